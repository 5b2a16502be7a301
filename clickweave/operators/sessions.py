"""Sessionization (W1-W5), source-session match rate (A9), year/month columns (P14) and the
carry-over variant for incremental batches (H1).

Semantics (reference spec): events of a user ordered by time; a new session starts at the first
event and whenever the whole-second idle time since the previous event is strictly greater than
the timeout; ``session_index`` counts sessions from 1 per user; ``computed_session_id`` is
``{user_id}_{session_index}``. Ties on time are ordered by a tie-breaker column so event
sequence numbers are deterministic.

Scale: a window partitioned by ``user_id`` puts one user's whole history into one task, which a
bot holding a large share of all rows turns into a straggler (or an OOM). ``sessionize`` therefore
cuts each user's timeline into chunks of width ``W <= timeout``. Two events of one chunk are less
than ``W`` apart, so a session can never start inside a chunk — only at a chunk's first event.
Hence:

1. a grouped aggregate per ``(user_id, chunk)`` — min/max second and count, combined map-side, so
   the shuffle carries one row per chunk and map task, never the events;
2. a window per user over those chunk rows only (at most time span / W rows per user, whatever the
   user's event volume): chunk-start flag, session index, events before the chunk;
3. one join of the chunk table back to the events on ``(user_id, chunk)``. The optional per-chunk
   window (``idle_seconds``, ``event_seq``) runs on the events before it, so that one shuffle and one
   sort of the events serve both the window and the join.

The result is identical to the single-window definition (tested), for any chunk width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.columns import epoch_seconds, session_id

DEFAULT_TIMEOUT_SECONDS = 1800
DEFAULT_CHUNK_SECONDS = 900

_UNB = Window.unboundedPreceding


def _flag(idle: Column, timeout_seconds: int) -> Column:
    """1 when a new session starts: no previous event, or idle strictly above the timeout."""
    return F.when(idle.isNull() | (idle > F.lit(timeout_seconds)), F.lit(1)).otherwise(F.lit(0))


def _tie_breakers(df: DataFrame, ts_col: str, order_col: str | None) -> list[str]:
    """Event order inside a user: time, then the first available tie-breaker column."""
    for c in (order_col, "src_event_id", "event_id"):
        if c and c in df.columns and c != ts_col:
            return [ts_col, c]
    return [ts_col]


def sessionize(
    df: DataFrame,
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS,
    *,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    order_col: str = "src_event_id",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    with_sequence: bool = True,
    state: DataFrame | None = None,
) -> DataFrame:
    """Add ``session_index``, ``computed_session_id`` and, with ``with_sequence`` (default),
    ``idle_seconds``, ``session_flag`` and ``event_seq`` (1-based position in the session, W5).
    Without it no per-event window (and no sort of the events) is planned.

    Rows with a NULL user or NULL time cannot be placed in a session and are dropped (D10); count
    them with ``unsessionizable``.

    ``state`` (one row per user: ``last_event_timestamp``, ``last_session_index``,
    ``last_session_events``) continues earlier sessions: a user's first session here carries on the
    stored one if the gap is within the timeout, else takes the next index. It is joined to the
    chunk rows, so events still move on (user, chunk) only.
    """
    if chunk_seconds <= 0 or timeout_seconds < 0:
        raise ValueError("chunk_seconds must be positive and timeout_seconds non-negative")
    order = _tie_breakers(df, ts_col, order_col)
    width = _chunk_width(timeout_seconds, chunk_seconds)
    sec = epoch_seconds(ts_col)
    base = df.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull()).withColumns(
        {"_sec": sec, "_chunk": F.floor(sec / F.lit(width))}
    )

    # 1-2. one row per chunk, then a per-user window over chunks only.
    wu = Window.partitionBy(user_col).orderBy("_chunk")
    upto = wu.rowsBetween(_UNB, Window.currentRow)
    flag = _flag(F.col("_c_min") - F.lag("_c_max").over(wu), timeout_seconds)
    chunks = (
        base.groupBy(user_col, "_chunk")
        .agg(F.min("_sec").alias("_c_min"), F.max("_sec").alias("_c_max"), F.count(F.lit(1)).alias("_c_n"))
        .select(
            user_col, "_chunk", "_c_n",
            F.lag("_c_max").over(wu).alias("_c_prev_max"),
            flag.alias("_c_flag"),
            F.col("_c_min").alias("_c_first"),
            (F.sum("_c_n").over(upto) - F.col("_c_n")).alias("_c_rank0"),
        )
        .select(
            user_col, "_chunk", "_c_prev_max", "_c_flag", "_c_rank0",
            F.sum("_c_flag").over(upto).alias("_c_index"),
            F.max(F.when(F.col("_c_flag") == 1, F.col("_c_rank0") + 1)).over(upto).alias("_c_start_rank"),
            F.first("_c_first").over(upto).alias("_c_first"),
        )
    )
    chunks = _continued(chunks, state, user_col, timeout_seconds)

    # 3. attach to the events, which the window has left sorted by (user, chunk).
    if with_sequence:
        w = Window.partitionBy(user_col, "_chunk").orderBy(*order)
        base = base.withColumns({"_c_rn": F.row_number().over(w), "_c_prev": F.lag("_sec").over(w)})
    out = base.join(chunks, [user_col, "_chunk"], "inner")
    index = F.col("_c_index").cast("bigint")
    cols = {"session_index": index, "computed_session_id": session_id(user_col, index)}
    if with_sequence:
        rn = F.col("_c_rn")
        first = rn == 1
        cols.update(
            {
                "idle_seconds": F.when(first, F.col("_sec") - F.col("_c_prev_max")).otherwise(F.col("_sec") - F.col("_c_prev")),
                "session_flag": F.when(first, F.col("_c_flag")).otherwise(F.lit(0)),
                "event_seq": (F.col("_c_rank0") + rn - F.col("_c_start_rank") + 1 + F.col("_c_carried")).cast("bigint"),
            }
        )
    out = out.withColumns(cols)
    return out.select(*[c for c in out.columns if not (c.startswith("_") and c not in df.columns)])


def _chunk_width(timeout_seconds: int, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> int:
    return max(1, min(chunk_seconds, timeout_seconds)) if timeout_seconds > 0 else 1


def _continued(chunks: DataFrame, state: DataFrame | None, user_col: str, timeout_seconds: int) -> DataFrame:
    """Chunk rows numbered on from the users' stored state. ``_c_carried``: events that the stored
    part of the session already holds. ``_c_first`` is the user's first second here."""
    if state is None:
        return chunks.withColumn("_c_carried", F.lit(0)).drop("_c_first")
    st = state.select(
        F.col(user_col), epoch_seconds("last_event_timestamp").alias("_s_last"),
        F.col("last_session_index").alias("_s_index"), F.col("last_session_events").alias("_s_events"),
    )
    gap = F.col("_c_first") - F.col("_s_last")
    on = F.coalesce(gap <= F.lit(timeout_seconds), F.lit(False))
    first_chunk = F.col("_c_rank0") == 0
    return (
        chunks.join(st, user_col, "left")
        .withColumns(
            {
                "_c_carried": F.when(on & (F.col("_c_index") == 1), F.col("_s_events")).otherwise(F.lit(0)),
                "_c_prev_max": F.when(first_chunk, F.col("_s_last")).otherwise(F.col("_c_prev_max")),
                "_c_flag": F.when(first_chunk & on, F.lit(0)).otherwise(F.col("_c_flag")),
                "_c_index": F.col("_c_index") + F.coalesce("_s_index", F.lit(0)) - on.cast("int"),
            }
        )
        .drop("_c_first", "_s_last", "_s_index", "_s_events")
    )


def sessionize_by_user(
    df: DataFrame,
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS,
    *,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    order_col: str = "src_event_id",
) -> DataFrame:
    """The reference's literal single-window form (W1-W5): one window per user. Same result as
    ``sessionize``; fine when no user is large. Kept as the executable definition for tests."""
    w = Window.partitionBy(user_col).orderBy(*_tie_breakers(df, ts_col, order_col))
    prev = F.lag(ts_col).over(w)
    out = (
        df.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull())
        .withColumn("idle_seconds", epoch_seconds(ts_col) - epoch_seconds(prev))
        .withColumn("session_flag", _flag(F.col("idle_seconds"), timeout_seconds))
        .withColumn("session_index", F.sum("session_flag").over(w.rowsBetween(_UNB, Window.currentRow)).cast("bigint"))
        .withColumn("computed_session_id", session_id(user_col, "session_index"))
    )
    ws = Window.partitionBy(user_col, "session_index").orderBy(*_tie_breakers(df, ts_col, order_col))
    return out.withColumn("event_seq", F.row_number().over(ws).cast("bigint"))


def unsessionizable(df: DataFrame, *, user_col: str = "user_id", ts_col: str = "event_timestamp") -> DataFrame:
    """One-row count of rows that ``sessionize`` leaves out (NULL user or NULL time), D10."""
    bad = F.col(user_col).isNull() | F.col(ts_col).isNull()
    return df.agg(F.count_if(bad).alias("unsessionizable_rows"))


def session_match_rate(
    silver: DataFrame, *, source_col: str = "user_session", session_col: str = "computed_session_id"
) -> DataFrame:
    """Share of source sessions that map to exactly one computed session.

    One row: ``n_user_sessions``, ``n_matched``, ``match_rate`` (NULL on empty input, D11). NULL
    source sessions are excluded. ``min = max`` replaces ``count(distinct) = 1`` so the per-source
    aggregate combines map-side even for a huge source session."""
    per_source = (
        silver.filter(F.col(source_col).isNotNull())
        .groupBy(source_col)
        .agg((F.min(session_col) == F.max(session_col)).alias("_one"))
    )
    return per_source.agg(
        F.count(F.lit(1)).alias("n_user_sessions"),
        F.count_if("_one").alias("n_matched"),
        F.avg(F.col("_one").cast("double")).alias("match_rate"),
    )


def match_rate_value(silver: DataFrame, **kw) -> float | None:
    """The reference's scalar form of A9 (one aggregated row to the driver)."""
    return session_match_rate(silver, **kw).first()["match_rate"]


def with_year_month(df: DataFrame, ts_col: str = "event_timestamp") -> DataFrame:
    """``event_year``, ``event_month`` partition columns of the silver layer."""
    return df.withColumn("event_year", F.year(ts_col)).withColumn("event_month", F.month(ts_col))


def session_state(silver: DataFrame, *, user_col: str = "user_id", ts_col: str = "event_timestamp") -> DataFrame:
    """H1 state, one row per user: last event time, last session index, the number of events in
    that last session (so a continued session's ``event_seq`` carries on) and its start time (so a
    refresh knows how far back a continued session reaches)."""
    per_session = silver.groupBy(user_col, "session_index").agg(
        F.min(ts_col).alias("_start"), F.max(ts_col).alias("_last_ts"), F.count(F.lit(1)).alias("_n")
    )
    return per_session.groupBy(user_col).agg(
        F.max("_last_ts").alias("last_event_timestamp"),
        F.max("session_index").alias("last_session_index"),
        F.max_by("_n", "session_index").alias("last_session_events"),
        F.max_by("_start", "session_index").alias("last_session_start"),
    )


def advance_state(
    state: DataFrame, fresh: DataFrame, *, user_col: str = "user_id", ts_col: str = "event_timestamp"
) -> DataFrame:
    """The state after ``fresh`` (rows returned by ``sessionize_incremental``) — computed from the
    batch and the old state only, never from the full history."""
    per_session = fresh.groupBy(user_col, "session_index").agg(
        F.min(ts_col).alias("_start"), F.max(ts_col).alias("_last_ts"), F.max("event_seq").alias("_n")
    )
    new = per_session.groupBy(user_col).agg(
        F.max("_last_ts").alias("_ts"),
        F.max("session_index").alias("_idx"),
        F.max_by("_n", "session_index").alias("_n"),
        F.max_by("_start", "session_index").alias("_start"),
    )
    old = state.select(user_col, "last_session_index", "last_session_start")
    continued = F.col("_idx") == F.col("last_session_index")
    updated = new.join(old, user_col, "left").select(
        user_col,
        F.col("_ts").alias("last_event_timestamp"),
        F.col("_idx").alias("last_session_index"),
        F.col("_n").alias("last_session_events"),
        F.when(continued, F.col("last_session_start")).otherwise(F.col("_start")).alias("last_session_start"),
    )
    kept = state.join(new.select(user_col), user_col, "left_anti")
    return kept.unionByName(updated)


def split_late(
    new_events: DataFrame,
    state: DataFrame,
    *,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """(fresh, late): events after their user's ``last_event_timestamp`` (or without stored state, or
    without user or time) and those at or before it. The state meets the events by chunk, so a
    hot user's events are not joined in one task."""
    sec = F.floor(epoch_seconds(ts_col) / F.lit(_chunk_width(timeout_seconds)))
    base = new_events.withColumn("_chunk", sec)
    chunks = base.filter(F.col(user_col).isNotNull()).groupBy(user_col, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    last = chunks.join(state.select(user_col, F.col("last_event_timestamp").alias("_last")), user_col)
    tagged = base.join(last.select(user_col, "_chunk", "_last"), [user_col, "_chunk"], "left")
    late = F.coalesce(F.col(ts_col) <= F.col("_last"), F.lit(False))
    return tagged.filter(~late).select(*new_events.columns), tagged.filter(late).select(*new_events.columns)


def sessionize_incremental(
    new_events: DataFrame,
    state: DataFrame,
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS,
    *,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    order_col: str = "src_event_id",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """H1: sessionize a new batch so that indexes continue each user's history; returns
    ``(sessionized, late)``.

    ``state`` is ``session_state`` of everything already sessionized. Events strictly after a user's
    ``last_event_timestamp`` continue the last known session (gap within the timeout) or open the
    next one. Earlier (late) events need their user's recompute from history and come back as they
    are.
    """
    fresh, late = split_late(new_events, state, user_col=user_col, ts_col=ts_col, timeout_seconds=timeout_seconds)
    out = sessionize(
        fresh, timeout_seconds, user_col=user_col, ts_col=ts_col, order_col=order_col, chunk_seconds=chunk_seconds, state=state
    )
    return out, late


def late_events(
    new_events: DataFrame, state: DataFrame, *, user_col: str = "user_id", ts_col: str = "event_timestamp"
) -> DataFrame:
    """New events at or before their user's stored last event time (need a full recompute)."""
    return split_late(new_events, state, user_col=user_col, ts_col=ts_col)[1]
