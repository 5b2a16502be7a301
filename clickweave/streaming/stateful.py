"""Running sessions on a stream, with state and timers (T1 with W4's running ``computed_session_id``).

``session_window`` (streaming/sessions.py) cannot number a user's sessions, since a number needs all
that came before. Here every user has a state: the last event given out (its time, id, session
index and place in the session) and a buffer of events that may still be overtaken. The buffer is
given out in order of (time, id) as far as ``lateness`` before the user's latest event; a timer gives out
the rest when nothing has come for ``idle``. Released events get exactly the batch sessionizer's columns
(``operators.sessions``): a new session where the whole-second idle time exceeds the timeout, its
index, id and the event's place in it.

An event that arrives after one behind it has been given out is late: it is not lost but
comes out marked ``late``, without a session, and ``start_running_sessions`` writes it to a table of its
own. Rows without user or time are late in the same sense (they have no place in any session). Lateness
is counted on each user's own clock, so that a user whose device sends late does not depend on others.

State per user: one row and the buffered events (those of ``lateness``). ``ttl`` drops the state of users
that have not been seen for so long; one that comes back then starts with session 1 again, so set it only
beyond the longest pause that ids must survive. Needs a state store that holds timers beside the
value: start the query with ``STORE`` in the session's settings.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from clickweave.operators.sessions import DEFAULT_TIMEOUT_SECONDS

#: Setting and value that stateful variables need (the session's owner sets it).
STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
_OUT = (
    "user_id bigint, event_us bigint, event_order bigint, session_index bigint, idle_seconds bigint, session_flag int, "
    "event_seq bigint, late boolean"
)


def _processor(timeout_seconds: int, lateness_us: int, idle_ms: int, ttl_ms: int | None) -> StatefulProcessor:
    """The per-user state machine. Made in a function, so that workers need no module of this library."""
    import numpy as np
    import pandas as pd

    class RunningSessions(StatefulProcessor):
        """The state is one value: the last event given out, the timer that is set, and the buffered
        events as one run of bytes (int64 time and id of each, in order), read and written as a whole."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("user", "us bigint, ord bigint, idx bigint, seq bigint, timer bigint, held binary", ttl_ms)

        def _given_out(self, user: int, last: tuple, rows: np.ndarray, late: np.ndarray) -> tuple[pd.DataFrame, tuple]:
            """``rows``, which are in order, with their sessions, then the late ones; and what ``last`` is behind them."""
            us0, _, index, seq = last
            us, n = rows[:, 0], len(rows)
            sec = us // 1_000_000
            idle = np.diff(sec, prepend=sec[:1] if us0 is None else us0 // 1_000_000)
            new = idle > timeout_seconds
            first = np.zeros(n + len(late), bool)
            first[n:] = True
            if n and us0 is None:
                new[0] = first[0] = True
            indexes = index + np.cumsum(new)
            at = np.arange(n)
            begun = np.maximum.accumulate(np.where(new, at, -1))
            places = np.where(begun < 0, seq + at + 1, at - begun + 1)
            if n:
                last = (*rows[-1].tolist(), int(indexes[-1]), int(places[-1]))
            more = np.zeros(len(late), np.int64)
            isnt = np.arange(n + len(late)) >= n
            whole = lambda x, none: pd.arrays.IntegerArray(np.concatenate([x, more]).astype(np.int64), none)
            both = np.concatenate([rows, late])
            frame = pd.DataFrame(
                {
                    "user_id": np.full(len(both), user), "event_us": both[:, 0], "event_order": both[:, 1],
                    "session_index": whole(indexes, isnt), "idle_seconds": whole(idle, first),
                    "session_flag": pd.arrays.IntegerArray(np.concatenate([new, more]).astype(np.int32), isnt.copy()),
                    "event_seq": whole(places, isnt.copy()), "late": isnt,
                }
            )
            return frame, last

        def _read(self) -> tuple[tuple, int | None, np.ndarray]:
            """(last event given out, timer, buffered events)."""
            us, order, index, seq, timer, held = self.state.get() or (None, None, 0, 0, None, b"")
            return (us, order, index, seq), timer, np.frombuffer(bytes(held), np.int64).reshape(-1, 2)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            fresh = np.concatenate([np.stack([r["event_us"].to_numpy(np.int64), r["event_order"].to_numpy(np.int64)], axis=1) for r in rows])
            last, timer, held = self._read()
            behind = np.zeros(len(fresh), bool)
            if last[0] is not None:
                behind = (fresh[:, 0] < last[0]) | ((fresh[:, 0] == last[0]) & (fresh[:, 1] <= last[1]))
            late, held = fresh[behind], np.concatenate([held, fresh[~behind]])
            held = held[np.lexsort((held[:, 1], held[:, 0]))]
            ready = int(np.searchsorted(held[:, 0], held[-1, 0] - lateness_us, side="right")) if len(held) else 0
            if timer is not None:
                self.handle.deleteTimer(timer)
                timer = None
            if ready < len(held):
                timer = timerValues.getCurrentProcessingTimeInMs() + idle_ms
                self.handle.registerTimer(timer)
            frame = None
            if ready or len(late):
                frame, last = self._given_out(key[0], last, held[:ready], late)
            self.state.update((*last, timer, held[ready:].tobytes()))
            if frame is not None:
                yield frame

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            last, _, held = self._read()
            if len(held):
                frame, last = self._given_out(key[0], last, held, held[:0])
                self.state.update((*last, None, b""))
                yield frame

        def close(self) -> None:
            pass

    return RunningSessions()


def running_sessions(
    events: DataFrame,
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS,
    *,
    lateness_seconds: int = 7200,
    idle_seconds: float = 600,
    ttl_seconds: float | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    order_col: str = "src_event_id",
) -> DataFrame:
    """W4 on a stream: one row per event of ``events``, as soon as no earlier event of its user is awaited:
    user_id, event_timestamp, ``order_col``, idle_seconds, session_flag, session_index,
    computed_session_id, event_seq, late."""
    ts_type = dict(events.dtypes)[ts_col]
    placed = events.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull()).select(
        F.col(user_col).cast("bigint").alias("user_id"),
        F.unix_micros(F.col(ts_col).cast("timestamp")).alias("event_us"),
        F.col(order_col).cast("bigint").alias("event_order"),
    )
    ttl = None if ttl_seconds is None else int(1000 * ttl_seconds)
    made = placed.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=_processor(timeout_seconds, 1_000_000 * lateness_seconds, int(1000 * idle_seconds), ttl),
        outputStructType=StructType.fromDDL(_OUT),
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    index = F.col("session_index").cast("string")
    return made.select(
        "user_id", F.timestamp_micros("event_us").cast(ts_type).alias(ts_col), F.col("event_order").alias(order_col),
        "idle_seconds", "session_flag", "session_index", F.concat(F.col("user_id").cast("string"), F.lit("_"), index).alias("computed_session_id"),
        "event_seq", "late",
    )


def start_running_sessions(events: DataFrame, sink_path: str, late_path: str, checkpoint_path: str, *, processing_time: str = "0 seconds", **parameters) -> StreamingQuery:
    """``running_sessions`` as a running query that writes events with their sessions to ``sink_path`` and late
    ones to ``late_path``. Each micro-batch writes a folder of its own (``batch_id``) and replaces it when it is
    replayed, so a restart repeats nothing."""

    running = running_sessions(events, **parameters)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for path, rows in ((sink_path, batch.filter("NOT late").drop("late")), (late_path, batch.filter("late").drop("late"))):
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        batch.unpersist()

    empty = events.sparkSession.createDataFrame([], running.drop("late").schema)
    for path in (sink_path, late_path):  # readable before anything has come out
        empty.write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    return (
        running.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
        .trigger(processingTime=processing_time)
        .start()
    )


def run_out(query: StreamingQuery, spark: SparkSession, paths: list[str], rows: int, *, wait_seconds: float = 300) -> None:
    """Wait until a query over a finite source has given out ``rows`` rows to ``paths`` (those that timers
    give out too), then stop it. It fails after ``wait_seconds`` in which no more came out and no batch ran."""
    end, before = time.monotonic() + wait_seconds, -1
    while (found := sum(spark.read.parquet(p).count() for p in paths)) < rows:
        if found > before or query.status["isTriggerActive"]:
            end, before = time.monotonic() + wait_seconds, found
        if query.exception() is not None or time.monotonic() > end:
            query.stop()
            raise RuntimeError(f"the stream did not give out its {rows} rows") from query.exception()
        time.sleep(1)
    query.stop()
