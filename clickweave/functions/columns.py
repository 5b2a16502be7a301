"""Column expressions shared by the operators. All are built-in Spark SQL expressions (codegen'd,
JVM-side); none is a UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole unix seconds of a timestamp (D3). For ``timestamp_ntz`` the value is the wall clock read
    as UTC, independent of the session time zone, so differences are plain wall-clock seconds."""
    return F.unix_timestamp(col(ts))


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall clock (``timestamp_ntz``) of an instant, by microseconds since the epoch: no
    local zone is involved, so hours that a zone repeats or skips stay apart."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz"))


def utc_instant(wall: str | Column) -> Column:
    """The instant of a UTC wall clock, the inverse of ``utc_wall_clock``."""
    micros = F.floor(F.date_part(F.lit("SECOND"), col(wall)) * 1_000_000).cast("bigint") % 1_000_000
    # whole seconds are cut towards zero, so one before 1970 with a fraction is a second too late
    early = (micros > 0) & (col(wall) < wall_clock_literal("1970-01-01"))
    return F.timestamp_micros((epoch_seconds(wall) - early.cast("int")) * 1_000_000 + micros)


def wall_clock_literal(text: str) -> Column:
    """A ``timestamp_ntz`` constant from ISO text; unlike a Python datetime it has no zone."""
    return F.lit(text).cast("timestamp_ntz")


def reject_reasons(
    *,
    corrupt: str | None = None,
    user_id: str = "user_id",
    price: str = "price",
    extra: dict[str, Column] | None = None,
) -> Column:
    """Comma-separated names of the reject rules a row breaks; NULL when it breaks none.

    Default rules are the reference's three: a corrupt source line, a missing user and a negative
    price. Each rule is null-safe, so a NULL price is not a reject (D1)."""
    rules: list[tuple[str, Column]] = []
    if corrupt is not None:
        rules.append(("corrupt_record", F.col(corrupt).isNotNull()))
    rules.append(("null_user_id", F.col(user_id).isNull()))
    rules.append(("negative_price", F.coalesce(F.col(price) < 0, F.lit(False))))
    for name, cond in (extra or {}).items():
        rules.append((name, F.coalesce(cond, F.lit(False))))
    parts = [F.when(cond, F.lit(name)) for name, cond in rules]
    joined = F.concat_ws(",", *parts)
    return F.when(joined != "", joined)


def reference_reject_predicate(
    corrupt: str | None = None, user_id: str = "user_id", price: str = "price"
) -> Column:
    """The reference's un-guarded predicate: evaluates to NULL for a clean row with NULL price, so
    such a row falls out of both the clean and the reject side (R1). Only for ``strict`` mode."""
    pred = F.col(user_id).isNull() | (F.col(price) < 0)
    if corrupt is not None:
        pred = F.col(corrupt).isNotNull() | pred
    return pred


def normalized(c: str | Column) -> Column:
    """``lower(trim(c))`` (P5)."""
    return F.lower(F.trim(col(c)))


def category_level(code: str | Column, level: int) -> Column:
    """1-based dot-separated segment of a category code; NULL when absent (P10). ``get`` rather
    than ``[]`` (which raises under ANSI) or ``split_part`` (which returns '')."""
    return F.get(F.split(col(code), r"\."), F.lit(level - 1))


def surrogate_key(cols: Iterable[str | Column], time_cols: Iterable[str] = ()) -> Column:
    """md5 over the '-'-joined text of the key columns, NULL replaced by a token.
    Timestamp columns listed in ``time_cols`` are rendered to whole seconds."""
    time_cols = set(time_cols)
    parts = []
    for c in cols:
        if isinstance(c, str) and c in time_cols:
            text = F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")
        else:
            text = col(c).cast("string")
        parts.append(F.coalesce(text, F.lit(NULL_TOKEN)))
    return F.md5(F.concat_ws("-", *parts))


def session_id(user_id: str | Column, session_index: str | Column) -> Column:
    """``{user_id}_{session_index}``."""
    return F.concat(col(user_id).cast("string"), F.lit("_"), col(session_index).cast("string"))
