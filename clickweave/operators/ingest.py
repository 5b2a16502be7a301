"""Bronze: reject/clean split (P1, P2), timestamp parsing (P3) and output balancing.

``split_rejects`` returns both sides of one staged input. The reject predicate is null-safe
(D1): a NULL price is clean. ``strict_reference_nulls=True`` reproduces the reference's
three-valued predicate, which drops such rows from both sides (R1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import reference_reject_predicate, reject_reasons, utc_wall_clock
from clickweave.sources.schema import CORRUPT_COLUMN, RAW_TIME_PATTERN


def strict_rules(time_text_col: str = "event_time_text") -> dict[str, F.Column]:
    """D2's optional extra rules: the columns the raw schema declares required (the file reader does
    not enforce ``nullable=False``, M1) and an event time that did not parse."""
    rules = {
        "null_event_type": F.col("event_type").isNull(),
        "null_product_id": F.col("product_id").isNull(),
        "null_event_time": F.col(time_text_col).isNull(),
        "unparseable_time": F.col(time_text_col).isNotNull() & F.col("event_timestamp").isNull(),
    }
    return rules


def with_reject_reason(
    df: DataFrame,
    *,
    extra_rules: dict[str, F.Column] | None = None,
    user_col: str = "user_id",
    price_col: str = "price",
) -> DataFrame:
    """Add ``reject_reason`` (comma-separated rule names, NULL for clean rows)."""
    corrupt = CORRUPT_COLUMN if CORRUPT_COLUMN in df.columns else None
    return df.withColumn(
        "reject_reason", reject_reasons(corrupt=corrupt, user_id=user_col, price=price_col, extra=extra_rules)
    )


def split_rejects(
    df: DataFrame,
    *,
    extra_rules: dict[str, F.Column] | None = None,
    strict_reference_nulls: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)``. ``rejects`` keeps every input column plus ``reject_reason``;
    ``clean`` drops the corrupt-record column. Stage CSV input first (``sources.csv_events``) so
    the corrupt flag does not depend on which columns a later query reads (M2)."""
    corrupt = CORRUPT_COLUMN if CORRUPT_COLUMN in df.columns else None
    if strict_reference_nulls:
        pred = reference_reject_predicate(corrupt)
        rejects = with_reject_reason(df, extra_rules=extra_rules).filter(pred)
        clean = df.filter(~pred)
    else:
        tagged = with_reject_reason(df, extra_rules=extra_rules)
        rejects = tagged.filter(F.col("reject_reason").isNotNull())
        clean = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    if corrupt is not None:
        clean = clean.drop(corrupt)
    return clean, rejects


def parse_event_time(df: DataFrame, *, src_col: str = "event_time", pattern: str = RAW_TIME_PATTERN) -> DataFrame:
    """P3 + D9: parse ``event_time`` text (with zone) to a UTC wall-clock ``timestamp_ntz``
    ``event_timestamp``; unparseable text gives NULL (``try_to_timestamp``), never an error. The
    result does not depend on the session time zone."""
    instant = F.try_to_timestamp(F.col(src_col), F.lit(pattern))
    return df.withColumn("event_timestamp", utc_wall_clock(instant)).drop(src_col)


def rebalance(df: DataFrame, num_partitions: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Balance output files. With a number, a round-robin ``repartition(n)`` as in the
    reference; without, a ``REBALANCE`` hint that AQE sizes from the measured data. ``by`` (the
    table's partition columns) keeps each output directory in few files; AQE still splits a hot
    value (a big day) over several tasks."""
    if num_partitions:
        return df.repartition(num_partitions)
    return df.hint("rebalance", *by) if by else df.hint("rebalance")
