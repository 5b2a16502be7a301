"""Declarative data tests as queries (Q1-Q6, J3). Each ``*_violations`` returns the offending rows
(zero rows = pass). ``check_*`` return one summary row per tested column in the common shape
``(check_name, table_name, column_name, n_violations)``, and ``run_checks`` unions a list of them.
Every check is one scan with a grouped or global aggregate; none collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickweave.sources.schema import ACCEPTED_EVENT_TYPES

SUMMARY_COLUMNS = ("check_name", "table_name", "column_name", "n_violations")


def _summary(df: DataFrame, check: str, table: str, column: str, n: F.Column) -> DataFrame:
    return df.agg(n.cast("bigint").alias("n_violations")).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        "n_violations",
    )


# Q1 unique ---------------------------------------------------------------------------------------
def unique_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_unique(df: DataFrame, key: str, table: str) -> DataFrame:
    dup = unique_violations(df.filter(F.col(key).isNotNull()), key)
    return _summary(dup, "unique", table, key, F.coalesce(F.sum("n"), F.lit(0)))


# Q2 not_null -------------------------------------------------------------------------------------
def check_not_null(df: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """All columns in one pass (``count_if`` per column), then unpivoted to one row per column."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "n_violations")
    return long.select(
        F.lit("not_null").alias("check_name"), F.lit(table).alias("table_name"), "column_name",
        F.col("n_violations").cast("bigint").alias("n_violations"),
    )


# Q3 accepted_values ------------------------------------------------------------------------------
def accepted_values_violations(df: DataFrame, column: str, values: Sequence[str] = ACCEPTED_EVENT_TYPES) -> DataFrame:
    """Values outside the accepted list (NULL is not tested, as in declarative data tests), with counts."""
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n_violations"))


def check_accepted_values(df: DataFrame, column: str, table: str, values: Sequence[str] = ACCEPTED_EVENT_TYPES) -> DataFrame:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return _summary(df, "accepted_values", table, column, F.count_if(bad))


# Q4 / J3 relationships ---------------------------------------------------------------------------
def relationship_violations(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in ``parent`` (left anti join)."""
    pc = parent_column or column
    keys = parent.select(F.col(pc).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def check_relationship(child: DataFrame, parent: DataFrame, column: str, table: str, parent_column: str | None = None) -> DataFrame:
    return _summary(relationship_violations(child, parent, column, parent_column), "relationships", table, column,
                    F.count(F.lit(1)))


# Q5 session duration -----------------------------------------------------------------------------
def duration_violations(features: DataFrame, tolerance_seconds: int = 0) -> DataFrame:
    """Sessions with ``session_duration_sec < -tolerance`` (tolerance e.g. 60 for clock skew)."""
    return features.filter(F.col("session_duration_sec") < -tolerance_seconds).select(
        "computed_session_id", "session_duration_sec"
    )


def check_duration(features: DataFrame, table: str, tolerance_seconds: int = 0) -> DataFrame:
    return _summary(features, "non_negative_duration", table, "session_duration_sec",
                    F.count_if(F.col("session_duration_sec") < -tolerance_seconds))


# Q6 price ----------------------------------------------------------------------------------------
def negative_price_violations(df: DataFrame, column: str = "price") -> DataFrame:
    return df.filter(F.col(column) < 0)


def check_non_negative(df: DataFrame, column: str, table: str) -> DataFrame:
    return _summary(df, "non_negative", table, column, F.count_if(F.col(column) < 0))


def _row_rules(
    not_null: Sequence[str], accepted_values: dict[str, Sequence[str]] | None, non_negative: Sequence[str], min_value: dict[str, float] | None
) -> list[tuple[str, str, F.Column]]:
    """(check name, column, condition of a violation) of every row-level rule."""
    rules: list[tuple[str, str, F.Column]] = []
    rules += [("not_null", c, F.col(c).isNull()) for c in not_null]
    for c, values in (accepted_values or {}).items():
        rules.append(("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(values))))
    rules += [("non_negative", c, F.col(c) < 0) for c in non_negative]
    for c, low in (min_value or {}).items():
        rules.append(("non_negative_duration" if c == "session_duration_sec" else "min_value", c, F.col(c) < low))
    return rules


# All row-level rules of one table in one scan --------------------------------------------------
def check_table(
    df: DataFrame,
    table: str,
    *,
    not_null: Sequence[str] = (),
    accepted_values: dict[str, Sequence[str]] | None = None,
    non_negative: Sequence[str] = (),
    min_value: dict[str, float] | None = None,
) -> DataFrame:
    """Q2, Q3, Q5, Q6 for one table from a single aggregate (one scan of the table however many
    rules), unpivoted to the summary shape. ``min_value`` = {column: lowest allowed value}, e.g.
    ``{"session_duration_sec": -60}`` for a clock-skew tolerance."""
    rules = _row_rules(not_null, accepted_values, non_negative, min_value)
    counts = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_, _, cond) in enumerate(rules)])
    pairs = ", ".join(f"'{name}', '{col}', r{i}" for i, (name, col, _) in enumerate(rules))
    long = counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (check_name, column_name, n_violations)")
    return long.select(
        "check_name", F.lit(table).alias("table_name"), "column_name",
        F.col("n_violations").cast("bigint").alias("n_violations"),
    )


class WriteChecks:
    """The row-level rules of one table, counted by the job that writes it: ``watch`` the rows right before
    the write, then read the ``summary`` after it, with no scan of what was written. ``watch`` must be
    the last step, behind any exchange, so that each row passes it once."""

    def __init__(
        self, table: str, *, not_null: Sequence[str] = (), accepted_values: dict[str, Sequence[str]] | None = None,
        non_negative: Sequence[str] = (), min_value: dict[str, float] | None = None,
    ):
        self.table, self.rules = table, _row_rules(not_null, accepted_values, non_negative, min_value)
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        self.spark = df.sparkSession
        counts = [F.count_if(cond).alias(f"r{i}") for i, (_, _, cond) in enumerate(self.rules)]
        return df.observe(self.observation, F.count(F.lit(1)).alias("n_rows"), *counts)

    @property
    def rows(self) -> int:
        return self.observation.get["n_rows"]

    def summary(self) -> DataFrame:
        """Rows like those of ``check_table``."""
        got = self.observation.get
        rows = [(name, self.table, column, got[f"r{i}"]) for i, (name, column, _) in enumerate(self.rules)]
        return self.spark.createDataFrame(rows, "check_name string, table_name string, column_name string, n_violations bigint")


def run_checks(checks: Iterable[DataFrame]) -> DataFrame:
    """Union of summary rows; ``passed`` = no violation."""
    out = reduce(DataFrame.unionByName, list(checks))
    return out.withColumn("passed", F.col("n_violations") == 0)
