"""Bucketed catalog tables and joins over them that move no rows (J1, J3, J4 at scale).

A table that is joined on the same key again and again is written once in ``buckets`` hash buckets of
that key, sorted inside. Two tables with equal buckets of their join key are then joined bucket by bucket:
the plan has no exchange on either side. The ``merge`` hint keeps the sort-merge join also where one side
is small enough today to be broadcast. Rows whose key is NULL match nothing. A bucket is one task's work:
choose ``buckets`` by the table's size (some 128 MB each), and the same number, or a multiple, for tables that meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.sinks.tables import qualified


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """(Re)write the catalog table ``name`` at ``path``, one file a bucket; returns the table. The one
    shuffle deals rows out by the same hash as the buckets, so that a task writes one of them."""
    spark = df.sparkSession
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(qualified(name))
    return spark.table(qualified(name))


def drop_bucketed(spark: SparkSession, *names: str) -> None:
    """Forget tables (their files stay where they are)."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {qualified(name)}")


def attach(staged: DataFrame, silver: DataFrame, key: str = "event_id") -> DataFrame:
    """J1 over two tables bucketed by ``key``."""
    return staged.join(silver.select(key, "computed_session_id").hint("merge"), key, "left")


def unmatched(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """J3/Q4 over two tables bucketed by ``key``: child rows whose key the parent lacks."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key).hint("merge"), key, "left_anti")


def merged(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """K4/J4 over two tables bucketed by ``key``, which neither repeats: updates replace target rows, columns
    that only one side has are NULL in the other's rows. The result keeps the buckets' distribution."""
    t, u = target.alias("t"), updates.hint("merge").alias("u")
    new = F.col(f"u.`{key}`").isNotNull()
    columns = [*target.columns, *[c for c in updates.columns if c not in target.columns]]

    def pick(c: str):
        old = F.col(f"t.`{c}`") if c in target.columns else F.lit(None)
        return F.when(new, F.col(f"u.`{c}`") if c in updates.columns else F.lit(None)).otherwise(old).alias(c)

    return t.join(u, F.col(f"t.`{key}`") == F.col(f"u.`{key}`"), "full_outer").select(*[pick(c) for c in columns])
