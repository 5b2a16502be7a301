"""Drift of two periods (L9): concept drift, that is a change of the label's rate at equal feature values,
and the two-sample Kolmogorov-Smirnov distance of each feature.

Both start from counts per (feature, value) or (feature, bin), combined map-side. The cumulative sums that
the distance needs are prefix sums over ranges of (feature, value): no task sees a whole feature.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import stage
from clickweave.sources.schema import FEATURE_COLUMNS, LABEL_COLUMN


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``out: value`` of ``sums``, the sum of ``value`` up to and with the row within its
    ``keys`` in ``order`` (which must be total). Rows are dealt into ranges of (keys, order) and staged; each
    range adds what the ranges before it hold of its key: one row a range and key."""
    keys, by = list(keys), [*keys, *order]
    ranged = stage(df.sparkSession, df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = ranged.groupBy(*keys, "_range").agg(*[F.sum(v).alias(f"_s_{o}") for o, v in sums.items()])
    per = per.select(*keys, "_range", *[F.coalesce(F.sum(f"_s_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in sums])
    within = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({f"_l_{o}": F.sum(v).over(within) for o, v in sums.items()})
    return local.join(per, [*keys, "_range"]).select(*df.columns, *[(F.col(f"_b_{o}") + F.col(f"_l_{o}")).alias(o) for o in sums])


def _long(features: DataFrame, split_col: str, base: str, current: str, cols: list[str], *more: str) -> DataFrame:
    typed = features.where(F.col(split_col).isin(base, current)).select(split_col, *more, *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot([split_col, *more], cols, "feature", "value")


def ks_distance(
    features: DataFrame, split_col: str = "data_split", base: str = "train", current: str = "oot", feature_cols: Sequence[str] = FEATURE_COLUMNS, *, alpha: float = 0.05
) -> DataFrame:
    """Per feature: ``ks``, the largest difference of the two periods' distribution functions, n_base, n_cur
    (NULLs apart), ``critical``, the distance that chance exceeds with probability ``alpha``, and
    ``drifted`` (ks > critical)."""
    long = _long(features, split_col, base, current, list(feature_cols)).where("value IS NOT NULL")
    count = lambda p: F.count_if(F.col(split_col) == p)
    values = long.groupBy("feature", "value").agg(count(base).alias("base"), count(current).alias("cur"))
    run = prefix_sums(values, ["feature"], ["value"], {"upto_base": "base", "upto_cur": "cur"})
    n = run.groupBy("feature").agg(F.sum("base").alias("n_base"), F.sum("cur").alias("n_cur"))  # a row a feature
    gap = F.abs(F.try_divide(F.col("upto_base"), F.col("n_base")) - F.try_divide(F.col("upto_cur"), F.col("n_cur")))
    out = run.join(F.broadcast(n), "feature").groupBy("feature", "n_base", "n_cur").agg(F.max(gap).alias("ks"))
    c = math.sqrt(-math.log(alpha / 2) / 2)
    critical = F.lit(c) * F.sqrt(F.try_divide(F.col("n_base") + F.col("n_cur"), F.col("n_base") * F.col("n_cur")))
    return out.select("feature", "ks", "n_base", "n_cur", critical.alias("critical"), (F.col("ks") > critical).alias("drifted"))


def label_rates(
    features: DataFrame, split_col: str = "data_split", base: str = "train", current: str = "oot", feature_cols: Sequence[str] = FEATURE_COLUMNS,
    *, label: str = LABEL_COLUMN, bins: int = 10,
) -> DataFrame:
    """Per feature and bin (``bins`` equal ranges over both periods, -1 for NULL): rows and label rate of either
    period, ``shift`` (rate_cur - rate_base) and its ``z`` under one common rate."""
    long = _long(features, split_col, base, current, list(feature_cols), label)
    hit = F.coalesce(F.col(label).cast("boolean"), F.lit(False))
    of = lambda p, c=None: F.count_if((F.col(split_col) == p) & (F.lit(True) if c is None else c))
    values = long.groupBy("feature", "value").agg(
        of(base).alias("n_base"), of(base, hit).alias("h_base"), of(current).alias("n_cur"), of(current, hit).alias("h_cur")
    )
    ranges = values.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))  # a row a feature
    width = F.col("hi") - F.col("lo")
    bin_ = (
        F.when(F.col("value").isNull(), -1).when(width <= 0, 0)
        .otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1))).cast("int")
    )
    binned = values.join(F.broadcast(ranges), "feature").groupBy("feature", bin_.alias("bin"))
    sums = binned.agg(*[F.sum(c).alias(c) for c in ("n_base", "h_base", "n_cur", "h_cur")])
    rate = lambda h, n: F.try_divide(F.col(h).cast("double"), F.col(n))
    pooled = F.try_divide((F.col("h_base") + F.col("h_cur")).cast("double"), F.col("n_base") + F.col("n_cur"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("n_base")) + F.try_divide(F.lit(1.0), F.col("n_cur"))))
    shift = rate("h_cur", "n_cur") - rate("h_base", "n_base")
    return sums.select(
        "feature", "bin", "n_base", "n_cur", rate("h_base", "n_base").alias("rate_base"), rate("h_cur", "n_cur").alias("rate_cur"),
        shift.alias("shift"), F.try_divide(shift, spread).alias("z"),
    )


def concept_drift(rates: DataFrame) -> DataFrame:
    """Per feature of ``label_rates``: ``rate_shift``, the mean absolute shift over the bins that both periods
    have (weighed by the current period's rows), ``max_shift`` and n_bins."""
    both = rates.where("shift IS NOT NULL")
    size = F.abs("shift")
    return both.groupBy("feature").agg(
        (F.sum(size * F.col("n_cur")) / F.sum("n_cur")).alias("rate_shift"), F.max(size).alias("max_shift"), F.count(F.lit(1)).alias("n_bins")
    )
