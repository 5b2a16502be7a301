"""Mergeable summaries kept in tables: distinct counts (A4, A13) and quantiles (L9) of any union of
periods, without reading the events of a period again.

Distinct counts are HyperLogLog sketches with 2^``LG_K`` registers: the relative standard error is about
1.04 / sqrt(2^LG_K), that is 1.6 % at 12. Quantiles are KLL sketches; with ``KLL_K`` = 200 a quantile's rank
is off by no more than 1.65 % (at 99 % confidence). Both are merged by an aggregate that combines
map-side, so a period of any size moves one sketch a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.sources.schema import FEATURE_COLUMNS

LG_K = 12
KLL_K = 200
#: Rank error of a KLL sketch of ``KLL_K`` at 99 % confidence (both sides).
KLL_RANK_ERROR = 0.0165


def hll_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def hourly_distinct(fct: DataFrame, distinct: Sequence[str] = ("user_id",), *, ts_col: str = "event_timestamp", lg_k: int = LG_K) -> DataFrame:
    """One row per hour: event_date, event_hour, n_events and a sketch ``<column>_sketch`` of each of
    ``distinct``. This is the table to keep; a new hour adds its row."""
    hours = fct.groupBy(F.to_date(ts_col).alias("event_date"), F.hour(ts_col).alias("event_hour"))
    return hours.agg(F.count(F.lit(1)).alias("n_events"), *[F.hll_sketch_agg(c, lg_k).alias(f"{c}_sketch") for c in distinct])


def merged_distinct(hours: DataFrame, by: dict[str, Column], distinct: Sequence[str] = ("user_id",)) -> DataFrame:
    """``hourly_distinct`` rows merged into coarser periods ``by`` (name: column): n_events and, for each
    of ``distinct``, its sketch and the estimate ``n_<column>``."""
    merged = hours.groupBy(*[v.alias(k) for k, v in by.items()]).agg(
        F.sum("n_events").alias("n_events"), *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in distinct]
    )
    return merged.withColumns({f"n_{c}": F.hll_sketch_estimate(f"{c}_sketch") for c in distinct})


def quantile_sketches(features: DataFrame, by: Sequence[str] = ("data_partition",), feature_cols: Sequence[str] = FEATURE_COLUMNS, *, k: int = KLL_K) -> DataFrame:
    """One row per period and feature: a KLL sketch of the feature's values (NULLs are not in it)."""
    cols = list(feature_cols)
    long = features.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(by), cols, "feature", "value")
    return long.where("value IS NOT NULL").groupBy(*by, "feature").agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """Sketches of many periods merged into one for each ``by``."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def _ranks(bins: int) -> Column:
    return F.array(*[F.lit(i / bins) for i in range(1, bins)])


def sketched_psi(base: DataFrame, current: DataFrame, *, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """L9 from sketches alone: per feature, the population-stability index of ``current`` against ``base``
    (``merged_quantiles`` of either period) with bins at the base's quantiles; neither period is read."""
    quantiles = base.select("feature", F.kll_sketch_get_quantile_double("sketch", _ranks(bins)).alias("q")).collect()  # bins numbers a feature
    edges = {r["feature"]: F.array(*[F.lit(v) for v in sorted(set(r["q"]))]) for r in quantiles}

    def upto(sketch: str) -> Column:
        """The sketch's share of values up to each edge (edges must be constants), and all."""
        out = F.lit(None).cast("array<double>")
        for feature, e in edges.items():
            out = F.when(F.col("feature") == feature, F.kll_sketch_get_rank_double(sketch, e)).otherwise(out)
        return F.concat(out, F.array(F.lit(1.0)))

    both = base.select("feature", F.col("sketch").alias("base")).join(current.select("feature", F.col("sketch").alias("cur")), "feature")
    ranked = both.select(
        "feature", F.kll_sketch_get_n_double("base").alias("n_base"), F.kll_sketch_get_n_double("cur").alias("n_cur"), upto("base").alias("base"), upto("cur").alias("cur")
    )
    share = lambda c: F.transform(c, lambda x, i: x - F.when(i > 0, F.get(F.col(c), i - 1)).otherwise(0.0))
    terms = F.zip_with(share("base"), share("cur"), lambda b, c: (c - b) * F.log((c + eps) / (b + eps)))
    return ranked.select("feature", F.aggregate(terms, F.lit(0.0), lambda a, x: a + x).alias("psi"), "n_base", "n_cur")
