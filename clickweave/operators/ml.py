"""Purchase-conversion model: pipeline (L1, L2), splits (L3, L4), fit and validation (L5), batch
scoring (L6, K12), ROC/PR-AUC (L7), feature importances (L8, O1), drift (L9), model persistence
(K10, S6) and the metrics report (K11).

Everything is ``pyspark.ml`` or DataFrame expressions; no UDFs. Training data never passes
through the driver; only the fitted model, a handful of metrics and nine importances do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.session import stage
from clickweave.sources.schema import FEATURE_COLUMNS, LABEL_COLUMN

# Fixed values (must equal the reference's configuration): model hyper-parameters and split.
GBT_MAX_ITER = 20
GBT_MAX_DEPTH = 5
RF_NUM_TREES = 100
RF_MAX_DEPTH = 5
VAL_RATIO = 0.2
SEED = 42


def prepare(features: DataFrame, feature_cols: Sequence[str] = FEATURE_COLUMNS, label: str = LABEL_COLUMN) -> DataFrame:
    """ML edge of the feature table: label to int (R8, a boolean label is rejected by the
    classifiers), NULL features to 0.0 (sessions without a priced view; the assembler rejects
    NULL, D12)."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feature_cols]
    keep = [c for c in features.columns if c not in set(feature_cols) | {label}]
    return features.select(*keep, *cols, F.col(label).cast("int").alias(label))


def _front(feature_cols: Sequence[str]):
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return [assembler, scaler]


def build_gbt(
    feature_cols: Sequence[str] = FEATURE_COLUMNS,
    label: str = LABEL_COLUMN,
    *,
    max_iter: int = GBT_MAX_ITER,
    max_depth: int = GBT_MAX_DEPTH,
    seed: int = SEED,
) -> Pipeline:
    """L1: assemble -> standardise (mean and std) -> gradient-boosted trees."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[*_front(feature_cols), gbt])


def build_random_forest(
    feature_cols: Sequence[str] = FEATURE_COLUMNS,
    label: str = LABEL_COLUMN,
    *,
    num_trees: int = RF_NUM_TREES,
    max_depth: int = RF_MAX_DEPTH,
    seed: int = SEED,
) -> Pipeline:
    """L2: the alternative classifier."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[*_front(feature_cols), rf])


def random_split(df: DataFrame, val_ratio: float = VAL_RATIO, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """L3 as specified: ``randomSplit([1-r, r], seed)``. Its membership depends on the input's
    partitioning; ``hash_split`` does not."""
    train, val = df.randomSplit([1.0 - val_ratio, val_ratio], seed=seed)
    return train, val


def hash_split(
    df: DataFrame, key: str = "computed_session_id", val_ratio: float = VAL_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """L3, reproducible: a row is in validation when ``pmod(xxhash64(key, seed), 10000) < r*10000``;
    the same key is always on the same side, whatever the partitioning or re-execution."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10000))
    is_val = bucket < F.lit(int(round(val_ratio * 10000)))
    return df.filter(~is_val), df.filter(is_val)


def temporal_split(
    df: DataFrame, cutoff: str, ts_col: str = "session_start", *, start_date: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """L4: train before ``cutoff``, out-of-time at or after it; rows before ``start_date`` are left
    out."""
    cut = F.lit(cutoff).cast("timestamp_ntz")
    if start_date is not None:
        df = df.filter(F.col(ts_col) >= F.lit(start_date).cast("timestamp_ntz"))
    return df.filter(F.col(ts_col) < cut), df.filter(F.col(ts_col) >= cut)


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit (iterative Spark jobs; checkpoints go to the session's checkpoint folder).

    The training frame (one row per session) is persisted for the duration of the fit, so the
    scaler's statistics pass and the boosting rounds do not each recompute sessionization; a lost
    block is recomputed from lineage. It is released when the fit returns."""
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("computed_session_id",)) -> DataFrame:
    """Batch inference; ``score`` = probability of the positive class."""
    pred = model.transform(df)
    label = [LABEL_COLUMN] if LABEL_COLUMN in pred.columns else []
    return pred.select(
        *keep,
        *label,
        F.get(vector_to_array("probability"), 1).alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def evaluate(predictions: DataFrame, label: str = LABEL_COLUMN, score_col: str = "score") -> dict:
    """ROC-AUC and PR-AUC with Spark's evaluator, exact (``numBins=0``: no down-sampling). The
    scores are staged, so the model runs once for both."""
    df = predictions.select(F.col(score_col).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
    df = stage(df.sparkSession, df, "predictions")
    out = {}
    for key, metric in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0)
        out[key] = ev.evaluate(df)
    return out


def roc_auc_frame(df: DataFrame, score_col: str, label_col: str, *, buckets: int = 1024) -> DataFrame:
    """L7 as a DataFrame: exact ROC-AUC (ties count one half) = Σ pos(s)·(neg(<s) + neg(s)/2) / (P·N).

    Distributed: rows are first reduced to one row per distinct score (map-side combined); the
    distinct scores are cut into about ``buckets`` ranges at approximate quantiles (computed once,
    a list of at most ``buckets`` numbers, then a binary-search ``Bucketizer``; any monotone cut
    keeps the result exact, quantiles keep the ranges balanced);
    negatives below a score = the negatives of all lower buckets (a prefix over at most
    ``buckets`` rows, broadcast — its size is the parameter, not the data) + the lower scores inside
    its own bucket (a window per bucket). Returns one row: ``n_pos``, ``n_neg``, ``n_unscored``
    (rows without a score or label, which take no part), ``roc_auc``."""
    per_all = score_counts(df, score_col, label_col)
    per = per_all.filter(F.col("s").isNotNull() & (F.col("pos") + F.col("neg") > 0))
    qs = [i / buckets for i in range(1, buckets)]
    edges = per.agg(F.percentile_approx("s", qs, 10 * buckets).alias("e")).first()["e"] if qs else None
    splits = [float("-inf"), *sorted({e for e in (edges or []) if e is not None}), float("inf")]
    if len(splits) < 3:
        per = per.withColumn("b", F.lit(0))
    else:
        per = Bucketizer(splits=splits, inputCol="s", outputCol="_b").transform(per)
        per = per.withColumn("b", F.col("_b").cast("int")).drop("_b")
    offsets = per.groupBy("b").agg(F.sum("neg").alias("bneg"))
    offsets = offsets.withColumn(
        "neg_before_bucket", F.coalesce(F.sum("bneg").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("bneg")
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("neg_before_inside", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    per = per.join(F.broadcast(offsets), "b")
    term = F.col("pos") * (F.col("neg_before_bucket") + F.col("neg_before_inside") + F.col("neg") * F.lit(0.5))
    tot = per.agg(F.sum(term).alias("num"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return tot.select(
        F.col("n_pos").cast("bigint").alias("n_pos"),
        F.col("n_neg").cast("bigint").alias("n_neg"),
        F.lit(_unscored(per_all)).cast("bigint").alias("n_unscored"),
        F.try_divide(F.col("num"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("roc_auc"),
    )


def score_counts(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Positives, negatives and unlabelled rows per distinct score, staged: what both curves read."""
    s = df.select(F.col(score_col).cast("double").alias("s"), F.col(label_col).cast("boolean").alias("y"))
    per = s.groupBy("s").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"), F.count_if(F.col("y").isNull()).alias("none"))
    return stage(df.sparkSession, per, "scores")


def _unscored(per: DataFrame) -> int:
    missing = F.when(F.col("s").isNull(), F.col("pos") + F.col("neg") + F.col("none")).otherwise(F.col("none"))
    return per.agg(F.coalesce(F.sum(missing), F.lit(0))).first()[0]


def pr_auc_frame(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """L7 as a DataFrame: area under the precision-recall curve, by the trapezoid rule over one
    point per distinct score from the highest down, starting at recall 0 with the precision of the
    first point (as Spark's evaluator). The running counts are distributed: score ranges, then one
    row of totals per range. One row: ``n_pos``, ``n_neg``, ``pr_auc``."""
    per = score_counts(df, score_col, label_col).filter(F.col("s").isNotNull() & (F.col("pos") + F.col("neg") > 0))
    ranged = per.repartitionByRange(F.col("s").desc()).withColumn("_range", F.spark_partition_id())
    ranged = stage(df.sparkSession, ranged, "score-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = ranged.groupBy("_range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.min("s").alias("low")).select(
        "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("p", "n")]
    )
    upto = Window.partitionBy("_range").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = ranged.join(F.broadcast(offsets), "_range").select(
        "pos", "neg", (F.col("p0") + F.sum("pos").over(upto)).alias("tp"), (F.col("n0") + F.sum("neg").over(upto)).alias("fp")
    )
    # the point before this one has the counts less this score's own
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    earlier = F.when(tp0 + fp0 == 0, precision).otherwise(tp0 / (tp0 + fp0))
    area = at.agg(F.sum(F.col("pos") * (precision + earlier) / 2).alias("area"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return area.select(
        F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"),
        F.try_divide("area", F.col("n_pos").cast("double")).alias("pr_auc"),
    )


def feature_importance(model: PipelineModel, feature_cols: Sequence[str] = FEATURE_COLUMNS) -> list[tuple[str, float]]:
    """L8 + O1: (feature, importance) sorted by importance descending, then name."""
    imp = model.stages[-1].featureImportances.toArray()
    pairs = [(name, float(v)) for name, v in zip(feature_cols, imp)]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def importance_frame(spark: SparkSession, model: PipelineModel, feature_cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    rows = [(i + 1, n, v) for i, (n, v) in enumerate(feature_importance(model, feature_cols))]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    """K10."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S6."""
    return PipelineModel.load(path)


def metrics_report(spark: SparkSession, metrics: dict, importances: list[tuple[str, float]]) -> DataFrame:
    """K11 content: one row, metrics as columns, importances as ``array<struct<feature, importance>>``."""
    schema = "roc_auc double, pr_auc double, feature_importance array<struct<feature: string, importance: double>>"
    row = (metrics.get("roc_auc"), metrics.get("pr_auc"), [(n, v) for n, v in importances])
    return spark.createDataFrame([row], schema)


def write_metrics(report: DataFrame, path: str) -> None:
    """The report as JSON (one small file)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def drift_psi(
    features: DataFrame,
    split_col: str = "data_split",
    base: str = "train",
    current: str = "oot",
    feature_cols: Sequence[str] = FEATURE_COLUMNS,
    *,
    bins: int = 10,
    eps: float = 1e-6,
    binning: str = "quantile",
) -> DataFrame:
    """Population-stability index per feature between the ``base`` and ``current`` periods.

    Bins are cut at the base period's quantiles (the default: a long-tailed feature keeps its bins
    filled) or, with ``equal_width``, are ``bins`` equal ranges over the feature's [min, max] across
    both periods; NULL has a bin of its own. PSI = Σ (p_cur − p_base)·ln((p_cur + eps)/(p_base + eps)). One unpivot,
    one grouped count per (feature, value) that both the per-feature ranges (one row per feature,
    broadcast) and the per-bin sums read."""
    cols = list(feature_cols)
    typed = features.filter(F.col(split_col).isin(base, current)).select(
        split_col, *[F.col(c).cast("double").alias(c) for c in cols]
    )
    if binning == "quantile":
        return _psi_from_bins(_quantile_bins(typed, split_col, base, cols, bins), split_col, base, current, eps)
    if binning != "equal_width":
        raise ValueError(f"unknown binning {binning!r}")
    long = typed.unpivot([split_col], cols, "feature", "value")
    # one pass over the features: counts per (feature, value, period), combined map-side; the
    # ranges and the binning both read this (its exchange is reused), not the features again
    per_value = long.groupBy("feature", "value").agg(
        F.count_if(F.col(split_col) == base).alias("n_base"), F.count_if(F.col(split_col) == current).alias("n_cur")
    )
    ranges = per_value.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.col("hi") - F.col("lo")
    bin_ = (
        F.when(F.col("value").isNull(), F.lit(-1))
        .when(width <= 0, F.lit(0))
        .otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / width * F.lit(bins)), F.lit(bins - 1)))
        .cast("int")
    )
    binned = per_value.join(F.broadcast(ranges), "feature").withColumn("bin", bin_)
    counts = binned.groupBy("feature", "bin").agg(F.sum("n_base").alias("n_base"), F.sum("n_cur").alias("n_cur"))
    return _psi(counts, eps)


def _psi(counts: DataFrame, eps: float) -> DataFrame:
    """PSI per feature from per-(feature, bin) counts ``n_base``, ``n_cur``."""
    totals = counts.groupBy("feature").agg(F.sum("n_base").alias("t_base"), F.sum("n_cur").alias("t_cur"))
    j = counts.join(totals, "feature")
    pb = F.try_divide(F.col("n_base").cast("double"), F.col("t_base"))
    pc = F.try_divide(F.col("n_cur").cast("double"), F.col("t_cur"))
    term = (pc - pb) * F.log((pc + F.lit(eps)) / (pb + F.lit(eps)))
    return j.groupBy("feature").agg(
        F.sum(term).alias("psi"),
        F.sum("n_base").cast("bigint").alias("n_base"),
        F.sum("n_cur").cast("bigint").alias("n_cur"),
    )


def _quantile_bins(typed: DataFrame, split_col: str, base: str, cols: list[str], bins: int) -> DataFrame:
    """Per-row bin index of every feature, with edges at the base period's approximate quantiles
    (computed once: features x bins numbers) and one multi-column ``Bucketizer`` pass. NULL gets
    the extra bucket ``bins`` (kept, not dropped)."""
    qs = [i / bins for i in range(1, bins)]
    row = typed.filter(F.col(split_col) == base).agg(
        *[F.percentile_approx(c, qs, 10000).alias(c) for c in cols]
    ).first()
    splits = []
    for c in cols:
        inner = sorted({e for e in (row[c] or []) if e is not None})
        splits.append([float("-inf"), *inner, float("inf")] if inner else [float("-inf"), 0.0, float("inf")])
    nan_filled = typed.select(split_col, *[F.coalesce(F.col(c), F.lit(float("nan"))).alias(c) for c in cols])
    bucketed = Bucketizer(
        splitsArray=splits, inputCols=cols, outputCols=[f"_b_{c}" for c in cols], handleInvalid="keep"
    ).transform(nan_filled)
    return bucketed.select(split_col, *[F.col(f"_b_{c}").cast("int").alias(c) for c in cols])


def _psi_from_bins(binned: DataFrame, split_col: str, base: str, current: str, eps: float) -> DataFrame:
    long = binned.unpivot([split_col], list(binned.columns[1:]), "feature", "bin")
    counts = long.groupBy("feature", "bin").agg(
        F.count_if(F.col(split_col) == base).alias("n_base"), F.count_if(F.col(split_col) == current).alias("n_cur")
    )
    return _psi(counts, eps)


def feature_summary(
    features: DataFrame, by: str = "data_partition", feature_cols: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """L9 companion: per period and feature, count, NULL count, mean, sample standard deviation,
    min and max — one unpivot and one grouped aggregate."""
    cols = list(feature_cols)
    long = features.select(by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [by], cols, "feature", "value"
    )
    return long.groupBy(by, "feature").agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
