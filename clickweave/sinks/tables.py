"""Parquet table sinks: create-if-absent (K1), append (K2), quarantine (K3), keyed upsert on disk
(K4), clustered layout (K7), materialisation per layer (K8), silver layout (K9).

Tables are Parquet directories; a catalog name can be attached (``ensure_table``) for SQL users.
Partition replacement uses the per-write ``partitionOverwriteMode=dynamic`` option, so only the
partitions present in the written data are replaced and no session setting is changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.incremental import latest_per_key, null_safe, upsert
from clickweave.operators.sessions import with_year_month
from clickweave.session import hadoop_path, release, stage

DEFAULT_NAMESPACE = "default"
#: Directory name of a NULL partition value (Spark's and Hive's).
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
#: Identity of an ingested file: its name as a tag, and a digest of its full path.
BATCH_COLUMNS = ("batch", "batch_source")


def qualified(name: str, namespace: str = DEFAULT_NAMESPACE) -> str:
    """An unqualified table name gets the default namespace (as the reference's catalog prefix)."""
    return name if "." in name else f"{namespace}.{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return fs.exists(hpath)


def ensure_table(
    spark: SparkSession, name: str, df: DataFrame, path: str, partition_cols: Sequence[str] = ("event_date",)
) -> str:
    """K1: create the catalog table ``name`` over ``path`` with ``df``'s schema and partitioning if
    it does not exist yet; returns the qualified name. (``days(ts)`` partition transforms need a
    table format jar; the built-in equivalent is a derived ``event_date`` column.)"""
    qname = qualified(name)
    if not spark.catalog.tableExists(qname):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        parts = ", ".join(f"`{c}`" for c in partition_cols)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qname} ({cols}) USING parquet"
            + (f" PARTITIONED BY ({parts})" if parts else "")
            + f" LOCATION '{path}'"
        )
    return qname


def refresh(spark: SparkSession, name: str | None) -> None:
    if name:
        spark.catalog.recoverPartitions(qualified(name))
        spark.catalog.refreshTable(qualified(name))


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ("event_date",), *, name: str | None = None) -> None:
    """K2: append rows (not idempotent: a re-run appends again)."""
    df.write.mode("append").partitionBy(*partition_cols).parquet(path)
    refresh(df.sparkSession, name)


def replace_partitions(
    df: DataFrame, path: str, partition_cols: Sequence[str], *, name: str | None = None
) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite); re-running the same
    batch gives the same table."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    refresh(df.sparkSession, name)


def partition_values(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> DataFrame | None:
    """The partitions of the table at ``path`` as rows of strings, from directory names alone; None
    if there is no table."""
    fs, hpath = hadoop_path(spark, path)
    if not fs.exists(hpath):
        return None
    _, pattern = hadoop_path(spark, "/".join([path, *[f"{c}=*" for c in partition_cols]]))
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    rows = []
    for status in fs.globStatus(pattern):
        names = status.getPath().toString().split("/")[-len(partition_cols) :]
        values = [n.split("=", 1)[1] for n in names]
        rows.append([None if v == HIVE_NULL else unescape(v) for v in values])
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in partition_cols))


def drop_partitions(spark: SparkSession, path: str, gone: DataFrame, partition_cols: Sequence[str]) -> int:
    """Delete the partition directories whose values are the rows of ``gone`` (as few rows as
    partitions); returns how many there were."""
    fs, _ = hadoop_path(spark, path)
    n = 0
    for row in gone.select(*[F.col(c).cast("string") for c in partition_cols]).distinct().toLocalIterator():
        jvm = spark.sparkContext._jvm
        names = [
            f"{c}={jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(v) if v else HIVE_NULL}"
            for c, v in zip(partition_cols, row, strict=True)
        ]
        _, part = hadoop_path(spark, "/".join([path, *names]))
        n += bool(fs.delete(part, True))
    return n


def swap_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], touched: DataFrame, **layout) -> None:
    """Make the ``touched`` partitions (rows of partition values) hold exactly the rows of ``df``: the
    partitions of ``df`` are replaced, touched ones without rows are removed. Running it again
    gives the same table. ``layout``: arguments of ``write_clustered``."""
    parts = list(partition_cols)
    if layout:
        write_clustered(df, path, parts, dynamic=True, **layout)
    else:
        replace_partitions(df, path, parts)
    new = df.select(*parts).distinct()
    empty = touched.select(*parts).distinct().alias("t").join(new.alias("n"), null_safe("t", "n", parts), "left_anti")
    drop_partitions(df.sparkSession, path, empty, parts)


def write_rejects(
    rejects: DataFrame, dlq_dir: str, batch_tag: str | None = None, *, batches: DataFrame | None = None
) -> None:
    """K3: quarantine rows to ``dlq_dir/batch=<tag>/`` as snappy Parquet. Without a ``batch_tag`` the
    rows' own batch columns partition the output (one write for all files). With ``batches`` (the
    batch columns of everything ingested) those batches' earlier rejects are replaced, also by
    nothing; without, rows are appended."""
    out = rejects if batch_tag is None else rejects.withColumn("batch", F.lit(batch_tag))
    parts = [c for c in BATCH_COLUMNS if c in out.columns]
    if batches is not None:
        swap_partitions(out, dlq_dir, parts, batches)
        return
    out.write.mode("append").option("compression", "snappy").partitionBy(*parts).parquet(dlq_dir)


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str | Sequence[str],
    partition_cols: Sequence[str],
    *,
    name: str | None = None,
) -> None:
    """K4 on disk: merge ``updates`` into the Parquet table at ``path`` by ``key`` (one row per key
    stays, NULL keys and NULL partitions included).

    Only partitions touched by the updates are read and rewritten. The merged partitions are first
    written to the shared scratch folder (the lineage cut: the target's files are about to be
    replaced, so the merge must not read them lazily while writing), then swapped in with a dynamic
    partition overwrite. Assumes a key never changes partition (true for event-time partitions)."""
    parts, keys = list(partition_cols), [key] if isinstance(key, str) else list(key)
    if not _exists(spark, path):
        replace_partitions(latest_per_key(updates, keys), path, parts, name=name)
        return
    merged = stage(spark, merged_partitions(spark, path, updates, keys, parts), "upsert")
    replace_partitions(merged, path, parts, name=name)
    release(spark, merged)


def upsert_files(
    spark: SparkSession, path: str, updates: DataFrame, key: str | Sequence[str], partition_cols: Sequence[str], *, name: str | None = None
) -> int:
    """K4 on disk, file by file: like ``upsert_table``, but of the touched partitions only the files that hold
    an updated key are rewritten; the others keep their names. Returns how many files were replaced.

    The files are found by reading the key column alone (row groups outside the updates' range of keys
    are skipped). Their rows, merged, and the new keys are staged, appended as new files, and the old
    files deleted. A run that stops in between leaves rows twice; running it again finds both files by
    their keys and leaves each row once. A key must not change its partition."""
    parts, keys = list(partition_cols), [key] if isinstance(key, str) else list(key)
    one = stage(spark, latest_per_key(updates, keys), "updates")
    if not _exists(spark, path):
        replace_partitions(one, path, parts, name=name)
        release(spark, one)
        return 0
    target = spark.read.option("mergeSchema", "true").parquet(path)
    bounds = one.agg(*[f(k).alias(f"{i}_{n}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    near = F.lit(True)
    for i, k in enumerate(keys):  # NULL keys are in no range
        if bounds[f"{i}_lo"] is not None:
            near = near & (F.col(k).between(bounds[f"{i}_lo"], bounds[f"{i}_hi"]) | F.col(k).isNull())
    held = target.filter(near).select(*keys, *parts, F.col("_metadata.file_path").alias("_file")).alias("t")
    held = held.join(one.select(*parts).distinct().alias("p"), null_safe("t", "p", parts), "left_semi")
    files = held.alias("t").join(one.select(*keys).alias("u"), null_safe("t", "u", keys), "left_semi").select("_file").distinct()
    files = stage(spark, files, "touched-files")  # a row a file
    old = target.withColumn("_file", F.col("_metadata.file_path")).join(files, "_file", "left_semi").drop("_file")
    merged = stage(spark, upsert(old.dropDuplicates(keys), one, keys), "upsert")
    merged.write.mode("append").partitionBy(*parts).parquet(path)
    n = 0
    for row in files.toLocalIterator():
        fs, gone = hadoop_path(spark, row["_file"])
        n += bool(fs.delete(gone, False))
    release(spark, one, files, merged)
    refresh(spark, name)
    return n


def merged_partitions(
    spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str], partition_cols: Sequence[str]
) -> DataFrame:
    """The touched partitions of the table at ``path`` after ``updates``."""
    target = spark.read.option("mergeSchema", "true").parquet(path)
    touched = updates.select(*partition_cols).distinct()  # a row a partition; shuffled, each would be one task's
    affected = target.alias("t").join(F.broadcast(touched).alias("p"), null_safe("t", "p", partition_cols), "left_semi")
    return upsert(affected, updates, key)


def write_clustered(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    cluster_cols: Sequence[str],
    *,
    num_partitions: int | None = None,
    mode: str = "overwrite",
    dynamic: bool = False,
    checks=None,
) -> None:
    """K7: clustered layout: directory partitions on the low-cardinality column(s), rows range-
    partitioned and sorted inside each file on the clustering columns (tight min/max stats per
    file, so Parquet row-group skipping works for the clustered predicates). ``dynamic`` replaces
    only the partitions that ``df`` has rows of. ``checks`` (``operators.quality.WriteChecks``)
    count their rules' violations in the write itself. A deterministic row
    hash ends the range key, so one hot (date, type) value is spread over several range
    partitions instead of landing in one task; files stay ordered by the clustering columns."""
    keys = list(partition_cols) + [c for c in cluster_cols if c not in partition_cols]
    spread = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_spread")
    with_spread = df.withColumn("_spread", spread)
    range_keys = [*keys, "_spread"]
    ranged = (
        with_spread.repartitionByRange(num_partitions, *range_keys)
        if num_partitions
        else with_spread.repartitionByRange(*range_keys)
    )
    out = ranged.sortWithinPartitions(*keys).drop("_spread")
    out = checks.watch(out) if checks is not None else out
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.partitionBy(*partition_cols).parquet(path)


def materialize(df: DataFrame, how: str, *, name: str | None = None, path: str | None = None,
                partition_cols: Sequence[str] = ()) -> DataFrame:
    """K8: ``view`` (temp view), ``ephemeral`` (the DataFrame itself, inlined by Catalyst) or
    ``table`` (written to ``path`` and read back)."""
    if how == "ephemeral":
        return df
    if how == "view":
        if not name:
            raise ValueError("a view needs a name")
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if how == "table":
        if not path:
            raise ValueError("a table needs a path")
        df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
        return df.sparkSession.read.parquet(path)
    raise ValueError(f"unknown materialisation {how!r}")


def write_silver(silver: DataFrame, path: str, *, mode: str = "overwrite", dealt: bool = False) -> None:
    """K9: silver events partitioned by ``event_year``, ``event_month``. ``overwrite`` replaces the
    whole table: months that the new data lacks are gone. A row hash deals each month over the tasks of
    a shuffle, of which adaptive execution merges small ones; a month is never one task's. ``dealt``: a
    shuffle on something finer than a month, such as ``sessionize``'s on user and chunk, has just dealt
    the rows, and they are written from there without a second one."""
    out = with_year_month(silver)
    if not dealt:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in silver.columns]).alias("_spread")
        out = out.select("*", spread).repartition("event_year", "event_month", "_spread").drop("_spread")
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy("event_year", "event_month").parquet(path)


def write_predictions(scored: DataFrame, path: str, partition_cols: Sequence[str] = ("data_partition",)) -> None:
    """The scored-session table (``gold_session_predictions``), partitions replaced per run."""
    replace_partitions(scored, path, [c for c in partition_cols if c in scored.columns])


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned table with ``df`` even when ``df`` is computed from that same
    table (merged dimensions, advanced state): write to the shared scratch folder first, then
    replace from the staged copy."""
    staged = stage(spark, df, "replace")
    staged.write.mode("overwrite").parquet(path)
    release(spark, staged)
