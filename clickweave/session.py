"""Local SparkSession for tests, the bench and the oracle check, and the shared scratch folder.

Library functions never set session configuration; they take the caller's session. Scratch
data (staged CSV, upsert staging, model artifacts in examples) goes under the folder the
cluster names in ``spark.checkpoint.dir``; only a local session made here sets one itself.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def _default_driver_memory(cap_mb: int = 16384) -> str:
    """60 % of physical memory, at most ``cap_mb`` (local mode runs everything in the driver JVM)."""
    try:
        with open("/proc/meminfo") as fh:
            total_kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        return f"{max(1024, min(cap_mb, int(total_kb / 1024 * 0.6)))}m"
    except (OSError, StopIteration, ValueError):
        return "4g"


def local_session(
    cores: int | str = "*",
    *,
    shuffle_partitions: int = 8,
    app: str = "clickweave",
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory or _default_driver_memory())
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {"spark.sql.session.timeZone": "UTC", **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared scratch folder (``spark.checkpoint.dir``), used as it is. When it is
    unset, a cluster session raises instead of falling back to a machine-local folder; only a
    local-mode session (tests, local runs) gets a fresh temporary folder, once."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: name a shared folder (HDFS/S3) for staged tables and checkpoints"
        )
    current = tempfile.mkdtemp(prefix="clickweave-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder for staged intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM for any scheme (s3a, hdfs, file)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: a lineage cut for a batch
    that several steps consume. ``release`` removes it when the job ends."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(spark: SparkSession, *staged: DataFrame | str | None) -> None:
    """Delete staged copies (frames returned by ``stage``, or scratch paths) that no later step
    reads."""
    for item in staged:
        path = item if isinstance(item, str) else getattr(item, "_scratch", None)
        if path:
            fs, jpath = hadoop_path(spark, path)
            fs.delete(jpath, True)
