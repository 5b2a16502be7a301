"""Bronze ingest job: raw CSV files -> staged parse -> reject/clean split -> quarantine + table.

One Spark job reads every source file (not a per-file loop); a batch is a file: its name as tag and
a digest of its full path. The clean side is partitioned by ``event_date`` and batch, so
re-ingesting a file replaces what the table holds of it (D7).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.incremental import null_safe
from clickweave.operators.ingest import rebalance, split_rejects
from clickweave.session import release
from clickweave.sinks import tables
from clickweave.sources.csv_events import read_raw_events, stage_raw

BRONZE_PARTITIONS = ("event_date", *tables.BATCH_COLUMNS)


@dataclass
class BronzeResult:
    """Lazy clean and reject rows over the staged copy, and the batches (files) it holds."""

    clean: DataFrame
    rejects: DataFrame
    batches: DataFrame
    staged: DataFrame

    def release(self) -> None:
        """Delete the staged copy; the frames cannot be read any more."""
        release(self.staged.sparkSession, self.staged)


def bronze_frames(
    spark: SparkSession,
    sources: str | Sequence[str],
    *,
    extra_rules: dict | None = None,
    strict_reference_nulls: bool = False,
    num_partitions: int | None = None,
    staging_path: str | None = None,
) -> BronzeResult:
    """Read, stage and split; returns lazy clean and reject DataFrames over the staged copy.
    Clean rows: raw columns without ``event_time``/``_corrupt_record``, plus ``event_timestamp``
    (UTC wall clock), ``event_date``, ``src_event_id``, ``batch`` and ``batch_source``."""
    staged = stage_raw(spark, read_raw_events(spark, sources), staging_path)
    clean, rejects = split_rejects(staged, extra_rules=extra_rules, strict_reference_nulls=strict_reference_nulls)
    clean = clean.drop("event_time_text").withColumn("event_date", F.to_date("event_timestamp"))
    rejects = rejects.drop("event_timestamp")
    batches = staged.select(*tables.BATCH_COLUMNS).distinct()
    return BronzeResult(rebalance(clean, num_partitions, by=("event_date",)), rejects, batches, staged)


def ingest(
    spark: SparkSession,
    sources: str | Sequence[str],
    table_path: str,
    *,
    table_name: str | None = "bronze_events",
    dlq_dir: str | None = None,
    replace_batches: bool = True,
    **kw,
) -> BronzeResult:
    """The ingest job: optional quarantine write (K3), create-if-absent (K1), then plain append (K2)
    or, by default, replacement of the batches (D7): whatever the table and the quarantine held of
    these files is replaced, also on days that a corrected file no longer has. A batch is a file by
    its full path. Call ``release()`` on the result when its frames are no longer needed."""
    res = bronze_frames(spark, sources, **kw)
    name = tables.ensure_table(spark, table_name, res.clean, table_path, BRONZE_PARTITIONS) if table_name else None
    if not replace_batches:
        if dlq_dir:
            tables.write_rejects(res.rejects, dlq_dir)
        tables.append(res.clean, table_path, BRONZE_PARTITIONS, name=name)
        return res
    held = tables.partition_values(spark, table_path, BRONZE_PARTITIONS)
    if dlq_dir:
        tables.write_rejects(res.rejects, dlq_dir, batches=res.batches)
    touched = res.clean.select(*BRONZE_PARTITIONS)
    if held is not None:
        on = null_safe("h", "b", tables.BATCH_COLUMNS)
        touched = held.alias("h").join(res.batches.alias("b"), on, "left_semi").select(*[F.col(c) for c in BRONZE_PARTITIONS])
    tables.swap_partitions(res.clean, table_path, BRONZE_PARTITIONS, touched)
    tables.refresh(spark, name)
    return res
