"""Incremental file ingest (S1, P1-P3, K2, K3 on a stream): CSV files of a folder, taken as they arrive.

The file source remembers in its checkpoint which files it has taken; every micro-batch goes through the
same steps as the batch ingest (staged parse, reject split) and replaces, in the table and the quarantine,
the partitions of its files. A file is a partition of its own (name and digest of the path), so a
micro-batch that is replayed after a failure, or all files read again after the checkpoint is lost, leave
the table as it was. Files are taken to be complete when they appear and not to change afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave.operators.ingest import rebalance, split_rejects
from clickweave.plans.bronze import BRONZE_PARTITIONS
from clickweave.session import release
from clickweave.sinks import tables
from clickweave.sources.csv_events import read_raw_events, stage_raw


def write_batch(raw: DataFrame, table_path: str, dlq_dir: str | None = None, *, extra_rules: dict | None = None) -> None:
    """Raw rows of some files into the bronze table and the quarantine: whatever both held of these files'
    days and batches is replaced."""
    spark = raw.sparkSession
    staged = stage_raw(spark, raw)
    clean, rejects = split_rejects(staged, extra_rules=extra_rules)
    clean = clean.drop("event_time_text").withColumn("event_date", F.to_date("event_timestamp"))
    tables.replace_partitions(rebalance(clean, by=("event_date",)), table_path, BRONZE_PARTITIONS)
    if dlq_dir:
        tables.replace_partitions(rejects.drop("event_timestamp"), dlq_dir, tables.BATCH_COLUMNS)
    release(spark, staged)


def start_ingest(
    spark: SparkSession,
    folder: str,
    table_path: str,
    checkpoint_path: str,
    *,
    dlq_dir: str | None = None,
    extra_rules: dict | None = None,
    max_files: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """A query that takes the files under ``folder`` not taken yet, at most ``max_files`` in a micro-batch, and
    stops (``available_now``) or goes on waiting for more."""
    raw = read_raw_events(spark, folder, stream=True, max_files=max_files)
    writer = (
        raw.writeStream.foreachBatch(lambda batch, _: write_batch(batch, table_path, dlq_dir, extra_rules=extra_rules))
        .option("checkpointLocation", checkpoint_path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
