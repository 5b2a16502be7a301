"""Raw CSV(.gz) event files (S1, S3) and the staging step that makes the reject split stable.

Why stage: Spark's CSV reader parses only the columns a query needs, so whether a line is flagged
in ``_corrupt_record`` depends on the projection (a bad value in a column nobody reads is not
seen). ``stage_raw`` writes every parsed column plus the corrupt flag once, as Parquet, to the
shared scratch folder; every later split or count reads that copy and gets the same answer.
The write is also the lineage cut: a lost executor recomputes from the staged files, not from
the gzip sources (a .gz file is one unsplittable read task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.ingest import parse_event_time
from clickweave.session import stage
from clickweave.sources.schema import CORRUPT_COLUMN, RAW_EVENT_SCHEMA


def read_raw_events(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema=RAW_EVENT_SCHEMA,
    with_batch: bool = True,
    stream: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """S1 + S3: read one or many CSV(.gz) files with a header, the fixed schema and PERMISSIVE
    mode; malformed lines are kept with their text in ``_corrupt_record``. All files are read by
    one job; ``batch`` is each file's name with ``.`` replaced by ``_`` (the reference's batch tag),
    ``batch_source`` a digest of its full path, so that files of one name in two folders differ.
    ``stream``: a stream of the files under one folder, also of those that are added later, at most
    ``max_files`` in a micro-batch."""
    if stream:
        if not isinstance(paths, str):
            raise ValueError("a stream reads one folder")
        reader = spark.readStream.option("recursiveFileLookup", "true")
        reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    else:
        reader, paths = spark.read, [paths] if isinstance(paths, str) else list(paths)
    df = (
        reader.format("csv")
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .schema(schema)
        .load(paths)
    )
    if with_batch:
        source = F.substring(F.md5(F.col("_metadata.file_path")), 1, 12)
        df = df.withColumns({"batch": F.regexp_replace(F.col("_metadata.file_name"), r"\.", "_"), "batch_source": source})
    return df


def with_source_event_id(df: DataFrame) -> DataFrame:
    """A content id for raw rows (``src_event_id``): xxhash64 over every raw field, without the
    batch, so that one line delivered in two files has one id. Used as an ordering tie-breaker and
    in the surrogate key, by which repeated lines are recognised."""
    cols = [c for c in df.columns if c not in (CORRUPT_COLUMN, "batch", "batch_source")]
    return df.withColumn("src_event_id", F.xxhash64(*[F.col(c) for c in cols]))


def stage_raw(spark: SparkSession, raw: DataFrame, path: str | None = None) -> DataFrame:
    """Parse every column once (event time too: ``event_timestamp`` next to the text), add
    ``src_event_id``, write to Parquet under the shared scratch folder (or ``path``) and return a
    reader over the staged copy."""
    parsed = with_source_event_id(raw).withColumn("event_time_text", F.col("event_time"))
    parsed = parse_event_time(parsed)
    if path is None:
        return stage(spark, parsed, "staged-raw")
    parsed.write.mode("overwrite").parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)
