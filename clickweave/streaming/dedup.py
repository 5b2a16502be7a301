"""Streaming deduplication (P16, W6 on a stream): the first row of each key, with bounded state.

Sources deliver again what they have delivered; ``dropDuplicatesWithinWatermark`` keeps a key for as long as
the watermark needs to pass the first row's time plus ``horizon`` and drops every repetition in between. State is the keys of
``horizon``, whatever the stream's age. Repetitions further apart than ``horizon`` pass (the batch P16 over
the table finds them), rows later than it are dropped and counted in the query's progress.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickweave.functions.columns import utc_instant


def drop_repeats(events: DataFrame, keys: Sequence[str], *, horizon: str, ts_col: str = "event_timestamp") -> DataFrame:
    """The rows of a stream without those whose ``keys`` came before within ``horizon`` of event time."""
    clocked = events.withColumn("_event_time", utc_instant(ts_col)).withWatermark("_event_time", horizon)
    return clocked.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def start_dedup(
    events: DataFrame,
    keys: Sequence[str],
    sink_path: str,
    checkpoint_path: str,
    *,
    horizon: str,
    ts_col: str = "event_timestamp",
    available_now: bool = True,
) -> StreamingQuery:
    """``drop_repeats`` appended to a Parquet sink, whose log makes a replayed micro-batch appear once."""
    writer = (
        drop_repeats(events, keys, horizon=horizon, ts_col=ts_col)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
