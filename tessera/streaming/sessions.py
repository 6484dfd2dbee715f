"""Streaming counterparts of batch operators; an extension, as the batch engine has no unbounded tables.

Gap clusters become session windows, first-wins deduplication becomes watermarked deduplication, and grouped
counts become windowed aggregates; late rows beyond the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def session_clusters(events: DataFrame, group: Sequence[str], at: str, gap: str, late: str) -> DataFrame:
    """(group, start, end, rows) of runs whose neighbours are less than ``gap`` apart."""
    sessions = events.withWatermark(at, late).groupBy(*group, F.session_window(at, gap).alias("w"))
    return sessions.agg(F.count("*").alias("rows")).select(*group, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "rows")


def windowed_counts(events: DataFrame, group: Sequence[str], at: str, size: str, slide: str | None, late: str) -> DataFrame:
    """(group, start, end, rows) of tumbling or sliding windows."""
    window = F.window(at, size, slide) if slide else F.window(at, size)
    counted = events.withWatermark(at, late).groupBy(*group, window.alias("w")).agg(F.count("*").alias("rows"))
    return counted.select(*group, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "rows")


def first_seen(events: DataFrame, key: Sequence[str], at: str, late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(list(key))


def append_batches(stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], tile: str) -> StreamingQuery:
    """Appends each micro-batch's new keys to a tiled store; repeats of a batch add nothing."""
    from tessera.sources.tables import append_fragments

    def write(batch: DataFrame, _: int) -> None:
        append_fragments(batch, path, key, tile)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
