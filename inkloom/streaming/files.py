"""Streaming: new text files as they arrive, through the same stateless pipeline; tables updated batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkloom.operators.pack import pack_lines
from inkloom.functions.text import split_lines, strip_u
from inkloom.sources.readers import texts


def text_stream(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """path, modificationTime, content of files as they arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", "true").load(folder)


def packed_stream(found: DataFrame, most: int = 2000) -> DataFrame:
    """path, segment, content, n_chars: each file, in any encoding of readers.texts, is one row, so no state is carried between batches."""
    lines = F.filter(F.transform(split_lines(F.col("text")), strip_u), lambda x: x != "")
    return pack_lines(texts(found).select("path", lines.alias("lines")), ["path"], "lines", most)


def write_batches(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Runs what is there and ends; ``sink`` gets each batch with its number and must be idempotent for it."""
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """window_start, event_type, n, total of events by event time; rows later than ``late`` are dropped by the watermark."""
    w = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
