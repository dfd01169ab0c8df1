"""An extension: incremental ingest of JSON lines with exact deduplication, as a Structured Streaming query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as t


def document_stream(spark: SparkSession, path: str, schema: str = "id string, text string, publisher string, at timestamp", files_per_batch: int = 100) -> DataFrame:
    """New JSON-lines files of a folder, with word count and text identity."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    return rows.withColumns({"whitespace_words": t.word_count(F.coalesce("text", F.lit(""))), "digest": t.identity_hash(F.col("text"))})


def first_of_each_text(rows: DataFrame, within: str = "7 days", at: str = "at") -> DataFrame:
    """Each text once within the watermark; the state is bounded by the texts of that time."""
    return rows.withWatermark(at, within).dropDuplicatesWithinWatermark(["digest"])


def windowed_counts(rows: DataFrame, window: str = "1 hour", late: str = "1 hour", at: str = "at", by: str = "publisher") -> DataFrame:
    return rows.withWatermark(at, late).groupBy(F.window(at, window), by).agg(F.count("*").alias("documents"), F.sum("whitespace_words").alias("words"))


def start(rows: DataFrame, path: str, checkpoint: str, reason: Column | None = None, once: bool = True) -> StreamingQuery:
    """Appends what no rule rejects to a Parquet folder, exactly once a batch."""
    kept = rows if reason is None else rows.where(reason.isNull())
    writer = kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(availableNow=True) if once else writer).start()
