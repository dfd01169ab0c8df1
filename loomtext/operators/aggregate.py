"""Profiles and summaries: one aggregate pass each, with map-side combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.urls import host


def group_counts(rows: DataFrame, by: Sequence[str], words: str = "whitespace_words") -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("records"), F.sum(words).alias("words"))


def grouping_sets(rows: DataFrame, fields: Sequence[str], words: str = "whitespace_words") -> DataFrame:
    """(field, value, passages, words) for each field on its own, from one pass."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return rows.select(F.inline(each), F.col(words).alias("_words")).groupBy("field", "value").agg(F.count("*").alias("passages"), F.sum("_words").alias("words"))


def histogram(rows: DataFrame, by: str, field: str) -> DataFrame:
    """(by, histogram map<value, count>)."""
    counts = rows.groupBy(by, F.coalesce(F.col(field).cast("string"), F.lit("None")).alias("value")).count()
    return counts.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "count")))).alias(field))


def summarize(rows: DataFrame, by: str = "dataset") -> DataFrame:
    """Records, words, distinct documents, ambiguous records and the authorship, engine and split histograms of each dataset."""
    base = rows.groupBy(by).agg(
        F.count("*").alias("records"), F.sum("whitespace_words").alias("whitespace_words"), F.count_distinct("document_group").alias("documents"), F.count_if("ambiguous_text").alias("ambiguous_text_records")
    )
    for field in ("authorship", "engine", "split"):
        base = base.join(histogram(rows, by, field), by)
    return base


def profile(rows: DataFrame, text: str = "text", limits: Sequence[int] = (100, 400, 1000)) -> DataFrame:
    """One row: rows, nulls, words, bytes and the rows of at least so many words."""
    words = t.word_count(F.coalesce(text, F.lit("")))
    return rows.select(F.col(text).alias("text"), words.alias("w")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("text").isNull()).alias("null_texts"), F.sum("w").alias("words"), F.sum(F.octet_length("text")).alias("bytes"), *[F.count_if(F.col("w") >= n).alias(f"rows_{n}_words") for n in limits]
    )


def field_coverage(rows: DataFrame) -> DataFrame:
    """(field, present) of every column."""
    counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("present")) for c in rows.columns])))


def most_common(rows: DataFrame, value: Column, k: int = 30) -> DataFrame:
    """The k most frequent values; ties by value."""
    return rows.groupBy(value.alias("value")).count().where("value IS NOT NULL").orderBy(F.desc("count"), "value").limit(k)


def common_hosts(rows: DataFrame, url: str = "url", k: int = 30) -> DataFrame:
    return most_common(rows, host(F.col(url)), k)


def tail_line_frequencies(rows: DataFrame, id: str = "id", publisher: str = "publisher", text: str = "text", minimum: int = 1) -> DataFrame:
    """(publisher, line, document_frequency, example_id): how many documents of a publisher end with a line."""
    lines = rows.select(F.col(id).alias("id"), F.col(publisher).alias("publisher"), F.explode(t.tail_lines(F.col(text))).alias("line"))
    counts = lines.groupBy("publisher", "line").agg(F.count("*").alias("document_frequency"), F.min("id").alias("example_id"))
    return counts.where(F.col("document_frequency") >= minimum)


def length_quantiles(rows: DataFrame, words: str = "whitespace_words") -> DataFrame:
    """Least, upper median and greatest length. Lengths are counted first, so the order statistics are read off a histogram."""
    counts = rows.groupBy(F.col(words).alias("w")).count()
    whole = Window.partitionBy(F.lit(0))  # one row for each distinct length
    marked = counts.select("w", F.sum("count").over(whole).alias("n"), F.sum("count").over(whole.orderBy("w")).alias("upto"))
    middle = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("w")))
    return marked.agg(F.min("w").alias("shortest"), middle.alias("upper_median"), F.max("w").alias("longest"))


def review_sample(rows: DataFrame, strata: Sequence[str], id: str, k: int = 8, seed: str = "review:") -> DataFrame:
    """The k rows of least hash of each stratum (k bounds the result), with `review_rank`."""
    key = t.text_hash(F.concat(F.lit(seed), F.col(id).cast("string")))
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(key, F.col(id)))
    return rows.withColumn("review_rank", rank).where(F.col("review_rank") <= k)


def annotate_licenses(rows: DataFrame, observations: Mapping[tuple[str, str], Mapping[str, str]]) -> DataFrame:
    """Rows with license_review_status and publisher_license_observation of their (dataset, publisher): a policy, so a literal join."""
    found = F.lit(None).cast("map<string,string>")
    for (dataset, publisher), seen in sorted(observations.items()):
        note = F.create_map(*[F.lit(x) for pair in sorted(seen.items()) for x in pair])
        found = F.when((F.col("dataset") == dataset) & (F.col("publisher") == publisher), note).otherwise(found)
    return rows.withColumns({"publisher_license_observation": found, "license_review_status": found["status"]})
