"""Partitions: hash buckets, allocation of whole groups by rank, and priority inside connected groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from .graph import component_edges, connected_components
from .records import binary_label

PRIORITY = {"train": 0, "validation": 1, "test": 2}


def hash_bucket(key: Column, digits: int = 16) -> Column:
    """The first hex digits of the key's SHA-256, as an unsigned number, modulo 100."""
    head = F.conv(F.substring(F.sha2(key, 256), 1, digits), 16, 10)
    return (head.cast("decimal(20,0)") % 100).cast("int")


def split_of(bucket: Column, train: int = 98, validation: int = 1) -> Column:
    return F.when(bucket < train, "train").when(bucket < train + validation, "validation").otherwise("test")


def test_first_split(bucket: Column, test: int = 10, validation: int = 10) -> Column:
    return F.when(bucket < test, "test").when(bucket < test + validation, "validation").otherwise("train")


def priority(split: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])[split]


def highest_split(split: Column) -> Column:
    """Aggregate: the split of highest priority."""
    return F.max_by(split, priority(split))


#: Leading hex digits of the hash by which a rank is cut into ranges.
_RANGE_DIGITS = 3


def _ranked(groups: DataFrame, key: Column, by: Sequence[str] = ()) -> DataFrame:
    """Groups with `_rank` (by hash of the key) and `_n`, per stratum, in two levels: the rank inside a range of hashes, and the
    ranges' counts (16^3 a stratum), so no task ranks a whole stratum."""
    hashed = groups.withColumns({"_hash": F.sha2(key, 256), "_key": key})
    hashed = hashed.withColumn("_range", F.substring("_hash", 1, _RANGE_DIGITS))
    strata = list(by)
    counts = hashed.groupBy(*strata, "_range").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*(strata or [F.lit(0)]))
    before = F.coalesce(F.sum("_c").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumns({"_before": before, "_n": F.sum("_c").over(whole)}).drop("_c")
    inner = F.row_number().over(Window.partitionBy(*strata, "_range").orderBy("_hash", "_key"))
    return hashed.withColumn("_inner", inner).join(offsets, [*strata, "_range"]).withColumn("_rank", F.col("_before") + F.col("_inner"))


def rank_split(groups: DataFrame, group: str, seed: str, share: float = 0.1) -> DataFrame:
    """Whole groups by hash rank: the first `share` (rounded up, at most half) test, as many validation, the rest train.
    """
    ranked = _ranked(groups.select(group).distinct(), F.concat(F.lit(seed), F.col(group)))
    reserve = F.least(F.ceil(F.col("_n") * share), F.floor((F.col("_n") - 1) / 2))
    split = F.when(F.col("_rank") <= reserve, "test").when(F.col("_rank") <= 2 * reserve, "validation").otherwise("train")
    return ranked.select(group, split.alias("split"))


def stratified_split(groups: DataFrame, group: str, stratum: str, seed: str, share: float = 0.15) -> DataFrame:
    """Groups by hash rank inside a stratum: `share` (half to even, at least one) test and validation each, if it has three."""
    ranked = _ranked(groups.select(group, stratum).distinct(), F.concat(F.lit(seed), F.col(group)), [stratum])
    held = F.when(F.col("_n") >= 3, F.greatest(F.lit(1), F.bround(F.col("_n") * share).cast("int"))).otherwise(0)
    split = F.when(F.col("_rank") <= held, "test").when(F.col("_rank") <= 2 * held, "validation").otherwise("train")
    return ranked.select(group, stratum, split.alias("split"))


def author_split(books: DataFrame, author: str, seed: str) -> DataFrame:
    """All books of an author together: the first author by hash test, the second validation, the others train."""
    ranked = _ranked(books.select(author).distinct(), F.concat(F.lit(seed), F.col(author)))
    return ranked.select(author, F.when(F.col("_rank") == 1, "test").when(F.col("_rank") == 2, "validation").otherwise("train").alias("split"))


def assign_splits(rows: DataFrame, seed: str = "pilot-v1:") -> DataFrame:
    """Records with split_group, split (80/10/10), ambiguous_text and binary_target.

    Documents that share a normalized text, or a normalized source text in one language, are one group; a repeated id
    fails the job. Texts with both labels get no target.
    """
    repeated = rows.groupBy("id").count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"repeated record id: {repeated.first()[0]}")
    marked = rows.withColumns({"_target": t.identity_hash(F.col("text")), "_source": t.identity_hash(F.col("source_text"))})
    doc = F.col("document_group")
    targets = component_edges(marked, doc, F.concat(F.lit("target:en:"), F.col("_target")))
    sources = component_edges(marked.where("source_text <> ''"), doc, F.concat(F.lit("source:"), F.col("source_language"), F.lit(":"), F.col("_source")))
    groups = connected_components(targets.unionByName(sources), nodes=marked.select("document_group"))
    groups = groups.select(F.col("node").alias("document_group"), F.col("component").alias("split_group"))
    label = binary_label(F.col("authorship"))
    kinds = marked.where(label.isNotNull()).groupBy("_target").agg((F.min(label) != F.max(label)).alias("ambiguous_text"))
    out = marked.drop("split_group", "split", "ambiguous_text", "binary_target").join(groups, "document_group").join(kinds, "_target", "left")
    out = out.withColumn("ambiguous_text", F.coalesce("ambiguous_text", F.lit(False)))
    split = split_of(hash_bucket(F.concat(F.lit(seed), F.col("split_group"))), 80, 10)
    return out.withColumns({"split": split, "binary_target": F.when(~F.col("ambiguous_text"), label)}).drop("_target", "_source")


def regroup(rows: DataFrame, edges: DataFrame, group: str = "split_group", split: str = "split") -> DataFrame:
    """Rows whose groups are joined by edges (src, dst); a joined group takes its highest split. Old values stay as upstream_*."""
    joined = connected_components(edges, nodes=rows.select(group)).select(F.col("node").alias(group), F.col("component").alias("_component"))
    moved = rows.join(joined, group)
    best = moved.groupBy("_component").agg(highest_split(F.col(split)).alias("_split"))
    moved = moved.join(best, "_component")
    return moved.withColumns({f"upstream_{group}": F.col(group), f"upstream_{split}": F.col(split)}).withColumns({group: F.col("_component"), split: F.col("_split")}).drop("_component", "_split")


def regroup_segments_and_spans(records: DataFrame, spans: DataFrame, minimum_words: int = 400) -> DataFrame:
    """Segments with a documented label and long spans, grouped again by their split_group, with example_granularity."""
    rows = records.where("authorship <> 'human_candidate'").unionByName(spans.where(t.word_count(F.col("text")) >= minimum_words), allowMissingColumns=True)
    granularity = F.when(F.col("id").startswith("span/"), "contiguous_span").otherwise("segment")
    return assign_splits(rows.withColumns({"document_group": F.col("split_group"), "example_granularity": granularity}))


def assign_post_groups(rows: DataFrame, stratified: str = "tweepfake", paired: str = "unmasking") -> DataFrame:
    """Accounts, pairs and equal texts together (partition_unit, normalized_text_sha256), then a split for each group.

    Groups with rows of the stratified dataset are allocated by rank inside the stratum of their labels; rows of the paired
    dataset bring their upstream split; a group takes the highest of its candidates.
    """
    edges = component_edges(rows, F.col("partition_unit"), F.col("normalized_text_sha256"))
    units = connected_components(edges, nodes=rows.select("partition_unit")).select(F.col("node").alias("partition_unit"), F.col("component").alias("_group"))
    rows = rows.join(units, "partition_unit")
    own = rows.where(F.col("dataset") == stratified).groupBy("_group").agg(F.array_join(F.array_sort(F.collect_set("binary_target").cast("array<string>")), ",").alias("_stratum"))
    allocated = stratified_split(own, "_group", "_stratum", "twitter-v1:").select("_group", F.col("split").alias("_candidate"))
    brought = rows.where(F.col("dataset") == paired).select("_group", F.col("upstream_split").alias("_candidate"))
    final = allocated.unionByName(brought).groupBy("_group").agg(highest_split(F.col("_candidate")).alias("split"))
    return rows.drop("split").join(final, "_group", "left").withColumn("split_group", F.sha2(F.concat(F.lit("twitter-v1-group:"), F.col("_group")), 256)).drop("_group")
