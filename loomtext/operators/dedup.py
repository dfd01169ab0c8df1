"""Exact deduplication: winners, aliases, label conflicts and first-seen rules.

Winners come from min_by aggregates with map-side combine, so a key of any share of the rows costs one small row a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .graph import component_edges, connected_components
from .splits import hash_bucket, split_of


def keep_first(rows: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The row of least position of each key, by an aggregate with map-side combine: a key of any share of the rows is no hot window."""
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*[f"`{c}`" for c in rows.columns]), position).alias("_best"))
    return best.select("_best.*")


def winners(rows: DataFrame, group: Column, order: Sequence[Column], id: str = "id") -> DataFrame:
    """(group, winner, members, equivalent_ids): the least id by `order`, the count, and all ids in order."""
    return rows.groupBy(group.alias("group")).agg(
        F.min_by(id, F.struct(*order)).alias("winner"), F.count("*").alias("members"), F.array_sort(F.collect_list(id)).alias("equivalent_ids")
    )


def article_groups(rows: DataFrame, seed: str = "news-curation-v1") -> tuple[DataFrame, DataFrame]:
    """(retained, duplicates) of rows with id, text, canonical_url, license and whitespace_words.

    Rows that share a normalized text or a canonical URL, also by way of others, are one article. The copy with a known
    licence, then the longest, then the least id is retained, with split_group, split (98/1/1) and equivalent_record_ids.
    """
    marked = rows.withColumn("_text", t.identity_hash(F.col("text")))
    edges = component_edges(marked, F.col("id"), F.concat(F.lit("t:"), F.col("_text"))).unionByName(component_edges(marked, F.col("id"), F.concat(F.lit("u:"), F.col("canonical_url"))))
    groups = connected_components(edges, nodes=rows.select("id")).select(F.col("node").alias("id"), F.col("component").alias("split_group"))
    ranked = rows.select("id", (F.col("license") == "unknown").cast("int").alias("rank"), (-F.col("whitespace_words")).alias("shorter")).join(groups, "id")
    best = ranked.groupBy("split_group").agg(F.min_by("id", F.struct("rank", "shorter", "id")).alias("retained_id"), F.array_sort(F.collect_list("id")).alias("equivalent_record_ids"))
    split = split_of(hash_bucket(F.concat(F.lit(seed + ":"), F.col("split_group"))))
    retained = rows.join(best.withColumnRenamed("retained_id", "id"), "id").withColumn("split", split)
    duplicates = groups.join(best.select("split_group", "retained_id"), "split_group").where("id <> retained_id")
    return retained, duplicates.select("id", "retained_id", F.col("split_group").alias("group"), F.lit("same_normalized_text_or_canonical_article_url").alias("reason"))


def label_conflicts(rows: DataFrame, key: str, target: str) -> DataFrame:
    """(key, n_targets) of keys that carry more than one target; null targets do not count."""
    return rows.groupBy(key).agg(F.count_distinct(target).alias("n_targets")).where("n_targets > 1")


def binary_examples(rows: DataFrame) -> DataFrame:
    """One row of each normalized text with a target, an original before a post-edited one, with equivalent_record_ids."""
    if "posteditor" not in rows.columns:
        rows = rows.withColumn("posteditor", F.lit(None).cast("string"))
    eligible = rows.where("binary_target IS NOT NULL").withColumn("_text", t.identity_hash(F.col("text")))
    order = F.struct(F.col("authorship") == "machine_assisted", F.col("posteditor").isNotNull(), "id")
    chosen = eligible.groupBy("_text").agg(F.min_by("id", order).alias("id"), F.array_sort(F.collect_list("id")).alias("equivalent_record_ids"))
    return eligible.drop("_text").join(chosen.drop("_text"), "id")


def quarantine_posts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(binary, quarantine) by normalized_text_sha256: a text with both labels, or with no eligible row, is quarantined whole;
    else the row of least (dataset, id) stands for all, and rows without a target are quarantined too."""
    key = "normalized_text_sha256"
    empty = t.is_blank(F.col("text"))
    eligible = F.col("binary_target").isNotNull() & ~empty
    facts = rows.groupBy(key).agg(
        F.count_distinct("binary_target").alias("_targets"), F.count_if(eligible).alias("_eligible"),
        F.min_by("id", F.when(eligible, F.struct("dataset", "id"))).alias("_chosen"),
    )
    judged = rows.join(facts, key)
    conflict = F.col("_targets") > 1
    none = ~conflict & (F.col("_eligible") == 0)
    binary = judged.where(~conflict & (F.col("_eligible") > 0) & (F.col("id") == F.col("_chosen")))
    # the list of all ids of a text goes to its one chosen row, never to each of them
    aliases = rows.groupBy(key).agg(F.array_sort(F.collect_list("id")).alias("equivalent_record_ids"))
    binary = binary.join(aliases, key)
    reason = F.when(conflict, "conflicting_labels_for_identical_normalized_text").when(none & empty, "empty_text").otherwise(F.col("exclusion_reason"))
    quarantine = judged.where(conflict | none | F.col("binary_target").isNull()).withColumn("exclusion_reason", reason)
    drop = ("_targets", "_eligible", "_chosen")
    return binary.drop(*drop), quarantine.drop(*drop)


def span_winners(spans: DataFrame, digest: Column) -> DataFrame:
    """The span of least (unknown licence, id) of each digest; equal spans in different splits fail the job."""
    marked = spans.withColumns({"_digest": digest, "_rank": (F.col("license") == "unknown").cast("int")})
    best = marked.groupBy("_digest").agg(F.min_by("id", F.struct("_rank", "id")).alias("id"), F.min("split").alias("_a"), F.max("split").alias("_b"))
    crossing = best.where("_a <> _b")
    if not crossing.isEmpty():
        raise ValueError("an exact span text crosses partitions; regroup before assembly")
    return marked.join(best.select("id"), "id", "left_semi").drop("_digest", "_rank")


def accepted_first_seen(rows: DataFrame, position: str, id: str = "id", digest: str = "digest") -> DataFrame:
    """Rows that are neither an accepted row's id nor an accepted row's digest again, in order of position.

    A row is blocked only by accepted rows, so this is the greedy rule and not a row_number by key. Rounds: a row is accepted
    once no undecided or accepted earlier row shares a key; it goes once an accepted earlier row does.
    """
    from ..session import materialise

    keyed = rows.select(F.col(position).alias("_at"), F.array(F.concat(F.lit("i:"), F.col(id)), F.concat(F.lit("d:"), F.col(digest))).alias("_keys"))
    open_ = materialise(keyed.select("_at", F.explode("_keys").alias("_key")), "first-seen")
    accepted = None
    while not open_.isEmpty():
        least = open_.groupBy("_key").agg(F.min("_at").alias("_first"))
        now = open_.join(least, "_key").groupBy("_at").agg(F.bool_and(F.col("_at") == F.col("_first")).alias("_ok")).where("_ok").select("_at")
        now = materialise(now, "first-seen")
        accepted = now if accepted is None else accepted.unionByName(now)
        blocked = open_.join(now, "_at", "left_semi").select("_key").distinct()
        gone = open_.join(blocked, "_key", "left_semi").select("_at").distinct()
        open_ = materialise(open_.join(gone, "_at", "left_anti"), "first-seen")
    if accepted is None:
        return rows.limit(0)
    return rows.join(accepted.withColumnRenamed("_at", position), position, "left_semi")
