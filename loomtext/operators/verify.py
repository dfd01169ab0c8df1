"""Verification: each check is a query for rows that break a rule, and must come back empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import materialise
from .similarity import keep_distinct, pair_scores, shingle_sets, similar_pairs
from .spans import span_gaps


def require_empty(checks: Mapping[str, DataFrame]) -> None:
    for name, broken in checks.items():
        first = broken.first()
        if first is not None:
            raise ValueError(f"{name}: {first}")


def crossing_keys(rows: DataFrame, kind: str, key: Column, split: str = "split") -> DataFrame:
    """(kind, key, splits) of keys whose rows lie in more than one split."""
    found = rows.select(key.alias("key"), F.col(split).alias("_s")).where("key IS NOT NULL").groupBy("key").agg(F.count_distinct("_s").alias("splits"))
    return found.where("splits > 1").select(F.lit(kind).alias("kind"), "key", "splits")


def leakage(rows: DataFrame) -> DataFrame:
    """Groups, texts and sources of records that cross splits."""
    parts = [crossing_keys(rows, "group", F.col("split_group")), crossing_keys(rows, "target", t.identity_hash(F.col("text")))]
    if "source_text" in rows.columns:
        parts.append(crossing_keys(rows.where("source_text IS NOT NULL"), "source", F.concat(F.col("source_language"), F.lit(":"), t.identity_hash(F.col("source_text")))))
    return reduce(DataFrame.unionByName, parts)


def verify_records(rows: DataFrame) -> None:
    require_empty({
        "repeated id": rows.groupBy("id").count().where("count > 1"),
        "text checksum changed": rows.where(t.text_hash(F.col("text")) != F.col("text_sha256")).select("id"),
        "split leakage": leakage(rows),
    })


def verify_slices(spans: DataFrame, parents: DataFrame) -> None:
    """Spans are exact slices of their parents, with the parent's group and split, gapless from 0."""
    bodies = parents.select(F.col("id").alias("parent_document_id"), F.col("text").alias("_body"))
    joined = spans.join(bodies, "parent_document_id", "left")
    own = t.text_slice(F.col("_body"), F.col("start"), F.col("end"))
    require_empty({
        "missing parent": joined.where("_body IS NULL").select("id"),
        "not a slice": joined.where(F.coalesce(own != F.col("text"), F.lit(True))).select("id"),
        "gap between spans": span_gaps(spans).select("id"),
    })


def verify_curated(scanned: DataFrame, retained: DataFrame, rejected: DataFrame, duplicates: DataFrame, spans: DataFrame, minimum: int, maximum: int) -> None:
    """Counts reconcile, spans are slices, and no long tail is left out."""
    total = {name: df.count() for name, df in (("scanned", scanned), ("retained", retained), ("rejected", rejected), ("duplicates", duplicates))}
    if total["scanned"] != total["retained"] + total["rejected"] + total["duplicates"]:
        raise ValueError(f"counts do not reconcile: {total}")
    verify_slices(spans, retained)
    ends = spans.groupBy(F.col("parent_document_id").alias("id")).agg(F.max("end").alias("_end"))
    rest = F.substr(F.col("text"), F.coalesce("_end", F.lit(0)) + 1)
    require_empty({
        "omitted tail": retained.join(ends, "id", "left").where(t.word_count(rest) >= minimum).select("id"),
        "word bounds": spans.where(~t.word_count(F.col("text")).between(minimum, 2 * maximum)).select("id"),
    })


def near_duplicate_violations(rows: DataFrame, kept: DataFrame, removed: DataFrame, rejected: DataFrame | None = None, similarity: float = 0.92, word_ratio: float = 0.85, sets: DataFrame | None = None) -> DataFrame:
    """(violation, id, other_id): where a near-duplicate release breaks its own certificate, recomputed from the texts.

    rows (id, text, rank) are all that went in, kept (id), removed (removed_id, retained_id) and rejected (id) what came out. A removed row
    must name a retained one that is kept, ranks before it and is a near copy by both bounds; no two kept rows may be near copies by both; and every
    row must have come out exactly once. Shingle sets of the texts may be given.
    """
    sets = materialise(shingle_sets(rows), "verified-sets") if sets is None else sets
    ranks = rows.select("id", "rank")
    named = removed.select(F.col("removed_id").alias("first"), F.col("retained_id").alias("second"))
    is_kept = kept.select(F.col("id").alias("second"), F.lit(True).alias("_kept")).distinct()
    own = ranks.select(F.col("id").alias("first"), F.col("rank").alias("_rank"))
    its = ranks.select(F.col("id").alias("second"), F.col("rank").alias("_before"))
    near = pair_scores(named, sets).where((F.col("jaccard") >= similarity) & (F.col("word_ratio") >= word_ratio)).select("first", "second", F.lit(True).alias("_near"))
    judged = named.join(is_kept, "second", "left").join(own, "first", "left").join(its, "second", "left").join(near, ["first", "second"], "left")
    kind = F.when(F.col("_kept").isNull(), "retained row is not kept").when(~F.coalesce(F.col("_before") < F.col("_rank"), F.lit(False)), "retained row ranks behind").when(F.col("_near").isNull(), "not a near copy")
    broken = judged.select(kind.alias("violation"), F.col("first").alias("id"), F.col("second").alias("other_id")).where("violation IS NOT NULL")
    # what the greedy rule would still remove from the kept rows
    listed = materialise(kept.select("id").distinct(), "listed")
    again = keep_distinct(ranks.join(listed, "id", "left_semi"), sets, similar_pairs(sets, min(0.8, similarity), listed), similarity, word_ratio)[1]
    again = again.select(F.lit("kept rows are near copies").alias("violation"), F.col("removed_id").alias("id"), F.col("retained_id").alias("other_id"))
    out = kept.select("id").unionByName(removed.select(F.col("removed_id").alias("id")))
    if rejected is not None:
        out = out.unionByName(rejected.select("id"))
    sides = rows.select("id", F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(out.select("id", F.lit(0).alias("i"), F.lit(1).alias("o")))
    uneven = sides.groupBy("id").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).where("i <> o")
    none = F.lit(None).cast(rows.schema["id"].dataType)
    return broken.unionByName(again).unionByName(uneven.select(F.lit("not accounted for once").alias("violation"), "id", none.alias("other_id")))


def verify_near_duplicates(rows: DataFrame, kept: DataFrame, removed: DataFrame, rejected: DataFrame | None = None, similarity: float = 0.92, word_ratio: float = 0.85) -> None:
    require_empty({"near-duplicate certificate": near_duplicate_violations(rows, kept, removed, rejected, similarity, word_ratio)})


def verify_selection(selected: DataFrame, budget: int | None = None) -> None:
    require_empty({"repeated id": selected.groupBy("id").count().where("count > 1"), "repeated text": selected.groupBy(t.identity_hash(F.col("text"))).count().where("count > 1")})
    words = selected.agg(F.sum("whitespace_words")).first()[0] or 0
    if budget is not None and words > budget:
        raise ValueError(f"budget exceeded: {words} > {budget}")


def verify_isolation(rows: DataFrame, keys: Sequence[str]) -> None:
    require_empty({f"{k} crosses splits": crossing_keys(rows, k, F.col(k)) for k in keys})


def difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows, with their side, that only one of two derivations has; counts of repeated rows matter."""
    columns = expected.columns
    missing = expected.exceptAll(actual.select(*columns)).withColumn("side", F.lit("expected"))
    return missing.unionByName(actual.select(*columns).exceptAll(expected).withColumn("side", F.lit("actual")))


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path) of files whose size or checksum changed, or that came or went, between two inventories."""
    b = before.select("path", F.col("sha256").alias("a"), F.col("bytes").alias("n"))
    joined = b.join(after.select("path", F.col("sha256").alias("b"), F.col("bytes").alias("m")), "path", "full")
    return joined.where(~F.col("a").eqNullSafe(F.col("b")) | ~F.col("n").eqNullSafe(F.col("m"))).select("path")


def replay(recipe: DataFrame, parents: DataFrame) -> DataFrame:
    """A frozen release from its recipe (id, parent_document_id, start, end, text_sha256, whitespace_words and more) and its parents' texts."""
    bodies = parents.select(F.col("id").alias("parent_document_id"), F.col("text").alias("_body"))
    joined = recipe.join(bodies, "parent_document_id", "left")
    rows = joined.withColumn("text", t.text_slice(F.col("_body"), F.col("start"), F.col("end"))).drop("_body")
    require_empty({"passage differs": rows.where(F.coalesce((t.text_hash(F.col("text")) != F.col("text_sha256")) | (t.word_count(F.col("text")) != F.col("whitespace_words")), F.lit(True))).select("id")})
    return rows


def verify_release(rows: DataFrame, passages: int, words: int, minimum: int = 400, maximum: int = 3000) -> None:
    require_empty({
        "split or language": rows.where("split NOT IN ('train', 'validation', 'test') OR language <> 'en'").select("id"),
        "unexpected authorship": rows.where("authorship <> 'human_candidate' OR binary_target IS NOT NULL").select("id"),
        "word bounds": rows.where(~F.col("whitespace_words").between(minimum, maximum)).select("id"),
        "repeated id": rows.groupBy("id").count().where("count > 1"),
        "repeated text": rows.groupBy("text_sha256").count().where("count > 1"),
        "group crosses splits": crossing_keys(rows, "group", F.col("split_group")),
        "parent crosses splits": crossing_keys(rows, "parent", F.col("parent_document_id")),
    })
    found = tuple(rows.agg(F.count("*"), F.sum("whitespace_words")).first())
    if found != (passages, words):
        raise ValueError(f"totals differ: {found}, expected {(passages, words)}")
