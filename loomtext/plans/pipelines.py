"""The curation pipelines end to end, each a composition of operators that returns its outputs and side logs as DataFrames.

Nothing is written here but working tables; the sinks publish what a caller wants to keep.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import aggregate, budget, dedup, detector, gates, language, similarity, spans, splits, verify
from ..operators.graph import component_edges
from ..session import materialise


@dataclass(frozen=True)
class QualityPolicy:
    minimum_words: int = 400
    maximum_span_words: int = 3000
    shingle_words: int = 7
    group_jaccard: float = 0.8
    dedup_jaccard: float = 0.92
    dedup_word_ratio: float = 0.85
    split_seed: str = "news-curation-v1"
    tails: spans.TailPolicy = field(default_factory=spans.TailPolicy)
    exact: bool = True


def curate(rows: DataFrame, policy: gates.NewsPolicy, open_licensed: Column, maximum_span_words: int = 3000, seed: str = "news-curation-v1", language_model: language.LanguageModel | None = None) -> dict[str, DataFrame]:
    """News rows (id, dataset, text, url, domain, source, date, created, metadata) -> documents, rejected, duplicates, spans, review.

    The cheap rules decide first; only what they keep is scored for its language, by the model if there is one, else by its stop words.
    """
    gated = materialise(gates.news_gate(rows, policy, open_licensed), "gated")
    kept = gated.where("reason IS NULL").drop("reason")
    if language_model is None:
        kept = kept.withColumn("_confidence", t.minimum_confidence(F.col("text")))
    else:
        found = language.language_confidences(kept, language_model).select("id", F.col("confidence").alias("_confidence"))
        kept = kept.join(found, "id")
    kept = materialise(kept.withColumn("reason", gates.english_reason(F.col("_confidence"), policy.english_confidence_minimum)).drop("_confidence"), "english")
    rejected = gated.where("reason IS NOT NULL").unionByName(kept.where("reason IS NOT NULL")).select("id", "reason")
    candidates = kept.where("reason IS NULL").drop("reason").withColumns({
        "publication_date": F.col("dated.date").cast("string"), "last_known_update_date": F.col("dated.updated").cast("string"), "publication_date_evidence": F.col("dated.evidence"),
        "authorship": F.lit("human_candidate"), "binary_target": F.lit(None).cast("int"), "text_sha256": t.text_hash(F.col("text")), "language": F.lit("en"), "review_status": F.lit("unreviewed"),
    }).drop("dated")
    documents, duplicates = dedup.article_groups(candidates, seed)
    documents = materialise(documents, "documents")
    cut = spans.make_spans(documents, policy.minimum_words, maximum_span_words)
    inherited = documents.select(F.col("id").alias("parent_document_id"), "publisher", "license", "publication_date", "split_group", "split", "authorship", "binary_target")
    return {
        "documents": documents, "rejected": rejected, "duplicates": duplicates, "spans": cut.join(inherited, "parent_document_id"),
        "review": aggregate.review_sample(documents, ["publisher"], "id"),
    }


def clean(documents: DataFrame, policy: QualityPolicy) -> dict[str, DataFrame]:
    """Documents (id, text, publisher, license, split_group, split) -> cleaned documents, spans, rejected, pairs, removed, tail_changes, ranked (what near-copies are removed from).

    Recognised tails go, short and disclosed texts are rejected, near-copies of a preferred document go, and groups that are similar or
    share an exact span are split together.
    """
    lines = aggregate.tail_line_frequencies(documents)
    cut = spans.trim_tails(documents, lines, policy.tails)
    cut = materialise(cut.withColumn("_body", F.substr("text", F.lit(1), F.col("tail_end"))), "trimmed")
    changes = cut.where("tail_rule IS NOT NULL").select("id", "publisher", "tail_end", "tail_rule", (t.word_count(F.col("text")) - t.word_count(F.col("_body"))).alias("removed_words"))
    body = cut.withColumn("text", F.col("_body")).drop("_body")
    body = body.withColumns({"text_sha256": t.text_hash(F.col("text")), "whitespace_words": t.word_count(F.col("text"))})
    kept, rejected = gates.admit(body, gates.tail_reason(policy.minimum_words, F.col("text")))
    kept = materialise(kept, "cleaned")
    sets = similarity.shingle_sets(kept, width=policy.shingle_words)
    pairs = similarity.similar_pairs(sets, policy.group_jaccard) if policy.exact else similarity.banded_pairs(sets, policy.group_jaccard)
    pairs = materialise(pairs, "pairs")
    ranked = kept.select("id", F.struct((F.col("license") == "unknown").cast("int").alias("rank"), (-F.col("whitespace_words")).alias("shorter"), "id").alias("rank"))
    _, removed = similarity.keep_distinct(ranked, sets, pairs, policy.dedup_jaccard, policy.dedup_word_ratio)
    removed = materialise(removed, "removed")
    retained = kept.join(removed.select(F.col("removed_id").alias("id")), "id", "left_anti")
    cut_spans = materialise(spans.make_spans(retained, policy.minimum_words, policy.maximum_span_words), "spans")
    group_of = kept.select("id", "split_group")
    first = group_of.select(F.col("id").alias("first"), F.col("split_group").alias("src"))
    second = group_of.select(F.col("id").alias("second"), F.col("split_group").alias("dst"))
    similar = pairs.join(first, "first").join(second, "second").select("src", "dst")
    of_span = cut_spans.join(group_of.withColumnRenamed("id", "parent_document_id"), "parent_document_id")
    repeated = component_edges(of_span, F.col("split_group"), t.identity_hash(F.col("text")))
    regrouped = splits.regroup(kept.select("id", "split_group", "split"), similar.unionByName(repeated)).select("id", F.col("split_group").alias("_group"))
    documents = retained.withColumnRenamed("split", "source_split").join(regrouped, "id").drop("split_group").withColumnRenamed("_group", "split_group")
    documents = materialise(documents.withColumn("split", splits.split_of(splits.hash_bucket(F.concat(F.lit(policy.split_seed + ":"), F.col("split_group"))))), "regrouped")
    final = cut_spans.join(documents.select(F.col("id").alias("parent_document_id"), "publisher", "license", "split_group", "split"), "parent_document_id")
    return {"documents": documents, "spans": final, "rejected": rejected.select("id", "reason"), "pairs": pairs, "removed": removed, "tail_changes": changes, "ranked": kept.select("id", "text").join(ranked, "id")}


def assemble_words(cut: DataFrame, word_budget: int | None = None, seed: str = "wordcorpus-v1") -> dict[str, DataFrame]:
    """Spans -> one of each text in hash order under a word budget: selected, rejected."""
    unique = materialise(dedup.span_winners(cut, t.identity_hash(F.col("text"))), "unique-spans")
    copies = cut.join(unique.select("id"), "id", "left_anti").select("id", F.lit("duplicate_normalized_span").alias("reason"))
    if word_budget is None:
        return {"selected": unique, "rejected": copies}
    chosen = materialise(budget.word_budget(unique, word_budget, seed), "budgeted")
    over = chosen.where("NOT selected").select("id", F.lit("exceeds_remaining_word_budget").alias("reason"))
    return {"selected": chosen.where("selected").drop("selected"), "rejected": copies.unionByName(over)}


def strict_core(cut: DataFrame, parents: DataFrame, policy: gates.CorePolicy) -> tuple[DataFrame, DataFrame]:
    """(selected, excluded) of passages by the strict gate on them and their parents."""
    kept, excluded = gates.admit(spans.join_parents(cut, parents), gates.strict_core_reason(policy))
    return kept.drop("parent"), excluded.select("id", "reason")


def group_similar(selected: DataFrame, minimum: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(rows with joined groups and their highest split, pairs): similar passages are split together."""
    pairs = materialise(similarity.similar_pairs(similarity.shingle_sets(selected), minimum), "pairs")
    of = selected.select("id", "split_group")
    edges = pairs.join(of.select(F.col("id").alias("first"), F.col("split_group").alias("src")), "first").join(of.select(F.col("id").alias("second"), F.col("split_group").alias("dst")), "second")
    return splits.regroup(selected, edges.select("src", "dst")), pairs


def diverse(pool: DataFrame, policy: budget.BalancePolicy) -> dict[str, DataFrame]:
    """A balanced mixture of genres: selected, pairs, summary."""
    chosen, pairs = group_similar(materialise(budget.balanced_select(pool, policy), "mixture"))
    return {"selected": chosen, "pairs": pairs, "summary": aggregate.grouping_sets(chosen, ["genre", "publisher", "author", "split"])}


def select_tokens(rows: DataFrame, quotas: Mapping[str, int], minimum: int, seed: str = "corpus-v1", vocabulary: str | None = None, end_tokens: int = 1) -> DataFrame:
    """Rows (source, position, id, text) under token quotas, with token_count, digest and split (98/1/1).

    Sources are filled one after the other, in the order of `quotas`. A duplicate is a row whose id or text an accepted row of an earlier
    source, or an earlier row of its own source, had; a text that no longer fits its source's quota may still fill a later one's.
    """
    counted = spans.token_counts(rows, vocabulary=vocabulary, end_tokens=end_tokens).withColumn("digest", t.identity_hash(F.col("text")))
    counted = materialise(counted.where(F.col("token_count") >= minimum), "tokens")
    chosen = None
    for source, tokens in quotas.items():
        own = counted.where(F.col("source") == source)
        if chosen is not None:
            own = own.join(chosen.select("id"), "id", "left_anti").join(chosen.select("digest"), "digest", "left_anti").select(*counted.columns)
        unique = materialise(dedup.accepted_first_seen(own, "position"), "unique")
        taken = budget.quota(unique.select(*counted.columns), {source: tokens}, "source", "position", "token_count", minimum).where("selected").drop("selected")
        taken = materialise(taken, "taken")
        chosen = taken if chosen is None else chosen.unionByName(taken)
    return chosen.withColumn("split", splits.split_of(splits.hash_bucket(F.concat(F.lit(seed + ":"), F.col("digest")))))


def pilot(*sources: DataFrame, seed: str = "pilot-v1:") -> dict[str, DataFrame]:
    """Records of several sources -> grouped and split records, binary examples, summary; leakage fails the job."""
    records = sources[0]
    for more in sources[1:]:
        records = records.unionByName(more, allowMissingColumns=True)
    records = materialise(splits.assign_splits(records, seed), "records")
    verify.verify_records(records)
    return {"records": records, "binary": dedup.binary_examples(records), "summary": aggregate.summarize(records)}


def literary(records: DataFrame, seed: str = "par3-work-groups-v2:", share: float = 0.1) -> dict[str, DataFrame]:
    """Aligned paragraphs with whole work groups allocated to splits by rank."""
    grouped = splits.assign_splits(records).drop("split")
    placed = materialise(grouped.join(splits.rank_split(grouped.select("split_group"), "split_group", seed, share), "split_group"), "literary")
    verify.verify_records(placed)
    return {"records": placed, "binary": dedup.binary_examples(placed)}


def posts(*sources: DataFrame) -> dict[str, DataFrame]:
    """Short posts grouped by account, pair and text, with one example of each text and the quarantine."""
    rows = sources[0]
    for more in sources[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    rows = materialise(splits.assign_post_groups(rows), "posts")
    verify.verify_isolation(rows, ["split_group", "partition_unit", "normalized_text_sha256"])
    binary, quarantine = dedup.quarantine_posts(rows)
    return {"rows": rows, "binary": binary, "quarantine": quarantine}


def train_detector(records: DataFrame, long_spans: DataFrame, minimum_words: int = 400, maximum_fpr: float = 0.01) -> tuple[detector.Detector, DataFrame]:
    """The baseline detector on segments and long spans, regrouped together, with its report on the test split."""
    rows = splits.regroup_segments_and_spans(records, long_spans, minimum_words)
    return detector.train_and_report(materialise(dedup.binary_examples(rows), "examples"), maximum_fpr)
