import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.operators import aggregate, budget, dedup, evaluate, similarity, spans, splits, verify
from loomtext.operators.graph import connected_components


def components_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long"), nodes=spark.createDataFrame([(5,), (999,)], "n long")).collect()))
    want = components_of([e for e in edges if e[0] != e[1]])
    assert {k: v for k, v in got.items() if k in want} == want and got[999] == 999


def test_components_of_nothing(spark):
    empty = spark.createDataFrame([], "src string, dst string")
    assert connected_components(empty).count() == 0


def greedy(sizes, limit):
    used, out = 0, []
    for s in sizes:
        ok = used + s <= limit
        used += s * ok
        out.append(ok)
    return out


@pytest.mark.parametrize("at_once", [0, 40, 1000])
def test_budget_is_greedy_with_skips(spark, monkeypatch, at_once):
    monkeypatch.setattr(budget, "SEQUENTIAL_ROWS", at_once)
    draw = random.Random(3)
    sizes = [draw.randint(1, 60) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(sizes)), "i long, w long")
    got = [r["selected"] for r in budget.greedy_budget(rows, F.lit(500), F.col("i"), "w").orderBy("i").collect()]
    assert got == greedy(sizes, 500)


def test_quota_by_source(spark):
    rows = spark.createDataFrame([("a", 1, 50), ("a", 2, 60), ("a", 3, 40), ("b", 1, 10), ("b", 2, 200), ("b", 3, 90)], "s string, p long, n long")
    got = budget.quota(rows, {"a": 100, "b": 100}, "s", "p", "n", 20).where("selected").select("s", "p").collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("a", 3), ("b", 3)]


def test_first_seen_is_blocked_by_accepted_only(spark):
    # row 2 shares its id with 1 and goes; row 3 shares its digest with row 2 only and stays
    rows = spark.createDataFrame([(1, "x", "p"), (2, "x", "q"), (3, "y", "q"), (4, "z", "q")], "pos long, id string, digest string")
    assert sorted(r["pos"] for r in dedup.accepted_first_seen(rows, "pos").collect()) == [1, 3]


def shingles(text, width=7):
    words = re.findall(r"\w+(?:['’]\w+)*", text.lower())
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_similar_pairs_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if texts[a] and texts[b] and texts[a] != texts[b] and len(texts[a] & texts[b]) / len(texts[a] | texts[b]) >= 0.5}
    sets = similarity.shingle_sets(docs, "doc_id")
    got = {(r["first"], r["second"]) for r in similarity.similar_pairs(sets, 0.5).where("jaccard < 1").collect()}
    least = {}
    for d in sorted(texts):
        least.setdefault(frozenset(texts[d]), d)
    assert got == {(a, b) for a, b in want if least[frozenset(texts[a])] == a and least[frozenset(texts[b])] == b}


def test_greedy_keep_chain(spark):
    ranked = spark.createDataFrame([(k, i) for i, k in enumerate("abcd")], "id string, rank int")
    pairs = spark.createDataFrame([("a", "b"), ("b", "c")], "first string, second string")
    kept, removed = similarity.greedy_keep(ranked, pairs)
    assert sorted(r["id"] for r in kept.collect()) == ["a", "c", "d"]
    assert [tuple(r) for r in removed.collect()] == [("b", "a")]


def test_passages_are_exact_and_contiguous(spark):
    text = "\n\n".join(f"Paragraph {i} has some words 漢字 😀 and ends here. Another sentence follows it." for i in range(40))
    found = spans.passages(text, 30, 120)
    assert [a for a, _, _ in found] == [0] + [b for _, b, _ in found[:-1]]
    assert all(n == len(text[a:b].split()) <= 120 for a, b, n in found)
    assert spans.passages("too short", 30, 120) == []
    rows = spark.createDataFrame([("d", text), ("e", None)], "id string, text string")
    made = spans.make_spans(rows, 30, 120)
    verify.verify_slices(made, rows)
    assert made.count() == len(found)


def test_tail_rules():
    policy = spans.TailPolicy({"p": ("Footer line.",)}, {"p": ("Editor.",)}, ("q",), 20)
    body = "word " * 50
    text = body + "\nFooter line.\nEditor."
    assert text[: spans.trim_tail(text, "p", policy, frozenset())[0]] == body.rstrip()
    assert spans.trim_tail(body + "\nFooter line.\nmore", "p", policy, frozenset())[1] is None
    teasers = [f"Story {i} goes on…" for i in range(3)]
    text = body + "\n" + "\n".join(teasers)
    assert spans.trim_tail(text, "q", policy, frozenset(teasers))[1] == "recurring_related_story_tail"
    assert spans.trim_tail(text, "q", policy, frozenset(teasers[:2]))[1] is None


def test_translation_spans(spark):
    rows = []
    for engine in ("A", "B"):
        for i in (1, 2, 4):
            rows.append((f"{engine}{i}", "doc", i, engine, f"{engine} text number {i}", f"src {i}", "g", "machine_translation"))
    df = spark.createDataFrame(rows, "id string, document_group string, segment_index int, engine string, text string, source_text string, split_group string, authorship string")
    made, skipped = spans.translation_spans(df, 1, 100)
    got = sorted((r["variant"], r["first_segment"], r["last_segment"]) for r in made.collect())
    assert got == [("A", 1, 2), ("A", 4, 4), ("B", 1, 2), ("B", 4, 4)]
    assert skipped.count() == 0


def test_splits(spark):
    bucket = spark.range(1).select(splits.hash_bucket(F.lit("x"))).first()[0]
    assert bucket == 76
    groups = spark.createDataFrame([(f"g{i}", "s") for i in range(30)], "g string, s string")
    counts = dict(map(tuple, splits.rank_split(groups, "g", "x").groupBy("split").count().collect()))
    assert counts == {"test": 3, "validation": 3, "train": 24}
    counts = dict(map(tuple, splits.stratified_split(groups, "g", "s", "x").groupBy("split").count().collect()))
    assert counts == {"test": 4, "validation": 4, "train": 22}  # 4.5 rounds to even


RECORD = "id string, document_group string, text string, source_text string, source_language string, authorship string"


def test_assign_splits_groups_and_ambiguity(spark):
    rows = [("1", "d1", "Same Text", None, None, "human_translation"), ("2", "d2", "same  text", None, None, "machine_translation"), ("3", "d3", "other", "quelle", "zh", "human_translation"), ("4", "d4", "another", "Quelle", "zh", "machine_translation"), ("5", "d5", "solo", "quelle", "de", "human_candidate")]
    got = {r["id"]: r for r in splits.assign_splits(spark.createDataFrame(rows, RECORD)).collect()}
    assert got["1"]["split_group"] == got["2"]["split_group"] == "d1" and got["4"]["split_group"] == "d3" and got["5"]["split_group"] == "d5"
    assert got["1"]["ambiguous_text"] and got["1"]["binary_target"] is None and got["3"]["binary_target"] == 0 and got["4"]["binary_target"] == 1 and got["5"]["binary_target"] is None
    with pytest.raises(ValueError):
        splits.assign_splits(spark.createDataFrame(rows[:1] * 2, RECORD))


def test_article_groups(spark):
    rows = [("a", "Same", "u1", "unknown", 5), ("b", "same", "u2", "open", 4), ("c", "x", "u2", "open", 9), ("d", "y", "u3", "open", 1)]
    kept, gone = dedup.article_groups(spark.createDataFrame(rows, "id string, text string, canonical_url string, license string, whitespace_words int"))
    assert {r["id"]: r["equivalent_record_ids"] for r in kept.collect()} == {"c": ["a", "b", "c"], "d": ["d"]}
    assert sorted((r["id"], r["retained_id"]) for r in gone.collect()) == [("a", "c"), ("b", "c")]


def test_threshold_and_ties(spark):
    rows = spark.createDataFrame([(0, s / 100) for s in range(100)] + [(0, 0.99), (1, 0.5)], "binary_target int, score double")
    assert evaluate.choose_threshold(rows, 0.01) > 0.99
    assert 0.9 < evaluate.choose_threshold(rows, 0.05) < 0.97
    with pytest.raises(ValueError):
        evaluate.choose_threshold(rows.where("binary_target = 1"))


def test_join_scores_fails_closed(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    for bad in ([("z", 0.1)], [("a", 0.1), ("a", 0.2)], [("a", float("nan"))], [("a", 1.5)]):
        with pytest.raises(ValueError):
            evaluate.join_scores(rows, spark.createDataFrame(bad, "id string, score double"))
    assert evaluate.join_scores(rows, spark.createDataFrame([("a", 0.5)], "id string, score double")).where("score IS NULL").count() == 1


def test_cluster_bootstrap(spark):
    rows = spark.createDataFrame([("g1", 0, 0.9), ("g1", 1, 0.9), ("g2", 0, 0.1), ("g2", 1, 0.2)], "split_group string, binary_target int, score double")
    got = evaluate.cluster_bootstrap(rows, 0.5, 200)
    assert got["work_groups"] == 2 and got["human_fpr"]["value"] == 0.5
    assert evaluate.poisson_bootstrap(rows, 0.5, 50).count() == 1
    with pytest.raises(Exception):
        evaluate.cluster_bootstrap(rows.withColumn("score", F.lit(None).cast("double")), 0.5)


def test_balanced_select_respects_caps(spark):
    rows = [(f"{g}{i}", g, f"p{i % 3}", f"a{i % 2}", f"d{i}", 10, f"text {g} {i}") for g in ("journalism", "fiction") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, genre string, publisher string, author string, parent_document_id string, whitespace_words int, text string")
    policy = budget.BalancePolicy({"journalism": 0.5, "fiction": 0.5}, publisher_share=0.1, author_share=0.2, document_share=1.0)
    got = budget.balanced_select(df, policy).collect()
    total = 800
    for p in ("p0", "p1", "p2"):
        assert sum(r["whitespace_words"] for r in got if r["genre"] == "journalism" and r["publisher"] == p) <= 0.1 * total + sum(r["whitespace_words"] for r in got if r["genre"] == "fiction" and r["publisher"] == p)
    assert len({r["id"] for r in got}) == len(got) > 0


def test_verification_catches_leakage(spark):
    rows = spark.createDataFrame([("1", "g", "t", "train"), ("2", "g", "u", "test")], "id string, split_group string, text string, split string").withColumn("text_sha256", F.sha2("text", 256))
    with pytest.raises(ValueError, match="split leakage"):
        verify.verify_records(rows)
    with pytest.raises(ValueError, match="checksum"):
        verify.verify_records(rows.withColumn("text_sha256", F.lit("0")))
    changed = verify.changed_files(spark.createDataFrame([("p", "1", 1)], "path string, sha256 string, bytes long"), spark.createDataFrame([("p", "2", 1)], "path string, sha256 string, bytes long"))
    assert changed.count() == 1


def test_regroup_takes_the_highest_split(spark):
    rows = spark.createDataFrame([("a", "train"), ("b", "test"), ("c", "train")], "split_group string, split string")
    edges = spark.createDataFrame([("a", "b")], "src string, dst string")
    got = {r["upstream_split_group"]: (r["split_group"], r["split"]) for r in splits.regroup(rows, edges).collect()}
    assert got == {"a": ("a", "test"), "b": ("a", "test"), "c": ("c", "train")}


def test_summaries(spark):
    rows = spark.createDataFrame([("d", "h", "e", "train", "g1", 5, False), ("d", "m", None, "test", "g2", 6, True)], "dataset string, authorship string, engine string, split string, document_group string, whitespace_words int, ambiguous_text boolean")
    got = aggregate.summarize(rows).first()
    assert got["records"] == 2 and got["documents"] == 2 and got["authorship"] == {"h": 1, "m": 1} and got["engine"] == {"None": 1, "e": 1}
    assert tuple(aggregate.length_quantiles(rows).first()) == (5, 6, 6)
    assert aggregate.field_coverage(rows).where("field = 'engine'").first()["present"] == 1


def test_copies_beside_a_longer_near_copy_all_go(spark):
    words = [f"w{i}" for i in range(300)]
    texts = {"x": words + ["and", "more"], "c1": words, "c2": words, "c3": words, "d": [f"v{i}" for i in range(200)], "e": [f"v{i}" for i in range(200)]}
    texts["y"] = words[3:]
    texts |= {f"g{i}": [f"u{j}" for j in range(i, 100 + i // 2)] for i in range(5)}
    texts["d2"] = texts["d"] + ["-"] * 40  # the same shingles, but too many words
    rows = [(k, " ".join(v)) for k, v in texts.items()]
    sets = similarity.shingle_sets(spark.createDataFrame(rows, "id string, text string"))
    ranked = sets.select("id", F.struct((-F.col("words")).alias("w"), "id").alias("rank"))
    _, removed = similarity.keep_distinct(ranked, sets, similarity.similar_pairs(sets, 0.8))
    terms = {k: shingles(t) for k, t in rows}
    near = lambda a, b: len(terms[a] & terms[b]) / len(terms[a] | terms[b]) >= 0.92 and min(len(texts[a]), len(texts[b])) / max(len(texts[a]), len(texts[b])) >= 0.85
    kept, want = [], {}
    for k in sorted(texts, key=lambda k: (-len(texts[k]), k)):
        found = sorted(o for o in kept if near(k, o))
        if found:
            want[k] = found[0]
        else:
            kept.append(k)
    assert {want[k] for k in ("c1", "c2", "c3")} == {"x"} and "d" not in want and want["e"] == "d"
    assert {r["removed_id"]: r["retained_id"] for r in removed.collect()} == want


def test_banded_pairs_verify_whole_buckets(spark):
    draw = random.Random(3)
    base = [f"w{i}" for i in range(1500)]
    texts = {i: base[: 1500 - i] + [f"t{i}"] for i in range(12)} | {i: texts_of for i, texts_of in ((20, base[:900]), (21, base[:900]), (22, base[:895]), (30, []))}
    rows = [(i, " ".join(v)) for i, v in texts.items()]
    draw.shuffle(rows)
    found = similarity.banded_pairs(similarity.shingle_sets(spark.createDataFrame(rows, "id long, text string")), 0.95)
    terms = {k: shingles(t) for k, t in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if terms[a] and terms[b] and len(terms[a] & terms[b]) / len(terms[a] | terms[b]) >= 0.95}
    assert {(r["first"], r["second"]) for r in found.collect()} == want - {(21, 22)}  # 21 is a copy of 20


def test_restored_punctuation_has_every_document(spark, tmp_path):
    from loomtext.plans.queries import restored_punctuation

    long = "word , " * 1000
    rows = [(1, "a , b ( c ) @-@ d ."), (2, long), (3, None), (4, " one\t@-@ two [ x ] ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["restored"] for r in restored_punctuation(spark, str(tmp_path)).collect()}

    def restored(text):
        text = re.sub(r"([(\[])[ \t]+", r"\1", re.sub(r"[ \t]+([,.;:!?%)\]])", r"\1", text))
        return re.sub(r"\s+@-@\s+", "-", text, flags=re.ASCII).strip(" ")

    assert got == {i: None if text is None else restored(text) for i, text in rows}


def test_detector_report_uses_all_features(monkeypatch, spark, sf):
    from loomtext.operators import detector
    from loomtext.plans.queries import detector_report

    monkeypatch.setattr(detector, "train_and_report", lambda rows, maximum_fpr, **options: (None, options))
    assert detector_report(spark, sf).get("features", detector.FEATURES) == 75_000


def test_detector_scores_equal_a_plain_model(spark):
    """TF-IDF with sublinear counts and smoothed, raised IDF, unit length, and the minimum of the penalised balanced loss by Newton's method."""
    from loomtext.operators import detector

    draw = random.Random(11)
    words = [["river", "stone", "walks", "house"], ["token", "model", "stone", "layer"]]
    rows = [(i, " ".join(draw.choices(words[y] + ["the", "Of"], k=draw.randint(3, 12))), y) for i, y in enumerate([0] * 25 + [1] * 15)]
    made = detector.fit(spark.createDataFrame(rows, "id int, text string, binary_target int"))
    got = {r["id"]: r["score"] for r in made.score(spark.createDataFrame(rows, "id int, text string, binary_target int")).collect()}
    grams = [[p[i : i + n] for p in [" ".join(t.lower().split())] for n in (3, 4, 5) for i in range(len(p) - n + 1)] for _, t, _ in rows]
    frequency = Counter(g for each in grams for g in set(each))
    vocabulary = {g: k for k, g in enumerate(sorted(g for g, n in frequency.items() if n >= 3))}
    x = np.zeros((len(rows), len(vocabulary) + 1))
    for i, each in enumerate(grams):
        for g, n in Counter(each).items():
            if g in vocabulary:
                x[i, vocabulary[g]] = (1 + math.log(n)) * (1 + math.log((1 + len(rows)) / (1 + frequency[g])))
        x[i] /= np.linalg.norm(x[i]) or 1
    x[:, -1] = 1
    y = np.array([r[2] for r in rows])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    penalty = np.append(np.ones(len(vocabulary)), 0)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (p - y)) + penalty * w
        w -= np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag(penalty), slope)
    want = 1 / (1 + np.exp(-x @ w))
    assert max(abs(got[i] - want[i]) for i in got) < 1e-6


def test_threshold_is_an_order_statistic_of_all_scores(spark):
    scores = [(i * 37 % 101) / 101 for i in range(400)] + [0.5] * 200
    rows = spark.createDataFrame([(0, s) for s in scores] + [(1, 0.999)] * 5, "binary_target int, score double")
    for allowed in (0.0, 0.01, 0.3, 0.45, 0.6, 0.99):
        want = sorted(scores, reverse=True)[math.floor(len(scores) * allowed)]
        assert evaluate.choose_threshold(rows, allowed) == math.nextafter(want, math.inf)


def test_shingles_and_bands_keep_ids_beside_a_null(spark):
    body = "one two three four five six seven eight nine ten"
    ids = [2**53 + 1, None, 2**53 + 3]
    sets = similarity.shingle_sets(spark.createDataFrame([(i, body) for i in ids], "id long, text string").coalesce(1))
    assert [r["id"] for r in sets.collect()] == ids and len({tuple(r["shingles"]) for r in sets.collect()}) == 1
    bands = similarity.minhash_bands(sets).collect()
    assert {r["id"] for r in bands} == set(ids) and len(bands) == 3 * similarity.BANDS and len({r["band"] for r in bands}) == similarity.BANDS
    assert similarity.minhash_bands(similarity.shingle_sets(spark.createDataFrame([(1, "short"), (2, None)], "id long, text string"))).count() == 0


def test_overlaps_are_the_same_broadcast_and_shuffled(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    docs = similarity.shingle_sets(spark.createDataFrame([(i, " ".join(words[i : i + 30])) for i in range(20)], "id long, text string"))
    items = similarity.shingle_sets(spark.createDataFrame([(i, " ".join(words[3 * i : 3 * i + 12])) for i in range(9)], "id long, text string"))
    small = sorted(map(tuple, similarity.overlaps(docs, items, 0.5).collect()))
    monkeypatch.setattr(similarity, "BROADCAST_POSTINGS", 0)
    assert small and small == sorted(map(tuple, similarity.overlaps(docs, items, 0.5).collect()))
