"""The language check and similarity retrieval against plain versions."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np

from loomtext.operators import language, similarity


def plain_grams(text):
    plain = " " + re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip() + " "
    return [plain[i : i + 3] for i in range(len(plain) - 2)]


def test_language_model_equals_the_plain_one(spark):
    draw = random.Random(1)
    letters = {"en": "thequickbrown ", "fr": "éàlesdpaux ", "de": "üßderich "}
    text = lambda lang, n: "".join(draw.choices(letters[lang], k=n))
    train = [(i, text(lang, 300), lang) for i, lang in enumerate(["en", "fr", "de"] * 20)] + [(900, None, "en"), (901, "12 34", "fr"), (902, "words", None)]
    test = [(i, text(lang, draw.choice([10, 500, 5000])), lang) for i, lang in enumerate(["en", "fr", "de"] * 10)] + [(100, None, "en"), (101, "1 2 3", "en"), (102, "", "fr"), (103, "x" * 2000 + "1" * 3000, "en")]
    model = language.train_language_model(spark.createDataFrame(train, "id long, text string, lang string"), features=200)
    got = {r["id"]: r for r in language.language_confidences(spark.createDataFrame(test, "id long, text string, lang string"), model).collect()}
    counts = {lang: Counter(g for _, t, x in train if x == lang for g in plain_grams(t)) for lang in ("de", "en", "fr")}
    total = sum(counts.values(), Counter())
    kept = sorted(total, key=lambda g: (-total[g], g))[:200]
    size = {x: sum(c[g] for g in kept) + len(kept) + 1 for x, c in counts.items()}
    weight = {(x, g): round(math.log((counts[x][g] + 1) / size[x]) * 1e6) for x in counts for g in kept}
    for id, body, _ in test:
        samples = [] if body is None else [body] if len(body) <= 1800 else [body[:1800], body[max(0, len(body) // 2 - 900) :][:1800], body[-1800:]]
        scores = [{x: sum(weight.get((x, g), 0) for g in plain_grams(s)) for x in counts} for s in samples]
        least = min((1 / sum(math.exp(min((v - s["en"]) / 1e6, 700)) for v in s.values()) if s["en"] else 0.0 for s in scores), default=0.0)
        assert abs(got[id]["confidence"] - least) < 1e-9
        whole = {x: sum(s[x] for s in scores) for x in counts}
        assert got[id]["detected"] == (max(sorted(whole), key=whole.get) if any(whole.values()) else None)
    assert sum(got[i]["detected"] == x for i, _, x in test[:30]) >= 20


def test_permutations_equal_plain_integers():
    draw = np.random.default_rng(1)
    a, b = similarity.permutations(50)
    a, b = np.append(a, np.uint64(1 << 60)), np.append(b, np.uint64(similarity.PRIME - 1))
    x = np.append(draw.integers(0, 1 << 32, 200, dtype=np.uint64), [np.uint64(0), np.uint64((1 << 32) - 1)])
    got = similarity._permuted(x[:, None], a[None, :], b[None, :])
    assert got.tolist() == [[(int(p) * int(v) + int(q)) % similarity.PRIME & similarity.VALUE for p, q in zip(a, b, strict=True)] for v in x]


def _sets(spark, sets):
    return spark.createDataFrame([(i, sorted(s), len(s)) for i, s in sets.items()], "id long, shingles array<long>, words long")


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def test_candidates_hold_all_similar_pairs(spark):
    draw = random.Random(7)
    sets = {}
    for base in range(40):
        core = draw.sample(range(-(10**6), 10**6), draw.randint(3, 120))
        for _ in range(6):
            kept = [x for x in core if draw.random() > 0.08] + draw.sample(range(5000), draw.randint(0, 9))
            sets[len(sets)] = set(kept or core)
    for minimum in (0.5, 0.8, 0.92):
        want = {(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] != sets[b] and _jaccard(sets[a], sets[b]) >= minimum}
        frame = _sets(spark, sets)
        candidates = {tuple(r) for r in similarity.prefix_candidates(frame, minimum).collect()}
        found = {(r["first"], r["second"]): r["jaccard"] for r in similarity.similar_pairs(frame, minimum).where("jaccard < 1").collect()}
        assert want <= candidates and found.keys() == want and all(abs(found[p] - _jaccard(sets[p[0]], sets[p[1]])) < 1e-12 for p in want)


def test_banded_cells_verify_every_pair_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PART", 7)
    draw = random.Random(9)
    core = draw.sample(range(10**9), 200)
    sets = {i: set(core[:190]) | {10**10 + i, 10**11 + i % 9} | set(draw.sample(core[190:], 4)) for i in range(60)}
    got = {(r["first"], r["second"]): (r["jaccard"], r["word_ratio"]) for r in similarity.banded_pairs(_sets(spark, sets), 0.9).collect()}
    want = {(a, b) for a, b in itertools.combinations(sets, 2) if _jaccard(sets[a], sets[b]) >= 0.9}
    assert len(want - got.keys()) <= 0.01 * len(want) and got.keys() <= want
    assert all(abs(x - _jaccard(sets[a], sets[b])) < 1e-12 for (a, b), (x, _) in got.items())


def test_a_hot_shingle_is_cut_into_blocks(spark):
    """One shingle in 20,000 sets: no cell has more than two blocks, and few of 200 million pairs are candidates."""
    draw = random.Random(3)
    sets = {i: {0} | set(draw.sample(range(1, 10**7), 3)) for i in range(20_000)}
    sets |= {20_000 + i: sets[i] | {10**8 + i} for i in range(50)}
    frame = _sets(spark, sets)
    members = frame.selectExpr("id", "0L AS shingle")
    sizes = similarity._cells(members, "shingle", lambda cell, left, right: [(len(cell["id"]), float(len(left)), float(len(right)))], "first long, left double, right double").collect()
    parts = -(-len(sets) // similarity.PART)
    assert len(sizes) == parts * (parts + 1) // 2 and max(r["first"] for r in sizes) < 2.6 * similarity.PART
    found = {(r["first"], r["second"]) for r in similarity.similar_pairs(frame, 0.8).where("jaccard < 1").collect()}
    assert {(i, 20_000 + i) for i in range(50)} <= found and all(_jaccard(sets[a], sets[b]) >= 0.8 for a, b in found)


def test_sets_without_an_id_pair_nothing(spark):
    frame = spark.createDataFrame([(1, [1, 2, 3], 3), (None, [1, 2, 3], 3), (None, [1, 2, 4], 3), (2, [], 0), (3, [1, 2, 3], 3)], "id long, shingles array<long>, words long")
    for found in (similarity.similar_pairs(frame, 0.5), similarity.banded_pairs(frame, 0.5)):
        assert [tuple(r) for r in found.collect()] == [(1, 3, 1.0, 1.0)]


def test_only_prefixes_and_candidates_leave_the_sets(spark, monkeypatch):
    """Whole sets are written once, and not at all when they are a working table; what is shuffled of them is their first shingles and the candidates."""
    draw = random.Random(5)
    sets = {i: set(draw.sample(range(10**9), 500)) for i in range(200)}
    sets |= {200: set(sorted(sets[0])[5:]) | {1}, 201: sets[3], 202: set(sorted(sets[4])[:300])}
    labels = {}
    keep = similarity.materialise

    def noted(df, label):
        labels[label] = keep(df, label)
        return labels[label]

    monkeypatch.setattr(similarity, "materialise", noted)
    frame = keep(_sets(spark, sets), "given")
    found = {(r["first"], r["second"]) for r in similarity.similar_pairs(frame, 0.8).collect()}
    assert found == {(0, 200), (3, 201)}
    assert not any("shingles" in t.columns for t in labels.values()) and labels["prefixes"].count() < 400  # of 101,000 shingles
    # the order of common shingles moves no result; ids outside are as if they were not there
    monkeypatch.setattr(similarity, "COMMON", 1)
    assert {(r["first"], r["second"]) for r in similarity.similar_pairs(frame, 0.8).collect()} == found
    among = frame.select("id").where("id <> 3")
    assert {(r["first"], r["second"]) for r in similarity.similar_pairs(frame, 0.8, among).collect()} == {(0, 200)}


def test_benchmark_overlap_equals_its_sql_on_odd_texts_and_ids(spark, tmp_path):
    """Repeated ids counted a shingle once a row; case folding and combining marks made other words than the SQL."""
    import duckdb

    import __spark_entry__

    body = "die große Straße führt über den Fluß in die ΣΑΣ Stadt İzmir ﬁn ① und weiter नमस्ते दुनिया कैसे हैं आप सब लोग आज"
    words = body.split()
    docs = [(1, body), (1, body), (2, body.upper()), (3, body.replace("ß", "ss")), (4, " ".join(words[:14])), (4, " ".join(words[8:])), (None, body), (None, body), (5, None), (6, body.replace("ﬁ", "fi").replace("①", "1")), (7, body.casefold()), (8, " ".join(words[10:]))]
    items = [(1, body), (2, " ".join(words[:12])), (2, " ".join(words[10:])), (None, body), (3, None), (4, " ".join(words[-11:])), (5, "GROẞE " + " ".join(words))]
    con = duckdb.connect()
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame([(*r, "de", "s") for r in rows], f"{schema}, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    key = lambda rows: sorted(rows, key=str)
    got = key(tuple(r) for r in __spark_entry__.queries()["benchmark_overlap"](spark, str(tmp_path)).collect())
    assert len(got) > 10 and got == key(con.execute(__spark_entry__.oracle_sql()["benchmark_overlap"]).fetchall())


def test_sets_of_texts_are_never_written_whole(spark, monkeypatch):
    """All sets were written, twice the texts' size, and all prefixes shuffled as rows; now only the candidates' sets are."""
    draw = random.Random(8)
    bodies = {i: [f"w{draw.randrange(10**6)}" for _ in range(300)] for i in range(150)}
    bodies |= {150: bodies[0][4:], 151: bodies[3], 152: bodies[4][:200], 153: ["short"], 154: bodies[0][:-4]}
    rows = [(i, " ".join(words)) for i, words in bodies.items()] + [(155, None), (None, " ".join(bodies[7]))]
    labels = {}
    keep = similarity.materialise

    def noted(df, label):
        labels[label] = (keep(df, label), df.count())
        return labels[label][0]

    monkeypatch.setattr(similarity, "materialise", noted)
    frame = spark.createDataFrame(rows, "id long, text string").repartition(3)
    brute = sorted(map(tuple, similarity.similar_pairs(keep(similarity.shingle_sets(frame), "given"), 0.8).collect()))
    labels.clear()
    for buckets, held, listed in ((500_000, 1_000_000, 1_000_000), (100, 50, 0)):
        monkeypatch.setattr(similarity, "BUCKET", buckets)
        monkeypatch.setattr(similarity, "HELD", held)
        monkeypatch.setattr(similarity, "BROADCAST_IDS", listed)
        assert sorted(map(tuple, similarity.similar_pairs(similarity.Texts(frame), 0.8).collect())) == brute
        assert {(p[0], p[1]) for p in brute} == {(0, 150), (0, 154), (150, 154), (3, 151)}
        assert labels["listed"][1] == 3 and not any("shingles" in t.columns for t, _ in labels.values()) and labels["prefixes"][1] < 400


def test_components_and_kept_rows_write_sizes_only(spark, sf, monkeypatch):
    """near_dup_components and near_dup_keep wrote every shingle set for the sake of ids and sizes."""
    from loomtext.plans import queries

    seen = []
    for module in (queries, similarity):
        monkeypatch.setattr(module, "materialise", lambda df, label, keep=module.materialise: seen.append(df.columns) or keep(df, label))
    queries.near_dup_components(spark, sf)
    queries.near_dup_keep(spark, sf)
    assert ["id", "words", "n"] in seen and not any("shingles" in columns for columns in seen)
