import itertools
import random
import re
from collections import Counter

import numpy as np

from loomtext.llm import neardup
from loomtext.llm.bagminhash import signatures, text_signatures
from loomtext.llm.textcore import mix, multiset, shingle_hashes, weighted_jaccard


def bag(text):
    w = re.findall(r"\w+", text.lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common) if a and b else 0.0


def test_shingles_match_a_plain_implementation():
    texts = ["One two, three FOUR five six.", "", None, "ab", "x x x x x x x", "é — ö…ü a b c", "a_b c-d e f g h"]
    hashes, counts = shingle_hashes(texts)
    at = np.concatenate(([0], np.cumsum(counts)))
    seen = {}
    for i, text in enumerate(texts):
        want = bag(text or "")
        got = Counter(hashes[at[i] : at[i + 1]].tolist())
        assert sorted(want.values()) == sorted(got.values())
        w = re.findall(r"\w+", (text or "").lower())
        for j, h in enumerate(hashes[at[i] : at[i + 1]].tolist()):
            assert seen.setdefault(tuple(w[j : j + 5]), h) == h
    assert len(set(seen.values())) == len(seen)
    assert (shingle_hashes(texts[::-1])[0] == np.concatenate([hashes[at[i] : at[i + 1]] for i in reversed(range(len(texts)))])).all()


def test_signatures_are_unbiased():
    draw = np.random.default_rng(0)
    error = []
    for _ in range(30):
        keys = mix(draw.integers(0, 2**63, 150).astype(np.uint64))
        a = draw.integers(0, 9, 150)
        b = np.where(draw.random(150) < 0.7, a, draw.integers(0, 20, 150))
        owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = signatures(np.concatenate([keys[a > 0], keys[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), owner, 2, 256)
        error.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(error)) < 0.015


def test_signatures_do_not_depend_on_the_batch():
    texts = [" ".join(random.Random(i).choices("abcdefgh", k=40 + i)) for i in range(12)]
    whole = text_signatures(texts)
    assert all((text_signatures([t])[0] == whole[i]).all() for i, t in enumerate(texts))
    assert not text_signatures([""]).any()


def classes(rows):
    return {(r["doc_id"]): r["class_id"] for r in rows}


def test_classes_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    bags = {r["doc_id"]: bag(r["text"] or "") for r in rows}
    texts = {r["doc_id"]: r["text"] for r in rows}
    parent = {d: d for d in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(bags), 2):
        if texts[a] == texts[b] or similarity(bags[a], bags[b]) >= 0.8:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert classes(neardup.op8_minhash_near_dedup(spark, sf).collect()) == {d: find(d) for d in bags}


def test_hot_group_of_near_copies_and_shared_passages(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=5))
    base = [word() for _ in range(200)]
    shared = [word() for _ in range(60)]
    rows = []
    for i in range(120):  # near copies: three words differ from the base
        w = list(base)
        for _ in range(2):
            w[draw.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    for i in range(120, 240):  # different texts around one shared passage
        rows.append((i, " ".join([word() for _ in range(40)] + shared + [word() for _ in range(10)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = classes(neardup.near_duplicate_classes(df).collect())
    assert {got[i] for i in range(120)} == {0}
    assert all(got[i] == i for i in range(120, 240))
    kept = sorted(r["doc_id"] for r in neardup.drop_near_duplicates(df).collect())
    assert kept == [0, *range(120, 240)]


def test_odd_rows(odd, none):
    rows = neardup.near_duplicate_classes(odd).collect()
    assert len(rows) == 8
    size = {(r["doc_id"], r["class_id"]): r["class_size"] for r in rows}
    assert size[1, 1] == 2 and size[3, 3] == size[4, 3] == 2 and size[2, 2] == 1 and (None, None) in size
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "5", "6", "None"]
    assert neardup.near_duplicate_classes(none).count() == 0 and neardup.drop_near_duplicates(none).count() == 0


def test_verified_similarity_is_that_of_multisets():
    a, b = "x y z w v x y z w v x y z", "x y z w v x y z w v q q q"
    sets = [multiset(shingle_hashes([t])[0]) for t in (a, b)]
    assert abs(weighted_jaccard(*sets) - similarity(bag(a), bag(b))) < 1e-12
    empty = multiset(shingle_hashes([""])[0])
    assert weighted_jaccard(empty, empty) == 0.0


def test_dropping_with_nulls_between_and_repeats(spark):
    rows = [(None, None, "a"), (4, "w " * 9 + "x", "b"), (3, "w " * 9 + "x", "c"), (3, "w " * 9 + "x", "d"), (None, None, "e"), (9, "other words that stand on their own here", "f"), (8, "Other words, that stand on their own here!", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _node string").coalesce(1)
    kept = neardup.drop_near_duplicates(df).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, ""), (0, ""), (3, "w " * 9 + "x"), (8, "Other words, that stand on their own here!")]


def test_links_inside_a_hot_group_of_texts_that_share_boilerplate(spark):
    draw = random.Random(11)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=6))
    shared = [word() for _ in range(300)]
    rows, want = [], {}
    for i in range(0, 600, 2):  # pairs over 0.8 to each other, and below it to all others
        own = [word() for _ in range(49)]
        twin = own[:23] + [word() for _ in range(26)]
        rows += [(i, " ".join(shared + own)), (i + 1, " ".join(shared + twin))]
        want[i] = want[i + 1] = i
    bags = {i: bag(text) for i, text in rows[:40]}
    assert all((similarity(bags[a], bags[b]) >= 0.8) == (want[a] == want[b]) for a, b in itertools.combinations(bags, 2))
    assert classes(neardup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


def brute_force(rows):
    """The least doc_id of every row's class, from all pairs."""
    bags, parent = {i: bag(text) for i, text in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(bags), 2):
        if similarity(bags[a], bags[b]) >= 0.8:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def test_near_copies_on_both_sides_of_the_limit_match_brute_force(spark, monkeypatch):
    draw = random.Random(1)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=6))
    rows = []
    for group in range(2):
        base = [word() for _ in range(120)]
        for i in range(200):
            w = list(base)
            for _ in range(2):
                w[draw.randrange(len(w))] = word()
            rows.append((group * 200 + i, " ".join(w)))
    want = brute_force(rows)
    assert 20 < len(set(want.values())) < 300
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(neardup.near_duplicate_classes(df).collect()) == want
    # the same classes when buckets are cut into many small blocks
    monkeypatch.setattr(neardup, "PART", 16)
    monkeypatch.setattr(neardup, "PART_ELEMENTS", 1 << 11)
    assert classes(neardup.near_duplicate_classes(df).collect()) == want


def test_overlaps_of_sets():
    texts = [" ".join(random.Random(i).choices("abc", k=30 + 5 * i)) for i in range(9)]
    sets = [neardup.elements_of(t) for t in texts]
    want = [[sum((bag(a) & bag(b)).values()) for b in texts] for a in texts]
    apart = ~np.eye(9, dtype=bool)  # an element that one set alone has is left out
    assert (neardup.overlaps(sets) == want)[apart].all()
    assert (neardup.overlaps(sets[:4], sets[4:]) == np.array(want)[:4, 4:]).all()
    assert [[neardup.common(a, b) for b in sets] for a in sets] == want
    assert neardup.overlaps([np.zeros(0, np.uint64)]).tolist() == [[0.0]]


def test_dropping_keeps_columns_named_as_our_own(spark):
    names = ["doc_id", "text", "near_node", "kept_node", "kept_id", "node", "id", "repeated", "Best"]
    rows = [(2**53 + 1, "one text of more than five words", *"abcdefg"), (2**53 + 3, "one text of more than five words", *"hijklmn"), (None, None, *"opqrstu")]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:])))
    assert kept.columns == names
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2]], key=str)
