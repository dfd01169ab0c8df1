"""Periodic runs, the conversation trie and document fingerprints against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from loomtext.llm import fingerprints, periodic, prefixtrie

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


# periodic runs


def plain_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and all(any(words[k] != words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def random_words(rnd, size=90):
    n, letters = rnd.randrange(size), rnd.choice([1, 2, 2, 3, 5])
    words = [rnd.choice("abcde"[:letters]) for _ in range(n)]
    if n and rnd.random() < 0.5:
        a = rnd.randrange(n)
        q = 1 + (n - a) // (3 + rnd.randrange(8))
        words = [words[i] if i < a else words[a + (i - a) % q] for i in range(n)]
    return words


def test_runs_of_random_texts(spark):
    rnd = random.Random(12)
    docs = [random_words(rnd) for _ in range(1500)]
    texts = [(i, rnd.choice(["", " ", "\t\n"]) + rnd.choice([" ", "\r\n", "\x0b\x0c "]).join(w)) for i, w in enumerate(docs)]
    got = {r["doc_id"]: r for r in periodic.periodic_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, words in enumerate(docs):
        runs = plain_runs(words)
        assert [tuple(r) for r in got[i]["runs"]] == runs and got[i]["n_words"] == len(words)
        assert got[i]["collapsed"] == collapsed(words, runs)


def test_runs_with_other_bounds(spark):
    rnd = random.Random(5)
    docs = [random_words(rnd, 40) for _ in range(300)]
    got = periodic.periodic_runs(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string"), least=9, repeats=5).collect()
    for r in got:
        assert [tuple(x) for x in r["runs"]] == [x for x in plain_runs(docs[r["doc_id"]]) if x[1] >= max(9, 5 * x[2])]
    with pytest.raises(ValueError):
        periodic.periodic_runs(spark.range(1).selectExpr("id AS doc_id", "'' AS text"), repeats=2)


@pytest.mark.parametrize("words", [["a"] * 300_000, [str(i % 1000) for i in range(300_000)], [str(-i) for i in range(100_000)]], ids=["one", "period", "falling"])
def test_runs_of_very_long_texts(words):
    text, counts = periodic._words(pa.array([" ".join(words), None]))
    doc, start, length, period = periodic._batch_runs(text, counts, 6, 4)
    n = len(set(words))
    want = [(0, 0, len(words), n)] if n <= 1000 else []
    assert list(zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True)) == want


def test_periodic_query_equals_the_plain_version(spark, sf, tmp_path):
    rnd = random.Random(2)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, " ".join(random_words(rnd))) for i in range(300)] + [(20_000, None), (20_000, None), (20_001, ""), (20_002, "a\x1cb c  d\x0be")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if n < 2000 else None
        if runs is None:
            continue
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        milli = best[1] and 1000 * best[1] // best[2]
        want.append((doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    got = [tuple(r) for r in periodic.op12_periodic_run_detection(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) and len(want) > 400
    known = {w[0] for w in want}
    assert sorted((g for g in got if g[0] in known), key=str) == sorted(want, key=str)


def test_periodic_edge_cases(spark, odd, none):
    got = periodic.periodic_runs(odd).collect()
    assert len(got) == odd.count() and {r["doc_id"] for r in got} == {1, 2, None, 3, 4, 5, 6}
    assert [(r["n_words"], r["runs"], r["collapsed"]) for r in got if r["doc_id"] in (2, 3)] == [(0, [], "")] * 2
    long = next(r for r in got if r["doc_id"] == 5)
    assert long["runs"] == [(0, 24_000, 6)] and long["collapsed"] == "Long words go on and on."
    assert periodic.periodic_runs(none).collect() == []


# conversation trie


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn, role or "", text or ""))
    order = lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16])
    own = {c: [t[1:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        whole[c] = (own.get(c - c % 100, []) if c is not None else [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c in sorted(whole, key=lambda c: (c is None, c or 0)):
        for d in range(len(whole[c]) + 1):
            nodes[tuple(whole[c][:d])].append(c)
    children = defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, members in nodes.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members) - 1) * len(node[-1][1]) if node else 0
    name = lambda c: "" if c is None else str(c)
    return sorted(
        ((m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k], sha(",".join(name(c) for c in m if len(whole[c]) == len(k)))) for k, m in nodes.items()),
        key=str,
    )


def conversations(rnd, n):
    rows = []
    for c in rnd.sample(range(-150, 900), n):
        rows += [(c, t if rnd.random() < 0.95 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "", None, "é😀"])) for t in range(rnd.choice([1, 2, 3, 5, 9]))]
    copies = [[(c, t, "user", f"turn {t}") for t in range(4)] for c in range(1000, 1040)]
    rows += [r for rows in copies for r in rows] + [(None, 1, "user", "a"), (None, 0, None, None), (7_007, 0, "user", "x"), (7_007, 0, "user", "x")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [5, 40, 2_000_000])
def test_trie_equals_the_plain_version(spark, shard_turns):
    rows = conversations(random.Random(shard_turns), 250)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = prefixtrie.prefix_trie(prefixtrie.conversation_paths(frame), shard_turns)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_trie(rows)


def test_trie_of_long_and_empty_input(spark):
    kinds = "conv_id long, turn long, role string, text string"
    assert prefixtrie.prefix_trie(prefixtrie.conversation_paths(spark.createDataFrame([], kinds))).collect() == []
    rows = [(c, t, "user", "x" * (t % 3)) for c in (0, 1) for t in range(3000)]
    got = prefixtrie.prefix_trie(prefixtrie.conversation_paths(spark.createDataFrame(rows, kinds))).collect()
    assert len(got) == 3001 and {(r["conv_id"], r["n_convs"], r["n_leaves"]) for r in got} == {(0, 2, 1)}
    assert max(r["saved_tokens"] for r in got) == 3000


def test_trie_ignores_other_columns_and_reads_any_integer_id(spark):
    rows = [(c, t, "user", "hello", 1, "x") for c in (1, 2) for t in range(2)]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, depth int, path string")
    assert sorted(tuple(r)[:4] for r in prefixtrie.prefix_trie(prefixtrie.conversation_paths(frame)).collect())[0][:2] == (1, 0)


def test_level_order_bits():
    one, two, three = (bytes([k]) * 16 for k in (1, 2, 3))
    trie = prefixtrie.LevelOrderTrie([b"", one, one + two, three], [b"", b"\1\0\0\0", b"\1\0\0\0\2\0\0\0", b"\3\0\0\0"])
    assert "".join(map(str, trie.bits.astype(int))) == "1101000"  # root: two children; 1: one; 3: none; 1-2: none
    assert trie.parent.tolist() == [-1, 0, 0, 1] and trie.depth.tolist() == [0, 1, 1, 2] and trie.end.tolist() == [0, 1, 3, 2]


def test_succinct_tries_hold_all_nodes(spark):
    rows = conversations(random.Random(1), 100)
    paths = prefixtrie.conversation_paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    labels = set()
    for r in prefixtrie.succinct_tries(paths, 50).collect():
        bits = np.unpackbits(np.frombuffer(r["louds"], np.uint8))[: 2 * r["n_nodes"] - 1]
        assert bits.sum() == r["n_nodes"] - 1 and len(r["labels"]) == 16 * r["n_nodes"] and len(r["ends"]) == 8 * r["n_paths"]
        labels |= {r["labels"][i : i + 16] for i in range(0, len(r["labels"]), 16)}
    assert len(labels) == len(plain_trie(rows))


# fingerprints

_MASK = (1 << 64) - 1


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & _MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & _MASK
    return x ^ (x >> 31)


def plain_fingerprint(text):
    data = bytes(6) + (text or "").encode()
    hashes = [plain_mix(int.from_bytes(data[i : i + 7])) for i in range(len(data) - 6)]

    def signature(size):
        out, total, inside = "", 0, False
        for h in hashes:
            total, inside = total + h & _MASK, True
            if ((h & 0xFFFFFFFF) + 1) % size == 0:
                out, total, inside = out + chr(fingerprints._ALPHABET[plain_mix(total) >> 58]), 0, False
        return out + chr(fingerprints._ALPHABET[plain_mix(total) >> 58]) * inside

    size = 3
    while len(signature(size)) > 64:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def plain_likeness(one, other):
    def alike(a, b):
        a, b = (re.sub(r"(.)\1{3,}", r"\1\1\1", x) for x in (a, b))
        k = min(7, -(-min(len(a), len(b)) // 2))
        if not k or not {a[i : i + k] for i in range(len(a) - k + 1)} & {b[i : i + k] for i in range(len(b) - k + 1)}:
            return 0.0
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last if x == y else last + 2)
        return 1 - d[-1] / (len(a) + len(b))

    if one == other:
        return 1.0
    sides = [{int(n): s for n, s in ((f.split(":")[0], f.split(":")[1]), (2 * int(f.split(":")[0]), f.split(":")[2]))} for f in (one, other)]
    return max((alike(sides[0][n], sides[1][n]) for n in sides[0].keys() & sides[1].keys()), default=0.0)


def random_texts(rnd, n):
    return ["", "a", "ab", "x" * 40, "x" * 900, "é漢😀" * 100, *["".join(rnd.choice("abcde fghé") for _ in range(rnd.randrange(1, 4000))) for _ in range(n)]]


def test_fingerprints_of_random_texts(monkeypatch):
    texts = random_texts(random.Random(3), 60)
    want = [plain_fingerprint(t) for t in texts]
    assert fingerprints.fingerprints(texts) == want and fingerprints.fingerprints(texts[::-1]) == want[::-1]
    monkeypatch.setattr(fingerprints, "BLOCK_BYTES", 200)  # every text on its own, in blocks
    assert fingerprints.fingerprints(texts) == want
    assert fingerprints.fingerprints([None]) == ["3::"]


def test_likeness_equals_the_plain_edit_distance():
    rnd = random.Random(4)
    texts = random_texts(rnd, 40)
    cut = lambda t: t[: rnd.randrange(len(t) + 1)] + rnd.choice(["", "zzz", "new words"]) + t[rnd.randrange(len(t) + 1) :]
    prints = [plain_fingerprint(t) for t in texts + [cut(t) for t in texts]]
    pairs = [(p, q) for p in prints for q in prints]
    assert all(abs(fingerprints.compare(p, q) - plain_likeness(p, q)) < 1e-12 for p, q in pairs)
    assert sum(0 < fingerprints.compare(p, q) < 1 for p, q in pairs) > 20


def plain_neighbours(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        mine, its, theirs = map(plain_fingerprint, (text, edited, after))
        out.append((i, len(text), sha(edited), mine, its, plain_likeness(mine, its), plain_likeness(mine, theirs)))
    return out


@pytest.mark.parametrize("n", [1, 2, 150])
def test_neighbours_equal_the_plain_version(spark, tmp_path, n):
    texts = random_texts(random.Random(n), 150)[-n:]
    rows = [(None if i == 1 else 3 * i - 100, t) for i, t in enumerate(texts)]
    if n > 100:
        rows[5] = (rows[5][0], None)
    random.Random(n).shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, part int").repartition(5)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fingerprints.op13_document_fingerprints(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    close = lambda rows: sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows), key=str)
    assert close(got) == close(plain_neighbours(rows))


def test_neighbours_of_repeated_rows_and_of_none(spark, odd, none):
    got = fingerprints.compare_neighbours(odd).collect()
    assert len(got) == odd.count() and {r["fingerprint"] for r in got if r["doc_id"] in (2, 3, 4)} == {"3::"}
    assert all(r["near_edited"] > 0.5 for r in got if r["doc_id"] == 1)
    assert fingerprints.compare_neighbours(none).collect() == []


def test_fingerprint_columns(spark):
    rows = spark.createDataFrame([("the quick brown fox " * 20, "the quick brown fox " * 20 + "end"), (None, "a")], "a string, b string")
    got = rows.select(fingerprints.fingerprint("a").alias("a"), fingerprints.fingerprint("b").alias("b")).select("a", fingerprints.likeness("a", "b").alias("x")).collect()
    assert got[0]["x"] > 0.5 and got[1]["a"] == "3::" and got[1]["x"] == 0
