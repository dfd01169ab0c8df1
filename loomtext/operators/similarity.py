"""Similar texts: word shingles, exact and banded retrieval, verified edges, greedy keep and grouping.

A shingle is a 64-bit hash of `width` consecutive words (with inner apostrophes) of the normalized text. Exact mode finds
every pair of at least the threshold. Shingles are ordered by value, those known to be common behind all others, and two sets of Jaccard similarity s
or more share one of the first n - ceil(s n) + 1 (prefix), whatever the order. Where they share one, its places bound how much can be common (position), and so
does the number of those that they share, with all shingles behind the prefix (count). Only prefixes, and the whole sets of candidates, are ever shuffled;
of Texts, whole sets are made again for the candidates, so none is ever written.
Banded mode retrieves by MinHash bands.

What shares a shingle or a band is a bucket. It is cut into blocks of some PART sets, and every two blocks are a cell: a task reads its cells one
after the other and compares them in arrays, so what doesn't pass the bounds never is a row, and a bucket of any size has cells of bounded size.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lowered, normalized
from ..session import discard, materialise, written
from .graph import connected_components

WIDTH = 7
BANDS, ROWS = 16, 8
#: Sets of a block, of which every two of a bucket meet.
PART = 256
#: Shingles that are read to learn which are common, and how often one must be among them. They only order the shingles, which no result depends on.
ORDER_SHINGLES, COMMON = 4_000_000, 4
#: Postings (an id and two numbers) up to which `overlaps` broadcasts its other side; beyond, both sides are shuffled.
BROADCAST_POSTINGS = 500_000
#: Ids up to which they are broadcast to what they pick or leave out; beyond, that is shuffled.
BROADCAST_IDS = 1_000_000
#: Shingles of prefixes that a task holds before it deals them out, and about how many of them meet in one row's worth of work.
HELD, BUCKET = 1_000_000, 500_000
#: The modulus of the permutations, and the bits of a value that a signature keeps.
PRIME, VALUE = (1 << 61) - 1, (1 << 32) - 1
_WORD = re.compile(r"\w+(?:['’]\w+)*")


def _words(plain: str, marked: bool) -> list[str]:
    marks = "".join(c for c in set(plain) if unicodedata.category(c)[0] == "M") if marked and not plain.isascii() else ""
    return (re.compile(rf"[\w{marks}]+(?:['’][\w{marks}]+)*") if marks else _WORD).findall(plain)


def shingle_sets(rows: DataFrame, id: str = "id", text: str = "text", width: int = WIDTH, as_sql: bool = False) -> DataFrame:
    """(id, shingles array<long> sorted and distinct, words) of every row; texts of fewer words have an empty set. Ids pass untouched, null ones too.

    A shingle is the first eight bytes of the MD5 of its words joined by blanks, which SQL can compute as well, less 2^63. With `as_sql`, texts are
    lower-cased only, and combining marks belong to words, as in the SQL of the queries.
    """
    kind = rows.schema[id].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sets, counts = [], []
            for body, plain in zip(batch.column("text").to_pylist(), batch.column("plain").to_pylist(), strict=True):
                words = [w.encode() for w in _words(plain or "", as_sql)]
                each = b"".join({hashlib.md5(b" ".join(words[i : i + width]), usedforsecurity=False).digest()[:8] for i in range(len(words) - width + 1)})
                sets.append(np.sort((np.frombuffer(each, dtype=">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)))
                counts.append(len((body or "").split()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.list_(pa.int64())), pa.array(counts, pa.int64())], ["id", "shingles", "words"])

    slim = rows.select(F.col(id).alias("id"), F.col(text).alias("text"), (lowered if as_sql else normalized)(F.col(text)).alias("plain"))
    return slim.mapInArrow(run, f"id {kind}, shingles array<bigint>, words long")


@dataclass(frozen=True)
class Texts:
    """Rows whose shingle sets are made wherever they are needed, and never written as a whole."""

    rows: DataFrame
    id: str = "id"
    text: str = "text"
    width: int = WIDTH
    as_sql: bool = False

    def sets(self, rows: DataFrame | None = None) -> DataFrame:
        return shingle_sets(self.rows if rows is None else rows, self.id, self.text, self.width, self.as_sql)

    def some(self, shingles: int) -> DataFrame:
        """Sets of rows with about so many shingles, of six characters each."""
        length = self.rows.agg(F.sum(F.length(self.text).cast("long"))).first()[0] or 0
        return self.sets(self.rows.where(F.pmod(F.xxhash64(self.id), F.lit(max(1, -(-length // (6 * shingles))))) == 0))

    def named(self, ids: DataFrame) -> DataFrame:
        """The sets of a working table of ids (id)."""
        return self.sets(self.rows.join(_listed(ids).withColumnRenamed("id", self.id), self.id, "left_semi"))


def _listed(ids: DataFrame) -> DataFrame:
    """ids, to be broadcast up to a bounded number of them; a working table."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def jaccard(a, b):
    """Jaccard similarity of two arrays of distinct values; 0 when both are empty."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def _sets_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets that pairs (first, second) name, so that no others are shuffled; pairs is a working table."""
    ids = pairs.select(F.col("first").alias("id")).unionByName(pairs.select(F.col("second").alias("id"))).distinct()
    return sets.join(materialise(ids, "named"), "id", "left_semi")


def pair_scores(pairs: DataFrame, sets: DataFrame, minimum: float = 0.0) -> DataFrame:
    """(first, second, jaccard, word_ratio) of pairs of at least `minimum`; the size bound comes before the sets are compared."""
    pairs = written(pairs, "named-pairs")
    named = _sets_of(pairs, sets)
    side = lambda name: named.select(F.col("id").alias(name), F.col("shingles").alias(f"{name}_set"), F.col("words").alias(f"{name}_words"))
    both = pairs.join(side("first"), "first").join(side("second"), "second")
    a, b = F.size("first_set"), F.size("second_set")
    both = both.where(F.least(a, b) >= minimum * F.greatest(a, b))
    scored = both.withColumn("jaccard", jaccard(F.col("first_set"), F.col("second_set"))).where(F.col("jaccard") >= minimum)
    ratio = F.least("first_words", "second_words") / F.greatest("first_words", "second_words")
    return scored.select("first", "second", "jaccard", ratio.alias("word_ratio"))


def _digests(sets: DataFrame) -> DataFrame:
    """(id, words, n, digest) of every set that has an id and isn't empty."""
    kind = sets.schema["id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            values, ends = batch.column("shingles").values.to_numpy(), batch.column("shingles").offsets.to_numpy()
            each = [hashlib.md5(values[lo:hi].tobytes(), usedforsecurity=False).digest() for lo, hi in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("words"), pa.array(np.diff(ends), pa.int64()), pa.array(each, pa.binary())], ["id", "words", "n", "digest"])

    whole = sets.where((F.size("shingles") > 0) & F.col("id").isNotNull())
    return whole.select("id", F.col("words").cast("long").alias("words"), "shingles").mapInArrow(run, f"id {kind}, words long, n long, digest binary")


def _copies(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, pairs) of rows (id, words, digest): copies (id, words, least) with the least id of their equals, and the pairs of others with it."""
    # equal sets collapse before anything is paired: a group of n copies makes n-1 pairs with its least id
    least = keyed.groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("copies")).where("copies > 1")
    copies = materialise(keyed.select("id", "words", "digest").join(least, "digest").select("id", "words", "least"), "copies")
    words = copies.where("id = least").select("least", F.col("words").alias("least_words"))
    ratio = F.least("words", "least_words") / F.greatest("words", "least_words")
    return copies, copies.where("id <> least").join(words, "least").select(F.col("least").alias("first"), F.col("id").alias("second"), F.lit(1.0).alias("jaccard"), ratio.alias("word_ratio"))


def _collapsed(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, ones): pairs of copies with the least id of their equals, and one row a set, of those that have an id and aren't empty. Whole sets are written once."""
    sets = written(sets, "shingles")
    copies, pairs = _copies(materialise(_digests(sets), "sets"))
    whole = sets.where((F.size("shingles") > 0) & F.col("id").isNotNull())
    return pairs, whole.join(materialise(copies.where("id <> least").select("id"), "left-out"), "id", "left_anti")


def _cells(members: DataFrame, bucket: str, compare: Callable[[dict[str, list], np.ndarray, np.ndarray], list[tuple]], schema: str, payload: DataFrame | None = None) -> DataFrame:
    """What `compare` finds in every two blocks of every bucket of members (bucket, id and more); buckets of one are left out. A payload (id and more) joins the members once their cells are known.

    `compare` takes the columns of a cell as lists and the places of its two sides (the same ones for a block with itself), and returns rows.
    """
    parts = members.groupBy(bucket).agg(F.count("*").alias("_n")).where("_n > 1").select(bucket, F.ceil(F.col("_n") / F.lit(PART)).cast("int").alias("_parts"))
    dealt = members.join(parts, bucket).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    cell = F.xxhash64(F.col(bucket), F.least("_own", "_other"), F.greatest("_own", "_other"))
    dealt = dealt.select(bucket, F.least("_own", "_other").alias("_row"), F.greatest("_own", "_other").alias("_col"), F.when(F.col("_own") <= F.col("_other"), 0).otherwise(1).alias("_side"), cell.alias("_cell"), *[c for c in members.columns if c != bucket])
    keys = [bucket, "_row", "_col"]
    if payload is not None:
        dealt = payload.join(_listed(materialise(dealt, "cells")), "id").select(*dealt.columns, *[c for c in payload.columns if c != "id"])
    dealt = dealt.repartition("_cell").sortWithinPartitions(*keys)
    names = [n for n in dealt.columns if n not in (*keys, "_cell")]
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the batches of the cell that is being read
        now = None
        kind: dict[str, pa.DataType] = {}

        def finish() -> list[tuple]:
            columns = {n: [v for b in held for v in b.column(n).to_pylist()] for n in names}
            side = np.array(columns.pop("_side"))
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            return compare(columns, left, left if now[1] == now[2] else right)

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind["id"] if n in ("first", "second") else pa.float64()) for n, c in zip(fields, zip(*rows, strict=True), strict=True)], fields)

        out: list[tuple] = []
        for batch in found:
            kind["id"] = batch.schema.field("id").type
            cells = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
            begin = 0
            for end in range(1, len(cells) + 1):
                if end < len(cells) and cells[end] == cells[begin]:
                    continue
                if cells[begin] != now:
                    if held:
                        out += finish()
                    held, now = [], cells[begin]
                held.append(batch.slice(begin, end - begin))
                begin = end
            if len(out) > 10_000:
                yield packed(out)
                out = []
        if held:
            out += finish()
        if out:
            yield packed(out)

    return dealt.mapInArrow(run, schema)


def _common_shingles(sets: DataFrame | Texts) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, ascending, that are common among some ORDER_SHINGLES, and how often they were met there."""
    if isinstance(sets, Texts):
        some = sets.some(ORDER_SHINGLES)
    else:
        total = sets.agg(F.sum(F.size("shingles").cast("long"))).first()[0] or 0
        some = sets.where(F.pmod(F.xxhash64("id"), F.lit(max(1, -(-total // ORDER_SHINGLES)))) == 0)
    found = some.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).toArrow()
    values, counts = found.column("shingle").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(values)
    return values[order], counts[order]


def summaries(sets: DataFrame | Texts, minimum: float = 0.8) -> DataFrame:
    """(id, words, n, digest, prefix) of every set: its size, a digest, and its first shingles in the order of the operator; a working table."""
    common, counts = _common_shingles(sets)
    sets = sets.sets() if isinstance(sets, Texts) else sets
    kind = sets.schema["id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            values, ends = batch.column("shingles").values.to_numpy(), batch.column("shingles").offsets.to_numpy()
            each = [hashlib.md5(values[lo:hi].tobytes(), usedforsecurity=False).digest() for lo, hi in zip(ends, ends[1:], strict=False)]
            sizes = np.diff(ends)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            values = values[ends[0] : ends[-1]]
            rank = np.zeros(len(values), dtype=np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, values), len(common) - 1)
                rank = np.where(common[at] == values, counts[at], 0)
            order = np.lexsort((values, rank, row))
            place = np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes) + 1
            taken = place <= (sizes - np.ceil(sizes * minimum - 1e-9).astype(np.int64) + 1)[row]
            bounds = np.concatenate([[0], np.cumsum(np.bincount(row[taken], minlength=batch.num_rows))])
            prefix = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values[order][taken], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("words"), pa.array(sizes, pa.int64()), pa.array(each, pa.binary()), prefix], ["id", "words", "n", "digest", "prefix"])

    slim = sets.select("id", F.col("words").cast("long").alias("words"), F.coalesce("shingles", F.array().cast("array<long>")).alias("shingles"))
    return materialise(slim.mapInArrow(run, f"id {kind}, words long, n long, digest binary, prefix array<long>"), "sets")


def _met_prefixes(ones: DataFrame) -> DataFrame:
    """(shingle, id, n, place) of the shingles of prefixes that more than one set of ones (id, n, prefix) has there; places count from 1.

    Shingles go by hash to buckets, as arrays with 32 bits of the hash each, so a row costs a few bytes. Different shingles that share a bucket and
    these bits meet as if they were one, which adds candidates and takes none away.
    """
    kind = ones.schema["id"].dataType.simpleString()
    buckets = max(1, -(-(ones.agg(F.sum(F.size("prefix").cast("long"))).first()[0] or 0) // BUCKET))

    def deal(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ends = rows.column("prefix").offsets.to_numpy()
            sizes = np.diff(ends)
            row, place = np.repeat(np.arange(rows.num_rows), sizes), np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes) + 1
            h = rows.column("prefix").values.to_numpy()[ends[0] : ends[-1]].view(np.uint64)
            for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                h = (h ^ (h >> np.uint64(31))) * np.uint64(factor)
            h ^= h >> np.uint64(32)
            bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            present, begins = np.unique(bucket[order], return_index=True)
            bounds = pa.array(np.append(begins, len(order)), pa.int32())
            row = pa.array(row[order])
            lists = [pa.array((h & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)[order]), rows.column("id").take(row), rows.column("n").take(row).cast(pa.int32()), pa.array(place[order], pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), *[pa.ListArray.from_arrays(bounds, x) for x in lists]], ["bucket", "hashes", "ids", "ns", "places"])

        held, size = [], 0
        for batch in found:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                held.append(part)
                size += int(part.column("prefix").offsets[-1].as_py() - part.column("prefix").offsets[0].as_py())
                if size > HELD:
                    yield dealt(held)
                    held, size = [], 0
        if size:
            yield dealt(held)

    def meet(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(bucket: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, ids, ns, places = (pa.concat_arrays([b.column(c).flatten() for b in held]) for c in ("hashes", "ids", "ns", "places"))
            plain = hashes.to_numpy()
            order = np.argsort(plain, kind="stable")
            same = plain[order][1:] == plain[order][:-1]
            met = order[np.append(same, False) | np.append(False, same)]
            for begin in range(0, len(met), 100_000):
                some = met[begin : begin + 100_000]
                shingle = (np.int64(bucket) << np.int64(32)) | plain[some].view(np.uint32).astype(np.int64)
                some = pa.array(some)
                yield pa.RecordBatch.from_arrays([pa.array(shingle, pa.int64()), ids.take(some), ns.take(some), places.take(some)], ["shingle", "id", "n", "place"])

        held, now = [], None
        for batch in found:
            for begin, bucket in enumerate(batch.column("bucket").to_pylist()):
                if held and bucket != now:
                    yield from finish(now, held)
                    held = []
                held, now = [*held, batch.slice(begin, 1)], bucket
        if held:
            yield from finish(now, held)

    dealt = ones.select("id", "n", "prefix").mapInArrow(deal, f"bucket int, hashes array<int>, ids array<{kind}>, ns array<int>, places array<int>")
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, f"shingle long, id {kind}, n int, place int")


def prefix_candidates(ones: DataFrame, minimum: float = 0.8) -> DataFrame:
    """(first, second) of different sets that pass the bounds of size, prefix, position and count: a superset of the pairs of at least `minimum`."""
    return _meetings(summaries(ones, minimum).where("n > 0 AND id IS NOT NULL"), minimum)


def _meetings(ones: DataFrame, minimum: float) -> DataFrame:
    """The candidates among ones (id, n, prefix), a working table."""
    kind = ones.schema["id"].dataType.simpleString()
    members = materialise(_met_prefixes(ones), "prefixes")

    def compare(cell: dict[str, list], left: np.ndarray, right: np.ndarray) -> list[tuple]:
        n, place = np.array(cell["n"], dtype=np.int64), np.array(cell["place"], dtype=np.int64)
        rest = np.ceil(n * minimum - 1e-9) - 1  # shingles behind the prefix
        ids, out = cell["id"], []
        for i in left.tolist():
            others = right[right > i] if left is right else right
            m = n[others]
            needed = np.ceil(minimum * (n[i] + m) / (1 + minimum) - 1e-9)
            fit = (np.minimum(n[i], m) >= minimum * np.maximum(n[i], m) - 1e-9) & (np.minimum(place[i], place[others]) + np.minimum(n[i] - place[i], m - place[others]) >= needed)
            # of the two last shingles of the prefixes one comes first; what is common is shared by the prefixes, or behind that one
            least = needed - np.maximum(rest[i], rest[others])
            out += [(ids[i], ids[j], x) if ids[i] < ids[j] else (ids[j], ids[i], x) for j, x in zip(others[fit].tolist(), least[fit].tolist(), strict=True)]
        return out

    # every shared shingle of the prefixes meets once
    found = _cells(members, "shingle", compare, f"first {kind}, second {kind}, least double").where("first <> second")
    shared = found.groupBy("first", "second").agg(F.count("*").alias("shared"), F.min("least").alias("least"))
    return materialise(shared.where("shared >= least").select("first", "second"), "candidates")


def _scored(pairs: DataFrame, sets: DataFrame | Texts, minimum: float) -> DataFrame:
    """(first, second, jaccard, word_ratio) of all pairs of at least `minimum` among pairs (first, second) of different sets, a working table, and maybe more such pairs.

    Sets meet at the least id that has a pair with the first of theirs, so a group of near copies is sent there once and not once a pair.
    """
    home = pairs.groupBy(F.col("second").alias("first")).agg(F.min("first").alias("home"))
    routed = pairs.join(home, "first", "left").withColumn("home", F.coalesce("home", "first"))
    members = materialise(routed.select("home", F.col("first").alias("id")).unionByName(routed.select("home", F.col("second").alias("id"))).distinct(), "homes")
    kind = members.schema["id"].dataType.simpleString()
    if isinstance(sets, Texts):
        payload = sets.named(materialise(members.select("id").distinct(), "listed"))
    else:
        payload = sets
    return _cells(members, "home", _verified(minimum), f"first {kind}, second {kind}, jaccard double, word_ratio double", payload.select("id", "shingles", F.col("words").cast("long").alias("words"))).distinct()


def similar_pairs(sets: DataFrame | Texts, minimum: float = 0.8, among: DataFrame | None = None, keyed: DataFrame | None = None) -> DataFrame:
    """All pairs of at least `minimum` (first < second), exactly, of all sets or of those whose ids are in `among`. Equal sets are paired through one of them only.

    Summaries of the sets may be given; they are deleted.
    """
    if not isinstance(sets, Texts):
        sets = written(sets, "shingles")
    keyed = summaries(sets, minimum) if keyed is None else keyed
    mine = keyed.where("n > 0 AND id IS NOT NULL")
    if among is not None:
        mine = mine.join(_listed(written(among.select("id").distinct(), "among")), "id", "left_semi")
    copies, pairs = _copies(mine)
    ones = mine.join(_listed(materialise(copies.where("id <> least").select("id"), "left-out")), "id", "left_anti")
    found = _meetings(ones, minimum)
    discard(keyed)
    return _scored(found, sets, minimum).unionByName(pairs)


def permutations(count: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (1 on) and offsets of `count` permutations, 60 bits each, by a rule that SQL can follow: leading hexadecimal digits of MD5s."""
    draw = lambda name: [int(hashlib.md5(f"minhash:{seed}:{name}:{k}".encode(), usedforsecurity=False).hexdigest()[:15], 16) for k in range(count)]
    return np.array(draw("a"), dtype=np.uint64) + np.uint64(1), np.array(draw("b"), dtype=np.uint64)


def _permuted(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """((a x + b) mod PRIME) & VALUE of 32-bit x and all a and b below 2^61, in 64 bits: 2^61 is 1 modulo PRIME, so high limbs are added to low ones."""
    low31, low30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    fold = lambda v: (v & np.uint64(PRIME)) + (v >> np.uint64(61))
    high = fold(x * (a >> np.uint64(31)))  # below 2^61 + 2, times 2^31
    total = fold((high >> np.uint64(30)) + ((high & low30) << np.uint64(31)) + x * (a & low31) + b)
    total = np.where(total >= np.uint64(PRIME), total - np.uint64(PRIME), total)
    return total & np.uint64(VALUE)


def minhash_bands(sets: DataFrame, bands: int = BANDS, rows: int = ROWS, seed: int = 42) -> DataFrame:
    """(id, band): one row for each band of the MinHash signature of a set that isn't empty.

    A value is the least (a x + b) mod (2^61 - 1), cut to 32 bits, over the high 32 bits x of the shingles; a band is a digest of its number and values.
    """
    kind = sets.schema["id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(bands * rows, seed)
        for batch in found:
            taken, keys = [], []
            values, ends = batch.column("shingles").values.to_numpy(), batch.column("shingles").offsets.to_numpy()
            for row, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)):
                if lo == hi:
                    continue
                x = (values[lo:hi].view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
                least = np.full(bands * rows, VALUE, dtype=np.uint64)
                for start in range(0, len(x), 1024):  # memory stays bounded for long texts
                    least = np.minimum(least, _permuted(x[start : start + 1024, None], a[None, :], b[None, :]).min(axis=0))
                for k in range(bands):
                    taken.append(row)
                    keys.append(hashlib.md5(f"{k}:{','.join(map(str, least[k * rows : (k + 1) * rows].tolist()))}".encode(), usedforsecurity=False).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(taken, pa.int64())), pa.array(keys, pa.string())], ["id", "band"])

    return sets.select("id", "shingles").mapInArrow(run, f"id {kind}, band string")


def _verified(minimum: float) -> Callable[[dict[str, list], np.ndarray, np.ndarray], list[tuple]]:
    """Compares the sets of a cell: rows (first, second, jaccard, word_ratio) of at least `minimum`."""

    def compare(cell: dict[str, list], left: np.ndarray, right: np.ndarray) -> list[tuple]:
        shingles, words, ids, out = [np.array(x, dtype=np.int64) for x in cell["shingles"]], np.array(cell["words"]), cell["id"], []
        size = np.array([len(x) for x in shingles])
        values, at = np.unique(np.concatenate([shingles[j] for j in right.tolist()]), return_inverse=True)
        owner, count = np.repeat(np.arange(len(right)), size[right]), len(right)
        order = np.argsort(at, kind="stable")
        lists, bounds = owner[order], np.searchsorted(at[order], np.arange(len(values) + 1))  # who has each shingle
        for i in left.tolist():
            place = np.searchsorted(values, shingles[i])
            place = place[(place < len(values)) & (values[np.minimum(place, len(values) - 1)] == shingles[i])]
            met = [lists[bounds[p] : bounds[p + 1]] for p in place.tolist()]
            common = np.bincount(np.concatenate(met), minlength=count) if met else np.zeros(count, dtype=np.int64)
            score = common / (size[i] + size[right] - common)
            hits = np.flatnonzero(score >= minimum)
            for k in hits[right[hits] > i] if left is right else hits:
                j = int(right[k])
                ratio = min(words[i], words[j]) / max(words[i], words[j])
                out.append((*((ids[i], ids[j]) if ids[i] < ids[j] else (ids[j], ids[i])), float(score[k]), float(ratio)))
        return out

    return compare


def banded_pairs(sets: DataFrame, minimum: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """All pairs of at least `minimum` among those that share a band (approximate retrieval). Equal sets are paired through one of them only.

    Sets come to the cells of their buckets and are verified there, so only pairs of at least `minimum` are rows.
    """
    copies, ones = _collapsed(sets)
    ones = materialise(ones, "ones")
    kind = ones.schema["id"].dataType.simpleString()
    keys = materialise(minhash_bands(ones, bands, rows), "bands")
    crowded = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = keys.join(crowded, "band", "left_semi").join(ones, "id")

    found = _cells(members, "band", _verified(minimum), f"first {kind}, second {kind}, jaccard double, word_ratio double")
    return found.distinct().unionByName(copies)


def duplicate_edges(pairs: DataFrame, similarity: float = 0.92, word_ratio: float = 0.85) -> DataFrame:
    return pairs.where((F.col("jaccard") >= similarity) & (F.col("word_ratio") >= word_ratio))


def similarity_groups(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, similarity_group) for every id."""
    found = connected_components(pairs, "first", "second", nodes=ids.select("id"))
    return found.select(F.col("node").alias("id"), F.col("component").alias("similarity_group"))


def greedy_keep(ranked: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept ids, removed (removed_id, retained_id)) of rows (id, rank), rank being the order of preference.

    In order, a row is removed when it has a kept neighbour, and is otherwise kept; it is removed for the least id among those
    neighbours that were kept before it. Rounds decide all rows at once whose earlier neighbours are decided; ids without
    neighbours never enter a round.
    """
    order = ranked.select("id", "rank")
    ends = pairs.select(F.col("first").alias("id"), F.col("second").alias("other")).union(pairs.select("second", "first")).distinct()
    ranks = ends.join(order, "id").join(order.select(F.col("id").alias("other"), F.col("rank").alias("other_rank")), "other")
    earlier = materialise(ranks.where("other_rank < rank").select("id", "other"), "earlier")
    nodes = ends.select("id").distinct()
    state = materialise(nodes.join(earlier.select("id").distinct(), "id", "left_anti").withColumn("kept", F.lit(True)), "state")
    while True:
        open_ = earlier.join(state, "id", "left_anti")
        if open_.isEmpty():
            break
        known = open_.join(state.select(F.col("id").alias("other"), F.col("kept").alias("other_kept")), "other", "left")
        judged = known.groupBy("id").agg(F.max(F.coalesce("other_kept", F.lit(False))).alias("hit"), F.bool_and(F.col("other_kept").isNotNull()).alias("closed"))
        fresh = judged.where("hit OR closed").select("id", (~F.col("hit")).alias("kept"))
        state = materialise(state.unionByName(fresh), "state")
    gone = state.where("NOT kept").select("id")
    keepers = state.where("kept").select(F.col("id").alias("other"))
    removed = earlier.join(gone, "id", "left_semi").join(keepers, "other", "left_semi").groupBy("id").agg(F.min("other").alias("retained_id"))
    removed = removed.select(F.col("id").alias("removed_id"), "retained_id")
    return order.select("id").join(gone, "id", "left_anti"), removed


def keep_distinct(ranked: DataFrame, sets: DataFrame, pairs: DataFrame, similarity: float = 0.92, word_ratio: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """greedy_keep of rows (id, rank) over all duplicate edges among them, from pairs that link equal sets through their least id.

    Rows of equal sets and word counts have the same neighbours and each other, so only the first of them by rank can be kept;
    greedy_keep runs on these, and the others follow. The edges of a group of copies are never listed.
    """
    pairs = written(pairs, "pairs")
    least = pairs.where("jaccard = 1").select(F.col("second").alias("id"), F.col("first").alias("least"))
    members = sets.select("id", "words").join(ranked.select("id", "rank"), "id").join(least, "id", "left").withColumn("least", F.coalesce("least", "id"))
    members = materialise(members, "members")
    groups = members.groupBy("least", "words").agg(F.min(F.struct("rank", "id"))["id"].alias("best"), F.min("rank").alias("rank"), F.count("*").alias("n"))
    groups = materialise(groups, "groups")
    near = pairs.where((F.col("jaccard") >= similarity) & (F.col("jaccard") < 1)).select("first", "second")
    same = groups.groupBy("least").count().where("count > 1").select(F.col("least").alias("first"), F.col("least").alias("second"))
    side = lambda name: groups.select(F.col("least").alias(name), F.col("words").alias(f"{name}_words"), F.col("best").alias(f"{name}_best"))
    met = near.unionByName(same).join(side("first"), "first").join(side("second"), "second").where("first_best <> second_best")
    met = met.where(F.least("first_words", "second_words") / F.greatest("first_words", "second_words") >= word_ratio)
    edges = materialise(met.select(F.col("first_best").alias("first"), F.col("second_best").alias("second")), "edges")
    kept, gone = greedy_keep(groups.select(F.col("best").alias("id"), "rank"), edges)
    kept, gone = materialise(kept, "kept"), materialise(gone, "gone")
    copies = members.join(groups.where("n > 1").select("least", "words", "best"), ["least", "words"]).where("id <> best").select("id", "rank", "best")
    of_kept = copies.join(kept.select(F.col("id").alias("best")), "best", "left_semi").select(F.col("id").alias("removed_id"), F.col("best").alias("retained_id"))
    ends = edges.select(F.col("first").alias("best"), F.col("second").alias("other")).union(edges.select("second", "first")).distinct()
    others = ends.join(kept.join(ranked, "id").select(F.col("id").alias("other"), F.col("rank").alias("other_rank")), "other")
    of_gone = copies.join(gone.select(F.col("removed_id").alias("best")), "best", "left_semi").join(others, "best").where("other_rank < rank")
    of_gone = of_gone.groupBy("id").agg(F.min("other").alias("retained_id")).withColumnRenamed("id", "removed_id")
    removed = materialise(gone.unionByName(of_kept).unionByName(of_gone), "removed")
    return ranked.select("id").join(removed.select(F.col("removed_id").alias("id")), "id", "left_anti"), removed


def overlaps(sets: DataFrame, others: DataFrame, minimum: float) -> DataFrame:
    """(id, other_id, containment): share of the other text's shingles that a text holds, at least `minimum`. Rows of one id are one text; others without an id are none."""
    left = sets.select("id", F.explode("shingles").alias("shingle"))
    right = materialise(others.where("id IS NOT NULL").select(F.col("id").alias("other_id"), F.explode("shingles").alias("shingle")).distinct(), "postings")
    size = right.groupBy("other_id").agg(F.count("*").alias("n"))
    if right.count() <= BROADCAST_POSTINGS:
        right, size = F.broadcast(right), F.broadcast(size)
    # a shingle counts once for an id, however many rows have it
    common = left.join(right, "shingle").distinct().groupBy("id", "other_id").agg(F.count("*").alias("c")).join(size, "other_id")
    return common.select("id", "other_id", (F.col("c") / F.col("n")).alias("containment")).where(F.col("containment") >= minimum)
