"""Operator 13: document fingerprints by context-triggered piecewise hashing.

A text is its UTF-8 bytes. A hash rolls over every window of WINDOW bytes (zeros stand before the first byte); where the hash plus one is
divisible by the block size, a chunk ends, so chunks depend on what stands around their ends and an edit changes only the chunks it
touches. Block sizes are 3 * 2^k, and the boundaries of one are among those of the half of it. A fingerprint takes the least block
size that leaves at most CHARS chunks, and reads `size:signature:signature`: one character for each chunk at that size and at twice it.
A chunk's character comes from the sum of its windows' hashes, so every byte of a text counts.

Two fingerprints are compared where their block sizes are equal or one is twice the other: likeness is 1 - d / (n + m) for the edit
distance d (insertions and deletions) of two signatures of one block size with n and m characters, the better one where both
sizes are shared. Runs of one character count three times at most, and signatures without a common piece of PIECE characters (half of the shorter
one where that is less) have likeness 0, as have other block sizes. Equal fingerprints have likeness 1.

Neighbours in the order of doc_id are met in ranges of it: texts are shuffled once, a task streams its range and holds one batch, and only
the first and the last text of each range are written for the step across its border.

Defined cases: a null text is empty; an empty text has the fingerprint `3::`, which is like itself only; null ids come first; rows of one
doc_id are ordered by a hash of their text, repeated rows in any order (they are alike); a single row is its own next one; an empty table
gives an empty result. Ids are passed on untouched. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..session import materialise_small, table
from .textcore import batches, mix

WINDOW = 7
LEAST_BLOCK = 3
CHARS = 64
PIECE = 7
#: Bytes whose windows are in memory at once.
BLOCK_BYTES = 1 << 20
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)


def _boundaries(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of bytes with WINDOW - 1 bytes of context before them: running sums of the windows' hashes, and positions and levels of all chunk ends.

    An end of level k is one at the block sizes 3, 6, ... 3 * 2^k.
    """
    wide = data.astype(np.uint64)
    two = wide[1:] | wide[:-1] << np.uint64(8)
    four = two[2:] | two[:-2] << np.uint64(16)
    three = two[1:] | wide[:-2] << np.uint64(16)
    hashes = mix(four[3:] | three[: len(four) - 3] << np.uint64(32))
    roll = (hashes & np.uint64(0xFFFFFFFF)) + np.uint64(1)
    at = np.flatnonzero(roll % np.uint64(LEAST_BLOCK) == 0)
    low = roll[at]
    levels = np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64)
    return np.cumsum(hashes), at, levels


def _signature(sums: np.ndarray, before: np.uint64) -> str:
    """One character for each chunk, from the sums at the chunks' ends and the sum before the text."""
    edges = np.concatenate((np.array([before], dtype=np.uint64), sums))
    found = _ALPHABET[(mix(edges[1:] - edges[:-1]) >> np.uint64(58)).astype(np.int64)]
    return found.tobytes().decode("ascii")


def _written(level: int, at: np.ndarray, levels: np.ndarray, sums: np.ndarray, before: np.uint64, last: int, total: np.uint64) -> str:
    """The fingerprint from the ends of at least this level."""
    parts = []
    for k in (level, level + 1):
        pick = levels >= k
        ends, values = at[pick], sums[pick]
        if last >= 0 and (not len(ends) or ends[-1] != last):
            values = np.append(values, total)
        parts.append(_signature(values, before))
    return ":".join((str(LEAST_BLOCK << level), *parts))


def _least_level(levels: np.ndarray, of_last: int) -> int:
    """The least level whose ends leave at most CHARS chunks; the last byte, whose own level is given (-1: no end), ends one in any case."""
    above = np.cumsum(np.bincount(levels, minlength=34)[::-1])[::-1]
    return int(np.argmax(above + (np.arange(len(above)) > of_last) <= CHARS))


def _of_long(data: bytes) -> str:
    """The fingerprint of one text, block by block; ends that no longer can be in a signature are dropped on the way."""
    carry, total, least = np.zeros(WINDOW - 1, dtype=np.uint8), np.zeros(1, np.uint64), 0
    at, levels, values = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for begin in range(0, len(data), BLOCK_BYTES):
        block = np.concatenate((carry, np.frombuffer(data, np.uint8, min(BLOCK_BYTES, len(data) - begin), begin)))
        sums, found, level = _boundaries(block)
        keep = level >= least
        at, levels = np.concatenate((at, found[keep] + begin)), np.concatenate((levels, level[keep]))
        values = np.concatenate((values, sums[found[keep]] + total))
        total = total + sums[-1:]
        least = max(least, _least_level(levels, 99))
        keep = levels >= least
        at, levels, values, carry = at[keep], levels[keep], values[keep], block[-(WINDOW - 1) :]
    last = len(data) - 1
    of_last = int(levels[-1]) if len(at) and at[-1] == last else -1
    return _written(max(least, _least_level(levels, of_last)), at, levels, values, np.uint64(0), last, total[0])


def fingerprints(texts: Sequence[str | None]) -> list[str]:
    """The fingerprint of every text."""
    out: list[str] = []
    for cut in batches(texts, BLOCK_BYTES // 4):
        coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts[cut]]
        if len(coded) == 1:
            out.append(_of_long(coded[0]) if coded[0] else f"{LEAST_BLOCK}::")
            continue
        pad = bytes(WINDOW - 1)
        sums, at, levels = _boundaries(np.frombuffer(pad + pad.join(coded), np.uint8))
        starts = np.cumsum([0, *[len(c) + WINDOW - 1 for c in coded]])
        bounds = np.searchsorted(at, np.column_stack((starts[:-1], starts[:-1] + [len(c) for c in coded])))
        for (low, high), begin, data in zip(bounds.tolist(), starts.tolist(), coded, strict=False):
            if not data:
                out.append(f"{LEAST_BLOCK}::")
                continue
            own, last = at[low:high], begin + len(data) - 1
            before = sums[begin - 1] if begin else np.uint64(0)
            of_last = int(levels[high - 1]) if high > low and own[-1] == last else -1
            level = _least_level(levels[low:high], of_last)
            out.append(_written(level, own, levels[low:high], sums[own], before, last, sums[last]))
    return out


def _short_runs(signature: str) -> str:
    """Runs of one character have three of it at most."""
    return "".join(c for i, c in enumerate(signature) if i < 3 or not signature[i - 3] == signature[i - 2] == signature[i - 1] == c)


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by one addition on the bits of b's characters for each of a's."""
    masks: dict[str, int] = {}
    for i, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(b)) - 1
    free = full
    for c in a:
        hit = free & masks.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(b) - free.bit_count()


def _alike(a: str, b: str) -> float:
    a, b = _short_runs(a), _short_runs(b)
    shorter = min(len(a), len(b))
    if not shorter:
        return 0.0
    piece = min(PIECE, (shorter + 1) // 2)
    if {a[i : i + piece] for i in range(len(a) - piece + 1)}.isdisjoint(b[i : i + piece] for i in range(len(b) - piece + 1)):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def compare(one: str, other: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if one == other:
        return 1.0
    (size, *own), (also, *its) = one.split(":"), other.split(":")
    size, also = int(size), int(also)
    if size == also:
        return max(_alike(own[0], its[0]), _alike(own[1], its[1]))
    if size == 2 * also:
        return _alike(own[0], its[1])
    return _alike(own[1], its[0]) if also == 2 * size else 0.0


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.pandas_udf("string")
    def run(found: pd.Series) -> pd.Series:
        return pd.Series(fingerprints([t if isinstance(t, str) else None for t in found]))

    return run(text)


def likeness(one: Column, other: Column) -> Column:
    """Likeness of two columns of fingerprints; null where one is null."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([compare(x, y) if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b, strict=True)], dtype="float64")

    return run(one, other)


def splice(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_KINDS = {"n_chars": LongType(), "edited_sha256": StringType(), "fingerprint": StringType(), "edited_fingerprint": StringType(), "near_edited": DoubleType(), "near_next": DoubleType()}


def _compared(texts: list[str], prints: list[str], edit: Callable[[str, str], str]) -> list[tuple]:
    """What _KINDS names, of every text but the last, which is the following one of the last but one."""
    edited = [edit(t, n) for t, n in zip(texts, texts[1:], strict=False)]
    found = zip(texts, edited, prints, fingerprints(edited), prints[1:], strict=False)
    return [(len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), p, q, compare(p, q), compare(p, n)) for t, e, p, q, n in found]


def compare_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edit: Callable[[str, str], str] = splice) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document, by ascending doc_id (after the last: the first).

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. `edit` takes a text and the next one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    plain = [rows.schema["doc_id"], *[StructField(n, k) for n, k in _KINDS.items()]]
    schema = StructType([*plain, StructField("part", IntegerType()), StructField("first", BooleanType()), StructField("body", StringType())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kind = TaskContext.get().partitionId(), None
        held: tuple | None = None  # id, text and fingerprint of the last row so far

        def out(ids: list, results: list[tuple], tails: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*results, strict=True)) if results else [()] * len(_KINDS)
            types = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.bool_(), pa.string()]
            whole = [*columns, *zip(*tails, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *[pa.array(c, t) for c, t in zip(whole, types, strict=True)]], schema.names)

        nothing = (None,) * len(_KINDS)
        for batch in found:
            kind = batch.schema.field("doc_id").type
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            prints = fingerprints(texts)
            if held is None and texts:
                yield out([None], [nothing], [(part, True, texts[0])])
            elif texts:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
            if len(texts) > 1:
                yield out(ids[:-1], _compared(texts, prints, edit), [(part, None, None)] * (len(ids) - 1))
            if texts:
                held = ids[-1], texts[-1], prints[-1]
        if held is not None:
            yield out([held[0]], [nothing], [(part, False, held[1])])

    done = materialise_small(rows.mapInArrow(run, schema), "fingerprints")
    # the rows at the borders: two for each range, of which the driver sees the numbers of the ranges
    parts = sorted(r["part"] for r in done.where("first").select("part").collect())
    following = spark.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, after int")
    heads = done.where("first").select(F.col("part").alias("after"), F.col("body").alias("next_text"))
    lasts = done.where("NOT first").select("doc_id", "part", "body").join(F.broadcast(following), "part").join(heads, "after").select("doc_id", "body", "next_text")

    def across(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            results = [_compared([t, n], fingerprints([t, n]), edit)[0] for t, n in zip(batch.column("body").to_pylist(), batch.column("next_text").to_pylist(), strict=True)]
            types = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            columns = list(zip(*results, strict=True)) if results else [()] * len(_KINDS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], ["doc_id", *_KINDS])

    borders = materialise_small(lasts.mapInArrow(across, StructType(plain)), "borders")
    return done.where("first IS NULL").select("doc_id", *_KINDS).unionByName(borders)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document beside its edited text and the next document."""
    return compare_neighbours(table(spark, sf_dir, "documents"))
