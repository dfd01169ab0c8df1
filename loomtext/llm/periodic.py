"""Operator 12: periodic run detection by Lyndon roots.

A run is a stretch of consecutive words with least period q (words q apart are identical) that no neighbouring word extends keeping q;
those of at least LEAST_WORDS words and REPEATS periods are reported. Words are what stands between ASCII white space.

By the runs theorem each run has a root that is the longest Lyndon word at its first word, under one of the two opposite orders of
the words. With the inverse suffix array those longest Lyndon words end before the next smaller and the next greater value. Every such root
is extended to the right by the longest common prefix of the suffixes one period apart (a range minimum of the LCP array, by a sparse
table of which one level is in memory at a time), and what reaches far enough to the left by the same on the reversed words.

The documents of a batch share one suffix array: a word's number is told apart by document, so no suffix of one equals a suffix of
another, and documents whose suffixes differ within four words (they have no run) leave it early. Memory is linear in a batch, which has
at most 4 MB of text or one document. Documents are worked on where they are read: nothing is shuffled.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; repeated rows and null ids are documents like
any other; an empty table gives an empty result. Ids are passed on untouched. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..session import materialise_small, table

LEAST_WORDS = 6
REPEATS = 4
SPACE = r"\x20\x09-\x0D"


def _ranks(symbols: np.ndarray, length: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the places in it that are not settled yet, by doubling; only suffixes that tie are sorted again.

    The last symbol must be unique. With a length, doubling ends once the first so many symbols (or more) are compared.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    pos = np.arange(n)
    key = symbols[order]
    done = 0
    while True:
        head = np.append(True, key[1:] != key[:-1])
        rank[order[pos]] = np.maximum.accumulate(np.where(head, pos, 0))
        pos = pos[~(head & np.append(head[1:], True))]
        done = done * 2 or 1
        if not len(pos) or (length and done >= length):
            return order, rank, pos
        index = order[pos]
        key = rank[index] * n + rank[index + done]
        sort = np.argsort(key, kind="stable")
        order[pos], key = index[sort], key[sort]


class _Extensions:
    """Longest common prefixes of suffixes of a sequence whose last symbol is unique."""

    def __init__(self, symbols: np.ndarray):
        self.order, self.rank, _ = _ranks(symbols)
        n = len(symbols)
        self.common = np.zeros(n, dtype=np.int64)  # of a suffix and the one before it in order
        before = memoryview(np.where(self.rank > 0, self.order[self.rank - 1], -1))
        text, plain, h = memoryview(symbols), np.zeros(n, dtype=np.int64), 0
        found = memoryview(plain)
        for i in range(n):
            j = before[i]
            if j < 0:
                h = 0
                continue
            while text[i + h] == text[j + h]:  # the unique last symbol ends it
                h += 1
            found[i] = h
            if h:
                h -= 1
        self.common[self.rank] = plain

    def query(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes at places a and b (not equal), all answered in one pass over the levels of the sparse table."""
        low, high = np.minimum(self.rank[a], self.rank[b]) + 1, np.maximum(self.rank[a], self.rank[b])
        level = np.log2(high - low + 1).astype(np.int64)
        found, least = np.empty(len(low), dtype=np.int64), self.common
        by_level = np.argsort(level, kind="stable")
        bounds = np.searchsorted(level[by_level], np.arange(level.max(initial=-1) + 2))
        for k in range(len(bounds) - 1):
            pick = by_level[bounds[k] : bounds[k + 1]]
            found[pick] = np.minimum(least[low[pick]], least[high[pick] - (1 << k) + 1])
            least = np.minimum(least[: -(1 << k)], least[1 << k :])
        return found


def _next_less(values: np.ndarray) -> np.ndarray:
    """The place of the next smaller value of each, the length where there is none. Every place jumps over what its next one has jumped over."""
    n = len(values)
    after = np.arange(1, n + 1)
    low = np.append(values, np.iinfo(np.int64).min)
    after = np.append(after, n)
    left = np.flatnonzero(low[after[:n]] > values)
    while len(left):
        after[left] = after[after[left]]
        left = left[low[after[left]] > values[left]]
    return after[:n]


def runs_of(symbols: np.ndarray, least: int = LEAST_WORDS, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, by start, then period. Runs can't hold a unique symbol; the last must be one.

    repeats is 3 or more: then the leftmost root of a run is followed by more than two periods that match.
    """
    forward = _Extensions(symbols)
    n = len(symbols)
    start = np.tile(np.arange(n), 2)
    period = np.concatenate((_next_less(forward.rank), _next_less(-forward.rank))) - start
    far = start + (repeats - 1) * period < n
    start, period = start[far], period[far]
    same = symbols[start] == symbols[start + period]
    start, period = start[same], period[same]
    right = forward.query(start, start + period)
    far = right >= np.maximum((repeats - 2) * period + 1, least - 2 * period + 1)
    start, period, right = start[far], period[far], right[far]
    if not len(start):
        return start, right, period
    backward = _Extensions(np.append(symbols[-2::-1], symbols.max() + 1))
    left = np.zeros(len(start), dtype=np.int64)
    inner = start > 0
    left[inner] = backward.query(n - 1 - start[inner], n - 1 - start[inner] - period[inner])
    length = left + period + right
    kept = (left < period) & (length >= np.maximum(least, repeats * period))
    found = np.unique(np.column_stack((start - left, period, length))[kept], axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and how many each has."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    upto = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    return flat.filter(real), np.diff(upto[offsets - offsets[0]])


def _batch_runs(words: pa.Array, counts: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of every run of a batch, by document, start and period."""
    docs = np.repeat(np.arange(len(counts)), counts + 1)
    own = np.ones(len(docs), dtype=bool)
    own[np.cumsum(counts + 1) - 1] = False
    ids = words.dictionary_encode().indices.to_numpy()
    size = int(ids.max(initial=0)) + 2
    symbols = docs * size  # the end of a document is less than its words, and one of a kind
    symbols[own] += ids + 1
    # a run of REPEATS periods and LEAST_WORDS words repeats (REPEATS - 1) / REPEATS of itself
    order, _, open_places = _ranks(symbols, 4)
    open_docs = np.zeros(len(counts), dtype=bool)
    open_docs[docs[order[open_places]]] = True
    kept = open_docs[docs]
    if not kept.any():
        return (np.zeros(0, dtype=np.int64),) * 4
    start, length, period = runs_of(symbols[kept], least, repeats)
    places = np.flatnonzero(kept)[start]
    doc = docs[places]
    return doc, places - (np.cumsum(counts + 1) - counts - 1)[doc], length, period


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, repeats: int = REPEATS) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed: the words joined by one space, without
    those that a run holds after its first period."""
    if repeats < 3 or least - least // repeats < 4:
        raise ValueError("at least 3 repeats, and so many words that 4 of them are repeated")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    run_type = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
    schema = StructType([rows.schema["doc_id"], StructField("n_words", LongType()), StructField("runs", ArrayType(run_type)), StructField("collapsed", StringType())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            words, counts = _words(batch.column("text"))
            doc, start, length, period = _batch_runs(words, counts, least, repeats)
            first = np.cumsum(counts) - counts
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, first[doc] + start + period, 1)
            np.add.at(change, first[doc] + start + length, -1)
            kept = np.cumsum(change[:-1]) == 0
            offsets = np.concatenate(([0], np.cumsum(kept)))[np.append(first, len(words))].astype(np.int32)
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.filter(pa.array(kept))), " ")
            structs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
            of_doc = np.searchsorted(doc, np.arange(len(counts) + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(of_doc), structs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), runs, collapsed], schema.names)

    return rows.mapInArrow(run, schema)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; of one in ten documents, told by a checksum of the id, the words from some place on repeat with some period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    words = F.filter(F.split(F.col("text"), f"[{SPACE}]+"), lambda w: w != "")
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.element_at("words", F.col("a") + (i - F.col("a")) % F.col("p") + 1)))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    chosen = chosen.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    return chosen.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def _best(runs: Column) -> Column:
    """The run of the greatest length / period, exactly; of equal ones the first."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.reduce(runs, none, lambda best, x: F.when(better(best, x), x).otherwise(best))


def op12_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, one in ten with a periodic tail: number of runs, the best one, digests of all runs and of the collapsed text."""
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n"))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), _best(F.col("runs")).alias("best"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.expr("1000 * best.length div best.period")
    return materialise_small(found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256"), "runs")
