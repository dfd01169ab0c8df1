"""Operator 3: benchmark decontamination by a BM25 index of the test items, searched by block-max WAND.

The test items are the indexed side; every passage of every training document is a query. A posting's weight is its BM25 part
divided by the item's own score, so a score is the share of the item's BM25 mass that the passage covers. A retrieved
item counts as leaked when the passage holds 80 % of the item's distinct five-word shingles, or 80 % of its question's
and of its answer's (the last sentence). A passage that does so lacks at most as many of the item's words as a fifth of its
shingles; one less the mass of that many of its heaviest terms is the item's threshold, so no leak scores below it.

A term's postings are sorted by item and lie in blocks of POSTINGS; each block has its largest weight and last item. A query
moves one cursor a term: cursors are ordered by item, the pivot is the first item that their terms' maxima can lift to the least
threshold, the maxima of the blocks that hold the pivot confirm it or the cursors skip past those blocks, and only confirmed
pivots are scored. All items that reach their own threshold are retrieved and verified.

Most passages are far from every item. So before the cursors move, one vectorised sum bounds a passage from above: items lie in
RANGES ranges, each term has its largest weight in each range, and a passage goes on only if some range's sum reaches the
range's least threshold. Terms that together cannot lift any item by more than SLACK are left out of that sum, which is compared with
the threshold less SLACK.

A passage is two neighbouring strides of words, and the stride of an item is the least of 16, 64, 256, ... words that holds it; so every
stretch as long as an item lies whole in a passage, and no item's passages depend on other items. Items of one stride are one index; all
of a part are searched in one pass over the texts. Document frequencies and mean length come from the whole benchmark, by distributed aggregates.
The index is built and searched in parts of bounded size, one part at a time, so neither the driver nor a task holds more than one part,
and results don't depend on how items fall into parts.

Defined cases: null or empty texts and items match nothing; an item of fewer than five words is one shingle of all its
words; items of equal text each match; repeated rows match each; an empty table gives an empty result. Ids are passed on
untouched, null ones too. Other columns may have any names: a search ignores them and filtering returns them as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import discard, materialise, materialise_small, table
from .textcore import SHINGLE_WORDS, batches, flat_words, released, shingle_hashes

K1, B = 1.2, 0.75
SLACK = 0.1
CONTAINED = 0.8
LEAST_STRIDE = 16
#: Bounds of an index part.
ITEMS_PER_PART = 4_000
CHARACTERS_PER_PART = 4_000_000
#: Postings of a block.
POSTINGS = 32
RANGES = 128
_TINY = 1e-9
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last sentence with words; a single sentence is both."""
    parts = [s for s in _SENTENCE.split(text) if flat_words(s)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


class Statistics:
    """Number and mean length of all items that have words, and in how many of them each of some words is."""

    def __init__(self, items: int, mean: float, frequency: Mapping[bytes, int]):
        self.items, self.mean, self.frequency = items, mean, frequency

    @classmethod
    def of(cls, texts: Sequence[str]) -> Statistics:
        words = [ws for t in texts for ws in [flat_words(t).split()] if ws]
        return cls(len(words), sum(map(len, words)) / max(1, len(words)), Counter(w for ws in words for w in set(ws)))


class Postings:
    """Sorted items and weights of a term, in blocks with their last items and largest weights."""

    __slots__ = ("items", "last", "most", "top", "weights")

    def __init__(self, pairs: Sequence[tuple[int, float]]):
        self.items, self.weights = [i for i, _ in pairs], [x for _, x in pairs]
        starts = range(0, len(pairs), POSTINGS)
        self.last = [self.items[min(s + POSTINGS, len(pairs)) - 1] for s in starts]
        self.most = [max(self.weights[s : s + POSTINGS]) for s in starts]
        self.top = max(self.most)


def stride_of(words: int) -> int:
    """The words of a stride, for an item of so many words."""
    stride = LEAST_STRIDE
    while stride < words:
        stride *= 4
    return stride


class ItemIndex:
    """BM25 postings of items of one stride (that of the longest of them) with block maxima."""

    def __init__(self, items: Sequence[tuple[object, str]], known: Statistics | None = None):
        items = [(i, t) for i, t in items if flat_words(t)]
        known = known or Statistics.of([t for _, t in items])
        self.ids = [i for i, _ in items]
        words = [flat_words(t).split() for _, t in items]
        self.shingles = [np.unique(shingle_hashes([t])[0]) for _, t in items]
        halves = [question_and_answer(t) for _, t in items]
        self.questions = [np.unique(shingle_hashes([q])[0]) for q, _ in halves]
        self.answers = [np.unique(shingle_hashes([a])[0]) for _, a in halves]
        self.short = [(len(flat_words(t).split()), len(flat_words(q).split()), len(flat_words(a).split())) for (_, t), (q, a) in zip(items, halves, strict=True)]
        self.stride = stride_of(max(map(len, words), default=0))
        n = len(items)
        present = sorted({w for ws in words for w in ws})
        self.terms = {w: k for k, w in enumerate(present)}
        idf = {w: float(np.log(1 + (known.items - known.frequency[w] + 0.5) / (known.frequency[w] + 0.5))) for w in present}
        self.thresholds = np.zeros(n)
        lists: list[list[tuple[int, float]]] = [[] for _ in present]
        for i, ws in enumerate(words):
            part = {w: idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(ws) / known.mean)) for w, c in Counter(ws).items()}
            own = sum(part.values())
            fifth = lambda x: int((1 - CONTAINED) * len(x) + _TINY)
            lost = max(fifth(self.shingles[i]), fifth(self.questions[i]) + fifth(self.answers[i]))
            self.thresholds[i] = 1 - sum(sorted(part.values(), reverse=True)[:lost]) / own - 1e-6
            for w, x in part.items():
                lists[self.terms[w]].append((i, x / own))
        self.postings = [Postings(pairs) for pairs in lists]
        self.least = float(self.thresholds.min()) if n else 1.0
        self.range = max(1, -(-n // RANGES))
        ranges = -(-n // self.range) if n else 0
        self.maxima = np.zeros((len(present), ranges), dtype=np.float32)
        for k, pairs in enumerate(lists):
            for i, x in pairs:
                self.maxima[k, i // self.range] = max(self.maxima[k, i // self.range], x)
        self.needed = np.array([self.thresholds[b * self.range : (b + 1) * self.range].min() for b in range(ranges)]) - SLACK - 1e-4
        # the terms of the longest lists are non-essential, as long as no item gets more than SLACK from all of them
        gained = np.zeros(n)
        self.essential = dict(self.terms)
        for w in sorted(self.terms, key=lambda w: (-len(lists[self.terms[w]]), w)):
            pairs = lists[self.terms[w]]
            if any(gained[i] + x > SLACK for i, x in pairs):
                break
            for i, x in pairs:
                gained[i] += x
            del self.essential[w]

    def retrieve(self, words: set[bytes]) -> dict[int, float]:
        """Every item that a passage of these words scores at its threshold or more, with the score, by block-max WAND."""
        lists = [self.postings[k] for k in sorted(self.terms[w] for w in words if w in self.terms)]
        cursors = [[p.items[0], 0, p] for p in lists]  # current item, its place, postings
        found: dict[int, float] = {}
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, at = 0.0, -1
            for at, cursor in enumerate(cursors):  # noqa: B007
                bound += cursor[2].top
                if bound >= self.least - _TINY:
                    break
            else:
                break
            pivot = cursors[at][0]
            while at + 1 < len(cursors) and cursors[at + 1][0] == pivot:
                at += 1
            ahead = cursors[: at + 1]
            blocks = [bisect_left(c[2].last, pivot) for c in ahead]  # the block in which the pivot would be
            bound = sum(c[2].most[b] for c, b in zip(ahead, blocks, strict=True) if b < len(c[2].last))
            if bound >= self.thresholds[pivot] - _TINY:
                target = pivot if ahead[0][0] < pivot else pivot + 1
                if target > pivot:
                    score = sum(c[2].weights[c[1]] for c in ahead)
                    if score >= self.thresholds[pivot]:
                        found[pivot] = score
            elif bound >= self.least - _TINY:  # another item of these blocks may still reach its own threshold
                target = pivot + 1
            else:
                ends = [c[2].last[b] + 1 for c, b in zip(ahead, blocks, strict=True) if b < len(c[2].last)]
                target = max(pivot + 1, min([*ends, *[c[0] for c in cursors[at + 1 : at + 2]]]))
            for cursor in ahead:
                if cursor[0] < target:
                    p = cursor[2]
                    place = bisect_left(p.items, target, cursor[1])
                    cursor[:2] = (p.items[place] if place < len(p.items) else -1), place
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def candidates(self, codes: np.ndarray, strides: np.ndarray) -> list[int]:
        """First strides of the passages whose bound reaches some range's threshold.

        codes: each word's essential term, or -1; strides: the number of its stride. A passage is two strides with
        successive numbers; strides of different documents never are.
        """
        at = np.flatnonzero(codes >= 0)
        if not len(at):
            return []
        pairs = np.unique(strides[at] * len(self.terms) + codes[at])
        stride, term = pairs // len(self.terms), pairs % len(self.terms)
        begin = np.flatnonzero(np.append(True, stride[1:] != stride[:-1]))
        sums = np.add.reduceat(self.maxima[term], begin, axis=0)
        own = stride[begin]
        before = np.append(False, own[1:] == own[:-1] + 1)
        bound = sums.copy()  # of the passage that ends at this stride
        bound[before] += sums[:-1][before[1:]]
        ends = own[(bound >= self.needed).any(axis=1)] - 1
        # a passage whose second stride has no essential terms
        last = np.append(own[1:] != own[:-1] + 1, True)
        starts = own[(sums >= self.needed).any(axis=1) & last]
        return np.unique(np.concatenate([ends, starts])).tolist()

    def _held(self, wanted: np.ndarray, words: int, have: set[int], passage: Sequence[bytes]) -> float:
        if words >= SHINGLE_WORDS:
            return sum(x in have for x in wanted.tolist()) / len(wanted)
        runs = {int(x) for x in shingle_hashes([(b" ".join(passage)).decode("utf-8", "surrogatepass")], words)[0]}
        return float(int(wanted[0]) in runs)

    def search(self, texts: Sequence[str | None]) -> list[tuple[int, int, float, float]]:
        """(text, item, best BM25 share, best containment) of all leaked items of the texts."""
        return [(piece.start + row, *rest) for piece in batches(texts) for row, *rest in self.search_words([flat_words(t).split() for t in texts[piece]])]

    def search_words(self, words: Sequence[Sequence[bytes]]) -> list[tuple[int, int, float, float]]:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        total = int(lengths.sum())
        if not total or not self.ids:
            return []
        codes = np.fromiter(map(self.essential.get, chain.from_iterable(words), repeat(-1)), dtype=np.int64, count=total)
        spans = -(-lengths // self.stride) + 2
        first = np.cumsum(spans) - spans + 1  # number of each text's first stride; one number is free on both sides
        inside = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        strides = np.repeat(first, lengths) + inside // self.stride
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for stride in self.candidates(codes, strides):
            row = int(np.searchsorted(first, stride + 1, side="right")) - 1
            at = (stride - int(first[row])) * self.stride
            passage, have = words[row][max(0, at) : at + 2 * self.stride], None
            for item, score in self.retrieve(set(passage)).items():
                if have is None:
                    have = set(shingle_hashes([b" ".join(passage).decode("utf-8", "surrogatepass")])[0].tolist())
                n_all, n_q, n_a = self.short[item]
                whole = self._held(self.shingles[item], n_all, have, passage)
                if whole >= CONTAINED or (self._held(self.questions[item], n_q, have, passage) >= CONTAINED and self._held(self.answers[item], n_a, have, passage) >= CONTAINED):
                    known = best.get((row, item), (0.0, 0.0))
                    best[row, item] = (max(known[0], score), max(known[1], whole))
        return [(row, item, *x) for (row, item), x in sorted(best.items())]


class IndexPart:
    """The indexes of some items, by stride."""

    def __init__(self, items: Sequence[tuple[object, str]], known: Statistics | None = None):
        known = known or Statistics.of([t for _, t in items])
        by_stride: dict[int, list[tuple[object, str]]] = {}
        for item in items:
            by_stride.setdefault(stride_of(len(flat_words(item[1]).split())), []).append(item)
        self.indexes = [ItemIndex(own, known) for _, own in sorted(by_stride.items())]
        self.ids = [i for index in self.indexes for i in index.ids]

    def search(self, texts: Sequence[str | None]) -> list[tuple[int, int, float, float]]:
        """(text, item, best BM25 share, best containment) of all leaked items of the texts."""
        found = []
        for piece in batches(texts):
            words, before = [flat_words(t).split() for t in texts[piece]], 0
            for index in self.indexes:
                found += [(piece.start + row, before + item, *rest) for row, item, *rest in index.search_words(words)]
                before += len(index.ids)
        return found


def item_parts(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", per_part: int = ITEMS_PER_PART) -> Iterator[IndexPart]:
    """The index, part by part: at most `per_part` items, and CHARACTERS_PER_PART and one item's text, are on the driver at a time."""
    items = materialise(benchmark.where(F.col(text).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(item_id).alias("item"), F.col(text).alias("text")), "items")

    def split(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            words = [flat_words(t).split() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(map(len, words), pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary()))], ["row", "n", "words"])

    worded = materialise_small(items.select("row", "text").mapInArrow(released(split), "row long, n long, words array<binary>").where("n > 0"), "item-words")
    size = worded.agg(F.count("*").alias("items"), F.avg("n").alias("mean")).first()
    each = worded.select("row", F.explode("words").alias("word"))
    frequency = each.groupBy("word").agg(F.count("*").alias("n"))
    counted = each.join(frequency, "word").groupBy("row").agg(F.collect_list(F.struct("word", "n")).alias("frequency"))
    whole = materialise(items.join(counted, "row").orderBy("row"), "item-frequencies")
    discard(items, worded)
    part: list[tuple[object, str]] = []
    known: dict[bytes, int] = {}
    used = 0
    build = lambda: IndexPart(part, Statistics(size["items"], size["mean"], known))
    for row in whole.select("item", "text", "frequency").toLocalIterator():
        part.append((row["item"], row["text"]))
        known |= {bytes(x["word"]): x["n"] for x in row["frequency"]}
        used += len(row["text"])
        if len(part) == per_part or used >= CHARACTERS_PER_PART:
            yield build()
            part, known, used = [], {}, 0
    if part:
        yield build()
    discard(whole)


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, bm25_share, containment): one row for each row of docs and item whose text it leaks."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"))
    schema = StructType([rows.schema["doc_id"], StructField("item_id", items.schema["item_id"].dataType), StructField("bm25_share", DoubleType()), StructField("containment", DoubleType())])

    def over(index: IndexPart) -> DataFrame:
        def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in found:
                hits = index.search(batch.column("text").to_pylist())
                ids = batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[h[1]] for h in hits], of), *[pa.array([h[k] for h in hits], pa.float64()) for k in (2, 3)]], schema.names)

        return materialise_small(rows.mapInArrow(released(run), schema), "leaks")  # one part at a time; its rows are few

    of = to_arrow_type(schema["item_id"].dataType)
    parts = [over(index) for index in item_parts(benchmark, item_id, item_text)]
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the rows that leak an item; each part of the index filters what the one before it left."""
    left = docs
    for index in item_parts(benchmark, item_id, item_text):
        last, left = left, materialise_small(left.where(~_leaking(index)(F.col(text))), "leakless")
        if last is not docs:
            discard(last)
    return left


def _leaking(index: IndexPart):
    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        found = np.zeros(len(texts), dtype=bool)
        found[[row for row, *_ in index.search(texts.tolist())]] = True
        return pd.Series(found)

    return leaks


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
