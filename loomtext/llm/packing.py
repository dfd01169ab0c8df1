"""Operator 6: best-fit packing of tokenized documents into sequences, by hierarchical residual packing.

A document is its token ids and an end id. One longer than the capacity is cut into pieces of exactly the capacity, of which
only the first is shorter. Every input partition packs its own pieces by best-fit decreasing and emits the bins that are
nearly full. The rest are items of later rounds: bins of FAN_IN neighbouring groups meet, are packed by best fit as
whole items, and again only the underfull go on. The mark of "nearly full" falls to half the capacity after the first of them, and
best fit leaves at most one bin of a group below half, so what goes up the tree shrinks to one bin a group and the
last task is small at any input size. Ids are never shuffled, only pieces' lengths and checksums.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; ties in length are packed by doc_id,
then piece; texts of any length and any run of white space or letters are encoded whole; an empty table gives an empty result. Strings that the vocabulary file lists as added tokens are one id each, as
its tokenizer gives them. Ids are passed on untouched, null ones too. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

import base64
import functools
import importlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import discard, materialise, materialise_small, table
from .textcore import released

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
FAN_IN = 8
#: Bins filled to these shares of the capacity leave the tree in round 0, and in round 1 and later.
NEARLY_FULL = (0.98, 0.5)
_WIDE_GAP = re.compile(r"\s{65536}")
_ENCODERS: dict[str, object] = {}


def vocabulary_path(name: str) -> str:
    return importlib.import_module("public_tokenizers").path(name)


@functools.cache
def _tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(vocabulary))


def encoder(vocabulary: str = VOCABULARY):
    """texts -> lists of ids. For the byte-level vocabulary the rank file of the same tokens is used, which gives the
    same ids several times faster; the added tokens of the vocabulary file are cut out first, as its tokenizer does. That library
    can't take very long runs of white space, so a text with one is left to tokenizers, which loads any other file too."""
    if vocabulary not in _ENCODERS:
        whole = lambda text: _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
        if vocabulary == VOCABULARY:
            import tiktoken

            with open(vocabulary_path("byte_bpe_50k.tiktoken"), "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            pattern = importlib.import_module("public_tokenizers").PATTERN
            plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            with open(vocabulary_path(vocabulary), encoding="utf-8") as file:
                added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
            cut_out = re.compile("|".join(f"({re.escape(t)})" for t in sorted(added, key=len, reverse=True)) or r"(?!)")

            def encode(text: str) -> list[int]:
                if _WIDE_GAP.search(text):
                    return whole(text)
                found = cut_out.search(text)
                if not found:
                    return plain(text)
                ids, at = [], 0
                for found in cut_out.finditer(text):
                    ids += [*plain(text[at : found.start()]), added[found[0]]]
                    at = found.end()
                return ids + plain(text[at:])

            _ENCODERS[vocabulary] = encode
        else:
            _ENCODERS[vocabulary] = whole
    return _ENCODERS[vocabulary]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def best_fit(sizes: np.ndarray, order: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of every item, taken in `order`, and the fill of each bin.

    A bit for each free space that some bin has makes the search for the tightest bin one shift and one bit scan.
    """
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    fill: list[int] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    for i in order.tolist():
        size = int(sizes[i])
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            at = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            at, space = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = at, fill[at]
        fill[at] += size
        rest = space - size
        if rest:
            by_space[rest].append(at)
            spaces |= 1 << rest
    return bins, offsets, fill


def _pieces(docs: DataFrame, doc_id: str, text: str, vocabulary: str, capacity: int) -> DataFrame:
    """Pieces with their bin in their own partition."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        ids, pieces = [], []  # ids of the partition's rows in Arrow; (row, piece, start, length, crc)
        rows = 0
        for batch in found:
            ids.append(batch.column("doc_id"))
            for row, body in enumerate(batch.column("text").to_pylist(), rows):
                tokens = np.array([*encode(body or ""), END_ID], dtype="<u4")
                pieces += [(row, k, at, n, zlib.crc32(tokens[at : at + n].tobytes())) for k, (at, n) in enumerate(cut(len(tokens), capacity))]
            rows += batch.num_rows
        if not pieces:
            return
        held = pa.chunked_array(ids)
        row, piece, start, length, crc = (np.array(column, dtype=np.int64) for column in zip(*pieces, strict=True))
        names = held.to_pylist()
        rank = np.empty(rows, dtype=np.int64)  # nulls first, then by doc_id
        rank[sorted(range(rows), key=lambda i: (names[i] is not None, names[i] if names[i] is not None else 0))] = np.arange(rows)
        # rows that tie in doc_id may be in any order, so the checksum decides before the row
        level = np.array([names[i] for i in np.argsort(rank)], dtype=object)
        group = np.cumsum(np.append(False, [a != b for a, b in zip(level[1:], level[:-1], strict=True)]))[rank]
        order = np.lexsort((row, crc, piece, group[row], -length))
        bins, offsets, fill = best_fit(length, order, capacity)
        columns = [row, piece.astype(np.int32), start, length, crc, (part << 33) + bins, offsets, np.array(fill, dtype=np.int32)[bins], np.full(len(row), part, dtype=np.int32)]
        for begin in range(0, len(row), 50_000):
            one = [c[begin : begin + 50_000] for c in columns]
            yield pa.RecordBatch.from_arrays([held.take(pa.array(one[0])).combine_chunks(), *map(pa.array, one[1:])], schema.names)

    long = {"piece": IntegerType(), "start": LongType(), "length": LongType(), "ids_crc32": LongType(), "bin": LongType(), "offset": LongType(), "bin_fill": IntegerType(), "part": IntegerType()}
    schema = StructType([rows.schema["doc_id"], *[StructField(n, k) for n, k in long.items()]])
    return rows.mapInArrow(released(run), schema)


_NODE = "members array<struct<bin:bigint,base:int>>, fill int, grp int"


def _round(items: DataFrame, group_of: int, capacity: int) -> DataFrame:
    """Best fit of the underfull bins of each group of neighbours."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lead = [m[0]["bin"] for m in frame["members"]]
        order = np.lexsort((np.array(lead), -frame["fill"].to_numpy()))
        bins, offsets, fill = best_fit(frame["fill"].to_numpy(), order, capacity)
        members: list[list] = [[] for _ in fill]
        for i in order.tolist():
            members[bins[i]] += [{"bin": m["bin"], "base": int(m["base"] + offsets[i])} for m in frame["members"].iloc[i]]
        return pd.DataFrame({"members": members, "fill": fill, "grp": int(frame["grp"].iloc[0])})

    return items.withColumn("grp", F.floor(F.col("grp") / group_of).cast("int")).groupBy("grp").applyInPandas(run, _NODE)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    pieces = materialise_small(_pieces(docs, doc_id, text, vocabulary, capacity), "pieces")
    bins = pieces.groupBy("bin").agg(F.first("bin_fill").alias("fill"), F.first("part").alias("grp"))
    one = F.array(F.struct(F.col("bin"), F.lit(0).alias("base")))
    items = bins.where(F.col("fill") < int(capacity * NEARLY_FULL[0])).select(one.alias("members"), "fill", "grp")
    items = materialise(items, "underfull")
    top = items.agg(F.max("grp")).first()[0]
    merged = None
    level = 0
    while top is not None:
        level += 1
        packed = materialise(_round(items, FAN_IN, capacity), "packed")
        top //= FAN_IN
        mark = int(capacity * NEARLY_FULL[min(level, len(NEARLY_FULL) - 1)])
        done = packed if top == 0 else packed.where(F.col("fill") >= mark)
        merged = done if merged is None else merged.unionByName(done)
        if top == 0:
            break
        last, items = items, packed.where(F.col("fill") < mark)
        discard(last)
    if merged is None:
        return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
    lead = F.element_at("members", 1)["bin"]
    places = merged.where(F.size("members") > 1).select(lead.alias("sequence_id"), F.inline("members")).withColumnRenamed("bin", "member")
    out = pieces.join(places, pieces["bin"] == places["member"], "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).cast("long").alias("offset"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
