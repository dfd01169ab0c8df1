"""Operator 8: near-duplicate classes by BagMinHash, banding and exact verification of multiset overlap.

Texts are multisets of five-word shingles (see textcore); two texts are linked when their weighted Jaccard similarity
is 0.8 or more, and a class is a connected component of links.

Plan. Equal texts collapse to one node (an MD5 of the text) before anything is paired. One Arrow pass makes the node's
BagMinHash signature and its band keys. Within a band value every node is first paired with one leader only, the least in
one of ORDERS random orders, found by an aggregate with map-side combine; so a bucket of n nodes makes n-1 candidates, not
n^2. Each node of a candidate is read once more and kept as a sorted set of 64-bit elements (a shingle's second, third, ...
occurrence is an element of its own, so the overlap of multisets is that of sets); candidates are verified on these sets.

Buckets that then still hold nodes of different classes are searched whole, without a cap: every two of their nodes that are
of different classes are verified. The bucket's largest class meets the others only, not itself. A bucket is cut into blocks
of bounded nodes and elements, every two blocks meet in a cell of their own, and a cell's overlaps are one matrix product; no
pair is ever a row, and a cell's links are reported as what they join, at most one fewer than its nodes. Buckets of the same
nodes are searched once. So the only pairs missed are those that share no band.

Defined cases: a null text and a text without words are in classes of their own unless another text is byte-identical
(null is never identical to anything); texts of one to four words are one shingle; repeated rows share a class; an empty
table gives an empty result. The class id is the least doc_id of the class; with null doc_ids only, it is null. Other columns
may have any names; `drop_near_duplicates` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import discard, fresh, materialise, materialise_small, table
from .bagminhash import COMPONENTS, signed_texts
from .textcore import batches, mix, released, shingle_hashes

SIMILARITY = 0.8
BANDS = 20
ROWS = COMPONENTS // BANDS
#: Orders by which bands choose the leaders of their buckets, so that a node meets several.
ORDERS = 4
#: Nodes and elements of a block, of which every two of an open bucket meet.
PART = 256
PART_ELEMENTS = 1 << 18
#: A set of nodes up to this many (some 16 bytes each) is broadcast; a larger one is joined by a shuffle.
BROADCAST_NODES = 500_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_KEYS = [f"k{b}" for b in range(BANDS)]
#: Columns of an incidence matrix that are multiplied at once.
_WIDE = 4096


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def elements_of(text: str | None) -> np.ndarray:
    """The sorted elements of a text's shingle multiset: a shingle that occurs k times gives k elements."""
    return _elements(shingle_hashes([text])[0])


def _elements(hashes: np.ndarray) -> np.ndarray:
    ordered = np.sort(hashes)
    again = np.flatnonzero(ordered[1:] == ordered[:-1]) + 1
    if len(again):
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        place = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
        ordered[again] = mix(ordered[again] + _GOLD * place[again].astype(np.uint64))
        ordered.sort()
    return ordered


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum())


def overlaps(left: Sequence[np.ndarray], right: Sequence[np.ndarray] | None = None) -> np.ndarray:
    """How many elements every set of left shares with every set of right (or of left), by products of incidence matrices."""
    sets = [*left, *(right or [])]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    total = np.zeros((len(left), len(right) if right is not None else len(left)))
    if not len(owner):
        return total
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    met = counts[column] > 1
    column, owner = shared[column[met]], owner[met]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, int(shared[-1]) + 1, _WIDE):
        low, high = np.searchsorted(column, [start, start + _WIDE])
        matrix = np.zeros((len(sets), _WIDE), dtype=np.float32)
        matrix[owner[low:high], column[low:high] - start] = 1.0
        total += matrix[: len(left)] @ (matrix if right is None else matrix[len(left) :]).T
    return total


def near_duplicate_components(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of every node that is linked to another; a component is named by its least node."""
    nodes = docs.where(F.col(text).isNotNull()).select(node_of(F.col(text)).alias("node"), F.col(text).alias("text"))
    signed = materialise_small(_signed(nodes), "signatures")
    keys = _band_keys(signed)
    order = F.xxhash64("node", F.col("band") % ORDERS)
    leaders = keys.groupBy("key").agg(F.min(F.struct(order.alias("order"), "node"))["node"].alias("leader"), F.count("*").alias("size")).where("size > 1")
    members = materialise(keys.join(leaders, "key").where("node <> leader").select("key", "size", "leader", "node"), "members")
    sets = _sets(nodes, members)
    linked = materialise_small(_verified(members, sets, similarity), "linked")
    labels = materialise(connected_components(linked, "leader", "node"), "labels")
    open_ = _open_buckets(keys, members, linked, labels, signed)
    cells = materialise(_cells(open_), "cells")
    joined = materialise_small(_joined(cells, sets, similarity), "joined")
    merged = materialise(connected_components(joined, "a", "b").select(F.col("node").alias("label"), F.col("component").alias("whole")), "merged")
    discard(members, sets, linked, open_, cells, joined, signed)
    own = labels.select("node", F.col("component").alias("label"))
    alone = merged.select(F.col("label").alias("node"), "label").join(own, "node", "left_anti")
    named = own.unionByName(alone).join(merged, "label", "left").select("node", F.coalesce("whole", "label").alias("component"))
    out = materialise(named, "components")
    discard(labels, merged)
    return out


def _signed(nodes: DataFrame) -> DataFrame:
    """(node, k0 ..., n): the band keys and the number of shingles of every node that has any."""

    def sign(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            names, bodies, seen = batch.column("node").to_pylist(), batch.column("text").to_pylist(), {}
            # equal texts of a batch are signed once; the rest collapse in the aggregate below
            first = [i for i, name in enumerate(names) if seen.setdefault(name, i) == i]
            values, counts = signed_texts([bodies[i] for i in first])
            has = np.flatnonzero(counts)
            pairs = np.ascontiguousarray(values[has]).view(np.uint64).reshape(len(has), BANDS, ROWS // 2)
            key = np.broadcast_to(_GOLD * np.arange(1, BANDS + 1, dtype=np.uint64), (len(has), BANDS))
            for k in range(ROWS // 2):
                key = mix(key ^ mix(pairs[:, :, k] + _GOLD))
            key = key.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([names[first[i]] for i in has], pa.binary()), *[pa.array(key[:, b]) for b in range(BANDS)], pa.array(counts[has])], ["node", *_KEYS, "n"])

    signed = nodes.mapInArrow(released(sign), f"node binary, {', '.join(f'{k} long' for k in _KEYS)}, n long")
    return signed.groupBy("node").agg(*[F.min(k).alias(k) for k in [*_KEYS, "n"]])


def _band_keys(signed: DataFrame) -> DataFrame:
    each = F.array(*[F.struct(F.lit(b).alias("band"), F.col(k).alias("key")) for b, k in enumerate(_KEYS)])
    return signed.select("node", F.inline(each)).select("key", "band", "node")


def _maybe_broadcast(ids: DataFrame) -> DataFrame:
    """ids (written, of narrow rows), broadcast when they are few; what it is joined to isn't shuffled then."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_NODES else ids


def _sets(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, elements): the sorted elements, 8 bytes each, of every node that shares a bucket."""
    ends = materialise(members.select("node").union(members.select("leader")).distinct(), "ends")
    texts = nodes.join(_maybe_broadcast(ends), "node", "left_semi").dropDuplicates(["node"])

    def split(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            bodies = batch.column("text").to_pylist()
            for piece in batches(bodies):
                hashes, counts = shingle_hashes(bodies[piece])
                parts = np.split(hashes, np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(piece.start, len(parts)), pa.array([_elements(p).tobytes() for p in parts], pa.binary())], ["node", "elements"])

    sets = materialise_small(texts.mapInArrow(released(split), "node binary, elements binary"), "sets")
    discard(ends)
    return sets


def _verified(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(leader, node) of the candidates that reach the similarity. A leader of many is read in several parts."""
    pairs = members.groupBy("leader", "node").agg(F.max("size").alias("size"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / PART)).cast("int")
    dealt = materialise(pairs.select("leader", "node", part.alias("part")), "pairs")
    hubs = materialise(dealt.select("leader", "part").distinct(), "hubs")
    hubs = sets.select(F.col("node").alias("leader"), F.col("elements").alias("hub")).join(_maybe_broadcast(hubs), "leader")
    both = sets.join(_maybe_broadcast(dealt), "node").join(hubs, ["leader", "part"]).select("leader", "node", "hub", "elements")

    def verify(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, np.zeros(0, np.uint64)
        for batch in found:
            keep = []
            for i, (leader, body, own) in enumerate(zip(batch.column("leader").to_pylist(), batch.column("hub"), batch.column("elements"), strict=True)):
                if leader != last:
                    last, hub = leader, np.frombuffer(body.as_buffer(), dtype=np.uint64).copy()
                mine = np.frombuffer(own.as_buffer(), dtype=np.uint64)
                if min(len(hub), len(mine)) >= similarity * max(len(hub), len(mine)):
                    both = common(hub, mine)
                    if both / (len(hub) + len(mine) - both) >= similarity:
                        keep.append(i)
            yield batch.select(["leader", "node"]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(released(verify), "leader binary, node binary")


def _open_buckets(keys: DataFrame, members: DataFrame, linked: DataFrame, labels: DataFrame, signed: DataFrame) -> DataFrame:
    """(key, node, label, n) of the buckets that hold nodes of different classes; of buckets of the same nodes, one."""
    side = lambda name: labels.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    # in a bucket of two nodes the candidate was the only pair
    unlike = members.where("size > 2").join(linked, ["leader", "node"], "left_anti").join(side("leader"), "leader", "left").join(side("node"), "node", "left")
    failed = unlike.where(F.coalesce("of_leader", "leader") != F.coalesce("of_node", "node")).select("key").distinct()
    failed = materialise(failed, "failed")
    held = materialise(keys.join(_maybe_broadcast(failed), "key", "left_semi").select("key", "node"), "held")
    alike = held.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    once = alike.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key")
    once = materialise(once, "once")
    open_ = held.join(_maybe_broadcast(once), "key", "left_semi").join(labels, "node", "left").join(signed.select("node", "n"), "node")
    out = materialise(open_.select("key", "node", F.coalesce("component", "node").alias("label"), "n"), "open")
    discard(failed, held, once)
    return out


def _cells(open_: DataFrame) -> DataFrame:
    """(key, kind, row, col, side, node, label): the nodes of every two blocks that meet.

    Kind 0 are the blocks of a bucket's smaller classes among themselves, kind 1 those against the blocks of its largest class.
    A bucket of one block is one cell.
    """
    parts = lambda size, n: F.ceil(F.greatest(size / PART, n / PART_ELEMENTS)).cast("int")
    by_class = open_.groupBy("key", "label").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    total = by_class.groupBy("key").agg(F.max(F.struct("size", "n", "label")).alias("most"), F.sum("size").alias("size"), F.sum("n").alias("n"))
    single = (F.col("size") <= PART) & (F.col("n") <= PART_ELEMENTS)
    cut = total.select(
        "key", F.when(~single, F.col("most.label")).alias("major"),
        F.when(single, 1).otherwise(parts(F.col("size") - F.col("most.size"), F.col("n") - F.col("most.n"))).alias("rest_parts"),
        F.when(single, 0).otherwise(parts(F.col("most.size"), F.col("most.n"))).alias("major_parts"),
    )
    cut = materialise(cut, "cut")
    dealt = open_.join(_maybe_broadcast(cut), "key").withColumn("is_major", F.coalesce(F.col("label") == F.col("major"), F.lit(False)))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_major"), F.col("major_parts")).otherwise(F.col("rest_parts"))).cast("int")
    dealt = dealt.withColumn("own", own)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    me = F.col("own")
    cell = lambda kind, row, col, side: F.struct(F.lit(kind).alias("kind"), row.alias("row"), col.alias("col"), side.alias("side"))
    among = F.transform(upto(F.col("rest_parts")), lambda q: cell(0, F.least(me, q), F.greatest(me, q), F.when(me == q, 0).when(me < q, 1).otherwise(2)))
    against = F.transform(upto(F.col("major_parts")), lambda q: cell(1, me, q, F.lit(1)))
    met = F.transform(upto(F.col("rest_parts")), lambda q: cell(1, q, me, F.lit(2)))
    return dealt.select("key", "node", "label", F.inline(F.when(F.col("is_major"), met).otherwise(F.concat(among, against))))


def _joined(cells: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): labels that links of the cells join, a spanning forest of each cell's."""
    at = ["key", "kind", "row", "col"]
    rows = sets.join(_maybe_broadcast(cells), "node").select(*at, "side", "label", "elements").repartition(*at).sortWithinPartitions(*at, "side")

    def joins(sides: dict[int, list], named: dict[int, list]) -> list[tuple[bytes, bytes]]:
        whole = bool(sides[0])
        left, right = (0, 0) if whole else (1, 2)
        if not sides[left] or not sides[right] or len({*named[left], *named[right]}) < 2:
            return []
        shared = overlaps(sides[left]) if whole else overlaps(sides[left], sides[right])
        sizes = [np.array([len(s) for s in sides[k]], dtype=np.float64) for k in (left, right)]
        union = sizes[0][:, None] + sizes[1][None, :] - shared
        code = {label: i for i, label in enumerate({*named[left], *named[right]})}
        tags = [np.array([code[x] for x in named[k]]) for k in (left, right)]
        hits = np.argwhere((shared / np.maximum(union, 1.0) >= similarity) & (tags[0][:, None] != tags[1][None, :]))
        root, out = list(range(len(code))), []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in hits.tolist():
            a, b = find(int(tags[0][i])), find(int(tags[1][j]))
            if a != b:
                root[a] = b
                out.append((named[left][i], named[right][j]))
        return out

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, named = None, {0: [], 1: [], 2: []}, {0: [], 1: [], 2: []}
        pack = lambda pairs: pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])
        for batch in found:
            done = []
            places = zip(*[batch.column(c).to_pylist() for c in [*at, "side", "label"]], strict=True)
            for (*place, side, label), own in zip(places, batch.column("elements"), strict=True):
                if place != now:
                    done += joins(sides, named)
                    now, sides, named = place, {0: [], 1: [], 2: []}, {0: [], 1: [], 2: []}
                sides[side].append(np.frombuffer(own.as_buffer(), dtype=np.uint64).copy())
                named[side].append(label)
            if done:
                yield pack(done)
        last = joins(sides, named)
        if last:
            yield pack(last)

    return rows.mapInArrow(released(run), "a binary, b binary")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of docs: doc_id, node, class_id and class_size (rows)."""
    component = near_duplicate_components(docs, text, similarity)
    rows = materialise(docs.select(F.col(doc_id).alias("doc_id"), node_of(F.col(text)).alias("node")), "rows")
    # one row a node first: what follows never sees the copies of a text
    per_node = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    grouped = per_node.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    size = grouped.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("rows").alias("class_size"))
    named = materialise(grouped.select("node", "component").join(size, "component").select("node", "class_id", "class_size"), "named")
    discard(component)
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return rows.join(named, "node", "left").select("doc_id", "node", own.alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each class: a row of the least doc_id (null only if all are). Rows with a null text all stay.

    What stays is named by doc_id and text, not by row numbers, so it doesn't matter in which order a lost task is read again.
    """
    component = near_duplicate_components(docs, text, similarity)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), node_of(F.col(text)).alias("node"))
    counted = materialise(rows.groupBy("node", "id").agg(F.count("*").alias("n")), "ids")
    per_node = counted.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "n")).alias("least"))
    keep = per_node.join(component, "node", "left").groupBy(F.coalesce("component", "node").alias("class")).agg(F.min("least").alias("best"))
    own, name, key = fresh("near_node", docs.columns), fresh("kept_node", docs.columns), fresh("kept_id", docs.columns)
    keep = materialise(keep.select(F.col("best.node").alias(name), F.col("best.id").alias(key), (F.col("best.n") > 1).alias("repeated")), "keepers")
    discard(component, counted)
    marked = docs.withColumn(own, node_of(F.col(f"`{text}`")))
    same = (F.col(own) == F.col(name)) & F.col(f"`{doc_id}`").eqNullSafe(F.col(key))
    of = lambda which: marked.where(F.col(own).isNotNull()).join(_maybe_broadcast(keep.where(which).drop("repeated")), same, "left_semi")
    kept = of("NOT repeated").unionByName(marked.where(F.col(own).isNull()))
    if not keep.where("repeated").isEmpty():  # rows that are equal in doc_id and text; one of them stays
        kept = kept.unionByName(of("repeated").dropDuplicates([own]))
    return kept.drop(own)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")
