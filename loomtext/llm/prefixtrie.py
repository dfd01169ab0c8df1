"""Operator 11: a trie of conversations that share their first turns, in succinct level-order form.

A turn is a 128-bit digest of its role and text, so texts are never shuffled; a node is the digest of all turns up to it. Conversations are dealt
in ranges of their sequences of node digests, so every shard of the trie is a set of neighbouring prefixes, and the copies of one
conversation may lie in several shards. A task builds the trie of its range in level order: a LOUDS bit vector (a one for each child of
a node, then a zero) with an array of labels; parents follow from ranks of its bits, and counts, least ids, leaves and savings are added
to the parents level by level from the deepest up.

Nodes on the first and the last path of a shard may go on in a neighbour. These heavy upper levels (two paths a shard, whatever the input) are merged on
their own, as one more trie of the same kind; what hangs below them inside a shard comes with their sums. The number of shards
follows from the number of turns, so a task holds SHARD_TURNS turns and the labels of one conversation at most.

A digest of all members that end at a node is sequential by definition: ids are joined to text in the shards, and only nodes on a shard's border are hashed
later, from those pieces. The turns of one conversation meet in one task, and its path is one value there.

Defined cases: a null role or text is empty; a null turn comes first; turns that tie are ordered by their digest; repeated rows are turns
of their own; a null conv_id is a conversation of its own turns alone, written as an empty string, and stands behind all others; negative
ids belong to the hundred below them; an empty table has no trie and gives an empty result. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, table

#: Conversations whose first turns a group may share, and turns that are shared at most, less one.
GROUP = 100
SHARED = 6
#: Turns of a shard on average, so that its arrays are bounded.
SHARD_TURNS = 2_000_000
#: Nodes of the upper levels up to which their least ids are broadcast; beyond, they are joined by a shuffle.
BROADCAST_NODES = 1_000_000
_ID = 16
_NONE = np.iinfo(np.int64).max
#: Ids that are joined to one text.
PIECE_IDS = 50_000


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its hundred."""
    return zlib.crc32(str(conv_id).encode()) % SHARED


def conversation_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each rebuilt conversation: conv_id, depth, path (the digests of its prefixes) and chars (code points of each turn).

    The first turns are those of the first conversation of the hundred (as many as shared_turns says), the rest are its own.
    """
    body = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    coded = F.encode(F.concat(F.length(body[0]).cast("string"), F.lit(":"), *body), "utf-8")
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.substring(F.unhex(F.sha2(coded, 256)), 1, _ID).alias("item"), F.length(body[1]).alias("chars"))
    rows = rows.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP)))
    rows = rows.repartition("base").sortWithinPartitions("base", "conv_id", F.col("turn").asc_nulls_first(), "item").select("base", "conv_id", "item", "chars")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: list = []  # the first turns of the first conversation of the group
        now, group, own, out, size = None, object(), [], [], 0

        def finish() -> tuple:
            if now is not None:
                h = shared_turns(now)
                own[:h] = first[:h]
            key, path, chars = bytes(_ID), bytearray(), np.empty(len(own), dtype="<i4")
            for i, (item, n) in enumerate(own):
                key = hashlib.sha256(key + item).digest()[:_ID]
                path += key
                chars[i] = n
            return now, len(own), bytes(path), chars.tobytes()

        started = False
        for batch in found:
            for base, conv, item, chars in zip(*[batch.column(c).to_pylist() for c in ("base", "conv_id", "item", "chars")], strict=True):
                if not started or conv != now:
                    if started:
                        if now is not None and now == group:
                            first = own[: SHARED - 1]
                        out.append(finish())
                        size += len(own)
                    if base != group:
                        first, group = [], base
                    now, own, started = conv, [], True
                    if size > 50_000:
                        yield _batch(out, _PATHS)
                        out, size = [], 0
                own.append((item, chars))
        if started:
            out.append(finish())
            yield _batch(out, _PATHS)

    return rows.mapInArrow(run, "conv_id long, depth long, path binary, chars binary")


_PATHS = {"conv_id": pa.int64(), "depth": pa.int64(), "path": pa.binary(), "chars": pa.binary()}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))


class LevelOrderTrie:
    """The trie of sorted, distinct paths: LOUDS bits, and for each node in level order its digest, length of text, parent and depth.

    The root is node 0; its digest is zeros. `end` is the node where each path ends.
    """

    def __init__(self, paths: list[bytes], chars: list[bytes]):
        depth = np.array([len(p) // _ID for p in paths], dtype=np.int64)
        labels = np.frombuffer(b"".join(paths), dtype=f"V{_ID}")
        sizes = np.frombuffer(b"".join(chars), dtype="<i4")
        begin = np.cumsum(depth) - depth
        self.end = np.zeros(len(paths), dtype=np.int64)
        node = np.zeros(len(paths), dtype=np.int64)  # of each path, at the level reached
        active, count = np.flatnonzero(depth > 0), 1
        parents, self.level_starts, keys, lengths = [], [0, 1], [np.zeros(1, dtype=f"V{_ID}")], [np.zeros(1, dtype=np.int64)]
        level = 0
        while len(active):
            at = begin[active] + level
            key = labels[at]
            new = np.append(True, key[1:] != key[:-1])
            parents.append(node[active[new]])
            keys.append(key[new])
            lengths.append(sizes[at[new]].astype(np.int64))
            node[active] = count + np.cumsum(new) - 1
            count += int(new.sum())
            self.level_starts.append(count)
            level += 1
            ends = depth[active] == level
            self.end[active[ends]] = node[active[ends]]
            active = active[~ends]
        self.labels, self.chars = np.concatenate(keys), np.concatenate(lengths)
        self.n_children = np.bincount(np.concatenate(parents), minlength=count) if parents else np.zeros(count, dtype=np.int64)
        self.bits = np.ones(2 * count - 1, dtype=bool)  # for every node a one for each child, then a zero
        self.bits[np.cumsum(self.n_children + 1) - 1] = False
        ones = np.flatnonzero(self.bits)
        self.parent = np.append(-1, ones - np.arange(len(ones)))  # zeros before the n-th one: the nodes before its owner
        self.depth = np.repeat(np.arange(len(self.level_starts) - 1), np.diff(self.level_starts))

    def upwards(self) -> Iterator[slice]:
        """The levels below the root, from the deepest up."""
        for begin, end in zip(self.level_starts[-2:0:-1], self.level_starts[:1:-1], strict=True):
            yield slice(begin, end)

    def way(self, path: int) -> np.ndarray:
        """The nodes from the root to where a path ends."""
        at, found = int(self.end[path]), []
        while at >= 0:
            found.append(at)
            at = int(self.parent[at])
        return np.array(found[::-1], dtype=np.int64)

    def add_up(self, values: np.ndarray) -> np.ndarray:
        """Sums of values over subtrees."""
        for level in self.upwards():
            np.add.at(values, self.parent[level], values[level])
        return values

    def least(self, values: np.ndarray) -> np.ndarray:
        """Minima of values over subtrees."""
        for level in self.upwards():
            np.minimum.at(values, self.parent[level], values[level])
        return values


#: Rows of a shard. kind: "node" (finished, but for its parent's id where that is open), "open" (one of its two border paths, with sums over
#: what hangs below its nodes in this shard), "ids" (members that end on a border path).
_ROWS = {
    "kind": pa.string(), "label": pa.binary(), "parent": pa.binary(), "depth": pa.int64(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "path": pa.binary(), "chars": pa.binary(), "sums": pa.binary(), "part": pa.int32(), "piece": pa.int64(), "ids": pa.string(),
}
_SCHEMA = ", ".join(f"{n} {({pa.string(): 'string', pa.binary(): 'binary', pa.int64(): 'long', pa.int32(): 'int'})[t]}" for n, t in _ROWS.items())
_EMPTY = hashlib.sha256(b"").hexdigest()


def _columns(n: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(given[k], t) if k in given else pa.nulls(n, t) for k, t in _ROWS.items()], list(_ROWS))


def _known(ids: np.ndarray, known: np.ndarray | bool = True) -> pa.Array:
    return pa.array(ids, mask=(ids == _NONE) | ~np.broadcast_to(known, ids.shape))


class _Shard:
    """The distinct paths of a range, in order, with their members."""

    def __init__(self, found: Iterator[pa.RecordBatch]):
        self.paths, self.chars, self.members, self.least, self.digests = [], [], [], [], []
        self.open_ids: dict[int, list[str]] = {}  # of the first path, and of the present one and those that begin it
        ids: list[str] = []
        for batch in found:
            for conv, path, size in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "path", "chars")], strict=True):
                if not self.paths or path != self.paths[-1]:
                    self._close(ids)
                    ids = []
                    for at in reversed([at for at in self.open_ids if at]):
                        if path.startswith(self.paths[at]):
                            break
                        del self.open_ids[at]
                    self.open_ids[len(self.paths)] = ids
                    self.paths.append(path)
                    self.chars.append(size)
                    self.members.append(0)
                    self.least.append(_NONE)
                self.members[-1] += 1
                self.least[-1] = min(self.least[-1], _NONE if conv is None else conv)
                ids.append("" if conv is None else str(conv))
        self._close(ids)
        self.borders = sorted({0, len(self.paths) - 1})

    def _close(self, ids: list[str]) -> None:
        if self.paths:
            self.digests.append(hashlib.sha256(",".join(ids).encode()).hexdigest())


def _shard_rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one range of paths, as rows."""
    part, shard = TaskContext.get().partitionId(), _Shard(found)
    if not shard.paths:
        return
    trie = LevelOrderTrie(shard.paths, shard.chars)
    n = len(trie.labels)
    convs, low = np.zeros(n, dtype=np.int64), np.full(n, _NONE, dtype=np.int64)
    convs[trie.end], low[trie.end] = shard.members, shard.least
    sha = np.full(n, _EMPTY, dtype=object)
    sha[trie.end] = shard.digests
    convs, low = trie.add_up(convs), trie.least(low)
    borders = [trie.way(at) for at in shard.borders]
    inner = np.ones(n, dtype=bool)
    for way in borders:
        inner[way] = False
    saved = trie.add_up(np.where(inner, (convs - 1) * trie.chars, 0))
    leaves = trie.add_up((inner & (trie.n_children == 0)).astype(np.int64))
    parent = np.maximum(trie.parent, 0)
    known = inner[parent]
    for begin in range(0, n, 50_000):
        at = np.flatnonzero(inner[begin : begin + 50_000]) + begin
        if len(at):
            up = parent[at]
            yield _columns(
                len(at), kind=["node"] * len(at), parent=[None if k else trie.labels[i].tobytes() for k, i in zip(known[at], up, strict=True)], depth=trie.depth[at], conv_id=_known(low[at]), parent_conv_id=_known(low[up], known[at]),
                n_convs=convs[at], n_children=trie.n_children[at], n_leaves=leaves[at], saved_tokens=saved[at], ends_sha256=list(sha[at]),
            )
    # below an open node: what its inner children bring; its open children are added where all shards meet
    closed = np.flatnonzero(inner)
    children, below_leaves, below_saved = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for total, values in ((children, 1), (below_leaves, leaves[closed]), (below_saved, saved[closed])):
        np.add.at(total, parent[closed], values)
    seen = np.zeros(n, dtype=bool)  # a node on both borders counts on the first
    for at, way in zip(shard.borders, borders, strict=True):
        fresh = ~seen[way]
        sums = np.stack([np.where(fresh, low[way], _NONE), *[np.where(fresh, v[way], 0) for v in (convs, children, below_leaves, below_saved)]])
        seen[way] = True
        yield _columns(1, kind=["open"], path=[shard.paths[at]], chars=[shard.chars[at]], sums=[sums.astype("<i8").tobytes()], part=[part])
    for at, ids in shard.open_ids.items():
        label = [trie.labels[trie.end[at]].tobytes()]
        for piece, begin in enumerate(range(0, len(ids), PIECE_IDS)):
            yield _columns(1, kind=["ids"], label=label, part=[part], piece=[piece], ids=[",".join(ids[begin : begin + PIECE_IDS])])


def _upper_rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open nodes of all shards, as a trie of their own whose sums are completed."""
    rows = sorted((row for batch in found for row in zip(*[batch.column(c).to_pylist() for c in ("path", "chars", "sums")], strict=True)), key=lambda row: row[0])
    if not rows:
        return
    trie = LevelOrderTrie([r[0] for r in rows], [r[1] for r in rows])
    n = len(trie.labels)
    low, convs, children, leaves, saved = np.full(n, _NONE, dtype=np.int64), *(np.zeros(n, dtype=np.int64) for _ in range(4))
    for at, (_, _, sums) in enumerate(rows):
        way = trie.way(at)
        given = np.frombuffer(sums, dtype="<i8").reshape(5, len(way))
        low[way] = np.minimum(low[way], given[0])
        for total, values in zip((convs, children, leaves, saved), given[1:], strict=True):
            total[way] += values
    children += trie.n_children
    saved, leaves = trie.add_up(saved + (convs - 1) * trie.chars), trie.add_up(leaves + (children == 0))
    parent = np.maximum(trie.parent, 0)
    for begin in range(0, n, 50_000):
        at = slice(begin, begin + 50_000)
        m = len(low[at])
        yield _columns(
            m, kind=["node"] * m, label=[v.tobytes() for v in trie.labels[at]], depth=trie.depth[at], conv_id=_known(low[at]), parent_conv_id=_known(low[parent[at]], trie.parent[at] >= 0),
            n_convs=convs[at], n_children=children[at], n_leaves=leaves[at], saved_tokens=saved[at],
        )


def _joined_ids(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the ids of each label, from pieces in order."""
    now, state = None, hashlib.sha256()
    row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["label", "ends_sha256"])
    for batch in found:
        for label, ids in zip(batch.column("label").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if label == now:
                state.update(b",")
            else:
                if now is not None:
                    yield row()
                now, state = label, hashlib.sha256()
            state.update(ids.encode())
    if now is not None:
        yield row()


def _in_ranges(paths: DataFrame, shard_turns: int) -> DataFrame:
    """The paths in order, dealt in so many ranges that one has about shard_turns turns at most."""
    spark = paths.sparkSession
    turns = paths.agg(F.sum(F.col("depth") + 1)).first()[0] or 0
    order = [F.col("path"), F.col("conv_id").asc_nulls_last()]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    return paths.repartitionByRange(shards, *order).sortWithinPartitions(*order)


def succinct_tries(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of each range of conversation_paths: part, n_nodes, louds (bits, eight a byte), labels (16 bytes a node), chars (4 bytes a node),
    and ends (the nodes, 8 bytes each, where its n_paths distinct paths end)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), _Shard(found)
        if shard.paths:
            trie = LevelOrderTrie(shard.paths, shard.chars)
            row = [part], [len(trie.labels)], [len(shard.paths)], [np.packbits(trie.bits).tobytes()], [trie.labels.tobytes()], [trie.chars.astype("<i4").tobytes()], [trie.end.astype("<i8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4], strict=True)], ["part", "n_nodes", "n_paths", "louds", "labels", "chars", "ends"])

    return _in_ranges(paths, shard_turns).mapInArrow(run, "part int, n_nodes long, n_paths long, louds binary, labels binary, chars binary, ends binary")


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of conversation_paths (conv_id, depth, path, chars).

    Columns: conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, characters of a
    node's turn for each member but one), ends_sha256 (of the ids of the members that end there, joined by commas).
    """
    shards = materialise(_in_ranges(paths, shard_turns).mapInArrow(_shard_rows, _SCHEMA), "shards")
    upper = materialise(shards.where("kind = 'open'").repartition(1).mapInArrow(_upper_rows, _SCHEMA), "upper")
    pieces = shards.where("kind = 'ids'").select("label", "part", "piece", "ids")
    digests = pieces.repartition("label").sortWithinPartitions("label", "part", "piece").mapInArrow(_joined_ids, "label binary, ends_sha256 string")
    top = upper.drop("ends_sha256").join(digests, "label", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    nodes = shards.where("kind = 'node'")
    names = upper.select(F.col("label").alias("parent"), F.col("conv_id").alias("parent_id"))
    if upper.count() <= BROADCAST_NODES:
        names = F.broadcast(names)
    below = nodes.where("parent IS NOT NULL").drop("parent_conv_id").join(names, "parent").withColumnRenamed("parent_id", "parent_conv_id")
    return nodes.where("parent IS NULL").select(*RESULT).unionByName(below.select(*RESULT)).unionByName(top.select(*RESULT))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, which share their first turns by the hundred."""
    paths = materialise(conversation_paths(table(spark, sf_dir, "conversations")), "paths")
    return prefix_trie(paths)
