"""Files whose records aren't lines, read in byte ranges by many tasks.

Spark's text reader deals ranges of a file to tasks and cuts each at a separator; a block is what one range gives. A block is read as a stream: records that
lie whole in it are rows, and what goes on in a neighbour is a piece. There are at most a few pieces a block, and only they are put together afterwards, so no file,
and no order over all rows, is in one task. Files that can't be split (gzip) are one block, read as a stream all the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import materialise

_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}


def text_blocks(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """(file, block, value): what stands between separators (line ends), in order within a block; block is where it begins in the file."""
    reader = spark.read.option("recursiveFileLookup", True)
    if separator is not None:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def by_block(rows: DataFrame, keys: Sequence[str], read: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """What `read` makes of every block: of neighbouring rows of equal keys. It takes the keys and a stream of the other columns' values."""
    others = [c for c in rows.columns if c not in keys]
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for batch in found for row in zip(zip(*[batch.column(k).to_pylist() for k in keys], strict=True), zip(*[batch.column(c).to_pylist() for c in others], strict=True), strict=True))
        for key, block in groupby(flat, key=lambda row: row[0]):
            out = iter(read(key, (values for _, values in block)))
            while some := list(islice(out, 500)):
                yield pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], list(names))

    return rows.mapInArrow(run, schema)


def joined_pieces(pieces: DataFrame, stream: Sequence[str], order: Sequence[str], opens: Column) -> DataFrame:
    """(stream, record, pieces array<struct>): pieces in order, a new record at each that opens one; record 0 is what stands before the first.

    `pieces` has a few rows a block. The window runs over these alone, and no array holds more than one record's.
    """
    columns = [c for c in pieces.columns if c not in stream]
    run = Window.partitionBy(*stream).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("record", F.sum(opens.cast("long")).over(run))
    return numbered.groupBy(*stream, "record").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in columns if c not in order]))).alias("pieces"))


# a JSON array of objects

_TOKEN = re.compile(r'\\.|["{}\[\],]|[^\s"{}\[\],\\]+', re.DOTALL)


def _balance(key: tuple, values: Iterator[tuple]) -> Iterator[tuple]:
    """Of a block: whether its quotes are odd in number, and how the depth changes if it begins outside or inside a string."""
    odd, change = False, [0, 0]
    for (value,) in values:
        for found in _TOKEN.finditer(value + "}"):
            token = found[0]
            if token == '"':
                odd = not odd
            elif token in "{[":
                change[odd] += 1
            elif token in "}]":
                change[odd] -= 1
    yield *key, odd, *change


def _elements(key: tuple, values: Iterator[tuple]) -> Iterator[tuple]:
    """(file, block, kind, body) of a block: whole elements, and the pieces of those that began before it or go on behind it."""
    file, block, inside, depth = key
    kind, body = ("whole", []) if depth < 2 else ("head", [])
    for (value,) in values:
        value += "}"  # the separator; behind the end of a file it stands outside of the array
        start = 0 if depth >= 2 else None
        for found in _TOKEN.finditer(value):
            token = found[0]
            if inside:
                inside = token != '"'
            elif token == '"':
                inside = True
                if depth < 2:
                    raise ValueError(f"not an array of objects: {file}")
            elif token in "{[":
                depth += 1
                if depth == 2:
                    start = found.start()
                    if token == "[":  # an array in the array
                        raise ValueError(f"not an array of objects: {file}")
            elif token in "}]":
                depth -= 1
                if depth == 1:
                    yield file, block, kind, "".join([*body, value[start : found.end()]])
                    kind, body, start = "whole", [], None
                elif depth == 0:
                    return
            elif depth < 2 and token != ",":
                raise ValueError(f"not an array of objects: {file}")
        if start is not None:
            body.append(value[start:])
    if body or depth >= 2:
        yield file, block, "middle" if kind == "head" else "tail", "".join(body)


def json_array(spark: SparkSession, path: str) -> DataFrame:
    """(file, body) of every element of files that hold one JSON array of objects each, whatever its lines; body is an element's JSON.

    A first pass notes for each block how quotes and brackets balance, for either state that it can begin in; the states then follow from the blocks before, and a
    second pass cuts the elements.
    """
    raw = text_blocks(spark, path, "}")
    balance = materialise(by_block(raw, ["file", "block"], _balance, "file string, block long, odd boolean, outside long, inside long"), "balance")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = balance.withColumn("within", F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1)
    # a block that begins inside a string has its even quotes inside: what it counted as outside is text then
    states = states.withColumn("change", F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside")))
    # behind the closing bracket the last separator is read, which the file doesn't have
    broken = states.groupBy("file").agg(F.sum("change").alias("left")).where("left <> -1").first()
    if broken is not None:
        raise ValueError(f"the array doesn't end: {broken['file']}")
    states = states.select("file", "block", "within", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"))
    # one row a block: their number is that of the ranges that Spark reads; a broadcast keeps the rows of a block in order
    started = raw.join(F.broadcast(states), ["file", "block"]).select("file", "block", "within", "depth", "value")
    found = materialise(by_block(started, ["file", "block", "within", "depth"], _elements, "file string, block long, kind string, body string"), "elements")
    parts = found.where("kind <> 'whole'").withColumn("order", F.when(F.col("kind") == "tail", 1).otherwise(0))
    joined = joined_pieces(parts, ["file"], ["block", "order"], F.col("kind") == "tail")
    ended = F.element_at("pieces", -1)["kind"] == "head"
    body = F.array_join(F.transform("pieces", lambda p: p["body"]), "")
    cut = joined.select("file", F.when((F.col("record") > 0) & ended, body).otherwise(F.raise_error(F.concat(F.lit("the array doesn't end: "), F.col("file")))).alias("body"))
    return found.where("kind = 'whole'").select("file", "body").unionByName(cut)


# marked-up documents, one tag a line


def _documents(key: tuple, values: Iterator[tuple]) -> Iterator[tuple]:
    """(file, block, kind, line, body) of a block: whole documents, pieces, and last the number of its lines."""
    file, block = key
    kind, begin, lines, number = "head", 0, [], 0
    for (line,) in values:
        number += 1
        if line.lstrip().startswith("<DOC "):
            if kind == "tail" and lines:
                raise ValueError(f"nested document at {file}, block {block}, line {number}")
            if kind == "head" and any(x.strip() for x in lines):
                yield file, block, "middle", 0, "\n".join(lines)  # something open can't end any more
            kind, begin, lines = "tail", number, []
        elif kind == "outside":
            continue
        lines.append(line)
        if line.strip() == "</DOC>":
            yield file, block, "whole" if kind == "tail" else "head", begin, "\n".join(lines)
            kind, lines = "outside", []
    if kind == "tail" or (kind == "head" and lines):
        yield file, block, "tail" if kind == "tail" else "middle", begin, "\n".join(lines)
    yield file, block, "lines", number, None


def marked_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, body) of every <DOC ...>...</DOC> block, one tag a line, plain or gzip; line is where it begins, from 1. Nested or open ones fail the job."""
    raw = text_blocks(spark, path)
    found = materialise(by_block(raw, ["file", "block"], _documents, "file string, block long, kind string, line long, body string"), "documents")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.where("kind = 'lines'").select("file", "block", F.coalesce(F.sum("line").over(before), F.lit(0)).alias("above"))
    placed = found.where("kind <> 'lines'").join(F.broadcast(counts), ["file", "block"]).withColumn("line", F.col("line") + F.col("above"))
    parts = placed.where("kind <> 'whole'").withColumn("order", F.when(F.col("kind") == "tail", 1).otherwise(0)).drop("above")
    joined = joined_pieces(parts, ["file"], ["block", "order"], F.col("kind") == "tail")
    # from its opening on, a document may have middles and has one end; lines outside of documents are middles as well
    first, ends = F.element_at("pieces", 1), F.size(F.filter("pieces", lambda p: p["kind"] == "head"))
    end = F.array_position(F.transform("pieces", lambda p: p["kind"]), "head").cast("int")
    body = F.array_join(F.transform(F.slice("pieces", 1, end), lambda p: p["body"]), "\n")
    blank = F.forall(F.col("pieces"), lambda p: (p["kind"] == "middle") & ~p["body"].rlike("<DOC |</DOC>"))
    wrong = F.raise_error(F.concat(F.lit("open document at "), F.col("file"), F.lit(":"), first["line"].cast("string")))
    cut = joined.where(~((F.col("record") == 0) & blank)).select("file", first["line"].alias("line"), F.when((F.col("record") > 0) & (ends == 1), body).otherwise(wrong).alias("body"))
    return placed.where("kind = 'whole'").select("file", "line", "body").unionByName(cut)


# articles in a stream of lines

_TITLE = re.compile(rf"[{t.SPACE}]*=[{t.SPACE}]+([^=\n]+?)[{t.SPACE}]+=[{t.SPACE}]*\Z")


def _articles(key: tuple, values: Iterator[tuple]) -> Iterator[tuple]:
    """The keys and (order, kind, title, begin, end, blank, before, after, body) of a range of lines: whole articles, and pieces.

    Its first and last lines are pieces of their own ("edge"), as it takes a neighbour to tell whether they are titles: before and after say
    whether the lines beside them are blank, and are null where those are in another range.
    """
    blank = lambda line: not (line or "").split()
    named = lambda line: (found := _TITLE.match(line or "")) and found[1].strip()
    order = 0

    def piece(kind: str, title: str | None, lines: list[tuple], before: bool | None = None, after: bool | None = None) -> tuple:
        nonlocal order
        order += 1
        return *key, order, kind, title, lines[0][0], lines[-1][0] + 1, all(blank(x) for _, x in lines), before, after, "".join(x or "" for _, x in lines)

    last, now = next(values), next(values, None)
    yield piece("edge", named(last[1]), [last], None, now and blank(now[1]))
    title, lines, kind = None, [], "head"
    while now is not None:
        after = next(values, None)
        name = named(now[1])
        if after is None:
            if lines:
                yield piece("tail" if kind == "whole" else kind, title, lines)
            yield piece("edge", name, [now], blank(last[1]), None)
        elif name and blank(last[1]) and blank(after[1]):
            if lines:
                yield piece(kind, title, lines)
            title, lines, kind = name, [now], "whole"
        else:
            lines.append(now)
        last, now = now, after


def stitched_articles(rows: DataFrame, position: str = "position", text: str = "text", part: Sequence[str] = ()) -> DataFrame:
    """(part, title, begin, end, text) of the articles in a stream of lines: one begins at a ` = Title = ` line between blank ones (or at the stream's ends).

    `part` names columns that cut the stream into independent ones. Lines are dealt in ranges of their order; text before the first title is an error.
    """
    names = [f"_part{i}" for i in range(len(part))]
    lines = rows.select(*[F.col(c).cast("string").alias(n) for c, n in zip(part, names, strict=True)], F.col(position).cast("long").alias("_at"), F.col(text).alias("_text"))
    order = [*names, "_at"]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_block", F.spark_partition_id().cast("long"))
    fields = [*[f"{n} string" for n in names], "_block long, order long, kind string, title string, begin long, end long, blank boolean, before boolean, after boolean, body string"]
    found = materialise(by_block(dealt, [*names, "_block"], _articles, ", ".join(fields)), "articles")
    # a line or two and a piece or two of each range
    beside = Window.partitionBy(*names).orderBy("_block", "order")
    edges = found.where("kind = 'edge'").withColumns({"before": F.coalesce("before", F.lag("blank").over(beside), F.lit(True)), "after": F.coalesce("after", F.lead("blank").over(beside), F.lit(True))})
    edges = edges.withColumn("title", F.when(F.col("before") & F.col("after"), F.col("title")))
    parts = edges.unionByName(found.where("kind IN ('head', 'tail')"))
    joined = joined_pieces(parts, names, ["_block", "order"], F.col("title").isNotNull())
    each = lambda name: F.transform("pieces", lambda p: p[name])
    if not joined.where((F.col("record") == 0) & ~F.forall("pieces", lambda p: p["blank"])).isEmpty():
        raise ValueError("text before the first article title")
    columns = [F.element_at("pieces", 1)["title"].alias("title"), F.array_min(each("begin")).alias("begin"), F.array_max(each("end")).alias("end"), F.array_join(each("body"), "").alias("text")]
    cut = joined.where("record > 0").select(*names, *columns)
    out = found.where("kind = 'whole'").select(*names, "title", "begin", "end", F.col("body").alias("text")).unionByName(cut)
    kinds = {c: rows.schema[c].dataType for c in part}
    return out.select(*[F.col(n).cast(kinds[c]).alias(c) for c, n in zip(part, names, strict=True)], "title", "begin", "end", "text")
