"""Sinks: partitioned JSON lines, manifests, content identity and atomic publishing."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release_on_exit


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_jsonl(rows: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "gzip") -> None:
    """JSON lines with columns in order of name; one folder for each value of the partition columns; never overwrites."""
    ordered = rows.select(*[f"`{c}`" for c in sorted(rows.columns)])
    ordered.write.mode("errorifexists").option("compression", compression).option("ignoreNullFields", "false").partitionBy(*partition_by).json(path)


def write_sides(kept: DataFrame, rejected: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Kept rows and, beside them, the log of what was rejected and why."""
    write_jsonl(kept, f"{path}/kept", partition_by)
    write_jsonl(rejected, f"{path}/rejected")


def write_text_file(spark: SparkSession, path: str, body: str) -> None:
    """A small driver-side file (a manifest), by way of a .part file and a rename."""
    fs, part = _fs(spark, path + ".part")
    stream = fs.create(part, True)
    stream.write(bytearray(body.encode("utf-8")))
    stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    # one rename that replaces the old file: a reader sees the old body or the new one, never none
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri() if part.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def manifest(spark: SparkSession, path: str, counts: Mapping[str, DataFrame], **facts: object) -> dict:
    """A JSON manifest of facts and one-row aggregates."""
    body = {**facts, "counts": {name: df.first().asDict(recursive=True) for name, df in counts.items()}}
    write_text_file(spark, path, json.dumps(body, indent=2, ensure_ascii=False, default=str) + "\n")
    return body


#: Identities in one piece of the list that selection_identity hashes.
PIECE_ROWS = 5_000


def selection_identity(rows: DataFrame, keys: Sequence[str], id: str = "id") -> str:
    """SHA-256 of the canonical JSON of the list of the rows' identity columns, in order of id.

    Rows are put in order and written to text in ranges; such a digest is sequential, so one task then hashes the pieces, one at a time.
    """
    names = list(dict.fromkeys([*keys, id]))
    ordered = rows.select(*names).repartitionByRange(id).sortWithinPartitions(id)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        for frame in frames:
            for begin in range(0, len(frame), PIECE_ROWS):
                # values come as JSON, so null numbers stay null and whole
                some = frame.iloc[begin : begin + PIECE_ROWS].itertuples(index=False)
                held = [canonical_json({k: json.loads(v)["v"] for k, v in zip(keys, row, strict=True)}) for row in some]
                yield pd.DataFrame({"part": [part], "number": [number], "body": [",".join(held)]})
                number += 1

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, first = hashlib.sha256(b"["), True
        for frame in frames:
            for body in frame["body"]:
                state.update(("" if first else ",").encode() + body.encode())
                first = False
        state.update(b"]")
        yield pd.DataFrame({"identity": [state.hexdigest()]})

    coded = ordered.select(*[F.to_json(F.struct(F.col(k).alias("v")), {"ignoreNullFields": "false"}).alias(f"_{i}") for i, k in enumerate(keys)])
    listed = coded.mapInPandas(pieces, "part int, number int, body string")
    found = listed.repartition(1).sortWithinPartitions("part", "number").mapInPandas(digest, "identity string").first()
    return found[0] if found else hashlib.sha256(b"[]").hexdigest()


def content_identity(rows: DataFrame) -> DataFrame:
    """One row (rows, identity): an order-free identity of any number of rows, from sums over row hashes in one pass."""
    row = F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in sorted(rows.columns)]), {"ignoreNullFields": "false"}), 256)
    piece = lambda k: F.conv(F.substring("_h", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")
    sums = rows.select(row.alias("_h")).agg(F.count("*").alias("rows"), *[F.sum(piece(k)).alias(f"s{k}") for k in range(4)])
    return sums.select("rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), *[F.coalesce(F.col(f"s{k}").cast("string"), F.lit("")) for k in range(4)]), 256).alias("identity"))


def review_queue(rows: DataFrame, open_fields: Sequence[str] = ("reviewer", "confirmed_human_evidence", "confirmed_version_evidence", "review_decision")) -> DataFrame:
    """Rows with empty fields for a reviewer to fill."""
    return rows.withColumns({name: F.lit(None).cast("string") for name in open_fields})


def stage(rows: DataFrame, path: str) -> DataFrame:
    """A working inventory as Parquet, read back."""
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.parquet(path)


def publish(spark: SparkSession, path: str, build: Callable[[str], None], verify: Callable[[str], None] | None = None) -> None:
    """Builds in a temporary sibling, verifies it, then renames it into place; a non-empty target is never touched."""
    fs, target = _fs(spark, path)
    if fs.exists(target) and len(fs.listStatus(target)):
        raise FileExistsError(f"{path} is not empty")
    temporary = f"{path.rstrip('/')}.{uuid.uuid4().hex}.building"
    release_on_exit(spark, temporary)
    build(temporary)
    if verify:
        verify(temporary)
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(temporary), target):
        raise OSError(f"cannot publish {path}")
