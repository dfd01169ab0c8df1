"""Operator 4: sharding by jump consistent hashing, in DataFrame functions only.

Law `key`: doc_id and the number of shards decide the shard; going from n to n+1 shards moves a row only into the new
shard. The hash is the published jump consistent hash over 64 bits of the MD5 of doc_id; its 64-bit multiplication is done on
24-bit limbs, since long arithmetic must not overflow in ANSI mode.

Slots number the rows of a shard without gaps, by group, doc_id, checksum and size. They are not made by one window over a
shard: each shard is cut into GROUPS groups by a hash of doc_id and checksum, so rows of one doc_id spread over them too. Equal rows are
first counted, with map-side combine, then numbered inside their group; the groups' counts (GROUPS rows a shard, broadcast) give the
offsets. A row that occurs more often than COPIES times is written out again by several tasks.

Defined cases: a null text has size 1 and crc 0; a null doc_id is a key like any other; repeated rows get slots of
their own; an empty table gives an empty result. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise, table

#: Groups of a shard: the first three hexadecimal digits of an MD5.
GROUP_DIGITS = 3
#: Copies of a row that one task writes at once.
COPIES = 4096
_MULTIPLIER = 2862933555777941757
_LOW = (1 << 24) - 1
_M = (_MULTIPLIER & _LOW, (_MULTIPLIER >> 24) & _LOW, _MULTIPLIER >> 48)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to shards-1) of a 64-bit key."""
    return _jump(key.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, 24).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, 48), shards)


def shard_of(doc_id: Column, shards: int) -> Column:
    """The shard of an id: the first 64 bits of the MD5 of its text are the key."""
    digits = F.md5(_name(doc_id))
    limb = lambda at, n: F.conv(F.substring(digits, at, n), 16, 10).cast("long")
    return _jump(limb(11, 6), limb(5, 6), limb(1, 4), shards)


def _name(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def _jump(low: Column, middle: Column, high: Column, shards: int) -> Column:
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(low.alias("a"), middle.alias("b"), high.alias("c"), F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))

    def step(state: Column, _: Column) -> Column:
        a, b, c = state["a"], state["b"], state["c"]
        r0 = a * F.lit(_M[0]) + F.lit(1)
        r1 = a * F.lit(_M[1]) + b * F.lit(_M[0]) + F.shiftright(r0, 24)
        r2 = (a * F.lit(_M[2]) + b * F.lit(_M[1]) + c * F.lit(_M[0]) + F.shiftright(r1, 24)).bitwiseAND(F.lit(0xFFFF))
        r1 = r1.bitwiseAND(F.lit(_LOW))
        top = F.shiftleft(r2, 15) + F.shiftright(r1, 9)
        jump = F.floor((state["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (top + 1).cast("double"))).cast("long")
        moved = F.struct(r0.bitwiseAND(F.lit(_LOW)).alias("a"), r1.alias("b"), r2.alias("c"), state["next"].alias("shard"), jump.alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    # every step moves to a higher shard, so there are at most `shards` of them
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)["shard"].cast("int")


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, size, text_crc32, law, shard, slot and grown_shard (with one shard more)."""
    body = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    counted = slim.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    key = F.col("doc_id")
    group = F.substring(F.md5(F.concat_ws(":", _name(key), F.col("text_crc32").cast("string"))), 1, GROUP_DIGITS)
    placed = materialise(counted.withColumns({"shard": shard_of(key, shards), "grown_shard": shard_of(key, shards + 1), "group": group}), "sharded")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("shard", "group").agg(F.sum("n").alias("n"))
    before = earlier(Window.partitionBy("shard").orderBy("group"))
    offsets = sizes.select("shard", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = earlier(Window.partitionBy("shard", "group").orderBy("doc_id", "text_crc32", "size"))
    first = placed.withColumn("rank", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(offsets), ["shard", "group"]).withColumn("first", F.col("offset") + F.col("rank"))
    columns = ["doc_id", "size", "text_crc32", "shard", "grown_shard"]
    few = first.where(F.col("n") <= COPIES).select(*columns, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    end = F.col("first") + F.col("n") - 1
    blocks = first.where(F.col("n") > COPIES).select(*columns, end.alias("end"), F.explode(F.sequence(F.col("first"), end, F.lit(COPIES).cast("long"))).alias("begin"))
    many = blocks.repartition("begin").select(*columns, F.explode(F.sequence(F.col("begin"), F.least(F.col("begin") + COPIES - 1, F.col("end")))).alias("slot"))
    return few.unionByName(many).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in shards 0 to 7."""
    return shard_documents(table(spark, sf_dir, "documents"), 8)
