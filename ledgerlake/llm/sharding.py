"""Shards by jump consistent hashing, and a gapless slot for every row of a shard, in DataFrame operations only.

A row's shard depends on its key and the number of shards, by no table. The published function walks a key through jumps:
after bucket b it draws the next bucket to which the key would move as shards are appended, and stops at the last one below
the number of shards. One more shard takes the keys whose next jump lands on just that shard; no other key moves.

Slots take one range shuffle of rows without texts, by shard and key: a row's place in its sorted partition, less the place of
the first of its shard there, plus the rows of that shard in partitions before. Equal rows are told apart by their place in
the stored table, so a key that holds a third of all rows is spread as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut, tasks_for

#: Fixed value: the multiplier of the published function's generator.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
#: Bits of a place within a partition in monotonically_increasing_id().
_PLACE = 33


def stable_key(key: Column) -> Column:
    """60 bits of the key's text, the same whatever its type, machine or engine; null is a key like any other."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _drawn(hi: Column, lo: Column) -> tuple[Column, Column]:
    """Halves of (hi:lo * MULTIPLIER + 1) modulo 2**64, in products below 2**63: overflow is an error in Spark."""
    m16, m32 = F.lit(0xFFFF), F.lit(0xFFFFFFFF)
    a = lo.bitwiseAND(m16) * F.lit(_LOW) + 1
    b = F.shiftright(lo, 16) * F.lit(_LOW) + F.shiftright(a, 16)
    low = F.shiftleft(b.bitwiseAND(m16), 16) + a.bitwiseAND(m16)
    c = F.shiftleft((F.shiftright(hi, 16) * F.lit(_LOW)).bitwiseAND(m16), 16) + (hi.bitwiseAND(m16) * F.lit(_LOW)).bitwiseAND(m32)
    high = (F.shiftright(b, 16) + (lo * F.lit(_HIGH)).bitwiseAND(m32) + c).bitwiseAND(m32)
    return high, low


def jump(key: Column, shards: int) -> Column:
    """Struct ``shard`` and ``next``: where a 60-bit key lies among ``shards``, and the shard that it would leave it for.

    A jump goes at least one shard on, so as many steps as shards are enough; most keys take about ln(shards).
    """
    start = F.struct(F.shiftright(key, 32).alias("hi"), key.bitwiseAND(F.lit(0xFFFFFFFF)).alias("lo"), F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))

    def step(s: Column, _: Column) -> Column:
        drawn = F.struct(*[c.alias(n) for c, n in zip(_drawn(s["hi"], s["lo"]), ("hi", "lo"), strict=True)])
        onward = F.get(F.transform(F.array(drawn), lambda d: F.struct(d["hi"].alias("hi"), d["lo"].alias("lo"), s["next"].alias("shard"), F.floor((s["next"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(d["hi"], 1) + 1))).cast("long").alias("next"))), F.lit(0))
        return F.when(s["next"] < shards, onward).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["next"].alias("next")))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ``size, text_crc32, law, shard, slot, grown_shard``.

    size: UTF-8 bytes of the text (null: none) and 16 for the rest of a record; text_crc32 that of these bytes. law is ``key``:
    id and number of shards decide, so rows of one id lie together, whatever their texts. grown_shard: where the row lies with
    one more shard, either there or where it was. slot: the row's place in its shard, by id (null first), size and checksum, without gaps from 0; equal
    rows get slots in the order in which they are stored. An empty table gives none. Other columns are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), jump(stable_key(F.col(id_col)), shards).alias("j"), F.monotonically_increasing_id().alias("at"))
    rows = cut(rows.select("id", "size", "text_crc32", F.col("j.shard").alias("shard"), F.when(F.col("j.next") == shards, shards).otherwise(F.col("j.shard")).cast("int").alias("grown_shard"), "at"), "sharded")
    order = ["shard", "id", "size", "text_crc32", "at"]
    placed = cut(rows.repartitionByRange(tasks_for(spark), *order).sortWithinPartitions(*order).drop("at").withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("place", _PLACE))
    parts = placed.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    # partitions are in the order of the shards: at most one row for each of both, and one more
    offsets = parts.select("shard", "part", (before - F.col("first")).alias("offset"))
    told = placed.join(F.broadcast(offsets), ["shard", "part"])
    return told.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("place") + F.col("offset")).alias("slot"), "grown_shard")
