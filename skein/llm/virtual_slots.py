"""Sharding over a fixed number of virtual slots.

A record is hashed into one of ``SLOTS`` virtual slots; bytes and rows are summed per slot; a
versioned table maps slots to shards and is all that changes when shards are rebalanced. Records
never move between slots, so a move of a slot moves exactly that slot's rows.

* ``first_map``: largest slot first, each to the shard with the fewest bytes so far.
* ``rebalanced``: edits a map for new sizes or for more shards: while a shard is above the mean,
  its largest slot that still lies above the mean line goes to the lightest shard; all other
  slots stay where they are.
* ``shard_documents`` stores the first map as version 1, assigns from what it reads back, and stores
  the edited map for one more shard as version 2, which gives each row the shard it would have then.

Both run over one row per slot (``SLOTS`` rows, whatever the input), folded in a SQL ``aggregate``.
Records are hashed by id and content, so copies of one text spread over the slots; rows equal in
id and text share a slot, and with it a shard. Null texts have no bytes and size 1; a null id hashes by its text.
An empty table stores a map without slots. A text of any length is one row of its size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.session import checkpoint_dir, write_table

#: Virtual slots: some hundred for each shard, so that one slot is a small part of a shard.
SLOTS = 8_192


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot: narrow rows, no text goes through a shuffle."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return (docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
                        F.crc32(data).alias("text_crc32"))
            .withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots)).cast("int")))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """virtual_slot, bytes, rows: at most one row per slot."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def _sorted_slots(sizes: DataFrame, *more: str) -> DataFrame:
    fields = F.struct((-F.col("bytes")).alias("b"), F.col("virtual_slot").alias("s"), *more)
    return sizes.agg(F.sort_array(F.collect_list(fields)).alias("slots"))


def _at(array: Column, i: Column) -> Column:
    return F.element_at(array, i + 1)


def _add(loads: Column, shard: Column, bytes_: Column) -> Column:
    return F.transform(loads, lambda x, i: F.when(i == shard, x + bytes_).otherwise(x))


def _lightest(loads: Column) -> Column:
    return F.array_position(loads, F.array_min(loads)).cast("int") - 1


def first_map(sizes: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """version, virtual_slot, shard: one row for each slot in ``sizes``."""
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("to"))

    def place(acc: Column, slot: Column) -> Column:
        shard = _lightest(acc["loads"])
        return F.struct(_add(acc["loads"], shard, -slot["b"]).alias("loads"), F.array_append(acc["to"], shard).alias("to"))

    placed = _sorted_slots(sizes).select("slots", F.aggregate("slots", start, place)["to"].alias("to"))
    return (placed.select(F.explode(F.arrays_zip("slots", "to")).alias("x"))
            .select(F.lit(version).alias("version"), F.col("x.slots.s").alias("virtual_slot"), F.col("x.to").alias("shard")))


def rebalanced(old: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, for the sizes of now and ``shards`` shards (as many or more).

    A slot without an entry (new since the last version) goes to the lightest shard. A shard
    above the mean gives away slots, largest first, as long as it stays at the mean or above.
    """
    now = sizes.join(old.select("virtual_slot", "shard"), "virtual_slot", "left")
    version = (old.agg(F.max("version")).first()[0] or 0) + 1
    slots = _sorted_slots(now, F.coalesce("shard", F.lit(-1)).alias("at"))
    zero = F.array_repeat(F.lit(0).cast("long"), shards)
    loads = F.aggregate("slots", zero, lambda acc, x: _add(acc, x["at"], -x["b"]))
    mean = F.aggregate("slots", F.lit(0).cast("long"), lambda acc, x: acc - x["b"]) / F.lit(shards)
    start = F.struct(F.col("loads").alias("loads"), F.array().cast("array<int>").alias("to"))

    def move(acc: Column, x: Column) -> Column:
        size, light = -x["b"], _lightest(acc["loads"])
        goes = (x["at"] < 0) | ((_at(acc["loads"], x["at"]) - size >= F.col("mean")) &
                                (F.array_min(acc["loads"]) + size <= F.col("mean")))
        to = F.when(goes, light).otherwise(x["at"])
        left = F.when(goes & (x["at"] >= 0), _add(acc["loads"], x["at"], -size)).otherwise(acc["loads"])
        return F.struct(F.when(goes, _add(left, light, size)).otherwise(left).alias("loads"),
                        F.array_append(acc["to"], to).alias("to"))

    moved = (slots.withColumn("loads", loads).withColumn("mean", mean)
             .select("slots", F.aggregate("slots", start, move)["to"].alias("to"))
             .select(F.explode(F.arrays_zip("slots", "to")).alias("x"))
             .select(F.col("x.slots.s").alias("virtual_slot"), F.col("x.to").alias("shard")))
    return moved.select(F.lit(version).alias("version"), "virtual_slot", "shard")


def assign(rows: DataFrame, sizes: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with shard and slot: the row's place in its shard, gapless from 0.

    A row's place is the number of rows in the shard's earlier virtual slots plus its rank within
    its own virtual slot, so no task ever orders a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = (sizes.join(slot_map.select("virtual_slot", "shard"), "virtual_slot")
              .withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
              .select("virtual_slot", "shard", "first"))
    own = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("rank", F.row_number().over(own) - 1)
            .join(F.broadcast(placed), "virtual_slot")  # one row per slot: SLOTS at most
            .withColumn("slot", (F.col("first") + F.col("rank")).cast("long"))
            .drop("first", "rank"))


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS,
                    path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, next_shard for every row,
    by equal bytes.

    The map is stored in the new folder ``path`` (by default one in the shared folder): version 1 places
    the rows, version 2 is version 1 edited for one more shard and gives ``next_shard``.
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/slot-map-{uuid.uuid4().hex}"
    rows = records(docs, doc_id, text, slots)
    sizes = write_table(slot_sizes(rows), "slot-sizes")
    write_map(first_map(sizes, shards), path)
    stored = read_map(spark, path, 1)
    write_map(rebalanced(stored, sizes, shards + 1), path)
    later = read_map(spark, path, 2).select("virtual_slot", F.col("shard").alias("next_shard"))
    return (assign(rows, sizes, stored).join(F.broadcast(later), "virtual_slot")  # one row per slot: SLOTS at most
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard"))


def write_map(slot_map: DataFrame, path: str) -> None:
    """Append a version to the stored map; older versions stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version of a stored map, or the latest."""
    stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version).select("version", "virtual_slot", "shard")
