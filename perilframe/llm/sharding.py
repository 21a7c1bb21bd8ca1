"""Sharding over fixed virtual slots.

Records hash into a fixed number of slots; bytes are summed for each slot; a versioned map gives each slot's shard, and is
kept as a table of one folder a version. The first version deals slots to shards by size, largest first, each to the lightest
shard. Rebalancing edits the latest map and saves the next version: it moves slots only, records are never hashed anew.

Equal records are counted before the shuffle and told apart by their copy's number, so that a text or id that comes by the
million is spread over the slots like any other records.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.llm.common import shared_dir, written

SLOTS, SHARDS = 4096, 8
#: Copies of one record that are spread in one go.
COPIES = 65_536


def size():
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, text_hash, copy) of every row; equal rows have copies 0, 1, 2 and so on.

    Equal rows are one row until they are spread again, the many copies of one in runs of COPIES.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size().alias("size"), F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"), F.xxhash64("text").alias("text_hash"))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    few = rows.where(F.col("copies") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    runs = rows.where(F.col("copies") > COPIES).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    runs = runs.repartition("doc_id", "text_hash", "_from").withColumn("copy", F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES, F.col("copies")) - 1))).drop("_from")
    return few.unionByName(runs).drop("copies")


def virtual_slot(slots: int = SLOTS):
    """The slot of a record, by hash of its doc_id, text and copy number."""
    return F.pmod(F.xxhash64("doc_id", "text_hash", "copy"), F.lit(slots)).cast("int")


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, records) of all slots that hold ``records``: at most ``slots`` rows, summed before the shuffle."""
    return rows.select(virtual_slot(slots).alias("virtual_slot"), "size").groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))


def saved_map(slot_map: DataFrame, path: str) -> DataFrame:
    """Adds a version of the map to the table of versions at ``path``, and reads it back. A version that is there is an error."""
    version = slot_map.agg(F.max("version")).first()[0] or 1  # one number
    slot_map.select("virtual_slot", "shard", "bytes", "records").write.mode("error").parquet(f"{path}/version={version}")
    return latest_map(slot_map.sparkSession, path)


def latest_map(spark: SparkSession, path: str) -> DataFrame:
    """The map's latest version: version, virtual_slot, shard, bytes, records."""
    every = spark.read.schema("virtual_slot int, shard int, bytes long, records long, version int").parquet(path)
    last = every.agg(F.max("version")).first()[0]  # one number
    return every.where(F.col("version") == last).select("version", "virtual_slot", "shard", "bytes", "records")


def _dealt(slots_array, loads):
    """Each slot of an array to the lightest of the shards (structs of bytes and shard), in the array's order."""
    start = F.struct(loads.alias("loads"), F.array().cast("array<struct<virtual_slot:int,bytes:bigint,records:bigint,shard:int>>").alias("out"))

    def deal(acc, s):
        lightest = F.array_min(acc["loads"])
        loads = F.transform(acc["loads"], lambda x: F.when(x == lightest, F.struct((x["bytes"] + s["bytes"]).alias("bytes"), x["shard"].alias("shard"))).otherwise(x))
        return F.struct(loads.alias("loads"), F.concat(acc["out"], F.array(F.struct(s["virtual_slot"].alias("virtual_slot"), s["bytes"].alias("bytes"), s["records"].alias("records"), lightest["shard"].alias("shard")))).alias("out"))

    return F.aggregate(slots_array, start, deal)["out"]


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: (version, virtual_slot, shard, bytes, records). One row holds the slots meanwhile; their number is fixed."""
    by_size = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "bytes", "records"))), lambda s: F.struct(s["virtual_slot"].alias("virtual_slot"), s["bytes"].alias("bytes"), s["records"].alias("records")))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(F.lit(0).cast("long").alias("bytes"), i.alias("shard")))
    dealt = sizes.agg(by_size.alias("s")).select(F.inline(_dealt(F.col("s"), loads)))
    return dealt.select(F.lit(1).alias("version"), "virtual_slot", "shard", "bytes", "records")


def grown_map(slot_map: DataFrame) -> DataFrame:
    """The next version, with one more shard: each old shard gives up slots, its smallest first, until it holds its new
    share; only the new shard takes any. All other slots stay where they are."""
    total = slot_map.agg(F.sum("bytes").alias("total"), F.max("shard").alias("last"), F.max("version").alias("was"))
    order = Window.partitionBy("shard").orderBy("bytes", "virtual_slot")
    held = Window.partitionBy("shard")
    rows = slot_map.crossJoin(F.broadcast(total)).withColumn("gone", F.sum("bytes").over(order)).withColumn("held", F.sum("bytes").over(held))
    moves = F.col("held") - F.col("gone") >= F.col("total") / (F.col("last") + 2)
    return rows.select((F.col("was") + 1).alias("version"), "virtual_slot", F.when(moves, F.col("last") + 1).otherwise(F.col("shard")).alias("shard"), "bytes", "records")


def rebalanced_map(slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """The next version for slots whose sizes have changed: shards over their share give up slots, smallest first, as far as
    they stay at their share or above; those go to shards below theirs, in order of size, as their room lasts.

    sizes: as from ``slot_sizes``, now; slots that are new to the map go where there is room. All other slots stay. Windows
    run over the fixed number of slots.
    """
    was = slot_map.agg(F.max("version").alias("was"), (F.max("shard") + 1).alias("shards"))
    now = sizes.join(slot_map.select("virtual_slot", "shard"), "virtual_slot", "left").crossJoin(F.broadcast(was))
    now = now.withColumn("share", F.sum("bytes").over(Window.partitionBy("was")) / F.col("shards"))
    order = Window.partitionBy("shard").orderBy("bytes", "virtual_slot")
    moves = F.col("shard").isNull() | (F.sum("bytes").over(Window.partitionBy("shard")) - F.sum("bytes").over(order) >= F.col("share"))
    now = now.withColumn("moves", moves)
    held = now.where("NOT moves").groupBy("shard").agg(F.sum("bytes").alias("held"))
    room = now.select("shards", "share").distinct().select("share", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")).join(held, "shard", "left")
    room = room.select("shard", F.greatest(F.lit(0.0), F.col("share") - F.coalesce("held", F.lit(0))).alias("room"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    room = room.select(F.col("shard").alias("_to"), (F.sum("room").over(upto) - F.col("room")).alias("_a"), F.sum("room").over(upto).alias("_b")).where("_b > _a")
    by_size = Window.orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    gone = now.where("moves").withColumn("_at", F.sum("bytes").over(by_size) - F.col("bytes") / 2)
    gone = gone.join(F.broadcast(room), (F.col("_at") >= F.col("_a")) & (F.col("_at") < F.col("_b")), "left")  # at most one stretch of room holds a point
    gone = gone.withColumn("shard", F.coalesce("_to", "shard", F.lit(0)))
    columns = [(F.col("was") + 1).alias("version"), "virtual_slot", "shard", "bytes", "records"]
    return now.where("NOT moves").select(*columns).unionByName(gone.select(*columns))


def sharded(rows: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and slot of every record; slot is its place in its shard, gapless from 0.

    Rows are numbered within their virtual slot (a window over one slot's rows, ids and numbers only), then moved up by
    the rows of the shard's slots before it. The map has at most ``slots`` rows and is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(F.col("virtual_slot").alias("_slot"), "shard", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("start"))
    rows = rows.withColumn("virtual_slot", virtual_slot(slots))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "text_hash", "copy")
    rows = rows.withColumn("place", F.row_number().over(within) - 1)
    return rows.join(F.broadcast(starts), F.col("virtual_slot") == F.col("_slot")).select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("start") + F.col("place")).alias("slot"))


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """All documents in shards 0 to 7 by bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot.

    A null text has size 1 and CRC 0 (that of empty bytes). Repeated rows are spread and take a slot each; ties are in any
    order, as such rows are equal. The first version of the map is saved at ``path`` (a new folder of the shared one if it isn't
    given), and its latest version is used. The law is ``bytes``, so grown_shard is null; ``grown_map`` adds shards.
    """
    rows = written(records(docs), "records")
    slot_map = saved_map(first_map(slot_sizes(rows)), path or f"{shared_dir(docs.sparkSession)}/slot-map-{uuid.uuid4().hex}")
    out = sharded(rows, slot_map)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
