"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots. Bytes are aggregated per slot, and a
versioned slot-to-shard map, a small stored table, says where each slot lives. Rebalancing
edits the map: slots stay where they are while their shard is under its fair share, and only
the overflow moves. Documents are never shuffled: the map (one row per slot, at most
``SLOTS`` rows) is joined to them by broadcast.

Defined results: a null text counts as empty; a null id hashes like any value, together
with the text's checksum, so null or repeated ids with different texts still spread over the slots;
exact repeats of a row share a slot and get different places in their shard (a slot is never split, so sizes are as near equal as the bytes
of the largest set of equal rows allow); an empty table
gives no rows; extra columns are ignored. Everything is DataFrame or SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import checkpoint, let, shared_path, table

SLOTS = 4096
SHARDS = 24
#: bytes counted for a record besides its text
OVERHEAD = 8
#: pieces into which the numbering of one slot's rows is split
SALTS = 32

MAP_SCHEMA = "version long, slot int, shard int, bytes long, n_rows long"


def digest(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot and a salt for numbering; no text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
                    F.crc32(text).alias("text_crc32"))
    return d.select("*", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int").alias("virtual_slot"),
                    F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"))


def slot_bytes(d: DataFrame) -> DataFrame:
    """slot, bytes, n_rows: at most one row per slot."""
    return d.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def edit_map(weights: DataFrame, shards: int, old: DataFrame | None = None, version: int = 1) -> DataFrame:
    """The next version of the slot map for the given bytes per slot.

    Slots are taken from the heaviest down. One with a shard below ``shards`` in ``old`` stays
    there while that keeps the shard within its fair share; the others are then placed on the least
    loaded shard, again from the heaviest down. The fold runs in one row over at most
    ``SLOTS`` entries, whatever the size of the data.
    """
    if old is None:
        w = weights.withColumn("home", F.lit(-1))
    else:
        w = weights.join(F.broadcast(old.select("slot", F.col("shard").alias("home"))), "slot", "left")
        w = w.withColumn("home", F.when(F.col("home") < shards, F.col("home")).otherwise(-1))
    row = w.agg(F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "slot", "n_rows", F.coalesce("home", F.lit(-1)).alias("home"))))).alias("items"))
    fair = f"(aggregate(items, 0L, (a, x) -> a + x.bytes) / {shards})"
    zero = f"transform(sequence(1, {shards}), i -> 0L)"
    # (loads, the chosen shard of each item in order); -1 means: not placed in this pass
    stay = (f"aggregate(items, struct({zero} AS loads, cast(array() AS array<int>) AS at), (a, x) -> CASE "
            f"WHEN x.home >= 0 AND get(a.loads, x.home) + x.bytes <= fair THEN struct("
            "transform(a.loads, (l, i) -> IF(i = x.home, l + x.bytes, l)) AS loads, array_append(a.at, x.home) AS at) "
            "ELSE struct(a.loads AS loads, array_append(a.at, -1) AS at) END)")
    place = ("aggregate(arrays_zip(items, kept.at), struct(kept.loads AS loads, cast(array() AS array<int>) AS at), (a, x) -> CASE "
             "WHEN x.at >= 0 THEN struct(a.loads AS loads, array_append(a.at, x.at) AS at) "
             "ELSE struct(transform(a.loads, (l, i) -> IF(i = cast(array_position(a.loads, array_min(a.loads)) AS int) - 1, l + x.items.bytes, l)) AS loads, "
             "array_append(a.at, cast(array_position(a.loads, array_min(a.loads)) AS int) - 1) AS at) END)")
    placed = row.selectExpr("items", f"{fair} AS fair").selectExpr("items", f"{stay} AS kept").selectExpr("items", f"{place} AS done")
    return (placed.select(F.explode(F.arrays_zip("items", F.col("done.at").alias("at"))).alias("x"))
            .select(F.lit(version).cast("long").alias("version"), F.col("x.items.slot").alias("slot"), F.col("x.at").alias("shard"),
                    F.col("x.items.bytes").alias("bytes"), F.col("x.items.n_rows").alias("n_rows")))


def store_map(slot_map: DataFrame, folder: str) -> None:
    """Append a version of the map to the table in ``folder``."""
    slot_map.coalesce(1).write.mode("append").parquet(folder)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest unless told otherwise."""
    m = spark.read.schema(MAP_SCHEMA).parquet(folder)
    if version is None:
        version = m.agg(F.max("version")).first()[0] or 0
    return m.where(F.col("version") == version)


def assign(d: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Digest rows with shard and their place in it (``slot``, gapless from 0).

    Places are counted in two steps, so that no task sees a whole shard or a whole hot slot:
    rows are numbered inside (virtual slot, salt), and the counts of these at most
    ``SLOTS * SALTS`` groups give each group's first place.
    """
    at = d.join(F.broadcast(slot_map.select(F.col("slot").alias("virtual_slot"), "shard")), "virtual_slot")
    group = ["shard", "virtual_slot", "salt"]
    before = W.partitionBy("shard").orderBy("virtual_slot", "salt").rowsBetween(W.unboundedPreceding, -1)
    first = at.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = W.partitionBy(*group).orderBy("doc_id", "text_crc32", "size")
    return (at.withColumn("nth", F.row_number().over(inside).cast("long") - 1).join(first, group)
            .withColumn("slot", F.col("first") + F.col("nth")))


def shard(docs: DataFrame, shards: int = SHARDS, folder: str | None = None) -> DataFrame:
    """Shard ``docs`` by bytes with a new map, stored in ``folder`` as version 1."""
    spark = docs.sparkSession
    d = checkpoint(digest(docs))
    folder = folder or shared_path(spark, "slot-map")
    store_map(edit_map(slot_bytes(d), shards), folder)
    return assign(d, load_map(spark, folder, 1))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 whose sizes are near equal (law ``bytes``)."""
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


QUERIES = {"op2_sharding": op2_sharding}
SQL: dict[str, str] = {}
