"""Shards by fixed virtual slots and a versioned map from slots to shards.

Records are hashed into thousands of slots that never change. Only the small map from slots to
shards is edited, so that adding a shard or evening out a hot one moves whole slots and nothing
else. Everything is DataFrame work in built-in functions.

Equal rows share a slot, so a row that is repeated more often than fits into a slot's share of all
bytes is spread over the slots: its repeats, which nothing tells apart, are hashed by their places in
the stored table. There are fewer such rows than slots.

Defined results: a null text counts no bytes but its eight bytes of overhead; equal rows keep a
place each; null keys hash like any other value; an empty table gives an empty map and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tonewright.sources.workspace import materialize

SLOTS = 4096
OVERHEAD = 8


def record_size(text: Column) -> Column:
    """Bytes of a record: its text in UTF-8 and a fixed overhead."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(OVERHEAD)


def virtual_slot(*key: Column, slots: int = SLOTS) -> Column:
    """The fixed slot of a record. The key should tell records apart, or one slot becomes hot."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame) -> DataFrame:
    """``slot_bytes`` and ``slot_rows`` of each virtual slot in use; at most one row for a slot."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows")
    )


def _deal(slots: DataFrame) -> DataFrame:
    """Gives the slots, largest first, to the shard with the fewest bytes so far.

    ``loads`` is the same array in all rows: the bytes that each shard has already. One row holds all slots, whose number is a fixed parameter and doesn't grow with the records.
    """
    ordered = F.sort_array(
        F.collect_list(F.struct("slot_bytes", "virtual_slot", "slot_rows")), asc=False
    )

    def place(state: Column, slot: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        return F.struct(
            F.transform(
                state["loads"], lambda load, i: load + F.when(i == least, slot["slot_bytes"]).otherwise(0)
            ).alias("loads"),
            F.concat(state["shards"], F.array(least)).alias("shards"),
        )

    start = F.struct(F.col("loads"), F.expr("cast(array() AS array<int>)").alias("shards"))
    packed = slots.agg(ordered.alias("slots"), F.first("loads").alias("loads")).withColumn(
        "dealt", F.aggregate("slots", start, place, lambda state: state["shards"])
    )
    pairs = F.explode(F.arrays_zip("slots", "dealt")).alias("pair")
    return packed.select(pairs).select("pair.slots.*", F.col("pair.dealt").alias("shard"))


def heavy_rows(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, text_crc32`` of repeated rows that have more than a slot's even share of all bytes.

    Only rows of slots that have twice that share are counted, so a table without such rows moves
    little. Fewer rows than slots.
    """
    share = F.sum("slot_bytes").over(Window.partitionBy()) / slots  # over one row for each slot
    crowded = slot_sizes(records).withColumn("share", share).where("slot_bytes > 2 * share")
    rows = records.join(F.broadcast(crowded.select("virtual_slot", "share")), "virtual_slot")
    alike = rows.groupBy("doc_id", "text_crc32").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.first("share").alias("share")
    )
    return alike.where("rows > 1 AND bytes > share").select("doc_id", "text_crc32")


def spread_heavy(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Stored records with the repeats of heavy rows in slots of their own, stored again if there are any."""
    heavy = materialize(heavy_rows(records, slots), "heavy-rows")
    if heavy.isEmpty():
        return records
    heavy = heavy.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"))
    placed = records.withColumn("__at", F.monotonically_increasing_id())
    same = placed["doc_id"].eqNullSafe(heavy["__id"]) & (placed["text_crc32"] == heavy["__crc"])
    met = placed.join(F.broadcast(heavy), same, "left")
    own = virtual_slot(F.col("doc_id"), F.col("text_crc32"), F.col("__at"), slots=slots)
    slot = F.when(F.col("__crc").isNull(), F.col("virtual_slot")).otherwise(own)
    return materialize(met.withColumn("virtual_slot", slot).select(records.columns), "spread-records")


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map ``(version, virtual_slot, shard, slot_bytes, slot_rows)``."""
    zeros = F.array_repeat(F.lit(0).cast("bigint"), shards)
    dealt = _deal(sizes.withColumn("loads", zeros))
    return dealt.select(
        F.lit(1).alias("version"), "virtual_slot", "shard", "slot_bytes", "slot_rows"
    )


def rebalance(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for newly measured sizes and, perhaps, more shards.

    A shard keeps its slots, the largest first, as long as they fit into an even share; only the
    overhang is dealt out again. A slot that was empty before counts as overhang.
    """
    measured = sizes.join(
        F.broadcast(current.select("virtual_slot", "shard", "version")), "virtual_slot", "left"
    )
    share = F.ceil(F.sum("slot_bytes").over(Window.partitionBy()) / shards)
    order = Window.partitionBy("shard").orderBy(F.desc("slot_bytes"), "virtual_slot")
    running = F.sum("slot_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
    judged = measured.withColumn("share", share).withColumn(
        "stays", F.col("shard").isNotNull() & (F.col("shard") < shards) & (running <= F.col("share"))
    )
    version = F.max("version").over(Window.partitionBy())
    judged = materialize(judged.withColumn("version", F.coalesce(version, F.lit(0)) + 1), "slots")
    kept = judged.where("stays")
    by_shard = kept.groupBy("shard").agg(F.sum("slot_bytes").alias("load"))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.coalesce(F.element_at(F.col("held"), i), F.lit(0)).cast("bigint"),
    )
    held = by_shard.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("shard").cast("int"), "load"))).alias("held")
    ).select(loads.alias("loads"))
    moved = judged.where("NOT stays").crossJoin(F.broadcast(held))  # one row of loads
    dealt = _deal(moved)
    columns = ["version", "virtual_slot", "shard", "slot_bytes", "slot_rows"]
    return kept.select(columns).unionByName(
        dealt.join(F.broadcast(judged.select("virtual_slot", "version")), "virtual_slot").select(columns)
    )


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds ``shard``, ``slot`` (place in the shard, gapless from 0) and ``map_version``.

    The places of a virtual slot follow those of the slots before it in the same shard, so only
    rows of one virtual slot are numbered together, never those of a shard. ``records`` has
    ``virtual_slot`` and is ordered within its slot by all of its columns.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot")
    begins = F.sum("slot_rows").over(before.rowsBetween(Window.unboundedPreceding, -1))
    starts = slot_map.select(
        "virtual_slot",
        "shard",
        F.coalesce(begins, F.lit(0)).cast("bigint").alias("begins"),
        F.col("version").alias("map_version"),
    )
    rank = F.row_number().over(
        Window.partitionBy("virtual_slot").orderBy(*(c for c in records.columns if c != "virtual_slot"))
    )
    numbered = records.withColumn("rank", rank)
    # at most one row for each of a fixed number of slots
    placed = numbered.join(F.broadcast(starts), "virtual_slot")
    return placed.withColumn("slot", F.col("begins") + F.col("rank") - 1).drop("begins", "rank")


def shard_records(
    docs: DataFrame, shards: int, slots: int = SLOTS, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Places all records by bytes; returns them with the stored map.

    The text is read once: its size and checksum are stored, and only these are placed.
    """
    body = F.col(text)
    checksum = F.crc32(F.coalesce(body, F.lit("")).cast("binary"))
    records = docs.select(
        F.col(key).alias("doc_id"), record_size(body).alias("size"), checksum.alias("text_crc32")
    ).withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots=slots))
    stored = spread_heavy(materialize(records, "records"), slots)
    slot_map = materialize(first_map(slot_sizes(stored), shards), "slot-map")
    return place(stored, slot_map), slot_map
