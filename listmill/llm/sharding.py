"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of it modulo ``SLOTS``, for good. Shards own slots: the map
is a stored table of (version, slot, shard), and rebalancing adds a version in which
some slots have moved. Bytes and rows are summed per slot, so whatever the table's
size the map is made from ``SLOTS`` rows.

Law: ``bytes``. The first version deals the slots out in turn. Rebalancing takes from
each shard the slots that lift it over the mean and gives them, largest first, to the
shard that has least; the same edit fills a shard that is added.

A slot that holds more than an eighth of a shard, as the many copies of one row make it, is
dealt out: its rows go to all slots by their place in the table. They are stored with
their slots, so that a lost task cannot deal them out anew.

A record's place in its shard is its place in its slot behind the slots before, so no
task ranks more than one slot.

Defined cases: a null text has no bytes (size 8, CRC of nothing); a null id is hashed
like any value; equal rows share a slot, unless it is dealt out, and get places of their own; no
rows give no rows. Columns other than id and text play no part in the slot.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listmill.llm.common import stored, table
from listmill.session import work_dir

SLOTS = 4096
SHARDS = 24
# What a record takes besides its text.
ROW_BYTES = 8
LAW = "bytes"
# Slots are dealt out if fewer than this many would fill a shard.
LEAST_SLOTS = 8

_MAP = "version int, slot int, shard int, first_place long"


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slot_of(*columns: Column, slots: int = SLOTS) -> Column:
    """Virtual slot of a record."""
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def slot_totals(records: DataFrame) -> DataFrame:
    """Bytes and rows per slot, from (slot, size)."""
    return records.groupBy("slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def rebalanced(owners: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Owners of the slots after moving those that lift a shard over the mean."""
    mean = sum(sizes.values()) / shards
    held: dict[int, int] = dict.fromkeys(range(shards), 0)
    kept: dict[int, int] = {}
    moved = []
    for slot in sorted(owners, key=lambda s: (-sizes.get(s, 0), s)):
        shard, size = owners[slot], sizes.get(slot, 0)
        if shard in held and held[shard] + size <= mean:
            held[shard] += size
            kept[slot] = shard
        else:
            moved.append(slot)
    least = [(size, shard) for shard, size in held.items()]
    heapq.heapify(least)
    for slot in moved:
        size, shard = heapq.heappop(least)
        kept[slot] = shard
        heapq.heappush(least, (size + sizes.get(slot, 0), shard))
    return kept


def _by_slot(totals: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Bytes and rows of each slot."""
    found = totals.collect()  # one row per slot
    return {r["slot"]: r["bytes"] for r in found}, {r["slot"]: r["rows"] for r in found}


class SlotMap:
    """The stored versions of a slot-to-shard map; all of it is ``slots`` rows a version."""

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path, slots

    def write(self, version: int, owners: dict[int, int], rows: dict[int, int]) -> None:
        """Add a version, with the number of rows in front of each slot in its shard."""
        front: dict[int, int] = {}
        entries = []
        for slot in sorted(owners):
            shard = owners[slot]
            entries.append((version, slot, shard, front.get(shard, 0)))
            front[shard] = front.get(shard, 0) + rows.get(slot, 0)
        frame = self.spark.createDataFrame(entries, _MAP).coalesce(1)
        frame.write.mode("append").parquet(self.path)

    def read(self, version: int) -> DataFrame:
        rows = self.spark.read.schema(_MAP).parquet(self.path)
        return rows.where(F.col("version") == version).drop("version")

    def create(self, shards: int) -> dict[int, int]:
        """Version 1: slots in turn."""
        owners = {slot: slot % shards for slot in range(self.slots)}
        self.write(1, owners, {})
        return owners

    def rebalance(self, version: int, totals: DataFrame, shards: int) -> int:
        """Edit the newest version by the slots' bytes; returns the new version."""
        owners = {r["slot"]: r["shard"] for r in self.read(version).collect()}
        sizes, rows = _by_slot(totals)
        self.write(version + 1, rebalanced(owners, sizes, shards), rows)
        return version + 1


def heavy_slots(sizes: dict[int, int], rows: dict[int, int], shards: int) -> list[int]:
    """Slots of several rows with more than their share of a shard."""
    most = sum(sizes.values()) / shards / LEAST_SLOTS
    return sorted(slot for slot, size in sizes.items() if size > most and rows[slot] > 1)


def balanced(records: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """The records with their final slots, and (slot, shard, first_place) of a new map for them.

    ``records`` has slot and size; those of heavy slots are stored with the slots they are dealt to.
    """
    spark = records.sparkSession
    totals = stored(slot_totals(records), "slot-totals")
    heavy = heavy_slots(*_by_slot(totals), shards)
    if heavy:
        is_heavy = F.col("slot").isin(heavy)
        dealt = records.where(is_heavy).withColumn("slot", slot_of(F.monotonically_increasing_id()))
        dealt = stored(dealt, "dealt-out")
        records = records.where(~is_heavy).unionByName(dealt)
        totals = totals.where(~is_heavy).unionByName(slot_totals(dealt))
        totals = totals.groupBy("slot").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    slot_map = SlotMap(spark, work_dir(spark, "slot-map"))
    slot_map.create(shards)
    return records, slot_map.read(slot_map.rebalance(1, totals, shards))


def _slotted(documents: DataFrame, *keep) -> DataFrame:
    text = F.col("text")
    return documents.select(
        *keep,
        F.col("doc_id"),
        record_size(text).alias("size"),
        text_crc(text).alias("text_crc32"),
    ).withColumn("slot", slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("size")))


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with a column ``shard``, in place of one of that name."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c.lower() != "shard"]
    rows = _slotted(documents, F.struct(*rest).alias("row")).select("row", "slot", "size")
    rows, owners = balanced(rows, shards)
    # a map has SLOTS rows
    return rows.join(F.broadcast(owners), "slot").select("row.*", "shard")


def op8_shard(spark, sf_dir: str) -> DataFrame:
    """Shard of every document and its place there."""
    records = stored(_slotted(table(spark, sf_dir, "documents")), "shard-records")
    records, owners = balanced(records)
    in_slot = Window.partitionBy("slot").orderBy("doc_id", "text_crc32", "size")
    placed = records.withColumn("n", F.row_number().over(in_slot) - 1)
    return placed.join(F.broadcast(owners), "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("first_place") + F.col("n")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
