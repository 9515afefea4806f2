"""Shards by virtual slots: rows hash to slots, and a versioned map gives slots to shards.

A rebalancing edits the map; rows never change their slot.
"""

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm.shared import cell, number_rows
from tastemap.sources.durable import durable, scratch_path

# Slots to hash into; the map and the bytes per slot are this long, whatever the corpus.
SLOTS = 4096
# A text whose copies weigh over one part in this many of all bytes is spread by row.
HEAVY = 16


@dataclass(frozen=True)
class SlotMap:
    """Version of the map, and the shard of each slot."""

    version: int
    shards: int
    of_slot: tuple[int, ...]


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 0: slots dealt out in turn."""
    return SlotMap(0, shards, tuple(s % shards for s in range(slots)))


def rebalance(current: SlotMap, sizes: list[int], shards: int | None = None) -> SlotMap:
    """The next version: slots move from the fullest shards until bytes are near equal.

    ``sizes`` has the bytes of each slot. Slots leave shards that hold more than
    their share, smallest first as long as they fit in the surplus, and all slots
    of shards that are no more. They join the emptiest shard, largest first.
    Ends with swaps between the fullest and the emptiest shard that narrow the gap.
    """
    shards = shards or current.shards
    of_slot, load = list(current.of_slot), [0] * shards
    share = sum(sizes) / shards
    loose = []
    members: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(of_slot):
        if shard < shards:
            members[shard].append(slot)
            load[shard] += sizes[slot]
        else:
            loose.append(slot)
    for shard in range(shards):
        for slot in sorted(members[shard], key=lambda s: (sizes[s], s)):
            if load[shard] - sizes[slot] < share:
                break
            if sizes[slot]:
                load[shard] -= sizes[slot]
                loose.append(slot)
    for slot in sorted(loose, key=lambda s: (-sizes[s], s)):
        shard = min(range(shards), key=lambda x: (load[x], x))
        of_slot[slot] = shard
        load[shard] += sizes[slot]
    _swap(of_slot, load, sizes)
    return SlotMap(current.version + 1, shards, tuple(of_slot))


def _swap(of_slot: list[int], load: list[int], sizes: list[int]) -> None:
    """Move or exchange slots between the fullest and the emptiest shard while that helps."""
    for _ in range(64):
        full, empty = load.index(max(load)), load.index(min(load))
        gap = load[full] - load[empty]
        here = [s for s, shard in enumerate(of_slot) if shard == full and sizes[s]]
        # Nothing in exchange, or a slot of the emptiest shard.
        there = sorted([(0, -1), *((sizes[s], s) for s, shard in enumerate(of_slot)
                                   if shard == empty)])
        best = None
        for slot in here:
            at = bisect_left(there, (sizes[slot] - gap / 2, -1))
            for weight, other in there[max(0, at - 1):at + 1]:
                moved = sizes[slot] - weight
                if 0 < moved < gap and (best is None or abs(2 * moved - gap) < best[0]):
                    best = (abs(2 * moved - gap), slot, other, moved)
        if best is None:
            return
        _, slot, other, moved = best
        of_slot[slot] = empty
        if other >= 0:
            of_slot[other] = full
        load[full] -= moved
        load[empty] += moved


def save_map(spark: SparkSession, slot_map: SlotMap, folder: str) -> None:
    """Add a version to the stored map; a stored version is never changed."""
    rows = [(slot_map.shards, slot, shard) for slot, shard in enumerate(slot_map.of_slot)]
    (spark.createDataFrame(rows, "shards int, slot int, shard int").coalesce(1)
     .write.mode("errorifexists").parquet(f"{folder}/version={slot_map.version}"))


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """A stored version of the map, the latest if none is named."""
    stored = spark.read.parquet(folder)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).orderBy("slot").collect()
    return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows))


def slot_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, cell``: one narrow row per document, written out.

    ``size`` is the UTF-8 bytes of the text plus 1, a null text having none. Equal
    texts hash to one slot, which keeps copies together, except where the copies
    of one text weigh over 1 / ``HEAVY`` of all bytes: those hash by their row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = durable(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text"), cell().alias("cell"),
        F.monotonically_increasing_id().alias("_row")))
    slot = F.pmod(F.col("_text"), F.lit(slots)).cast("int")
    sizes = rows.groupBy("_text").agg(F.sum("size").alias("_bytes"))
    # At most HEAVY texts can be that heavy, so the list is short.
    limit = sizes.agg(F.sum("_bytes")).first()[0] or 0
    heavy = [r[0] for r in sizes.where(F.col("_bytes") * HEAVY > limit).collect()]
    by_row = F.pmod(F.xxhash64("_text", "_row"), F.lit(slots)).cast("int")
    spread = F.when(F.col("_text").isin(heavy), by_row).otherwise(slot) if heavy else slot
    return rows.withColumn("virtual_slot", spread).drop("_text", "_row")


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes of each slot."""
    found = dict(rows.groupBy("virtual_slot").agg(F.sum("size")).collect())
    return [found.get(s, 0) for s in range(slots)]


def assign_shards(rows: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``rows`` with ``shard`` by the map, and ``slot``, the row's place in its shard from 0."""
    of_slot = F.array(*map(F.lit, slot_map.of_slot))
    placed = rows.withColumn("shard", F.get(of_slot, F.col("virtual_slot")))
    return number_rows(placed, ["shard"], ["doc_id", "text_crc32"], "slot").drop("cell")


def shard_documents(docs: DataFrame, shards: int, folder: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents in ``shards`` shards of near equal bytes.

    Stores version 0 of the map and the version edited by the bytes found, and
    places the documents by the latest. Null texts and ids are placed like
    others, repeated rows each for themselves; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "slot-map")
    rows = slot_rows(docs, id_col, text_col)
    save_map(spark, first_map(shards), folder)
    save_map(spark, rebalance(load_map(spark, folder), slot_sizes(rows)), folder)
    return assign_shards(rows, load_map(spark, folder))
