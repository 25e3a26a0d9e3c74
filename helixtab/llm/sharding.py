"""Shards through fixed virtual slots.

Records are hashed into a fixed number of virtual slots that never changes.  Bytes are summed per
slot, and a map from slot to shard is kept as a table with versions: version 0 deals the slots out,
largest first, to the shard with the fewest bytes; later versions are edits of it.  Rebalancing moves
slots from shards above the mean to shards below; growing moves slots only into the new shard.  The map has as many rows as
there are slots (a parameter), which is all that the driver sees.

Defined results: a null text has no bytes, and a row's size is its UTF-8 bytes plus one; null ids are
spread by their texts; rows equal in id and text share a slot; an empty table gives an empty result
with the same map rule; other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, text_or_empty

SLOTS = 4096
MAP = "version int, vslot int, shard int"


def slot_records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_or_empty(text_col)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty(text_col)).alias("text_crc32"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(slots)).cast("int").alias("vslot"),
    )


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes per virtual slot: one number per slot."""
    out = [0] * slots
    for row in records.groupBy("vslot").agg(F.sum("size").alias("size")).collect():
        out[row.vslot] = row["size"]
    return out


def deal(sizes: list[int], shards: int) -> list[int]:
    """The first map: slots by falling bytes, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    owner = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        load, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (load + sizes[slot], shard))
    return owner


def _loads(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    out = [0] * shards
    for slot, shard in enumerate(owner):
        out[shard] += sizes[slot]
    return out


def rebalance(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """An edit of the map for new sizes: slots leave shards above the mean for the emptiest shard,
    each only if that lowers the larger of the two loads."""
    owner = list(owner)
    loads = _loads(owner, sizes, shards)
    mean = sum(loads) / shards
    for shard in sorted(range(shards), key=lambda s: -loads[s]):
        for slot in sorted((k for k in range(len(owner)) if owner[k] == shard), key=lambda k: (-sizes[k], k)):
            if loads[shard] <= mean:
                break
            to = min(range(shards), key=lambda s: (loads[s], s))
            if to != shard and loads[to] + sizes[slot] < loads[shard]:
                owner[slot] = to
                loads[shard] -= sizes[slot]
                loads[to] += sizes[slot]
    return owner


def grow(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """An edit of a map of ``shards`` shards for one more: the new shard takes slots from the fullest
    shards until it has its share; no slot moves between old shards."""
    owner = list(owner)
    loads = _loads(owner, sizes, shards)
    share = sum(loads) / (shards + 1)
    heap = [(-load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    own = {s: sorted((k for k in range(len(owner)) if owner[k] == s), key=lambda k: (sizes[k], k)) for s in range(shards)}
    taken = 0
    while heap:
        load, shard = heapq.heappop(heap)
        if not own[shard]:
            continue
        slot = own[shard].pop()
        if taken + sizes[slot] <= share:
            owner[slot] = shards
            taken += sizes[slot]
            load += sizes[slot]
        # a slot that is too large stays; smaller ones of the shard are tried next
        heapq.heappush(heap, (load, shard))
    return owner


def write_map(spark: SparkSession, path: str, version: int, owner: list[int]) -> None:
    rows = [(version, slot, shard) for slot, shard in enumerate(owner)]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The slot-to-shard map of a version, the latest if none is named."""
    maps = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("vslot", "shard")


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` with their shard and a gapless place in it.

    Places run over the virtual slots of a shard; rows are numbered within a virtual slot, so the
    numbering is spread over all slots.
    """
    counts = records.groupBy("vslot").agg(F.count(F.lit(1)).alias("n")).join(slot_map, "vslot")
    base = counts.select(
        "vslot", "shard", (F.sum("n").over(Window.partitionBy("shard").orderBy("vslot")) - F.col("n")).alias("base")
    )
    number = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("number", number - 1)
        .join(F.broadcast(base), "vslot")  # one row per virtual slot
        .select("*", (F.col("base") + F.col("number")).alias("slot"))
        .drop("base", "number")
    )


def shard_documents(
    docs: DataFrame, path: str, shards: int = 8, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deal ``docs`` into shards of nearly equal bytes, writing version 0 of the map to ``path``."""
    spark = docs.sparkSession
    records = stage(slot_records(docs, slots, id_col, text_col), "records")
    write_map(spark, path, 0, deal(slot_bytes(records, slots), shards))
    return assign(records, read_map(spark, path, 0))
