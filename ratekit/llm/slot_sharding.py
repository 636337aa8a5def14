r"""Sharding by fixed virtual slots, in DataFrame functions only.

Every record is hashed into one of ``SLOTS`` virtual slots; a slot never changes.
Bytes are aggregated per slot, and a slot-to-shard map, one row per slot,
puts slots into shards so that bytes are near equal: the heaviest slot
first, each into the shard that is lightest so far.  Maps are stored by
version.  Rebalancing edits the map and writes the next version: growing
moves slots into the new shards only, so nothing moves between old ones.

Records are numbered within their shard without a global sort: numbered
within their slot (thousands of windows, none larger than a slot), plus
the records of the shard's earlier slots, from the per-slot counts.

The map has ``SLOTS`` rows whatever the size of the table; it is the only thing
that the driver sees and that is broadcast.  The hash covers id and text, so
one id shared by many records does not fill one slot.

Defined results: a null text has no bytes (size 8, checksum 0); null ids and
repeated rows are records like any other, and repeated ones share a
slot; an empty table gives a map whose slots go round the shards.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

SLOTS = 4096
OVERHEAD = 8
_MAP = "array<struct<slot:int,shard:int,bytes:bigint,n:bigint,first:bigint>>"


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record, from the first 32 bits of an MD5 over id and text."""
    key = F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % slots).cast("int")


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, slot of every record."""
    own = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(own) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(own).alias("text_crc32"), slot_of(F.col(doc_id), F.col(text), slots).alias("slot"))


def slot_sizes(sized: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, records) of each of the ``slots`` slots."""
    out = [(0, 0)] * slots
    for r in sized.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect():
        out[r["slot"]] = (r["bytes"], r["n"])
    return out


def first_map(sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """The shard of each slot: heaviest slot first, into the lightest shard, then the lowest."""
    loads = [(0, 0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i][0], i)):
        load, n, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (load + sizes[slot][0], n + 1, shard))
    return out


def grown_map(shard_of: list[int], sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """``shard_of`` edited for more shards: slots leave the heaviest shards for the new ones only."""
    out, old = list(shard_of), max(shard_of) + 1
    loads = [0] * shards
    for slot, shard in enumerate(out):
        loads[shard] += sizes[slot][0]
    share = sum(loads) / shards
    own = {s: sorted((i for i, x in enumerate(out) if x == s), key=lambda i: (sizes[i][0], i)) for s in range(old)}
    for new in range(old, shards):
        while True:
            giver = max(range(old), key=lambda s: (loads[s], -s))
            fits = [i for i in own[giver] if loads[new] + sizes[i][0] <= share]
            if loads[giver] <= share or not fits:
                break
            slot = fits[-1]
            own[giver].remove(slot)
            out[slot] = new
            loads[giver] -= sizes[slot][0]
            loads[new] += sizes[slot][0]
    return out


def map_table(spark: SparkSession, shard_of: list[int], sizes: list[tuple[int, int]]) -> DataFrame:
    """slot, shard, bytes, n, first (records of the shard's earlier slots): one row per slot."""
    before: dict[int, int] = {}
    rows = []
    for slot, shard in enumerate(shard_of):
        rows.append({"slot": slot, "shard": shard, "bytes": sizes[slot][0], "n": sizes[slot][1],
                     "first": before.get(shard, 0)})
        before[shard] = before.get(shard, 0) + sizes[slot][1]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), _MAP)))


def write_map(table: DataFrame, path: str, version: int) -> DataFrame:
    """Store a map as ``version`` under ``path``, never over an older one; returns what was stored."""
    at = f"{path}/version={version}"
    table.coalesce(1).write.mode("error").parquet(at)
    return table.sparkSession.read.parquet(at)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The map of a version, or the latest one, with its version."""
    every = spark.read.parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def assign(sized: DataFrame, table: DataFrame) -> DataFrame:
    """Records with shard and position: places in their shard, gapless from 0."""
    own = Window.partitionBy("slot").orderBy("doc_id", "text_crc32", "size")
    numbered = sized.withColumn("at", F.row_number().over(own) - 1)
    return numbered.join(F.broadcast(table.select("slot", "shard", "first")), "slot").select(
        "doc_id", "size", "text_crc32", "slot", "shard", (F.col("first") + F.col("at")).cast("long").alias("position"))


def shard(docs: DataFrame, path: str, shards: int, doc_id: str = "doc_id", text: str = "text",
          slots: int = SLOTS) -> DataFrame:
    """Records with their shard by a first map, which is stored as version 1 under ``path``."""
    sized = materialize(records(docs, doc_id, text, slots), "records")
    sizes = slot_sizes(sized, slots)
    table = map_table(docs.sparkSession, first_map(sizes, shards), sizes)
    return assign(sized, write_map(table, path, 1))


def rebalance(sized: DataFrame, path: str, shards: int, slots: int = SLOTS) -> DataFrame:
    """Edit the latest map under ``path`` for more shards and the bytes of now; stores the next version."""
    spark = sized.sparkSession
    latest = read_map(spark, path)
    version = latest.agg(F.max("version")).first()[0]
    shard_of = [0] * slots
    for r in latest.select("slot", "shard").collect():
        shard_of[r["slot"]] = r["shard"]
    sizes = slot_sizes(sized, slots)
    table = map_table(spark, grown_map(shard_of, sizes, shards), sizes)
    return assign(sized, write_map(table, path, version + 1))
