"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many arcs of a hash ring.  A key belongs to the arc that its
hash falls into; where that arc's shard is full, the keys left over go on
clockwise to the next arc whose shard has room.  Capacities are the even share,
so the row counts differ by one at most.

All row-level work is DataFrame expressions.  The driver only handles the counts
of the ring's cells, whose number depends on shards and virtual nodes, and on
the row count by one cell per million rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize


@dataclass(frozen=True)
class RingParams:
    """virtual_nodes: so many that little overflows and has to move with the counts.  Up to run_rows copies of a row are dealt by one task."""

    shards: int = 24
    virtual_nodes: int = 256
    rows_per_cell: int = 1_000_000
    run_rows: int = 65_536


def ring(p: RingParams, bits: int) -> list[int]:
    """Owner of each of the 2**bits cells: the shard whose next virtual node lies clockwise."""
    cells = 1 << bits
    nodes = sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") * cells >> 64, s) for s in range(p.shards) for v in range(p.virtual_nodes))
    out, at = [], 0
    for cell in range(cells):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        out.append(nodes[at % len(nodes)][1])
    return out


def plan(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """(cell, first rank, shard, first slot): how each cell's rows, by rank, are dealt to shards with bounded loads.

    A cell's rows go to its owner while that has room; what is left goes on
    clockwise, before the rows of later cells' overflow, until no row is left.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out, used, left = [], [0] * shards, []

    def put(cell: int, rank: int, n: int, shard: int) -> int:
        k = min(n, room[shard] - used[shard])
        if k:
            out.append((cell, rank, shard, used[shard]))
            used[shard] += k
        return k

    for cell, n in enumerate(counts):  # owners first: keys that needn't move don't
        k = put(cell, 0, n, owners[cell])
        if k < n:
            left.append((cell, k, n - k))
    for cell, rank, n in left:
        at = cell
        while n:
            at = (at + 1) % len(owners)
            k = put(cell, rank, n, owners[at])
            rank, n = rank + k, n - k
    return sorted(out)


def assign(docs: DataFrame, p: RingParams = RingParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for each row of docs.

    size is the UTF-8 bytes of the text plus 8, a null text having none.  Rows
    with equal id, size and checksum are counted together before the shuffle and
    dealt as runs of ranks, so repeated rows spread over shards like others; rows
    without an id have a place by size and checksum.  Long texts are read where
    they are and never shuffled.  An empty table gives no rows; other columns
    aren't read.
    """
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("_id"), (F.length(data).cast("long") + 8).alias("size"), F.crc32(data).alias("text_crc32"))
    keys = materialize(rows.groupBy("_id", "size", "text_crc32").agg(F.count("*").alias("_n")), "shard-keys")
    total = keys.agg(F.sum("_n")).first()[0] or 0
    bits = max(14, (p.shards * p.virtual_nodes * 4).bit_length(), (total // p.rows_per_cell).bit_length())
    celled = keys.withColumn("_hash", F.when(F.col("_id").isNull(), F.xxhash64("size", "text_crc32")).otherwise(F.xxhash64(F.col("_id").cast("string")))).withColumn("_cell", F.shiftrightunsigned("_hash", 64 - bits).cast("int"))
    counts = [0] * (1 << bits)
    for r in celled.groupBy("_cell").agg(F.sum("_n").alias("n")).collect():  # 2**bits rows at most
        counts[r["_cell"]] = r["n"]
    spark = docs.sparkSession
    runs = plan(counts, ring(p, bits), p.shards)
    by_cell: dict[int, list[dict]] = {}
    for cell, rank, shard, slot in runs:
        by_cell.setdefault(cell, []).append({"rank": rank, "shard": shard, "slot": slot})
    text = json.dumps([{"_cell": c, "_runs": x} for c, x in by_cell.items()])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<_cell:int,_runs:array<struct<rank:long,shard:int,slot:long>>>>")))
    before = W.partitionBy("_cell").orderBy("_hash", "_id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, -1)
    ranked = celled.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = ranked.join(F.broadcast(table), "_cell")  # bounded by 2**bits cells and one run more per shard
    last = F.col("_first") + F.col("_n") - 1
    runs_of = lambda df: df.select("_id", "size", "text_crc32", "_runs", last.alias("_last"), F.explode(F.sequence(F.col("_first"), last, F.lit(p.run_rows).cast("long"))).alias("_a"))
    # A row with very many copies is dealt by several tasks.
    many = runs_of(ranked.where(F.col("_n") > p.run_rows)).repartition("_a")
    parts = runs_of(ranked.where(F.col("_n") <= p.run_rows)).unionByName(many)
    each = parts.select("_id", "size", "text_crc32", "_runs", F.explode(F.sequence(F.col("_a"), F.least(F.col("_last"), F.col("_a") + p.run_rows - 1))).alias("_rank"))
    run = F.element_at(F.filter("_runs", lambda x: x["rank"] <= F.col("_rank")), -1)
    return each.withColumn("_run", run).select(F.col("_id").alias(id_col), "size", "text_crc32", F.col("_run.shard").alias("shard"), (F.col("_run.slot") + F.col("_rank") - F.col("_run.rank")).alias("slot"))
