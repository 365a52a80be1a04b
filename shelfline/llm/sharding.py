"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import store, text_or_empty


def ring(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in clockwise order."""
    nodes = []
    for shard in range(shards):
        for copy in range(virtual_nodes):
            place = int.from_bytes(hashlib.md5(f"{shard}/{copy}".encode()).digest()[:8], "big")
            nodes.append((place % cells, place, shard))
    return [(cell, shard) for cell, _, shard in sorted(nodes)]


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Rows a shard may hold. Without slack the capacities differ by one at most and add up to the total."""
    if slack:
        return [-int(-(1 + slack) * total // shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Spread the rows of the cells clockwise: (cell, from rank, to rank, shard, first slot).

    A virtual node first takes the rows of its own arc up to the room of its shard; what is left over
    travels on clockwise to the next shard with room, those that overflowed first going first.
    The work is bounded by the cells and the virtual nodes, whatever the number of rows.
    """
    places = [cell for cell, _ in nodes]
    arcs: list[list[list[int]]] = [[] for _ in nodes]
    for cell in sorted(counts):
        if counts[cell]:
            arcs[bisect_left(places, cell) % len(nodes)].append([cell, 0, counts[cell]])
    room, held, out, over = list(room), [0] * len(room), [], []

    def take(queue: list[list[int]], shard: int) -> list[list[int]]:
        rest = []
        for cell, lo, hi in queue:
            n = min(room[shard], hi - lo)
            if n:
                out.append((cell, lo, lo + n, shard, held[shard]))
                room[shard] -= n
                held[shard] += n
            if lo + n < hi:
                rest.append([cell, lo + n, hi])
        return rest

    left = [take(arcs[i], shard) for i, (_, shard) in enumerate(nodes)]
    for i in range(2 * len(nodes)):  # two turns: what overflows at the end of the first is placed in the second
        at = i % len(nodes)
        over, left[at] = over + left[at], []
        if over and room[nodes[at][1]]:
            over = take(over, nodes[at][1])
    return out


def ring_shards(docs: DataFrame, shards: int = 40, virtual_nodes: int = 100, slack: float = 0.0, cells: int = 65536) -> DataFrame:
    """Shard and slot of each document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    doc_id is hashed to one of ``cells`` places on a ring and belongs to the next virtual node
    clockwise; rows that find a shard full go on clockwise. With ``slack`` 0 the capacities add up to
    the number of rows, so row counts differ by one at most (law ``rows``); grown_shard is null.

    Spark counts rows by cell; the ledger of cells (a fixed number) is walked once to give every cell
    its ranges of shards, and comes back as a broadcast table with at most a row for each cell, virtual
    node and shard. A row finds its range by its rank in the cell.

    size is the UTF-8 bytes plus 16. Null text counts as empty. Rows with equal doc_id, size and checksum are counted
    first and unfolded after they have a shard, so a repeated or null doc_id does not fill one task.
    An empty table gives no rows.
    """
    rows = store(
        docs.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("bytes"), F.crc32(text_or_empty()).alias("text_crc32"))
        .groupBy("doc_id", (F.col("bytes") + 16).alias("size"), "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("place", F.xxhash64("doc_id")).withColumn("cell", F.pmod("place", F.lit(cells)).cast("int")), "ring")
    counts = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.sum("copies").alias("n")).collect()}  # at most `cells` rows
    ranges = walk(counts, ring(shards, virtual_nodes, cells), capacities(sum(counts.values()), shards, slack))
    ledger = docs.sparkSession.createDataFrame(ranges, "at int, lo long, hi long, shard int, first_slot long")
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("end", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("copies"))
    placed = ranked.join(F.broadcast(ledger), (F.col("cell") == F.col("at")) & (F.col("lo") < F.col("end")) & (F.col("hi") > F.col("start")))
    law = "rows" if not slack else "bounded"
    return (
        placed.withColumn("rank", F.explode(F.sequence(F.greatest("start", "lo"), F.least("end", "hi") - 1)))
        .select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
                (F.col("first_slot") + F.col("rank") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
