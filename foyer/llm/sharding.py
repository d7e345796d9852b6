"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns many points of a ring of 65,536 equal cells. A row belongs to the cell of its
key's hash and goes to the owner of the next point clockwise. Shard capacities add up to exactly
the number of rows (each is the floor or the ceiling of the mean), and rows that find a full shard
continue clockwise to the next point of a shard with room. So counts differ by at most one, and a
change of the shard count moves the rows of the arcs that change hands and the overflow only.

Only one count per cell reaches the driver, whatever the number of rows. There the ring is walked
once with counts in place of rows, and the outcome - per cell, a few runs of ranks and the shard
that takes each - goes back as a join side of at most (cells + points + shards) rows. A row needs
only its rank within its cell, so the one shuffle is by cell: tens of thousands of even groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foyer.llm.common import fresh, named, whole_text

CELL_BITS = 16
VIRTUAL_NODES = 128


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, seed: int = 0) -> list[tuple[int, int]]:
    """The points of a ring, clockwise, as (cell, shard).

    A shard's points do not depend on how many shards there are.
    """
    points = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.md5(f"{seed}:{shard}:{node}".encode()).digest()
            points.setdefault(int.from_bytes(digest[:4], "big") >> (32 - CELL_BITS), shard)
    return sorted(points.items())


def capacities(rows: int, shards: int) -> list[int]:
    """Rows each shard takes: they add up to all rows and differ by at most one."""
    least, more = divmod(rows, shards)
    return [least + (shard < more) for shard in range(shards)]


def place(
    counts: dict[int, int], points: list[tuple[int, int]], room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Walk the ring with counts: runs of ranks as (cell, first rank, end, shard, first slot).

    In each round every shard takes what waits at its points, in ring order, as long as there is
    room; what is left moves on to the next point of a shard that still has room.
    """
    room, used = list(room), [0] * len(room)
    waiting: list[list[list[int]]] = [[] for _ in points]
    at = 0
    for cell in sorted(counts):
        while at < len(points) and points[at][0] < cell:
            at += 1
        waiting[at % len(points)].append([cell, 0, counts[cell]])
    runs = []
    while any(waiting):
        for point, (_, shard) in enumerate(points):
            left = []
            for cell, start, end in waiting[point]:
                taken = min(room[shard], end - start)
                if taken:
                    runs.append((cell, start, start + taken, shard, used[shard]))
                    room[shard] -= taken
                    used[shard] += taken
                if start + taken < end:
                    left.append([cell, start + taken, end])
            waiting[point] = left
        # The next point with room, clockwise, seen from each point.
        ahead, following = None, [0] * len(points)
        for step in range(2 * len(points) - 1, -1, -1):
            point = step % len(points)
            following[point] = ahead
            if room[points[point][1]]:
                ahead = point
        moved: list[list[list[int]]] = [[] for _ in points]
        for point, queue in enumerate(waiting):
            if queue:
                moved[following[point]].extend(queue)
        waiting = moved
    return runs


def shard_by_ring(
    docs: DataFrame,
    shards: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    tie: Iterable[Column] = (),
    virtual_nodes: int = VIRTUAL_NODES,
    seed: int = 0,
    shard_column: str = "shard",
    slot_column: str = "slot",
) -> DataFrame:
    """The rows with their shard and a place in it, counted from 0 without gaps.

    Rows of one cell rank by the hash of their key, the key, then ``tie``. A null key is replaced
    by the text's hash, so that many null keys do not share a cell; equal keys share a cell and are
    told apart by ``tie``; rows that are equal in everything are interchangeable. An empty table
    gives an empty result. Columns named as the two new ones are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    docs = docs.drop(shard_column, slot_column)
    cell, hashed, rank, first, end, start = (
        fresh(f"ring_{name}", docs) for name in ("cell", "hash", "rank", "first", "end", "start")
    )
    position = F.when(named(key).isNull(), F.xxhash64(F.lit("null"), whole_text(text))).otherwise(
        F.xxhash64(named(key).cast("string"))
    )
    placed = docs.withColumn(hashed, position).withColumn(
        cell, F.shiftrightunsigned(named(hashed), 64 - CELL_BITS).cast("int")
    )
    counts = {row[0]: row[1] for row in placed.groupBy(named(cell)).count().collect()}
    runs = place(counts, ring(shards, virtual_nodes, seed), capacities(sum(counts.values()), shards))
    plan = docs.sparkSession.createDataFrame(
        runs, f"`{cell}` int, `{first}` long, `{end}` long, `{shard_column}` int, `{start}` long"
    )
    within = Window.partitionBy(named(cell)).orderBy(named(hashed), named(key), *tie)
    ranked = placed.withColumn(rank, F.row_number().over(within).cast("long") - 1)
    # At most cells + points + shards rows, whatever the input.
    joined = ranked.join(F.broadcast(plan), cell).where(
        (named(rank) >= named(first)) & (named(rank) < named(end))
    )
    return joined.withColumn(slot_column, named(start) + named(rank) - named(first)).drop(
        cell, hashed, rank, first, end, start
    )
