"""Resharding by minimum-cost flow.

Old shard sizes are supplies, new shard capacities are demands, and a byte
costs 0 where it is and 1 when it moves. The flow (a few dozen nodes, solved
on the driver from shard totals alone) says how many bytes each old shard
sends to each new one. Every old shard is cut, in a fixed order of its
documents, into consecutive blocks of those sizes; only shards whose contents
change are rewritten.

Edge cases: a NULL text has size ``ROW_BYTES`` and a NULL checksum; a NULL id
is ordered by the digest of the empty string; a NULL old shard counts as
outside all new ones (its rows always move); repeated rows are separate
documents. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcast.llm.common import materialize, shuffled_key, utf8_bytes
from lotcast.llm.prefix import hex_levels, running_sums

#: Bytes a document takes besides its text.
ROW_BYTES = 8


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest integral flow from ``supply`` to ``demand`` (equal sums):
    successive shortest paths with node potentials."""
    n, m = len(supply), len(demand)
    source, sink = n + m, n + m + 1
    edges: list[list] = []  # [to, room, cost]; the reverse edge is at index ^ 1
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a, b, room, price):
        out[a].append(len(edges))
        edges.append([b, room, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    for j, d in enumerate(demand):
        edge(n + j, sink, d, 0)
    first = len(edges)
    for i in range(n):
        for j in range(m):
            edge(i, n + j, min(supply[i], demand[j]), cost[i][j])
    potential = [0] * len(out)
    while True:
        dist: list[float] = [float("inf")] * len(out)
        via = [-1] * len(out)
        dist[source] = 0
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for k in out[a]:
                b, room, price = edges[k]
                if room and (e := d + price + potential[a] - potential[b]) < dist[b]:
                    dist[b], via[b] = e, k
                    heapq.heappush(queue, (e, b))
        if via[sink] < 0:
            break
        potential = [p + (d if d < float("inf") else 0) for p, d in zip(potential, dist)]
        path, b = [], sink
        while b != source:
            path.append(via[b])
            b = edges[via[b] ^ 1][0]
        room = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= room
            edges[k ^ 1][1] += room
    return [[edges[first + 2 * (i * m + j) + 1][1] for j in range(m)] for i in range(n)]


def plan_moves(old: dict[int, int], n_new: int, capacity: list[int]) -> dict[int, list[tuple[int, int]]]:
    """For each old shard, ``(new shard, bytes)`` in block order: what stays
    comes first. ``capacity`` must sum to the old bytes."""
    shards = sorted(old)
    flow = min_cost_flow([old[s] for s in shards], capacity,
                         [[0 if s == j else 1 for j in range(n_new)] for s in shards])
    return {s: sorted(((j, b) for j, b in enumerate(row) if b), key=lambda x: (x[0] != s, x[0]))
            for s, row in zip(shards, flow)}


def equal_capacities(total: int, n: int, taken: list[int] | None = None) -> list[int]:
    """``n`` near-equal capacities for ``total`` bytes on top of what the
    shards already hold (the emptiest are filled first)."""
    have = list(taken or [0] * n)
    room, goal = total, sum(have) + total
    left = sorted(range(n), key=lambda j: -have[j])
    out = [0] * n
    while left:
        j = left.pop(0)
        out[j] = min(room, max(0, -(-(goal) // (len(left) + 1)) - have[j]))
        goal -= have[j] + out[j]
        room -= out[j]
    return out


def _cut(df: DataFrame, moves: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """Send each row to the block that its middle byte falls in."""
    to = F.lit(None).cast("int")
    for shard, blocks in moves.items():
        middle, end, inside = F.col("before") + F.col("size") / 2, 0, None
        for new, amount in blocks:
            end += amount
            hit = F.lit(new)
            inside = F.when(middle <= end, hit) if inside is None else inside.when(middle <= end, hit)
        if inside is not None:
            to = F.when(F.col("old_shard") == shard, inside.otherwise(F.lit(blocks[-1][0]))).otherwise(to)
    return df.withColumn("shard", to)


def reshard(docs: DataFrame, old_shard: Column, n_new: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``,
    ``old_shard``, ``shard`` (0 .. n_new - 1, byte sizes near equal), ``slot``
    (gapless from 0 in each shard).

    Documents above half the mean size are placed first; the flow is then
    solved again for the small ones against what room is left, which evens
    out the large ones' rounding.
    """
    slim = materialize(docs.select(
        F.col(id_col).alias("doc_id"), (utf8_bytes(F.col(text_col)) + ROW_BYTES).alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(-1)).alias("old_shard"),
        shuffled_key(F.col(id_col)).alias("place")), "reshard-sizes")
    order = [F.col("place"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    mean = slim.agg(F.avg("size")).first()[0] or 0
    tiered = slim.withColumn("tier", F.when(F.col("size") > mean / 2, F.lit(0)).otherwise(F.lit(1)))
    queued = materialize(running_sums(tiered, ["old_shard", "tier"], hex_levels("place"), order,
                                      {"before": F.col("size")}), "reshard-queues")
    held, parts = [0] * n_new, []
    for tier in (0, 1):
        rows = queued.filter(F.col("tier") == tier)
        old = {r["old_shard"]: r["b"] for r in rows.groupBy("old_shard").agg(F.sum("size").alias("b")).collect()}
        moves = plan_moves(old, n_new, equal_capacities(sum(old.values()), n_new, held)) if old else {}
        part = _cut(rows, moves)
        if tier == 0:
            for r in part.groupBy("shard").agg(F.sum("size").alias("b")).collect():
                held[r["shard"]] += r["b"]
        parts.append(part)
    placed = parts[0].unionByName(parts[1])
    slots = running_sums(placed, ["shard"], hex_levels("place"), order, {"slot": F.lit(1)})
    return slots.select("doc_id", "size", "text_crc32",
                        F.when(F.col("old_shard") >= 0, F.col("old_shard")).alias("old_shard"), "shard", "slot")


def rewrite_affected(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> list[int]:
    """Write ``shard=N`` folders under ``path`` for the shards that gain or
    lose a document; returns their numbers. Untouched shards keep their
    files. Rows are matched by id, size and checksum, and equal rows that
    went to different shards are matched up one to one. ``path`` may be the
    old layout, also when ``docs`` is read from it: folders that the new one
    leaves without documents are deleted once the others are committed. An own
    column ``shard`` is replaced."""
    moved = placed.filter(~F.col("old_shard").eqNullSafe(F.col("shard")))
    affected = sorted(r[0] for r in moved.select(F.explode(F.array("old_shard", "shard")).alias("s"))
                      .filter("s is not null").distinct().collect())
    unknown = bool(moved.filter("old_shard is null").take(1))
    used = {r[0] for r in placed.select("shard").distinct().collect()}
    if not affected:
        return []
    own = [c for c in docs.columns if c.lower() != "shard"]
    # Copies of a row get numbers in both tables. The key holds the id and
    # the checksum, so a group is the copies of one row under one id.
    key = ["_id", "_size", "_crc"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("_shard"))
    target = (placed.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"),
                            F.col("text_crc32").alias("_crc"), F.col("shard").alias("_shard"))
              .withColumn("_nth", nth).alias("p"))
    rows = (docs.withColumns({"_id": F.col(id_col), "_size": utf8_bytes(F.col(text_col)) + ROW_BYTES,
                              "_crc": F.crc32(F.col(text_col).cast("binary"))})
            .withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(
                *[F.col(f"`{c}`") for c in own])))).alias("d"))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in key + ["_nth"]]
    out = rows.join(target.filter(F.col("_shard").isin(affected)), on).select(
        *[F.col(f"d.`{c}`") for c in own], F.col("p._shard").alias("shard"))
    (out.write.partitionBy("shard").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    _delete_shards(docs, path, set(affected) - used, unknown)
    return affected


def _delete_shards(docs: DataFrame, path: str, shards: set[int], unknown: bool) -> None:
    """Delete the ``shard=N`` folders of ``shards``; with ``unknown`` also
    those of no shard number (rows without an old shard always move)."""
    spark = docs.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and name == "shard" and (int(value) in shards if value.isdecimal() else unknown):
            files.delete(status.getPath(), True)
