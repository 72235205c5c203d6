"""Approximate nearest neighbours by largest inner product.

A forest of random-projection trees is fitted on a bounded sample; every
vector is put into one leaf of each tree. A query walks all trees at once
through one priority queue ordered by the smallest margin on the way, and
visits the most promising leaves, the same share of all leaves at any size (or
``visits`` of them). Leaf candidates are reranked by the exact inner product of
the original vectors in double precision.

Inner product is not a metric, so trees see each vector with one more
coordinate, sqrt(max_norm^2 - norm^2), and each query with a 0 there: the
largest inner product is then the smallest angle.

Equal vectors are searched once: a distinct vector carries its ``k + 1``
smallest ids (all that ties to smaller ids can ever return), so a vector that
a third of the rows share is one candidate and one query. Leaves beyond
``BLOCK_ROWS`` rows are split into blocks by hash, and so are the queries that
visit a leaf, by how many there are; a task meets one block of each.

Edge cases: vectors that are NULL, empty, zero or hold a NULL or non-finite
component, ids that are NULL, and vectors of another length than the most
common one take no part. A repeated row counts once. With no more than ``k``
other vectors, all are returned. Fewer than two usable rows give an empty
result.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcast.llm.common import materialize

#: Vectors the trees are fitted on, at most (a fixed bound for the driver).
SAMPLE_ROWS = 16384
TREES = 8
#: Leaves that a query visits of a forest of ``VISITS_OF`` leaves; a larger
#: forest keeps the share, a smaller one the number.
VISITS, VISITS_OF = 44, 256
#: Bytes of planes sent to the tasks, at most; deeper trees are not built.
PLANE_BYTES = 64 << 20
BLOCK_ROWS = 8192
#: Queries of one leaf that one task meets.
PROBE_ROWS = 8192


@dataclass(frozen=True)
class Forest:
    """``planes[t, node]`` and ``cuts[t, node]``: nodes of a complete binary
    tree, children of i at 2i+1 (below the cut) and 2i+2 (above)."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int
    norm2: float

    def augmented(self, x: np.ndarray, query: bool) -> np.ndarray:
        x = x.astype(np.float64)
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm2 - (x * x).sum(1)))
        return np.hstack([x, more[:, None]])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        x = self.augmented(x, query=False)
        node = np.zeros((len(x), len(self.planes)), np.int64)
        for t in range(len(self.planes)):
            for _ in range(self.depth):
                at = node[:, t]
                above = np.einsum("nd,nd->n", x, self.planes[t][at]) > self.cuts[t][at]
                node[:, t] = 2 * at + 1 + above
        return node - ((1 << self.depth) - 1)

    def search(self, q: np.ndarray, visits: int) -> list[list[tuple[int, int]]]:
        """For each query the (tree, leaf) pairs it visits, best first."""
        q = self.augmented(q, query=True)
        margins = np.einsum("nd,tpd->ntp", q, self.planes) - self.cuts if self.depth else np.zeros((len(q), 0, 0))
        first_leaf = (1 << self.depth) - 1
        out = []
        for m in margins:
            heap = [(-math.inf, t, 0) for t in range(len(self.planes))]
            found: list[tuple[int, int]] = []
            while heap and len(found) < visits:
                worst, t, node = heapq.heappop(heap)  # the least priority is the widest margin
                if node >= first_leaf:
                    found.append((t, node - first_leaf))
                    continue
                margin = m[t][node]
                heapq.heappush(heap, (max(worst, margin), t, 2 * node + 1))
                heapq.heappush(heap, (max(worst, -margin), t, 2 * node + 2))
            out.append(found)
        return out


def fit_forest(sample: np.ndarray, norm2: float, depth: int, trees: int, seed: int = 7) -> Forest:
    """Random Gaussian directions, cut at the sample's median in each node."""
    rng = np.random.default_rng(seed)
    dim, inner = sample.shape[1] + 1, (1 << depth) - 1
    forest = Forest(rng.standard_normal((trees, inner, dim)), np.zeros((trees, inner)), depth, norm2)
    x = forest.augmented(sample, query=False)
    for t in range(trees):
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            for i in range((1 << level) - 1, (1 << (level + 1)) - 1):
                here = np.flatnonzero(node == i)
                if len(here):
                    projected = x[here] @ forest.planes[t][i]
                    forest.cuts[t][i] = np.median(projected)
                    node[here] = 2 * i + 1 + (projected > forest.cuts[t][i])
    return forest


def tree_depth(rows: int, dim: int, trees: int) -> int:
    """Leaves of about 4096 rows, and never fewer than 32 leaves where
    that leaves 64 rows in each."""
    depth = max(min(5, int(math.log2(max(1, rows / 64)))), math.ceil(math.log2(max(1, rows / 4096))))
    most = int(math.log2(max(2, PLANE_BYTES // (8 * trees * (dim + 1)))))
    return min(depth, most, int(math.log2(SAMPLE_ROWS)))


def visited(depth: int, trees: int) -> int:
    """Leaves a query visits. A share of the rows, not a number of leaves,
    holds the recall where near vectors share no region."""
    return max(VISITS, math.ceil(VISITS * (trees << depth) / VISITS_OF))


def usable(vec: Column) -> Column:
    """No NULL or non-finite component and not all zero."""
    fine = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one query with rows of ``x``, added up in component
    order in double precision (the same for any block or batch)."""
    out = np.zeros(len(x))
    for d in range(len(q)):
        out += q[d] * x[:, d]
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding", trees: int = TREES, visits: int | None = None) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for every row
    where ``is_query`` holds: its ``k`` nearest found among all other rows,
    ties to the smaller id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")) \
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    lengths = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = lengths["d"] if lengths else 0
    rows = rows.filter(F.size("vec") == dim).withColumn("uid", F.md5(F.col("vec").cast("string").cast("binary")))
    smallest = Window.partitionBy("uid").orderBy("vec_id")
    kept = (rows.select("uid", "vec_id", "vec").dropDuplicates(["uid", "vec_id"])
            .withColumn("nr", F.row_number().over(smallest)).filter(F.col("nr") <= k + 1))
    asked = rows.filter("is_query").select("uid", "vec_id").distinct()
    distinct = (kept.groupBy("uid").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec"))
                .join(asked.select("uid").distinct().withColumn("asked", F.lit(True)), "uid", "left"))
    distinct = materialize(distinct.select("uid", "ids", F.col("ids")[0].alias("min_id"), "vec",
                                           F.coalesce("asked", F.lit(False)).alias("asked")), "ann-vectors")
    asked = materialize(asked, "ann-queries")
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("m")).first()
    n = max(1, total["n"])
    share = F.abs(F.xxhash64("uid") % (1 << 20)) <= min(1.0, 2 * SAMPLE_ROWS / n) * (1 << 20)
    sample = _matrix(distinct.filter(share).select("uid", "vec").orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE_ROWS)
                     .toArrow()["vec"])
    depth = tree_depth(n, dim, trees)
    forest = fit_forest(sample, total["m"] or 0.0, depth if len(sample) else 0, trees)
    visits = visited(forest.depth, trees) if visits is None else visits
    blocks = max(1, math.ceil(n / (1 << depth) / BLOCK_ROWS))
    sc = distinct.sparkSession.sparkContext
    shared = sc.broadcast(forest)
    vec_type = dict(distinct.dtypes)["vec"]
    leaves_a_tree = 1 << forest.depth

    def ask(batches):
        for batch in batches:
            for few in (batch.slice(s, 1024) for s in range(0, batch.num_rows, 1024)):
                found = shared.value.search(_matrix(few.column("vec")), visits)
                places = [[t * leaves_a_tree + leaf for t, leaf in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [few.column("uid"), few.column("vec"), pa.array(places, pa.list_(pa.int32()))], ["query", "vec", "places"])

    asking = materialize(distinct.filter("asked").select("uid", "vec").mapInArrow(
        ask, f"query string, vec {vec_type}, places array<int>"), "ann-probes")
    # One row a leaf at most: how many blocks its queries make.
    parts = {r["place"]: math.ceil(r["count"] / PROBE_ROWS)
             for r in asking.select(F.explode("places").alias("place")).groupBy("place").count().collect()}

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = shared.value.leaves(_matrix(batch.column("vec")))
            block = np.array([int(u[:8], 16) % blocks for u in batch.column("uid").to_pylist()], np.int32)
            for t in range(leaves.shape[1]):
                at = (t * leaves_a_tree + leaves[:, t]).astype(np.int32)
                many = np.array([parts.get(p, 0) for p in at.tolist()])
                for part in range(many.max()):
                    some = np.flatnonzero(many > part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at[some]), pa.array(block[some]), pa.array(np.full(len(some), part, np.int32)),
                         *[batch.column(c).take(pa.array(some)) for c in ("min_id", "uid", "vec")]],
                        ["place", "block", "part", "min_id", "uid", "vec"])

    stored = distinct.select("min_id", "uid", "vec").mapInArrow(
        place, f"place int, block int, part int, min_id long, uid string, vec {vec_type}")
    split = F.broadcast(distinct.sparkSession.createDataFrame(sorted(parts.items()), "place int, parts int"))
    probes = (asking.select("query", "vec", F.explode("places").alias("place")).join(split, "place")
              .withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("parts"))

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "uid", "min_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.float64())], names)
        x, q = _matrix(left["vec"]).astype(np.float64), _matrix(right["vec"]).astype(np.float64)
        min_id = left["min_id"].to_numpy()
        at, chosen, scores = [], [], []
        for s in range(0, len(q), 256):
            rough = q[s: s + 256] @ x.T
            cut = min(k + 1, len(x))
            least = np.partition(rough, len(x) - cut, axis=1)[:, len(x) - cut]
            for i in range(len(rough)):
                near = np.flatnonzero(rough[i] >= least[i] - 1e-9 * max(1.0, abs(least[i])))
                exact = exact_products(q[s + i], x[near])
                best = np.lexsort((min_id[near], -exact))[: k + 1]
                at += [s + i] * len(best)
                chosen.append(near[best])
                scores.append(exact[best])
        chosen = np.concatenate(chosen)
        return pa.table([right["query"].take(pa.array(at, pa.int64())), left["uid"].take(pa.array(chosen)),
                         pa.array(min_id[chosen]), pa.array(np.concatenate(scores))], names)

    keys = ["place", "block", "part"]
    found = (stored.groupBy(*keys).cogroup(probes.groupBy(*keys))
             .applyInArrow(rerank, "query string, uid string, min_id long, score double"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "min_id", "uid")
    found = (found.groupBy("query", "uid").agg(F.max("score").alias("score"), F.first("min_id").alias("min_id"))
             .withColumn("nr", F.row_number().over(best)).filter(F.col("nr") <= k + 1)
             .join(distinct.select("uid", "ids"), "uid")
             .select("query", "score", F.explode("ids").alias("vec_id")))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("nr", F.row_number().over(by_id)).filter(F.col("nr") <= k + 1)
    ranked = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (asked.select(F.col("vec_id").alias("query_id"), F.col("uid").alias("query")).join(found, "query")
            .filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
