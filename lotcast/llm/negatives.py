"""Hard negatives from vectors by anchor-clustered shared lists.

Anchors are clustered by angle. For each cluster the candidates are sorted
once by the most that any member can score with them, relative to the member's
length: ``|x| * cos(max(0, angle(x, centre) - spread))``, where ``spread`` is
the widest angle of a member from the centre. Every member walks that list
from its head until the bound of what is left is below the worst result that it
still needs: all later candidates are then certified not to matter.

On Spark, a cluster's list is cut into blocks by a hash of the candidate and
each block is sorted and walked in one task; the blocks' results meet in a
top-k. Before anything moves, every anchor is compared with one bounded
sample of candidates. What it finds there is a proven lower limit, so a
candidate below the limits of all members isn't sent to the cluster at all.
The walk is done twice: for the positives (highest score, same label), then
for the negatives (other labels, in the window that a positive's score opens).
Results are exact. How many candidates are spared depends on the vectors:
where all angles are near 90 degrees, as in random vectors, nearly none.

Scores are integers: each component becomes ``floor(scale * x)``.

Edge cases: rows with a NULL id, label or vector, with a NULL or non-finite
component or a component of ``2**26`` or more after scaling, and vectors of
another length than the most common one take no part. A repeated row counts
once; rows of one id with different vectors or labels are rows each, and no
row with the anchor's own id is its candidate. A vector of zeros scores 0 with
everything. Equal scores go by the smaller id. Anchors without positives, or
positives without negatives in the window, give no rows. Empty tables give an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcast.llm.best import Best
from lotcast.llm.common import materialize

#: Candidates every anchor is compared with first, and anchors the centres
#: are fitted on, at most.
SAMPLE_ROWS = 8192
CLUSTERS = 8
#: Members of one cluster walked in one task, and candidates in one block.
CHUNK_ROWS = 16384
BLOCK_ROWS = 65536
#: Candidates a walk takes at a time, and members beside them.
STEP, MEMBERS = 1024, 1024
_LARGEST = 1 << 26
#: Angles are computed in doubles; bounds are widened by this share.
_SLACK = 1e-6
_LOWEST = np.iinfo(np.int64).min
_MEMBER = "uid string, id long, label long, vec array<int>, cluster int, angle double, norm double"
_POSITIVES = "positives array<struct<slot:int,id:long,score:long>>"


@dataclass(frozen=True)
class Lists:
    """Unit centres of the clusters, and for every chunk of members its
    cluster, the widest angle from the centre and the least bound that any
    member still needs."""

    centres: np.ndarray
    cluster: np.ndarray
    part: np.ndarray
    spread: np.ndarray
    need: np.ndarray


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1, 1))


def fit_centres(sample: np.ndarray, clusters: int, rounds: int = 8, seed: int = 13) -> np.ndarray:
    """Spherical k-means; a centre that loses its members stays where it is."""
    unit, _ = _units(sample)
    centres = unit[np.random.default_rng(seed).choice(len(unit), clusters, replace=False)]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(1)
        for c in range(clusters):
            total = unit[nearest == c].sum(0)
            if (length := np.sqrt((total ** 2).sum())) > 0:
                centres[c] = total / length
    return centres


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by doubles where no sum can pass 2**53."""
    most = np.sqrt((a.astype(float) ** 2).sum(1)).max(initial=0) * np.sqrt((x.astype(float) ** 2).sum(1)).max(initial=0)
    if most < 1 << 52:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


def window(positive: np.ndarray, percent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score of a negative: low * p <= 100 * s <= high * p."""
    return -(-percent[0] * positive // 100), percent[1] * positive // 100


def bounds(norm: np.ndarray, angle: np.ndarray, spread: float) -> np.ndarray:
    """The most that a member of length 1 scores, widened by ``_SLACK``."""
    return norm * (np.cos(np.maximum(0, angle - spread)) + _SLACK)


def walk(x: np.ndarray, bound: np.ndarray, anchors: np.ndarray, reach: np.ndarray, need, take) -> None:
    """Walk one list, highest bound first, with all its members. ``need()``
    is the score each member still needs, and ``take(who, at, scores)``
    receives the members' scores with a stretch of the list. A member ends
    when ``reach`` (its length) times the next bound is below its need."""
    left = np.arange(len(anchors))
    for start in range(0, len(x), STEP):
        left = left[reach[left] * bound[start] >= need()[left]]
        if not len(left):
            return
        at = np.arange(start, min(start + STEP, len(x)))
        for some in (left[s: s + MEMBERS] for s in range(0, len(left), MEMBERS)):
            take(some, at, products(anchors[some], x[at]))


def _kth(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The k-th best allowed score of each row, ``_LOWEST`` without one."""
    if scores.shape[1] < k:
        return np.full(len(scores), _LOWEST)
    held = np.where(allowed, scores, _LOWEST)
    return np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]


def _usable(vec: Column) -> Column:
    return F.coalesce(F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def _rows(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str, vec_col: str, scale: int) -> tuple[DataFrame, int]:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col(vec_col).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")) \
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vec")) & (F.size("vec") > 0))
    lengths = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = lengths["d"] if lengths else 1
    most = min(_LARGEST, int(2.0 ** 31 / math.sqrt(dim)))
    scaled = rows.filter(F.size("vec") == dim) \
        .withColumn("vec", F.transform("vec", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))) \
        .filter(F.forall("vec", lambda x: F.abs(x) < most)).withColumn("vec", F.col("vec").cast("array<int>")).distinct()
    uid = F.md5(F.concat_ws(",", "id", "label", F.col("vec").cast("string")).cast("binary"))
    return materialize(scaled.select(uid.alias("uid"), "id", "label", "vec", "is_anchor"), "negatives-rows"), dim


def _sample(rows: DataFrame, dim: int) -> pa.Table:
    """At most ``SAMPLE_ROWS`` rows and 32 MB, the same on every run."""
    most = max(1, min(SAMPLE_ROWS, (8 << 20) // dim))
    return rows.select("uid", "id", "label", "vec").orderBy(F.xxhash64("uid"), "uid").limit(most).toArrow()


def _stretches(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    return (batch.slice(s, rows) for s in range(0, batch.num_rows, rows))


def _with_column(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    for name, values in columns.items():
        batch = batch.append_column(name, values)
    return batch


def _first_limits(anchors: DataFrame, sample: pa.Table, centres: np.ndarray, k: int) -> DataFrame:
    """``anchors`` with their cluster, angle, length, and the k-th best score
    among the sampled rows of the same label."""
    shared = anchors.sparkSession.sparkContext.broadcast((matrix(sample["vec"]), sample["id"].to_numpy(), sample["label"].to_numpy(), centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, ids, labels, middle = shared.value
        for batch in batches:
            for few in _stretches(batch, 512):
                a = matrix(few["vec"])
                unit, norm = _units(a)
                angle = angles(unit, middle)
                own, label = few["id"].to_numpy(), few["label"].to_numpy()
                allowed = (labels == label[:, None]) & (ids != own[:, None])
                yield _with_column(few, cluster=pa.array(angle.argmin(1).astype(np.int32)), angle=pa.array(angle.min(1)),
                                   norm=pa.array(norm), least=pa.array(_kth(products(a, x), allowed, k)))

    return anchors.mapInArrow(run, f"{_MEMBER}, least long")


def _window_limits(anchors: DataFrame, sample: pa.Table, k: int, percent: tuple[int, int]) -> DataFrame:
    """``anchors`` (with their ``positives``) with the least score of any use
    in each positive's window."""
    shared = anchors.sparkSession.sparkContext.broadcast((matrix(sample["vec"]), sample["label"].to_numpy(), sample["id"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, labels, ids = shared.value
        for batch in batches:
            for few in _stretches(batch, 256):
                scores = products(matrix(few["vec"]), x)
                fits = (labels != few["label"].to_numpy()[:, None]) & (ids != few["id"].to_numpy()[:, None])
                owner, _, positive, _ = _pairs(few)
                low, high = window(positive, percent)
                least = low.copy()
                for pair, who in enumerate(owner):
                    inside = fits[who] & (scores[who] >= low[pair]) & (scores[who] <= high[pair])
                    least[pair] = max(low[pair], _kth(scores[who][None], inside[None], k)[0])
                ends = np.searchsorted(owner, np.arange(few.num_rows + 1))
                yield _with_column(few, leasts=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(least)),
                                   least=pa.array(np.minimum.reduceat(least, ends[:-1])))

    return anchors.mapInArrow(run, f"{_MEMBER}, {_POSITIVES}, leasts array<long>, least long")


def _pairs(table: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner (row), slot, score and id of every positive of the rows."""
    column = table["positives"]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten()
    owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    return owner, flat.field("slot").to_numpy(), flat.field("score").to_numpy(), flat.field("id").to_numpy()


def _lists(members: DataFrame, centres: np.ndarray) -> tuple[DataFrame, Lists]:
    """Members with their chunk, and what a candidate must know of every
    chunk (one row a chunk)."""
    sizes = {r["cluster"]: r["count"] for r in members.groupBy("cluster").count().collect()}
    parts = [max(1, math.ceil(sizes.get(c, 0) / CHUNK_ROWS)) for c in range(len(centres))]
    number = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("cluster") + 1)
    members = members.withColumn("part", F.pmod(F.xxhash64("uid"), number).cast("int"))
    need = F.when((F.col("norm") > 0) & (F.col("least") > _LOWEST), F.col("least") / F.col("norm")).otherwise(float("-inf"))
    chunks = members.groupBy("cluster", "part").agg(F.max("angle").alias("spread"), F.min(need).alias("need")).toArrow()
    return members, Lists(centres, *[chunks[c].to_numpy() for c in ("cluster", "part", "spread", "need")])


def _candidates(rows: DataFrame, lists: Lists, blocks: int) -> DataFrame:
    """Every row once for each chunk whose members may still need it."""
    shared = rows.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for few in _stretches(batch, 8192):
                unit, norm = _units(matrix(few["vec"]))
                angle = angles(unit, held.centres)
                block = np.array([int(u[:8], 16) % blocks for u in few["uid"].to_pylist()], np.int32)
                for c, part, spread, need in zip(held.cluster, held.part, held.spread, held.need):
                    bound = bounds(norm, angle[:, c], spread)
                    some = np.flatnonzero(bound >= need)
                    if len(some):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), c, np.int32)), pa.array(np.full(len(some), part, np.int32)),
                             pa.array(block[some]), pa.array(bound[some]),
                             *[few[n].take(pa.array(some)) for n in ("id", "label", "vec")]],
                            ["cluster", "part", "block", "bound", "id", "label", "vec"])

    return rows.select("uid", "id", "label", "vec").mapInArrow(
        run, "cluster int, part int, block int, bound double, id long, label long, vec array<int>")


def _walked(members: DataFrame, candidates: DataFrame, blocks: int, walker, result: str) -> DataFrame:
    asked = members.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["cluster", "part", "block"]
    empty = pa.schema([(n.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[n.split()[1]])
                       for n in result.split(", ")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty.empty_table()
        order = np.argsort(-left["bound"].to_numpy(), kind="stable")
        x, bound = matrix(left["vec"])[order], left["bound"].to_numpy()[order]
        return pa.table(walker(x, bound, left["id"].to_numpy()[order], left["label"].to_numpy()[order], right), empty)

    return candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, result)


def _walk_positives(k: int):
    def walker(x, bound, ids, labels, members: pa.Table) -> list:
        a, own, label = matrix(members["vec"]), members["id"].to_numpy(), members["label"].to_numpy()
        best = Best(len(a), k, members["least"].to_numpy().copy())
        reach = members["norm"].to_numpy()
        for this in np.unique(label):  # only equal labels meet
            mine, theirs = np.flatnonzero(label == this), np.flatnonzero(labels == this)

            def take(some, at, scores, mine=mine, theirs=theirs):
                who, which = np.nonzero((scores >= best.least[mine[some]][:, None])
                                        & (ids[theirs[at]] != own[mine[some]][:, None]))
                best.add(mine[some][who], scores[who, which], ids[theirs[at]][which])

            walk(x[theirs], bound[theirs], a[mine], reach[mine], lambda mine=mine: best.least[mine], take)
        owner, score, found = best.cut()
        return [members["uid"].take(pa.array(owner)).combine_chunks(), pa.array(found), pa.array(score)]

    return walker


def _walk_negatives(k: int, percent: tuple[int, int]):
    def walker(x, bound, ids, labels, members: pa.Table) -> list:
        a, own, label = matrix(members["vec"]), members["id"].to_numpy(), members["label"].to_numpy()
        owner, slot, positive, _ = _pairs(members)
        _, high = window(positive, percent)
        best = Best(len(owner), k, members["leasts"].combine_chunks().flatten().to_numpy().copy())
        first = np.searchsorted(owner, np.arange(len(a)))
        many = np.bincount(owner, minlength=len(a))

        def take(some, at, scores):
            fits = (labels[at] != label[some][:, None]) & (ids[at] != own[some][:, None])
            for nr in range(many[some].max()):
                has = np.flatnonzero(many[some] > nr)
                pair = first[some[has]] + nr
                who, which = np.nonzero(fits[has] & (scores[has] >= best.least[pair][:, None]) & (scores[has] <= high[pair][:, None]))
                best.add(pair[who], scores[has][who, which], ids[at][which])

        walk(x, bound, a, members["norm"].to_numpy(), lambda: np.minimum.reduceat(best.least, first), take)
        pair, score, found = best.cut()
        return [members["uid"].take(pa.array(owner[pair])).combine_chunks(), pa.array(slot[pair], pa.int32()), pa.array(found),
                pa.array(score)]

    return walker


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10,
                   percent: tuple[int, int] = (30, 90), scale: int = 256, id_col: str = "vec_id",
                   vec_col: str = "embedding") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``: for each anchor and each of its
    ``positives`` best rows of the same label, the ``negatives`` best rows of
    other labels whose score lies within ``percent`` of the positive's."""
    rows, dim = _rows(vectors, is_anchor, F.col("label") if label is None else label, id_col, vec_col, scale)
    anchors = rows.filter("is_anchor").drop("is_anchor")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_anchor"), 1)).alias("a")).first()
    blocks = max(1, math.ceil(counts["n"] / BLOCK_ROWS))
    seen = _sample(rows, dim)
    few = matrix(_sample(anchors, dim)["vec"])
    clusters = min(len(few), max(CLUSTERS, min(256, counts["a"] // CHUNK_ROWS)))
    centres = fit_centres(few, clusters) if clusters else np.zeros((1, dim))
    members = materialize(_first_limits(anchors, seen, centres, positives), "negatives-anchors")
    members, lists = _lists(members, centres)
    found = _walked(members, _candidates(rows, lists, blocks), blocks, _walk_positives(positives), "uid string, id long, score long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "id")
    found = found.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= positives)
    found = found.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("slot", "id", "score"))).alias("positives"))
    paired = members.drop("part", "least").join(found, "uid")
    paired = paired.select(*[n.split()[0] for n in _MEMBER.split(", ")], "positives")
    paired = materialize(_window_limits(paired, seen, negatives, percent), "negatives-pairs")
    members, lists = _lists(paired, centres)
    found = _walked(members, _candidates(rows, lists, blocks), blocks, _walk_negatives(negatives, percent),
                    "uid string, slot int, id long, score long")
    order = Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = paired.select("uid", F.col("id").alias("anchor_id"), F.inline("positives").alias("slot", "positive_id", "positive_score"))
    return found.join(named, ["uid", "slot"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                                                     "positive_score", F.col("score").alias("negative_score"))
