import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotcast.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, id double"


def brute(rows, positives=5, count=10):
    """Every anchor with every row, in whole numbers."""
    fine = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        fine[i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    out = []
    for i, label, v in fine:
        if i % 100:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), j, m) for j, m, w in fine if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:count]
            out += [(i, j, nr + 1, n, -p, -s) for nr, (s, n, _) in enumerate(inside)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(i, v, label, "x", 1.0) for i, v, label in rows], SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label)
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                  for r in got.collect())


def _clustered(n, dim, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dim)) * 2
    which = rng.integers(0, centres, n)
    x = (middle[which] + rng.standard_normal((n, dim)) * 0.4) * rng.gamma(3, 0.4, (n, 1))
    return [(int(i), [float(a) for a in v], int(c if rng.random() < 0.7 else rng.integers(0, 10))) for i, (v, c) in enumerate(zip(x, which))]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force_on_clustered_vectors(spark, monkeypatch, small):
    if small:  # many blocks, chunks and steps, and a sample that knows little
        for name, value in (("BLOCK_ROWS", 150), ("CHUNK_ROWS", 2), ("STEP", 16), ("MEMBERS", 2), ("SAMPLE_ROWS", 30), ("CLUSTERS", 3)):
            monkeypatch.setattr(negatives, name, value)
    rows = _clustered(1500, 8, 1)
    assert found(spark, rows) == brute(rows)


def test_equals_brute_force_on_random_directions(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((900, 16))
    rows = [(int(i), [float(a) for a in v / np.linalg.norm(v)], int(i % 4)) for i, v in enumerate(x)]
    assert found(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = _clustered(300, 3, 2)
    rows += [(1000, None, 1), (1100, [nan, 1.0, 1.0], 1), (1200, [inf, 1.0, 1.0], 1), (1300, [None, 1.0, 1.0], 1), (1400, [0.0, 0.0, 0.0], 1),
             (1500, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (1600, [], 1), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]),
             (200, rows[7][1], 3)]
    rows += [(2000 + i, [1.0, 0.5, 0.25], i % 3) for i in range(250)]  # one vector that many rows share, anchors among them
    held = [r for r in rows if r[1] is None or len(r[1]) == 3]  # vectors of another length take no part
    assert found(spark, rows) == brute(held)
    assert found(spark, []) == [] and found(spark, rows[1:99]) == []
    one = [(100, [1.0, 0.0], 1), (101, [0.9, 0.1], 1), (102, [0.5, 0.1], 2)]
    assert found(spark, one) == brute(one) != []


def test_walk_ends_where_the_bound_certifies():
    """On vectors with structure most of the list is never looked at."""
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 1, (200, 8)) + [300, *[0] * 7], rng.normal(0, 1, (20_000, 8)) + [0, 300, *[0] * 6]].astype(int)
    a = np.array([[300, 0, 0, 0, 0, 0, 0, 0]] * 3)
    unit, norm = negatives._units(x)
    middle = np.eye(8)[:1]
    bound = negatives.bounds(norm, negatives.angles(unit, middle)[:, 0], 0.0)
    order = np.argsort(-bound)
    best = negatives.Best(3, 5, np.full(3, negatives._LOWEST))
    looked = []

    def take(some, at, scores):
        looked.append(len(at))
        who, which = np.nonzero(scores >= best.least[some][:, None])
        best.add(some[who], scores[who, which], order[at][which])
        best.cut()

    negatives.walk(x[order], bound[order], a, np.full(3, 300.0), lambda: best.least, take)
    assert sum(looked) <= 2 * negatives.STEP
    top = sorted((-int(s), i) for i, s in enumerate(x @ a[0]))[:5]
    assert [(-s, t) for o, s, t in zip(*best.cut()) if o == 0] == top


def test_bound_is_never_below_a_score():
    rng = np.random.default_rng(3)
    for _ in range(50):
        dim = int(rng.integers(1, 6))
        a, x = rng.integers(-50, 50, (7, dim)), rng.integers(-500, 500, (40, dim))
        centres = negatives.fit_centres(a, 2)
        (ua, na), (ux, nx) = negatives._units(a), negatives._units(x)
        mine = negatives.angles(ua, centres)
        for c in range(2):
            who = mine.argmin(1) == c
            if who.any():
                bound = negatives.bounds(nx, negatives.angles(ux, centres)[:, c], mine[who, c].max())
                assert (negatives.products(a[who], x) <= na[who][:, None] * bound + 1e-9).all()


def test_products_of_large_numbers_are_exact():
    a = np.array([[1 << 26, -(1 << 26) + 1, 3]])
    x = np.array([[(1 << 26) - 1, (1 << 26) - 5, 7]])
    assert negatives.products(a, x)[0, 0] == sum(int(p) * int(q) for p, q in zip(a[0], x[0]))
