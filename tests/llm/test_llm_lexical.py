import math
import random
from collections import Counter

import numpy as np
import pytest

from lotcast.llm import lexical
from lotcast.llm.best import Best
from test_llm_contamination import words


def brute(docs, items, k=20):
    counts = [(d, Counter(words(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in sorted(set(items), key=repr):
        scored = []
        for d, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in Counter(words(text)).items() if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, nr + 1, s[3], -s[0]) for nr, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=repr)


def _tables(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(40)] + ["Größe", "x", "中文"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.randrange(1, 80))) for i in range(150)]
    docs += [(500 + i, docs[0][1]) for i in range(60)]  # a group of copies: ties by id
    docs += [(None, docs[0][1]), (7, docs[7][1]), (900, None), (901, ""), (902, "-- !"), (903, "x " * 40_000), (-5, docs[0][1])]
    items = [(i, text(rng.randrange(1, 30)).upper()) for i in range(15)]
    items += [(20, None), (21, ""), (22, "unknownword"), (23, "x x x x"), (3, items[3][1]), (None, "t1 t2"), (30, docs[0][1])]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 24, 700])

def test_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(lexical, "CELLS", 1 << 21 if limit > 700 else 64)
    docs, items = _tables(limit % 7)
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, item_id string").repartition(5)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    assert found(lexical.rank(d, i, limit=limit)) == brute(docs, items)


def test_edges(spark):
    d = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    i = spark.createDataFrame([("p", "a c"), ("q", "zz")], "item_id string, text string")
    assert found(lexical.rank(d, i)) == brute([(1, "a b"), (2, "a")], [("p", "a c"), ("q", "zz")])
    for docs, items in ((d.limit(0), i), (d, i.limit(0)), (d.limit(0), i.limit(0))):
        assert lexical.rank(docs, items).count() == 0
    assert [r["rank"] for r in lexical.rank(d, i, k=1).collect()] == [1]


def test_cuts_bound_what_a_block_reaches(monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 10)
    rng = np.random.default_rng(0)
    for reached in ([], [0, 0, 0], [30], [4, 4, 4, 30, 1, 9], rng.integers(0, 9, 50).tolist()):
        cuts = list(lexical._cuts(np.array(reached, int), 4))
        assert [k for s, e in cuts for k in range(s, e)] == list(range(len(reached)))
        assert all(e - s <= 4 and (e - s == 1 or sum(reached[s:e]) <= 10) for s, e in cuts)


def test_sums_beyond_doubles_stay_whole(monkeypatch):
    index = lexical.build([b"a " * 3, b"a b"])
    w = np.array([5, 7])
    args = (np.array([80]), np.array([2]), np.array([0, 1]), np.array([9, 4]))
    whole = lexical._scores(index, w, *args)
    monkeypatch.setattr(lexical, "_MOST", 1 << 60)
    assert (lexical._scores(index, w, *args) == whole).all() and whole.shape == (1, 2)


def test_best_keeps_the_best():
    rng = np.random.default_rng(2)
    held, every = Best(5, 3, np.full(5, -1 << 40)), []
    held.room = 40
    for _ in range(60):
        owner, score, tie = rng.integers(0, 5, 30), rng.integers(0, 12, 30), rng.integers(0, 1000, 30)
        every += zip(owner, -score, tie)
        some = score >= held.least[owner]
        held.add(owner[some], score[some], tie[some])
    got = [(o, -s, t) for o, s, t in zip(*held.cut())]
    assert got == [x for o in range(5) for x in sorted(e for e in every if e[0] == o)[:3]]
