import random

import pytest
from brute import near_components

from lotcast.llm import minhash
from lotcast.llm.components import components


def _found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def _family(seed, members, words=40):
    """Texts that drift away from one another a word at a time."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(1000)}" for _ in range(words)]
    out = [" ".join(text)]
    for _ in range(members - 1):
        text = list(text)
        text[rng.randrange(words)] = f"n{rng.randrange(10 ** 6)}"
        out.append(" ".join(text).upper() if rng.random() < 0.2 else " ".join(text))
    return out


@pytest.mark.parametrize("size", [1, 2, 5])
@pytest.mark.parametrize("block", [1024, 3])
def test_components_equal_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = [t for s in range(4) for t in _family(s, 25)] + ["a", "A", "a b", "", None, " \t\n"]
    random.Random(5).shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(minhash.near_duplicates(docs, shingle_words=size)) == near_components(rows, size)


def test_links_that_no_star_tries(spark):
    """The smallest id of the buckets is similar enough to share bands but
    linked with nobody, while two others are linked."""
    words = [f"w{i}" for i in range(100)]
    other = [f"x{i}" for i in range(100)]
    rows = [(0, " ".join(words[:62] + other[:38])), (1, " ".join(words)), (2, " ".join(words[:95] + other[60:65]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(minhash.near_duplicates(docs, shingle_words=1)) == near_components(rows, 1)


@pytest.mark.parametrize("turned", [False, True])
def test_one_id_with_two_texts_loses_no_link(spark, turned):
    x, y = _family(1, 2), _family(2, 2)
    rows = [(5, x[0]), (5, y[0]), (7, y[1]), (8, x[1]), (9, "alone here")]
    docs = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs, shingle_words=1).collect()}
    assert got == {(5, 5), (7, 5), (8, 5), (9, 9)}


def test_hot_bucket_of_unlike_texts_is_compared_in_cells(spark, monkeypatch):
    """Many texts share a band with none like another, but for a few pairs."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "band_keys", lambda m: minhash.np.r_[minhash.np.int64(1), m[:31].view(minhash.np.int64)])
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(30)] + [(100 + i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(0, 30, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(minhash.near_duplicates(docs, shingle_words=1)) == near_components(rows, 1)


def test_edges(spark):
    long = " ".join(f"w{i % 50_000}" for i in range(100_000))
    docs = spark.createDataFrame(
        [(5, "same text here for all", "a"), (3, "same text here for all", "b"), (3, "same text here for all", "b"),
         (None, "same text here for all", "c"), (7, None, "d"), (8, "", "e"), (9, long, "f"), (10, long + " end", "g"),
         (11, "one", "h")], "doc_id long, text string, digest string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(5, 3, False), (3, 3, True), (None, None, True), (7, 7, True), (8, 8, True), (9, 9, True),
                   (10, 9, False), (11, 11, True)}
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 7, 8, 9, 11]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_is_close():
    import numpy as np
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 62, 800).astype(np.uint64)
    errors = []
    for k in range(50):
        a = np.unique(np.r_[shared, rng.integers(0, 1 << 62, 100).astype(np.uint64)])
        b = np.unique(np.r_[shared, rng.integers(0, 1 << 62, 100).astype(np.uint64)])
        x, y = minhash.packed(minhash.minima(a)), minhash.packed(minhash.minima(b))
        d = (x ^ y).view(np.uint64)
        equal = sum(1 for w in d for f in range(16) if not (int(w) >> (4 * f)) & 15)
        errors.append((equal / 128 - 1 / 16) / (15 / 16) - 0.8)
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.2


def test_long_chains_contract(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, k) for k in range(501, 560)] + [(7, 7)],
                                  "a long, b long")
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    assert all(got[k] == 1 for k in range(1, 201)) and all(got[k] == 500 for k in range(500, 560))
    assert components(edges.limit(0)).count() == 0
