import random

import numpy as np
import pytest
from brute import text_measures

from lotcast.llm import quality


def test_measures_equal_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        words = [rng.choice(["a", "bb", "é#", "*x*", "|", "ccc", "日本"]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", "\n", "\t", " \x0b", "\r\n", " "]) for w in words)
        got = dict(zip(quality.STATS, quality.measure(text)))
        assert {k: got[k] for k in text_measures(text)} == text_measures(text)
    assert set(quality.measure(None)) == {0} == set(quality.measure(" \n"))


def test_model_finds_accuracies():
    """Votes drawn from known accuracies: the posterior sorts the two kinds."""
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.85, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(len(good)) < 0.3, 0, np.where(rng.random(len(good)) < a, 1, -1) * np.where(good, 1, -1))
                      for a in accuracy], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    rules = [f"r{k}" for k in range(5)]
    model = quality.fit([(tuple(map(int, p)), int(c)) for p, c in zip(patterns, counts)], rules)
    total = model.prior + sum(np.take(model.log_odds[r], votes[:, k] + 1) for k, r in enumerate(rules))
    assert ((total > 0) == good).mean() > 0.9
    assert all(model.log_odds[r][0] <= 0 <= model.log_odds[r][2] and model.log_odds[r][1] == 0 for r in rules)


@pytest.fixture(scope="module")
def judged(spark):
    from lotcast.llm.queries import op3_quality
    return op3_quality(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")


def test_query_against_brute_force_and_labels(spark, judged):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(judged) == len(docs)
    for d in docs:
        row, want = judged.loc[d["doc_id"]], text_measures(d["text"])
        assert {k: row[k] for k in want} == want
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").join(judged)
    passed = labels[~labels.base_failed]
    assert ((passed.quality == 1) == passed.kept).mean() > 0.98
    assert ((labels.quality == 1) == (labels.posterior >= 0.5)).mean() > 0.98


def test_edges(spark):
    clean = "The quick brown fox jumps over a lazy dog while many other animals look on. " * 1
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, clean, "s"), (4, clean, "s"), (4, clean, "s"),
                                  (5, "word " * 200_000, "s")], "doc_id long, text string, stats string")
    got = quality.judge(docs)
    assert got.count() == 6
    assert got.filter("doc_id = 5").first()["n_repeat_words"] == 200_000
    assert {r["doc_id"]: r["base_failed"] for r in got.collect()} == {1: True, 2: True, None: False, 4: False, 5: True}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.judge(docs.limit(0)).count() == 0 == quality.keep_good(docs.limit(0)).count()
