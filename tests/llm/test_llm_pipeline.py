import pytest
from brute import near_components, removed_bytes
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lotcast.llm import mixing, pieces, quality
from lotcast.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        after = materialize(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stage_order_and_columns(steps):
    assert [n for n, _, _ in steps] == ["quality_rules", "near_dedup", "repeat_dedup", "source_mix", "encode"]
    assert all(after.columns == before.columns for _, before, after in steps[:-1])
    assert pipeline.ORACLE_SQL is None


def test_quality_stage_rejects_junk_and_keeps_clean(spark, steps):
    _, before, after = steps[0]
    kept = {r["doc_id"] for r in after.collect()}
    judged = quality.judge(before)
    assert kept == {r["doc_id"] for r in judged.filter("good").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert sum((r["quality"] == 1) == (r["doc_id"] in kept) for r in labels) >= 0.97 * len(labels)


def test_near_dedup_stage_equals_brute_force(steps):
    _, before, after = steps[1]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    want = {d for d, (_, c) in near_components(rows, 5).items() if c == d}
    assert {r["doc_id"] for r in after.collect()} == want


def test_repeat_stage_equals_brute_force(steps):
    _, before, after = steps[2]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    kept = {r["doc_id"]: r for r in after.collect()}
    for (doc_id, text), (size, gone, _, _) in zip(rows, removed_bytes([t for _, t in rows], pipeline.REPEAT_BYTES)):
        left = kept[doc_id]["text"]
        assert size - gone - 6 <= len(left.encode()) <= size - gone and kept[doc_id]["n_chars"] == len(left)
        assert gone or left == text


def test_mix_stage_takes_what_the_mix_says(steps):
    _, before, after = steps[3]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(before).filter("copies > 0").collect()}
    assert {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want


def test_encoded_stage_decodes_to_the_mixed_texts(spark, steps):
    _, before, after = steps[4]
    decoded = pieces.decode(after, pieces.read_model(pipeline.PIECE_MODEL))
    assert sorted(r["decoded"] for r in decoded.collect()) == sorted(r["text"] for r in before.collect())


def test_stages_take_awkward_documents(spark):
    """NULLs, empty and very long texts, repeated rows, empty tables and a
    column named as an output, with the result that each stage states."""
    text = "Some words of a text. " * 3
    docs = spark.createDataFrame(
        [(1, None, None, None, None, "x"), (None, "", "en", None, 0, "x"), (3, text, "en", "s", 1, "x"),
         (3, text, "en", "s", 1, "x"), (4, "w" * 50_000, "en", "s", 1, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, kept string")
    want = {
        "near_dedup": [(1, None), (3, text), (4, "w" * 50_000), (None, "")],
        "repeat_dedup": [(1, ""), (3, text), (3, text), (4, ""), (None, "")],
        "source_mix": [(3, text), (3, text), (4, "w" * 50_000)],
    }
    for name, stage in pipeline.STAGES:
        after = stage(spark, docs, SF)
        rows = after.collect()
        if name == "encode":
            assert after.columns == ["doc_id", "source", "n_tokens", "ids"]
            got = sorted(((r["doc_id"], r["n_tokens"], None if r["ids"] is None else len(r["ids"])) for r in rows), key=repr)
            assert got == [(1, None, None), (3, 25, 25), (3, 25, 25), (4, 25_000, 25_000), (None, 0, 0)]
        else:
            assert after.columns == docs.columns and all(r["kept"] == "x" for r in rows)
            got = sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)
            if name == "quality_rules":  # the verdict is the rules'; copies share it
                assert set(got) <= {(r["doc_id"], r["text"]) for r in docs.collect()} and got.count((3, text)) in (0, 2)
            else:
                assert got == want[name], name
            if name == "repeat_dedup":
                assert all(r["n_chars"] == len(r["text"]) for r in rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
