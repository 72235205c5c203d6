"""Every registered query against its DuckDB SQL on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from lotcast.plans.catalogue import QUERIES
from lotcast.plans.oracle import ORACLE

TABLES = ["lineitem", "events", "documents", "labels"]
FAST = ["bucket_activity", "bucket_price", "bucket_ratio", "weekday_counts", "top_sellers",
        "all_reports", "clean_distinct", "lenient_cast", "reject_split", "decode_json",
        "encode_decode", "csv_round_trip", "landed_csv", "price_linear_scores", "reg_metrics", "clf_metrics", "reg_metrics_multi",
        "class_recall", "linear_fit", "stream_ingest", "stream_score", "price_gbt_scores", "price_forest_scores",
        "sold_scores", "price_board", "sold_board", "evaluation_rows", "listing_clean", "listing_reports",
        "listing_features", "listing_rejects", "stream_listings", "listing_dedup", "landed_compacted", "stream_dedup",
        "stream_report_table", "stream_releases", "stream_six_models", "linear_arrivals", "linear_arrivals_scores", "bagged_scores"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(records):
    return sorted((tuple(_norm(v) for v in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_a_model_fit():
    assert set(QUERIES) - set(ORACLE) == {"price_leaderboard", "sold_leaderboard", "score_all"}
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    assert _rows(tuple(r[c] for c in cols) for r in sdf.collect()) == \
        _rows(tuple(r[i] for i in idx) for r in rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["report", "key", "counts"]
    assert df.count() > 0


def test_leaderboards_have_three_rows(spark):
    price = E.queries()["price_leaderboard"](spark, SF_SMALL).collect()
    assert [r["id"] for r in sorted(price, key=lambda r: r["id"])] == [1, 2, 3]
    assert all(r["rmse"] >= 0 for r in price)
    sold = E.queries()["sold_leaderboard"](spark, SF_SMALL).collect()
    assert len(sold) == 3 and all(0 <= r["accurate_rate"] <= 1 for r in sold)


@pytest.mark.parametrize("name", ["weekday_counts", "all_reports", "lenient_cast", "encode_decode", "clf_metrics"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        test_query_matches_oracle(spark, con, name)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
