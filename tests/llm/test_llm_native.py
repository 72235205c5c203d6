"""The DataFrame-only operators against their SQL on awkward tables."""

import duckdb
import pyarrow as pa
import pytest

from lotcast.llm import licenses, mixing, quotes
from lotcast.llm.license_texts import KNOWN
from lotcast.llm.sql import MIXING_SQL, QUOTES_SQL, license_sql


def _sql(query, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, pa.Table.from_pylist(rows))
    rel = con.sql(query)
    return sorted(repr(tuple(r)) for r in rel.fetchall()), rel.columns


def _spark(df, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def _rows(names, rows):
    return [dict(zip(names, r)) for r in rows]


DOCS = [(1, "a b c d", "s1"), (2, "a\tb\nc", "s0"), (3, None, "s0"), (4, "", None), (5, "x " * 400, None), (6, "y " * 9, "é"),
        (7, "z", "Z"), (8, "q " * 50, "s3"), (9, "q " * 51, "s3"), (9, "q " * 51, "s3"), (None, "n n n", "s1"),
        (11, "w " * 30, "s1"), (12, "w " * 7, "s1")]


def test_mixing_equals_sql(spark):
    docs = spark.createDataFrame([(*r, 0, "x") for r in DOCS], "doc_id long, text string, source string, size int, target string")
    mix = mixing.mix(docs)
    want, columns = _sql(MIXING_SQL, documents=_rows(["doc_id", "text", "source"], DOCS))
    assert _spark(mix, columns) == want
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    total = sum(r["taken"] for r in mix.collect())
    assert sum(len(r["text"].split()) for r in mixed.collect()) == total >= sum(len((t or "").split()) for _, t, _ in DOCS)
    assert mixing.mix(docs.limit(0)).count() == 0 == mixing.mixed(docs.limit(0)).count()
    assert [r["taken"] for r in mixing.mix(docs.filter("text is null or text = ''")).collect()] == [0, 0]


def test_mixing_query_comes_near_its_targets(spark):
    from lotcast.llm.queries import op6_mixing
    sf = "/root/testdata/sf0.01"
    p = op6_mixing(spark, sf).toPandas()
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    per = p.groupby(p.doc_id.map(source)).agg(size=("size", "sum"), of=("source_size", "first"), target=("target", "first"),
                                              taken=("taken", "sum"))
    assert (per["size"] == per.of).all() and abs(per.target.sum() - per["size"].sum()) < 1e-6 * per["size"].sum()
    assert ((per.taken - per.target).abs() <= p["size"].max()).all()
    assert (p.taken <= 3 * p["size"]).all() and (per.target <= 3 * per.of).all()


def _variants():
    mit = KNOWN[0][1]
    rows = [(i, text.upper().replace("LICENSE", "LICENCE").replace("COPYRIGHT HOLDER", "COPYRIGHT\nOWNER").replace(" ", "  "))
            for i, (_, text) in enumerate(KNOWN)]
    rows += [(90, "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + mit), (91, mit + " and more"),
             (92, "word\n Released under the  mit LICENCE!\nmore\nLicensed under CC BY 4.0."), (93, None), (94, ""),
             (95, "favour & colour organise v2.0 — “quote” é ß\r\n\n"), (96, "x " * 100_000), (97, "©"), (97, "©"), (None, mit)]
    return rows


def test_licenses_equal_sql_and_see_through_spelling(spark):
    rows = _variants()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, license string, digest int")
    found = licenses.scan(docs)
    want, columns = _sql(license_sql(), documents=_rows(["doc_id", "text"], rows))
    assert _spark(found, columns) == want
    got = {r["doc_id"]: r for r in found.collect()}
    for i, (name, _) in enumerate(KNOWN):
        assert got[i]["license"] == name
    assert got[90]["license"] == got[None]["license"] == "MIT" and got[91]["licenses"] is None
    assert got[92]["licenses"] == "CC-BY-4.0,MIT" and got[92]["n_notices"] == 2 and got[92]["license"] is None
    assert got[93]["digest"] is None and got[94]["licenses"] is None
    assert licenses.scan(docs.limit(0)).count() == 0


MESSAGES = [
    (1, 0, "user", "Hello there\nHow are you?"), (1, 1, "assistant", "> How are you?\nFine.\n\nAnd you?"),
    (1, 2, "user", "Unrelated question"), (1, 3, "user", "> > how  ARE you?\n> Fine.\nGood to hear"),
    (1, 4, "assistant", ">Unrelated question\nanswer\n> no such\nmore"), (1, 5, "user", "> Good to hear\nbye"),
    (2, 0, "user", None), (2, 1, None, ""), (None, 0, "x", "> a\nb"), (None, None, "x", "> b\nc"),
    (1, 2, "user", "Unrelated question"), (1, 2, "user", "dup turn"), (3, 0, "user", "ok"), (3, 1, "a", "> ok\nok"),
    (5, 0, "user", ">" * 3_000 + "deep\nsaid"), (5, 1, "a", "> said\n" + "> " * 5_000 + "\n \t" * 2_000 + "x" + " \n" * 50),
    (3, 2, "user", "> ok\n> > ok\nlater"), (3, 900, "user", "> later\n" + "long " * 50_000), (4, 1, "u", "> ahead"), (4, 2, "u", "ahead"),
]


def test_quotes_equal_sql(spark):
    names = ["conv_id", "turn", "role", "text"]
    chats = spark.createDataFrame([(*r, 0, "x") for r in MESSAGES],
                                  "conv_id long, turn long, role string, text string, position int, message string")
    linked = quotes.link_quotes(chats)
    want, columns = _sql(QUOTES_SQL, conversations=_rows(names, MESSAGES))
    assert _spark(linked, columns) == want
    one = [r["turn"] for r in linked.filter("conv_id = 1").orderBy("position").collect()]
    assert one == [0, 1, 3, 5, 2, 2, 4]
    got = {(r["conv_id"], r["turn"], r["role"]): r for r in linked.collect()}
    assert got[1, 3, "user"]["reply_to"] == 1 and got[1, 3, "user"]["text"] == "Good to hear"
    assert got[4, 1, "u"]["reply_to"] is None and got[4, 1, "u"]["n_quotes"] == 1
    assert quotes.link_quotes(chats.limit(0)).count() == 0


def test_a_million_marks_on_a_line_are_quotation(spark):
    rows = [(1, 0, "u", "said"), (1, 1, "u", ">" * 1_000_000 + " said\nmore"), (1, 2, "u", "> " * 500_000 + ">said\n" + " " * 1_000_000 + "x")]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["turn"], r["text"], r["n_quotes"], r["reply_to"]) for r in got} == {
        (0, "said", 0, None), (1, "more", 1, 0), (2, "x", 1, 0)}


@pytest.mark.parametrize("name", ["op2_licenses", "op5_minhash", "op6_mixing", "op7_quotes", "op11_wumanber", "op12_search", "op13_negatives"])
def test_queries_equal_sql(spark, name):
    from lotcast.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(rel.columns)
    assert _spark(got, rel.columns) == sorted(repr(tuple(r)) for r in rel.fetchall())


def test_known_licences_come_from_a_table(spark):
    full = "Zlib License\n\nThis software is provided 'as-is', without any warranty.\n\nPermission is granted to anyone."
    known = spark.createDataFrame([("Zlib", full)], "license string, text string")
    docs = spark.createDataFrame([(1, full.upper()), (2, "other")], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(docs, known=known).collect()}
    assert got == {1: "Zlib", 2: None}
