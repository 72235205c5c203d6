import itertools
import random
import zlib

from pyspark.sql import functions as F

from lotcast.llm import reshard


def test_flow_is_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        n, m, total = rng.randint(1, 3), rng.randint(1, 3), rng.randint(1, 6)
        supply, demand = [0] * n, [0] * m
        for _ in range(total):
            supply[rng.randrange(n)] += 1
            demand[rng.randrange(m)] += 1
        cost = [[rng.randint(0, 4) for _ in range(m)] for _ in range(n)]
        flow = reshard.min_cost_flow(supply, demand, cost)
        assert [sum(r) for r in flow] == supply and [sum(c) for c in zip(*flow)] == demand
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        slots = [j for j, d in enumerate(demand) for _ in range(d)]
        best = min(sum(cost[i][j] for i, j in zip(units, p)) for p in set(itertools.permutations(slots)))
        assert sum(f * c for a, b in zip(flow, cost) for f, c in zip(a, b)) == best


def test_query_keeps_the_law(spark):
    from lotcast.llm.queries import NEW_SHARDS, OLD_SHARDS, op4_reshard
    sf = "/root/testdata/sf0.01"
    p = op4_reshard(spark, sf).toPandas()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(p.doc_id) == sorted(docs) and p.grown_shard.isna().all() and set(p.law) == {"bytes"}
    for r in p.itertuples():
        raw = (docs[r.doc_id]["text"] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert r.old_shard == zlib.crc32((docs[r.doc_id]["source"] or "").encode()) % OLD_SHARDS
    sizes = p.groupby("shard")["size"].sum()
    assert len(sizes) == NEW_SHARDS and sizes.max() - sizes.min() < 0.05 * sizes.mean()
    for _, g in p.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    least = sum(max(0, b - p["size"].sum() / NEW_SHARDS) for b in p.groupby("old_shard")["size"].sum())
    assert p[p.old_shard != p.shard]["size"].sum() <= 1.05 * least + p["size"].max()
    again = op4_reshard(spark, sf).toPandas()
    assert p.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_files_of_affected_shards_are_rewritten(spark, tmp_path):
    rows = [(i, None if i == 5 else "t" * (i % 7), i % 2) for i in range(60)] + [(7, "same", 0), (7, "same", 0), (None, "n", 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, old int, slot string")
    placed = reshard.reshard(docs, F.col("old"), 3).cache()
    assert placed.count() == len(rows)
    affected = reshard.rewrite_affected(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert affected == [0, 1, 2] and back.count() == len(rows)
    want = sorted((str(r["doc_id"]), r["shard"]) for r in placed.collect())
    assert sorted((str(r["doc_id"]), r["shard"]) for r in back.select("doc_id", "shard").collect()) == want
    still = reshard.reshard(docs.filter("old = 0"), F.lit(0), 1)
    assert reshard.rewrite_affected(docs.filter("old = 0"), still, str(tmp_path / "none")) == []
    assert reshard.reshard(docs.limit(0), F.col("old"), 3).count() == 0
    unknown = reshard.reshard(docs, F.lit(None).cast("int"), 4)
    assert unknown.filter("old_shard is null").count() == len(rows)


def test_emptied_shards_leave_the_old_layout(spark, tmp_path):
    path = str(tmp_path / "layout")
    rows = [(i, "t" * (i % 7), None if i % 10 == 9 else i % 4) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string, shard int").write.partitionBy("shard").parquet(path)
    for n in (2, 1):
        docs = spark.read.parquet(path)
        placed = reshard.reshard(docs, F.col("shard"), n).cache()
        want = sorted((r["doc_id"], r["shard"]) for r in placed.collect())
        affected = reshard.rewrite_affected(docs, placed, path)
        assert affected == ([0, 1, 2, 3] if n == 2 else [0, 1])
        back = spark.read.parquet(path).collect()
        assert sorted((r["doc_id"], r["shard"]) for r in back) == want and len(back) == len(rows)
        assert all(r["text"] == "t" * (r["doc_id"] % 7) for r in back)
        assert sorted(p.name for p in (tmp_path / "layout").glob("shard=*")) == [f"shard={k}" for k in range(n)]


def test_capacities_fill_up():
    assert reshard.equal_capacities(10, 3) == [4, 3, 3] or sum(reshard.equal_capacities(10, 3)) == 10
    assert sum(reshard.equal_capacities(7, 3, [9, 0, 0])) == 7
    assert reshard.equal_capacities(7, 3, [9, 0, 0])[0] == 0
