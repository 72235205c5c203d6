import pytest

from lotcast import schemas as S
from lotcast.plans.listing_jobs import Sink
from lotcast.session import scratch_path, scratch_root
from lotcast.sinks import jdbc_options, write_table
from lotcast.sources import kafka_options, read_listings


def test_kafka_options():
    o = kafka_options("b1:9092,b2:9092", "listings", max_offsets_per_trigger=1000)
    assert o["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert o["subscribe"] == "listings"
    assert o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "1000"
    assert o["kafka.max.partition.fetch.bytes"] == "15728640"
    assert kafka_options("b", "t", max_fetch_bytes=None, **{"kafka.group.id": "g"})["kafka.group.id"] == "g"


def test_jdbc_options_have_no_defaults():
    o = jdbc_options("jdbc:x://h/db", user="u", password="p", batchsize=500, truncate=True, num_partitions=4)
    assert o == {"url": "jdbc:x://h/db", "user": "u", "password": "p", "batchsize": "500",
                 "numPartitions": "4", "truncate": "true"}
    assert jdbc_options("jdbc:x://h/db") == {"url": "jdbc:x://h/db"}


def test_sink_targets():
    assert Sink("jdbc", options={"url": "u"}).target("task_week") == "task_week"
    assert Sink("parquet", "/a/b/").target("t") == "/a/b/t"
    with pytest.raises(ValueError):
        Sink("parquet").target("t")


def test_scratch_is_under_checkpoint_dir(spark):
    root = scratch_root(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(root)


def test_csv_header_maps_schema_by_position(spark):
    path = scratch_path(spark, "t_csv")
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    write_table(df, path, fmt="csv")
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("first", StringType()), StructField("second", IntegerType())])
    back = read_listings(spark, path, schema, fmt="csv", header=True).first()
    assert (back["first"], back["second"]) == ("x", 1)


def test_landed_csv_without_header(spark):
    path = scratch_path(spark, "t_landed_csv")
    row = [str(i) for i in range(32)]
    spark.createDataFrame([row], S.LISTING_LANDED).write.option("header", False).csv(path)
    back = read_listings(spark, path, S.LISTING_LANDED, header=False).first()
    assert back["EbayID"] == "0" and back["IsInMedianRatio25Percent"] == "31"


def test_csv_malformed_lines_keep_their_text(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    path = scratch_path(spark, "t_csv_bad")
    spark.createDataFrame([("a", "1"), ("b", "oops")], "s string, n string").write.option("header", True).csv(path)
    schema = StructType([StructField("s", StringType()), StructField("n", IntegerType())])
    rows = read_listings(spark, path, schema, corrupt_col="_corrupt_record").cache()
    got = sorted((r["s"], r["n"], r["_corrupt_record"]) for r in rows.collect())
    assert got == [("a", 1, None), ("b", None, "b,oops")]


class _Tables:
    """A stand-in for a JDBC connection: knows its tables, keeps statements."""

    def __init__(self, *tables, quote='"'):
        self.tables, self.quote, self.ran, self.closed = tables, quote, [], False

    def getMetaData(self):
        return self

    def getIdentifierQuoteString(self):
        return self.quote

    def getTables(self, catalog, schema, name, types):
        self.found = (schema, name) in self.tables
        return self

    def next(self):
        return self.found

    def close(self):
        pass

    def prepareStatement(self, sql):
        self.ran.append([sql])
        return self

    def setLong(self, i, v):
        self.ran[-1].append((i, v))

    setString = setLong

    def executeUpdate(self):
        self.ran[-1].append("done")


def test_replayed_batches_delete_only_their_own_rows():
    from lotcast.sinks.writers import delete_batch
    fresh = _Tables()
    assert not delete_batch(fresh, "scores", {"stream_id": "a", "batch_id": 0}) and fresh.ran == []
    plain = _Tables((None, "SCORES"))
    assert delete_batch(plain, "scores", {"stream_id": "a", "batch_id": 3})
    assert plain.ran == [['DELETE FROM "SCORES" WHERE stream_id = ? AND batch_id = ?', (1, "a"), (2, 3), "done"]]
    nested = _Tables(("shop", "my table"), quote="`")
    assert delete_batch(nested, "shop.my table", {"stream_id": "b", "batch_id": 0})
    assert nested.ran[0][0] == "DELETE FROM `shop`.`my table` WHERE stream_id = ? AND batch_id = ?"
    assert not delete_batch(_Tables((None, "my table")), "shop.my table", {"batch_id": 0})


def test_batch_writer_deletes_then_appends(spark, monkeypatch):
    from lotcast.sinks import writers
    conn, written = _Tables((None, "scores")), []
    monkeypatch.setattr(writers, "write_table", lambda df, *a: written.append((df.collect(), *a)))
    batch = spark.createDataFrame([(1, 7)], "x int, batch_id long")
    for stream in ("first", "second"):  # a new checkpoint is a new stream
        writers.jdbc_batch_writer("scores", {"url": "u"}, stream, connect=lambda s, o: conn)(batch, 7)
    assert [r[1:3] for r in conn.ran] == [[(1, "first"), (2, 7)], [(1, "second"), (2, 7)]]
    assert [tuple(w[0][0]) for w in written] == [(1, 7, "first"), (1, 7, "second")]


def test_stream_id_lives_with_its_checkpoint(spark):
    from lotcast.session import drop_scratch, scratch_path
    from lotcast.streaming import checkpoint_stream_id
    a, b = scratch_path(spark, "ckpt-a"), scratch_path(spark, "ckpt-b")
    first = checkpoint_stream_id(spark, a)
    assert checkpoint_stream_id(spark, a) == first != checkpoint_stream_id(spark, b)
    drop_scratch(spark, a)
    assert checkpoint_stream_id(spark, a) != first
    import pytest
    with pytest.raises(ValueError):
        drop_scratch(spark, "/elsewhere")
