import math

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lotcast import schemas as S
from lotcast.functions import band, cast_lenient, decode_messages, encode_messages, lenient


def _band_of(spark, values, bands):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, v double")
    edges, labels, else_label = bands
    return [r[0] for r in df.orderBy("i").select(band("v", edges, labels, else_label)).collect()]


def test_band_activity_edges(spark):
    got = _band_of(spark, [9, 10, 19.99, 20, 299.99, 300, 301], S.ACTIVITY_BANDS)
    assert got == ["1-10", "10-20", "10-20", "20-40", "200-300", ">300", ">300"]


def test_band_price_edges(spark):
    got = _band_of(spark, [-1, 1.99, 2, 120, None, float("nan")], S.PRICE_BANDS)
    assert got == ["0-2", "0-2", "2-10", ">120", ">120", ">120"]


def test_band_ratio_edges(spark):
    got = _band_of(spark, [-0.1, 0.2, 0.8, 1.7, None, float("nan")], S.RATIO_BANDS)
    assert got == ["0-0.2", "0.2-0.4"] + ["0.8-1.0"] * 4


def test_band_null_label(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "v double")
    edges, labels, else_label = S.PRICE_BANDS
    got = [r[0] for r in df.select(band("v", edges, labels, else_label, null_label="none")).collect()]
    assert got == ["none", "2-10"]


def _cast(spark, values, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(lenient("s", dtype)).collect()]


def test_cast_lenient_int(spark):
    got = _cast(spark, ["12", "1.0", "1.7", "", "nan", "abc", None, " 7 ", "-2.9", "1e2"], IntegerType())
    assert got == [12, 1, 1, None, None, None, None, 7, -2, 100]


def test_cast_lenient_bigint_exact(spark):
    assert _cast(spark, ["9007199254740993", "1.0"], LongType()) == [9007199254740993, 1]


def test_cast_lenient_double(spark):
    got = _cast(spark, ["1.5", "nan", "abc", "-1e-3", ".5", "Infinity"], DoubleType())
    assert got[:5] == [1.5, None, None, -0.001, 0.5]
    assert math.isinf(got[5])


def test_cast_lenient_keeps_nan_when_asked(spark):
    df = spark.createDataFrame([("nan",)], "s string")
    (v,) = df.select(lenient("s", DoubleType(), nan_to_null=False)).first()
    assert math.isnan(v)


def test_cast_lenient_frame_passes_other_columns(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string")
    schema = StructType([StructField("a", IntegerType()), StructField("c", DoubleType())])
    out = cast_lenient(df, schema)
    assert out.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert tuple(out.first()) == (1, "x", 2.5)


def test_decode_messages_cases(spark):
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    msgs = ['{"a": "1", "b": "x"}', "not json", '{"a": "2"}', '{"a": "3", "b": "y", "zz": "extra"}']
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "i int, value string")
    rows = decode_messages(df, schema, keep=["i"]).orderBy("i").collect()
    assert (rows[0]["a"], rows[0]["b"], rows[0]["_corrupt_record"]) == ("1", "x", None)
    assert (rows[1]["a"], rows[1]["b"], rows[1]["_corrupt_record"]) == (None, None, "not json")
    assert (rows[2]["a"], rows[2]["b"]) == ("2", None)
    assert (rows[3]["a"], rows[3]["b"]) == ("3", "y")
    assert "zz" not in rows[3].asDict()


def test_encode_decode_round_trip_with_types(spark):
    df = spark.sql("SELECT 9007199254740993L AS id, 0.1D AS x, 'a\"b' AS s, "
                   "TIMESTAMP_NTZ'2024-01-02 03:04:05.123456' AS ts, CAST(NULL AS INT) AS n")
    wire = encode_messages(df, key="id")
    assert wire.columns == ["key", "value"]
    assert wire.first()["key"] == "9007199254740993"
    back = cast_lenient(decode_messages(wire, S.all_strings(df.columns), corrupt_col=None), df.schema)
    assert back.collect() == df.collect()


def test_listing_schemas_shape():
    assert len(S.LISTING_BATCH.fields) == 28
    assert len(S.LISTING_MESSAGE.fields) == 33
    assert len(S.LISTING_STREAM.fields) == 32
    assert len(S.PRICE_FEATURES) == 23 and len(S.SOLD_FEATURES) == 22
    assert "QuantitySold" in S.PRICE_FEATURES and "QuantitySold" not in S.SOLD_FEATURES
    stream_names = [f.name for f in S.LISTING_STREAM.fields]
    assert stream_names == [k for k in S.LISTING_MESSAGE_KEYS if k != "Authenticated"]


def test_band_rejects_bad_spec():
    import pytest
    with pytest.raises(ValueError):
        band(F.lit(1), [2, 1], ["a", "b"], "c")


def test_decode_kafka_shaped_binary_value(spark):
    rows = [(bytearray(b'"key"'), bytearray(b'{"EbayID": "7", "Price": "1.5", "Authenticated": "1"}'), 0, 41),
            (None, bytearray(b"{broken"), 1, 42)]
    df = spark.createDataFrame(rows, "key binary, value binary, partition int, offset long")
    out = decode_messages(df, S.LISTING_MESSAGE, keep=["partition", "offset"]).orderBy("offset").collect()
    assert (out[0]["EbayID"], out[0]["Price"], out[0]["Authenticated"]) == ("7", "1.5", "1")
    assert out[0]["_corrupt_record"] is None and out[0]["SellerName"] is None
    assert out[1]["EbayID"] is None and out[1]["_corrupt_record"] == "{broken"
    typed = cast_lenient(decode_messages(df, S.LISTING_MESSAGE, corrupt_col=None), S.LISTING_STREAM)
    assert [r["EbayID"] for r in typed.orderBy("EbayID").collect()] == [None, 7]
    assert dict(typed.dtypes)["EbayID"] == "bigint" and dict(typed.dtypes)["Price"] == "double"


def test_one_message_is_one_object(spark):
    texts = ["", "  ", None, '{"EbayID":"3"}{"EbayID":"4"}', '{"EbayID":"3"} trailing', '{"EbayID":"3"},{"EbayID":"4"}',
             '[{"EbayID":"3"}]', "5", "{broken", ' {"EbayID": "3", "more": [1, {"a": 2}]} ', "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = decode_messages(df, S.all_strings(["EbayID"]), keep=["i"]).orderBy("i").collect()
    assert [r["EbayID"] for r in got] == [None] * 9 + ["3", None]
    assert [r["_corrupt_record"] for r in got] == [t or "" for t in texts[:9]] + [None, None]


def test_text_behind_an_object_is_never_passed(spark):
    """Braces in values and nested objects are fine; anything behind the
    object is not."""
    good = ['{"k": 1}', ' {"k": 1} \n', '{"k": 1, "t": "a}b{"}', '{"k": 1, "n": {"m": {}}}', "{}", '{"t": "}"}']
    bad = ['{"k":1}{"k":2}', '{"k":1},{"k":2}', '{"k":1}]', '{"k":1}] , [{"k":1}', '{"k":1}]}', '{"k":1},0', '{"k":1} x', '{"k":1',
           '[{"k":1}]', "0", "", " ", None, '{"k": "x"}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(good + bad)], "i int, value string")
    got = {r["i"]: r["_corrupt_record"] for r in decode_messages(df, StructType([StructField("k", IntegerType())]), keep=["i"]).collect()}
    assert [got[i] for i in range(len(good))] == [None] * len(good)
    assert [got[len(good) + i] for i in range(len(bad))] == [v or "" for v in bad]
