"""The registered queries: each reference operator run over the test
tables in the role SURVEY §7.4 gives them.

Roles: ``events`` rows are listings, ``event_type = 'purchase'`` means
sold, ``value`` is price and activity, ``user_id`` the seller, the weekday
of ``ts`` the end day and ``props`` the JSON message; ``lineitem`` gives
the ratio (``l_discount * 10`` over returned lines) and the price-model
inputs; ``labels`` + ``documents`` give the sold/unsold classifier input.
Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lotcast import schemas as S
from lotcast.functions.bands import band
from lotcast.functions.casts import cast_lenient, lenient_double, lenient_integral
from lotcast.functions.codec import decode_messages, encode_messages
from lotcast.ml.bagging import fit_bagged
from lotcast.ml.leaderboard import evaluate, evaluated_rows
from lotcast.ml.least_squares import GrowingFit
from lotcast.ml.models import CLASSIFICATION, REGRESSION, assembler, fit_all, load_all, prediction_col, save_all, usable
from lotcast.ml.registry import Registry
from lotcast.ml.score import score
from lotcast.operators.clean import clean, split_rejects, tag_rejects
from lotcast.operators.split import hash_split
from lotcast.operators.metrics import classification_metrics, per_class_recall, regression_metrics
from lotcast.operators.reports import band_counts, category_counts, sold_reports, top_k
from lotcast.plans.listing_jobs import (
    ingest_messages,
    landed_folder,
    listing_reports_stream,
    read_landed,
    read_rejects,
    report_dimensions,
)
from lotcast.plans.listing_tables import listings, messages
from lotcast.session import scratch_path
from lotcast.sinks.writers import write_table
from lotcast.sources.readers import read_listings, read_table
from lotcast.streaming.dedup import without_resent
from lotcast.streaming.ingest import open_stream, stream_to_files
from lotcast.streaming.reports import ReportTable
from lotcast.streaming.scoring import read_released_scores, score_stream, score_stream_released

Query = Callable[[SparkSession, str], DataFrame]

K_SCHEMA = StructType([StructField("k", IntegerType(), True)])
PRICE_INPUTS = ["l_quantity", "l_discount", "l_tax"]
PRICE_LABEL = "l_extendedprice"
SPLIT = [0.8, 0.2]
#: Partitions at least that the fits on lineitem are dealt into, whatever the
#: cluster (a forest depends on it; see ``fit_all``).
FIT_PARTITIONS = 8


def _sold() -> Column:
    return F.col("event_type") == F.lit("purchase")


def _returned() -> Column:
    return F.col("l_returnflag") == F.lit("R")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events")


def _with_k(df: DataFrame) -> DataFrame:
    """events + the ``k`` field of its JSON ``props``."""
    return df.withColumn("k", F.from_json("props", K_SCHEMA)["k"])


def _weekday(ts: str = "ts") -> Column:
    return F.date_format(F.col(ts), "EEEE")


# --- reports (AGG1-5, EXP1-3, FLT3, SRT1) -----------------------------------

def bucket_activity(spark: SparkSession, d: str) -> DataFrame:
    return band_counts(_events(spark, d), "value", S.ACTIVITY_BANDS, where=_sold())


def bucket_price(spark: SparkSession, d: str) -> DataFrame:
    return band_counts(_events(spark, d), "value", S.PRICE_BANDS, where=_sold())


def bucket_ratio(spark: SparkSession, d: str) -> DataFrame:
    lineitem = read_table(spark, d, "lineitem")
    return band_counts(lineitem, F.col("l_discount") * 10, S.RATIO_BANDS, where=_returned())


def weekday_counts(spark: SparkSession, d: str) -> DataFrame:
    return category_counts(_events(spark, d), _weekday(), S.WEEKDAY_COL, where=_sold())


def top_sellers(spark: SparkSession, d: str) -> DataFrame:
    return top_k(_events(spark, d), "user_id", S.TOP_SELLERS, S.SELLER_COL, where=_sold())


def all_reports(spark: SparkSession, d: str) -> DataFrame:
    """Activity, price, weekday and seller counts from ONE scan."""
    edges_a, labels_a, else_a = S.ACTIVITY_BANDS
    edges_p, labels_p, else_p = S.PRICE_BANDS
    dims = {
        "activity": band("value", edges_a, labels_a, else_a),
        "price": band("value", edges_p, labels_p, else_p),
        "weekday": _weekday(),
        "seller": F.col("user_id"),
    }
    return sold_reports(_events(spark, d), dims, where=_sold())


# --- cleaning and casts (FLT1-2, FLT4, PRJ2, EXP4, EXP7) --------------------

def clean_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Listing-shaped projection of lineitem, cleaned and de-duplicated."""
    listing = read_table(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    return clean(listing, required=["l_suppkey", "l_returnflag", "l_linestatus"],
                 positive=["l_quantity"])


def lenient_cast(spark: SparkSession, d: str) -> DataFrame:
    """Values written as text (as the wire carries them), cast back."""
    text = _events(spark, d).select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        F.col("value").cast("string").alias("value_text"),
        "props", "event_type")
    return text.select(
        "event_id",
        lenient_integral("id_text", LongType()).alias("id_long"),
        lenient_double("value_text").alias("value_double"),
        lenient_integral("value_text", IntegerType()).alias("value_int"),
        lenient_double("props").alias("props_double"),
        lenient_integral("event_type", IntegerType()).alias("type_int"))


def reject_split(spark: SparkSession, d: str) -> DataFrame:
    """Rows a model could not use, with the reason (nothing is dropped:
    good rows come back with a NULL reason)."""
    ev = _with_k(_events(spark, d)).select("event_id", "value", "k")
    return tag_rejects(ev, ["value", "k"])


# --- message codec (SRC6, EXP5-6, SNK9, PRJ1) --------------------------------

MESSAGE_FIELDS = [("event_id", "long"), ("user_id", "long"), ("event_type", "string"),
                  ("value", "double"), ("props", "string")]


def decode_json(spark: SparkSession, d: str) -> DataFrame:
    decoded = decode_messages(_events(spark, d), K_SCHEMA, value_col="props", keep=["event_id"])
    return decoded.select("event_id", "k")


def encode_decode(spark: SparkSession, d: str) -> DataFrame:
    """Rows -> string-valued JSON messages -> rows -> types."""
    names = [n for n, _ in MESSAGE_FIELDS]
    wire = encode_messages(_events(spark, d), names, key="event_id")
    decoded = decode_messages(wire, S.all_strings(names), value_col="value", corrupt_col=None)
    return cast_lenient(decoded, S.struct(MESSAGE_FIELDS))


# --- file round trip (SRC1, SRC3, SNK1) ---------------------------------------

def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Write CSV with a header to the shared scratch folder, read it back
    with the declared schema."""
    names = [n for n, _ in MESSAGE_FIELDS]
    path = scratch_path(spark, "csv_round_trip")
    write_table(_events(spark, d).select(*names), path, fmt="csv")
    return read_listings(spark, path, S.struct(MESSAGE_FIELDS), fmt="csv", header=True)


def landed_csv(spark: SparkSession, d: str) -> DataFrame:
    """Rows landed as headerless all-text CSV (as the stream ingest writes
    them), read back with a positional schema and cast leniently."""
    names = [n for n, _ in MESSAGE_FIELDS]
    root = scratch_path(spark, "landed_csv")
    text = _events(spark, d).select(*[F.col(n).cast("string").alias(n) for n in names])
    write_table(text, root, fmt="csv", options={"header": "false"})
    raw = read_listings(spark, root, S.all_strings(names), fmt="csv", header=False)
    return cast_lenient(raw, S.struct(MESSAGE_FIELDS))


# --- metrics (EVA1-2, AGG6-7) ---------------------------------------------------

def reg_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Price metrics of a band-midpoint predictor, in one aggregation."""
    ev = _events(spark, d).withColumn("midpoint", F.floor(F.col("value") / 10) * 10 + 5)
    m = regression_metrics(ev, "value", {"band_midpoint": "midpoint"})
    return m.select("id", "algorithm_name",
                    *[F.round(c, 6).alias(c) for c in ("rmse", "mse", "r2", "mae")])


def clf_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Sold metrics of a parity predictor (``k % 2``), in one pass."""
    ev = _with_k(_events(spark, d)).select(
        _sold().cast("double").alias("sold"), (F.col("k") % 2).cast("double").alias("parity"))
    m = classification_metrics(ev, "sold", {"k_parity": "parity"})
    return m.select("id", "algorithm_name",
                    *[F.round(c, 9).alias(c) for c in ("accuracy", "weighted_recall", "f1")])


def reg_metrics_multi(spark: SparkSession, d: str) -> DataFrame:
    """Two predictors ranked in the same single aggregation."""
    ev = _events(spark, d).select(
        "value",
        (F.floor(F.col("value") / 10) * 10 + 5).alias("midpoint"),
        (F.floor(F.col("value") / 10) * 10).alias("floor10"))
    m = regression_metrics(ev, "value", {"band_midpoint": "midpoint", "band_floor": "floor10"})
    return m.select("id", "algorithm_name",
                    *[F.round(c, 6).alias(c) for c in ("rmse", "mse", "r2", "mae")])


def class_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall of each true class (what weighted recall hides)."""
    ev = _with_k(_events(spark, d)).select(
        _sold().cast("double").alias("sold"), (F.col("k") % 2).cast("double").alias("parity"))
    r = per_class_recall(ev, "sold", {"k_parity": "parity"})
    return r.select("model_id", "algorithm_name", "label", "n_label", "tp",
                    F.round("recall", 9).alias("recall"))


# --- models (REG1-3, CLS1-3, FEA1-2, PIP1-4, LDR1-2) ---------------------------

def _linear_k(spark: SparkSession, d: str) -> PipelineModel:
    ev = _with_k(_events(spark, d))
    return fit_all(ev, ["k"], "value", REGRESSION, prefix="value", only=["value_linear"])["value_linear"]


def linear_fit(spark: SparkSession, d: str) -> DataFrame:
    """Least squares ``value ~ k`` with spark.ml; slope and intercept."""
    lr = _linear_k(spark, d).stages[-1]
    row = [(float(lr.coefficients[0]), float(lr.intercept))]
    out = spark.createDataFrame(row, "slope double, intercept double")
    return out.select(F.round("slope", 8).alias("slope"), F.round("intercept", 8).alias("intercept"))


def price_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    """Three price regressors, trained on 80% of lineitem, ranked on 20%."""
    lineitem = read_table(spark, d, "lineitem").select(*PRICE_INPUTS, PRICE_LABEL)
    train, test = hash_split(lineitem, SPLIT, seed=10)
    models = fit_all(train, PRICE_INPUTS, PRICE_LABEL, REGRESSION, prefix="price", fit_partitions=FIT_PARTITIONS,
                     group_bins=True)
    return evaluate(models, test, PRICE_LABEL, REGRESSION)


def _count_chars(text: Column, chars: str) -> Column:
    """Occurrences of any of ``chars`` in the whole text (a character
    translate, no regex)."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


# Character classes counted by the text features.
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def document_features(docs: DataFrame) -> DataFrame:
    """Whole-text length features of documents (JVM string functions, no
    shuffle)."""
    text = F.col("text")
    return docs.select(
        "doc_id",
        F.length(text).cast("double").alias("n_chars"),
        F.when(text.isNotNull(), F.size(F.split(F.trim(text), r"\s+"))).cast("double").alias("n_words"),
        (_count_chars(text, "\n") + 1).alias("n_lines"),
        _count_chars(text, DIGITS).alias("n_digits"),
        _count_chars(text, UPPER).alias("n_upper"),
        _count_chars(text, PUNCT).alias("n_punct"),
    )


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_upper", "n_punct"]


#: Most label ids that are broadcast to pick documents (8 bytes each).
BROADCAST_IDS = 1_000_000


def _labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    """Labels joined to the features of the labelled documents. Every text
    becomes six numbers where it is read, so no shuffle carries text. Up to
    ``BROADCAST_IDS`` label ids (counted first) are broadcast, so unlabelled
    documents go before their text is looked at; beyond that the six numbers
    of all documents are joined."""
    labels = read_table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    if labels.count() <= BROADCAST_IDS:
        docs = docs.join(F.broadcast(labels.select("doc_id").distinct()), "doc_id", "left_semi")
    return labels.join(document_features(docs), "doc_id")


def sold_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    """Three classifiers (quality 0/1 from text features), 80/20 split.

    The labelled feature table is written once to the shared scratch
    folder: the texts are scanned once (not once per split), and a lost
    executor recomputes from six numbers per document, not from the text.
    """
    path = scratch_path(spark, "labelled_documents")
    _labelled_documents(spark, d).write.mode("overwrite").parquet(path)
    train, test = hash_split(spark.read.parquet(path), SPLIT, seed=10)
    models = fit_all(train, DOC_FEATURES, "quality", CLASSIFICATION, prefix="sold")
    return evaluate(models, test, "quality", CLASSIFICATION)


def score_all(spark: SparkSession, d: str) -> DataFrame:
    """Fit, save, load and score all of lineitem with the three price
    models in one scan; one prediction column per model."""
    lineitem = read_table(spark, d, "lineitem")
    models = fit_all(lineitem, PRICE_INPUTS, PRICE_LABEL, REGRESSION, prefix="price", fit_partitions=FIT_PARTITIONS,
                     group_bins=True)
    loaded = load_all(save_all(models, scratch_path(spark, "models")))
    return score(lineitem.select("l_orderkey", "l_linenumber", *PRICE_INPUTS, PRICE_LABEL), loaded)


def price_linear_scores(spark: SparkSession, d: str) -> DataFrame:
    """Saved and reloaded least-squares price model applied to all of
    lineitem in the reference's output shape: the prediction replaces the
    true price as the last column."""
    lineitem = read_table(spark, d, "lineitem")
    model = fit_all(lineitem, ["l_quantity"], PRICE_LABEL, REGRESSION, prefix="qty",
                    only=["qty_linear"])
    loaded = load_all(save_all(model, scratch_path(spark, "models")))
    scored = score(lineitem.select("l_orderkey", "l_linenumber", "l_quantity", PRICE_LABEL), loaded,
                   replace_label=PRICE_LABEL)
    return scored.withColumn(PRICE_LABEL, F.round(PRICE_LABEL, 4))


# --- models on saturated features: a fit equals a plain aggregate ------------------

def _coded(spark: SparkSession, d: str) -> DataFrame:
    """lineitem with the features and labels that models can learn exactly:
    codes of the two flags, a label that is constant for each line number,
    and a 0/1 label whose majority differs between returned lines and
    others."""
    returned = (F.col("l_returnflag") == "R").cast("double")
    return read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", PRICE_LABEL,
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("flag_code"),
        (F.col("l_linestatus") == "O").cast("double").alias("status_code"),
        (F.col("l_linenumber") * F.col("l_linenumber") * 10.0).alias("square"),
        returned.alias("returned"),
        F.when(returned == 1, F.col("l_quantity") > 10).otherwise(F.col("l_quantity") > 40).cast("double").alias("wanted"))


def _stored(spark: SparkSession, models: dict[str, PipelineModel]) -> dict[str, PipelineModel]:
    return load_all(save_all(models, scratch_path(spark, "models")))


def price_gbt_scores(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees on the two flag codes, saved, loaded and applied: the
    mean price of each combination."""
    lines = _coded(spark, d)
    models = fit_all(lines, ["flag_code", "status_code"], PRICE_LABEL, REGRESSION, prefix="flags", only=["flags_gbt"],
                     fit_partitions=FIT_PARTITIONS, group_bins=True)
    scored = score(lines.select("l_orderkey", "l_linenumber", "flag_code", "status_code"), _stored(spark, models))
    return scored.select("l_orderkey", "l_linenumber", F.round(prediction_col("flags_gbt"), 4).alias("prediction"))


def price_forest_scores(spark: SparkSession, d: str) -> DataFrame:
    """A regression forest on the line number, with a label that is constant
    for each: exact whatever the bootstrap draws."""
    lines = _coded(spark, d)
    models = fit_all(lines, ["l_linenumber"], "square", REGRESSION, prefix="line", only=["line_random_forest"])
    scored = score(lines.select("l_orderkey", "l_linenumber"), _stored(spark, models))
    return scored.select("l_orderkey", "l_linenumber", F.round(prediction_col("line_random_forest"), 6).alias("prediction"))


def bagged_scores(spark: SparkSession, d: str) -> DataFrame:
    """Both forests bagged by hashes, saved, loaded and applied: no row is
    shuffled for them, and they are exact on these features."""
    lines = _coded(spark, d)
    models = _stored(spark, {
        "line_bagged": fit_bagged(lines, ["l_linenumber"], "square", REGRESSION, "line_bagged"),
        "want_bagged": fit_bagged(lines, ["returned"], "wanted", CLASSIFICATION, "want_bagged")})
    scored = score(lines.select("l_orderkey", "l_linenumber", "returned"), models)
    return scored.select("l_orderkey", "l_linenumber", F.round(prediction_col("line_bagged"), 6).alias("square"),
                         F.col(prediction_col("want_bagged")).alias("wanted"))


def sold_scores(spark: SparkSession, d: str) -> DataFrame:
    """All three classifiers on one 0/1 feature: each group's majority, and
    from the logistic model its share."""
    lines = _coded(spark, d)
    models = _stored(spark, fit_all(lines, ["returned"], "wanted", CLASSIFICATION, prefix="want", group_equal=True))
    scored = score(lines.select("l_orderkey", "l_linenumber", "returned"), models, keep_vectors=True)
    return scored.select("l_orderkey", "l_linenumber",
                         F.round(vector_to_array("want_logistic_probability")[1], 5).alias("logistic_share"),
                         *[F.col(prediction_col(m)).alias(m.removeprefix("want_")) for m in models])


def _fifth() -> Column:
    return F.col("l_orderkey") % 5 == 0


def price_board(spark: SparkSession, d: str) -> DataFrame:
    """Three regressors trained on four fifths of the orders and ranked on
    the rest, on the line number."""
    lines = _coded(spark, d)
    models = fit_all(lines.where(~_fifth()), ["l_linenumber"], "square", REGRESSION, prefix="board",
                     group_equal=True)
    board = evaluate(models, lines.where(_fifth()), "square", REGRESSION)
    return board.select("id", "algorithm_name", *[F.round(c, 6).alias(c) for c in ("rmse", "mse", "r2", "mae")])


def sold_board(spark: SparkSession, d: str) -> DataFrame:
    """Three classifiers, trained and ranked in the same way."""
    lines = _coded(spark, d)
    models = fit_all(lines.where(~_fifth()), ["returned"], "wanted", CLASSIFICATION, prefix="board",
                     group_equal=True)
    board = evaluate(models, lines.where(_fifth()), "wanted", CLASSIFICATION)
    return board.select("id", "algorithm_name", *[F.round(c, 9).alias(c) for c in ("accurate_rate", "recall_rate", "f1_score")])


def evaluation_rows(spark: SparkSession, d: str) -> DataFrame:
    """Which rows a leaderboard rests on: a tenth of the labels and features
    is made NULL or NaN first."""
    key = F.col("l_orderkey") % 10
    lines = _coded(spark, d).withColumns({
        "square": F.when(key == 0, F.lit(None)).when(key == 1, F.lit(float("nan"))).otherwise(F.col("square")),
        "flag_code": F.when(key == 2, F.lit(None)).when(key == 3, F.lit(float("nan"))).otherwise(F.col("flag_code"))})
    train, test = lines.where(~_fifth()), lines.where(_fifth())
    models = {**fit_all(train, ["flag_code"], "square", REGRESSION, prefix="one", only=["one_linear"]),
              **fit_all(train, ["l_linenumber"], "square", REGRESSION, prefix="two", only=["two_linear"])}
    rows = evaluated_rows(models, lines, "square")
    return rows.select("id", "algorithm_name", "n_rows", "n_scored", "n_skipped")


# --- listing layouts (28, 33 and 32 columns; 23 and 22 features) --------------------

def listing_clean(spark: SparkSession, d: str) -> DataFrame:
    """Listings cleaned, landed as Parquet and read back (28 columns)."""
    path = scratch_path(spark, "listing_clean")
    clean(listings(spark, d)).write.parquet(path)
    return spark.read.schema(S.LISTING_BATCH).parquet(path)


def listing_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Listings of which a third is there twice, cleaned by row digests:
    only rows that may be repeated are shuffled whole."""
    path = scratch_path(spark, "listing_dedup")
    rows = listings(spark, d)
    rows.unionByName(rows.where(F.col("EbayID") % 3 == 0)).write.parquet(path)
    return clean(spark.read.schema(S.LISTING_BATCH).parquet(path), dedup="digest")


def listing_reports(spark: SparkSession, d: str) -> DataFrame:
    """The five sold reports of the cleaned listings, from one scan."""
    return sold_reports(clean(listings(spark, d)), report_dimensions(), where=F.col("QuantitySold") == 1.0)


def listing_features(spark: SparkSession, d: str) -> DataFrame:
    """Both feature presets assembled: their widths and the sum of their
    values, in order."""
    rows = listings(spark, d)
    rows = rows.where(usable(rows, S.PRICE_FEATURES, "Price"))
    for name, features in (("price", S.PRICE_FEATURES), ("sold", S.SOLD_FEATURES)):
        rows = assembler(features, f"{name}_vector").transform(rows) \
            .withColumn(f"{name}_values", vector_to_array(f"{name}_vector"))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6)
    return rows.select("EbayID", F.size("price_values").alias("n_price"), total("price_values").alias("price_sum"),
                       F.size("sold_values").alias("n_sold"), total("sold_values").alias("sold_sum"))


def listing_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Listings that a price model can't use, with the reason (prices of
    every seventh listing are made NULL first)."""
    rows = listings(spark, d).withColumn("Price", F.when(F.col("EbayID") % 7 != 0, F.col("Price")))
    return split_rejects(rows, [*S.PRICE_FEATURES, "Price"])[1].select("EbayID", "Price", "reject_reason")


def stream_listings(spark: SparkSession, d: str) -> DataFrame:
    """33-key wire messages, one in ten bad, through the stream: landed
    listings (typed) and rejected messages together are every message once,
    from one read of the source."""
    source, landed = scratch_path(spark, "messages"), scratch_path(spark, "landed")
    sent = messages(spark, d)
    sent.write.parquet(source)
    keep = sent.select("event_id").schema
    stream = open_stream(spark, source, sent.schema)
    ingest_messages(stream, landed, scratch_path(spark, "landed_ckpt"), keep=["event_id"]).awaitTermination()
    return _landed_and_rejected(spark, landed, keep)


def _landed_and_rejected(spark: SparkSession, landed: str, keep: StructType, compacted_root: str | None = None) -> DataFrame:
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (
        ("EbayID", "long"), ("SellerName", "string"), ("Price", "double"), ("HitCount", "int"), ("EndDay", "string"))]
    good = read_landed(spark, landed, keep=keep, compacted_root=compacted_root).select(
        F.col("EbayID").alias("event_id"), F.lit(None).cast("string").alias("rejected_text"),
        "EbayID", "SellerName", "Price", "HitCount", "EndDay")
    rejected = read_rejects(spark, landed, keep=keep, compacted_root=compacted_root)
    return good.unionByName(rejected.select("event_id", "rejected_text", *nothing))


def landed_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The same stream landed in many small batches over two runs, compacted
    twice with merging, the covered files deleted, and a last run landed
    after that: every message once."""
    source, landed, root = (scratch_path(spark, n) for n in ("messages", "landed", "generations"))
    sent = messages(spark, d)
    keep, ckpt = sent.select("event_id").schema, scratch_path(spark, "landed_ckpt")
    folder = landed_folder(spark, landed, root, keep)
    for nr in range(3):
        sent.where(F.col("event_id") % 3 == nr).repartition(3).write.mode("append").parquet(source)
        stream = open_stream(spark, source, sent.schema, max_files_per_trigger=1)
        ingest_messages(stream, landed, ckpt, keep=["event_id"]).awaitTermination()
        if nr < 2:
            folder.compact(fan_in=2)
            folder.vacuum(keep=1)
    return _landed_and_rejected(spark, landed, keep, compacted_root=root)


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Events from a source that sends messages again: a third within the
    first run, half of all in a second run of the same checkpoint an hour
    later. Each lands once."""
    events = _events(spark, d).select("event_id", "user_id", "event_type", "value", "props")
    source, out, ckpt = (scratch_path(spark, n) for n in ("resent", "resent_landed", "resent_ckpt"))
    first = events.where(F.col("event_id") % 4 != 0)
    runs = [first.unionByName(first.where(F.col("event_id") % 3 == 0)),
            events.where((F.col("event_id") % 2 == 0) | (F.col("event_id") % 4 == 0))]
    for hour, rows in enumerate(runs):
        received = F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")
        rows.withColumn("received", received).write.mode("append").parquet(source)
        stream = open_stream(spark, source, spark.read.parquet(source).schema)
        kept = without_resent(stream, events.columns, "received", "2 hours")
        stream_to_files(kept.drop("received"), out, ckpt).awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


def stream_report_table(spark: SparkSession, d: str) -> DataFrame:
    """The five sold reports after each of three arrivals of listings, kept
    by a stream that restarts for each."""
    rows = listings(spark, d)
    source, root, ckpt = (scratch_path(spark, n) for n in ("report_listings", "report_table", "report_ckpt"))
    after = []
    for nr in range(3):
        rows.where(F.col("EbayID") % 3 == nr).write.mode("append").parquet(source)
        stream = open_stream(spark, source, S.LISTING_BATCH)
        listing_reports_stream(spark, stream, root, ckpt).awaitTermination()
        table = ReportTable(spark, root)
        after.append(table.read(table.versions.latest()).withColumn("arrivals", F.lit(nr + 1)))
    return reduce(DataFrame.unionByName, after)


# --- streaming (SRC5-6, STR1-3, SNK2) -----------------------------------------

def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = read_table(spark, d, "events").schema
    return open_stream(spark, f"{d.rstrip('/')}/event[s].parquet", schema)


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """File stream -> decode JSON -> Parquet, checkpointed, drained with
    availableNow; the landed table is returned."""
    decoded = decode_messages(_event_stream(spark, d), K_SCHEMA, value_col="props",
                              keep=["event_id", "user_id", "event_type", "value"], corrupt_col=None)
    out, ckpt = scratch_path(spark, "stream_ingest"), scratch_path(spark, "stream_ingest_ckpt")
    stream_to_files(decoded, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


def stream_score(spark: SparkSession, d: str) -> DataFrame:
    """Score the event stream with the saved ``value ~ k`` model."""
    model_paths = save_all({"value_linear": _linear_k(spark, d)}, scratch_path(spark, "models"))
    models = load_all(model_paths)
    events = _with_k(_event_stream(spark, d)).select("event_id", "k")
    out, ckpt = scratch_path(spark, "stream_score"), scratch_path(spark, "stream_score_ckpt")
    score_stream(events, models, out, ckpt).awaitTermination()
    return spark.read.parquet(out).select(
        "event_id", F.round(prediction_col("value_linear"), 6).alias("prediction"))


def stream_releases(spark: SparkSession, d: str) -> DataFrame:
    """One running query over two arrivals of files, with a new release of
    the model published in between: the model of the purchases scores the
    first, the model of all other events the second."""
    events = _with_k(_events(spark, d)).select("event_id", "event_type", "value", "k")
    source, out = scratch_path(spark, "released_events"), scratch_path(spark, "released_scores")
    registry = Registry(spark, scratch_path(spark, "registry"))
    name = "value_linear"
    query = None
    for nr, rows in enumerate((_sold(), ~_sold())):
        registry.publish(fit_all(events.where(rows), ["k"], "value", REGRESSION, prefix="value", only=[name]))
        events.where(F.col("event_id") % 2 == nr).select("event_id", "k").write.mode("append").parquet(source)
        if query is None:
            stream = open_stream(spark, source, events.select("event_id", "k").schema)
            query = score_stream_released(stream, registry, out, scratch_path(spark, "released_ckpt"), trigger="1 second")
        query.processAllAvailable()
    query.stop()
    scored = read_released_scores(spark, out, events.select("event_id", "k").schema, [name])
    return scored.select("event_id", "model_version", F.round(prediction_col(name), 6).alias("prediction"))


def stream_six_models(spark: SparkSession, d: str) -> DataFrame:
    """All six models over a stream of lineitem, from one release, on
    features where each fit equals a plain aggregate."""
    lines = _coded(spark, d)
    registry = Registry(spark, scratch_path(spark, "registry"))
    price = fit_all(lines, ["l_linenumber"], "square", REGRESSION, prefix="price", group_equal=True)
    sold = fit_all(lines, ["returned"], "wanted", CLASSIFICATION, prefix="sold", group_equal=True)
    registry.publish({**price, **sold})
    columns = ["l_orderkey", "l_linenumber", "returned"]
    source, out = scratch_path(spark, "six_source"), scratch_path(spark, "six_scores")
    lines.select(*columns).write.parquet(source)
    stream = open_stream(spark, source, lines.select(*columns).schema)
    score_stream_released(stream, registry, out, scratch_path(spark, "six_ckpt")).awaitTermination()
    scored = read_released_scores(spark, out, lines.select(*columns).schema, [*price, *sold])
    return scored.select(*columns, "model_version",
                         *[F.round(prediction_col(m), 4).alias(m) for m in (*price, *sold)])


def linear_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """The ``value ~ k`` fit after each of three arrivals of events, from
    stored moments: no arrival is read after it was added."""
    events = _with_k(_events(spark, d)).select("event_id", "value", "k")
    growing = GrowingFit(spark, scratch_path(spark, "moments"), ["k"], "value")
    rows = []
    for nr in range(3):
        growing.add(events.where(F.col("event_id") % 3 == nr), f"arrival-{nr}")
        lr = growing.fit("value_linear").stages[-1]
        rows.append((nr + 1, growing.total().used, float(lr.coefficients[0]), float(lr.intercept)))
    out = spark.createDataFrame(rows, "arrivals int, n_rows long, slope double, intercept double")
    return out.withColumns({c: F.round(c, 8) for c in ("slope", "intercept")})


def linear_arrivals_scores(spark: SparkSession, d: str) -> DataFrame:
    """A price model of three arrivals of lineitem, added by a stream, saved,
    loaded and applied to all of it."""
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", PRICE_LABEL)
    source = scratch_path(spark, "arrivals")
    growing = GrowingFit(spark, scratch_path(spark, "moments"), ["l_quantity"], PRICE_LABEL)
    ckpt = scratch_path(spark, "arrivals_ckpt")
    for nr in range(3):  # the stream starts anew for each arrival and reads only that
        lines.where(F.col("l_orderkey") % 3 == nr).write.mode("append").parquet(source)
        growing.add_stream(open_stream(spark, source, lines.schema), ckpt).awaitTermination()
    loaded = load_all(save_all({"qty_linear": growing.fit("qty_linear")}, scratch_path(spark, "models")))
    scored = score(lines, loaded, replace_label=PRICE_LABEL)
    return scored.withColumn(PRICE_LABEL, F.round(PRICE_LABEL, 4))


QUERIES: dict[str, Query] = {
    "bucket_activity": bucket_activity,
    "bucket_price": bucket_price,
    "bucket_ratio": bucket_ratio,
    "weekday_counts": weekday_counts,
    "top_sellers": top_sellers,
    "all_reports": all_reports,
    "clean_distinct": clean_distinct,
    "lenient_cast": lenient_cast,
    "reject_split": reject_split,
    "decode_json": decode_json,
    "encode_decode": encode_decode,
    "csv_round_trip": csv_round_trip,
    "landed_csv": landed_csv,
    "reg_metrics": reg_metrics,
    "clf_metrics": clf_metrics,
    "reg_metrics_multi": reg_metrics_multi,
    "class_recall": class_recall,
    "linear_fit": linear_fit,
    "linear_arrivals": linear_arrivals,
    "linear_arrivals_scores": linear_arrivals_scores,
    "price_leaderboard": price_leaderboard,
    "sold_leaderboard": sold_leaderboard,
    "score_all": score_all,
    "price_linear_scores": price_linear_scores,
    "price_gbt_scores": price_gbt_scores,
    "price_forest_scores": price_forest_scores,
    "sold_scores": sold_scores,
    "bagged_scores": bagged_scores,
    "price_board": price_board,
    "sold_board": sold_board,
    "evaluation_rows": evaluation_rows,
    "listing_clean": listing_clean,
    "listing_dedup": listing_dedup,
    "listing_reports": listing_reports,
    "listing_features": listing_features,
    "listing_rejects": listing_rejects,
    "stream_listings": stream_listings,
    "stream_ingest": stream_ingest,
    "stream_score": stream_score,
    "landed_compacted": landed_compacted,
    "stream_dedup": stream_dedup,
    "stream_report_table": stream_report_table,
    "stream_releases": stream_releases,
    "stream_six_models": stream_six_models,
}
