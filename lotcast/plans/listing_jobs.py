"""The listing applications end to end, as Spark jobs:

* :func:`run_batch` -- read training and test listings, clean them, fit
  and rank the three price and three sold models, save them, and write
  the leaderboards, the cleaned training table and the five sold reports.
* :func:`ingest_messages` -- decode a stream of JSON listing messages and
  land them (32 columns), with rejected messages kept aside, exactly once.
* :func:`score_landed` / :func:`score_landed_stream` -- score landed
  listings with all six saved models in one pass (batch, or incrementally
  as files arrive).

Every output goes through a :class:`Sink`: a folder of Parquet/CSV files
or a JDBC database, chosen by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from lotcast import schemas as S
from lotcast.functions.bands import band
from lotcast.functions.casts import cast_lenient
from lotcast.functions.codec import CORRUPT_COL, decode_messages
from lotcast.ml.leaderboard import evaluated_rows, train_and_evaluate
from lotcast.ml.models import CLASSIFICATION, REGRESSION, load_all, prediction_col, save_all
from lotcast.ml.registry import Registry
from lotcast.ml.score import score
from lotcast.operators.clean import clean, split_rejects
from lotcast.operators.reports import sold_reports, split_report
from lotcast.session import drop_scratch, scratch_path
from lotcast.sinks.jdbc import jdbc_transaction_writer, replace_table
from lotcast.sinks.writers import write_table
from lotcast.sources.readers import read_listings
from lotcast.streaming.compact import CompactedFolder
from lotcast.streaming.dedup import without_resent
from lotcast.streaming.ingest import LANDED_CSV, open_stream, stream_to_files
from lotcast.streaming.reports import ReportTable, stream_reports
from lotcast.streaming.scoring import (
    checkpoint_stream_id,
    score_stream,
    score_stream_each_batch,
    score_stream_released,
)

TABLE_PRICE_BOARD = S.TABLE_PRICE_BOARD
TABLE_SOLD_BOARD = S.TABLE_SOLD_BOARD
TABLE_TRAINING = S.TABLE_TRAINING
REPORT_TABLES = S.REPORT_TABLES
SCORE_TABLES = S.SCORE_TABLES
REJECTED_COL = "rejected"
# Not the name that Spark's readers keep for lines they could not parse.
REJECTED_TEXT_COL = "rejected_text"
REPORT_COLUMNS = {
    "activity": S.RANGE_COL,
    "weekday": S.WEEKDAY_COL,
    "seller": S.SELLER_COL,
    "ratio": S.RANGE_COL,
    "price": S.RANGE_COL,
}


@dataclass
class Sink:
    """Where outputs go: ``fmt`` parquet/csv/json/orc under ``root``, or
    ``fmt="jdbc"`` with ``options`` from :func:`lotcast.sinks.jdbc_options`
    (the table name is the output's name). With ``swap`` a JDBC table that is
    overwritten is switched in one step (:func:`lotcast.sinks.replace_table`)."""

    fmt: str = "parquet"
    root: str | None = None
    options: dict = field(default_factory=dict)
    swap: bool = False

    def target(self, name: str) -> str:
        if self.fmt == "jdbc":
            return name
        if not self.root:
            raise ValueError("a file sink needs a root folder")
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> str:
        target = self.target(name)
        if self.fmt == "jdbc" and self.swap and mode == "overwrite":
            replace_table(df, target, self.options)
        else:
            write_table(df, target, self.fmt, mode, self.options)
        return target


def _sold(label: str = "QuantitySold") -> Column:
    return F.col(label) == F.lit(1.0)


def report_dimensions() -> dict[str, Column]:
    """The five report keys of a listing row."""
    return {
        "activity": band("HitCount", *S.ACTIVITY_BANDS),
        "weekday": F.col("EndDay"),
        "seller": F.col("SellerName"),
        "ratio": band("SellerSaleAvgPriceRatio", *S.RATIO_BANDS),
        "price": band("Price", *S.PRICE_BANDS),
    }


def listing_reports(spark: SparkSession, listings: DataFrame, sink: Sink) -> dict[str, str]:
    """All five sold reports from ONE scan of the listings.

    The grouped counts (one row per band, weekday and seller) are written
    once to the shared scratch folder; the five report tables are then cut
    from that small table instead of rescanning the listings five times.
    """
    counts_path = scratch_path(spark, "report_counts")
    sold_reports(listings, report_dimensions(), where=_sold()).write.mode("overwrite").parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    written = {}
    for name, table in REPORT_TABLES.items():
        top = S.TOP_SELLERS if name == "seller" else None
        written[name] = sink.write(split_report(counts, name, REPORT_COLUMNS[name], top=top), table)
    drop_scratch(spark, counts_path)
    return written


def run_batch(spark: SparkSession, training_path: str, test_path: str, sink: Sink,
              fmt: str = "csv", schema: StructType = S.LISTING_BATCH, header: bool = True,
              model_root: str | None = None, reject_nan: bool = False,
              malformed_table: str | None = None, fit_partitions: int | None = None,
              keep_scratch: bool = False, registry: Registry | None = None) -> dict:
    """Clean -> train -> evaluate -> report, as the reference's batch job.

    The cleaned tables are written once to the shared scratch folder and
    read back: that cuts the lineage (a lost executor recomputes from the
    cleaned Parquet, not from the raw CSV and the shuffle of ``distinct``)
    and gives every later step a columnar input, so each report reads 2
    columns instead of 28.

    With ``malformed_table``, input lines with a value that does not parse
    are also written, raw text included, to that output (``<name>_train``
    and ``<name>_test``); the rows themselves go on as before, with NULL in
    the bad field. Rows that a family of models cannot use (a NULL or NaN
    feature or label) are written with the reason to ``<family>_rejects_train``
    and ``_test``, and ``<family>_evaluated_rows`` says how many test rows each
    leaderboard line rests on. The run's scratch folder goes when the run is
    done, unless ``keep_scratch``. With a ``registry`` the six models become
    its next release (``model_root`` is not used), so scorers that are loading
    models meanwhile see the earlier release or the new one whole.
    """
    run_root = scratch_path(spark, "listing-run")
    cleaned, tables = {}, {}
    for name, path in (("train", training_path), ("test", test_path)):
        corrupt = CORRUPT_COL if malformed_table else None
        raw = read_listings(spark, path, schema, fmt=fmt, header=header, corrupt_col=corrupt)
        if corrupt:
            tables[f"malformed_{name}"] = sink.write(
                raw.where(F.col(corrupt).isNotNull()), f"{malformed_table}_{name}")
            raw = raw.drop(corrupt)
        out = f"{run_root}/clean_{name}"
        clean(raw, reject_nan=reject_nan).write.mode("overwrite").parquet(out)
        cleaned[name] = spark.read.parquet(out)
    train, test = cleaned["train"], cleaned["test"]
    models, boards = {}, {}
    for family, features, label, kind in (("price", S.PRICE_FEATURES, "Price", REGRESSION),
                                          ("sold", S.SOLD_FEATURES, "QuantitySold", CLASSIFICATION)):
        fitted, board = train_and_evaluate(train, test, features, label, kind, prefix=family,
                                           fit_partitions=fit_partitions)
        models.update(fitted)
        boards[family] = board
        tables[f"{family}_rows"] = sink.write(evaluated_rows(fitted, test, label), f"{family}_evaluated_rows")
        for name, rows in cleaned.items():
            _, rejected = split_rejects(rows, [*features, label])
            tables[f"{family}_rejects_{name}"] = sink.write(rejected, f"{family}_rejects_{name}")
    if registry is not None:
        paths = registry.publish(models).paths
    else:
        paths = save_all(models, model_root or scratch_path(spark, "models"))
    tables.update({
        "price_board": sink.write(boards["price"], TABLE_PRICE_BOARD),
        "sold_board": sink.write(boards["sold"], TABLE_SOLD_BOARD),
        "training": sink.write(train, TABLE_TRAINING),
    })
    tables.update(listing_reports(spark, train, sink))
    if not keep_scratch:
        drop_scratch(spark, run_root)
    return {"models": paths, "tables": tables}


def landed_columns() -> list[str]:
    return [f.name for f in S.LISTING_STREAM.fields]


def ingest_messages(messages: DataFrame, landed_root: str, checkpoint: str, value_col: str = "value",
                    fmt: str = "parquet", trigger: str | None = "availableNow",
                    keep: Sequence[str] = (), resend_ttl: str | None = None,
                    received_col: str = "timestamp", resend_key: Sequence[str] | None = None) -> StreamingQuery:
    """Land a stream of JSON listing messages (Kafka ``value`` or text).

    One checkpointed query with one file sink, partitioned by ``rejected``:
    well-formed messages as the 32 landed columns under ``rejected=false``,
    all others with their text under ``rejected=true``. The source is read
    once, every message lands in exactly one row, and the sink's metadata log
    lets readers of the folder see only committed files, so a replayed
    micro-batch never shows twice. ``keep`` carries source columns such as
    Kafka ``partition`` and ``offset``, which name a message that has no text.

    With ``resend_ttl`` a message that came before within that time (by
    ``received_col``) is not landed again; the same message is the same
    ``resend_key`` (its text by default).

    Land Parquet unless CSV is asked for: scoring then reads only the columns
    it needs, and files split. Old micro-batch files are made into larger ones
    by :func:`landed_folder` (``compact``); bound the sink's log with its
    ``retention`` option.
    """
    if resend_ttl is not None:
        messages = without_resent(messages, resend_key or [value_col], received_col, resend_ttl)
    decoded = decode_messages(messages, S.LISTING_MESSAGE, value_col=value_col, keep=keep, corrupt_col=CORRUPT_COL)
    rows = decoded.select(*landed_columns(), F.col(CORRUPT_COL).alias(REJECTED_TEXT_COL), *keep,
                          F.col(CORRUPT_COL).isNotNull().alias(REJECTED_COL))
    return stream_to_files(rows, landed_root, checkpoint, fmt=fmt, trigger=trigger, partition_by=[REJECTED_COL])


def landed_schema(keep: StructType | None = None) -> StructType:
    extra = list(keep.fields) if keep else []
    return StructType([*S.LISTING_LANDED.fields, StructField(REJECTED_TEXT_COL, StringType()), *extra,
                       StructField(REJECTED_COL, BooleanType())])


def landed_folder(spark: SparkSession, landed_root: str, compacted_root: str,
                  keep: StructType | None = None) -> CompactedFolder:
    """The landed (Parquet) folder with its compacted generations."""
    return CompactedFolder(spark, landed_root, compacted_root, landed_schema(keep), [REJECTED_COL])


def _landed(spark: SparkSession, landed_root: str, fmt: str, keep: StructType | None = None,
            compacted_root: str | None = None) -> DataFrame:
    if compacted_root is not None:
        return landed_folder(spark, landed_root, compacted_root, keep).read()
    options = LANDED_CSV if fmt == "csv" else {}
    return spark.read.schema(landed_schema(keep)).format(fmt).options(**options).load(landed_root)


def read_landed(spark: SparkSession, landed_root: str, fmt: str = "parquet",
                keep: StructType | None = None, compacted_root: str | None = None) -> DataFrame:
    """Landed listings, typed leniently (bad numbers become NULL). Reading
    the sink folder itself (no glob) goes through its metadata log, so only
    committed files are read. ``keep``: the kept source columns.
    ``compacted_root``: where the folder's generations are, if it is compacted."""
    raw = _landed(spark, landed_root, fmt, keep, compacted_root).where(~F.col(REJECTED_COL)).select(*landed_columns())
    return cast_lenient(raw, S.LISTING_STREAM)


def read_rejects(spark: SparkSession, landed_root: str, fmt: str = "parquet",
                 keep: StructType | None = None, compacted_root: str | None = None) -> DataFrame:
    """The rejected messages' texts and kept source columns."""
    return (_landed(spark, landed_root, fmt, keep, compacted_root).where(F.col(REJECTED_COL))
            .select(REJECTED_TEXT_COL, *(keep.names if keep else [])))


def listing_reports_stream(spark: SparkSession, listings: DataFrame, root: str, checkpoint: str,
                           trigger: str | None = "availableNow") -> StreamingQuery:
    """Keep the five sold reports of a stream of typed listings in a
    :class:`ReportTable` under ``root``: after every micro-batch its counts are
    those of all cleaned listings so far. Repeats are for the ingest to remove
    (``resend_ttl``)."""
    rows = clean(listings, dedup=False)
    return stream_reports(rows, report_dimensions(), ReportTable(spark, root), checkpoint, where=_sold(), trigger=trigger)


def score_landed(spark: SparkSession, landed_root: str, model_paths: Mapping[str, str], sink: Sink,
                 fmt: str = "parquet", reference_shape: bool = False, keep_scratch: bool = False) -> dict[str, str]:
    """Score every landed listing with all saved models in one scan.

    Default output: one table ``listing_scores`` with a prediction column
    per model. ``reference_shape=True`` additionally writes one table per
    model in which the prediction replaces the true label. The scores are
    computed once: with extra tables they are first written to the shared
    scratch folder and every output is cut from that copy (column reads of
    Parquet), whatever the sink.
    """
    models = load_all(dict(model_paths))
    scored = score(read_landed(spark, landed_root, fmt), models)
    if not reference_shape:
        return {"listing_scores": sink.write(scored, "listing_scores")}
    scored_path = scratch_path(spark, "listing_scores")
    scored.write.mode("overwrite").parquet(scored_path)
    base = spark.read.parquet(scored_path)
    written = {"listing_scores": sink.write(base, "listing_scores")}
    for name in models:
        label = "Price" if name.startswith("price") else "QuantitySold"
        others = [prediction_col(m) for m in models if m != name]
        table = base.drop(label, *others).withColumnRenamed(prediction_col(name), label)
        written[name] = sink.write(table, SCORE_TABLES.get(name, name))
    if not keep_scratch:
        drop_scratch(spark, scored_path)
    return written


def score_landed_stream(spark: SparkSession, landed_root: str, models: Mapping[str, PipelineModel] | None,
                        out: str, checkpoint: str, fmt: str = "parquet",
                        trigger: str | None = "availableNow",
                        jdbc: Sink | None = None,
                        max_files_per_trigger: int | None = None,
                        registry: Registry | None = None) -> StreamingQuery:
    """Incremental version: only newly landed files are scored, each once.

    By default the scores go to the exactly-once file sink at ``out``. With
    a JDBC ``Sink`` they are appended to the table named ``out`` through
    :func:`lotcast.sinks.jdbc_transaction_writer`: each micro-batch in one
    commit, once. ``max_files_per_trigger`` bounds each micro-batch, so a backlog is worked off in steps.

    With a ``registry``, ``models`` is not used: every micro-batch takes the
    newest release, and its scores appear in ``out`` (Parquet) whole, with the
    version as a column.
    """
    stream = open_stream(spark, landed_root, landed_schema(), fmt=fmt, options=LANDED_CSV if fmt == "csv" else None,
                         max_files_per_trigger=max_files_per_trigger)
    typed = cast_lenient(stream.where(~F.col(REJECTED_COL)).select(*landed_columns()), S.LISTING_STREAM)
    if registry is not None:
        if jdbc is not None:
            raise ValueError("registry= writes files; give no jdbc= with it")
        return score_stream_released(typed, registry, out, checkpoint, trigger=trigger)
    if jdbc is not None:
        if jdbc.fmt != "jdbc":
            raise ValueError("jdbc= takes a Sink with fmt='jdbc'")
        return score_stream_each_batch(typed, models, jdbc_transaction_writer(
            out, jdbc.options, checkpoint_stream_id(spark, checkpoint)), checkpoint, trigger=trigger)
    return score_stream(typed, models, out, checkpoint, trigger=trigger)
