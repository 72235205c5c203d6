"""One query per operator over its whole table, with production parameters.

The operators keep their general interfaces; the queries only name the
columns and derive digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcast.llm import (ann, contamination, html, lexical, licenses, minhash, mixing, negatives, pieces, quality, quotes,
                         repeats, reshard)
from lotcast.llm.common import table
from lotcast.llm.sql import (CONTAMINATION_SQL, MIXING_SQL, NEAR_DUPLICATES_SQL, NEGATIVES_SQL, QUOTES_SQL, SEARCH_SQL,
                             license_sql)

#: The old layout that op4 reshards: documents sharded by source.
OLD_SHARDS = 16
NEW_SHARDS = 24


#: The public vocabulary that op9 encodes with.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.col("good")).alias("kept"), "posterior")


def op4_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    old = F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")) % OLD_SHARDS
    placed = reshard.reshard(docs, old, NEW_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                         F.col("old_shard").cast("int").alias("old_shard"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(PIECE_MODEL)
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    decoded = pieces.decode(encoded, model)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op11_wumanber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


#: Tags whose names tell what a container is, and any attributes of others.
_TELLING = r"(?i)<(/?)(?:article|main|nav|header|footer|aside|form|div)\b[^>]*>"


def host_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with every telling container made a plain ``div``: what is
    boilerplate then shows only by what the pages of a host repeat."""
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages.withColumn("html", F.regexp_replace("html", _TELLING, "<$1div>")))


def repeat_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal repeat of 400 bytes or more in the documents, with all
    its occurrences: ``group_id`` (hex), ``length``, ``doc_id`` and ``starts``
    (byte offsets, ascending), a row for each document that holds it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Documents of equal text share their repeats: each text is read once.
    rows = docs.select("doc_id", repeats.row_key(F.lit(""), F.col("text")).alias("rkey"),
                       F.lit(0).cast("long").alias("scope"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("units"))
    groups = repeats.grouped_repeats(rows.select("rkey", "scope", "units"), repeats.MIN_BYTES)
    named = rows.select("rkey", "doc_id").distinct()
    return groups.join(named, "rkey").select(
        F.lower(F.hex("group_id")).alias("group_id"), F.col("length").cast("long").alias("length"), "doc_id",
        F.col("starts").cast("array<bigint>").alias("starts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_licenses": op2_licenses,
    "op3_quality": op3_quality,
    "op4_reshard": op4_reshard,
    "op5_minhash": op5_minhash,
    "op6_mixing": op6_mixing,
    "op7_quotes": op7_quotes,
    "op8_html": op8_html,
    "op9_pieces": op9_pieces,
    "op10_repeats": op10_repeats,
    "op11_wumanber": op11_wumanber,
    "op12_search": op12_search,
    "op13_negatives": op13_negatives,
    "host_boilerplate": host_boilerplate,
    "repeat_passages": repeat_passages,
}

ORACLE: dict[str, str] = {
    "op2_licenses": license_sql(),
    "op5_minhash": NEAR_DUPLICATES_SQL,
    "op6_mixing": MIXING_SQL,
    "op7_quotes": QUOTES_SQL,
    "op11_wumanber": CONTAMINATION_SQL,
    "op12_search": SEARCH_SQL,
    "op13_negatives": NEGATIVES_SQL,
}
