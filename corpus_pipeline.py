"""From raw documents to token ids: quality rules, near-duplicate removal,
repeated passages out, sources mixed to target weights, texts encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps
(the last one their ids); what it returns is written as Parquet and read again
as the next stage's documents.

Every stage takes NULLs in any column, texts of any length, repeated rows,
tables without rows and columns of any other name; each says below what comes
of them. Own columns pass through, except that the last stage returns ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcast.llm import minhash, mixing, pieces, quality, repeats
from lotcast.llm.common import materialize, table
from lotcast.llm.queries import PIECE_MODEL


#: A repeated passage of fifty words is to go even where words are short, so
#: the stage looks for shorter strings than op10 (400 bytes).
REPEAT_BYTES = 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Probably good documents; the rest goes. A NULL text is judged as an
    empty one (no words: what the rules make of that). Repeated rows are judged
    alike and all stay or all go. No rows give none."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles,
    similarity 0.8 or more): the one with the smallest id. NULL and empty texts
    are like no other text and stay, as do documents with a NULL id. Of rows
    equal in id and text one stays; rows of one id with different texts are
    judged each."""
    return minhash.keep_one(docs, shingle_words=5, percent=80)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of ``REPEAT_BYTES`` or more that occur elsewhere,
    in the same text too. Every document stays, with what is left of its text
    and the new ``n_chars``; a NULL text becomes an empty one. Repeated rows are
    copies of each other, so their passages go from all of them."""
    removed = repeats.remove_repeats(docs, min_bytes=REPEAT_BYTES)
    return removed.withColumns({"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}) \
        .select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times. A
    NULL source is a source of its own, the last. Texts without words (NULL and
    empty ones too) have no size, so the mix never takes them. Repeated rows are
    queued each. Equal places in the queue are ordered by id and size, so reruns
    agree."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document in the mix: ``doc_id``, ``source``,
    ``n_tokens``, ``ids``. A NULL text has NULL ids and a NULL count, an empty
    one no ids; repeated rows are encoded each."""
    encoded = pieces.encode(docs.select("doc_id", "source", "text"), pieces.read_model(PIECE_MODEL))
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("repeat_dedup", repeat_dedup),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: Expectation-maximisation, MinHash and Viterbi have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
