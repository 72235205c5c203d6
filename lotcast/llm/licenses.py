"""Licence scans by canonical digest (DataFrame functions only).

A text is brought to a canonical form: ASCII letters lowered, copyright lines
dropped, punctuation and blanks made single spaces, equivalent spellings made
one. The SHA-256 digest of the whole canonical text, and of each whole
canonical line, is joined with the digests of the known texts (a few dozen
constants, or a table of full licence texts; lines of one of their lengths
are looked at).

Edge cases: a NULL text has a NULL digest and no licence; an empty canonical
text matches nothing; repeated rows each get their result; lines are the
parts between line feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcast.llm.common import materialize
from lotcast.llm.license_texts import KNOWN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of the canonical form, in order (RE2 syntax that Java shares).
RULES: list[tuple[str, str]] = [
    # copyright lines: the word with a year or a sign, or the sign alone
    (r"(^|\n)[^a-z0-9\n]*(copyright[^\n]*([0-9]{4}|\(c\)|©|<year>|\[yyyy\])|\(c\) |©)[^\n]*", r"\n"),
    (r"(^|\n)[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*", r"\n"),
    (r"&", " and "),
    # punctuation and blanks, ASCII and typographic
    (r"[\x00-\x09\x0B-/:-@\[-`{-\x7F\x{A0}\x{2010}-\x{201F}\x{2026}\x{3000}]+", " "),
    (r" *\n+ *", r"\n"),
    # equivalent spellings
    (r"licenc", "licens"),
    (r"([a-z])is(e|ed|es|ing|ation|ations)([^a-z0-9]|$)", r"\1iz\2\3"),
    (r"([a-z][a-z])our(s?)([^a-z0-9]|$)", r"\1or\2\3"),
    (r"copyright([ \n])owner", r"copyright\1holder"),
    (r"https ", "http "),
    (r"(^|[ \n])v(ersion)? ?([0-9])", r"\1version \3"),
]


def _java(replacement: str) -> str:
    out = replacement.replace(r"\n", "\n")
    for k in range(1, 4):
        out = out.replace(f"\\{k}", f"${k}")
    return out


def canonical(text: Column) -> Column:
    """The canonical form, one line a line."""
    out = F.translate(text, UPPER, LOWER)
    for pattern, replacement in RULES:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(_java(replacement)))
    return out


def whole(canonical_text: Column) -> Column:
    """The canonical text as one line."""
    return F.trim(F.regexp_replace(canonical_text, "[ \n]+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """``digest``, ``license``, ``length`` of the known texts, a list or a
    table with ``license`` and ``text``."""
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    form = whole(canonical(F.col("text")))
    return texts.select(F.sha2(form, 256).alias("digest"), "license", F.length(form).alias("length")).distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """One row per document: ``doc_id``, ``digest`` of the canonical text,
    ``license`` (if the text as a whole is known), ``n_notices`` (its lines
    that are a known text in whole) and ``licenses`` (sorted names of all of
    these, joined by commas; NULL if none)."""
    table = known_digests(docs.sparkSession, known)
    lengths = sorted(r["length"] for r in table.select("length").distinct().collect())  # constants
    form = F.col("form")
    lines = F.transform(F.split(form, "\n"), lambda x: F.trim(x))
    slim = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), canonical(F.col("text")).alias("form"))
        .select("doc_id", "text_md5", F.sha2(whole(form), 256).alias("digest"),
                F.transform(F.filter(lines, lambda x: F.length(x).isin(lengths)), lambda x: F.sha2(x, 256)).alias("lines")),
        "license-digests")
    hits = (slim.select("text_md5", F.posexplode("lines").alias("nr", "digest")).join(table, "digest")
            .dropDuplicates(["text_md5", "nr"])
            .groupBy("text_md5").agg(F.count(F.lit(1)).alias("n_notices"), F.collect_set("license").alias("names")))
    out = (slim.select("doc_id", "text_md5", "digest").join(table.select("digest", "license"), "digest", "left")
           .join(hits, "text_md5", "left"))
    names = F.array_sort(F.array_distinct(F.array_compact(F.concat(
        F.coalesce("names", F.array().cast("array<string>")), F.array("license")))))
    return out.select("doc_id", "digest", "license", F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
                      F.when(F.size(names) > 0, F.array_join(names, ",")).alias("licenses"))
