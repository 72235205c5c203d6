"""Chat formatting by quotation linking (DataFrame functions only).

Lines are read into quote levels (the number of ">" before the text).
Consecutive lines of one level are a passage. Quoted passages are normalised
(blanks single, ASCII letters lowered) and hashed, and the hashes are joined
with those of what messages of the same conversation say themselves, as whole
passages or single lines. The first message that says it is the original. A
message replies to the latest original among its shallowest linked quotes;
messages linked like that, directly or through others, form a thread. The
conversation is put in reply order: threads by their first message, messages
of a thread by turn (a reply always has a later turn than what it quotes), and
quotes are taken out of the texts.

Edge cases: NULL and empty texts have no lines that count and an empty clean
text; a NULL conversation is one of its own; a NULL turn comes last and never
is an original; a quote without original leaves the message in a thread of
its own; messages with equal conversation, turn, role and text are one
message; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotcast.llm.common import materialize
from lotcast.llm.licenses import LOWER, UPPER
from lotcast.llm.prefix import running_sums

#: All up to the last mark of a run of marks and blanks. Without a repeated
#: group, which Java would match by recursion, a line may hold any number.
MARKS = r"^[ \t>]*>"
LAST_TURN = (1 << 63) - 1
#: Turns to a range when messages are numbered.
RANGE = 256


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), r"[ \t\r]+", " "))


def _lines(text: Column) -> Column:
    """Array of (level, body) of each line."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(x, MARKS, "").alias("body")))


def _clean(lines: Column) -> Column:
    own = F.filter(lines, lambda x: x["level"] == 0)
    return F.btrim(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), F.lit(" \t\r\n"))


def _passages(lines: DataFrame) -> DataFrame:
    """``message``, ``conv``, ``turn``, ``level``, ``island``, ``digest``,
    ``kind``: 0 for whole passages, 1 for their single lines. ``lines`` has
    one row per line with its number ``nr``."""
    same_level = Window.partitionBy("message", "level").orderBy("nr")
    lines = lines.withColumn("island", F.col("nr") - F.row_number().over(same_level)) \
        .withColumn("normal", _normal(F.col("body"))).filter("normal <> ''")
    whole = lines.groupBy("message", "conv", "turn", "level", "island").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nr", "normal"))), lambda x: x["normal"]), " ")
        .alias("normal"))
    both = whole.withColumn("kind", F.lit(0)).unionByName(
        lines.select("message", "conv", "turn", "level", "island", "normal").withColumn("kind", F.lit(1)))
    return both.select("message", "conv", "turn", "level", "island", "kind", F.sha2("normal", 256).alias("digest"))


def _threads(links: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``root``: follow ``reply_to`` to the first message,
    doubling the step each round."""
    now = materialize(links.select("conv", "turn", F.col("reply_to").alias("root")), "threads")
    while True:
        step = now.select("conv", F.col("turn").alias("root"), F.col("root").alias("further"))
        on = materialize(now.join(step, ["conv", "root"], "left")
                         .select("conv", "turn", F.coalesce("further", "root").alias("root"),
                                 F.col("further").isNotNull().alias("moved")), "threads")
        if not on.filter("moved").take(1):
            return on.select("conv", "turn", "root")
        now = on.select("conv", "turn", "root")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per message: ``conv_id``, ``turn``, ``role``, ``text`` (without
    quotes), ``position`` (gapless from 0 in reply order), ``thread`` (turn of
    its first message), ``reply_to`` (turn of the original, if any),
    ``n_quotes`` and ``n_linked`` (quoted passages; those with an
    original)."""
    said = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    said = said.withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")))
    mark = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("conv", "turn", "role", "text")]
    said = said.withColumn("message", F.md5(F.concat_ws("\u0000", *mark).cast("binary"))).dropDuplicates(["message"])
    said = materialize(said.withColumn("lines", _lines(F.col("text")))
                       .withColumn("n_quoted_lines", F.size(F.filter("lines", lambda x: x["level"] > 0)))
                       .withColumn("clean", _clean(F.col("lines"))), "messages")
    quoting = said.filter("n_quoted_lines > 0").select("conv").distinct()
    lines = (said.join(quoting, "conv", "left_semi")
             .select("message", "conv", "turn", F.posexplode("lines").alias("nr", "line"))
             .select("message", "conv", "turn", "nr", "line.level", "line.body"))
    originals = (_passages(lines.filter("level = 0 and turn is not null")).groupBy("conv", "digest")
                 .agg(F.min("turn").alias("original")))
    quotes = materialize(_passages(lines.filter("level > 0")), "quotes")
    found = (quotes.join(originals, ["conv", "digest"])
             .filter(F.col("original") < F.coalesce("turn", F.lit(LAST_TURN))))
    counted = quotes.filter("kind = 0").groupBy("message").agg(F.count(F.lit(1)).alias("n_quotes"))
    linked = found.groupBy("message", "conv", "turn").agg(
        F.countDistinct("level", "island").alias("n_linked"),
        (-F.min(F.struct("level", "kind", (-F.col("original")).alias("o")))["o"]).alias("reply_to"))
    linked = materialize(linked, "quote-links")
    roots = _threads(linked.groupBy("conv", "turn").agg(F.min("reply_to").alias("reply_to")).filter("turn is not null"))
    rows = (said.drop("lines", "n_quoted_lines", "text").join(counted, "message", "left")
            .join(linked.select("message", "n_linked", "reply_to"), "message", "left")
            .join(roots, ["conv", "turn"], "left"))
    place = F.coalesce("turn", F.lit(LAST_TURN))
    thread = F.when(F.col("reply_to").isNotNull(), F.coalesce("root", "reply_to")).otherwise(F.col("turn"))
    rows = rows.withColumn("thread", thread).withColumn("thread_place", F.coalesce("thread", F.lit(LAST_TURN))) \
        .withColumn("place", place)
    levels = [F.floor(F.col("thread_place") / F.lit(RANGE)), F.col("thread_place"), F.floor(F.col("place") / F.lit(RANGE))]
    order = [F.col("thread_place"), F.col("place"), F.col("role"), F.col("message")]
    rows = running_sums(rows, ["conv"], levels, order, {"position": F.lit(1)})
    return rows.select("conv_id", "turn", "role", F.col("clean").alias("text"), "position", "thread", "reply_to",
                       F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
                       F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
