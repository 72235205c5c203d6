"""Mixing sources to target weights by weighted fair queueing (DataFrame
functions only).

Every source is a queue of its documents in a fixed shuffled order, repeated
up to ``max_repeats`` times. A document copy's virtual finish time is its
source's running tokens, this copy included, divided by the source's target.
Sorting all copies by that time interleaves the sources in proportion to
their targets; the mix is the prefix whose copies start within the budget.

Edge cases: a NULL text has size 0; a document of size 0 is taken 0 times in
words (its copies are not emitted); a NULL source is a source of its own,
last in order; a NULL id is placed by the digest of the empty string; repeated
rows are separate documents. An empty table gives an empty result. With all
sizes 0 every target is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotcast.llm.common import materialize, shuffled_key, word_count
from lotcast.llm.prefix import hex_levels, running_sums

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Ranges of virtual time for the global order: 2**(2 * TIME_BITS) finest.
TIME_BITS = 9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight``, ``target``,
    ``longest`` (its longest document) and ``full`` (the target is its cap).

    Sources take the weights in turn, by code point, NULL last. The targets
    share the sum of all sizes by weight, none above ``max_repeats`` times
    its source's size; the excess goes to the others by weight. That is the
    water level L with sum(min(L * weight, cap)) = total: sources are full in
    order of cap / weight, so one prefix sum over the (few, pre-aggregated)
    sources finds it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("longest"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    chosen = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", "longest", place.alias("place"), chosen.cast("double").alias("weight"),
                     (F.col("source_size") * max_repeats).cast("double").alias("cap"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    # Past the first source that is not full the level only falls.
    water = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    return per.select("source", "source_size", "weight", "longest", "full",
                      F.when(F.col("full"), F.col("cap"))
                      .otherwise(water * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``,
    ``source_size``, ``target``, ``copies`` (how often the mix takes it),
    ``taken`` (``copies * size``), ``first_finish`` (virtual finish time of
    its first copy) and ``text_crc32``, which with id and source identifies
    the row's text."""
    slim = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
        shuffled_key(F.col(id_col)).alias("place")), "mix-sizes")
    targets = materialize(source_targets(slim, weights, max_repeats), "mix-targets")
    keyed = (slim.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
             .join(targets.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("source_key"),
                                  "source_size", "target"), "source_key"))
    order = [F.col("place"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    queued = materialize(running_sums(keyed, ["source_key"], hex_levels("place"), order,
                                      {"before": F.col("size")}), "mix-queues")
    epochs = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("epoch")
    finish = ((F.col("epoch") * F.col("source_size") + F.col("before") + F.col("size")).cast("double") / F.col("target"))
    # By virtual time 1 every full source has given all its copies, and by the
    # horizon every other one its target at least (a document may be the
    # longest): the budget is spent, and no later copy can be in the mix.
    late = targets.agg(F.max(F.when(~F.col("full"), F.col("longest") / F.col("target")))).first()[0]
    horizon = (1.0 + (late or 0.0)) * (1 + 1e-9)
    copies = (queued.filter((F.col("size") > 0) & (F.col("target") > 0)).select("*", epochs)
              .withColumn("finish", finish).filter(F.col("finish") <= horizon))
    tick = F.floor(F.col("finish") / horizon * ((1 << (2 * TIME_BITS)) - 1)).cast("long")
    levels = [F.shiftright(tick, TIME_BITS), tick]
    by_time = [F.col("finish"), F.col("source_key"), F.col("epoch"), *order]
    placed = running_sums(copies, [], levels, by_time, {"mixed_before": F.col("size")})
    budget = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"))
    taken = (placed.crossJoin(F.broadcast(budget))  # one row: the total
             .filter(F.col("mixed_before") < F.col("budget"))
             .groupBy("source_key", "place", "doc_id", "size", "text_crc32", "before")
             .agg(F.count(F.lit(1)).alias("copies"), F.min("finish").alias("first_finish")))
    same = ["source_key", "place", "before", "size"]
    return (queued.alias("q").join(taken.select(*same, "copies", "first_finish", "doc_id", "text_crc32").alias("t"),
                                   [F.col(f"q.{c}") == F.col(f"t.{c}") for c in same]
                                   + [F.col("q.doc_id").eqNullSafe(F.col("t.doc_id")),
                                      F.col("q.text_crc32").eqNullSafe(F.col("t.text_crc32"))], "left")
            .select("q.doc_id", "q.source", "q.size", "q.source_size", "q.target",
                    F.coalesce("t.copies", F.lit(0)).alias("copies"),
                    (F.coalesce("t.copies", F.lit(0)) * F.col("q.size")).alias("taken"),
                    "t.first_finish", "q.text_crc32"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: rows of ``docs``, own columns only, each as often as
    the mix takes it."""
    taken = mix(docs, id_col, text_col, source_col, weights, max_repeats)
    key = ["id", "crc", "origin"]
    # Rows of one id, text and source are numbered on both sides, in an order
    # that a repeated task finds again; a group is the copies of one row.
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row")))
    mark = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), mark(F.col(id_col)).alias("id"),
                       mark(F.crc32(F.col(text_col).cast("binary"))).alias("crc"),
                       mark(F.col(source_col)).alias("origin")).withColumn("nth", nth)
    copies = taken.select(mark(F.col("doc_id")).alias("id"), mark(F.col("text_crc32")).alias("crc"),
                          mark(F.col("source")).alias("origin"), F.col("copies").cast("int").alias("copies")) \
        .withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("copies"))))
    joined = rows.join(copies.filter("copies > 0"), [*key, "nth"])
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
