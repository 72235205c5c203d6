"""Ranked lexical search in reverse: the items wait, the documents stream.

The items' terms make an inverted index (term to items, with repeats), which
is sent to the tasks. One pass over the texts counts each document's terms
that the index holds, and those counts are written; collection statistics
are added up from them. A second pass streams the counts through the index and
keeps, for each item, a bounded heap of its best documents in every task; the
heaps are merged by salted and then by whole top-k.

A document's term that occurs ``tf`` times adds
``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` for each occurrence of
the term in the item, with ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and
``m = 100 - 25 + ((25 * n * N) div L)``; all but ``w`` is 64-bit integer.

The index of one group of items (``terms.ITEM_BYTES`` of texts) is held at a
time; a larger set of items is answered group by group, which is exact because
items don't depend on each other.

Edge cases: a NULL or empty text has no terms, counts in no statistic and is
never returned. A repeated document is a document each time; ids break ties,
a NULL id last. Repeated items are one; items of one id and different texts
are answered each. Items without terms, and empty tables, give no rows. Texts
of any length are counted whole. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from lotcast.llm.best import Best
from lotcast.llm.common import materialize
from lotcast.llm.terms import ITEM_BYTES, item_groups, terms, utf8

#: Cells of the (document, item) scores held at a time in a task, and
#: entries of the index that its documents reach.
CELLS = 1 << 21
#: Parts of an item's heaps that are merged first.
SALTS = 64
#: 1000 * tf / (1000 * tf + 12 * m) is under 1, so a term adds less than this
#: for each unit of weight.
_MOST = 1_000_000


@dataclass(frozen=True)
class Index:
    """Items of term ``t``: ``items[starts[t]: starts[t + 1]]``, each with
    the term's number of occurrences in it."""

    number: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    n_items: int


def build(texts: list[bytes | None]) -> Index:
    number: dict[bytes, int] = {}
    found: list[list[tuple[int, int]]] = []
    for item, text in enumerate(texts):
        for term, times in Counter(terms(text)).items():
            if term not in number:
                number[term] = len(found)
                found.append([])
            found[number[term]].append((item, times))
    flat = np.array([x for of in found for x in of], np.int64).reshape(-1, 2)
    return Index(number, np.cumsum([0, *map(len, found)]), flat[:, 0], flat[:, 1], len(texts))


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def _counts(docs: DataFrame, index) -> DataFrame:
    """``doc_id``, ``n`` (terms), and the index's terms in the document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.number.get
        for batch in batches:
            n, which, tfs = [], [], []
            for raw in batch.column("raw"):
                words = terms(raw.as_py())
                held = Counter(map(number, words))
                held.pop(None, None)
                n.append(len(words))
                which.append(list(held))
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(which, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _statistics(counts: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of every term, added up in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 2, np.int64)
        for batch in batches:
            n = batch.column("n").to_numpy()
            total[:2] += (n > 0).sum(), n.sum()
            total[2:] += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "number"])

    rows = counts.select("n", "terms").mapInArrow(run, "at long, number long").groupBy("at") \
        .agg(F.sum("number").alias("number")).collect()  # a row for each term of the index at most
    total = np.zeros(n_terms + 2, np.int64)
    for r in rows:
        total[r["at"]] = r["number"]
    return int(total[0]), int(total[1]), total[2:]


def _scores(index: Index, w: np.ndarray, m: np.ndarray, sizes: np.ndarray, which: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Scores of a block of documents for every item. ``which`` and ``tf``
    are the documents' terms one after the other, ``sizes`` how many each."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    value = w[which] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
    some = np.flatnonzero(value)
    doc, which, value = doc[some], which[some], value[some]
    many = index.starts[which + 1] - index.starts[which]
    at = np.repeat(index.starts[which] - np.cumsum(many) + many, many) + np.arange(many.sum())
    cell = np.repeat(doc, many) * index.n_items + index.items[at]
    value = np.repeat(value, many) * index.times[at]
    cells = len(sizes) * index.n_items
    if int(w.max(initial=0)) * _MOST * int(index.times.sum()) < 1 << 53:  # sums of doubles are exact
        total = np.bincount(cell, value, cells)
    else:
        total = np.zeros(cells, np.int64)
        np.add.at(total, cell, value)
    return total.reshape(len(sizes), index.n_items)


def _cuts(reached: np.ndarray, most_docs: int) -> Iterator[tuple[int, int]]:
    """Stretches of documents that reach ``CELLS`` entries of the index at
    most (one document may reach the whole index, no more)."""
    total = np.cumsum(np.r_[0, reached])
    start = 0
    while start < len(reached):
        end = int(np.searchsorted(total, total[start] + CELLS, "right")) - 1
        end = min(max(end, start + 1), start + most_docs, len(reached))
        yield start, end
        start = end


def _best(counts: DataFrame, index, w: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best ``k`` documents of every item in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        heaps = Best(held.n_items, k, np.ones(held.n_items), ties=2, score_type=float)
        step = max(1, CELLS // held.n_items)
        for batch in batches:
            column = batch.column("terms")
            which = column.flatten().to_numpy()
            ends = np.cumsum(np.r_[0, held.starts[which + 1] - held.starts[which]])
            reached = np.diff(ends[column.offsets.to_numpy() - column.offsets[0].as_py()])
            for few in (batch.slice(s, e - s) for s, e in _cuts(reached, step)):
                ids = few.column("doc_id")
                sizes = np.diff(few.column("terms").offsets.to_numpy())
                m = 100 - 25 + 25 * few.column("n").to_numpy() * n_docs // n_terms
                scores = _scores(held, w, m, sizes, few.column("terms").flatten().to_numpy().astype(np.int64),
                                 few.column("tfs").flatten().to_numpy())
                doc, item = np.nonzero(scores >= heaps.least)
                no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                heaps.add(item, scores[doc, item], no_id[doc], ids.fill_null(0).to_numpy()[doc])
        item, score, no_id, ids = heaps.cut()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, pa.int64(), mask=no_id > 0),
                                          pa.array(score.astype(np.int64))], ["item", "doc_id", "score"])

    return counts.filter(F.size("terms") > 0).mapInArrow(run, "item long, doc_id long, score long")


def _ranked(docs: DataFrame, group: list[Row], id_type: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    index = build([r["text"] for r in group])
    if not index.number:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    shared = spark.sparkContext.broadcast(index)
    counts = materialize(_counts(docs, shared), "lexical-counts")
    n_docs, n_terms, df = _statistics(counts, len(index.number))
    best = _best(counts, shared, weights(df, n_docs), n_docs, max(1, n_terms), k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", "salt").orderBy(*order)
    best = best.withColumn("salt", F.spark_partition_id() % SALTS).withColumn("rank", F.row_number().over(some)) \
        .filter(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    named = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(group)], f"item long, item_id {id_type}")
    return best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", limit: int = ITEM_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` of each item's
    ``k`` documents with the highest scores above 0."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("raw"))
    id_type = items.select(item_col).schema[0].dataType.simpleString()
    groups = item_groups(items, item_col, item_text, limit)
    if len(groups) == 1:
        return _ranked(slim, groups[0].collect(), id_type, k)
    return reduce(DataFrame.unionByName, [materialize(_ranked(slim, g.collect(), id_type, k), "lexical-ranked") for g in groups])
