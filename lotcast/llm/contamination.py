"""Benchmark decontamination by Wu-Manber multi-pattern search.

The test strings are the windows of ``width`` consecutive terms of every
benchmark item (an item of fewer terms is one string). All strings of one
length share a table over blocks of two terms: how far the search may move on
when it meets that block, which is the least distance of the block from the
end of any string, and the furthest for a block that no string holds. Where
the distance is 0 the block is the end of some string: its bucket holds the
strings that end so, and the text's own terms are compared with them.

The tables of one group of items (``terms.ITEM_BYTES`` of texts) are sent to
the tasks. A larger benchmark is searched group by group, and the groups'
hits are brought together by the text's digest.

Edge cases: a NULL or empty text has no terms and is not contaminated.
Items without terms match nothing; repeated items are one; an item with a
NULL id marks terms but has no id to be listed by. Repeated documents are
judged each. Tables without rows give a result without hits or without rows.
Texts of any length are searched whole. Columns of ``docs`` and ``items``
other than the named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lotcast.llm.common import materialize
from lotcast.llm.terms import ITEM_BYTES, item_groups, terms, utf8

WIDTH = 10
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = "text_md5 binary, n_words long, items array<string>, spans array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Strings:
    """Test strings of one length: ``moves`` by block, ``far`` for all other
    blocks, and the strings by their last block with the items that hold
    them."""

    length: int
    far: int
    moves: dict[tuple[bytes, bytes], int]
    buckets: dict[tuple[bytes, bytes], dict[tuple[bytes, ...], frozenset]]


def windows(items: Iterable[tuple[str | None, bytes | None]], width: int) -> dict[tuple[bytes, ...], set]:
    """Each test string with the ids of its items."""
    out: dict[tuple[bytes, ...], set] = {}
    for item, text in items:
        words = terms(text)
        for start in range(max(1, len(words) - width + 1) if words else 0):
            out.setdefault(tuple(words[start: start + width]), set()).add(item)
    return out


def strings(found: dict[tuple[bytes, ...], set]) -> list[Strings]:
    """One table a length. A string of a single term has no block of two;
    its bucket is the term with itself."""
    out = []
    for length in sorted({len(w) for w in found}):
        moves: dict[tuple[bytes, bytes], int] = {}
        buckets: dict[tuple[bytes, bytes], dict[tuple[bytes, ...], frozenset]] = {}
        for string, items in found.items():
            if len(string) != length:
                continue
            for end in range(1, length):
                block = string[end - 1], string[end]
                moves[block] = min(moves.get(block, length), length - 1 - end)
            buckets.setdefault((string[-2 if length > 1 else -1], string[-1]), {})[string] = frozenset(items)
        out.append(Strings(length, max(1, length - 1), moves, buckets))
    return out


def occurrences(words: list[bytes], table: Strings) -> Iterator[tuple[int, frozenset]]:
    """Where a string of ``table`` starts in ``words``, with its items."""
    length, far, moves, buckets = table.length, table.far, table.moves, table.buckets
    if length == 1:
        for at, word in enumerate(words):
            if (word, word) in buckets:
                yield at, buckets[word, word][word,]
        return
    move, at, n = moves.get, length - 1, len(words)
    while at < n:
        block = words[at - 1], words[at]
        step = move(block, far)
        if step:
            at += step
            continue
        start = at - length + 1
        items = buckets[block].get(tuple(words[start: at + 1]))
        if items is not None:
            yield start, items
        at += 1


def _structs(runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": s, "end": e} for s, e in runs]


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def hits(words: list[bytes], tables: list[Strings]) -> tuple[list[str], list[tuple[int, int]]]:
    """Ids of the items that occur, sorted, and the hit runs of terms."""
    items: set = set()
    runs: list[tuple[int, int]] = []
    for table in tables:
        for start, of in occurrences(words, table):
            items |= of
            if runs and runs[-1][0] <= start <= runs[-1][1]:
                runs[-1] = runs[-1][0], max(runs[-1][1], start + table.length)
            else:
                runs.append((start, start + table.length))
    return sorted(i for i in items if i is not None), merged(runs)


def _search(docs: DataFrame, group: list[Row], width: int) -> DataFrame:
    """``docs`` (``doc_id``, ``raw``, ``text_md5``) searched for one group."""
    tables = docs.sparkSession.sparkContext.broadcast(strings(windows(((r["id"], r["text"]) for r in group), width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tables.value
        for batch in batches:
            count, items, runs = [], [], []
            for raw in batch.column("raw"):
                words = terms(raw.as_py())
                of, at = hits(words, held)
                count.append(len(words))
                items.append(of)
                runs.append(_structs(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_md5"), pa.array(count, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(runs, _SPANS)],
                ["doc_id", "text_md5", "n_words", "items", "spans"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {_FOUND}")


def _together(parts: list[DataFrame]) -> DataFrame:
    """Hits of several groups, by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_structs(merged((s["start"], s["end"]) for s in spans)) for spans in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("text_md5"), batch.column("items"), pa.array(runs, _SPANS)],
                                             ["text_md5", "items", "spans"])

    every = reduce(DataFrame.unionByName, [p.filter(F.size("spans") > 0).select("text_md5", "items", "spans") for p in parts])
    by_text = every.groupBy("text_md5").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                                            F.flatten(F.collect_set("spans")).alias("spans"))
    return by_text.mapInArrow(run, by_text.schema)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", width: int = WIDTH,
                  limit: int = ITEM_BYTES) -> DataFrame:
    """One row a document: ``doc_id``, ``text_md5``, ``n_words``, ``items``
    (ids of the items with an occurring string, as strings, sorted),
    ``spans`` (hit runs: ``start`` and ``end`` in terms), ``n_hit`` (terms in
    them) and ``contaminated``."""
    slim = docs.select(F.col(id_col).alias("doc_id"), utf8(F.col(text_col)).alias("raw"))
    slim = slim.withColumn("text_md5", F.unhex(F.md5(F.coalesce("raw", F.lit(b"")))))
    named = items.select(F.col(item_col).cast("string").alias("id"), F.col(item_text).alias("text"))
    groups = item_groups(named, "id", "text", limit)
    found = _search(slim, groups[0].collect(), width)
    if len(groups) > 1:
        found = materialize(found, "contamination-group")
        rest = [materialize(_search(slim, g.collect(), width).filter(F.size("spans") > 0), "contamination-group")
                for g in groups[1:]]
        found = found.select("doc_id", "text_md5", "n_words").join(_together([found, *rest]), "text_md5", "left") \
            .withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in found.dtypes if c in ("items", "spans")})
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "text_md5", "n_words", "items", "spans", n_hit.alias("n_hit"),
                        (F.size("spans") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """The documents in which no test string occurs, with their own columns.
    Only the digests of contaminated texts are joined back."""
    bad = contamination(docs, items, id_col, text_col, **options).filter("contaminated").select("text_md5").distinct()
    md5 = F.unhex(F.md5(F.coalesce(utf8(F.col(f"row.`{text_col}`")), F.lit(b""))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("text_md5", md5)
    return rows.join(bad, "text_md5", "left_anti").select("row.*")
