"""Long repeats: common-prefix interval trees over enhanced suffix arrays.

A sequence (bytes of a text, or hashed tokens) is cut at content-defined
anchors: of the grams in every window of ``min_len`` units the one with the
least hash is an anchor. Equal windows choose the same anchor at the same
offset, so every repeat of ``min_len`` units shows as equal anchor grams, and
only the suffixes that start at anchors need sorting: about two in
``min_len`` positions. Suffixes are bucketed by their anchor gram (a prefix
they must share); a bucket's distinct contexts form an enhanced suffix array
(sorted suffixes and their common prefix lengths), a stack scan lists its
common-prefix intervals, and inside each interval a second scan over the
reversed left contexts tests left-extension diversity. Every pair of an
interval and a left cluster that together reach ``min_len`` units and differ
on both sides is a maximal repeat, reported with all its occurrences.

Contexts that occur more than once as a whole (exact copies) are counted by
hash before any text moves and enter a bucket once. Buckets with more than
``BUCKET_CONTEXTS`` distinct contexts are not brought together: there every
window of ``min_len`` units is counted by digest, which finds exactly the
intervals of depth ``min_len``.

``repeat_groups`` lists whole maximal repeats: the starts of repeated windows
whose occurrences differ on the left are the roots, and their suffixes are
compared by ever longer pieces to where they differ. Where roots may be, the
buckets tell: the left ends of the maximal repeats around an anchor, and the
first windows of contexts that occur again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotcast.llm.common import materialize, slices, stored
from lotcast.session import drop_scratch

#: Distinct contexts that one bucket may bring together (a context is under
#: two windows long: some 50 MB of texts at 400 bytes).
BUCKET_CONTEXTS = 65536
#: Bytes and units a piece that ``repeat_groups`` compares at a time.
BUCKET_BYTES = 64 << 20
MAX_STEP = 1 << 16
#: Windows handled at a time; longer sequences are cut with overlap.
CHUNK = 1 << 20
_INDEX_BITS = 24
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_length(min_len: int) -> int:
    """The largest power of two up to half the window, 32 at most."""
    return 1 << min(5, max(0, (min_len // 2).bit_length() - 1))


def gram_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) units from each position."""
    with np.errstate(over="ignore"):
        h = (units + np.uint64(1)) * _MULTIPLIER
        step, factor = 1, np.uint64(0xD6E8FEB86659FD93)
        while step < size:
            h = h[: len(h) - step] * factor + h[step:]
            factor *= factor
            step *= 2
        h = h ^ (h >> np.uint64(32))
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def select_anchors(units: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``hash, position, first, last`` of each run of windows (by start)
    that share an anchor. Every window belongs to exactly one run."""
    size = gram_length(min_len)
    parts = []
    for start in range(0, len(units) - min_len + 1, CHUNK):
        piece = units[start: start + CHUNK + min_len - 1]
        grams = gram_hashes(piece, size)
        key = (grams >> np.uint64(_INDEX_BITS) << np.uint64(_INDEX_BITS)) | np.arange(len(grams), dtype=np.uint64)
        width, have = min_len - size + 1, 1
        while have < width:  # least key of ever wider ranges
            step = min(have, width - have)
            key = np.minimum(key[: len(key) - step], key[step:])
            have += step
        at = (key & np.uint64((1 << _INDEX_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:] - 1, len(at) - 1]
        at = at[first]
        parts.append((grams[at], at + start, first + start, last + start))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _units(raw: bytes, unit: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if unit == 1 else ">u8").astype(np.uint64)


def _prefix_lengths(texts: list[bytes], unit: int) -> np.ndarray:
    """Common prefix, in units, of each text with the one before (0 for the
    first)."""
    out = np.zeros(len(texts), np.int64)
    for i in range(1, len(texts)):
        a, b = texts[i - 1], texts[i]
        lo, hi = 0, min(len(a), len(b)) // unit
        if a[: hi * unit] == b[: hi * unit]:
            lo = hi
        while lo < hi - 1:
            mid = (lo + hi) // 2
            if a[: mid * unit] == b[: mid * unit]:
                lo = mid
            else:
                hi = mid
        out[i] = lo
    return out


def intervals(lcp: np.ndarray, least: int = 1) -> Iterator[tuple[int, int, int]]:
    """Stack scan of a common-prefix array: ``(depth, first, last)`` of every
    interval of two rows or more with depth ``least`` or more, inner ones
    first."""
    stack: list[tuple[int, int]] = []  # depth, first row
    n = len(lcp)
    for i in range(1, n + 1):
        depth, first = (int(lcp[i]) if i < n else -1), i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            if d >= least:
                yield d, first, i - 1
        if i < n and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class _RangeMin:
    """Least value between two rows (exclusive, inclusive], by a sparse table."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            top = self.rows[-1]
            self.rows.append(np.minimum(top[: len(top) - step], top[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][a[at] + 1], self.rows[k][b[at] + 1 - (1 << k)])
        return out


def maximal_repeats(contexts: list[bytes], offsets: list[int], min_len: int, unit: int = 1,
                    spread: Callable[[np.ndarray], bool] = lambda members: True) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(left, right, members)`` of every maximal repeat around the anchor
    of a bucket: ``left`` units before it and ``right`` from it on are equal
    in all members (rows of ``contexts``), and no unit more on either side
    as far as the contexts reach.
    ``spread`` may reject a member set."""
    rights = [c[o * unit:] for c, o in zip(contexts, offsets)]
    lefts = [np.frombuffer(c[: o * unit], f"V{unit}")[::-1].tobytes() for c, o in zip(contexts, offsets)]
    if len(contexts) == 2:
        r = int(_prefix_lengths(rights, unit)[1])
        left = int(_prefix_lengths(lefts, unit)[1])
        if r and left + r >= min_len and spread(np.array([0, 1])):
            yield left, r, np.array([0, 1])
        return
    suffixes = sorted(range(len(contexts)), key=rights.__getitem__)
    by_left = sorted(range(len(contexts)), key=lefts.__getitem__)
    lcp = _prefix_lengths([rights[i] for i in suffixes], unit)
    left_min = _RangeMin(_prefix_lengths([lefts[i] for i in by_left], unit))
    right_min = _RangeMin(lcp)
    left_rank = np.empty(len(contexts), np.int64)
    left_rank[by_left] = np.arange(len(contexts))
    left_rank, by_left = left_rank[suffixes], np.array(by_left)
    rank = np.empty(len(contexts), np.int64)
    rank[suffixes] = np.arange(len(contexts))
    for depth, first, last in intervals(lcp):
        ranks = np.sort(left_rank[first: last + 1])
        common = np.r_[0, left_min(ranks[:-1], ranks[1:])]
        if depth + common.max() < min_len:
            continue
        needed = min_len - depth
        if needed <= 0:  # all members agree on the right alone
            members = by_left[ranks]
            if int(common[1:].min()) == 0 and spread(members):
                yield 0, depth, members
            needed = 1
        for left, a, b in intervals(common, needed):
            members = by_left[ranks[a: b + 1]]
            at = rank[members]
            if right_min(np.array([at.min()]), np.array([at.max()]))[0] == depth and spread(members):
                yield left, depth, members


def _shared_anchors(rows: DataFrame, min_len: int, unit: int, across_rows: bool) -> tuple[DataFrame, str]:
    """The anchors whose gram occurs again (``across_rows``: in another row),
    and their folder. Most grams occur once: they are told by a count of the
    grams alone, so contexts, row keys and starts of the rest move once more
    and no further."""
    spark = rows.sparkSession
    anchors, path = stored(_anchors(rows, min_len, unit), "repeat-anchors")
    if across_rows:
        again = anchors.groupBy("h").agg(F.min("rkey").alias("lo"), F.max("rkey").alias("hi")).filter("lo != hi")
    else:
        again = anchors.groupBy("h").agg(F.sum(F.size("starts")).alias("total")).filter("total > 1")
    grams, grams_path = stored(again.select("h"), "repeat-grams")
    # Sorted on both sides at any size: a gram that very many rows hold can be split.
    shared = stored(anchors.join(grams.hint("merge"), "h", "left_semi").select(anchors.columns), "repeat-shared")
    for folder in (path, grams_path):
        drop_scratch(spark, folder)
    return shared


def _buckets(rows: DataFrame, min_len: int, unit: int,
             across_rows: bool) -> tuple[DataFrame, DataFrame, DataFrame | None, list[str]]:
    """The anchors of the buckets that hold a repeat, their contexts, the text
    around those that share a bucket (None if none do), and the folders of
    these tables."""
    anchors, path = _shared_anchors(rows, min_len, unit, across_rows)
    contexts = anchors.groupBy("h", "g").agg(
        F.sum(F.size("starts")).alias("m"), F.min(F.struct("rkey", "a", "b", "p")).alias("one"),
        F.max("rkey").alias("last_row"))
    sizes = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    contexts, contexts_path = stored(contexts.join(sizes, "h").select(
        "h", "g", "n", "m", "one.rkey", "one.a", "one.b", "one.p", "last_row"), "repeat-contexts")
    folders = [path, contexts_path]
    if not contexts.filter("n > 1").take(1):
        return anchors, contexts, None, folders
    wanted = (contexts.filter("n > 1").groupBy("rkey")
              .agg(F.collect_list(F.struct("h", "g", "n", "m", "a", "b", "p", "last_row")).alias("cuts")))
    texts, texts_path = stored(_cut(rows.join(wanted, "rkey").select("rkey", "units", "cuts"), min_len, unit), "repeat-texts")
    return anchors, contexts, texts, [*folders, texts_path]


def find_repeats(rows: DataFrame, min_len: int, unit: int = 1, across_rows: bool = False) -> DataFrame:
    """Repeated parts of every row.

    ``rows``: ``rkey`` (binary, names a row), ``scope`` (long; repeats are
    looked for within a scope) and ``units`` (binary, ``unit`` bytes a unit).
    Gives ``rkey`` and ``spans`` for rows with any: structs of ``starts`` and
    the stretch ``lo`` to ``hi`` from each of them, in units (``stretches``
    lists them). With ``across_rows`` a repeat must occur in
    two different rows.
    """
    anchors, contexts, texts, folders = _buckets(rows, min_len, unit, across_rows)
    again = F.col("rkey") != F.col("last_row") if across_rows else F.col("m") > 1
    # A context that occurs again is repeated in whole; of the others the scan
    # tells which part.
    found = contexts.filter(again).select("h", "g", F.lit(0).alias("lo"), (F.col("b") - F.col("a") + min_len).alias("hi"))
    if texts is not None:
        few = texts.filter(F.col("n") <= BUCKET_CONTEXTS)
        many = texts.filter(F.col("n") > BUCKET_CONTEXTS)
        found = found.unionByName(_scan(few, min_len, unit, across_rows))
        if contexts.filter(F.col("n") > BUCKET_CONTEXTS).take(1):
            found = found.unionByName(_count_windows(many, min_len, unit, across_rows))
    spans = materialize(anchors.select("h", "g", "rkey", "starts").join(found, ["h", "g"])
                        .groupBy("rkey").agg(F.collect_list(F.struct("starts", "lo", "hi")).alias("spans")), "repeat-spans")
    for folder in folders:
        drop_scratch(rows.sparkSession, folder)
    return spans


def stretches(spans: list[dict] | None) -> list[tuple[int, int]]:
    """The repeated stretches (start, end) of one row of ``find_repeats``."""
    return [(a + s["lo"], a + s["hi"]) for s in spans or [] for a in s["starts"]]


def repeat_groups(rows: DataFrame, min_len: int, unit: int = 1) -> DataFrame:
    """Maximal repeats of ``min_len`` units or more with all occurrences:
    ``group_id`` (digest of the repeat), ``length``, ``rkey``, ``start``."""
    return grouped_repeats(rows, min_len, unit).select("group_id", "length", "rkey", F.explode("starts").alias("start"))


def grouped_repeats(rows: DataFrame, min_len: int, unit: int = 1) -> DataFrame:
    """``repeat_groups`` with a row for each repeat and sequence: ``starts``,
    ascending.

    A maximal repeat starts with a window of ``min_len`` units whose
    occurrences don't all follow the same unit, and all its occurrences start
    with that window. From there, level by level, a group's members (a row for
    each sequence, with its starts) are read ``step`` units on: their distinct
    pieces form a small suffix array whose intervals end repeats, and members
    with equal whole pieces go on as a group with twice the step. Groups of more
    than ``BUCKET_CONTEXTS`` distinct pieces (or ``BUCKET_BYTES``) halve their
    step instead, down to one unit, where counting is enough. Starts are listed
    in full, so a text of one repeated unit gives a number of them in the square
    of its length.
    """
    texts = materialize(rows.groupBy("rkey").agg(F.first("scope").alias("scope"), F.first("units").alias("units"),
                                                 F.count(F.lit(1)).alias("copies")), "repeat-sequences")
    # Of rows equal in all two are enough to show that their windows occur again.
    shown = F.explode(F.when(F.col("copies") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    places = _root_places(texts.select("rkey", "scope", "units", shown).drop("_copy"), min_len, unit)
    windows, old = stored(_windows(texts.join(places, "rkey"), min_len, unit), "repeat-windows")
    members = F.sum(F.col("copies") * F.size("starts")).alias("m")
    prevs = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("first").alias("first")]
    differ = F.col("first") | (F.col("lo") != F.col("hi"))
    roots = windows.groupBy("gid").agg(members, *prevs).filter((F.col("m") > 1) & differ).select("gid")
    state, path = stored(windows.join(roots, "gid").select("gid", "rkey", "starts", "copies", F.lit(min_len).alias("depth"),
                                                           F.lit(min_len).alias("step")), "repeat-state")
    drop_scratch(rows.sparkSession, old)
    # Each level reads the sequences that still have members: they are written
    # again whenever they are half as many, so all levels together read little more
    # than the first.
    near, near_path, held = texts, None, math.inf
    found = None
    while count := state.agg(F.count_distinct("rkey")).first()[0]:
        if 2 * count <= held:
            before = near_path
            near, near_path = stored(near.join(state.select("rkey").distinct(), "rkey", "left_semi").select("rkey", "units"),
                                     "repeat-near")
            held = count
            if before:
                drop_scratch(rows.sparkSession, before)
        level, level_path = stored(_pieces(state, near, unit), "repeat-level")
        pieces, pieces_path = stored(level.groupBy("gid", "x").agg(
            members, *prevs, F.first("piece").alias("piece"), F.first("step").alias("step")), "repeat-pieces")
        size = F.octet_length("piece")
        groups, groups_path = stored(pieces.groupBy("gid").agg(
            ((F.count(F.lit(1)) > BUCKET_CONTEXTS) | (F.count(F.lit(1)) > 1) & (F.sum(size) > BUCKET_BYTES)).alias("many")),
            "repeat-sizes")
        pieces = pieces.join(groups, "gid").withColumn("whole", size == F.col("step") * unit)
        counted = F.col("many") & (F.col("step") == 1)  # pieces of one unit share nothing: the group ends here
        few = pieces.filter("not many").select(
            F.col("gid").alias("h"), F.col("x").alias("g"), "m", (F.col("first").cast("int") + 2 * F.col("whole").cast("int"))
            .alias("off"), F.col("piece").alias("ctx"), F.col("lo").alias("row"), F.col("hi").alias("last_row"))
        ends = _by_bucket(few, lambda table: _ends(table, unit), "gid binary, x binary, more int, node binary").unionByName(
            pieces.filter(counted).select("gid", "x", F.lit(0).alias("more"), F.unhex(F.md5("gid")).alias("node")))
        part = materialize(level.join(ends, ["gid", "x"]).select(
            "node", "rkey", "starts", (F.col("depth") + F.col("more")).alias("length")), "repeat-found")
        found = part if found is None else found.unionByName(part)
        on = pieces.filter((~F.col("many") | counted) & F.col("whole") & (F.col("m") > 1) & differ).select("gid", "x")
        longer = F.least(2 * F.col("step"), F.lit(MAX_STEP))
        onward = level.join(on, ["gid", "x"]).select(
            F.unhex(F.md5(F.concat("gid", "x"))).alias("gid"), "rkey", "starts", "copies",
            (F.col("depth") + F.col("step")).alias("depth"), longer.alias("step"))
        again = state.filter("step > 1").join(groups.filter("many").select("gid"), "gid").select(
            "gid", "rkey", "starts", "copies", "depth", (F.col("step") / 2).cast("int").alias("step"))
        old = [path, level_path, pieces_path, groups_path]
        state, path = stored(onward.unionByName(again), "repeat-state")
        for folder in old:
            drop_scratch(rows.sparkSession, folder)
    if near_path:
        drop_scratch(rows.sparkSession, near_path)
    if found is None:
        found = state.select(F.col("gid").alias("node"), "rkey", "starts", F.col("depth").alias("length"))
    # A sequence goes along once, whatever the number of repeats it names.
    ones = found.groupBy("node").agg(F.min(F.struct("rkey", F.col("starts")[0].alias("start"), "length")).alias("one")) \
        .groupBy("one.rkey").agg(F.collect_list(F.struct("node", "one.start", "one.length")).alias("ones"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "units"):
            node, ids = [], []
            for scope, units, ones in zip(*[batch.column(c) for c in ("scope", "units", "ones")]):
                units, seed = units.as_py(), scope.as_py() & 0xFFFFFFFFFFFFFFFF
                for one in ones.as_py():
                    node.append(one["node"])
                    ids.append(xxhash.xxh3_128_digest(memoryview(units)[one["start"] * unit: (one["start"] + one["length"]) * unit],
                                                      seed=seed))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(ids, pa.binary())], ["node", "group_id"])

    names = ones.join(texts, "rkey").select("scope", "units", "ones").mapInArrow(name, "node binary, group_id binary")
    return found.join(names, "node").groupBy("group_id", "length", "rkey").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))


def _root_places(rows: DataFrame, min_len: int, unit: int) -> DataFrame:
    """``rkey`` and ``places`` (structs of ``starts`` and an offset ``s`` from
    each) of the windows that may be roots of ``repeat_groups``, each with all
    its occurrences. Occurrences of a window share its anchor, so they are in
    one bucket. Where they differ on the left, either two contexts differ there
    (or one begins: had the units before been equal, so had the windows that
    start there and their anchors), which makes a maximal repeat of the bucket,
    or copies of one context do, at its first window."""
    anchors, contexts, texts, folders = _buckets(rows, min_len, unit, False)
    found = contexts.filter("m > 1").select("h", "g", F.lit(0).alias("s"))

    def work(table: dict) -> Iterator[tuple]:
        at: list[set[int]] = [set() for _ in table["g"]]
        for left, _, members in maximal_repeats(table["ctx"], table["off"], min_len, unit):
            for i in members.tolist():
                at[i].add(table["off"][i] - left)
        for g, m, places in zip(table["g"], table["m"], at):
            for s in sorted(places):
                if s or m == 1:  # the first windows of other contexts are known already
                    yield table["h"][0], g, s

    if texts is not None:
        found = found.unionByName(_by_bucket(texts.filter(F.col("n") <= BUCKET_CONTEXTS), work, "h long, g binary, s int"))
        if contexts.filter(F.col("n") > BUCKET_CONTEXTS).take(1):
            windows = _bucket_windows(texts.filter(F.col("n") > BUCKET_CONTEXTS), min_len, unit)
            differ = F.max(F.col("s") == 0) | (F.min("prev") != F.max("prev"))
            roots = windows.groupBy("h", "w").agg(F.sum("m").alias("total"), differ.alias("differ")).filter("total > 1 and differ")
            found = found.unionByName(windows.filter("s > 0 or m = 1").join(roots.select("h", "w"), ["h", "w"]).select("h", "g", "s"))
    places = materialize(anchors.select("h", "g", "rkey", "starts").join(found, ["h", "g"])
                         .groupBy("rkey").agg(F.collect_list(F.struct("starts", "s")).alias("places")), "repeat-places")
    for folder in folders:
        drop_scratch(rows.sparkSession, folder)
    return places


def _windows(texts: DataFrame, min_len: int, unit: int) -> DataFrame:
    """The windows at the ``places`` of each sequence, by a digest of scope and
    window: a row for each with its starts and the units before them (least,
    greatest, and whether one starts the sequence)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "units"):
            for rkey, scope, raw, copies, places in zip(*[batch.column(c) for c in ("rkey", "scope", "units", "copies", "places")]):
                raw, seed = raw.as_py(), scope.as_py() & 0xFFFFFFFFFFFFFFFF
                held: dict[bytes, list[int]] = {}
                for i in sorted({a + x["s"] for x in places.as_py() for a in x["starts"]}):
                    held.setdefault(xxhash.xxh3_128_digest(raw[i * unit: (i + min_len) * unit], seed=seed), []).append(i)
                yield _rows([{"gid": gid, "rkey": rkey.as_py(), "starts": at, "copies": copies.as_py(), **_before(raw, at, unit)}
                             for gid, at in held.items()], _WINDOW)

    return texts.select("rkey", "scope", "units", "copies", "places").mapInArrow(run, _WINDOW)


_WINDOW = "gid binary, rkey binary, starts array<int>, copies long, lo binary, hi binary, first boolean"
_LEVEL = _WINDOW + ", depth int, step int, x binary, piece binary"


def _rows(rows: list[dict], schema: str) -> pa.RecordBatch:
    types = {"binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, types[t]) for n, t in map(str.split, schema.split(", "))]))


def _before(raw: bytes, starts: list[int], unit: int) -> dict:
    prev = {raw[(i - 1) * unit: i * unit] for i in starts if i}
    return {"lo": min(prev, default=None), "hi": max(prev, default=None), "first": 0 in starts}


def _pieces(state: DataFrame, texts: DataFrame, unit: int) -> DataFrame:
    """The members with the ``step`` units after their ``depth`` (fewer at the
    end of a sequence) and a digest of them: a row for each piece of a group in
    a sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "units"):
            for rkey, raw, members in zip(batch.column("rkey"), batch.column("units"), batch.column("members")):
                rkey, raw, out, size = rkey.as_py(), raw.as_py(), [], 0
                for member in members:
                    x = member.as_py()
                    held: dict[bytes, list[int]] = {}
                    ends: dict[bytes, int] = {}
                    for s in x["starts"]:
                        at = (s + x["depth"]) * unit
                        digest = xxhash.xxh3_128_digest(raw[at: at + x["step"] * unit])
                        held.setdefault(digest, []).append(s)
                        ends[digest] = at
                    for digest, starts in held.items():
                        piece = raw[ends[digest]: ends[digest] + x["step"] * unit]
                        out.append({**x, "rkey": rkey, "starts": starts, **_before(raw, starts, unit), "x": digest, "piece": piece})
                        size += len(piece) + 32 * len(starts) + 400
                        if size > 1 << 22:
                            yield _rows(out, _LEVEL)
                            out, size = [], 0
                if out:
                    yield _rows(out, _LEVEL)

    grouped = state.groupBy("rkey").agg(F.collect_list(F.struct("gid", "starts", "copies", "depth", "step")).alias("members"))
    return texts.join(grouped, "rkey").select("rkey", "units", "members").mapInArrow(run, _LEVEL)


def _ends(table: dict, unit: int) -> Iterator[tuple]:
    """Where repeats of one group end inside its pieces: ``gid``, ``x``, units
    of the piece that belong to the repeat, and a name of the repeat."""
    h, ctx = table["h"][0], table["ctx"]
    order = sorted(range(len(ctx)), key=ctx.__getitem__)
    lcp = _prefix_lengths([ctx[i] for i in order], unit)

    def node(members: list[int], size: int) -> Iterator[tuple]:
        if any(table["off"][i] & 1 for i in members) \
                or min(table["row"][i] for i in members) != max(table["last_row"][i] for i in members):
            name = xxhash.xxh3_128_digest(h + ctx[members[0]][: size * unit])
            for i in members:
                yield h, table["g"][i], size, name

    for depth, first, last in intervals(lcp, 0):
        yield from node(order[first: last + 1], depth)
    for k, i in enumerate(order):  # equal pieces that end their sequences
        size = len(ctx[i]) // unit
        if table["m"][i] > 1 and not table["off"][i] & 2 and (k + 1 == len(order) or lcp[k + 1] < size):
            yield from node([i], size)


def _anchors(rows: DataFrame, min_len: int, unit: int) -> DataFrame:
    """One row for each context of a row, with all its starts (a line that a
    text repeats a thousand times is one context)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "units"):
            keys, grams, out, starts = [], [], [], []
            digests: list[bytes] = []
            for rkey, scope, raw in zip(batch.column("rkey"), batch.column("scope"), batch.column("units")):
                raw = raw.as_py() or b""
                if len(raw) < min_len * unit:
                    continue
                h, p, a, b = select_anchors(_units(raw, unit), min_len)
                with np.errstate(over="ignore"):
                    h = h ^ (np.uint64(scope.as_py() & 0xFFFFFFFFFFFFFFFF) * _MULTIPLIER)
                found: dict[tuple[int, bytes], list[int]] = {}
                for i, (gram, at, first, last) in enumerate(zip(h.view(np.int64).tolist(), p.tolist(), a.tolist(), b.tolist())):
                    context = xxhash.xxh3_128_digest(raw[first * unit: (last + min_len) * unit], seed=at - first)
                    found.setdefault((gram, context), []).append(i)
                keys += [rkey.as_py()] * len(found)
                grams += [k[0] for k in found]
                digests += [k[1] for k in found]
                one = np.fromiter((v[0] for v in found.values()), np.int64, len(found))
                out.append((a[one], b[one], p[one]))
                starts += [a[v] for v in found.values()]
            if not out:
                continue
            a, b, p = (np.concatenate(x).astype(np.int32) for x in zip(*out))
            ends = np.cumsum([0, *map(len, starts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(grams, pa.int64()), pa.array(digests, pa.binary()), pa.array(a),
                 pa.array(b), pa.array(p),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(starts).astype(np.int32)))],
                ["rkey", "h", "g", "a", "b", "p", "starts"])

    return rows.select("rkey", "scope", "units").mapInArrow(
        run, "rkey binary, h long, g binary, a int, b int, p int, starts array<int>")


_TEXTS = "h long, g binary, n long, m long, off int, ctx binary, row binary, last_row binary"


def _cut(rows: DataFrame, min_len: int, unit: int) -> DataFrame:
    """The text around each wanted anchor, one row per distinct context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "units"):
            for rkey, raw, cuts in zip(batch.column("rkey"), batch.column("units"), batch.column("cuts")):
                rkey, raw, cuts = rkey.as_py(), raw.as_py(), cuts.as_py()
                for s in range(0, len(cuts), 4096):
                    part = cuts[s: s + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([c["h"] for c in part], pa.int64()), pa.array([c["g"] for c in part], pa.binary()),
                        pa.array([c["n"] for c in part], pa.int64()), pa.array([c["m"] for c in part], pa.int64()),
                        pa.array([c["p"] - c["a"] for c in part], pa.int32()),
                        pa.array([raw[c["a"] * unit: (c["b"] + min_len) * unit] for c in part], pa.binary()),
                        pa.array([rkey] * len(part), pa.binary()), pa.array([c["last_row"] for c in part], pa.binary()),
                    ], ["h", "g", "n", "m", "off", "ctx", "row", "last_row"])

    return rows.mapInArrow(run, _TEXTS)


def _by_bucket(texts: DataFrame, work: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """Apply ``work`` to each bucket. Buckets are many and mostly of two
    contexts, so they stream through a sorted partition instead of being
    grouped one call each; one bucket at a time is in memory."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = pa.schema([(f.name, {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
                        [f.dataType.simpleString()]) for f in T.StructType.fromDDL(schema).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        out: list[tuple] = []

        def flush():
            if held and len(held["h"]):
                out.extend(work(held))

        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("h", "g", "m", "off", "ctx", "row", "last_row")}
            h, start = columns["h"], 0
            for i in range(len(h)):
                if i + 1 < len(h) and h[i + 1] == h[i]:
                    continue
                if held and held["h"][0] != h[i]:
                    flush()
                    held = {}
                part = {n: c[start: i + 1] for n, c in columns.items()}
                held = {n: held[n] + part[n] for n in part} if held else part
                start = i + 1
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], types)
                out = []
        flush()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], types)

    return texts.repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def _spread(table: dict, across_rows: bool) -> Callable[[np.ndarray], bool]:
    if not across_rows:
        return lambda members: True
    row, last = table["row"], table["last_row"]
    return lambda members: min(row[i] for i in members) != max(last[i] for i in members)


def _scan(texts: DataFrame, min_len: int, unit: int, across_rows: bool) -> DataFrame:
    """The part of each context that maximal repeats cover: all of them hold
    the anchor, so their union is one stretch."""
    def work(table: dict) -> Iterator[tuple]:
        left, right = [-1] * len(table["g"]), [0] * len(table["g"])
        for a, b, members in maximal_repeats(table["ctx"], table["off"], min_len, unit, _spread(table, across_rows)):
            for i in members.tolist():
                left[i], right[i] = max(left[i], a), max(right[i], b)
        for i, off in enumerate(table["off"]):
            whole = table["row"][i] != table["last_row"][i] if across_rows else table["m"][i] > 1
            if left[i] >= 0 and not whole:  # whole ones are known already
                yield table["h"][i], table["g"][i], off - left[i], off + right[i]

    return _by_bucket(texts, work, "h long, g binary, lo int, hi int")


def _bucket_windows(texts: DataFrame, min_len: int, unit: int) -> DataFrame:
    """Every window of the contexts of a bucket with a digest ``w`` and the
    unit before it (NULL for a context's first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, g, m, row, last, ctx in zip(*[batch.column(c).to_pylist()
                                                 for c in ("h", "g", "m", "row", "last_row", "ctx")]):
                n = len(ctx) // unit - min_len + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([h] * n, pa.int64()), pa.array([g] * n, pa.binary()), pa.array(range(n), pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(ctx[i * unit: (i + min_len) * unit]) for i in range(n)], pa.binary()),
                    pa.array([ctx[(i - 1) * unit: i * unit] if i else None for i in range(n)], pa.binary()),
                    pa.array([m] * n, pa.int64()), pa.array([row] * n, pa.binary()), pa.array([last] * n, pa.binary()),
                ], ["h", "g", "s", "w", "prev", "m", "row", "last_row"])

    return texts.select("h", "g", "m", "row", "last_row", "ctx").mapInArrow(
        run, "h long, g binary, s int, w binary, prev binary, m long, row binary, last_row binary")


def _count_windows(texts: DataFrame, min_len: int, unit: int, across_rows: bool) -> DataFrame:
    """Buckets of very many contexts: count every window by digest."""
    windows = _bucket_windows(texts, min_len, unit)
    counted = windows.groupBy("h", "w").agg(F.sum("m").alias("total"), F.min("row").alias("lo"), F.max("last_row").alias("hi"))
    repeated = counted.filter(F.col("lo") != F.col("hi") if across_rows else F.col("total") > 1).select("h", "w")
    # All windows of a context hold its anchor: their union is one stretch.
    single = F.col("row") == F.col("last_row") if across_rows else F.col("m") == 1
    return windows.filter(single).select("h", "g", "s", "w").join(repeated, ["h", "w"]).groupBy("h", "g").agg(
        F.min("s").alias("lo"), (F.max("s") + min_len).alias("hi"))


# Text dedup -----------------------------------------------------------------

MIN_BYTES = 400


def row_key(id_col: Column, text_col: Column) -> Column:
    """Names a row by id and text; rows equal in both share it (and every
    result)."""
    return F.unhex(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("?")), F.lit("\u0000"),
                                  F.coalesce(text_col, F.lit(""))).cast("binary")))


def cut_spans(raw: bytes, spans: list[tuple[int, int]]) -> tuple[list[bytes], int]:
    """The kept pieces and the number of maximal removed runs."""
    pieces, at, runs, end = [], 0, 0, -1
    for start, stop in sorted(spans):
        if start > end:
            runs += 1
            pieces.append(raw[at:start])
            end = stop
        else:
            end = max(end, stop)
        at = end
    pieces.append(raw[at:])
    return pieces, runs


REMOVED = {"kept_text": "string", "n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """The rows of ``docs`` with their own columns and ``kept_text``,
    ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` (of the
    remaining bytes); own columns of these names are replaced.

    Texts are compared as UTF-8 bytes; every byte inside a string of
    ``min_bytes`` that starts anywhere else too is removed, first occurrences
    included, judged on the input. ``kept_text`` drops the remains of
    characters that a cut went through. NULL text counts as empty; an empty
    table gives an empty result; repeated rows are copies of each other.
    """
    key = row_key(F.col(id_col), F.col(text_col).cast("string"))
    spans = find_repeats(docs.select(key.alias("rkey"), F.lit(0).cast("long").alias("scope"),
                                     F.col(text_col).cast("string").cast("binary").alias("units")), min_bytes)
    whole = docs.select(key.alias("rkey"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = whole.join(spans.hint("merge"), "rkey", "left").select("row", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for batch in slices(batches, "row", text_col):
            out = []
            for text, spans in zip(batch.column("row").field(text_col), batch.column("spans")):
                text = text.as_py()
                raw = ("" if text is None else str(text)).encode()
                pieces, runs = cut_spans(raw, stretches(spans.as_py()))
                kept = sum(map(len, pieces))
                out.append(("".join(p.decode("utf-8", "ignore") for p in pieces), len(raw), len(raw) - kept, runs,
                            hashlib.sha256(b"".join(pieces)).hexdigest()))
            texts, *numbers, digests = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), *[pa.array(x, pa.int64()) for x in numbers],
                 pa.array(digests, pa.string())], ["row", *REMOVED])

    schema = T.StructType([joined.schema["row"], *[T.StructField(n, T.StringType() if t == "string" else T.LongType())
                                                   for n, t in REMOVED.items()]])
    own = [c for c in docs.columns if c not in REMOVED]
    return joined.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in own], *REMOVED)
