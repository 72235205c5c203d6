"""Near-duplicates by b-bit MinHash.

Each document's set of word shingles gives ``HASHES`` minima. Bands of
``ROWS_A_BAND`` minima generate candidates. Of every minimum only the low
``BITS`` bits are kept, packed into longs: the share of equal fields (an xor,
a fold and a bit count) is the similarity plus chance collisions, which the
estimate takes out. Pairs that may reach the threshold by that estimate (six
standard deviations) are confirmed on the full sets.

Documents with equal sets are one unit from the start. In a bucket every unit
is paired with the bucket's smallest unit only. What a star can miss is a
link between two units of one bucket whose components still differ. In those
buckets the members outside the largest component are compared with the full
sets of all others, block by block through an inverted index, and only links
come out, one for each component met. No bucket emits all its pairs.

At similarity 0.8, a pair shares no band with probability 5e-8.

Edge cases: without words or with NULL text a document has an empty set and
is its own component. A NULL id takes no part: component NULL, kept. Rows
with one id and different texts are judged each by its text; repeated rows
share a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcast.llm.common import materialize
from lotcast.llm.components import components

HASHES = 128
ROWS_A_BAND = 4
BITS = 4
#: Units of one bucket whose sets meet in one task.
BLOCK = 1024
_FIELDS = 64 // BITS
_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of the whole text, A-Z lowered. A
    text with fewer words is one shingle; without words the set is empty."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    grams = np.full(n, min(size, len(words)), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, len(words))):
            grams = _mix(grams * _ODD + h[k: k + n])
    return np.unique(grams)


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for s in range(0, len(shingles), 1024):
            np.minimum(out, (shingles[s: s + 1024, None] * _A + _B).min(0), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """One key a band; the band's number is mixed in."""
    m = m.reshape(-1, ROWS_A_BAND)
    key = np.arange(len(m), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS_A_BAND):
            key = _mix(key * _ODD + m[:, k])
    return key.view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    """The low bits of all minima, ``64 / BITS`` to a long."""
    fields = (_mix(m) & np.uint64((1 << BITS) - 1)).reshape(-1, _FIELDS)
    shifts = np.arange(_FIELDS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(fields << shifts, axis=1).view(np.int64)


#: The lowest bit of every field.
_LOWEST = sum(1 << (BITS * k) for k in range(_FIELDS))
_LOWEST_LONG = _LOWEST - (1 << 64) if _LOWEST >> 63 else _LOWEST


def similarity(equal: Column) -> Column:
    """Collision-corrected estimate from the number of equal fields."""
    chance = 2.0 ** -BITS
    return (equal / HASHES - chance) / (1 - chance)


def _equal_fields(a: Column, b: Column) -> Column:
    def differing(x: Column) -> Column:
        for k in range(1, BITS):
            folded = F.shiftrightunsigned(x, k) if k == 1 else folded.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.bit_count(x.bitwiseOR(folded).bitwiseAND(F.lit(_LOWEST_LONG)))

    total = F.lit(HASHES)
    for k in range(HASHES // _FIELDS):
        total = total - differing(a[k].bitwiseXOR(b[k]))
    return total


def least_estimate(threshold: float) -> float:
    """Six standard deviations below the threshold."""
    chance = 2.0 ** -BITS
    equal = chance + (1 - chance) * threshold
    return threshold - 6 * math.sqrt(equal * (1 - equal) / HASHES) / (1 - chance)


def _measure(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, digest, bits, bands = [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), size)
                m = minima(s)
                count.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                bits.append(packed(m))
                bands.append(band_keys(m))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)), w)
                     .cast(pa.list_(pa.int64())) for x, w in ((bits, HASHES // _FIELDS), (bands, HASHES // ROWS_A_BAND))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_md5"), pa.array(count, pa.int64()),
                 pa.array(digest, pa.binary()), *lists], ["doc_id", "text_md5", "n_shingles", "digest", "bits", "bands"])

    return docs.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_md5")).mapInArrow(
        run, "doc_id long, text_md5 binary, n_shingles long, digest binary, bits array<long>, bands array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), size).tobytes() for t in batch.column("text")]
            same = [xxhash.xxh3_128_digest(s) == d.as_py() for s, d in zip(sets, batch.column("digest"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())],
                                             ["node", "shingles"]).filter(pa.array(same, pa.bool_()))

    return docs.mapInArrow(run, "node long, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that reach the threshold on their full sets."""
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _linked(stored: list[np.ndarray], probe: np.ndarray, percent: int, index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which stored sets reach the threshold with the probe, by counting
    common shingles in an inverted index (sorted shingles and their owners)."""
    values, owners = index
    lo, hi = np.searchsorted(values, probe, "left"), np.searchsorted(values, probe, "right")
    at = np.repeat(lo - np.cumsum(np.r_[0, (hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum())
    common = np.bincount(owners[at], minlength=len(stored))
    sizes = np.fromiter(map(len, stored), np.int64, len(stored))
    return 100 * common >= percent * (sizes + len(probe) - common)


def _within(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside a bucket between different components: every probe is
    compared with the full sets of every block, and one link a probe and
    component comes out. A cell is one block of stored sets with one block of
    probes; cells stream through sorted partitions, one at a time, so a task
    holds two blocks at most however large the bucket is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            node, label = whole["node"].to_numpy(), whole["label"].to_numpy()
            probes = np.flatnonzero(whole["probe"].to_numpy(zero_copy_only=False))
            kept = np.flatnonzero(whole["stored"].to_numpy(zero_copy_only=False))
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in whole["shingles"]]
            stored = [sets[i] for i in kept]
            values = np.concatenate(stored) if stored else np.zeros(0, np.uint64)
            owners = np.repeat(np.arange(len(stored)), [len(x) for x in stored])
            order = np.argsort(values, kind="stable")
            index = values[order], owners[order]
            found = set()
            for i in probes:
                hits = kept[_linked(stored, sets[i], percent, index)]
                hits = hits[label[hits] != label[i]]
                _, first = np.unique(label[hits], return_index=True)
                found.update((int(min(node[i], node[j])), int(max(node[i], node[j]))) for j in hits[first])
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            cell = np.column_stack([batch.column(c).to_numpy() for c in ("key", "block", "probe_block")])
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if start == end:
                    continue
                this = tuple(cell[start])
                if held and this != at:
                    yield flush()
                    held = []
                at = this
                held.append(batch.slice(start, end - start))
        if held:
            yield flush()

    cell = ["key", "block", "probe_block"]
    return (buckets.join(sets, "node").repartition(*cell).sortWithinPartitions(*cell)
            .select(*cell, "node", "label", "probe", "stored", "shingles")
            .mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``
    (smallest id reachable over links of similarity ``percent`` / 100 or
    more), ``kept`` (the id is the component's) and ``text_md5``, which with
    the id names the row."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    measured = materialize(_measure(slim, shingle_words), "minhash-signatures")
    # A unit's name must be its own even if one id has several texts: it is
    # numbered where its row is written, and the written number counts.
    units = materialize(
        measured.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).groupBy("digest")
        .agg(F.min("doc_id").alias("min_id"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"),
             F.first("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()), "minhash-units")
    # The centre of a bucket is its smallest doc_id: of copies that were made
    # from one text, that is most often the text.
    banded = units.select("node", "min_id", F.explode("bands").alias("key"))
    shared = (banded.groupBy("key").agg(F.min("min_id").alias("rep"), F.count(F.lit(1)).alias("members"))
              .filter("members > 1"))
    buckets = materialize(banded.join(shared, "key"), "minhash-buckets")
    of = units.select("node", "min_id", "n_shingles", "bits")
    least = least_estimate(percent / 100)
    stars = buckets.select("rep", F.col("node").alias("b")).distinct()
    stars = stars.join(of.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("sb")), "b") \
        .join(of.select(F.col("node").alias("a"), F.col("min_id").alias("rep"), F.col("n_shingles").alias("na"),
                        F.col("bits").alias("sa")), "rep") \
        .filter((F.col("a") != F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                & (similarity(_equal_fields(F.col("sa"), F.col("sb"))) >= least)).select("a", "b")
    stars = materialize(stars, "minhash-stars")
    wanted = (stars.select(F.explode(F.array("a", "b")).alias("node"))
              .union(buckets.filter("members > 2").select("node")).distinct()
              .join(units.select("node", F.col("min_id").alias("doc_id"), "digest"), "node"))
    sets = materialize(_sets(slim.join(wanted, "doc_id").select("node", "text", "digest"), shingle_words)
                       .dropDuplicates(["node"]), "minhash-sets")
    links = materialize(_confirm(stars, sets, percent), "minhash-links")
    labels = components(links)
    # Links inside a bucket that its star did not try.
    labelled = (buckets.filter("members > 2").join(labels, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    by_label = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    split = (by_label.groupBy("key").agg(F.max_by("label", "c").alias("largest"), F.max("c").alias("c"),
                                         F.count(F.lit(1)).alias("labels"))
             .filter("labels > 1").select("key", "largest", "c"))
    open_buckets = (labelled.join(split, "key").withColumns({
        "blocks": F.ceil(F.col("members") / BLOCK).cast("int"),
        "probe_blocks": F.ceil((F.col("members") - F.col("c")) / BLOCK).cast("int")})
        .select("key", "node", "label", "blocks", "probe_blocks", (F.col("label") != F.col("largest")).alias("probe")))
    own, asked = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("node"), F.col("probe_blocks")).cast("int")
    small = open_buckets.filter("blocks = 1").withColumns({"block": F.lit(0), "probe_block": F.lit(0), "stored": F.lit(True)})
    large = open_buckets.filter("blocks > 1")
    stored = large.withColumns({"block": own, "stored": F.lit(True), "probe": F.lit(False)}) \
        .withColumn("probe_block", F.explode(F.sequence(F.lit(0), F.col("probe_blocks") - 1)))
    probes = large.filter("probe").withColumns({"probe_block": asked, "stored": F.lit(False)}) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = small.unionByName(stored).unionByName(probes).drop("blocks", "probe_blocks")
    more = materialize(_within(cells, sets, percent), "minhash-more")
    if more.take(1):
        labels = components(links.unionByName(more))
    of_unit = units.select("digest", "node", "min_id").join(labels, "node", "left") \
        .select("digest", "min_id", F.coalesce("label", "node").alias("label"))
    smallest = of_unit.groupBy("label").agg(F.min("min_id").alias("component"))
    of_unit = of_unit.join(smallest, "label").select("digest", "component")
    return (measured.select("doc_id", "text_md5", "n_shingles", "digest").join(of_unit, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
                    .otherwise(F.col("doc_id")).alias("component_id"), "text_md5")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
             percent: int = 80) -> DataFrame:
    """The documents without near-duplicates of a smaller id, with their own
    columns only; of rows equal in id and text one stays."""
    found = materialize(near_duplicates(docs, id_col, text_col, shingle_words, percent), "near-duplicates")
    md5 = F.unhex(F.md5(F.col(f"row.`{text_col}`").cast("string").cast("binary")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumns({"id": F.col(f"row.`{id_col}`").cast("long"), "md5": md5})
    gone = found.filter("not kept").select(F.col("doc_id").alias("id"), F.col("text_md5").alias("md5")).distinct()
    rows = rows.join(gone, ["id", "md5"], "left_anti")
    again = found.filter("kept and doc_id is not null").groupBy("doc_id", "text_md5").count().filter("count > 1")
    if again.take(1):  # only then is a pass over all texts needed
        rows = rows.filter("id is null").unionByName(rows.filter("id is not null").dropDuplicates(["id", "md5"]))
    return rows.select("row.*")
