import hashlib
import random
import re

import pytest

from lotcast.llm import contamination as C
from lotcast.llm.terms import terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {u: u + 32 for u in range(ord("A"), ord("Z") + 1)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, width=10):
    """Every window of every item at every position."""
    strings = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            strings.setdefault(tuple(w[i:i + width]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(s) for s in strings}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in strings:
                    found |= strings[tuple(w[i:i + size])]
                    hit |= set(range(i, i + size))
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                    r["contaminated"]) for r in df.collect()), key=repr)


def _tables(seed, n_docs=60):
    """Few different words, so that windows, blocks and prefixes recur."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "ab", "É", "x9", "über", "中"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "\x7f", "`"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "?!"), (15, items[0][1]), (15, items[0][1]), (None, text(10)), (100, "A b"), (2, "ab AB ab")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(n_docs)]
    docs += [(n_docs + k, text(5) + (items[k][1] or "").upper() + text(4)) for k in range(12)]
    docs += [(900, None), (901, ""), (902, "..."), (None, items[3][1]), (903, docs[1][1]), (903, docs[1][1]), (904, "a " * 30_000),
             (905, "É" * 50_000)]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 24, 900])
def test_equals_brute_force(spark, limit):
    """Also group by group, with hits of one text in several groups."""
    docs, items = _tables(3 if limit > 900 else 4)
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, n_words int").repartition(3)
    i = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, doc_id string")
    got = C.contamination(d, i, limit=limit)
    assert found(got) == brute(docs, items)
    for r in got.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    kept = C.without_contaminated(d, i, limit=limit)
    assert kept.columns == d.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(r["doc_id"]) for r in got.filter("not contaminated").collect())


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert C.contamination(d.limit(0), i).count() == 0
    assert found(C.contamination(d, i.limit(0))) == brute([(1, "a b c")], [])
    assert found(C.contamination(d, i)) == brute([(1, "a b c")], [(1, "a b c")])


def test_the_search_skips_what_no_string_can_reach():
    """Far fewer blocks are looked up than there are words."""
    table, = C.strings(C.windows([("i", " ".join(f"w{k}" for k in range(10)).encode())], 10))
    looked = []

    class Moves(dict):
        def get(self, block, default):
            looked.append(block)
            return dict.get(self, block, default)

    counted = C.Strings(table.length, table.far, Moves(table.moves), table.buckets)
    text = [b"other%d" % k for k in range(9_000)] + [b"w%d" % k for k in range(10)]
    assert list(C.occurrences(text, counted)) == [(9_000, frozenset({"i"}))]
    assert len(looked) < 1_100


def test_random_strings_equal_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        alphabet = "ab" if rng.random() < 0.5 else "abcdef"
        text = lambda n: " ".join(rng.choice(alphabet) for _ in range(n))
        items = [(str(i), text(rng.randrange(1, 8))) for i in range(rng.randrange(1, 6))]
        width = rng.randrange(1, 6)
        doc = text(rng.randrange(0, 40))
        ids, runs = C.hits(terms(doc.encode()), C.strings(C.windows([(i, t.encode()) for i, t in items], width)))
        (_, n, hit, _, digest, _), = brute([(0, doc)], items, width)
        assert sum(e - s for s, e in runs) == hit and hashlib.sha256(",".join(ids).encode()).hexdigest() == digest


def test_planted_passages_of_the_given_benchmark_are_caught(spark):
    from lotcast.llm.queries import op11_wumanber
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = op11_wumanber(spark, sf)
    rows = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got.collect()), key=repr)
    assert rows == brute(docs, items)
