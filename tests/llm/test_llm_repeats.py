import random
from collections import defaultdict

import numpy as np
import pytest
from brute import removed_bytes

from lotcast.llm import repeats
from lotcast.session import drop_scratch

COLUMNS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _texts(seed):
    rng = random.Random(seed)
    passage = [rng.choice("abé") for _ in range(60)]
    out = []
    for _ in range(60):
        kind = rng.randrange(6)
        noise = "".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(80)))
        if kind == 0:
            out.append(noise)
        elif kind == 1:
            out.append(rng.choice("ab") * rng.randrange(40))
        elif kind == 2:
            a = rng.randrange(40)
            out.append(noise + "".join(passage[a:a + rng.randrange(40)]) + noise[::-1])
        elif kind == 3 and out:
            out.append(rng.choice(out))
        elif kind == 4 and out:
            t = rng.choice(out) or ""
            k = rng.randrange(len(t) + 1)
            out.append(t[:k] + rng.choice("xyz") + t[k:])
        else:
            out.append(None if rng.random() < 0.3 else "ab" * rng.randrange(20))
    return out


@pytest.mark.parametrize("seed,width,contexts", [(1, 12, 8192), (2, 9, 8192), (3, 16, 2), (4, 5, 1)])
def test_every_repeated_byte_and_no_other(spark, monkeypatch, seed, width, contexts):
    monkeypatch.setattr(repeats, "BUCKET_CONTEXTS", contexts)  # small: windows are counted instead
    monkeypatch.setattr(repeats, "CHUNK", 37)
    texts = _texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.remove_repeats(docs, min_bytes=width).orderBy("doc_id").select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == removed_bytes(texts, width)


def test_maximal_repeats_have_all_occurrences(spark):
    texts = [t or "" for t in _texts(7)]
    width = 10
    rows = spark.createDataFrame([(bytes([i]), 0, t.encode()) for i, t in enumerate(texts)],
                                 "rkey binary, scope long, units binary")
    groups = defaultdict(set)
    for r in repeats.repeat_groups(rows, width).collect():
        groups[r["group_id"]].add((r["rkey"][0], r["start"], r["length"]))
    assert groups
    raws = [t.encode() for t in texts]
    for members in groups.values():
        strings = {raws[d][s:s + n] for d, s, n in members}
        assert len(strings) == 1 and len(members) > 1
        string = strings.pop()
        everywhere = {(d, s, len(string)) for d, r in enumerate(raws) for s in range(len(r)) if r.startswith(string, s)}
        assert members == everywhere
    covered = [bytearray(len(r)) for r in raws]
    for members in groups.values():
        for d, s, n in members:
            covered[d][s:s + n] = b"\1" * n
    assert [sum(c) for c in covered] == [n for _, n, _, _ in removed_bytes(texts, width)]


def _maximal(raws, width):
    """string -> occurrences of every maximal repeat, from all substrings."""
    at = defaultdict(set)
    for d, r in enumerate(raws):
        for i in range(len(r)):
            for j in range(i + width, len(r) + 1):
                at[r[i:j]].add((d, i))
    def sides(w, places):
        return ({raws[d][i - 1:i] if i else (d, i) for d, i in places},
                {raws[d][i + len(w):i + len(w) + 1] or (d, i) for d, i in places})
    return {w: p for w, p in at.items() if len(p) > 1 and all(
        len(s) > 1 or isinstance(next(iter(s)), tuple) for s in sides(w, p))}


@pytest.mark.parametrize("contexts", [65536, 2])
def test_groups_are_whole_maximal_repeats(spark, monkeypatch, contexts):
    monkeypatch.setattr(repeats, "BUCKET_CONTEXTS", contexts)  # small: hot groups
    rng = random.Random(3)
    size = 90 if contexts > 2 else 16  # far longer than one anchor's context
    x, y, z = ["".join(rng.choice("abcdefgh") for _ in range(size)) for _ in range(3)]
    texts = [x + y + z, "1" + x + y + "2", "3" + y + z + "4", "5" + z + x, "6" + x + y + z, x, "bb" * 7, "", x[:8] + "q", x[:8] + "r"]
    raws = [t.encode() for t in texts]
    rows = spark.createDataFrame([(bytes([i]), 0, t) for i, t in enumerate(raws)], "rkey binary, scope long, units binary")
    got = defaultdict(set)
    for r in repeats.repeat_groups(rows, 6).collect():
        d, s = r["rkey"][0], r["start"]
        got[r["group_id"], raws[d][s:s + r["length"]]].add((d, s))
    want = _maximal(raws, 6)
    assert {w: p for (_, w), p in got.items()} == want and len(got) == len(want)
    assert max(map(len, want)) == 3 * size


def test_interval_scan():
    assert sorted(repeats.intervals(np.array([0, 2, 2, 1, 0, 3]))) == [(1, 0, 3), (2, 0, 2), (3, 4, 5)]


def test_edges(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    rows = [(1, None), (2, ""), (None, "short"), (4, long), (5, long[1000:1800]), (6, "twin " * 200), (6, "twin " * 200)]
    docs = spark.createDataFrame([(*r, "x", "k") for r in rows], "doc_id long, text string, row string, kept_text string")
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs).collect()}
    assert [got[k]["n_removed"] for k in (1, 2, None, 4, 5)] == [0, 0, 0, 800, 800]
    assert got[4]["n_spans"] == 1 and got[5]["kept_text"] == "" and got[6]["n_removed"] == 1000
    assert got[4]["row"] == "x"
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    from lotcast.llm.queries import op10_repeats
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = op10_repeats(spark, sf).orderBy("doc_id").select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == removed_bytes([d["text"] for d in docs], 400)


def test_query_takes_planted_passages_of_400_bytes_and_leaves_shorter_ones(spark, tmp_path):
    """Bytes decide, not words: passages of 55 words that two documents hold
    go from 400 bytes on, and ``text`` is what is left. ``n_bytes`` is the
    input's size whatever goes."""
    import hashlib

    from lotcast.llm.queries import op10_repeats
    rng = random.Random(11)
    words = lambda n, size: " ".join("".join(rng.choices("abcdefgh", k=size)) for _ in range(n))
    short, long = words(55, 5), words(55, 7)
    assert len(short) < 400 <= len(long)
    texts = [words(300, 6) for _ in range(8)]
    for i, passage in ((0, short), (1, short), (2, long), (3, long), (4, long)):
        texts[i] = f"{texts[i][:600]}{i}{passage}{i}{texts[i][600:]}"
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op10_repeats(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        kept = text.replace(long, "")
        assert got[i]["text"] == kept and got[i]["n_bytes"] == len(text)
        assert got[i]["n_removed"] == len(text) - len(kept) == (len(long) if i in (2, 3, 4) else 0)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_repeat_passages_are_whole_maximal_and_cover_what_is_removed(spark):
    """The query over whole documents: each group holds every occurrence of
    its string, no group could be longer on a side, and together they cover
    what brute force removes."""
    from brute import removed_bytes
    from lotcast.llm.queries import repeat_passages
    sf = "/root/testdata/sf0.001"
    raw = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    groups = {}
    for r in repeat_passages(spark, sf).collect():
        assert r["starts"] == sorted(set(r["starts"]))
        groups.setdefault((r["group_id"], r["length"]), []).extend((r["doc_id"], s) for s in r["starts"])
    covered, seen = {d: bytearray(len(t)) for d, t in raw.items()}, set()
    whole = "\0".join(t.decode() for t in raw.values()).encode()  # no text holds a NUL
    for (_, n), at in groups.items():
        strings = {raw[d][s:s + n] for d, s in at}
        string, = strings
        assert len(string) == n >= 400 and string not in seen
        seen.add(string)
        count = pos = 0
        while (pos := whole.find(string, pos) + 1):
            count += 1
        assert count == len(at) >= 2
        for side in ([raw[d][s - 1:s] if s else None for d, s in at], [raw[d][s + n:s + n + 1] or None for d, s in at]):
            assert None in side or len(set(side)) > 1
        for d, s in at:
            covered[d][s:s + n] = b"\1" * n
    for (d, t), (_, gone, _, _) in zip(raw.items(), removed_bytes([t.decode() for t in raw.values()], 400)):
        assert sum(covered[d]) == gone


def test_root_places_grow_with_the_repeats_not_with_their_bytes(spark):
    """Two long copies have one place for a root each, not one for each of
    their windows, and a repeat is a row for each text that holds it."""
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(20_000)).encode()
    rows = spark.createDataFrame([(b"1", 0, b"x" + long), (b"2", 0, b"yy" + long)], "rkey binary, scope long, units binary")
    places = {r["rkey"]: {a + p["s"] for p in r["places"] for a in p["starts"]} for r in repeats._root_places(rows, 400, 1).collect()}
    assert 1 in places[b"1"] and 2 in places[b"2"] and max(map(len, places.values())) < 200
    line = bytes(rng.choice(b"abcdefgh ") for _ in range(100))
    rows = spark.createDataFrame([(b"1", 0, line * 9)], "rkey binary, scope long, units binary")
    got = repeats.grouped_repeats(rows, 100).collect()
    assert sorted((r["length"], r["starts"]) for r in got) == [(100 * n, list(range(0, 1000 - 100 * n, 100))) for n in range(1, 9)]


@pytest.mark.parametrize("across_rows", [False, True])
def test_grams_that_occur_once_go_no_further_and_scratch_goes(spark, monkeypatch, tmp_path, across_rows):
    """Only anchors of repeated grams reach the buckets, and once the spans
    are known nothing else stays on the disk."""
    monkeypatch.setattr("lotcast.session.scratch_root", lambda _: f"file:{tmp_path}")
    rng = random.Random(9)
    passage, inner = ["".join(rng.choice("abcdefgh ") for _ in range(700)) for _ in range(2)]
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(9000)) for _ in range(6)]
    texts[1] += passage
    texts[4] = passage + texts[4]
    texts[5] = inner + texts[5] + inner  # repeats in one row only
    rows = spark.createDataFrame([(bytes([i]), 0, t.encode()) for i, t in enumerate(texts)],
                                 "rkey binary, scope long, units binary")
    anchors = repeats._buckets(rows, 400, 1, across_rows)[0].collect()
    assert {r["rkey"][0] for r in anchors} == ({1, 4} if across_rows else {1, 4, 5})
    assert 0 < len(anchors) < 30 < repeats._anchors(rows, 400, 1).count()
    for folder in list((tmp_path / "lotcast").iterdir()):
        drop_scratch(spark, f"file:{folder}")
    spans = repeats.find_repeats(rows, 400, across_rows=across_rows)
    assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "lotcast").iterdir()] == ["repeat-spans"]
    covered = {r["rkey"][0]: sorted(repeats.stretches(r["spans"])) for r in spans.collect()}
    assert {d: (s[0][0], max(e for _, e in s)) for d, s in covered.items()} == {
        1: (9000, 9700), 4: (0, 700), **({} if across_rows else {5: (0, 10400)})}


def test_equal_texts_are_read_once_and_levels_read_what_goes_on(spark, monkeypatch, tmp_path):
    """Documents of one text are listed each but compared as one, and a level
    reads no text whose repeats have ended."""
    from lotcast.llm.queries import repeat_passages
    rng = random.Random(31)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    copied, passage = word(9000), word(500)
    copied = f"{copied[:4000]}({passage}){copied[4000:]}"
    texts = [(k, copied) for k in range(4)] + [(4, copied), (4, copied), (5, f"{word(700)}[{passage}]{word(300)}"), (6, None)]
    spark.createDataFrame(texts + [(10 + k, word(900)) for k in range(9)], "doc_id long, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    read, pieces = [], repeats._pieces
    monkeypatch.setattr(repeats, "_pieces", lambda state, texts, unit: read.append(texts.count()) or pieces(state, texts, unit))
    got = sorted((r["length"], r["doc_id"], r["starts"]) for r in repeat_passages(spark, str(tmp_path)).collect())
    assert got == [*[(500, k, [4001]) for k in range(5)], (500, 5, [701]), *[(9502, k, [0]) for k in range(5)]]
    assert read[0] == 2 and read[-1] == 1
