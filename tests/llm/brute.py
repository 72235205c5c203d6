"""Plain-Python answers that the operators are held against."""

import hashlib
from collections import Counter


def removed_bytes(texts, width):
    """n_bytes, n_removed, n_spans, sha256 of the rest, per text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - width + 1):
            if seen[r[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        rest = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def near_components(rows, size, percent=80):
    """doc_id -> (set size, smallest id reachable); ids must be distinct."""
    sets = [(d, shingles(t, size)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            common = len(x & y)
            if x and y and 100 * common >= percent * (len(x) + len(y) - common):
                u, v = sorted((find(a), find(b)))
                parent[v] = u
    return {d: (len(s), find(d)) for d, s in sets}


def text_measures(text):
    """word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words."""
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            repeated |= set(range(i, i + 5))
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}
