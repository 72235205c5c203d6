"""SentencePiece encoding and decoding with an existing model.

An Aho-Corasick automaton over the model's pieces reports, in one pass over
the text, every piece that ends at each position (following output links).
Each report relaxes the best score at that position, so the pass is the
Viterbi segmentation of highest total piece score. Ties go to the longer last
piece. A character that no piece covers costs the worst score less 10 and
becomes its UTF-8 byte pieces (the unknown id in models without them).

Blanks become U+2581 and one is put in front, as the model's own rules say
(identity normalisation). No piece has U+2581 after another character, so a
segmentation never crosses the start of a blank run, and the runs between
can be solved one by one and remembered. A U+2581 in the text itself is
written as bytes, which makes decoding exact for every text.

Edge cases: NULL text gives NULL ids and NULL ids give NULL text; empty text
gives an empty list; repeated rows and other columns pass through; an
existing column with the output's name is replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
BREAK = "\n"
#: Remembered units per worker and generation; there are two generations.
REMEMBERED = 1 << 16
#: Longer units are solved without being remembered.
REMEMBERED_CHARS = 48
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def read_model(path: str) -> bytes:
    """The model file's bytes (read on the driver; under a megabyte)."""
    with open(path, "rb") as f:
        return f.read()


class PieceModel:
    """Pieces, scores and ids of one model, with its automaton."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.text_of: list[str | None] = []
        self.byte_of: dict[int, int] = {}
        self.byte_id: dict[int, int] = {}
        self.score: dict[str, tuple[float, int]] = {}
        self.unknown_id = reader.unk_id()
        for i in range(reader.get_piece_size()):
            piece = reader.id_to_piece(i)
            if reader.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
                self.byte_id[self.byte_of[i]] = i
                self.text_of.append(None)
            elif reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i):
                self.text_of.append("")
            else:
                self.text_of.append(piece.replace(SPACE, " "))
                self.score[piece] = (reader.get_score(i), i)
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece has a blank after another character; units can't be solved apart")
        self.unknown_score = min(s for s, _ in self.score.values()) - 10
        self.single = {p for p in self.score if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, (score, i) in self.score.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.breaks = not any(BREAK in p for p in self.score)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _unknown(self, char: str) -> list[int]:
        if len(self.byte_id) < 256:
            return [self.unknown_id]
        return [self.byte_id[b] for b in char.encode()]

    def viterbi(self, unit: str) -> list[int]:
        """Best segmentation of a unit in one pass over the automaton."""
        n = len(unit)
        best, length_of, id_of = [0.0] + [float("-inf")] * n, [1] * (n + 1), [-1] * (n + 1)
        # Characters without a piece of their own get their fallback just
        # before the first match that ends after them.
        bare = [k for k, c in enumerate(unit) if c not in self.single]
        bare.append(n)
        due = bare.pop(0)
        for end, (length, score, i) in self.automaton.iter(unit):
            while due < end:
                self._fall_back(best, length_of, id_of, due)
                due = bare.pop(0)
            end += 1
            score += best[end - length]
            if score > best[end]:
                best[end], length_of[end], id_of[end] = score, length, i
        while due < n:
            self._fall_back(best, length_of, id_of, due)
            due = bare.pop(0)
        ids: list[int] = []
        while n:
            if id_of[n] >= 0:
                ids.append(id_of[n])
            else:
                ids += self._unknown(unit[n - 1])[::-1]
            n -= length_of[n]
        ids.reverse()
        return ids

    def _fall_back(self, best: list[float], length_of: list[int], id_of: list[int], k: int) -> None:
        if best[k] + self.unknown_score > best[k + 1]:
            best[k + 1], length_of[k + 1], id_of[k + 1] = best[k] + self.unknown_score, 1, -1

    def unit(self, unit: str) -> tuple[int, ...]:
        """Solve a unit and remember it. Units used since the last change of
        generation survive the next one."""
        ids = self.older.get(unit)
        if ids is None:
            ids = tuple(self.viterbi(unit))
        if len(unit) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[unit] = ids
        return ids

    def _units(self, part: str, first: bool) -> list[str]:
        """Units of a text without U+2581; ``first``: it starts the text."""
        if "  " in part or part[:1] == " " or part[-1:] == " ":
            return _UNIT.findall((" " + part if first else part).replace(" ", SPACE))
        return ((SPACE if first else "") + part.replace(" ", " " + SPACE)).split(" ")

    def encode(self, text: str, into: array) -> None:
        """Append the text's ids to ``into``."""
        if not text:
            return
        for k, part in enumerate(text.split(SPACE)):
            if k:
                into.extend(self._unknown(SPACE))
            # No piece holds this character, so no segmentation crosses it.
            for j, line in enumerate(part.split(BREAK) if self.breaks else [part]):
                if j:
                    into.extend(self._unknown(BREAK))
                if line or not k and not j:
                    get = self.known.get
                    into.extend(chain.from_iterable([get(u) or self.unit(u) for u in self._units(line, not k and not j)]))

    def decode(self, ids) -> str:
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            piece = self.text_of[i]
            if piece is None:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(piece)
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out)[1:] if out else ""


@lru_cache(maxsize=2)
def load(model: bytes) -> PieceModel:
    """The model, built once per worker."""
    return PieceModel(model)


def _append(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [k for k, f in enumerate(batch.schema.names) if f != name]
    return pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + [values],
                                      [batch.schema.names[k] for k in kept] + [name])


def _out_schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the ids of every whole text; a narrow map over Arrow batches."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(shared.value)
        for batch in batches:
            ids, ends, null = array("i"), array("i", [0]), []
            for text in batch.column(text_col):
                text = text.as_py()
                null.append(text is None)
                if text is not None:
                    pieces.encode(text, ids)
                ends.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(ids), pa.int32()),
                                             mask=pa.array(null, pa.bool_()))
            yield _append(batch, ids_col, lists)

    return df.mapInArrow(run, _out_schema(df, ids_col, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of every id list; a narrow map over Arrow batches."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(shared.value)
        for batch in batches:
            lists = batch.column(ids_col)
            texts = [None if x is None else pieces.decode(x)
                     for x in (lists[k].values.to_numpy(zero_copy_only=False).tolist() if lists[k].is_valid else None
                               for k in range(len(lists)))]
            yield _append(batch, text_col, pa.array(texts, pa.string()))

    return df.mapInArrow(run, _out_schema(df, text_col, T.StringType()))
