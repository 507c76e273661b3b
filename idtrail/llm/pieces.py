"""Merge-type SentencePiece models: encoding by a table of the last token of each prefix, and decoding.

Merges keep the encoding of every run of their own tokens, so tokens are an encoding exactly if each neighbouring pair is
one. Every prefix of a text then has one encoding, and one last token: the token that ends there and is compatible with the
last token of the prefix before it. The table holds a token for each place, whatever the length of the text.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idtrail.llm.common import Batches, arrow_schema, ids_and_texts

SPACE = "▁"
KEPT = 250_000  # chunks that a task remembers, and as many pairs of tokens
SHORT = 64  # longer chunks are not remembered
AT_ONCE = 1_000_000  # characters or ids of a batch that go out together
NEVER = float("inf")


class Pieces:
    """The tables of one model. Characters without a piece of their own are tokens ``-ord(c)`` until the ids are told."""

    def __init__(self, path: str) -> None:
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in numbers):
            raise ValueError("models with unused pieces are not supported")
        self.unknown = sp.unk_id()
        self.byte = {int(sp.id_to_piece(i)[3:-1], 16): i for i in numbers if sp.is_byte(i)}
        self.text = {i: sp.id_to_piece(i) for i in numbers if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        self.rank = {piece: -sp.get_score(i) for i, piece in self.text.items()}
        tied = Counter(self.rank.values())
        self.tied = {piece for piece, rank in self.rank.items() if tied[rank] > 1}
        self.parts = {piece: self._parts(piece) for piece in self.rank}
        self.matches = ahocorasick.Automaton()
        for i, piece in self.text.items():
            if len(piece) == 1 or self.parts[piece]:  # a piece that merges never make is never a token
                self.matches.add_word(piece, (i, len(piece), {}))  # with the tokens that were tried on its left
        self.matches.make_automaton()
        known = {c for piece in self.text.values() for c in piece}
        bars = "".join(re.escape(c) for c in map(chr, range(128)) if c not in known)
        # no token holds a character of one chunk and one of the next
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.text.values()):
            self.chunks = re.compile(f"[^{bars}]+|[{bars}]")
        else:
            self.chunks = re.compile(f"{SPACE}*[^{SPACE}{bars}]+|{SPACE}+|[{bars}]")
        self.spelled = {i: piece.replace(SPACE, " ").encode() for i, piece in self.text.items()}
        self.spelled |= {i: bytes([b]) for b, i in self.byte.items()}
        self.spelled |= {i: b"" for i in numbers if sp.is_control(i)} | {self.unknown: " ⁇ ".encode()}
        self.edges: dict[str, tuple] = {}
        self.tried = 0
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _merge(self, now: list[str]) -> int:
        """Merges the pair of the least rank, the leftmost of equals, and tells where; -1 if no pair is a piece."""
        best, at = NEVER, -1
        for k in range(len(now) - 1):
            rank = self.rank.get(now[k] + now[k + 1], NEVER)
            if rank < best:
                best, at = rank, k
        if at >= 0:
            now[at : at + 2] = [now[at] + now[at + 1]]
        return at

    def _parts(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge of ``piece`` joins."""
        now = list(piece)
        while len(now) > 2 and self._merge(now) >= 0:
            pass
        return (now[0], now[1]) if len(now) == 2 else None

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """What stands at one end of ``piece`` while it is merged, from its character to itself, and the rank of the merge
        that ends it. ``None`` if ranks don't rise with the merges, or are those of several pieces."""
        out, until = [], NEVER
        while True:
            out.append((piece, until))
            if len(piece) == 1:
                return out[::-1]
            rank, parts = self.rank[piece], self.parts[piece]
            if rank >= until or piece in self.tied or any(self.rank.get(x, -NEVER) >= rank for x in parts if len(x) > 1):
                return None
            piece, until = parts[side], rank

    def _edges(self, piece: str) -> tuple:
        found = self.edges.get(piece)
        if found is None:
            found = self.edges[piece] = (self._edge(piece, 0), self._edge(piece, 1))
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens next to each other are the encoding of their joined text.

        They are, unless a pair across their border is a piece of lesser rank than the merges that would end it.
        """
        a, b = (self.text[x] if x >= 0 else chr(-x) for x in (left, right))
        ends, starts = self._edges(a)[1], self._edges(b)[0]
        if ends is None or starts is None:
            return self._stays(a, b)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = ends[i], starts[j]
            rank = self.rank.get(x + y)
            if rank is not None:
                if x + y in self.tied:
                    return self._stays(a, b)
                if rank < x_until and rank <= y_until:
                    return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:  # of equal ranks the leftmost merge comes first
                i += 1
            else:
                j += 1

    def _stays(self, a: str, b: str) -> bool:
        """The same by doing all merges of the joined text."""
        now = list(a + b)
        while (at := self._merge(now)) >= 0:
            before = sum(map(len, now[:at]))
            if before < len(a) < before + len(now[at]):
                return False
        return True

    def prefix_table(self, chunk: str) -> list[int | None]:
        """For each length, the last token of the encoding of the prefix; ``None`` where a character has no piece."""
        last: list[int | None] = [None] * (len(chunk) + 1)
        for end, (token, size, tried) in self.matches.iter(chunk):
            if last[end + 1] is None:
                start = end + 1 - size
                if start:
                    before = last[start]
                    if before is None:
                        before = -ord(chunk[start - 1])
                    fits = tried.get(before)
                    if fits is None:
                        fits = tried[before] = self.compatible(before, token)
                        self.tried += 1
                    if not fits:
                        continue
                last[end + 1] = token
        if self.tried > KEPT:
            self.tried = 0
            for _, _, tried in self.matches.values():
                tried.clear()
        return last

    def _chunk(self, chunk: str) -> bytes:
        last, at, back = self.prefix_table(chunk), len(chunk), []
        while at:
            token = last[at]
            if token is None:
                at -= 1
                back += [self.byte[b] for b in reversed(chunk[at].encode())] if self.byte else [self.unknown]
            else:
                back.append(token)
                at -= len(self.text[token])
        return array("i", reversed(back)).tobytes()

    def _remembered(self, chunk: str) -> bytes:
        """Ids of a chunk, four bytes each. Short ones are kept; a full table becomes the older one, from which chunks in use come back."""
        ids = self.before.get(chunk) or self._chunk(chunk)
        if len(chunk) <= SHORT:
            if len(self.known) >= KEPT:
                self.before = dict(self.known)
                self.known.clear()
            self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text, without begin and end ids."""
        known, new = self.known, self._remembered
        ids = np.frombuffer(b"".join([known.get(c) or new(c) for c in self.chunks.findall(self.model.normalize(text))]), np.int32)
        if not self.byte and len(ids):  # neighbouring unknown characters are one id
            ids = ids[np.append(True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown))]
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: pieces and bytes joined, without the blank that encoding puts first."""
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids]).removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def text_of(value: bytes) -> str:
    """Bytes that are no UTF-8 count as U+FFFD."""
    return value.decode("utf-8", "replace")


def portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """From and to of runs of rows that have about ``AT_ONCE`` in all, so that a batch of long texts isn't in memory as ids."""
    start = total = 0
    for k, size in enumerate(sizes, 1):
        total += size
        if total >= AT_ONCE or k == len(sizes):
            yield start, k
            start, total = k, 0


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for each row of ``docs``, as the model's own library encodes the whole text.

    Null or empty text: no ids. Null ids and repeated rows stay as they are. Empty table: no rows. Very long texts: memory
    grows with the text's length, time too. Other columns of ``docs`` are not read. ``path`` is the same on all machines.
    """
    wire = arrow_schema("doc_id long, ids array<int>")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            model, texts = pieces(path), batch.column("text").cast(pa.large_binary())
            for a, b in portions(pc.binary_length(texts).to_pylist()):
                ids = [model.encode(text_of(x.as_py())) for x in texts[a:b]]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], lists.cast(wire.field("ids").type)], schema=wire)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` for each row of ``encoded (doc_id, ids)``: the text of the ids. Null ids: null text."""
    wire = arrow_schema("doc_id long, ids array<int>, text string")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            model, ids = pieces(path), batch.column("ids")
            for a, b in portions(pc.fill_null(pc.list_value_length(ids), 0).to_pylist()):
                texts = [x if x is None else model.decode(x) for x in ids[a:b].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], ids[a:b], pa.array(texts, pa.string())], schema=wire)

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, text string")
