"""Periodic runs of words, found online by dyadic square catching.

A catcher holds a complete block of 2^k words and waits for its next occurrence, 2 to 4 block lengths on. A square whose half is
that long has such a block whole in its first half, so catchers of all k find all squares. An occurrence opens a comparison of each
word with that ``q`` places before; each appended word goes on with the open comparisons. One that has held for ``q`` words has
reported a square, and for each further word one more; they are one run, from the first word of the first square to the last
word of the last one. Few catchers wait for any one word, and a word costs log n steps at most beside its comparisons.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from idtrail.llm.common import arrow_schema, ids_and_texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DIRECT = 3  # blocks of less than 2^3 words need no catcher
PRIME = (1 << 61) - 1
BASE = 0x9E3779B97F4A7C15 % PRIME  # any large number; equal hashes are compared word by word
FOUND = "doc_id long, starts array<int>, lengths array<int>, periods array<int>, collapsed string"


class Catchers:
    """The words so far and the squares that end at the last one. Feed words with ``extend``, then ``close``."""

    def __init__(self, least: int = 6, times: int = 4) -> None:
        self.least, self.times = least, times
        self.words: list[int] = []
        self.sums = [0]  # hash of each prefix
        self.power: list[int] = []  # of the base, for block lengths 1, 2, 4 ..
        self.waiting: dict[int, list[tuple[int, int]]] = {}  # last word of a block: its first word's number, log of its length
        self.open: dict[int, int] = {}  # period: first word of the comparison that has held since then
        self.found: list[tuple[int, int, int]] = []

    def _end(self, period: int, since: int, end: int) -> None:
        """The comparison of ``period`` held from ``since`` up to the word before ``end``."""
        length = end - since + period
        if end - since >= period and length >= max(self.least, self.times * period):
            self.found.append((since - period, length, period))

    def _start(self, period: int, first: int) -> None:
        """Opens the comparison of ``period`` that holds at the last word, from where it began to hold. Not if an open run of a
        divisor has all words from ``first`` on: then ``period`` is not the smallest one there."""
        words, end = self.words, len(self.words)
        for p, since in self.open.items():
            if p < period and period % p == 0 and since - p <= first and end - since >= p:
                return
        since = end
        while since > period and words[since - 1] == words[since - 1 - period]:
            since -= 1
        if since < end:
            self.open[period] = since

    def _catchers(self) -> None:
        """Catchers of the blocks that wait from the last word on: those that ended two block lengths before it."""
        end, k = len(self.words), DIRECT
        while end % (1 << k) == 0 and end >= 3 << k:
            while len(self.power) <= k:
                self.power.append(pow(BASE, 1 << len(self.power), PRIME))
            self.waiting.setdefault(self.words[end - (2 << k) - 1], []).append((end - (3 << k), k))
            k += 1

    def _catch(self, word: int, catchers: list[tuple[int, int]]) -> None:
        """The waiting blocks that occur again with the last word. Those that have waited for four lengths go."""
        sums, end = self.sums, len(self.words)
        late = False
        for block, k in catchers:
            size = 1 << k
            q = end - size - block
            if q >= 4 * size:
                late = True
            elif q not in self.open:
                power = self.power[k]
                if (sums[end] - sums[end - size] * power - sums[block + size] + sums[block] * power) % PRIME == 0:
                    self._start(q, block)
        if late:
            self.waiting[word] = [(block, k) for block, k in catchers if end - block < 5 << k]

    def extend(self, new: Iterable[int]) -> None:
        """Appends words, given as numbers, one after the other."""
        words, sums, waiting, opened, near = self.words, self.sums, self.waiting, self.open, 2 << DIRECT
        total = sums[-1]
        for word in new:
            e = len(words)
            if opened:
                for q in [q for q in opened if words[e - q] != word]:
                    self._end(q, opened.pop(q), e)
            recent = words[-near + 1 :]
            words.append(word)
            total = (total * BASE + word + 1) % PRIME
            sums.append(total)
            at = -1
            for _ in range(recent.count(word)):  # blocks of 1, 2, 4 words: their periods are compared at once
                at = recent.index(word, at + 1)
                q = len(recent) - at
                if (q < 4 or q < e and words[e - 1] == words[e - 1 - q]) and q not in opened:
                    self._start(q, e - q)
            if not (e + 1) % (1 << DIRECT):
                self._catchers()
            if catchers := waiting.get(word):
                self._catch(word, catchers)

    def close(self) -> list[tuple[int, int, int]]:
        """All runs ``(start, length, period)`` by start and period."""
        for q, since in self.open.items():
            self._end(q, since, len(self.words))
        self.open = {}
        # a multiple of a run's period may have been opened before that run was known
        least: dict[tuple[int, int], int] = {}
        for start, length, period in self.found:
            least[start, length] = min(period, least.get((start, length), period))
        return sorted(((s, n, q) for (s, n), q in least.items()), key=lambda r: (r[0], r[2]))


def runs_of(words: Iterable, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """Maximal stretches ``(start, length, smallest period)`` of at least ``least`` words and ``times`` (2 or more) periods."""
    catchers, number = Catchers(least, times), {}
    catchers.extend(number.setdefault(word, len(number)) for word in words)
    return catchers.close()


def collapse(words: list, found: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    out, at = [], 0
    for first, end in sorted((start + period, start + length) for start, length, period in found):
        out += words[at:first]
        at = max(at, end)
    return out + words[at:]


def runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the periodic runs of the words of the text, and the text without their repeats, a row for each row of ``docs``.

    ``starts``, ``lengths``, ``periods`` (in words, in step, by start and period): stretches of at least ``least`` words and ``times``
    smallest periods that no neighbouring word extends. ``collapsed``: the words, joined by blanks, but for those that a run holds
    after its first period. Words are what lies between the six ASCII blanks. Null, empty or blank text: no runs and an empty ``collapsed``. Null ids and repeated rows
    stay as they are. Empty table: no rows. Very long texts: the time grows with n log n of the words, memory with n.
    Other columns of ``docs`` are not read.
    """
    if times < 2:
        raise ValueError("a run has at least two periods")
    wire = arrow_schema(FOUND)

    def run(batches):
        for batch in batches:
            words = [WORD.findall(x.as_py()) for x in batch.column("text").cast(pa.large_binary())]
            found = [runs_of(x, least, times) for x in words]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *(pa.array([[r[k] for r in x] for x in found], pa.list_(pa.int32())) for k in range(3)),
                pa.array([b" ".join(collapse(*x)).decode("utf-8", "replace") for x in zip(words, found, strict=True)], pa.string()),
            ], schema=wire)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, FOUND)
