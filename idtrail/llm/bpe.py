"""Byte-level BPE by DuckDB's recursive queries inside each partition.

A row is a token at a place of a word. A step joins neighbouring tokens with the merge table and contracts the leftmost pair of
the least rank of each word; words without such a pair leave the recursion. DuckDB runs in the task's own process and memory.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from functools import lru_cache
from itertools import accumulate, count

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from idtrail.llm.common import arrow_schema, ids_and_texts

HALVES = (48, 144, 720, 5040, 55440)  # bytes; longer words are encoded in overlapping pieces of twice as many
BYTES = 1 << 20  # of words in one query

# A word is one row with the list of its tokens, replaced at each step (only the newest row of a word is held); a step takes it
# apart into token-position rows.
WORDS = """
with recursive state(w, ids) using key (w) as (
  select w, list(id order by p) from start group by w
  union all
  select s.w, s.ids[:b.p - 1] || [b.m] || s.ids[b.p + 2:]
  from state s join (
    select w, min(k) & ((1::bigint << 40) - 1) as p, (min(k) >> 40)::int as m from (
      select placed.w, (merges.m::bigint << 40) | placed.p as k from (
        select w, p, (ids[p]::bigint << 32) | ids[p + 1] as pair from (select w, ids, unnest(range(1, len(ids))) as p from state)
      ) placed join merges on merges.pair = placed.pair
    ) group by w
  ) b on s.w = b.w
)
select w, ids from state
"""
DECODED = """
select w, array_to_string(ids, ' ') as said, bytes from found join (
  select w, unhex(string_agg(hex, '' order by p)) as bytes
  from (select w, unnest(ids) as id, unnest(range(len(ids))) as p from found) join tokens using (id) group by w) using (w)
"""


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """The rank of each token; the file is on every executor, as its library is."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def parts(items: list, most: int = BYTES, size=len):
    """``items`` in lists of at most ``most`` bytes together, or of one item."""
    part, held = [], 0
    for item in items:
        n = size(item)
        if part and held + n > most:
            yield part
            part, held = [], 0
        part.append(item)
        held += n
    if part:
        yield part


class Codec:
    """Encodes and decodes words (matches of the split pattern) with one private in-memory database."""

    def __init__(self, ranks: dict[bytes, int], memory: str = "250MB") -> None:
        self.ranks, self.token = ranks, {rank: token for token, rank in ranks.items()}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        ]
        merges = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "m": pa.array([m for _, m in pairs], pa.int32())})
        tokens = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [token.hex() for token in ranks]})
        for name, rows in (("merges", merges), ("tokens", tokens)):
            self.db.register("given", rows)
            self.db.execute(f"create table {name} as select * from given")
            self.db.unregister("given")
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)

    def _ask(self, query: str, **tables: pa.Table) -> pa.Table:
        for name, rows in tables.items():
            self.db.register(name, rows)
        told = self.db.sql(query).to_arrow_table()
        for name in tables:
            self.db.unregister(name)
        return told

    def _contracted(self, words: list[bytes]) -> pa.Table:
        """``w, ids`` of each word, by the recursion."""
        lengths = np.array([len(w) for w in words])
        return self._ask(WORDS, start=pa.table({
            "w": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "p": np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths),
            "id": self.bytes[np.frombuffer(b"".join(words), np.uint8)],
        }))

    def _stitched(self, words: list[bytes], half: int) -> list[list[int] | None]:
        """Ids of each word from pieces of ``2 * half`` bytes, each of which begins in the middle of the one before.

        Two pieces that hold the same token at the same place are joined at it. A list of tokens is the encoding of its bytes if any
        two neighbours are that of theirs: the first merge over a border between two tokens would be one of the two alone as well. All
        neighbours here are neighbours in the encoding of a piece. None where two pieces share no token.
        """
        cuts = [[w[at : at + 2 * half] for at in range(0, max(1, len(w) - half), half)] for w in words]
        known = dict.fromkeys(piece for pieces in cuts for piece in pieces)
        for part in parts(list(known)):
            rows = self._contracted(part)
            known.update(zip([part[k] for k in rows["w"].to_pylist()], rows["ids"].to_pylist(), strict=True))
        told = []
        for pieces in cuts:
            ids, begins = [], []  # tokens so far and where they begin
            for k, piece in enumerate(pieces):
                own = known[piece]
                places = list(accumulate((len(self.token[i]) for i in own[:-1]), initial=k * half))
                if not k:
                    ids, begins = list(own), places
                    continue
                here = dict(zip(places, range(len(own))))
                last = (k + 1) * half
                j = len(ids) - 1
                while j >= 0 and begins[j] >= k * half and (begins[j] >= last or begins[j] not in here or own[here[begins[j]]] != ids[j]):
                    j -= 1
                if j < 0 or begins[j] < k * half:
                    ids = None
                    break
                at = here[begins[j]]
                del ids[j:], begins[j:]
                ids += own[at:]
                begins += places[at:]
            told.append(ids)
        return told

    def encode(self, words: list[bytes], at_once: int = BYTES) -> tuple[list[str], list[bytes]]:
        """Ids, joined by blanks, and decoded bytes of each word; words that are tokens need no merge."""
        told = [str(self.ranks[w]) if w in self.ranks else None for w in words]
        decoded = [self.token[self.ranks[w]] if w in self.ranks else b"" for w in words]
        open_ = [i for i, said in enumerate(told) if said is None and words[i]]
        short, long = ([i for i in open_ if (len(words[i]) > 2 * HALVES[0]) == big] for big in (False, True))
        done = [(part, self._contracted([words[i] for i in part])) for part in parts(short, at_once, lambda i: len(words[i]))]
        for half in HALVES:
            ids = self._stitched([words[i] for i in long], half)
            whole = [(i, x) for i, x in zip(long, ids, strict=True) if x is not None]
            done += [([i], pa.table({"w": pa.array([0], pa.int32()), "ids": pa.array([x], pa.list_(pa.int32()))})) for i, x in whole]
            long = [i for i, x in zip(long, ids, strict=True) if x is None]
        for i in long:  # no two pieces of any length agree: the word as a whole
            done.append(([i], self._contracted([words[i]])))
        for part, found in done:
            rows = self._ask(DECODED, found=found)
            for k, said, whole in zip(*(rows[c].to_pylist() for c in ("w", "said", "bytes")), strict=True):
                told[part[k]], decoded[part[k]] = said, whole
        return ["" if said is None else said for said in told], decoded

    def close(self) -> None:
        self.db.close()


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids, decoded``) for each row of ``docs``.

    ``path``: a rank file (base64 token and rank a line) with all 256 bytes in it; ``pattern``: what splits a text into words. No
    special tokens: their strings are ordinary text. Each word of a partition is worked out once; nothing is shuffled.

    Null or empty text: no tokens, digests of nothing. Null ids and repeated rows each come out. Words of any
    length are encoded in bounded pieces (see :meth:`Codec._stitched`). Empty table: no rows. Other columns are not read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids
    arrow = arrow_schema(schema)

    def run(batches):
        codec, split = None, regex.compile(pattern)
        index, told, sizes, back = defaultdict(count().__next__), [], [], []
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                codec = codec or Codec(ranks_of(path))
                if len(index) > 600_000:  # a fresh cache; memory stays bounded
                    index, told, sizes, back = defaultdict(count().__next__), [], [], []
                placed = [np.array([index[w] for w in split.findall(text)], np.int32) for text in batch.column("text").to_pylist()]
                new = [w.encode() for w in list(index)[len(told):]]
                said, decoded = codec.encode(new)
                told += said
                sizes += [x.count(" ") + 1 for x in said]
                back += decoded
                size = np.array(sizes, np.int64)
                rows = []
                for doc_id, at in zip(batch.column("doc_id").to_pylist(), placed, strict=True):
                    where = at.tolist()
                    whole = b"".join(map(back.__getitem__, where))
                    joined = " ".join(map(told.__getitem__, where))
                    row = (doc_id, int(size[at].sum()), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(whole).hexdigest())
                    rows.append((*row, list(map(int, joined.split())), whole) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)
        finally:
            if codec:
                codec.close()

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)
