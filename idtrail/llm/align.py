"""Two tokenizers' ids of the same text, aligned where tokens of both end.

The ends of either side's tokens are counted byte by byte; ends that both have cut the two lists of ids into groups. A link
joins two tokens of a group that share bytes: to each token of A the counts tell the first and the last of B. How often an id pair is linked is counted over the whole corpus: tasks count blocks
of documents first, and each block gets back the counts of its own pairs only.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from idtrail.llm.common import arrow_schema, ids_and_texts
from idtrail.session import staged

NONE = np.zeros(0, np.int64)
BLOCK = 8_000_000  # characters of text whose pairs are counted together
LONG_BLANK = re.compile(r"\s{1000}")
LINKED = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, counts binary"
ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Sides:
    """Both tokenizers: ids of a text, and for each id its bytes."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str, model_path: str) -> None:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # the rank file is the same vocabulary and four times as fast; its splitting can't stand very long blanks
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(json_path)
        self.slow.encode_special_tokens = True
        self.bytes_a = ranks_to_list(ranks)
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.bytes_b = [
            bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
            for i in range(sp.get_piece_size())
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in side]) for side in (self.bytes_a, self.bytes_b))
        # an id as text, with what follows it in its group: A within it and at its end, B within it and at its end
        self.written = [f"{x}{mark}" for mark, side in zip(",|,;", (self.bytes_a, self.bytes_a, self.bytes_b, self.bytes_b), strict=True) for x in range(len(side))]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; ``None`` if there is no text or a side's bytes are not those of the text."""
        if not text:
            return None
        a = self.slow.encode(" " + text, add_special_tokens=False).ids if LONG_BLANK.search(text) else self.fast.encode_ordinary(" " + text)
        b = self.model.encode(text, num_threads=1)
        whole = (" " + text).encode()
        # byte-level tokens are pieces of the text's own bytes: their lengths tell; the other side's pieces may spell something else
        ids_a = np.array(a, np.int64)
        same = self.length_a[ids_a].sum() == len(whole) and b"".join(map(self.bytes_b.__getitem__, b)) == whole
        return (ids_a, np.array(b, np.int64)) if same else None

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int, str]:
        """The linked id pairs (``pair_key``), one for each link; how many groups there are; and the groups as text."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at_a, at_b = ended(ends_a), ended(ends_b)
        pairs = links(a, b, ends_a, at_b)
        last_a, last_b = at_b[ends_a] > at_b[ends_a - 1], at_a[ends_b] > at_a[ends_b - 1]  # the other side has this end too
        # groups one after the other, A before B: a token comes behind all of its side and all groups of the other side before it
        before_a, before_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, before_b)[group_a]] = a + last_a * len(self.bytes_a)
        order[np.arange(len(b)) + before_a[group_b]] = b + 2 * len(self.bytes_a) + last_b * len(self.bytes_b)
        return pairs, len(before_a), "".join(map(self.written.__getitem__, order.tolist()))[:-1]


def ranks_to_list(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def ended(ends: np.ndarray) -> np.ndarray:
    """For each number of bytes, from 0: how many tokens end there or before."""
    at = np.zeros(ends[-1] + 1, np.int32)
    at[ends] = 1
    return np.cumsum(at, dtype=np.int32)


def links(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Id pairs (``pair_key``) of all token pairs that share bytes: of A's token with the tokens of B from the first that ends behind its
    start to the first that ends at its end or behind."""
    first, last = at_b[np.append(0, ends_a[:-1])], at_b[ends_a - 1]
    n = last - first + 1
    partner = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
    return pair_key(np.repeat(a, n), b[partner])


@lru_cache(maxsize=1)
def sides(*paths: str) -> Sides:
    return Sides(*paths)


def linked(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, model_path: str, digest: bool) -> DataFrame:
    """A row for each document with its distinct linked pairs (as numbers in its block's list) and how often each is linked; and
    for each block of documents a row without ``n_a`` that holds the block's pairs and their counts. Written once."""
    wire = arrow_schema(LINKED)

    def run(batches):
        task, blocks, size, rows = TaskContext.get().partitionId(), 0, 0, []

        def told():
            """The rows of a block: its documents, then its pairs."""
            block = (task << 32) + blocks
            pairs, place = np.unique(np.concatenate([r[-2] for r in rows]), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, place, np.concatenate([r[-1] for r in rows]))
            place = np.split(place.astype(np.int32), np.cumsum([len(r[-1]) for r in rows])[:-1])
            out = [(block, *r[:-2], at.tobytes(), r[-1].astype(np.int32).tobytes()) for r, at in zip(rows, place, strict=True)]
            out.append((block, None, None, None, None, None, None, pairs.tobytes(), total.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), wire.types, strict=True)], schema=wire)

        for batch in batches:
            both = sides(json_path, ranks_path, pattern, model_path)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
                text = text.as_py().decode("utf-8", "replace")
                found = both.encode(text)
                if found is None:
                    rows.append((doc_id, 0, 0, 0, 0, "", NONE, NONE))
                else:
                    keys, n_groups, groups = both.aligned(*found)
                    own, counts = np.unique(keys, return_counts=True)
                    rows.append((
                        doc_id, len(found[0]), len(found[1]), n_groups, len(keys),
                        hashlib.sha256(groups.encode()).hexdigest() if digest else groups, own, counts,
                    ))
                size += len(text)
                if size >= BLOCK:
                    yield told()
                    size, rows, blocks = 0, [], blocks + 1
        if rows:
            yield told()

    return staged(ids_and_texts(docs).mapInArrow(run, LINKED))


def block_pairs(rows: DataFrame) -> DataFrame:
    """``block, place, a, b, n`` for each pair of each block's list: how often the block's documents link it."""
    wire = arrow_schema("block long, place int, a int, b int, n long")

    def run(batches):
        for batch in batches:
            for block, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "counts")), strict=True):
                pair, n = np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(pair), block)), pa.array(np.arange(len(pair), dtype=np.int32)),
                    pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)), pa.array(n),
                ], schema=wire)

    return rows.where("n_a is null").select("block", "pairs", "counts").mapInArrow(run, "block long, place int, a int, b int, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a, b, total, best``: links of each id pair in the corpus, and whether no other pair with this ``b`` has more."""
    totals = staged(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")))
    most = totals.groupBy(F.col("b").alias("of")).agg(F.max("total").alias("most"))
    return totals.join(most, totals.b == most.of).select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, model_path: str, id_col: str = "doc_id", text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """For each row of ``docs``: numbers of ids, groups and links; ``n_best``, its links whose pair has the highest corpus count of its B
    id (ties too); ``count_sum``, the corpus counts over its links; ``groups``, ids as ``a1,a2|b1;a3|b2`` (``digest``: its SHA-256).

    A is byte-level BPE of a blank and the text, B the piece model, which adds that blank. Special tokens' strings are plain text.
    Null and empty texts, and texts of which either side's bytes differ (the piece model's own blank mark), have no tokens: zeros and ''.
    Null ids and repeated rows stay, each counts. Empty table: no rows. Very long texts make a block of their own; memory grows with
    the longest text. Other columns of ``docs`` are not read. Paths are the same on all machines.
    """
    paths = (json_path, ranks_path, pattern, model_path)
    rows = linked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), *paths, digest)
    pairs = block_pairs(rows)
    counted = pairs.join(pair_counts(pairs), ["a", "b"]).select("block", "place", "total", "best")
    own = rows.where("n_a is not null")
    wire = arrow_schema(ROWS)
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        total, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        total[place], best[place] = right.column("total").to_numpy(), right.column("best").to_numpy()
        n_best, count_sum = [], []
        for at, n in zip(left.column("pairs").to_pylist(), left.column("counts").to_pylist(), strict=True):
            at, n = np.frombuffer(at, np.int32), np.frombuffer(n, np.int32).astype(np.int64)
            n_best.append(int(n[best[at]].sum()))
            count_sum.append(int((n * total[at]).sum()))
        told = dict(zip(keep, left.select(keep).columns, strict=True)) | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table({c: told[c] for c in wire.names}, schema=wire)

    # of a block there are at most its documents and its pairs
    return own.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(sums, ROWS)
