"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window."""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from idtrail.llm.bpe import ranks_of
from idtrail.llm.common import arrow_schema, ids_and_texts
from idtrail.session import staged

SPECIAL = "<|endoftext|>"
END = 1
SLICE = 500
VOCABULARY = 1 << 16
COUNTED = np.dtype([("id", "<u2"), ("n", "<u4")])
IDS = "place long, doc_id long, doc_tokens long, full binary, tail binary, counted binary"
DEALT = "place long, doc_id long, doc_tokens long, full binary, tail binary, leaf int, lead int"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=1)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str, pattern: str):
    """Text to ids. The rank file is the same vocabulary and splits alike, five times as fast; a text that holds a special
    token's string goes through the tokenizer itself, which knows that token and is read when it is first needed."""
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks_of(ranks), special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def slices(batches, rows: int = SLICE):
    """The batches in parts of at most ``rows`` rows: what a worker makes of them, and what Spark gets back at once, stays small."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def tokenized(docs: DataFrame, window: int, path: str, ranks: str, pattern: str) -> DataFrame:
    """For each document: how many ids, the checksums of its whole windows, and the ids behind them. Written once.

    Each task adds a row with ``counted``: in how many of its whole documents each id occurs.
    """
    arrow = arrow_schema(IDS)

    def run(batches):
        encode, task, n = None, TaskContext.get().partitionId(), 0
        found = np.zeros(VOCABULARY, np.uint32)
        for batch in slices(batches):
            rows = []
            encode = encode or encoder(path, ranks, pattern)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text), np.uint32(END)).astype("<u4")
                if ids.max() >= VOCABULARY:
                    raise ValueError(f"ids of {VOCABULARY} and more are not packed")
                found[ids] += np.uint32(1)  # an id that stands there twice is set to the same number twice
                cut = len(ids) // window * window
                full = [zlib.crc32(ids[a : a + window].tobytes()) for a in range(0, cut, window)]
                rows.append(((task << 32) + n, doc_id, len(ids), np.array(full, "<u4").tobytes(), ids[cut:].astype("<u2").tobytes(), None))
                n += 1
            yield rows_to_batch(rows, arrow)
        at = np.flatnonzero(found)
        counted = np.zeros(len(at), COUNTED)
        counted["id"], counted["n"] = at, found[at]
        yield rows_to_batch([(-1, None, 0, b"", b"", counted.tobytes())], arrow)

    return staged(docs.mapInArrow(run, IDS))


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def document_counts(rows: DataFrame) -> np.ndarray:
    """In how many whole documents each id occurs. One number for each id of the vocabulary."""
    wire = arrow_schema("id int, n long")

    def tell(batches):
        for batch in batches:
            for told in batch.column("counted").to_pylist():
                counted = np.frombuffer(told, COUNTED)
                yield pa.RecordBatch.from_arrays([pa.array(counted["id"], pa.int32()), pa.array(counted["n"], pa.int64())], schema=wire)

    counts = np.zeros(VOCABULARY, np.int64)
    told = rows.where("counted is not null").select("counted").mapInArrow(tell, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in told.collect():  # at most one row for each id of the vocabulary
        counts[row.id] = row.n
    return counts


@lru_cache(maxsize=1)
def directions(size: int) -> np.ndarray:
    """A fixed random direction for each id."""
    return np.random.default_rng(7).standard_normal((VOCABULARY, size), np.float32)


@lru_cache(maxsize=1)
def places() -> np.ndarray:
    return np.zeros(VOCABULARY, np.int32)


def distinct(ids: np.ndarray) -> np.ndarray:
    """The different ids in ``ids``, without a sort: of each the place that was written last."""
    last, at = places(), np.arange(len(ids), dtype=np.int32)
    last[ids] = at
    return ids[last[ids] == at]


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in ``ids`` and how often each stands there, likewise."""
    last, at = places(), np.arange(len(ids), dtype=np.int32)
    last[ids] = at
    which = last[ids]
    keep = which == at
    return ids[keep], np.bincount(which, minlength=len(ids))[keep]


def vector(found: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Projection of the distinct ids of a tail; length one."""
    out = weight[found] @ directions(size)[found]
    return out / max(float(np.linalg.norm(out)), 1e-9)


def halves(vectors: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, float]]:
    """Node (root 1, below ``n`` are ``2n`` and ``2n + 1``) to its direction of greatest spread and the median along it."""
    cuts = {}

    def cut(node: int, rows: np.ndarray) -> None:
        if node >> depth or len(rows) < 4:
            return
        _, axes = np.linalg.eigh(np.cov(rows.T))
        along = rows @ axes[:, -1]
        middle = float(np.median(along))
        cuts[node] = axes[:, -1].astype(np.float32), middle
        cut(2 * node, rows[along <= middle])
        cut(2 * node + 1, rows[along > middle])

    cut(1, vectors)
    return cuts


def leaf_of(found: np.ndarray, cuts: dict[int, tuple[np.ndarray, float]], depth: int) -> int:
    node = 1
    while node in cuts:
        axis, middle = cuts[node]
        node = 2 * node + (float(found @ axis) > middle)
    return node << (depth + 1 - node.bit_length())


def lots(idf: np.ndarray) -> np.ndarray:
    """A fixed draw for each id, smaller for rare ones. The least of a tail's ids is alike for tails with most of their ids in common."""
    lot = np.random.default_rng(11).random(VOCABULARY)
    return -np.log1p(-lot) / np.maximum(idf, 1e-9)


def dealt(rows: DataFrame, idf: np.ndarray, documents: int, sample: int, size: int = 128, depth: int = 8) -> DataFrame:
    """``rows`` with ``leaf`` and ``lead``: documents that are alike are near each other in this order.

    The leaf is one of a tree of halves, fitted on about ``sample`` documents, chosen by a hash of their place; all are put into it. The
    weight of an id is the square of how rare it is. Written once, as ranges are drawn from it first.
    """
    weight, draw = idf**2, lots(idf)
    step = max(1, -(-documents // sample))
    wire = arrow_schema("vector binary")

    def project(batches):
        for batch in slices(batches):
            told = [vector(distinct(np.frombuffer(tail, "<u2")), weight, size).tobytes() for tail in batch.column("tail").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(told, pa.binary())], schema=wire)

    chosen = rows.where(F.pmod(F.xxhash64("place"), F.lit(step)) == 0).select("tail").mapInArrow(project, "vector binary").collect()
    vectors = np.frombuffer(b"".join(bytes(r.vector) for r in chosen), np.float32).reshape(-1, size)
    cuts = halves(vectors[np.lexsort(vectors.T)], depth)
    out = arrow_schema(DEALT)

    def deal(batches):
        for batch in slices(batches):
            ids = [distinct(np.frombuffer(tail, "<u2")) for tail in batch.column("tail").to_pylist()]
            leaves = pa.array([leaf_of(vector(found, weight, size), cuts, depth) for found in ids], pa.int32())
            leads = pa.array([int(found[np.argmin(draw[found])]) if len(found) else -1 for found in ids], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], leaves, leads], schema=out)

    return staged(rows.select("place", "doc_id", "doc_tokens", "full", "tail").mapInArrow(deal, DEALT))


class Index:
    """BM25 postings of one shard: for each id, the documents that hold it and what it adds to their score.

    Ids that an eighth of the documents have are kept as one row of scores over all documents.
    """

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75) -> None:
        found = [counted(t) for t in tails]
        sizes = [len(x) for x, _ in found]
        n = len(tails)
        doc = np.repeat(np.arange(n, dtype=np.int32), sizes)
        term = np.concatenate([x for x, _ in found]).astype(np.int32) if found else np.zeros(0, np.int32)
        tf = np.concatenate([x for _, x in found]).astype(np.float32) if found else np.zeros(0, np.float32)
        length = np.array([len(t) for t in tails], np.float32)
        norm = (k1 * (1 - b + b * length / max(mean, 1e-9))).astype(np.float32)
        order = np.argsort(term, kind="stable")
        doc, term, tf = doc[order], term[order], tf[order]
        weight = idf[term] * tf * np.float32(k1 + 1) / (tf + norm[doc])
        held = np.bincount(term, minlength=VOCABULARY)
        often = np.flatnonzero(held * 8 > n)
        self.row = np.full(VOCABULARY, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.common = np.zeros((len(often), n), np.float32)
        common = self.row[term] >= 0
        self.common[self.row[term[common]], doc[common]] = weight[common]
        self.doc, self.weight, term = doc[~common], weight[~common], term[~common]
        self.start = np.searchsorted(term, np.arange(VOCABULARY + 1))
        self.terms, self.n = [x for x, _ in found], n

    def scores(self, seed: int) -> np.ndarray:
        """Scores of all documents for all ids of ``seed``."""
        terms = self.terms[seed].astype(np.int64)
        row = self.row[terms]
        wanted = np.zeros(len(self.common), np.float32)
        wanted[row[row >= 0]] = 1
        rare = terms[row < 0]
        begin = self.start[rare]
        sizes = self.start[rare + 1] - begin
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return wanted @ self.common + np.bincount(self.doc[at], self.weight[at], self.n)


def best_first(scores: np.ndarray, first: int = 64):
    """Places of positive scores, best first, ties by place."""
    n = int((scores > 0).sum())
    if n > first:
        bound = np.partition(scores, len(scores) - first)[len(scores) - first]
        near = np.flatnonzero(scores >= bound)
        near = near[np.argsort(-scores[near], kind="stable")]
        yield from near.tolist()
        rest = np.flatnonzero((scores < bound) & (scores > 0))
    else:
        rest = np.flatnonzero(scores > 0)
    yield from rest[np.argsort(-scores[rest], kind="stable")].tolist()


def fill(tails: list[np.ndarray], index: Index, window: int):
    """Sequences as lists of ``(document, from, to)`` over tails; every id is in one piece.

    The longest unused document is the next seed; its best unused neighbours follow, ties and documents without a common term
    by place. The last is cut where the window ends and its rest waits on. When the shard is used up, what is left of the last
    window becomes sequences of powers of two, which need no padding.
    """
    used = np.array([len(t) == 0 for t in tails], bool)
    begin = np.zeros(len(tails), np.int64)
    order = sorted(range(len(tails)), key=lambda i: -len(tails[i]))
    at, room, current = 0, window, []
    spare = [i for i in range(len(tails)) if not used[i]]
    while True:
        while at < len(order) and used[order[at]]:
            at += 1
        if at == len(order):
            break
        seed = order[at]
        scores = index.scores(seed)
        scores[used] = -1
        scores[seed] = np.inf
        for i in chain(best_first(scores), [-1]):
            if i < 0:  # no neighbour is left: the next unused documents, in their order
                spare = [k for k in spare if not used[k]]
                rest = spare
            else:
                rest = [i]
            for k in rest:
                take = min(room, len(tails[k]) - begin[k])
                current.append((k, int(begin[k]), int(begin[k] + take)))
                begin[k] += take
                room -= take
                used[k] = begin[k] == len(tails[k])
                if not room:
                    break
            if not room:
                break
        if room:
            break
        yield current
        room, current = window, []
    left = sum(b - a for _, a, b in current)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            k, a, b = current[0]
            take = min(size, b - a)
            part.append((k, a, a + take))
            size -= take
            if a + take == b:
                current.pop(0)
            else:
                current[0] = (k, a + take, b)
        yield part


def pack(
    docs: DataFrame, path: str, ranks: str, pattern: str, window: int = 2048, shard: int = 4096, sample: int = 16384,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of all rows of ``docs``.

    A document is its ids and an end id. Whole windows of long documents are sequences of their own; what is left is put in an order by
    content (:func:`dealt`) and cut into shards of about ``shard`` documents (less than twice that), so that documents which are alike
    meet in one. Each has an inverted index of all ids. Document counts behind the scores are those of whole documents, all of them.
    BM25 neighbours, by all ids of the seed, that are not used yet fill the window of each seed.

    The order is fitted on about ``sample`` documents. It is sorted by place last, so copies of one document don't end in one task.

    No sequence needs padding: all have ``window`` ids or a power of two. Null or empty text: the end id alone. Null ids and
    repeated rows are documents of their own. Empty table: no rows. Other columns are not read. The result is a written table, as
    ranges are drawn anew each time.
    """
    told = tokenized(ids_and_texts(docs, id_col, text_col), window, path, ranks, pattern)
    rows = told.where("counted is null")
    tail = F.length("tail")
    facts = rows.agg(F.count("*").alias("n"), F.avg(F.when(tail > 0, tail / 2)).alias("mean")).first()
    counts = document_counts(told)
    idf = np.log(1 + (facts.n - counts + 0.5) / (counts + 0.5)).astype(np.float32)
    mean = facts.mean or 1.0
    shards = max(1, -(-facts.n // shard))
    parts = min(shards, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards // 64)))
    out = arrow_schema(PIECES)

    def packed(group: list[tuple], number: int) -> tuple[pa.RecordBatch, int]:
        tails = [np.frombuffer(row[4], "<u2") for row in group]
        pieces = []
        for _, doc_id, size, full, _ in group:
            for j, crc in enumerate(np.frombuffer(full, "<u4").tolist()):
                pieces.append((doc_id, j * window, window, crc, size, number, 0))
                number += 1
        for sequence in fill(tails, Index(tails, idf, mean), window):
            offset = 0
            for k, a, b in sequence:
                crc = zlib.crc32(tails[k][a:b].astype("<u4").tobytes())
                _, doc_id, size, _, _ = group[k]
                pieces.append((doc_id, size - len(tails[k]) + a, b - a, crc, size, number, offset))
                offset += b - a
            number += 1
        return rows_to_batch(pieces, out), number

    def run(batches):
        waiting, number = [], TaskContext.get().partitionId() << 32
        for batch in batches:
            waiting += zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            while len(waiting) >= 2 * shard:
                done, number = packed(waiting[:shard], number)
                waiting = waiting[shard:]
                yield done
        if waiting:
            yield packed(waiting, number)[0]

    order = ("leaf", "lead", "place")
    near = dealt(rows, idf, facts.n, sample).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return staged(near.mapInArrow(run, PIECES))
