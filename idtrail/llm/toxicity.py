"""Toxicity: averaged subword embeddings under a linear softmax, trained together in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idtrail.llm.common import arrow_schema, ids_and_texts

BUCKETS = 1 << 17
PUNCTUATION = bytes.maketrans(b".,;:!?\"()[]{}|", b" " * 14)


LONG = 64  # bytes; a longer word is hardly met twice
BLOCK = 1 << 16
CRC = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint32)  # crc32 of one byte
STEP = (CRC ^ CRC[0]).astype(np.uint32)  # the table of crc32: the step of the register by its low byte


def subwords(word: bytes) -> list[int]:
    """Buckets of a word with its ends and of its pieces of 3 to 5 code points, over the whole word."""
    marked = f"<{word.decode('utf-8', 'replace')}>"
    found = [zlib.crc32(word) % BUCKETS]
    n = len(marked)
    for size in (3, 4, 5):
        found += [zlib.crc32(marked[i : i + size].encode()) % BUCKETS for i in range(n - size + 1)]
    return found


def pieces(word: bytes) -> Iterator[np.ndarray]:
    """:func:`subwords` of a long word (text without blanks), in blocks: crc32 of all pieces, a byte of each at a time."""
    yield np.array([zlib.crc32(word) % BUCKETS], np.int32)
    marked = np.frombuffer(f"<{word.decode('utf-8', 'replace')}>".encode(), np.uint8)
    starts = np.append(np.flatnonzero((marked & 0xC0) != 0x80), len(marked))  # where code points begin, and the end
    for size in (3, 4, 5):
        for at in range(0, len(starts) - size, BLOCK):
            a = starts[at : min(at + BLOCK, len(starts) - size)]
            lengths = starts[at + size : at + size + len(a)] - a
            state = np.full(len(a), 0xFFFFFFFF, np.uint32)
            for k in range(int(lengths.max())):
                on = lengths > k
                old = state[on]
                state[on] = (old >> np.uint32(8)) ^ STEP[(old & np.uint32(0xFF)) ^ marked[a[on] + k]]
            yield ((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS)).astype(np.int32)


def words(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(PUNCTUATION).split()


def features(text: bytes, cache: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's bag and how often each occurs."""
    lists = []
    for word in words(text):
        if len(word) > LONG:
            for block in pieces(word):
                lists.append(block)
            continue
        got = cache.get(word)
        if got is None:
            if len(cache) > 300_000:
                cache.clear()
            got = cache[word] = np.array(subwords(word), np.int32)
        lists.append(got)
    if not lists:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    ids, counts = np.unique(np.concatenate(lists), return_counts=True)
    return ids.astype(np.int32), counts.astype(np.int32)


def packed(bag: tuple[np.ndarray, np.ndarray]) -> bytes:
    """A bag in few bytes: steps between buckets and counts are small numbers."""
    return zstandard.compress(np.concatenate((np.diff(bag[0], prepend=0), bag[1])).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()
    steps, counts = np.split(both, 2)
    return np.cumsum(steps, dtype=np.int32), (counts / max(1, counts.sum())).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray, int, float]], size: int = 8, steps: int = 1200, batch: int = 64, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weight of each bucket for class 1 over class 0, and the bias, from ``(buckets, shares, label, weight)``.

    ``steps``: minibatches in all, within 8 to 200 passes over the rows. Embeddings E and softmax weights V are trained together by Adagrad on minibatches. As the model is linear in the averaged
    embedding, E (v1 - v0) is all that scoring needs.
    """
    rng = np.random.default_rng(seed)
    rows = [r for r in rows if len(r[0])]
    if not rows:
        return np.zeros(BUCKETS, np.float32), 0.0
    table = rng.uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32)
    out, bias = rng.uniform(-1 / size, 1 / size, (size, 2)), np.zeros(2)
    out_sum, bias_sum, table_sum = np.full((size, 2), 1e-3), np.full(2, 1e-3), np.full(BUCKETS, 1e-6)
    for _ in range(max(8, min(200, steps * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = [rows[i] for i in order[at : at + batch]]
            ids = np.concatenate([r[0] for r in part])
            share = np.concatenate([r[1] for r in part])
            starts = np.cumsum([0, *[len(r[0]) for r in part[:-1]]])
            hidden = np.add.reduceat(table[ids] * share[:, None], starts, axis=0)
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), [r[2] for r in part]] -= 1
            p *= np.array([r[3] for r in part])[:, None] / len(part)
            d_out, d_bias, d_hidden = hidden.T @ p, p.sum(0), p @ out.T
            out_sum += d_out**2
            bias_sum += d_bias**2
            out -= rate / 5 * d_out / np.sqrt(out_sum)
            bias -= rate / 5 * d_bias / np.sqrt(bias_sum)
            own = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
            unique, back = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(back, share * d_hidden[own, j], len(unique)) for j in range(size)], axis=1)
            table_sum[unique] += (grad**2).mean(1)
            table[unique] -= (rate * grad / np.sqrt(table_sum[unique])[:, None]).astype(np.float32)
    return (table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, max_toxic: int = 2500) -> tuple[np.ndarray, float]:
    """The model, from at most ``max_toxic`` toxic and ``max_rows`` labelled rows in all outside the held-out fold.

    The sample is the rows with the smallest hash of id, so it is the same in every run; class weights restore the classes'
    shares among all labelled rows. Features are made on the executors; the driver gets the bags of the sample only.
    """
    labelled = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    labelled = labelled.where("label_id is not null").where(~held_out(F.col("label_id")))
    shares = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64("label_id", F.lit(17)), F.col("label_id"))
    toxic = labelled.where("toxic = 1").orderBy(*order).limit(max_toxic)
    clean = labelled.where("toxic = 0").orderBy(*order).limit(max_rows - max_toxic)
    chosen = toxic.unionByName(clean)  # at most max_rows pairs of numbers: a size that is known
    picked = docs.join(F.broadcast(chosen), docs.doc_id == chosen.label_id).select("doc_id", "text", "toxic")
    schema = "doc_id long, toxic int, bag binary"
    arrow = arrow_schema(schema)

    def bags(batches):
        cache: dict[bytes, np.ndarray] = {}
        for batch in batches:
            found = [packed(features(x, cache)) for x in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array(found, pa.binary())], schema=arrow
            )

    got = sorted(picked.mapInArrow(bags, schema).dropDuplicates(["doc_id"]).collect(), key=lambda r: r.doc_id)
    sampled = {0: sum(r.toxic == 0 for r in got), 1: sum(r.toxic == 1 for r in got)}
    total = max(1, sum(shares.values()))
    weight = {c: shares.get(c, 0) / total * len(got) / max(1, sampled[c]) for c in (0, 1)}
    return train([(*unpacked(r.bag), r.toxic, weight[r.toxic]) for r in got])


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    A text's score is the softmax over the average of its subword embeddings, over the whole text: a sum of one number a word,
    so a word is worked out once a task. Misspelt words share pieces with known ones. Null or empty text: the bias alone.
    Null id: not held out, never a training row. Without usable labels every score is 0.5. Repeated rows each come out; a label
    that is there twice counts once, toxic if any says so. Empty table: no rows.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    weights, bias = fit(rows, labels, **options)
    schema = "doc_id long, score double"
    arrow = arrow_schema(schema)

    def run(batches):
        cache: dict[bytes, tuple[float, int]] = {}
        for batch in batches:
            scores = []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                total, n = 0.0, 0
                for word in words(text):
                    if len(word) > LONG:
                        for ids in pieces(word):
                            total += float(weights[ids].sum(dtype=np.float64))
                            n += len(ids)
                        continue
                    got = cache.get(word)
                    if got is None:
                        if len(cache) > 1_000_000:
                            cache.clear()
                        ids = subwords(word)
                        got = cache[word] = (float(weights[ids].sum(dtype=np.float64)), len(ids))
                    total += got[0]
                    n += got[1]
                scores.append(1 / (1 + np.exp(-np.clip(bias + total / max(1, n), -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], schema=arrow)

    return rows.mapInArrow(run, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
