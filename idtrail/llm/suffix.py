"""Repeated byte strings across documents, by enhanced suffix arrays over sampled positions.

A full suffix array of a corpus has an entry for each byte. Here only *anchors* have one: in each window of ``window`` bytes,
the leftmost of the least-hashed ``gram``-byte strings. Which one it is depends on the window's bytes alone, so two equal windows
have equal anchors at equal places, and comparing the anchors' surroundings finds every repeat of ``window`` bytes or more.

1. ``packs``: documents are written once in compressed packs; exact copies are known by their SHA-256 from then on.
2. Anchor hashes go, a blob for each pack and hash range, to where those that occur in several documents are told. Of those, the
   hashes of what stands around them (their contexts) do the same, which leaves few that are equal by chance.
3. Each pack gives the surroundings of such contexts, each different text once, to the task of the anchor's hash range.
4. There, suffix array, common prefixes and a stack scan make the interval tree; intervals are split where what stands left of
   the suffixes differs, and each part of an interval knows the first document it occurs in.
5. Each pack marks its windows that an earlier document has and sums its documents up.

What goes from step to step is a table, and what was shuffled for it is deleted when it is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idtrail.llm.common import arrow_schema, ids_and_texts
from idtrail.session import staged

GRAM = 20
LAST = 2**63 - 1
MASK = (1 << 64) - 1
MULTIPLIER = 0xD1342543DE82EF95
CHUNK = 1 << 16
STEP = 4
PACKS = "pack long, ids binary, lengths binary, hashes binary, body binary"
NOTES = "pack long, kind int, part int, body binary"
REPEATED, COPIES, ORIGINS, FLAGS, CONTEXTS = range(5)


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal weight stand together, which is what makes them small."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a)
        planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
        out.append(f"{raw.dtype.str}:{len(raw)};".encode() + planes)
    sizes = np.array([len(x) for x in out], np.int64).tobytes()
    return zstandard.compress(bytes([len(out)]) + sizes + b"".join(out), 3)


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n, at, found = raw[0], 1 + 8 * raw[0], []
    for size in np.frombuffer(raw, np.int64, n, 1).tolist():
        stop = raw.index(b";", at)
        kind, length = raw[at:stop].decode().split(":")
        dtype = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, size - (stop + 1 - at), stop + 1)
        found.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, int(length)).T).reshape(-1).view(dtype))
        at += size
    return found


def rising(values: np.ndarray) -> np.ndarray:
    """Steps of a sorted array; they are small numbers."""
    return np.diff(values, prepend=values.dtype.type(0))


def packs(docs: DataFrame, pack_bytes: int) -> DataFrame:
    """``ids_and_texts`` rows in packs of about ``pack_bytes`` of text, written to shared storage."""
    arrow = arrow_schema(PACKS)

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
                ids.append(LAST if doc_id is None else doc_id)
                texts.append(text)
                size += len(text)
                if size >= pack_bytes:
                    yield packed((task << 32) + n, ids, texts)
                    n, ids, texts, size = n + 1, [], [], 0
        if ids:
            yield packed((task << 32) + n, ids, texts)

    def packed(pack, ids, texts):
        lengths = np.array([len(t) for t in texts], np.int64)
        hashes = b"".join(hashlib.sha256(t).digest() for t in texts)
        row = [[pack], [squeeze(np.array(ids, np.int64))], [squeeze(lengths)], [hashes], [zstandard.compress(b"".join(texts), 3)]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, arrow.types, strict=True)], schema=arrow)

    return staged(docs.mapInArrow(run, PACKS))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of the ``gram`` bytes from each position on; the last ``gram - 1`` positions have none."""
    power = data.astype(np.uint64) + np.uint64(1)
    done, covered, size = None, 0, 1
    while True:
        if gram & size:
            if done is None:
                done, covered = power, size
            else:
                n = len(done) - size
                done, covered = done[:n] * np.uint64(pow(MULTIPLIER, size, 1 << 64)) + power[covered : covered + n], covered + size
        if size * 2 > gram:
            break
        power = power[: len(power) - size] * np.uint64(pow(MULTIPLIER, size, 1 << 64)) + power[size:]
        size *= 2
    done = done[: len(data) - gram + 1]
    done = done ^ (done >> np.uint64(31))
    done *= np.uint64(0x9E3779B97F4A7C15)
    return done ^ (done >> np.uint64(29))


def anchors(data: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor positions, their hashes, and the first and last window start that each serves; windows stay within a document."""
    width = window - gram + 1
    starts = np.concatenate(([0], ends[:-1]))
    edge = np.zeros(len(data) + 1, np.int32)
    fits = ends - starts >= window
    np.add.at(edge, starts[fits], 1)
    np.add.at(edge, ends[fits] - window + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    found = []
    low = np.uint64((1 << 17) - 1)
    for at in range(0, max(0, len(data) - window + 1), CHUNK):
        own = np.flatnonzero(valid[at : at + CHUNK])
        if not len(own):
            continue
        h = gram_hashes(data[at : at + CHUNK + window - 1], gram)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        reach = 1
        while reach * 2 <= width:
            least = np.minimum(least[: len(least) - reach], least[reach:])
            reach *= 2
        rest = width - reach
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        spot = (least[own] & low).astype(np.int64)
        new = np.ones(len(own), bool)
        new[1:] = (spot[1:] != spot[:-1]) | (own[1:] != own[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(own)) - 1
        found.append((spot[first] + at, h[spot[first]], own[first] + at, own[last] + at))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, h, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    joined = np.zeros(len(place), bool)  # a run that goes on in the next chunk
    joined[1:] = (place[1:] == place[:-1]) & (a[1:] == b[:-1] + 1)
    keep = np.flatnonzero(~joined)
    return place[keep], h[keep], a[keep], b[np.append(keep[1:], len(place)) - 1]


def range_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, document ends and document ids of a pack."""
    lengths = unsqueeze(row["lengths"])[0]
    return np.frombuffer(zstandard.decompress(row["body"]), np.uint8), np.cumsum(lengths), unsqueeze(row["ids"])[0]


def rows_to_arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def by_range(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    values, first = np.unique(part[order], return_index=True)
    for value, a, b in zip(values.tolist(), first, np.append(first[1:], len(order)), strict=True):
        yield value, order[a:b]


WIRE = "part int, pack long, once binary, often binary"


def hashes_by_range(pack: int, h: np.ndarray, doc: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each hash range: which hashes one document of the pack has, and which several."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, count = np.unique(h[keep], return_counts=True)
    rows = []
    for part, at in by_range(range_of(h, parts)):
        low, many = (h[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32), count[at] > 1
        once, often = np.unique(low[~many]), np.unique(low[many])
        rows.append((part, pack, squeeze(rising(once)), squeeze(rising(often))))
    return rows_to_arrow(rows, arrow_schema(WIRE))


def met(told: DataFrame, kind: int, hot_packs: int) -> DataFrame:
    """Notes for each pack and hash range: which of the pack's hashes occur in several documents, and which in ``hot_packs`` packs."""
    out = arrow_schema(NOTES)

    def meet(group: pa.Table) -> pa.Table:
        rows, lists, many = group.select(["part", "pack"]).to_pylist(), [], []
        for once, often in zip(group.column("once").to_pylist(), group.column("often").to_pylist(), strict=True):
            once, often = (np.cumsum(unsqueeze(x)[0], dtype=np.uint32) for x in (once, often))
            lists.append(np.union1d(once, often))
            many.append(often)
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        many = np.unique(np.concatenate([values[counts > 1], *many]))
        hot = np.isin(many, values[counts >= hot_packs]).astype(np.uint8)
        notes = []
        for row, own in zip(rows, lists, strict=True):
            at = np.searchsorted(many, own)
            at = at[many[np.minimum(at, len(many) - 1)] == own] if len(many) else at[:0]
            if len(at):
                notes.append((row["pack"], kind, row["part"], squeeze(rising(many[at]), hot[at])))
        return pa.Table.from_batches([rows_to_arrow(notes, out)])

    return told.groupBy("part").applyInArrow(meet, NOTES)


def repeated_anchors(packed: DataFrame, window: int, gram: int, parts: int, hot_packs: int) -> DataFrame:
    """Notes of the anchor hashes that several documents have."""

    def tell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, ends, _ = opened(row)
                place, h, _, _ = anchors(data, ends, window, gram)
                yield hashes_by_range(row["pack"], h, np.searchsorted(ends, place, "right"), parts)

    return met(packed.select("pack", "ids", "lengths", "body").mapInArrow(tell, WIRE), REPEATED, hot_packs)


def copies(packed: DataFrame) -> DataFrame:
    """Notes for each pack: its documents whose whole text a document with a smaller id has, and that id is not null."""
    wire = arrow_schema("hash binary, doc_id long, pack long, place int")

    def tell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, hashes = unsqueeze(row["ids"])[0].tolist(), row["hashes"]
                yield rows_to_arrow([(hashes[32 * i : 32 * i + 32], x, row["pack"], i) for i, x in enumerate(ids)], wire)

    rows = packed.select("pack", "ids", "hashes").mapInArrow(tell, "hash binary, doc_id long, pack long, place int")
    # read as a table, so that the join may split the rows of a hot text
    first = staged(rows.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"))
    out = arrow_schema(NOTES)

    def note(group: pa.Table) -> pa.Table:
        places = np.sort(group.column("place").to_numpy()).astype(np.int32)
        return pa.Table.from_batches([rows_to_arrow([(group.column("pack")[0].as_py(), COPIES, 0, squeeze(places))], out)])

    return rows.join(first, "hash").where("doc_id > first").select("pack", "place").groupBy("pack").applyInArrow(note, NOTES)


def notes_of(table: pa.Table, kind: int) -> list[tuple[int, list[np.ndarray]]]:
    kinds, parts, bodies = (table.column(c).to_pylist() for c in ("kind", "part", "body"))
    return [(p, unsqueeze(b)) for k, p, b in zip(kinds, parts, bodies, strict=True) if k == kind]


def noted_hashes(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted range-and-hash keys of a pack's notes, and which of them are hot."""
    noted = [((np.uint64(p) << np.uint64(32)) | np.cumsum(low, dtype=np.uint32).astype(np.uint64), hot) for p, (low, hot) in notes_of(table, kind)]
    if not noted:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    known, hot = (np.concatenate(x) for x in zip(*noted, strict=True))
    order = np.argsort(known)
    return known[order], hot[order].astype(bool)


def told_of(h: np.ndarray, parts: int, known: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes are noted, and which of them as hot."""
    if not len(known):
        return np.zeros(len(h), bool), np.zeros(len(h), bool)
    key = (range_of(h, parts).astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    found = known[at] == key
    return found, found & hot[at]


def string_hashes(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Mixed polynomial hash of the ``size`` bytes from each of some places on."""
    done = np.zeros(len(start), np.uint64)
    for i in range(size):
        done = (done + data[start + i] + np.uint64(1)) * np.uint64(MULTIPLIER)
    done = done ^ (done >> np.uint64(31))
    done *= np.uint64(0x9E3779B97F4A7C15)
    return done ^ (done >> np.uint64(29))


class Candidates:
    """A pack's repeated anchors, copies left out, and the two contexts of each.

    A window that starts ``lead`` bytes or more before its anchor holds these bytes and the anchor: its *left* context. All other
    windows hold the anchor and what follows it up to ``window - lead + 1`` bytes: their *right* context. So windows are equal only
    if their contexts are, which are nearly twice as long as an anchor and far seldomer equal by chance.
    """

    def __init__(self, row: dict, notes: pa.Table, window: int, gram: int, parts: int) -> None:
        self.data, self.ends, self.ids = opened(row)
        place, h, a, b = anchors(self.data, self.ends, window, gram)
        doc = np.searchsorted(self.ends, place, "right")
        keep, hot = told_of(h, parts, *noted_hashes(notes, REPEATED))
        skipped = np.zeros(len(self.ends), bool)
        for _, (places,) in notes_of(notes, COPIES):
            skipped[places] = True
        keep &= ~skipped[doc]
        self.place, self.h, self.a, self.b, self.doc, self.hot = place[keep], h[keep], a[keep], b[keep], doc[keep], hot[keep]
        lead = (window - gram) // 2
        #: last window start of the left and first of the right context
        self.turn = self.place - lead
        self.sides = np.flatnonzero(self.a <= self.turn), np.flatnonzero(self.b > self.turn)
        left, right = self.sides
        self.hashes = string_hashes(self.data, self.turn[left], lead + gram), string_hashes(self.data, self.place[right], window - lead + 1)


def repeated_contexts(texts: DataFrame, noted: DataFrame, window: int, gram: int, parts: int, hot_packs: int) -> DataFrame:
    """Notes of the contexts of repeated anchors that several documents have."""
    wire = arrow_schema(WIRE)

    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return wire.empty_table()
        row = left.to_pylist()[0]
        found = Candidates(row, right, window, gram, parts)
        h, doc = np.concatenate(found.hashes), np.concatenate([found.doc[side] for side in found.sides])
        return pa.Table.from_batches([hashes_by_range(row["pack"], h, doc, parts)])

    return met(texts.groupBy("pack").cogroup(noted.groupBy("pack")).applyInArrow(tell, WIRE), CONTEXTS, hot_packs)


def surroundings(window: int, gram: int, parts: int):
    """For a pack and its notes: origin rows (for itself) and the different surroundings of its repeated anchors by hash range.

    Surroundings hold the windows of repeated contexts only. Those of an anchor that many packs have go, one text for each context,
    to where the context says. If many packs have that too, they go in texts of up to ``STEP`` windows to where the bytes say that these share.
    """
    out = arrow_schema(NOTES)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        row = left.to_pylist()[0]
        found = Candidates(row, right, window, gram, parts)
        data, ids, turn, contexts = found.data, found.ids, found.turn, noted_hashes(right, CONTEXTS)
        kept, spread, key = np.zeros((2, len(turn)), bool), np.zeros((2, len(turn)), bool), np.zeros((2, len(turn)), np.uint64)
        for side, (at, h) in enumerate(zip(found.sides, found.hashes, strict=True)):
            kept[side, at], spread[side, at] = told_of(h, parts, *contexts)
            key[side, at] = h
        a, b = (found.a, np.maximum(found.a, turn + 1)), (np.minimum(found.b, turn), found.b)
        one = np.flatnonzero(~found.hot & kept.any(axis=0))
        runs = [(one, np.where(kept[0], a[0], a[1])[one], np.where(kept[1], b[1], b[0])[one], found.h[one], np.zeros(len(one), bool))]
        for side in range(2):
            at = np.flatnonzero(found.hot & kept[side])
            runs.append((at, a[side][at], b[side][at], key[side, at], spread[side, at]))
        own, a, b, h, wide = (np.concatenate(x) for x in zip(*runs, strict=True))
        order = np.argsort(a, kind="stable")
        own, a, b, part, wide = own[order], a[order], b[order], range_of(h[order], parts), wide[order]
        if wide.any():
            lead = found.place[own] - a, found.place[own] - b
            n = np.where(wide, lead[0] // STEP - lead[1] // STEP + 1, 1)
            by = np.repeat(np.arange(len(a)), n)
            nth = np.arange(len(by)) - np.repeat(np.cumsum(n) - n, n)
            own, a, b, part, wide = own[by], a[by], b[by], part[by], wide[by]
            core = found.place[own] - (lead[0][by] // STEP - nth) * STEP  # the last window start of the step
            a, b = np.where(wide, np.maximum(a, core - STEP + 1), a), np.where(wide, np.minimum(b, core), b)
            part[wide] = range_of(string_hashes(data, core[wide], window - STEP + 1), parts)
        place, doc = found.place[own], found.doc[own]
        whole, seen, texts, which = data.tobytes(), {}, [], []
        for x, y in zip(a.tolist(), (b + window).tolist(), strict=True):
            text = whole[x:y]
            k = seen.get(text)
            if k is None:
                k = seen[text] = len(texts)
                texts.append(text)
            which.append(k)
        if not texts:
            return out.empty_table()
        which = np.array(which, np.int64)
        first = np.full(len(texts), LAST)
        last = np.full(len(texts), -(2**63))
        np.minimum.at(first, which, ids[doc])
        np.maximum.at(last, which, ids[doc])
        _, lead = np.unique(which, return_index=True)
        offset, part = (place - a)[lead].astype(np.uint8), part[lead]
        rows = [(row["pack"], ORIGINS, -1, squeeze(which.astype(np.int32), rising(a), doc.astype(np.int32)))]
        for p, k in by_range(part):
            own = [texts[i] for i in k.tolist()]
            body = squeeze(
                k.astype(np.int32), np.array([len(t) for t in own], np.uint8), offset[k], first[k], last[k] - first[k],
            )
            packed_text = zstandard.compress(b"".join(own), 3)
            rows.append((row["pack"], FLAGS, p, len(body).to_bytes(8, "little") + body + packed_text))
        return pa.Table.from_batches([rows_to_arrow(rows, out)])

    return run


def intervals(lcp: np.ndarray, least: int) -> np.ndarray:
    """Nodes ``(first, end, depth, depth of parent)`` of the interval tree over suffixes with common prefixes of ``least`` or more.

    ``lcp[i]`` is what suffix ``i`` shares with the one before; the stack holds the open intervals from wide to narrow.
    """
    out, stack = [], []
    for i, depth in enumerate([*lcp.tolist(), least - 1]):
        left = i - 1
        while stack and stack[-1][1] > depth:
            left, own = stack.pop()
            outer = max(depth, stack[-1][1] if stack else 0)
            out.append((left, i, own, outer))
        if depth >= least and (not stack or stack[-1][1] < depth):
            stack.append((left, depth))
    return np.array(out, np.int64).reshape(-1, 4)


def padded(body: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """``size`` bytes from ``start`` on (backwards for ``step`` -1) in rows of ``width``, zeros behind."""
    lanes = np.arange(width)
    at = np.minimum(np.maximum(start[:, None] + step * lanes, 0), max(0, len(body) - 1))
    return np.where(lanes < size[:, None], body[at], 0).astype(np.uint8)


def sorted_rows(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order of byte rows; of rows that differ in padding only, the shorter first."""
    by_size = np.argsort(size, kind="stable")
    return by_size[np.argsort(rows[by_size].view(f"S{rows.shape[1]}").ravel(), kind="stable")]


def shared(one: np.ndarray, two: np.ndarray, size_one: np.ndarray, size_two: np.ndarray) -> np.ndarray:
    differs = one != two
    n = np.where(differs.any(axis=1), differs.argmax(axis=1), one.shape[1])
    return np.minimum(n, np.minimum(size_one, size_two))


class Suffixes:
    """The enhanced suffix array of one hash range and its interval tree.

    Row ``i`` is the text after an anchor, with what stands before it; equal surroundings of one pack are one row. ``nodes`` are
    the intervals that hold a window (first row, end, depth, depth of the parent); ``node, member`` pair each with its rows, in the
    order of what stands before them, ``same`` is what a pair shares leftwards with the one before it, ``opens`` marks a node's first.
    """

    def __init__(self, group: pa.Table, window: int, gram: int) -> None:
        numbers, texts, pack_of = [], [], []
        self.packs, self.part, self.width = group.column("pack").to_pylist(), group.column("part")[0].as_py(), window - gram
        for n, blob in enumerate(group.column("body").to_pylist()):
            size = int.from_bytes(blob[:8], "little")
            numbers.append(unsqueeze(blob[8 : 8 + size]))
            texts.append(zstandard.decompress(blob[8 + size :]))
            pack_of.append(np.full(len(numbers[-1][0]), n))
        index, size, offset, first, extra = (np.concatenate(x) for x in zip(*numbers, strict=True))
        pack_of, body = np.concatenate(pack_of), np.frombuffer(b"".join(texts), np.uint8)
        size, offset = size.astype(np.int64), offset.astype(np.int64)
        start, right_size = np.cumsum(size) - size, size - offset
        right = padded(body, start + offset, right_size, window)
        order = sorted_rows(right, right_size)
        right, start = right[order], start[order]
        self.index, self.offset, self.right_size, self.pack_of = (x[order] for x in (index, offset, right_size, pack_of))
        self.first, self.last = first[order], (first + extra)[order]
        self.lcp = np.zeros(len(order), np.int64)
        self.lcp[1:] = shared(right[1:], right[:-1], self.right_size[1:], self.right_size[:-1])
        nodes = intervals(self.lcp, gram)
        low = np.maximum(window - nodes[:, 2], 0)
        high = np.minimum(window - 1 - np.maximum(nodes[:, 3], gram - 1), self.width)
        self.nodes, self.low, self.high = (x[low <= high] for x in (nodes, low, high))
        left = padded(body, start + self.offset - 1, self.offset, max(1, self.width), -1)
        rank = np.empty(len(order), np.int64)
        rank[sorted_rows(left, self.offset)] = np.arange(len(order))
        count = self.nodes[:, 1] - self.nodes[:, 0]
        node = np.repeat(np.arange(len(self.nodes)), count)
        member = np.repeat(self.nodes[:, 0], count) + np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)
        by = np.lexsort((rank[member], node))
        self.node, self.member = node[by], member[by]
        self.same = np.zeros(len(node), np.int64)
        one, two = self.member[1:], self.member[:-1]
        self.same[1:] = shared(left[one], left[two], self.offset[one], self.offset[two])
        self.opens = np.ones(len(node), bool)
        self.opens[1:] = self.node[1:] != self.node[:-1]


def first_documents(window: int, gram: int):
    """For all surroundings of a hash range: for each, the window runs that an earlier document has, and which.

    A window that starts ``l`` bytes before its anchor belongs to the node whose depth is the least that covers ``window - l``. Where
    what precedes the anchors differs within ``l`` bytes (the node is left-diverse there), the node falls into a group for each
    extension.
    """
    out = arrow_schema(NOTES)

    def run(group: pa.Table) -> pa.Table:
        t = Suffixes(group, window, gram)
        found = []
        for l in range(t.width + 1):
            rows = np.flatnonzero((t.low[t.node] <= l) & (l <= t.high[t.node]))
            if not len(rows):
                continue
            own = t.member[rows]
            cut = np.flatnonzero(t.opens[rows] | (t.same[rows] < l))
            earliest = np.minimum.reduceat(t.first[own], cut)
            length = np.diff(np.append(cut, len(rows)))
            earliest, length = np.repeat(earliest, length), np.repeat(length, length)
            flag = (length > 1) & (earliest < t.last[own]) & (t.offset[own] >= l) & (t.right_size[own] >= window - l)
            found.append((own[flag], np.full(int(flag.sum()), l), earliest[flag]))
        # documents of the same surroundings that come later than their own first one
        own = np.flatnonzero(t.first < t.last)
        lows = window - t.right_size[own]
        n = np.maximum(t.offset[own] - lows + 1, 0)
        own, lows = np.repeat(own, n), np.repeat(lows, n)
        found.append((own, lows + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n), t.first[own]))
        own, l, earliest = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(own):
            return out.empty_table()
        by = np.lexsort((earliest, l, own))
        own, l, earliest = own[by], l[by], earliest[by]
        new = np.ones(len(own), bool)  # of several answers for a window, the earliest
        new[1:] = (own[1:] != own[:-1]) | (l[1:] != l[:-1])
        own, l, earliest = own[new], l[new], earliest[new]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (l[1:] != l[:-1] + 1) | (earliest[1:] != earliest[:-1])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(own)) - 1
        own, far, near, earliest = own[a], l[b], l[a], earliest[a]
        rows = []
        for n, at in by_range(t.pack_of[own]):
            spot = own[at]
            rows.append((t.packs[n], FLAGS, t.part, squeeze(
                t.index[spot], (t.offset[spot] - far[at]).astype(np.uint8), (t.offset[spot] - near[at]).astype(np.uint8), earliest[at]
            )))
        return pa.Table.from_batches([rows_to_arrow(rows, out)])

    return run


def range_minimum(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value in each ``values[a:b]``, none of them empty."""
    table = [values]
    while 2 << len(table) <= 2 * len(values):
        reach = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-reach], table[-1][reach:]))
    level = np.frexp((b - a).astype(float))[1] - 1
    out = np.empty(len(a), values.dtype)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << k)])
    return out


def maximal_repeats(window: int, gram: int):
    """For all surroundings of a hash range: maximal repeat groups, as notes to each pack of the members it holds.

    The rows of a node share ``depth`` bytes from the anchor on and no more. The same stack scan over what stands before them gives
    the sets that share so many bytes leftwards and no more: left-diverse, so they can't be extended there. A set is a group if
    its rows are right-diverse too (they don't all lie in one child) and both sides together make a window.
    """
    out = arrow_schema(NOTES)

    def run(group: pa.Table) -> pa.Table:
        t = Suffixes(group, window, gram)
        sets = intervals(np.where(t.opens, -1, t.same), 0) if len(t.node) else np.zeros((0, 4), np.int64)
        depth = t.nodes[t.node[sets[:, 0]], 2]
        length = depth + sets[:, 2]
        if len(sets):
            lo = np.minimum.reduceat(np.append(t.member, 0), sets[:, :2].ravel())[::2]
            hi = np.maximum.reduceat(np.append(t.member, 0), sets[:, :2].ravel())[::2]
            good = (length >= window) & (range_minimum(t.lcp, lo + 1, hi + 1) == depth)
        else:
            good = np.zeros(0, bool)
        sets, length = sets[good], length[good]
        n = sets[:, 1] - sets[:, 0]
        number = np.repeat(np.arange(len(sets)), n)
        own = t.member[np.repeat(sets[:, 0], n) + np.arange(len(number)) - np.repeat(np.cumsum(n) - n, n)]
        begin, length = t.offset[own] - np.repeat(sets[:, 2], n), np.repeat(length, n)
        # surroundings that several documents of one pack have, and no others, are a group by themselves
        alone = t.first < t.last
        alone[own[(begin == 0) & (length == (t.offset + t.right_size)[own])]] = False
        alone = np.flatnonzero(alone)
        number, own = np.append(number, len(sets) + np.arange(len(alone))), np.append(own, alone)
        begin, length = np.append(begin, np.zeros(len(alone), np.int64)), np.append(length, (t.offset + t.right_size)[alone])
        rows = []
        for k, at in by_range(t.pack_of[own]):
            spot = own[at]
            rows.append((t.packs[k], FLAGS, t.part, squeeze(t.index[spot], begin[at].astype(np.uint8), length[at].astype(np.uint8), number[at])))
        return pa.Table.from_batches([rows_to_arrow(rows, out)])

    return run


def matched(which: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places with ``which[a] == key[b]``; ``key`` is sorted."""
    lo, hi = np.searchsorted(key, which, "left"), np.searchsorted(key, which, "right")
    n = hi - lo
    own = np.repeat(np.arange(len(which)), n)
    return own, np.repeat(lo, n) + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)


def removed(window: int, row: dict, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a pack, document ends, ids, and which bytes an earlier document's window covers."""
    data, ends, ids = opened(row)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    edge = np.zeros(len(data) + 1, np.int32)
    for _, (places,) in notes_of(right, COPIES):
        long = places[ends[places] - starts[places] >= window]
        np.add.at(edge, starts[long], 1)
        np.add.at(edge, ends[long], -1)
    flags = [x for _, x in notes_of(right, FLAGS)]
    for _, (which, steps, doc) in notes_of(right, ORIGINS) if flags else []:
        at = np.cumsum(steps)
        key, a, b, earliest = (np.concatenate(x) for x in zip(*flags, strict=True))
        by = np.argsort(key, kind="stable")
        key, a, b, earliest = key[by], a[by].astype(np.int64), b[by].astype(np.int64), earliest[by]
        own, flag = matched(which, key)
        later = earliest[flag] < ids[doc[own]]
        own, flag = own[later], flag[later]
        np.add.at(edge, at[own] + a[flag], 1)
        np.add.at(edge, at[own] + b[flag] + window, -1)
    return data, ends, ids, np.cumsum(edge[:-1]) > 0


def surrounded(docs, window, gram, pack_bytes, part_bytes, hot_packs, id_col, text_col) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packs, notes of copies, and notes of the surroundings of repeated anchors."""
    packed = packs(ids_and_texts(docs, id_col, text_col), pack_bytes)
    total = packed.agg(F.sum(F.length("body"))).first()[0] or 0
    parts = int(max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 3 * total // part_bytes))
    same = staged(copies(packed))
    texts = packed.select("pack", "ids", "lengths", "body")
    noted = staged(repeated_anchors(packed, window, gram, parts, hot_packs)).unionByName(same)
    noted = staged(repeated_contexts(texts, noted, window, gram, parts, hot_packs)).unionByName(noted)
    return texts, same, staged(texts.groupBy("pack").cogroup(noted.groupBy("pack")).applyInArrow(surroundings(window, gram, parts), NOTES))


def repeat_groups(
    docs: DataFrame, window: int = 50, gram: int = GRAM, pack_bytes: int = 8 << 20, part_bytes: int = 16 << 20, hot_packs: int = 256,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Repeats as groups with all their occurrences: ``part, group`` (together a group's name), ``length, doc_id, start`` (bytes).

    A group is a string of ``window`` bytes or more that several documents have, with every place where it stands, maximal within
    the surroundings of its anchor: it can't be extended without losing an occurrence, up to where another anchor takes over. A
    longer repeat is a chain of such groups. Documents that are copies of one with a smaller id take no part. Rows are as many as
    places times nested groups, not pairs. Other cases as in :func:`dedup`.
    """
    texts, _, told = surrounded(docs, window, gram, pack_bytes, part_bytes, hot_packs, id_col, text_col)
    groups = told.where(F.col("kind") == FLAGS).groupBy("part").applyInArrow(maximal_repeats(window, gram), NOTES)
    schema = "part int, group long, length int, doc_id long, start long"
    out = arrow_schema(schema)

    def places(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for row in left.to_pylist():
            ends, ids = np.cumsum(unsqueeze(row["lengths"])[0]), unsqueeze(row["ids"])[0]
            for _, (which, steps, doc) in notes_of(right, ORIGINS):
                at, starts = np.cumsum(steps), np.concatenate(([0], ends[:-1]))
                for part, (key, begin, length, number) in notes_of(right, FLAGS):
                    by = np.argsort(key, kind="stable")
                    own, flag = matched(which, key[by])
                    flag = by[flag]
                    name = ids[doc[own]]
                    found.append(pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(own), part), pa.int32()), pa.array(number[flag], pa.int64()), pa.array(length[flag], pa.int32()),
                        pa.array(name, pa.int64(), mask=name == LAST), pa.array(at[own] + begin[flag] - starts[doc[own]], pa.int64()),
                    ], schema=out))
        return pa.Table.from_batches(found, schema=out)

    notes = groups.unionByName(told.where(F.col("kind") == ORIGINS))
    return texts.select("pack", "ids", "lengths").groupBy("pack").cogroup(notes.groupBy("pack")).applyInArrow(places, schema)


def dedup(
    docs: DataFrame, window: int = 50, gram: int = GRAM, pack_bytes: int = 8 << 20, part_bytes: int = 16 << 20, hot_packs: int = 256,
    id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
) -> DataFrame:
    """For each row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the bytes left).

    Each byte goes that lies in a string of ``window`` UTF-8 bytes which also starts in a document with a smaller id, judged on the
    input. ``n_spans`` counts maximal runs of such bytes.

    Null text: empty. Null id: later than every id and equal to other nulls, so such rows lose what any id has and take from no
    one. Rows with one id do not take from each other, so a repeated row comes out twice, alike. Texts shorter than ``window``
    stay. Empty table: no rows. Other columns are not read.

    Rows are blobs of a pack and a hash range (packs times ranges): for far larger corpora raise both sizes. A hash that at
    least ``hot_packs`` packs hold spreads over all ranges by its contexts, a context of so many packs by longer strings; this changes the
    route only.
    """
    texts, same, told = surrounded(docs, window, gram, pack_bytes, part_bytes, hot_packs, id_col, text_col)
    flags = staged(told.where(F.col("kind") == FLAGS).groupBy("part").applyInArrow(first_documents(window, gram), NOTES))
    notes = flags.unionByName(same).unionByName(told.where(F.col("kind") == ORIGINS))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    out = arrow_schema(schema)

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = []
        for row in left.to_pylist():
            data, ends, ids, gone = removed(window, row, right)
            rows, a = [], 0
            for doc_id, b in zip(ids.tolist(), ends.tolist(), strict=True):
                mask = gone[a:b]
                kept = data[a:b][~mask].tobytes()
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if b > a else 0
                found = (None if doc_id == LAST else doc_id, b - a, b - a - len(kept), spans, hashlib.sha256(kept).hexdigest())
                rows.append((*found, kept) if with_text else found)
                a = b
            batches.append(rows_to_arrow(rows, out))
        return pa.Table.from_batches(batches, schema=out)

    return texts.groupBy("pack").cogroup(notes.groupBy("pack")).applyInArrow(summed, schema)
