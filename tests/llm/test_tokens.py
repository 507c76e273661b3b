"""Alignment of two tokenizers, piece models and periodic runs against the libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from idtrail.llm import align, pieces, runs
from idtrail.llm.queries import QUERIES
from tests.llm import awkward
from tests.oracle import DATA

FOLDER = f"{DATA}/sf0.001"
JSON, RANKS, MODEL = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
ODD = ["a", "b", "e", "the", " ", "  ", "▁", "\n", "é", "日", "本", "😀", "\0", "<s>", "ing", "\t", "　", "�", "z", "1", "Ω", "<|endoftext|>", "<0x0A>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts(seed, n, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


# piece models


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_as_the_library(library):
    model = pieces.pieces(MODEL)
    for text in [*odd_texts(1, 3000), *ODD, " " * 3000 + "x" + " " * 17, "".join(random.Random(2).choices("abcdefgh", k=20_000))]:
        ids = library.encode(text)
        assert model.encode(text).tolist() == ids
        assert model.decode(ids) == library.decode(ids)


def test_quick_compatibility_is_that_of_all_merges():
    model, rng = pieces.pieces(MODEL), random.Random(3)
    tokens = list(model.text)
    for _ in range(5000):
        a, b = rng.choice(tokens[:2000]), rng.choice(tokens[:2000] if rng.random() < 0.9 else tokens)
        assert model.compatible(a, b) == model._stays(model.text[a], model.text[b])


def test_chunks_leave_the_tables_and_come_back(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 5)
    model = pieces.Pieces(MODEL)
    texts = odd_texts(4, 300)
    assert [model.encode(t).tolist() for t in texts] == library.encode(texts)


def test_pieces_of_awkward_rows(spark, library):
    docs = awkward.docs(spark)
    told = pieces.decode(pieces.encode(docs, MODEL), MODEL).collect()
    want = [(r[0], library.encode(r[1] or "")) for r in awkward.rows()]
    assert sorted((str(r.doc_id), r.ids, r.text) for r in told) == sorted((str(i), ids, library.decode(ids)) for i, ids in want)
    assert pieces.encode(awkward.empty(spark), MODEL).isEmpty()


def test_pieces_query(spark, library):
    want = {}
    for i, text in documents(spark):
        ids = library.encode(text or "")
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_pieces"](spark, FOLDER).collect()} == want


# alignment


def aligned(rows):
    """By the definition: all pairs of tokens whose byte ranges meet."""
    slow, model = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    slow.encode_special_tokens = True
    letters = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in letters.values())}
    vocabulary = {i: t for t, i in slow.get_vocab().items()}
    told, count = [], Counter()
    for doc_id, text in rows:
        a = slow.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        spelled = [bytes(letters[c] for c in vocabulary[x]) for x in a], [
            bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x..>", p) and model.is_byte(x) else p.replace("▁", " ").encode() for x in b for p in [model.id_to_piece(x)]
        ]
        if not text or not b"".join(spelled[0]) == b"".join(spelled[1]) == (" " + text).encode():
            told.append((doc_id, [], [], [], []))
            continue
        spans = []
        for side in spelled:
            ends = list(accumulate(map(len, side)))
            spans.append(list(zip([0, *ends[:-1]], ends, strict=True)))
        linked, first = [], 0
        for x, (s, e) in zip(a, spans[0], strict=True):
            while spans[1][first][1] <= s:
                first += 1
            k = first
            while k < len(b) and spans[1][k][0] < e:
                linked.append((x, b[k]))
                k += 1
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        both = set(common)
        cut = [[n for n, (_, e) in enumerate(side, 1) if e in both] for side in spans]
        parts = [
            ",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m]))
            for i, j, k, m in zip([0, *cut[0][:-1]], cut[0], [0, *cut[1][:-1]], cut[1], strict=True)
        ]
        told.append((doc_id, a, b, parts, linked))
        count.update(linked)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [
        (i, len(a), len(b), len(parts), len(linked), sum(count[p] == most[p[1]] for p in linked), sum(count[p] for p in linked), ";".join(parts))
        for i, a, b, parts, linked in told
    ]


def test_alignment_by_its_definition(spark, monkeypatch):
    texts = [*odd_texts(5, 300, 60), None, "", "a" + " " * 2000 + "b", "x<|endoftext|>y", "unbelievably tokenization", "同じ same 同じ"]
    rows = [(k % 290, t) for k, t in enumerate(texts)] + [(None, "the the"), (None, "the the")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_a int, block string").repartition(3)
    for block in (8_000_000, 500):
        monkeypatch.setattr(align, "BLOCK", block)
        got = align.align(docs, JSON, RANKS, public_tokenizers.PATTERN, MODEL).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, aligned(rows)))
    assert align.align(docs.where("false"), JSON, RANKS, public_tokenizers.PATTERN, MODEL).isEmpty()


def test_alignment_of_awkward_rows(spark):
    got = align.align(awkward.docs(spark), JSON, RANKS, public_tokenizers.PATTERN, MODEL).collect()
    want = aligned([r[:2] for r in awkward.rows()])
    assert sorted(str((r.doc_id, r.n_a, r.n_b, r.n_links, r.n_best, r.count_sum)) for r in got) == sorted(str((*r[:3], *r[4:7])) for r in want)


def test_alignment_on_arrays():
    """Links and groups of whole lists of ids at once, whatever the lengths of their tokens."""
    deal = random.Random(12)
    both = align.Sides(JSON, RANKS, public_tokenizers.PATTERN, MODEL)
    both.bytes_a, both.bytes_b = ([b"x" * n for n in (1, 2, 3, 7)] for _ in range(2))
    both.length_a = both.length_b = np.array([1, 2, 3, 7])
    both.written = [f"{x}{mark}" for mark in ",|,;" for x in range(4)]
    for _ in range(300):
        size = deal.randint(1, 60)
        ids = []
        for _ in range(2):
            own, left = [], size
            while left:
                own.append(deal.choice([k for k, n in enumerate((1, 2, 3, 7)) if n <= left]))
                left -= (1, 2, 3, 7)[own[-1]]
            ids.append(own)
        ends = [list(accumulate((1, 2, 3, 7)[x] for x in own)) for own in ids]
        spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in ends]
        want = sorted(x << 32 | y for x, (s, e) in zip(ids[0], spans[0], strict=True) for y, (f, t) in zip(ids[1], spans[1], strict=True) if s < t and f < e)
        common = [0, *sorted(set(ends[0]) & set(ends[1]))]
        parts = ["|".join(",".join(str(x) for x, e in zip(own, of, strict=True) if low < e <= high) for own, of in zip(ids, ends, strict=True)) for low, high in zip(common, common[1:])]
        pairs, groups, text = both.aligned(*(np.array(own, np.int64) for own in ids))
        assert (sorted(pairs.tolist()), groups, text) == (want, len(parts), ";".join(parts))


def test_alignment_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_alignment"](spark, FOLDER).collect()}
    want = aligned(documents(spark))
    assert len(got) == len(want)
    for i, n_a, n_b, n_groups, n_links, n_best, count_sum, groups in want:
        r = got[i]
        assert tuple(r)[1:] == (n_a, n_b, n_groups, n_links, n_best, count_sum, sha(groups) if groups else "")


# periodic runs


def all_runs(words, least=6, times=4):
    """For each period, all stretches where it holds."""
    number, found = {}, {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    for q in range(1, len(words) // times + 1):
        edge = np.diff(np.concatenate(([0], (w[q:] == w[:-q]).astype(np.int8), [0])))
        for since, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            length = end - since + q
            if end - since >= q and length >= max(least, times * q):
                found[since, length] = min(q, found.get((since, length), q))
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def test_runs_by_brute_force():
    rng = random.Random(6)
    for _ in range(600):
        k = rng.choice([1, 2, 3, 5])
        words = []
        while len(words) < 100:
            words += [rng.randrange(k) for _ in range(rng.randint(1, 30))] * rng.choice([1, 1, 2, 5]) + [rng.randrange(k)]
        words = words[: rng.randint(0, 140)]
        for least, times in ((6, 4), (2, 2), (1, 3)):
            assert runs.runs_of(words, least, times) == all_runs(words, least, times)


def test_long_periods_and_regular_words():
    shapes = [list(range(900)) * 5, [1] * 30_000, [1, 2] * 9000, ([1] * 70 + [2]) * 60, [bin(i).count("1") % 2 for i in range(5000)]]
    for words in shapes[:1] + shapes[3:]:
        assert runs.runs_of(words) == all_runs(words)
    assert runs.runs_of(shapes[1]) == [(0, 30_000, 1)] and runs.runs_of(shapes[2]) == [(0, 18_000, 2)]


def test_runs_of_awkward_rows(spark):
    got = runs.runs(awkward.docs(spark)).collect()
    want = []
    for i, text, *_ in awkward.rows():
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        found = all_runs(words) if len(words) < 5000 else []
        want.append((i, found, " ".join(collapsed(words, found))))
    assert sorted(str((r.doc_id, list(zip(r.starts, r.lengths, r.periods, strict=True)), r.collapsed)) for r in got) == sorted(map(str, want))
    assert runs.runs(awkward.empty(spark)).isEmpty()
    with pytest.raises(ValueError):
        runs.runs(awkward.empty(spark), times=1)


def test_runs_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_runs"](spark, FOLDER).collect()}
    want = {}
    for i, text in documents(spark):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        found = all_runs(words)
        best = min(((-m, s, q) for s, m, q in found), default=None)
        head = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        want[i] = (len(found), *head, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(collapsed(words, found))))
    assert {i: got[i] for i in want} == want and any(w[0] for w in want.values())
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").agg(F.count("*")).first()[0]
