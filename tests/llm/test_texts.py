"""Operators on documents against brute force, on small awkward tables and the smallest given ones."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from idtrail.llm import bpe, lines, packing, quality, secrets, simhash, suffix, toxicity
from tests.llm import awkward

FOLDER = "/root/testdata/sf0.001"
LAST = 2**63 - 1
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(params=["awkward", "given", "empty"])
def docs(request, spark):
    if request.param == "given":
        return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return awkward.docs(spark) if request.param == "awkward" else awkward.empty(spark)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def bag(rows):
    return Counter(map(tuple, rows))


# ---- repeated strings


def strings_removed(rows, width=50):
    rows = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in sorted(rows):
        for s in range(len(b) - width + 1):
            first.setdefault(b[s : s + width], i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if first[b[s : s + width]] < i:
                gone[s : s + width] = b"\1" * width
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((None if i == LAST else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"pack_bytes": 20_000, "hot_packs": 2, "part_bytes": 50_000}])
def test_suffix_dedup(docs, options):
    assert bag(suffix.dedup(docs, **options).collect()) == strings_removed(pairs(docs))


def test_intervals_are_those_of_the_definition():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lcp = rng.integers(0, 5, 12)
        lcp[0] = 0
        want = set()
        for a in range(12):
            for b in range(a + 2, 13):
                depth = lcp[a + 1 : b].min()
                if depth >= 2 and lcp[a] < depth and (b == 12 or lcp[b] < depth):
                    want.add((a, b, depth))
        assert {tuple(x[:3]) for x in suffix.intervals(lcp, 2).tolist()} == want


def test_surroundings_that_are_equal_within_a_pack(spark):
    """In most hash ranges nothing but one row with several documents."""
    same = awkward.prose(20, 100)
    docs = spark.createDataFrame([(1, same + " x"), (2, same + " y"), (3, "z " + same)], "doc_id long, text string").coalesce(1)
    assert bag(suffix.dedup(docs, part_bytes=100).collect()) == strings_removed(pairs(docs))


def packs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_words_that_many_packs_have_by_chance_go_nowhere(spark):
    """A string longer than an anchor in all documents, never with the same words around it."""
    docs = packs_of(spark, [awkward.prose(100 + i, 40) + " of this and that and those " + awkward.prose(200 + i, 40) for i in range(40)])
    _, _, told = suffix.surrounded(docs, 50, 20, 1000, 1000, 2, "doc_id", "text")
    assert told.count() == 0
    assert bag(suffix.dedup(docs, pack_bytes=1000, part_bytes=1000, hot_packs=2).collect()) == strings_removed(pairs(docs))


def test_passages_that_many_packs_have_go_in_few_texts(spark):
    """Strings of all lengths up to two windows in all documents, with other words around them, and runs of one letter."""
    long, made = awkward.prose(1, 200), []
    for i in range(60):
        a = 7 * (i % 5)
        made.append(" ".join([awkward.prose(300 + i, 12), long[a : a + 30 + i], awkward.prose(400 + i, 12), long[300 - i : 360 + i], "z" * (40 + i), awkward.prose(500 + i, 3)]))
    docs = packs_of(spark, made)
    want = strings_removed(pairs(docs))
    for hot_packs in (2, 5, 20, 1000):
        assert bag(suffix.dedup(docs, pack_bytes=1000, part_bytes=1000, hot_packs=hot_packs).collect()) == want
    sent = {h: suffix.surrounded(docs, 50, 20, 1000, 1000, h, "doc_id", "text")[2].where(F.col("kind") == suffix.FLAGS) for h in (2, 1000)}
    sent = {h: sum(len(zstandard.decompress(b[8 + int.from_bytes(b[:8], "little") :])) for (b,) in df.select("body").collect()) for h, df in sent.items()}
    assert sent[1000] < sent[2] < 4 * sent[1000]


@pytest.mark.parametrize("given", [True, False])
def test_repeat_groups(spark, given):
    """Each group is one string with all places where it stands, and every repeated window lies in one."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60") if given else awkward.docs(spark).where("doc_id is not null and doc_id not in (11, 12, 13)").dropDuplicates(["doc_id"])
    rows, texts = sorted(pairs(docs)), {}
    for i, t in rows:  # copies take no part
        if (t or "").encode() not in texts.values():
            texts[i] = (t or "").encode()
    groups = defaultdict(list)
    for r in suffix.repeat_groups(docs, pack_bytes=30_000).collect():
        groups[r.part, r.group, r.length].append((r.doc_id, r.start))
    covered = set()
    for (_, _, n), places in groups.items():
        strings = {texts[i][a : a + n] for i, a in places}
        assert len(strings) == 1 and n >= 50 and len(places) == len(set(places))
        one = re.compile(b"(?s)(?=" + re.escape(strings.pop()) + b")")
        assert set(places) == {(i, m.start()) for i, t in texts.items() for m in one.finditer(t)}
        covered |= {(i, a + k) for i, a in places for k in range(n - 49)}
    where = defaultdict(set)
    for i, t in texts.items():
        for a in range(len(t) - 49):
            where[t[a : a + 50]].add((i, a))
    repeated_windows = {x for places in where.values() if len({i for i, _ in places}) > 1 for x in places}
    assert repeated_windows <= covered


def test_range_minimum():
    rng = np.random.default_rng(6)
    values = rng.integers(0, 50, 77)
    a = rng.integers(0, 76, 200)
    b = a + 1 + rng.integers(0, 77 - a - 1 + 1) * (a < 76)
    b = np.minimum(np.maximum(b, a + 1), 77)
    assert suffix.range_minimum(values, a, b).tolist() == [values[x:y].min() for x, y in zip(a, b)]


def test_kept_bytes(spark):
    got = suffix.dedup(awkward.docs(spark), with_text=True).where("doc_id = 4").first()
    assert bytes(got.kept).decode() == "\n" + awkward.prose(5, 30) or got.n_removed >= 50


# ---- secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def spans_of(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(docs):
    want = Counter()
    for i, t in pairs(docs):
        found = spans_of(t or "")
        said = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
        n = [sum(x[2] == kind for x in found) for kind in ("assign", "access", "hex")]
        want[(i, *n, hashlib.sha256(said.encode()).hexdigest(), said)] += 1
    assert bag(secrets.digest(docs).collect()) == want


def test_secret_traps(spark):
    texts = ["token=api_key: abcdefgh1", "secret==abcdefg", "ſecret: abcdefghij", "AKIAAKIA" + "A" * 12, "passwd 'x' : \"abcdefgh", "😀 api_key = \"ZZZZZZZZ\" 😀"]
    got = secrets.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.spans for r in got} == {i: ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans_of(t)) for i, t in enumerate(texts)}


def test_ledger_scans_only_what_is_new(spark):
    all_docs = awkward.docs(spark)
    old = secrets.scan(all_docs.where("doc_id < 10")).persist()
    new = secrets.scan(all_docs, old).persist()
    assert not set(map(tuple, old.select("blob", "kind").collect())) & set(map(tuple, new.select("blob", "kind").collect()))
    assert bag(secrets.digest(all_docs, old).collect()) == bag(secrets.digest(all_docs).collect())
    raised = (("assign", 2, *secrets.RULES[0][2:]), *secrets.RULES[1:])
    again = secrets.scan(all_docs, old.unionByName(new), raised)
    assert {(r.kind, r.version) for r in again.collect()} == {("assign", 2)}
    assert secrets.scan(all_docs, old.unionByName(new)).isEmpty()


def test_redact(spark):
    got = secrets.redact(awkward.docs(spark))
    assert got.columns == awkward.docs(spark).columns and got.count() == len(awkward.rows())
    # overlapping spans become one mark
    assert got.where("doc_id = 18").first().text == "<SECRET> <SECRET> <SECRET> token:short"
    assert got.where("doc_id = 11").first().text == "<SECRET>"  # 60,000 hex digits
    rest = "doc_id is null or doc_id not in (11, 18)"
    assert bag(got.where(rest).collect()) == bag(awkward.docs(spark).where(rest).collect())


# ---- quality


def repeated(words, width=5):
    runs = defaultdict(list)
    for i in range(len(words) - width + 1):
        runs[tuple(words[i : i + width])].append(i)
    return len({j for at in runs.values() if len(at) > 1 for i in at for j in range(i, i + width)})


def test_quality_base(docs):
    want = Counter()
    for i, t in pairs(docs):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        held = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, again = len(words), repeated(words)
        failed = n < 10 or 100 * again > 20 * n
        want[(i, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(held) - len(set(held)), again, failed)] += 1
    got = quality.judge(docs).collect()
    assert bag(r[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_distances(spark):
    """Distances against a plain version, and verdicts on texts that are plainly off."""
    made = [(i, awkward.prose(i, 120), "en") for i in range(60)] + [(100, "#$%& " * 200 + awkward.prose(3, 30), "en"), (101, "SHOUT " + awkward.prose(4, 90).upper(), "en")]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(got[i].kept for i in range(60)) and not got[100].kept and not got[101].kept
    classes = [quality.class_counts(t.encode()) for _, t, _ in made]
    p, q = classes[7] / classes[7].sum(), sum(classes) / sum(classes).sum()
    m = (p + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
    assert got[7].class_distance == pytest.approx(((kl(p) + kl(q)) / 2) ** 0.5)
    kept = quality.drop_rejected(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    # the most frequent words and all others as one; ties go to the word that sorts first
    plain = [re.findall(r"[a-z]+", t.lower()) for _, t, _ in made]
    counted = Counter(w for x in plain for w in x)
    top = [w for w, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0].encode()))[:100]]
    counts = lambda x: np.array([Counter(x)[w] for w in top] + [sum(w not in top for w in x)])
    for i in (7, 30, 59):
        p, q = counts(plain[i]) / len(plain[i]), counts([w for x in plain for w in x]) / counted.total()
        m = (p + q) / 2
        assert got[i].common_distance == pytest.approx(((kl(p) + kl(q)) / 2) ** 0.5)
        assert got[i].kept == (not got[i].base_failed and got[i].class_distance <= 0.25 and got[i].common_distance <= 0.5 and got[i].class_distance + got[i].common_distance <= 0.6)


def test_languages_are_judged_alone(spark):
    """Any number of languages: the verdict on a document depends on its own language only."""
    made = [(1000 * k + i, awkward.prose(1000 * k + i, 70) if i < 3 else "#$%& " * 90 + awkward.prose(i, 12), f"l{k}") for k in range(300) for i in range(4)]
    docs = spark.createDataFrame(made + [(5, "", "empty"), (6, None, None)], "doc_id long, text string, lang string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: r for r in quality.judge(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 1202
    for k in (0, 150, 299):
        alone = quality.judge(docs.where(f"lang = 'l{k}'")).collect()
        assert [tuple(got[r.doc_id]) for r in alone] == [tuple(r) for r in alone]


# ---- BPE


def test_bpe(docs):
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={})
    want = Counter()
    for i, t in pairs(docs):
        ids = encoding.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert bag(bpe.round_trip(docs, RANKS, P.PATTERN).collect()) == want


def test_bpe_words():
    ranks = bpe.ranks_of(RANKS)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(5)
    words = [b"a" * 700, b"ab" * 500, b" " * 333, "é".encode() * 90, b"\xff\xfe", b"<|endoftext|>"]
    words += [bytes(rng.choice(list(b"etaoin shr"), int(rng.integers(1, 200))).astype(np.uint8)) for _ in range(200)]
    codec = bpe.Codec(ranks)
    ids, back = codec.encode(words, at_once=50)
    codec.close()
    assert back == words
    assert ids == [" ".join(map(str, encoding._encode_single_piece(w))) for w in words]


def test_bpe_long_words():
    """Pieces that share tokens, periods that never fall in step with a piece, and words far beyond any real one."""
    ranks = bpe.ranks_of(RANKS)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(6)

    def drawn(letters, n):
        return bytes(rng.choice(list(letters), int(n)).astype(np.uint8))

    letters = b"abcdefghijklmnopqrstuvwxyz"
    words = [b"-" * 5000, b"=-" * 777, "日本語".encode() * 300, *[drawn(letters, n) for n in (96, 97, 144, 145, 5000, 200_000)]]
    words += [drawn(b"abcdehlo", rng.integers(2, 23)) * int(rng.integers(10, 200)) for _ in range(100)]
    words += [drawn(range(256), rng.integers(90, 900)) for _ in range(50)]
    codec = bpe.Codec(ranks)
    ids, back = codec.encode(words)
    assert back == words
    assert ids == [" ".join(map(str, encoding._encode_single_piece(w))) for w in words]
    # without pieces that agree, the whole word is contracted
    found = codec._stitched([b"the" * 40], 1)
    assert found == [None] or " ".join(map(str, found[0])) == " ".join(map(str, encoding._encode_single_piece(b"the" * 40)))
    codec.close()


# ---- lines


def lines_removed(rows, run=2, alone=5):
    seen, held = {}, []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        said = [(k, x.strip(" \t\v\f\r")) for k, x in enumerate((t or "").split("\n"))]
        said = [(k, x) for k, x in said if x]
        found = [[*said[k : k + run]] for k in range(len(said) - run + 1)]
        found += [[s] for s in said if len(re.split(r"[ \t\v\f\r]+", s[1])) >= alone]
        number = {k: n for n, (k, _) in enumerate(said)}
        for w in found:
            spot = (i is None, i or 0, number[w[0][0]])
            key = tuple(x for _, x in w)
            held.append((i, t, w, spot, key))
            seen[key] = min(seen.get(key, spot), spot)
    gone = defaultdict(set)
    for i, t, w, spot, key in held:
        if spot > seen[key]:
            gone[i, t] |= {k for k, _ in w}
    return Counter(
        (i, t if not gone[i, t] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t])) for i, t in rows
    )


def test_line_dedup(docs):
    got = lines.dedup_lines(docs)
    assert got.columns == docs.columns
    assert bag(got.select("doc_id", "text").collect()) == lines_removed(pairs(docs))


def test_line_runs(spark):
    texts = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\n\n d \ny"), (3, "b\nq\nc"), (4, "b\r\nc\nb\nc"), (None, "c\nd"), (None, "c\nd"), (5, awkward.PASSAGE * 2), (6, "z\n" + awkward.PASSAGE * 2)]
    got = lines.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    assert bag(got.collect()) == lines_removed(texts)
    by_id = {r.doc_id: r.text for r in got.collect()}
    assert by_id[2] == "x\n\ny" and by_id[3] == "b\nq\nc" and by_id[4] == "" and by_id[6] == "z"


@pytest.mark.parametrize("run, alone", [(1, 99), (2, 3), (3, 4), (5, 99)])
def test_line_runs_of_any_window(spark, run, alone):
    """Texts of few different lines, so that runs overlap, repeat in themselves and tie within a window."""
    rng = np.random.default_rng(run)
    said = ["a", "b", "c", "d d d", "e e e e", ""]
    texts = [(int(i), "\n".join(rng.choice(said, int(rng.integers(0, 25))))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert bag(lines.dedup_lines(df, run, alone).collect()) == lines_removed(texts, run, alone)
    for r in lines.repeats(df, run, alone).collect():
        spans = [(x.start, x.start + x.length) for x in r.runs]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # maximal: no two touch


def test_line_fingerprints(spark):
    """Only minima of windows are kept, and every window has one."""
    texts = [(1, "\n".join(f"l{k}" for k in range(300)))]
    found = lines.fingerprints(spark.createDataFrame(texts, "doc_id long, text string"), run=5, alone=99).collect()
    assert sorted(k for r in found for k in r["at"]) == list(range(1, 297))
    assert len(found) < 150


# ---- SimHash


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    n = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        n.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * n[b] > len(shingles))


def linked(prints):
    values = sorted(set(prints))
    group = {v: v for v in values}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    for k, a in enumerate(values):
        for b in values[k:]:
            if (a ^ b).bit_count() <= 3:
                group[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_simhash(docs):
    own_texts = pairs(docs)
    rows = [(i, simhash_of(t or "")) for i, t in own_texts]
    root = linked([p for _, p in rows])
    least = {}
    for i, p in rows:
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = Counter((i, f"{p:016x}", least.get(root[p])) for i, p in rows)
    assert bag(simhash.near_groups(docs).collect()) == want
    kept = simhash.keep_one(docs)
    best = {}
    for (i, p), (_, text) in zip(rows, own_texts, strict=True):
        own = (i is None, i or 0, hashlib.md5((text or "").encode()).hexdigest())
        best[root[p]] = min(own, best.get(root[p], own))
    assert kept.columns == docs.columns
    got = [(r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest()) for r in kept.collect()]
    assert sorted(got) == sorted(best.values())


def test_links_are_all_close_pairs_once(spark):
    rng = np.random.default_rng(2)
    values = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)]
    values += [v ^ sum(1 << int(b) for b in rng.choice(63, int(k), replace=False)) for v in values for k in rng.integers(0, 6, 5)] + [-1, 0, 1, -(2**63)]
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    got = [(r.a, r.b) for r in simhash.links(prints).collect()]
    own = sorted(set(values))
    want = {(a, b) for k, a in enumerate(own) for b in own[k + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_a_long_chain(spark):
    from idtrail.llm.common import components

    edges = [(i, i + 1) for i in range(200)] + [(900, 905), (905, 901), (300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900, 905: 900}


def test_near_copies_of_the_pipeline(spark):
    """One of each group stays; different texts of one id are judged one by one; repeated rows are one."""
    rows = []
    for base in range(12):
        words = awkward.prose(1000 + base, 400).split()
        for k in range(4):
            words[7 * k] = "other"
            rows.append((base * 10 + k, " ".join(words)))
    rows += [(500, awkward.prose(77, 50)), (500, awkward.prose(78, 50)), (500, awkward.prose(78, 50)), (501, awkward.prose(78, 50))]
    root = linked([simhash_of(t) for _, t in rows])
    best = {}
    for i, t in rows:
        own = (i, hashlib.md5(t.encode()).hexdigest(), t)
        best[root[simhash_of(t)]] = min(own, best.get(root[simhash_of(t)], own))
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert bag(got.collect()) == Counter((i, t) for i, _, t in best.values())
    assert len(best) < 30 and sum(i == 500 for i, _, _ in best.values()) == 2


# ---- toxicity


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(4)
    bad = ["idiotic", "worthless", "scummy", "pathetic"]
    made, marks = [], []
    for i in range(600):
        words = awkward.prose(i, 40).split()
        toxic = int(i % 5 == 0)
        for _ in range(4 * toxic):
            words[int(rng.integers(40))] = bad[int(rng.integers(4))] + "xyz"[int(rng.integers(3))] * int(rng.integers(2))
        made.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    docs = spark.createDataFrame(made + [(None, "x"), (700, None), (701, "")], "doc_id long, text string")
    labels = spark.createDataFrame(marks + marks[:5] + [(None, 1, 1), (800, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 603
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    truth = {i: t for i, _, t in marks}
    hard = [r for r in rows if r.held_out and r.doc_id in truth]
    hit = sum(r.predicted and truth[r.doc_id] for r in hard)
    assert hit >= 0.9 * sum(truth[r.doc_id] for r in hard) and hit >= 0.9 * sum(r.predicted for r in hard)


def test_pieces_of_long_words():
    for word in ("abc" * 500, "日本語é𝄞x" * 400, "é" * 3000, "a", ""):
        assert Counter(toxicity.subwords(word.encode())) == Counter(np.concatenate(list(toxicity.pieces(word.encode()))).tolist())


def test_toxicity_late_in_a_text_without_blanks(spark):
    rng = np.random.default_rng(4)
    made, marks = [], []
    for i in range(300):
        words = awkward.prose(i, 40).split()
        if i % 3 == 0:
            for k in rng.choice(40, 8, replace=False):
                words[int(k)] = ["idiotic", "worthless"][int(rng.integers(2))]
        made.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 3 == 0)))
    head = "-".join(awkward.prose(900, 2500).split())[:10_000]
    made += [(1000, head), (1001, head + "_worthlesss"), (1002, head[:100] + "_worthlesss_idiotick" * 500)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(made, "doc_id long, text string"), labels).collect()}
    own = zlib.crc32(head.encode()) % toxicity.BUCKETS, zlib.crc32((head + "_worthlesss").encode()) % toxicity.BUCKETS
    assert own[0] != own[1] and got[1001].score > got[1000].score
    assert got[1002].predicted == 1 and got[1000].predicted == 0


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(awkward.docs(spark), none).collect()} == {0.5}
    assert toxicity.score(awkward.empty(spark), none).isEmpty()


# ---- packing


def test_packing(docs):
    window = 256
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), RANKS, P.PATTERN, window=window, shard=50).collect()
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in pairs(docs):
        want[(i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1]))] += 1
    starts = defaultdict(list)
    for r in rows:
        starts[r.doc_id, r.doc_tokens].append(r)
    for (i, ids), n in want.items():
        same = [x for (j, y), m in want.items() if j == i and len(y) == len(ids) for x in [y] * m]
        covered = Counter()
        for r in starts[i, len(ids)]:
            covered.update(range(r.start, r.start + r.length))
            crcs = {zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) for x in same}
            assert r.ids_crc32 in crcs
        assert covered == {k: len(same) for k in range(len(ids))}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end and r.length > 0
            end += r.length
        assert end == window or end & (end - 1) == 0 and end < window


def test_packing_takes_lexical_neighbours():
    tails = [np.array(x * 10) for x in ([1, 2, 3], [50, 51, 52], [1, 2, 9], [60, 61, 62], [50, 51, 77])]
    counts = np.bincount(np.concatenate([np.unique(t) for t in tails]), minlength=packing.VOCABULARY)
    idf = np.log(1 + (len(tails) - counts + 0.5) / (counts + 0.5)).astype(np.float32)
    found = list(packing.fill(tails, packing.Index(tails, idf, 30.0), 60))
    assert [{k for k, _, _ in s} for s in found[:2]] == [{0, 2}, {1, 4}]


def test_packing_scores_are_plain_bm25():
    deal = np.random.default_rng(3)
    tails = [deal.zipf(1.3, deal.integers(0, 80)) % 500 for _ in range(60)]
    idf = deal.random(packing.VOCABULARY).astype(np.float32)
    index = packing.Index(tails, idf, 25.0)
    assert len(index.common) and len(index.doc)
    for seed in range(60):
        want = np.zeros(60)
        for t in set(tails[seed].tolist()):
            for i, tail in enumerate(tails):
                tf = int((tail == t).sum())
                want[i] += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tail) / 25.0))
        assert np.allclose(index.scores(seed), want, rtol=1e-4, atol=1e-5)


def test_packing_distinct_ids():
    deal = np.random.default_rng(9)
    for n in (0, 1, 50, 2000):
        ids = deal.integers(0, 300, n).astype("<u2")
        assert sorted(packing.distinct(ids).tolist()) == sorted(set(ids.tolist()))
        assert dict(zip(*(x.tolist() for x in packing.counted(ids)))) == Counter(ids.tolist())


@pytest.mark.parametrize("first", [1, 5, 64])
def test_packing_takes_the_best_first(first):
    deal = np.random.default_rng(first)
    scores = deal.integers(-1, 8, 200).astype(float)
    assert list(packing.best_first(scores, first)) == [i for i in np.argsort(-scores, kind="stable").tolist() if scores[i] > 0]
    assert list(packing.best_first(np.zeros(0), first)) == list(packing.best_first(-np.ones(9), first)) == []


def test_packing_workers_hold_little():
    """The tokenizer is read for a text with its token only; batches are worked on in small parts, all of them."""
    packing.encoder.cache_clear()
    packing.tokenizer.cache_clear()
    encode = packing.encoder(P.path("byte_bpe_50k.json"), RANKS, P.PATTERN)
    encode("plain words")
    assert packing.tokenizer.cache_info().currsize == 0
    whole = packing.Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode("a" + packing.SPECIAL, add_special_tokens=False).ids
    assert encode("a" + packing.SPECIAL).tolist() == whole and packing.tokenizer.cache_info().currsize == 1
    batches = [pa.RecordBatch.from_pydict({"x": list(range(n))}) for n in (0, 1, 1700, packing.SLICE)]
    parts = list(packing.slices(batches))
    assert max(b.num_rows for b in parts) == packing.SLICE
    assert [x for b in parts for x in b.column("x").to_pylist()] == [x for b in batches for x in b.column("x").to_pylist()]


def test_packing_counts_whole_documents(docs):
    told = packing.tokenized(packing.ids_and_texts(docs), 64, P.path("byte_bpe_50k.json"), RANKS, P.PATTERN)
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter(x for _, t in pairs(docs) for x in {*tokenizer.encode(t or "", add_special_tokens=False).ids, 1})
    counts = packing.document_counts(told)
    assert {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == want


def test_packing_deals_like_documents_together(spark):
    deal = np.random.default_rng(5)
    rows, topics = [], []
    for i in deal.permutation(400).tolist():
        own, all_ = 100 + 60 * (i % 8) + deal.integers(0, 60, 40), deal.integers(0, 100, 40)
        rows.append((len(rows), i, 80, b"", np.concatenate([own, all_]).astype("<u2").tobytes()))
        topics.append(i % 8)
    rows += [(400, 400, 0, b"", b""), (401, 401, 0, b"", b"")]
    table = spark.createDataFrame(rows, "place long, doc_id long, doc_tokens long, full binary, tail binary")
    idf = np.ones(packing.VOCABULARY, np.float32)
    idf[:100] = 0.1
    got = packing.dealt(table, idf, len(rows), 200, depth=3).orderBy("leaf", "lead", "place").collect()
    assert sorted(r.place for r in got) == list(range(402))
    places = [r.place for r in got if r.place < 400]
    assert sum(topics[a] == topics[b] for a, b in zip(places, places[1:])) > 300
    assert {r.lead for r in got if r.place >= 400} == {-1}


def test_special_token_in_a_text(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    got = packing.pack(docs, P.path("byte_bpe_50k.json"), RANKS, P.PATTERN).collect()
    ids = Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode("a <|endoftext|> b", add_special_tokens=False).ids + [1]
    assert sum(r.length for r in got) == len(ids) == got[0].doc_tokens
