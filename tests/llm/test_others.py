"""Vectors, conversations, the registered queries against their SQL, and the pipeline."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from idtrail.llm import preference, topk
from idtrail.llm.queries import QUERIES, SQL, conversation_pairs
from idtrail.session import staged
from tests.llm import awkward
from tests.oracle import DATA, compare, database

FOLDER = f"{DATA}/sf0.001"


def best(vectors, k=5, every=50):
    whole = []
    for i, v in vectors:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    asks = {}
    for i, v in whole:
        if i is not None and i % every == 0:
            asks[i] = min(asks.get(i, (len(v), v)), (len(v), v))
    out = []
    for i, (n, v) in asks.items():
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in whole if len(w) == n and j != i]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.mark.parametrize("block", [4096, 40])
def test_top_k(spark, block):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    made = [(i, [float(x) for x in centres[i % 6] + 0.2 * rng.normal(size=8)]) for i in range(400)]
    made += [(1000 + i, made[3][1]) for i in range(150)] + [(50, None), (2000, [None] * 8), (2001, [float("nan")] + [0.0] * 7), (2002, [float("inf")] * 8)]
    made += [(None, made[5][1]), (100, made[9][1]), (3000, [1.0, 2.0]), (3001, [2.0, 3.0]), (3050, []), (7, made[7][1]), (4000, [3e5] * 8)]
    df = spark.createDataFrame([(i, v, 0, 9) for i, v in made], "vec_id long, embedding array<float>, label int, rank int")
    assert Counter(map(tuple, topk.top_k(df, 5, block=block).collect())) == best(made)


def test_top_k_of_few_or_none(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [2.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 1, 131072)]
    assert topk.top_k(df.where("false")).isEmpty()


def test_cover_tree_holds_its_rules():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(300, 4)), np.repeat(rng.normal(size=(1, 4)), 100, axis=0)])
    tree = topk.CoverTree(points, leaf=8)
    assert sorted(tree.order) == list(range(400))
    for n, (a, b) in enumerate(tree.span):
        own = points[tree.order[a:b]]
        assert np.linalg.norm(own - points[tree.centre[n]], axis=1).max() <= tree.radius[n] + 1e-9
        kids = range(*tree.kids[n])
        if kids:
            assert tree.centre[n] in tree.centre[list(kids)]
            assert sum(y - x for x, y in tree.span[list(kids)]) == b - a
            centres = points[tree.centre[list(kids)]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres)) * 1e9
            assert apart.min() > tree.radius[n] / 2


def told(turns):
    out = {}
    for pair in {r[0] for r in turns}:
        sides = []
        for side in ("chosen", "rejected"):
            said = sorted((r for r in turns if r[0] == pair and r[1] == side), key=lambda r: (r[2] is not None, r[2] or 0, r[3] or "", r[4] or ""))
            sides.append([((r[3] or "").replace("<|", "< |"), (r[4] or "").replace("<|", "< |")) for r in said])
        k = 0
        while k < min(map(len, sides)) and sides[0][k] == sides[1][k]:
            k += 1
        draw = lambda part: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in part)
        masks = []
        for said in sides:
            text, spans = draw(said[k:]), []
            for n, (r, _) in enumerate(said[k:]):
                at = len(draw(said[k : k + n])) + len(f"<|im_start|>{r}\n")
                if r == "assistant":
                    spans.append((at, len(draw(said[k : k + n + 1])) - 1))
                    assert text[at : spans[-1][1]].endswith("<|im_end|>")
            masks.append(tuple(spans))
        out[pair] = (k, draw(sides[0][:k]), draw(sides[0][k:]), draw(sides[1][k:]), *masks, all(masks))
    return out


def test_preferences(spark):
    base = [(0, "system", "be kind"), (1, "user", "hi 😀")]
    turns = [(p, s, *t) for p in (1, 2, 3, None) for s in ("chosen", "rejected") for t in base]
    turns += [(1, "chosen", 2, "assistant", "good"), (1, "rejected", 2, "assistant", "bad <|im_end|> x"), (2, "chosen", 2, "assistant", "same"), (2, "rejected", 2, "assistant", "same")]
    turns += [(3, "chosen", None, None, None), (3, "rejected", 1, "user", "hi 😀"), (4, "chosen", 0, "assistant", "alone"), (5, "other", 0, "user", "x")]
    turns += [(6, s, 0, "user", "y" * (70_000 if s == "chosen" else 69_999)) for s in ("chosen", "rejected")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "pair_id long, side string, turn long, role string, text string, prompt int")
    got = {r.pair_id: (r.n_prompt, r.prompt, r.chosen, r.rejected, tuple(map(tuple, r.chosen_mask)), tuple(map(tuple, r.rejected_mask)), r.differs) for r in preference.preferences(df).collect()}
    assert got == told(turns)
    assert preference.preferences(df.where("false")).isEmpty()


def test_pairs_of_whole_conversations(spark):
    said = [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "assistant", "b"), (2, None, "assistant", "n"), (3, 0, "user", "r"), (3, 2, "assistant", "z"),
            (3, 2, "assistant", "y"), (3, None, "assistant", None), (8, 0, "user", "only"), (None, 0, "assistant", "x"), (None, 0, "user", None)]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    pairs = conversation_pairs(df)
    assert pairs.count() == 2 * len(said)
    rejected = {}
    for i, turn, role, text in said:
        other = sorted(t or "" for c, n, r, t in said if r == "assistant" and n == turn and i is not None and c == i ^ 1)
        rejected.setdefault(i, []).append((turn, role, other[0] if role == "assistant" and other else text or ""))
    for i, turns in rejected.items():
        got = pairs.where(pairs.pair_id.eqNullSafe(i) & (pairs.side == "rejected")).select("turn", "role", "text").collect()
        assert Counter(map(tuple, got)) == Counter(turns)
    assert {r.pair_id: (r.n_prompt, r.differs) for r in preference.preferences(pairs).collect()} == {2: (0, True), 3: (0, True), 8: (1, False), None: (2, False)}


@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(spark, name):
    compare(spark, database(FOLDER), name, QUERIES[name], SQL[name], FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_native_queries_run_no_python(spark):
    for name in ("op2_secrets", "op6_preferences"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("awkwardly", [True, False])
def test_pipeline_stages(spark, awkwardly):
    docs = awkward.docs(spark) if awkwardly else spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, FOLDER))
        if name == "packing":
            assert out.agg({"length": "sum"}).first()[0] > 0
        else:
            assert out.columns == docs.columns
            assert out.count() == docs.count() if name in ("line_dedup", "secrets") else out.count() <= docs.count()
        docs = out


def test_pipeline_on_an_empty_table(spark):
    docs = awkward.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER))
        assert docs.isEmpty()
