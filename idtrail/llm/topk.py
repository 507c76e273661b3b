"""Exact k largest inner products by dual-tree search over cover trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from idtrail.llm.common import arrow_schema
from idtrail.session import staged

LAST = 2**63 - 1
ROW = "vec_id long, v array<double>, dim int, pivot int"


class CoverTree:
    """Nodes with a centre that is one of their points and the radius that holds all of them.

    The children of a node have centres of which each is more than half the node's radius from all others, and hold what is
    within that of them; one of them has the node's own centre. A node's points are a run of ``order``, its children a run of nodes.
    """

    def __init__(self, points: np.ndarray, leaf: int = 24) -> None:
        n = len(points)
        self.points, self.order = points, np.arange(n)
        centre, radius, span, kids = [0], [0.0], [(0, n)], [(0, 0)]
        at = 0
        while at < len(centre):
            a, b = span[at]
            own = self.order[a:b]
            far = np.linalg.norm(points[own] - points[centre[at]], axis=1)
            radius[at] = float(far.max(initial=0.0))
            if b - a > leaf and radius[at] > 0:
                reach, group, c = radius[at] / 2, np.full(b - a, -1), centre[at]
                near, first, m = far, len(centre), 0
                while True:
                    free = (group < 0) & (near <= reach)
                    group[free] = m
                    centre.append(int(c))
                    m += 1
                    open_ = np.flatnonzero(group < 0)
                    if not len(open_):
                        break
                    c = own[open_[0]]
                    near = np.full(b - a, np.inf)
                    near[open_] = np.linalg.norm(points[own[open_]] - points[c], axis=1)
                by = np.argsort(group, kind="stable")
                self.order[a:b] = own[by]
                ends = a + np.cumsum(np.bincount(group, minlength=m))
                span += list(zip([a, *ends[:-1].tolist()], ends.tolist(), strict=True))
                radius += [0.0] * m
                kids += [(0, 0)] * m
                kids[at] = (first, first + m)
            at += 1
        self.centre, self.radius, self.span, self.kids = np.array(centre), np.array(radius), np.array(span).reshape(-1, 2), np.array(kids).reshape(-1, 2)
        self.size = np.linalg.norm(points[self.centre], axis=1)


def exact_scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Integer inner products. Doubles hold them exactly up to 2**53; beyond, Python's integers do, cut to the range of long."""
    top = np.abs(queries).max(initial=0.0) * np.abs(points).max(initial=0.0) * max(1, queries.shape[1])
    if top < 2**53:
        return (queries @ points.T).astype(np.int64)
    whole = [[int(x) for x in q] for q in points]
    return np.array([
        [max(-LAST, min(LAST, sum(int(a) * b for a, b in zip(q, p, strict=True)))) for p in whole] for q in queries
    ], dtype=np.int64).reshape(len(queries), len(points))


def search(query_ids, queries: np.ndarray, floors, ids, points: np.ndarray, k: int):
    """``(query row, id, score)`` of the ``k`` best of ``points`` for each query, as far as they reach its ``floor``."""
    found = [[] for _ in query_ids]
    worst = np.array(floors, float)  # a kth score that is reached elsewhere already
    asks, holds = CoverTree(queries), CoverTree(points)

    def bound(q: int, nodes: np.ndarray) -> np.ndarray:
        centre = holds.points[holds.centre[nodes]] @ asks.points[asks.centre[q]]
        most = centre + asks.size[q] * holds.radius[nodes] + holds.size[nodes] * asks.radius[q] + asks.radius[q] * holds.radius[nodes]
        return most + 1e-6 * np.abs(most) + 1e-6  # rounding never prunes

    def score(rows: np.ndarray, at: np.ndarray) -> None:
        scores = exact_scores(queries[rows], points[at])
        for i, row in enumerate(rows):
            good = np.flatnonzero((scores[i] >= worst[row]) & (ids[at] != query_ids[row]))
            if len(good):
                best = found[row] + list(zip((-scores[i][good]).tolist(), ids[at[good]].tolist(), strict=True))
                best.sort()
                found[row] = best[:k]
                if len(best) >= k:
                    worst[row] = max(worst[row], -best[k - 1][0])

    def open_wide(nodes: np.ndarray) -> np.ndarray:
        runs = holds.kids[nodes]
        return np.concatenate([np.arange(a, b) for a, b in runs]) if len(runs) else nodes

    stack = [(0, np.array([0]))] if len(queries) and len(points) else []
    while stack:
        q, front = stack.pop()
        rows = asks.order[slice(*asks.span[q])]
        last = asks.kids[q][0] == asks.kids[q][1]
        done = []
        while len(front):
            front = front[bound(q, front) >= worst[rows].min()]
            inner = holds.kids[front, 1] > holds.kids[front, 0]
            wide = inner & (last | (holds.radius[front] > asks.radius[q]))
            done.append(front[~wide])
            front = open_wide(front[wide])
        front = np.concatenate(done) if done else front
        if not last:
            stack += [(child, front) for child in range(*asks.kids[q])]
            continue
        most = bound(q, front)
        by = np.argsort(-most)
        front, most = front[by], most[by]
        sizes = np.cumsum(holds.span[front, 1] - holds.span[front, 0])
        at = 0
        while at < len(front) and most[at] >= worst[rows].min():
            to = int(np.searchsorted(sizes, sizes[at] + 256)) + 1
            score(rows, np.concatenate([holds.order[a:b] for a, b in holds.span[front[at:to]]]))
            at = to
    return [(i, vec, -score_) for i, best in enumerate(found) for score_, vec in best]


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def quantised(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v, dim``: each component x as floor(scale * x). Null vectors and null or non-finite components are left out."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    finite = ~F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(F.col(vector_col).isNotNull()).where(F.coalesce(finite, F.lit(False))).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("vec_id"), whole.alias("v"), F.size(vector_col).alias("dim")
    )


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, block: int = 4096, max_pivots: int = 256, spread: int = 32,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every``, the ``k`` largest inner products.

    1. Vectors go to the nearest of some pivots (one for each ``block`` vectors, ``max_pivots`` at most; a small stated sample,
       used for locality only) and there to blocks of about ``block`` by a hash, so a crowded place is many blocks.
    2. Each query is searched in one block of its own pivot: its first kth score.
    3. Blocks and groups of queries (those of a pivot) are summed up as centre, radius and size; a pair whose bound is under the
       group's worst kth score is dropped. What remains is searched by (block, chunk of queries), each by both cover trees.

    Exact: only bounds prune. Ties go to the smaller id, null ids last. A query's own id is no candidate. Of query rows with one
    id, the smallest vector asks; a candidate row that is there twice counts twice. Only vectors of one length are compared.
    Empty vectors score 0. Empty table: no rows.
    """
    raw = staged(quantised(vectors, 256.0, id_col, vector_col))
    spark = raw.sparkSession
    dims = {r.dim: r.n for r in raw.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(max_pivots).collect()}
    wanted = max(1, min(max_pivots, -(-sum(dims.values()) // block)))
    sample = raw.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(wanted).collect()
    pivots: dict[int, np.ndarray] = {}
    for row in sample:
        pivots.setdefault(row.dim, []).append(row.v)
    pivots = {d: np.array(v, float).reshape(len(v), d) for d, v in pivots.items()}
    arrow = arrow_schema(ROW)

    def nearest(batches):
        for batch in batches:
            vectors_, near = batch.column("v").to_pylist(), np.zeros(batch.num_rows, np.int32)
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors_):
                by_dim.setdefault(len(v), []).append(i)
            for d, at in by_dim.items():
                if d in pivots and d:
                    x = np.array([vectors_[i] for i in at], float)
                    far = (pivots[d] ** 2).sum(1)[None, :] - 2 * x @ pivots[d].T
                    near[at] = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("dim"), pa.array(near)], schema=arrow
            )

    placed = raw.select("vec_id", "v", "dim").mapInArrow(nearest, ROW)
    counts = {(r.dim, r.pivot): r.n for r in placed.where(F.col("dim").isin(list(dims))).groupBy("dim", "pivot").agg(F.count("*").alias("n")).collect()}
    split = F.coalesce(
        F.create_map(*[x for (d, p), n in counts.items() for x in (F.lit(f"{d}:{p}"), F.lit(-(-n // block)))])[F.concat_ws(":", "dim", "pivot")]
        if counts else F.lit(None).cast("int"), F.lit(1),
    )
    placed = staged(placed.withColumn("part", F.pmod(F.xxhash64("vec_id"), split).cast("int")))
    asked = placed.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != LAST)).groupBy("vec_id", "dim").agg(F.min(F.struct("v", "pivot")).alias("q"))
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("dim", "q")).alias("a")).select("vec_id", "a.dim", "a.q.v", "a.q.pivot")
    asked = staged(asked)
    n_chunks = max(1, -(-asked.count() // block))
    found_schema = arrow_schema("query_id long, dim int, pivot int, vec_id long, score long")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return found_schema.empty_table()
        dim = left.column("dim")[0].as_py()
        ids, near = left.column("vec_id").to_numpy(), left.column("pivot").to_numpy()
        rows = search(ids, _matrix(left, dim), left.column("floor").to_numpy(), right.column("vec_id").to_numpy(), _matrix(right, dim), k)
        columns = list(zip(*[(int(ids[i]), dim, int(near[i]), vec, s) for i, vec, s in rows], strict=True)) or [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, found_schema.types, strict=True)], schema=found_schema)

    ddl = "query_id long, dim int, pivot int, vec_id long, score long"
    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)).cast("int")

    def searched(queries: DataFrame, blocks: DataFrame) -> DataFrame:
        """``queries`` with ``at_pivot, at_part`` and a floor, each in that block."""
        keys = ["dim", "at_pivot", "at_part", "chunk"]
        left = queries.withColumn("chunk", chunk).select("vec_id", "v", "pivot", "floor", *keys)
        right = blocks.select("vec_id", "v", "dim", F.col("pivot").alias("at_pivot"), F.col("part").alias("at_part"), F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, ddl)

    first = staged(searched(
        asked.withColumns({"floor": F.lit(float("-inf")), "at_pivot": F.col("pivot"), "at_part": F.lit(0)}), placed.where("part = 0")
    ))
    reached = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor"))
    asked = staged(asked.join(reached, asked.vec_id == reached.query_id, "left").drop("query_id").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))))

    def summary(rows: DataFrame, *keys: str) -> DataFrame:
        """Centre (mean), radius and size of each group, in two aggregations that combine before the shuffle."""
        parts = rows.select(*keys, F.posexplode("v").alias("i", "x")).groupBy(*keys, "i").agg(F.avg("x").alias("m"))
        centre = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c")).select(*keys, F.transform("c", lambda s: s.m).alias("c"))
        square = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)
        far = rows.join(centre, list(keys)).select(*keys, "c", F.sqrt(square(F.zip_with("v", "c", lambda x, m: x - m))).alias("far"))
        return far.groupBy(*keys).agg(F.max("far").alias("radius"), F.first("c").alias("c")).withColumn("size", F.sqrt(square(F.col("c"))))

    groups = summary(asked, "dim", "pivot").join(asked.groupBy("dim", "pivot").agg(F.min("floor").alias("floor")), ["dim", "pivot"])
    groups = groups.select("dim", F.col("pivot").alias("group"), F.col("c").alias("gc"), F.col("radius").alias("gr"), F.col("size").alias("gs"), "floor", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"))
    blocks = summary(placed, "dim", "pivot", "part").withColumn("salt", F.pmod(F.xxhash64("pivot", "part"), F.lit(spread)).cast("int"))
    dot = F.aggregate(F.zip_with("gc", "c", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    most = dot + F.col("gs") * F.col("radius") + F.col("size") * F.col("gr") + F.col("gr") * F.col("radius")
    pairs = groups.join(blocks, ["dim", "salt"]).where(most + F.abs(most) * 1e-6 + 1e-6 >= F.col("floor"))
    pairs = pairs.where((F.col("group") != F.col("pivot")) | (F.col("part") != 0)).select(
        "dim", F.col("group").alias("pivot"), F.col("pivot").alias("at_pivot"), F.col("part").alias("at_part")
    )
    rest = searched(asked.join(pairs, ["dim", "pivot"]), placed)
    both = first.unionByName(rest)
    ranked = both.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != LAST, F.col("vec_id")).alias("vec_id"), "score"
    )
