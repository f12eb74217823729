"""Exact top-k by inner product with a dual-tree search over farthest-first ball trees.

Vectors are dealt to blocks around pivots (a bounded, documented sample of the
vectors); a large block is split, so that a block never exceeds about ``BLOCK``
rows. In each block the data and a group of queries are both indexed by a ball
tree: a node covers its points with a radius around one of them, and its children
are points that are far apart (farthest-first), each covering the points nearest to
it. A lopsided split is made by distance ranks instead. This is not a cover tree: there
are no levels with halving radii, and no separation of centers is kept. Pairs of nodes are descended best bound first; a pair goes when

    <cq, cx> + Rq |cx| + Rx |cq| + Rq Rx

is below the worst k-th score of the pair's query group.

The search has two passes. First every query searches its own block, whose k-th
score is a lower bound of the final one. Then groups of queries search all other
blocks with these bounds, which end most far blocks at the root. Every vector is
indexed and no pair of nodes is dropped without its bound, so results are exact.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

K = 5
SCALE = 256
#: Pivots, the sample on which the blocks are fitted.
PIVOTS = 64
#: Rows of a block and queries of a group, about.
BLOCK, QUERY_GROUP = 16384, 4096
FANOUT, LEAF = 16, 64
#: A scaled component beyond this has no part: its products would not fit a long.
LIMIT = float(2 ** 31)


@dataclass
class Node:
    start: int
    end: int
    center: np.ndarray
    radius: float
    norm: float
    children: list["Node"]


def build(points: np.ndarray) -> tuple[np.ndarray, Node | None]:
    """``(order, root)``: a farthest-first ball tree whose nodes are ranges of ``points[order]``."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), None
    order = np.arange(n)
    x = points.astype(np.float64)

    def node(start: int, end: int, center: np.ndarray) -> Node:
        far = np.sqrt(((x[order[start:end]] - center) ** 2).sum(axis=1))
        return Node(start, end, center, float(far.max()), float(np.sqrt(center @ center)), [])

    root = node(0, n, x[int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())])
    todo = [root]
    while todo:
        at = todo.pop()
        size = at.end - at.start
        if size <= LEAF or at.radius == 0:
            continue
        mine = order[at.start:at.end].copy()
        own = x[mine]
        nearest = ((own - at.center) ** 2).sum(axis=1)
        to_center = nearest
        centers, owner = [at.center], np.zeros(size, np.int64)
        while len(centers) < FANOUT and nearest.max() > 0:
            c = own[int(nearest.argmax())]
            d = ((own - c) ** 2).sum(axis=1)
            owner[d < nearest] = len(centers)
            nearest = np.minimum(nearest, d)
            centers.append(c)
        if np.bincount(owner).max() > 0.8 * size:  # outliers only: cut by distance, so that depth stays logarithmic
            rank = np.argsort(np.argsort(to_center, kind="stable"), kind="stable")
            owner = rank * FANOUT // size
            centers = [own[owner == i].mean(axis=0) for i in range(FANOUT)]
            centers = [own[owner == i][((own[owner == i] - c) ** 2).sum(axis=1).argmin()] for i, c in enumerate(centers)]
        by = np.argsort(owner, kind="stable")
        order[at.start:at.end] = mine[by]
        counts = np.bincount(owner, minlength=len(centers))
        begin = at.start
        for c, m in zip(centers, counts.tolist()):
            if m:
                at.children.append(node(begin, begin + m, c))
                begin += m
        todo.extend(at.children)
    return order, root


def search(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int = K,
           floor: np.ndarray | None = None) -> pd.DataFrame:
    """Top k of the integer vectors ``x`` for each of ``q``, without rows that bear the query's id.

    ``floor``: for each query a score below which results don't matter. Result:
    query (index into ``q``), vec_id, score; ties go to the smaller id.
    """
    exact = max(1, q.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2 ** 53
    kind = np.float64 if exact else np.int64  # BLAS where doubles hold every sum, else integers
    q_order, q_root = build(q)
    x_order, x_root = build(x)
    if q_root is None or x_root is None:
        return pd.DataFrame({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
    qs, xs, qi, xi = q[q_order].astype(kind), x[x_order].astype(kind), q_ids[q_order], x_ids[x_order]
    none = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    best = np.full((len(qs), k), none, kind)
    best_id = np.full((len(qs), k), np.iinfo(np.int64).max)
    worst = np.full(len(qs), -np.inf)
    if floor is not None:
        worst = floor[q_order].astype(np.float64)

    def bound(a: Node, b: Node) -> float:
        top = float(a.center @ b.center) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return top + abs(top) * 1e-9 + a.norm * b.norm * 1e-9 + 1e-6

    stack = [(bound(q_root, x_root), q_root, x_root)]
    while stack:
        top, a, b = stack.pop()
        if top < worst[a.start:a.end].min():
            continue
        if a.children and (not b.children or a.radius > b.radius):
            stack.extend((bound(c, b), c, b) for c in a.children)
        elif b.children:
            stack.extend(sorted(((bound(a, c), a, c) for c in b.children), key=lambda p: p[0]))
        else:
            for at in range(b.start, b.end, 4096):  # a leaf of equal points may be long
                end = min(at + 4096, b.end)
                score = qs[a.start:a.end] @ xs[at:end].T
                score[qi[a.start:a.end, None] == xi[None, at:end]] = none
                rows = np.nonzero((score >= worst[a.start:a.end, None]).any(axis=1))[0]
                if not len(rows):
                    continue
                r = rows + a.start
                every = np.concatenate([best[r], score[rows]], axis=1)
                ids = np.concatenate([best_id[r], np.broadcast_to(xi[at:end], (len(rows), end - at))], axis=1)
                ids = np.where(every == none, np.iinfo(np.int64).max, ids)
                pick = np.lexsort((ids, -every if kind is np.float64 else ~every), axis=1)[:, :k]
                best[r], best_id[r] = np.take_along_axis(every, pick, 1), np.take_along_axis(ids, pick, 1)
                kth = best[r, k - 1]
                worst[r] = np.maximum(worst[r], np.where(kth == none, -np.inf, kth.astype(np.float64)))
    rows, cols = np.nonzero(best != none)
    return pd.DataFrame({"query": q_order[rows], "vec_id": best_id[rows, cols], "score": best[rows, cols].astype(np.int64)})


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) as longs; null if the vector is null, empty, or holds a null or
    non-finite component or one whose product would not fit a long."""
    doubles = F.transform(vector, lambda v: v.cast("double") * scale)
    ok = F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LIMIT))
    return F.when((F.size(vector) > 0) & ok, F.transform(doubles, lambda v: F.floor(v).cast("long")))


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.int64) if len(column) else np.zeros((0, dim), np.int64)


def deal(vectors: DataFrame, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``vectors`` (vec_id, v) with ``dim`` and ``block`` (a string key of bounded size)."""
    vectors = vectors.withColumn("dim", F.size("v"))
    # The same vectors every time, whatever the partitions.
    sample = vectors.select("dim", "v").orderBy(F.xxhash64("vec_id", F.col("v"))).limit(pivots).collect()
    centers: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        centers[dim] = np.array([r["v"] for r in sample if r["dim"] == dim], np.float64)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.full(len(batch), -1)
            for dim, rows in batch.groupby("dim").indices.items():
                if dim in centers:
                    c = centers[dim]
                    x = _matrix(batch["v"].iloc[rows], dim).astype(np.float64)
                    out[rows] = ((c ** 2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
            yield batch.assign(pivot=out.astype(np.int32))

    dealt = materialise(vectors.mapInPandas(nearest, "vec_id long, v array<long>, dim int, pivot int"), "knn-dealt")
    parts = (dealt.groupBy("dim", "pivot").agg(F.count("*").alias("n"))
             .select(F.col("dim").alias("p_dim"), F.col("pivot").alias("p_pivot"),
                     F.ceil(F.col("n") / block).cast("long").alias("parts")))
    # One row per pivot and dimension: the planner sees its size.
    return dealt.join(parts, (F.col("dim") == F.col("p_dim")) & (F.col("pivot") == F.col("p_pivot"))).select(
        "vec_id", "v", "dim", F.concat_ws(":", "dim", "pivot", F.pmod(F.xxhash64("vec_id", F.col("v")), F.col("parts"))).alias("block"))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner products of each query.

    Queries are the rows for which ``is_query`` holds (an expression over the id
    column). Rows with a null id, or a vector that ``scaled`` rejects, take no part;
    only vectors of the query's length are its candidates. A candidate that bears the
    query's id is its own row; repeated candidates count each, a repeated query id is
    searched once, with the smallest of its vectors. Fewer candidates give fewer rows;
    an empty table gives none.
    """
    valid = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col), scale).alias("v"),
                           is_query.alias("is_query")).filter("vec_id is not null and v is not null")
    data = materialise(deal(valid.select("vec_id", "v")), "knn-blocks")
    asked = valid.filter("is_query").select("vec_id").distinct()
    queries = (data.join(asked, "vec_id", "left_semi").groupBy("vec_id", "dim")
               .agg(F.min(F.struct("v", "block")).alias("m"))
               .select(F.col("vec_id").alias("query_id"), "dim", F.col("m.v").alias("q"), F.col("m.block").alias("home")))
    queries = materialise(queries, "knn-queries")
    groups = max(1, -(-queries.count() // QUERY_GROUP))
    found = "query_id long, vec_id long, score long"

    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        dim = int(x["dim"].iloc[0])
        floor = q["floor"].to_numpy(np.float64) if "floor" in q else None
        ids = q["query_id"].to_numpy(np.int64)
        got = search(ids, _matrix(q["q"], dim), x["vec_id"].to_numpy(np.int64), _matrix(x["v"], dim), k, floor)
        return pd.DataFrame({"query_id": ids[got["query"]], "vec_id": got["vec_id"], "score": got["score"]})

    group = F.pmod(F.xxhash64("query_id"), F.lit(groups))
    tagged = queries.withColumn("group", group)
    copies = data.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    at_home = (tagged.withColumnRenamed("home", "block").groupBy("block", "group")
               .cogroup(copies.groupBy("block", "group")).applyInPandas(run, found))
    at_home = materialise(at_home, "knn-home")
    floors = (at_home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
              .select("query_id", F.when(F.col("n") >= k, F.col("low").cast("double")).otherwise(float("-inf")).alias("floor")))
    blocks = data.select(F.col("block").alias("other"), F.col("dim").alias("o_dim")).distinct()
    away = (tagged.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
            .join(blocks, F.col("dim") == F.col("o_dim")).filter("other <> home")
            .select("query_id", "q", "floor", F.col("other").alias("block"), "group"))
    far = away.groupBy("block", "group").cogroup(copies.groupBy("block", "group")).applyInPandas(run, found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return (at_home.union(far).withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
