"""Hard negatives of anchors, by bounds along a spanning tree of the anchors.

An anchor's positives are its highest-scoring rows of its own label. Its hard negatives
for a positive are the highest-scoring rows of other labels whose score lies in a window
relative to the positive's score. Scores are exact inner products of scaled integer
vectors.

The bound. Anchors that are worked on together form a minimum spanning tree. If ``p`` is
the parent of anchor ``c``, then for every candidate ``x``

    | <c, x> - <p, x> |  <=  |c - p| |x|,

so an interval that holds the parent's score, widened by the edge's length times the
candidate's norm, holds the child's. Only candidates whose interval overlaps what the
child looks for (at least its worst kept score; inside one of its windows) are scored;
the others keep their interval for the child's own children.

On Spark. Rows are dealt to blocks around pivots and anchors to groups around fewer
pivots; centers, radii and the groups' loosest thresholds decide which (group, block)
pairs are looked at, before any vector moves. There are two sweeps, positives first.
Each starts in every anchor's own block, which gives worst kept scores, and goes on over
the pairs that remain. Every row is dealt, and a pair, an interval or a candidate is left
out only by its bound, so results are exact.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

POSITIVES, NEGATIVES = 5, 10
#: A negative's score is from 30 % to 90 % of its positive's.
LOWEST, HIGHEST = Fraction(30, 100), Fraction(90, 100)
SCALE = 256
#: Rows of a block and anchors of a group, about; most pivots (a sample drawn by hash).
BLOCK, GROUP, PIVOTS = 4096, 512, 4096
#: Summaries of blocks or groups that are compared as one matrix.
SUMMARIES = 1024


# --- inside a task -----------------------------------------------------------------

def spanning_tree(points: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """``(order, parent, length)`` of a minimum spanning tree; the root has parent -1. The order
    is depth first with the largest subtree last, so few parents wait for a child at a time."""
    n = len(points)
    joined, parent, length = [], np.full(n, -1), np.zeros(n)
    at = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
    best, via, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    for i in range(n):
        joined.append(at)
        parent[at], length[at], left[at] = via[at], best[at] if i else 0.0, False
        d = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = left & (d < best)
        best[closer], via[closer] = d[closer], at
        at = int(np.where(left, best, np.inf).argmin())
    size, children = np.ones(n, np.int64), [[] for _ in range(n)]
    for c in reversed(joined[1:]):
        size[parent[c]] += size[c]
        children[parent[c]].append(c)
    order, todo = [], joined[:1]
    while todo:
        order.append(at := todo.pop())
        todo.extend(sorted(children[at], key=lambda c: -size[c]))
    return order, parent, length


def exact_scores(a: np.ndarray, x: np.ndarray, small: bool) -> np.ndarray:
    """Inner products of the integer vector ``a`` with the rows of ``x`` (doubles that hold
    integers): doubles where these hold every sum (``small``), else Python integers. A score
    that a long cannot hold is an error."""
    if small:
        return x @ a
    left = [int(v) for v in a]
    out = [sum(p * int(q) for p, q in zip(left, row)) for row in x.tolist()]
    if any(abs(s) >= 2 ** 63 for s in out):
        raise ValueError("a score does not fit a long")
    return np.array([*out, None], object)[:-1]


def below(score: float) -> float:
    """A double at or below a score that has been rounded to a double."""
    return score - abs(score) * 1e-15


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores, ties to smaller ids, in this order."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > 8 * k:  # everything from the k-th score on, then sorted
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= kth)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def walk(anchors: np.ndarray, x: np.ndarray, visit: Callable) -> int:
    """Visits anchors along their spanning tree; returns the number of scores computed.

    ``visit(anchor, low, high, score)`` gets intervals that hold the scores of all
    candidates and a function from candidate indices to their exact scores.
    """
    order, parent, length = spanning_tree(anchors)
    norms = np.sqrt((x ** 2).sum(axis=1))
    sizes = np.sqrt((anchors ** 2).sum(axis=1))
    children = np.bincount(parent[parent >= 0], minlength=len(anchors))
    small = x.shape[1] * float(np.abs(anchors).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2 ** 53
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    computed = 0
    for c in order:
        p = int(parent[c])
        if p < 0:
            low, high = np.full(len(x), -np.inf), np.full(len(x), np.inf)
        else:
            # Rounding of norms, distances and sums is far below this slack.
            slack = length[c] * norms * (1 + 1e-9) + (sizes[c] + sizes[p]) * norms * 1e-12 + 1e-6
            low, high = known[p][0] - slack, known[p][1] + slack

        def score(at: np.ndarray, c: int = c, low: np.ndarray = low, high: np.ndarray = high) -> np.ndarray:
            nonlocal computed
            computed += len(at)
            s = exact_scores(anchors[c], x[at], small)
            near = s.astype(np.float64)
            gap = np.abs(near) * 1e-15 if s.dtype == object else 0.0
            low[at], high[at] = near - gap, near + gap
            return s

        visit(c, low, high, score)
        if p < 0 and children[c]:  # the root's children need finite intervals
            at = np.flatnonzero(np.isinf(high))
            if len(at):
                score(at)
        if children[c]:
            known[c] = (low, high)
        if p >= 0:
            children[p] -= 1
            if not children[p]:
                del known[p]
    return computed


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, 0))


def find_positives(q: pd.DataFrame, x: pd.DataFrame, k: int = POSITIVES) -> pd.DataFrame:
    """``(anchor_row, positive_id, score)``: of the rows of ``x``, those that may be among the
    ``k`` positives of the anchors ``q``, whose column ``floor`` is a score to be reached (or null)."""
    a, v = _matrix(q["v"]), _matrix(x["v"])
    ids, rows, labels = x["vec_id"].to_numpy(np.int64), x["row"].to_numpy(np.int64), x["label"].to_numpy(np.int64)
    mine, own, floors = q["row"].to_numpy(np.int64), q["label"].to_numpy(np.int64), q["floor"].tolist()
    out: list[tuple] = []

    def visit(c: int, low: np.ndarray, high: np.ndarray, score: Callable) -> None:
        fits = np.flatnonzero((labels == own[c]) & (rows != mine[c]))
        if floors[c] is not None and floors[c] == floors[c]:
            fits = fits[high[fits] >= below(float(floors[c]))]
        if len(fits) > 8 * k and np.isfinite(high[fits]).all():
            # The likeliest first: their k-th score rules out more.
            likely = fits[np.argpartition(-high[fits], 4 * k)[:4 * k]]
            s = score(likely)
            fits = fits[high[fits] >= below(float(s[first(s, ids[likely], k)[-1]]))]
        if len(fits):
            s = score(fits)
            for i in first(s, ids[fits], k).tolist():
                out.append((mine[c], ids[fits[i]], int(s[i])))

    if len(q) and len(x):
        walk(a, v, visit)
    return pd.DataFrame(out, columns=["anchor_row", "positive_id", "score"])


def window(score: int) -> tuple[int, int]:
    """Lowest and highest score of a negative for a positive's score; empty if low > high."""
    return ceil(LOWEST * score), floor(HIGHEST * score)


def find_negatives(q: pd.DataFrame, x: pd.DataFrame, k: int = NEGATIVES) -> pd.DataFrame:
    """``(anchor_row, positive, negative_id, score)``: of the rows of ``x``, those that may be among
    the ``k`` negatives of an anchor and its positive, a place in the anchor's ``scores``."""
    a, v = _matrix(q["v"]), _matrix(x["v"])
    ids, labels = x["vec_id"].to_numpy(np.int64), x["label"].to_numpy(np.int64)
    mine, own = q["row"].to_numpy(np.int64), q["label"].to_numpy(np.int64)
    scores, floors = q["scores"].tolist(), q["floors"].tolist()
    out: list[tuple] = []

    def visit(c: int, low: np.ndarray, high: np.ndarray, score: Callable) -> None:
        wanted = []
        for j, (s, f) in enumerate(zip(scores[c], floors[c])):
            lo, hi = window(int(s))
            lo = lo if f is None or f != f else max(lo, ceil(below(float(f))))
            if lo <= hi:
                wanted.append((j, lo, hi))
        if not wanted:
            return
        other = labels != own[c]
        overlaps = np.zeros(len(x), bool)
        for _, lo, hi in wanted:
            overlaps |= (high >= lo - abs(lo) * 1e-15) & (low <= hi + abs(hi) * 1e-15)
        at = np.flatnonzero(overlaps & other)
        if not len(at):
            return
        s = score(at)
        for j, lo, hi in wanted:
            inside = np.flatnonzero((s >= lo) & (s <= hi))
            for i in inside[first(s[inside], ids[at[inside]], k)].tolist():
                out.append((mine[c], j, ids[at[i]], int(s[i])))

    if len(q) and len(x):
        walk(a, v, visit)
    return pd.DataFrame(out, columns=["anchor_row", "positive", "negative_id", "score"])


# --- blocks, groups and pairs ----------------------------------------------------------

def deal(rows: DataFrame, block: int, group: int) -> DataFrame:
    """``rows`` (vec_id, label, is_anchor, v) with integer components, a unique ``row``, ``dim``,
    ``block``, and ``grp`` (null if not an anchor)."""
    rows = rows.withColumn("dim", F.size("v"))
    n, n_anchors = rows.agg(F.count("*"), F.count(F.when(F.col("is_anchor"), 1))).first()
    pivots = min(PIVOTS, 2 * n // block)
    share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 40)) < int((1 << 40) * (pivots / max(n, 1)))
    sample = sorted(map(tuple, rows.filter(share).select("dim", "v").distinct().collect())) if pivots > 1 else []
    fine = {d: np.floor(np.array([v for e, v in sample if e == d], np.float64)) for d, _ in sample}
    groups = -(-n_anchors // group)
    coarse = {d: c[:: max(1, len(c) // groups)] for d, c in fine.items()} if groups > 1 else {}

    def nearest(centers: dict[int, np.ndarray], dim: int, x: np.ndarray) -> np.ndarray:
        if dim not in centers:
            return np.full(len(x), -1)
        c = centers[dim]
        return ((c ** 2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cell, near = np.full(len(b), -1), np.full(len(b), -1)
            whole = [np.floor(v) for v in b["v"]]
            for dim, at in b.groupby("dim").indices.items():
                if dim:
                    x = np.stack([whole[i] for i in at])
                    cell[at], near[at] = nearest(fine, dim, x), nearest(coarse, dim, x)
            yield b.assign(v=whole, cell=cell.astype(np.int32), near=near.astype(np.int32))

    dealt = rows.mapInPandas(place, "vec_id long, label long, is_anchor boolean, v array<double>, dim int, cell int, near int")
    dealt = materialise(dealt.withColumn("row", F.monotonically_increasing_id()), "negatives-dealt")
    # Large cells are cut by a hash. One row a cell: the planner sees the size.
    cells = dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / block).alias("parts"))
    nears = dealt.filter("is_anchor").groupBy("dim", "near").agg(F.ceil(F.count("*") / group).alias("near_parts"))
    out = dealt.join(cells, ["dim", "cell"]).join(nears, ["dim", "near"], "left")
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    return out.select("row", "vec_id", "label", "is_anchor", "dim", "v", F.concat_ws(":", "dim", "cell", part("parts")).alias("block"),
                      F.when(F.col("is_anchor"), F.concat_ws(":", "dim", "near", part("near_parts"))).alias("grp"))


def _ball(rows: pd.DataFrame) -> tuple[list[float], float]:
    x = _matrix(rows["v"])
    center = x.mean(axis=0)
    return center.tolist(), float(np.sqrt(((x - center) ** 2).sum(axis=1)).max())


def block_balls(data: DataFrame) -> DataFrame:
    """``(dim, block, center, radius)`` of every block."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        center, radius = _ball(rows)
        return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "block": [rows["block"].iloc[0]], "center": [center], "radius": [radius]})
    return data.select("dim", "block", "v").groupBy("block").applyInPandas(run, "dim int, block string, center array<double>, radius double")


def group_balls(anchors: DataFrame) -> DataFrame:
    """``(dim, grp, center, radius, least, most)``: least and most score that any anchor looks for."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        center, radius = _ball(rows)
        return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "grp": [rows["grp"].iloc[0]], "center": [center], "radius": [radius],
                             "least": [rows["least"].min()], "most": [rows["most"].max()]})
    return anchors.select("dim", "grp", "v", "least", "most").groupBy("grp").applyInPandas(
        run, "dim int, grp string, center array<double>, radius double, least double, most double")


def near_pairs(groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(grp, block)``: pairs whose scores may lie between the group's least and most.

    Summaries are compared as matrices of about ``SUMMARIES`` rows each, so the frames
    that meet have few rows.
    """
    def chunks(df: DataFrame, key: str, names: list[str]) -> DataFrame:
        n = max(1, -(-df.count() // SUMMARIES))
        return df.groupBy("dim", F.pmod(F.xxhash64(key), F.lit(n)).alias("chunk")).agg(
            F.collect_list(F.struct(*names)).alias(f"{key}s")).drop("chunk")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for gs, bs in zip(b["grps"], b["blocks"]):
                g, c = np.array([r["center"] for r in gs], np.float64), np.array([r["center"] for r in bs], np.float64)
                rg, rc = np.array([r["radius"] for r in gs])[:, None], np.array([r["radius"] for r in bs])[None, :]
                ng, nc = np.sqrt((g ** 2).sum(axis=1))[:, None], np.sqrt((c ** 2).sum(axis=1))[None, :]
                middle, reach = g @ c.T, rg * nc + rc * ng + rg * rc
                reach = reach * (1 + 1e-9) + (ng + rg) * (nc + rc) * 1e-9 + 1e-6
                i, j = np.nonzero((middle + reach >= np.array([r["least"] for r in gs])[:, None])
                                  & (middle - reach <= np.array([r["most"] for r in gs])[:, None]))
                yield pd.DataFrame({"grp": [gs[k]["grp"] for k in i], "block": [bs[k]["block"] for k in j]})

    pairs = chunks(groups, "grp", ["grp", "center", "radius", "least", "most"]).join(
        chunks(blocks, "block", ["block", "center", "radius"]), "dim")
    return pairs.select("grps", "blocks").mapInPandas(run, "grp string, block string")


def sweep(anchors: DataFrame, data: DataFrame, pairs: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run`` on the anchors of every block at home (without ``pairs``), or on those of every pair of
    group and block that are not at home there."""
    def task(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        return run(q, x)

    if pairs is None:
        return anchors.groupBy("block").cogroup(data.groupBy("block")).applyInPandas(task, schema)
    away = anchors.withColumnRenamed("block", "home").join(pairs, "grp").filter("home <> block").drop("home")
    there = data.join(pairs, "block")
    return away.groupBy("grp", "block").cogroup(there.groupBy("grp", "block")).applyInPandas(task, schema)


# --- the operator -----------------------------------------------------------------------

def valid_rows(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    v = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double") * scale)
    ok = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(ok)


def mine_negatives(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   scale: int = SCALE, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` and ``label`` (an integer) are expressions over ``vectors``. A component x
    becomes floor(scale * x), x as double. An anchor's positives are the ``POSITIVES``
    highest-scoring other rows of its label, its negatives for a positive the ``NEGATIVES``
    highest-scoring rows of other labels with a score from ``LOWEST`` to ``HIGHEST`` times the
    positive's; ties go to the smaller id, and fewer are returned if there are no more. A
    positive with a negative score has an empty window.

    Rows with a null id, label or vector, or a null or non-finite (scaled) component take no
    part. Vectors of different lengths have no score with each other; empty ones all score
    0. Rows that share an id are rows of their own, as anchors (each gives its result), as
    positives and as negatives. A score beyond a long is an error. An empty table, or one
    without anchors, gives no rows.
    """
    data = materialise(deal(valid_rows(vectors, is_anchor, label, id_col, vector_col, scale), block, group), "negatives-blocks")
    blocks = materialise(block_balls(data), "negatives-balls")
    anchors = materialise(data.filter("is_anchor").select("row", F.col("vec_id").alias("anchor_id"), "label", "dim", "v", "block", "grp"), "negatives-anchors")
    data = data.select("row", "vec_id", "label", "v", "block")

    found = "anchor_row long, positive_id long, score long"
    home = materialise(sweep(anchors.withColumn("floor", F.lit(None).cast("long")), data, None, find_positives, found), "negatives-p-home")
    floors = home.groupBy("anchor_row").agg(F.when(F.count("*") >= POSITIVES, F.min("score")).alias("floor"))
    asked = anchors.join(floors, F.col("row") == F.col("anchor_row"), "left").drop("anchor_row").withColumn(
        "least", F.coalesce(F.col("floor").cast("double"), F.lit(float("-inf")))).withColumn("most", F.lit(float("inf")))
    asked = materialise(asked, "negatives-p-asked")
    pairs = materialise(near_pairs(materialise(group_balls(asked), "negatives-groups"), blocks), "negatives-p-pairs")
    far = sweep(asked.drop("least", "most", "dim"), data, pairs, find_positives, found)
    place = F.row_number().over(Window.partitionBy("anchor_row").orderBy(F.col("score").desc(), "positive_id"))
    positives = materialise(home.union(far).withColumn("at", place).filter(F.col("at") <= POSITIVES), "negatives-positives")

    found = "anchor_row long, positive int, negative_id long, score long"
    lists = positives.groupBy("anchor_row").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "score"))), lambda s: s["score"]).alias("scores"))
    asked = anchors.join(lists, F.col("row") == F.col("anchor_row")).drop("anchor_row")
    none = F.transform("scores", lambda s: F.lit(None).cast("long"))
    home = materialise(sweep(asked.withColumn("floors", none), data, None, find_negatives, found), "negatives-n-home")
    worst = home.groupBy("anchor_row", "positive").agg(F.when(F.count("*") >= NEGATIVES, F.min("score")).alias("floor"))
    worst = worst.groupBy("anchor_row").agg(F.map_from_entries(F.collect_list(F.struct("positive", "floor"))).alias("by"))
    floors = F.transform("scores", lambda s, i: F.try_element_at("by", i.cast("int")))
    asked = asked.join(worst, F.col("row") == F.col("anchor_row"), "left").withColumn("floors", F.coalesce(floors, none)).drop("anchor_row", "by")
    usable = F.filter(F.arrays_zip("scores", "floors"), lambda z: z["scores"] >= 0)
    low = F.array_min(F.transform(usable, lambda z: F.greatest(z["scores"] * float(LOWEST), F.coalesce(z["floors"].cast("double"), F.lit(0.0))) * (1 - 1e-12) - 1))
    asked = asked.withColumn("least", low).withColumn("most", F.array_max(F.transform(usable, lambda z: z["scores"] * float(HIGHEST) * (1 + 1e-12) + 1)))
    asked = materialise(asked.filter("least is not null"), "negatives-n-asked")
    pairs = materialise(near_pairs(materialise(group_balls(asked), "negatives-groups"), blocks), "negatives-n-pairs")
    far = sweep(asked.drop("least", "most", "dim"), data, pairs, find_negatives, found)
    place = F.row_number().over(Window.partitionBy("anchor_row", "positive").orderBy(F.col("score").desc(), "negative_id"))
    kept = home.union(far).withColumn("rank", place).filter(F.col("rank") <= NEGATIVES)
    names = anchors.select(F.col("row").alias("anchor_row"), "anchor_id")
    whose = positives.select("anchor_row", (F.col("at") - 1).alias("positive"), "positive_id", F.col("score").alias("positive_score"))
    return kept.join(whose, ["anchor_row", "positive"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
