"""Hard negatives against brute force; the spanning tree and its bounds; odd rows."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenmill.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>, v int"


def plain(rows, every=100):
    valid = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, l, v in rows
             if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, l, a) in enumerate(valid):
        if i % every:
            continue
        s = [(-sum(x * y for x, y in zip(a, b)), j, m) for k, (j, m, b) in enumerate(valid) if k != at and len(a) == len(b)]
        for d, j, _ in sorted(x for x in s if x[2] == l)[:5]:
            fits = sorted((e, n) for e, n, m in s if m != l and -30 * d <= -100 * e <= -90 * d)[:10]
            out += [(i, j, r + 1, n, -d, -e) for r, (e, n) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], schema)
    out = H.mine_negatives(df, F.col("vec_id") % 100 == 0, F.col("label"), **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, d)) * 2
    return [(i * 10, int(rng.integers(4)), [float(x) for x in centers[i % 12] + rng.normal(size=d) * 0.2]) for i in range(n)]


@pytest.mark.parametrize("block,group", [(H.BLOCK, H.GROUP), (40, 7)])
def test_against_brute_force(spark, block, group):
    rows = clustered(500, 6, 3)
    rows += [(5000 + i, i % 3, rows[9][2]) for i in range(80)]  # copies: ties, in one block
    rows += [(6000, None, rows[0][2]), (6100, 1, None), (6200, 1, [None] * 6), (6300, 2, [float("nan")] * 6), (6400, 2, [float("inf")] * 6),
             (6500, 1, []), (6501, 1, []), (6502, 2, []), (6600, 0, [1.0, 2.0]), (6601, 0, [2.0, 2.0]), (6602, 3, [0.5, 2.0]),
             (None, 1, rows[0][2]), (0, 1, rows[5][2]), (0, 1, rows[5][2]), (6700, 1, [0.0] * 6)]
    assert mined(spark, rows, block=block, group=group) == plain(rows)


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(7)
    rows = [(i * 25, i % 2, [float(np.floor(x)) for x in rng.integers(1, 2 ** 21, 5)]) for i in range(60)]
    rows += [(10000 + i, 1, [float(2 ** 21 + i % 2)] * 5) for i in range(6)]
    got = mined(spark, rows, block=16, group=2)
    assert got == plain(rows) and max(r[4] for r in got) > 2 ** 53
    with pytest.raises(Exception, match="does not fit a long"):
        mined(spark, [(0, 1, [1e12] * 3), (1, 1, [1e12] * 3)])


def test_few_rows_and_clashing_names(spark):
    assert mined(spark, []) == [] and mined(spark, [(0, 1, [1.0])]) == [] and mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    df = spark.createDataFrame([(0, 1, [1.0], 5, "x"), (1, 1, [2.0], 6, "y"), (2, 2, [1.0], 7, "z")],
                               "row long, block int, v array<double>, `a.b` int, grp string")
    got = H.mine_negatives(df, F.col("row") == 0, F.col("block"), id_col="row", vector_col="v")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 256 * 512, 256 * 256)]


def test_spanning_tree():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    order, parent, length = H.spanning_tree(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    seen = set()
    for c in order:
        assert parent[c] == -1 and not seen or parent[c] in seen
        assert parent[c] == -1 or abs(length[c] - d[c, parent[c]]) < 1e-12
        seen.add(c)
    assert len(seen) == 60
    group, total = list(range(60)), 0.0  # Kruskal
    for i, j in sorted(((i, j) for i in range(60) for j in range(i)), key=lambda p: d[p]):
        if group[i] != group[j]:
            total += d[i, j]
            group = [group[i] if g == group[j] else g for g in group]
    assert abs(total - length.sum()) < 1e-9
    assert H.spanning_tree(np.zeros((4, 2)))[2].tolist() == [0.0] * 4 and H.spanning_tree(np.zeros((0, 2)))[0] == []


def test_intervals_hold_and_most_candidates_are_not_scored():
    rng = np.random.default_rng(1)
    anchors = np.floor(1000 + rng.normal(size=(40, 8)) * 5)
    x = np.floor(rng.normal(size=(400, 8)) * 100)
    scores = anchors @ x.T

    def visit(c, low, high, score):
        assert (low <= scores[c]).all() and (high >= scores[c]).all()
        at = np.flatnonzero(high >= np.sort(scores[c])[-5])
        assert (score(at) == scores[c][at]).all()

    assert H.walk(anchors, x, visit) < 400 + 40 * 60


def test_window():
    assert [H.window(s) for s in (100, 0, 101, 7)] == [(30, 90), (0, 0), (31, 90), (3, 6)]
    low, high = H.window(-10)
    assert low > high


def test_pairs_that_cannot_matter_are_left_out(spark):
    ball = lambda i, c, **k: dict(dim=2, center=c, radius=1.0, **k)
    groups = spark.createDataFrame(pd.DataFrame([ball(0, [10.0, 0.0], grp="a", least=50.0, most=1e9), ball(1, [0.0, 10.0], grp="b", least=-1e9, most=-50.0)]))
    blocks = spark.createDataFrame(pd.DataFrame([ball(0, [10.0, 0.0], block="x"), ball(1, [0.0, -10.0], block="y"), ball(2, [0.0, 0.0], block="z")]))
    assert sorted(map(tuple, H.near_pairs(groups, blocks).collect())) == [("a", "x"), ("b", "y")]
