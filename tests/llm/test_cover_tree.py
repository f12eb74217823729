"""Dual-tree search against brute force; the tree's cover; odd rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenmill.llm import cover_tree as C


def plain(rows, every=50, k=5):
    valid = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            valid.append((i, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for q, a in valid:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -d) for n, (d, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("n,d,scale", [(600, 4, 1), (300, 3, 2 ** 29), (900, 64, 256), (200, 2, 0)])
def test_search_against_brute_force(n, d, scale):
    rng = np.random.default_rng(d)
    x = np.floor(rng.normal(size=(n, d)) * scale).astype(np.int64)
    x[n // 2:n // 2 + 100] = x[0]
    ids = rng.permutation(n)
    q = rng.choice(n, 70, replace=False)
    got = C.search(ids[q], x[q], ids, x)
    score = x[q].astype(object) @ x.T.astype(object)
    want = {(r, int(ids[j]), int(score[r, j])) for r in range(70) for j in sorted((j for j in range(n) if ids[j] != ids[q[r]]), key=lambda j: (-score[r, j], ids[j]))[:5]}
    assert {tuple(map(int, t)) for t in got[["query", "vec_id", "score"]].to_numpy()} == want


def test_floors_only_drop_what_does_not_matter():
    rng = np.random.default_rng(0)
    x, ids = rng.integers(-50, 50, (500, 8)), np.arange(500)
    full = C.search(ids[:20], x[:20], ids, x)
    low = full.groupby("query")["score"].min().to_numpy().astype(float)
    assert full.sort_values(["query", "score", "vec_id"]).reset_index(drop=True).equals(
        C.search(ids[:20], x[:20], ids, x, floor=low).sort_values(["query", "score", "vec_id"]).reset_index(drop=True))


def test_tree_covers():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(3000, 5)), np.zeros((500, 5)), rng.normal(50, 1, (7, 5))])
    order, root = C.build(x)
    assert sorted(order.tolist()) == list(range(len(x)))
    todo, depth = [(root, 0)], 0
    while todo:
        n, k = todo.pop()
        depth = max(depth, k)
        assert np.sqrt(((x[order[n.start:n.end]] - n.center) ** 2).sum(axis=1)).max() <= n.radius + 1e-9
        if n.children:
            assert [c.start for c in n.children] == [n.start] + [c.end for c in n.children[:-1]] and n.children[-1].end == n.end
        else:
            assert n.end - n.start <= C.LEAF or n.radius == 0
        todo += [(c, k + 1) for c in n.children]
    assert depth < 12


def rows_of(n=400, d=6):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=d)]) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies, with ties in score
    rows += [(2000, None), (2050, []), (2100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2150, [float("nan")] * d), (2200, [float("inf")] + [0.0] * (d - 1)),
             (2250, [1.0, 2.0]), (2251, [3.0, 1.0]), (2300, [5.0]), (None, rows[0][1]), (2301, rows[0][1])]
    return rows


@pytest.mark.parametrize("block,group", [(C.BLOCK, C.QUERY_GROUP), (20, 3)])
def test_query_against_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(C, "QUERY_GROUP", group)
    monkeypatch.setattr(C.deal, "__defaults__", (8, block))
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, v int")
    got = C.top_k(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_few_repeated_and_empty(spark):
    schema = "vec_id long, embedding array<double>"
    run = lambda rows: sorted(map(tuple, C.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect()))
    assert run([]) == [] and run([(0, [1.0])]) == []
    assert run([(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run([(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])]) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]
