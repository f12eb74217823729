"""Vector-table operators: strict matmul, tile invariance of the causal pool."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenmill.operators import vectors
from tokenmill.plans import catalog as C
from tokenmill.validation import TokenmillError


def test_strict_matmul(spark):
    a = spark.createDataFrame([(1, 0, 0, 2.0), (2, 0, 0, 1.0)], "batch int, i int, k int, v double")
    b = spark.createDataFrame([(1, 0, 0, 3.0)], "batch int, k int, j int, v double")
    with pytest.raises(TokenmillError):
        vectors.matmul_cells(a, b)
    b2 = spark.createDataFrame([(1, 0, 0, 3.0), (2, 0, 1, 4.0)], "batch int, k int, j int, v double")
    got = sorted(tuple(r) for r in vectors.matmul_cells(a, b2).collect())
    assert got == [(1, 0, 0, 6.0), (2, 0, 1, 4.0)]


@pytest.mark.parametrize("tile", [2, 5, 256])
def test_blocks_give_the_cells_of_the_product(spark, tile):
    rng = np.random.default_rng(tile)
    a = [(s, f"r{i}", int(k), float(v)) for s in (0, 1) for i in range(9) for k, v in enumerate(rng.integers(-2, 3, 11)) if rng.random() < 0.5]
    b = [(s, int(k), j * 10, float(v)) for s in (0, 1) for j in range(7) for k, v in enumerate(rng.integers(-2, 3, 13)) if rng.random() < 0.5]
    a += [a[0], (0, "lone", 99, 1.0), (0, "r0", 5, None)]  # a cell twice, no inner partner, no value
    left, right = spark.createDataFrame(a, "batch int, i string, k long, v double"), spark.createDataFrame(b, "batch int, k long, j int, v double")
    got = {(r.batch, r.i, r.j): r.v for r in vectors.matmul_blocks(left, right, tile).collect()}
    want = {(r.batch, r.i, r.j): r.v for r in vectors.matmul_cells(left.filter("v is not null"), right).collect()}
    assert got == want and got
    with pytest.raises(TokenmillError):
        vectors.matmul_blocks(left, right.filter("batch = 0"))


def test_block_rows_not_product_rows_are_shuffled(spark):
    cells = spark.range(64 * 64).select(F.lit(0).alias("batch"), (F.col("id") % 64).alias("i"), F.floor(F.col("id") / 64).alias("k"), F.lit(1.0).alias("v"))
    assert vectors.matrix_blocks(cells, "i", "k", 4, 4, 4).count() == 4 * 4 * 4
    got = vectors.matmul_blocks(cells, cells.withColumnRenamed("k", "j").withColumnRenamed("i", "k"), 16)
    assert got.count() == 64 * 64 and got.agg(F.min("v"), F.max("v")).first() == (64.0, 64.0)


def _direct(x, seqs, heads, history=None):
    out = {}
    d = x.shape[1]
    hd = d // heads
    for s in set(seqs):
        idx = [i for i in range(len(seqs)) if seqs[i] == s]
        for qi in idx:
            vis = [k for k in idx if k <= qi][-(history or len(idx)):]
            res = []
            for h in range(heads):
                sl = slice(h * hd, (h + 1) * hd)
                sc = np.array([x[qi, sl] @ x[k, sl] for k in vis]) / math.sqrt(hd)
                p = np.exp(sc - sc.max())
                p /= p.sum()
                res.extend((p[:, None] * x[vis][:, sl]).sum(axis=0))
            out[qi] = np.array(res)
    return out


@pytest.mark.parametrize("tile", [1, 3, 8, 64])
def test_causal_pool_tile_invariance(spark, tile):
    rng = np.random.default_rng(42)
    n, d = 20, 8
    x = rng.normal(size=(n, d))
    seqs = [i % 3 for i in range(n)]
    df = spark.createDataFrame([(int(seqs[i]), i, x[i].tolist()) for i in range(n)],
                               "seq long, pos long, v array<double>")
    got = {r.pos: np.array(r.out) for r in vectors.causal_pool(df, "seq", "pos", "v", n_heads=2, tile=tile).collect()}
    want = _direct(x, seqs, 2)
    assert set(got) == set(want)
    for k in want:
        assert np.allclose(got[k], want[k], atol=1e-12)


@pytest.mark.parametrize("tile,history", [(1, 1), (1, 5), (2, 3), (3, 1000), (64, 4)])
def test_bounded_history(spark, monkeypatch, tile, history):
    monkeypatch.setattr(vectors, "KEY_TILES", 2)
    monkeypatch.setattr(vectors, "QUERY_TILES", 3)
    rng = np.random.default_rng(7)
    n, d = 40, 4
    x = rng.normal(size=(n, d))
    seqs = [0 if i % 4 else 1 for i in range(n)]
    df = spark.createDataFrame([(seqs[i], i * 1000, x[i].tolist()) for i in range(n)], "seq long, pos long, v array<double>")
    got = {r.pos // 1000: np.array(r.out) for r in vectors.causal_pool(df, "seq", "pos", "v", n_heads=2, tile=tile, max_history=history).collect()}
    want = _direct(x, seqs, 2, history)
    assert set(got) == set(want) and all(np.allclose(got[k], want[k], atol=1e-12) for k in want)
    with pytest.raises(TokenmillError):
        vectors.causal_pool(df, "seq", "pos", "v", max_history=0)


def test_a_band_is_linear_in_the_sequence(spark):
    """Rows times key blocks: as many a row in a band, growing with the sequence without one."""
    def pairs(n, history):
        return vectors.query_blocks(spark.range(n).withColumnRenamed("id", "rank"), 4, history).count()
    block = 4 * vectors.KEY_TILES
    assert pairs(64 * block, 10) < 1.2 * 64 * block and pairs(256 * block, 10) < 1.2 * 256 * block
    assert pairs(64 * block, None) == sum(block * (b + 1) for b in range(64))


def test_causal_pool_heads_must_divide(spark):
    df = spark.createDataFrame([(0, 0, [1.0, 2.0, 3.0])], "seq long, pos long, v array<double>")
    with pytest.raises(TokenmillError):
        vectors.causal_pool(df, "seq", "pos", "v", n_heads=2)


def test_group_softmax_sums_to_one(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 700.0), (1, -700.0)], "g int, s double")
    got = vectors.group_softmax(df, "g", "s").groupBy("g").sum("p").collect()
    assert all(abs(r[1] - 1.0) < 1e-12 for r in got)


def test_the_null_group_has_shares(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (0, 1.0), (1, None)], "g int, s double")
    got = vectors.group_softmax(df, "g", "s").collect()
    assert len(got) == 4 and abs(sum(r.p for r in got if r.g is None) - 1) < 1e-12
    assert [r.p for r in got if r.g == 0] == [1.0] and [r.p for r in got if r.g == 1] == [None]


def test_hot_tokens_are_not_shuffled(spark, monkeypatch):
    """A table too large for a broadcast: hot tokens by broadcast, the others by shuffle, the same result."""
    rows = [(k, [0] * 50 + [k, 7, 99, None, 0, 1]) for k in range(40)]
    windows = spark.createDataFrame(rows, "chunk_idx int, input_ids array<int>")
    tok = spark.createDataFrame([(t, [float(t), 1.0]) for t in range(45)], "token int, vec array<double>")
    pos = spark.createDataFrame([(p, [0.5, float(p)]) for p in range(60)], "pos int, vec array<double>")
    small = vectors.embed_tokens(windows, tok, pos).collect()
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", 100)
    monkeypatch.setattr(vectors, "HOT_SHARE", 20)
    large = vectors.embed_tokens(windows, tok, pos)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = large._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert any("BroadcastHashJoin" in j for j in joins) and any("SortMergeJoin" in j for j in joins), joins
        assert vectors.frequent_keys(windows.select(F.explode("input_ids").alias("token")), "token", 20) == [0]
        key = lambda r: (r.chunk_idx, r.pos)
        assert sorted(large.collect(), key=key) == sorted(small, key=key)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.pos, r.emb is None) for r in small} == {(p, p in (52, 53)) for p in range(56)}


def test_measured_embeddings_equal_the_rows(spark, monkeypatch):
    """Unknown, NULL and repeated tokens, short vectors and missing entries: sums and counts as from a row a position,
    with tables that every task has and with larger ones."""
    windows = spark.createDataFrame([(0, [1, 2, 1, None]), (1, [3, 77]), (2, [4, 5, 6, 1]), (3, []), (4, None), (None, [-5, 10**6, 7]), (5, [77, 3]), (5, [2])],
                                    "chunk_idx int, input_ids array<int>")
    tok = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 0.5]), (2, [1.0, 1.0]), (3, None), (4, [1.0]), (5, [None, 2.0]), (None, [9.0, 9.0]),
                                 (6, [1.5, -2.0]), (10**6, [4.0, 4.0]), (7, [])], "token int, vec array<float>")
    pos = spark.createDataFrame([(0, [0.5, 0.25]), (1, [1.0, 1.0]), (1, [2.0, 3.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "pos long, vec array<float>")
    rows = vectors.embed_tokens(windows, tok, pos).collect()
    want = {}
    for r in rows:
        total, unknown = want.get(r.chunk_idx, (None, 0))
        if r.emb is None:
            unknown += 1
        elif None not in r.emb:
            total = (total or 0.0) + sum(x * x for x in r.emb)
        want[r.chunk_idx] = total, unknown

    def measured():
        out = vectors.embed_tokens(windows, tok, pos, measure=vectors.sum_of_squares).groupBy("chunk_idx").agg(F.sum("total"), F.sum("unknown"))
        return {r[0]: (r[1], r[2]) for r in out.collect()}
    assert measured() == want and len(want) == 5
    monkeypatch.setattr(vectors, "MEASURE_CELLS", 5)
    monkeypatch.setattr(vectors, "SPARSE_TOKENS", 0)
    assert measured() == want
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", 20)
    assert measured() == want
    for size in (20, 1 << 20):
        monkeypatch.setattr(vectors, "BROADCAST_BYTES", size)
        with pytest.raises(Exception, match="position 3 exceeds the position table"):
            vectors.embed_tokens(windows, tok, pos.filter("pos < 3"), measure=vectors.sum_of_squares).collect()


def test_the_query_makes_no_row_a_position(spark, tmp_path):
    """embed_tokens (F1): a window's embeddings are made by arrays, not by a join and a lambda a position."""
    spark.createDataFrame([(i, "some words to embed " * 40) for i in range(8)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[(F.col("id") % (j + 2)).cast("float") for j in range(4)]).alias("embedding")).write.parquet(
        f"{tmp_path}/embeddings.parquet")
    out = C.QUERIES["embed_tokens"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "zip_with" not in plan and "MapInArrow" in plan
    assert out.agg(F.count("sumsq")).first()[0] > 0


def test_standardize_rejects_wrong_dim(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])], "id int, v array<double>")
    ok, bad = vectors.standardize_vectors(df, "v", 2)
    assert [r.id for r in ok.collect()] == [0] and [r.id for r in bad.collect()] == [1]
    np.testing.assert_allclose(ok.collect()[0].out, [-1 / math.sqrt(0.25 + 1e-5) * 0.5,
                                                      1 / math.sqrt(0.25 + 1e-5) * 0.5])


def test_every_row_ends_in_result_or_rejects(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0, None]), (4, [])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    eye = [[1.0, 0.0], [0.0, 1.0]]
    for ok, bad in (vectors.standardize_vectors(df, "v", 2), vectors.project_vectors(df, "v", eye),
                    vectors.score_ffn(df, "v", eye, [0.0, 0.0], eye, [0.0, 0.0])):
        assert [r.id for r in ok.collect()] == [0]
        assert sorted(r.id for r in bad.collect()) == [1, 2, 3, 4]
        assert all(r.reason for r in bad.collect())


def test_causal_pool_sparse_positions_and_many_key_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "KEY_TILES", 2)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 4))
    seqs = [0] * 25 + [1] * 5
    df = spark.createDataFrame([(seqs[i], i * 1_000_003, x[i].tolist()) for i in range(30)], "seq long, pos long, v array<double>")
    got = {r.pos // 1_000_003: np.array(r.out) for r in vectors.causal_pool(df, "seq", "pos", "v", n_heads=2, tile=3).collect()}
    want = _direct(x, seqs, 2)
    assert set(got) == set(want) and all(np.allclose(got[k], want[k], atol=1e-12) for k in want)
    assert vectors.causal_pool(df.limit(0), "seq", "pos", "v").count() == 0
