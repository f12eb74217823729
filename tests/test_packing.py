"""Window packing: golden cases and random shards vs concatenate-then-chunk."""
import random

import models as M
from tokenmill.operators import packing


def _tokens_df(spark, shards_docs):
    rows = []
    for s, docs in enumerate(shards_docs):
        for r, toks in enumerate(docs):
            rows.append((s, r, len(toks), toks))
    return spark.createDataFrame(rows, "shard_idx int, row_idx long, n_tokens int, tokens array<int>")


def _windows(spark, shards_docs, ctx, n_val, n_test):
    w = packing.token_windows(_tokens_df(spark, shards_docs), ctx, n_val, n_test).collect()
    out = {"train": [], "val": [], "test": []}
    for r in w:
        out[r.split].append((r.shard_idx, r.chunk_idx, list(r.input_ids), list(r.target_ids)))
    return {k: sorted(v) for k, v in out.items()}


def test_windows_golden(spark):
    got = _windows(spark, [[list(range(10))]], 3, 0, 0)
    assert got["train"] == [(0, 0, [0, 1, 2], [1, 2, 3]), (0, 1, [4, 5, 6], [5, 6, 7])]


def test_split_golden(spark):
    got = _windows(spark, [[list(range(10))]], 1, 4, 3)
    assert [w[2] + [w[3][-1]] for w in got["val"]] == [[0, 1], [2, 3]]
    assert [w[2] + [w[3][-1]] for w in got["test"]] == [[4, 5]]
    assert [w[2] + [w[3][-1]] for w in got["train"]] == [[7, 8]]


def test_random_shards_match_model(spark):
    rng = random.Random(11)
    for _ in range(3):
        shards = [[[rng.randint(0, 99) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 6))]
                  for _ in range(rng.randint(1, 4))]
        ctx, nv, nt = rng.randint(1, 6), rng.randint(0, 25), rng.randint(0, 25)
        got = _windows(spark, shards, ctx, nv, nt)
        want = M.windows([sum(d, []) for d in shards], ctx, nv, nt)
        assert got == {k: sorted(v) for k, v in want.items()}


def test_split_invalid_name(spark):
    import pytest
    from tokenmill.validation import TokenmillError
    w = packing.token_windows(_tokens_df(spark, [[[1, 2, 3]]]), 1, 0, 0)
    with pytest.raises(TokenmillError):
        packing.select_split(w, "dev")


def test_worker_export(spark, scratch):
    from tokenmill.sources import sinks
    w = packing.token_windows(_tokens_df(spark, [[list(range(40))], [list(range(30))], [list(range(20))]]), 3, 8, 4)
    sinks.write_windows(w, scratch + "/win", 2)
    back = spark.read.parquet(scratch + "/win")
    got = {(r.split, r.worker): r["count"] for r in back.groupBy("split", "worker").count().collect()}
    assert got == {("val", 0): 2, ("test", 0): 1, ("train", 0): 7 + 5, ("train", 1): 7}
