"""Lookup-table placement: table properties, a plain re-computation, odd rows."""
import hashlib

import pytest
from pyspark.sql import functions as F

from tokenmill.llm import sharding as S


def h(t):
    return int(hashlib.md5(t.encode()).hexdigest()[:15], 16)


def test_table_follows_turns_and_preferences():
    shards, m = [f"s{i}" for i in range(5)], 101
    orders = {s: [(h("offset:" + s) % m + j * (h("skip:" + s) % (m - 1) + 1)) % m for j in range(m)] for s in shards}
    assert all(sorted(o) == list(range(m)) for o in orders.values())
    owner = {}
    while len(owner) < m:
        for s in shards:
            if len(owner) < m:
                owner[next(x for x in orders[s] if x not in owner)] = s
    assert [shards[i] for i in S.lookup_table(shards, m)] == [owner[i] for i in range(m)]


def test_balance_and_small_moves():
    a = S.lookup_table(list(S.SHARDS))
    counts = [a.count(i) for i in range(len(S.SHARDS))]
    assert max(counts) - min(counts) <= 1
    b = S.lookup_table(list(S.SHARDS[:-1]))
    moved = sum(x != y for x, y in zip(a, b) if x < len(S.SHARDS) - 1)
    assert moved < 0.25 * len(a)


@pytest.mark.parametrize("shards,size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_arguments(shards, size):
    with pytest.raises(ValueError):
        S.lookup_table(shards, size)


def test_rows_nulls_ties_and_clashing_columns(spark):
    schema = "doc_id long, text string, slot string, __owner int"
    rows = [(1, "a", "x", 1), (1, "a", "x", 1), (2, None, None, None), (None, "t", "y", 2), (None, "t", "y", 3), (None, None, "z", 4),
            (3, "", "", 0), (4, "w" * 300_000, "q", 0)]
    df = spark.createDataFrame(rows, schema)
    out = S.assign_shards(df, S.document_key(F.col("doc_id"), F.col("text")))
    got = out.collect()
    assert out.columns == ["doc_id", "text", "__owner", "slot", "shard"] and len(got) == len(rows)
    table = S.lookup_table(list(S.SHARDS))
    for r in got:
        key = str(r["doc_id"]) if r["doc_id"] is not None else (
            "text:" + hashlib.md5(r["text"].encode()).hexdigest() if r["text"] is not None else "null")
        assert r["slot"] == h(key) % S.SIZE and r["shard"] == table[r["slot"]]
    assert S.assign_shards(df.limit(0), F.lit("k")).count() == 0
    assert S.assign_shards(df, F.lit(None).cast("string")).select("shard").distinct().count() == 1


def test_no_shuffle_of_documents_and_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = S.assign_shards(df, F.col("doc_id").cast("string"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
