"""Mixing against a plain apportionment; targets, quotas, whole documents."""
import hashlib
import random
import re
from fractions import Fraction

from tokenmill.llm import mixing as M


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def plain_targets(sizes):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = {s: w[s] for s in names if s not in capped}
        if not free:
            break
        rest = total - sum(capped.values())
        over = [s for s in free if Fraction(rest * w[s], sum(free.values())) >= 3 * sizes[s]]
        if not over:
            break
        capped.update({s: 3 * sizes[s] for s in over})
    return {s: Fraction(capped[s]) if s in capped else Fraction((total - sum(capped.values())) * w[s], sum(free.values())) for s in names}


def plain_quotas(targets, seats):
    won = {s: 0 for s in targets}
    order = list(targets)
    seq = []
    if sum(targets.values()):
        for _ in range(seats):
            best = max(order, key=lambda s: (targets[s] / (2 * won[s] + 1), -order.index(s)))
            won[best] += 1
            seq.append(best)
    return won, seq


def plain_mix(rows, shards=2, blocks=32):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = plain_targets(sizes)
    won, _ = plain_quotas({s: t for s, t in targets.items() if t}, shards * blocks)
    total, out = sum(sizes.values()), []
    for s in sizes:
        take = min(3 * sizes[s], won.get(s, 0) * total // (shards * blocks))
        mine = sorted((r for r in rows if r[2] == s), key=lambda r: hashlib.md5(f"mix-1:{r[0]}".encode()).hexdigest())
        first = 0
        for i, t, _ in mine:
            n = size(t)
            words = [(first + k) for k in range(n)]
            out.append((i, n, sizes[s], float(targets[s]), sum(len(range(p, take, sizes[s])) for p in words)))
            first += n
    return sorted(out)


def test_against_a_plain_mix(spark):
    rng = random.Random(5)
    for trial in range(3):
        rows = []
        for i in range(60):
            s = rng.choice(["a", "a", "a", "a", "b", "é", "z", None])
            rows.append((i, rng.choice([None, "", "x \t y\n", "w " * rng.randint(1, 40), "long " * 300 if trial == 1 else "o"]), s))
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = M.mix_sources(df, n_shards=2, blocks_per_shard=32)
        want = plain_mix(rows)
        have = sorted(tuple(r) for r in got.select("doc_id", "size", "source_size", "target", "taken").collect())
        assert [(a, b, c, e) for a, b, c, _, e in have] == [(a, b, c, e) for a, b, c, _, e in want]
        assert all(abs(x[3] - y[3]) < 1e-6 for x, y in zip(have, want))
        assert all(r[4] <= 3 * r[1] for r in have)


def test_quotas_are_integers_per_shard_and_house_monotone(spark):
    sizes = spark.createDataFrame([("a", 700), ("b", 200), ("c", 100), (None, 5)], "source string, source_size long")
    targets = M.source_targets(sizes)
    t = {r["source"]: r["target"] for r in targets.collect()}
    assert abs(sum(t.values()) - 1005) < 1e-9 and t[None] == 15.0
    rows = M.shard_quotas(targets, 4, 8).collect()
    order = ["a", "b", "c", None]
    _, seq = plain_quotas({s: Fraction(t[s]) for s in order}, 32)
    for shard in range(4):
        part = seq[shard * 8:shard * 8 + 8]
        assert {r["source"]: r["quota"] for r in rows if r["shard"] == shard} == {s: part.count(s) for s in set(part)}


def test_empty_odd_and_clashing(spark):
    schema = "doc_id long, text string, source string, size string, taken int"
    empty = spark.createDataFrame([], schema)
    assert M.mix_sources(empty).count() == 0 and M.mixed_documents(empty).count() == 0
    rows = [(1, None, None, "s", 1), (1, "", "a", "s", 2)]
    out = M.mix_sources(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 2 and {r["taken"] for r in out} == {0}
    rows = [(None, "one two three", "a", "s", 1)] * 3 + [(7, "x " * 50, "b", "t", 2), (7, "x " * 50, "b", "t", 2)]
    df = spark.createDataFrame(rows, schema)
    out = M.mix_sources(df)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"] and out.count() == 5
    mixed = M.mixed_documents(df)
    assert mixed.columns == df.columns and set(map(tuple, mixed.collect())) <= set(map(tuple, df.collect()))


def test_mixed_documents_follow_targets(spark):
    rows = [(i, "w " * 50, "a" if i % 10 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = {s: k for s, k in [(r["source"], r["count"]) for r in M.mixed_documents(df).groupBy("source").count().collect()]}
    assert n["b"] == 120 and abs(n["a"] - 280) <= 1


def test_small_sources_beside_a_hot_one_are_near_their_targets(spark):
    sizes = {"hot": 2_000_000, **{f"s{i}": n for i, n in enumerate([1, 2, 7, 30, 100, 400, 500, 600, 3000])}, None: 3}
    rows = [(i, "w " * 50_000, "hot") for i in range(sizes["hot"] // 50_000)]
    rows += [(1000 * k + i, "w", s) for k, (s, n) in enumerate(sizes.items(), 1) if s != "hot" for i in range(n)]
    got = M.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken = {r["source"]: r["t"] for r in got.groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "t").collect()}
    for s, t in plain_targets(sizes).items():
        assert abs(taken[s] - t) <= max(1, t / 16), (s, taken[s], float(t))


def test_more_sources_than_blocks(spark):
    rows = [(i, "w " * 20, f"s{i // 2:05d}") for i in range(10_000)]
    got = M.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    r = got.groupBy("source", "target").agg({"taken": "sum"}).collect()
    assert len(r) == 5000 and all(abs(x["sum(taken)"] - x["target"]) <= x["target"] / 16 for x in r)


def test_quotas_of_many_blocks_equal_a_plain_apportionment(spark):
    rng = random.Random(8)
    sizes = [(f"s{i:02d}", rng.choice([3, 50, 900, 40_000])) for i in range(30)]
    targets = M.source_targets(spark.createDataFrame(sizes, "source string, source_size long"))
    t = {r["source"]: r["target"] for r in targets.collect()}
    won, _ = plain_quotas(dict(sorted(t.items())), 3000)
    got = M.shard_quotas(targets, 3, 1000).groupBy("source").agg({"quota": "sum"}).collect()
    assert {r["source"]: r["sum(quota)"] for r in got} == {s: n for s, n in won.items() if n}
