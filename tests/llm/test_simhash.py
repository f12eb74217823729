"""SimHash against brute force: fingerprints, distances, components, removal."""
import random
import re

import numpy as np
import pytest
import xxhash

from tokenmill.llm import simhash as S
from tokenmill.llm.components import connected_components

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps, radius=2):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def texts():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(50)] + ["É", "x\u00a0y", "Ünï", "A"]
    out = [None, "", " \t\r\n", "one", "One TWO", "one  two\x0bthree", "É é", "a\u00a0b c d"]
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 30, 400]))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(vocab)
            out.append(rng.choice([" ", "  ", "\n"]).join(near).upper())
    out.append("long " * 200_000 + "end")
    return out


def test_fingerprints():
    for t in texts():
        assert S.fingerprint(t) == plain_fingerprint(t)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 300])
def test_bit_planes_against_all_pairs(n):
    rng = np.random.default_rng(n)
    seeds = rng.integers(0, 2 ** 63, 4, dtype=np.uint64)
    values = set()
    while len(values) < n:
        x = int(rng.choice(seeds))
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            x ^= 1 << int(b)
        values.add(x)
    f = np.array(sorted(values), np.uint64)
    for radius in (1, 2, 3, 5):
        i, j = S.close_pairs(f, radius)
        assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(n) for b in range(a + 1, n) if int(f[a] ^ f[b]).bit_count() <= radius]


def test_abandoned_blocks_keep_links():
    rng = np.random.default_rng(1)
    f = np.unique(rng.integers(0, 2 ** 63, 3000, dtype=np.uint64))
    f = np.unique(np.concatenate([f, f[:50] ^ np.uint64(1 << 40), f[50:90] ^ np.uint64(3)]))
    i, j = S.close_pairs(f, 2)
    assert len(i) == 90
    assert all(int(f[a] ^ f[b]).bit_count() <= 2 for a, b in zip(i, j))


def test_components_of_documents(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    random.Random(1).shuffle(rows)
    rows += [(None, rows[0][1], "x"), (None, "nothing like it at all", "x"), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    group = plain_groups(fps)
    low = {}
    for (i, _, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(i, low.get(g, i))
    want = sorted(((i, f"{f:016x}", low.get(g)) for (i, _, _), f, g in zip(rows, fps, group)), key=str)
    assert sorted(map(tuple, S.near_duplicates(df).collect()), key=str) == want

    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert len(got) == len(set(group))
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((low.get(g) for g in set(group)), key=str)
    assert {tuple(r) for r in got} <= set(rows)


def test_chains_and_stars(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, -7), (-7, 5000), (9, 9)]
    edges = [(a, b) if rng.random() < .5 else (b, a) for a, b in edges]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 300)}, 5000: -7}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0 and S.drop_near_duplicates(df).count() == 0
