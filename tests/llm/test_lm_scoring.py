"""LM scoring: counts and scores re-computed plainly, normalisation, held-out gain, odd rows."""
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tokenmill.llm import lm_scoring as L


def corpus(n=150):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        kind = rng.choice(["a", "b"])
        rows.append((i, " ".join(f"{kind}{min(int(rng.expovariate(0.15)), 400)}" for _ in range(rng.randint(0, 60)))))
    return rows


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def plain(rows):
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update(L.tokens(t))
    n, v = sum(c.values()), len(c)
    return c, n, v


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(L, "MODEL_WORDS", 20)


def test_against_a_plain_computation(spark, small):
    rows = corpus() + [(900, None), (901, ""), (902, "unseen WORDS É é a1"), (None, "a1 a2"), (7, "a1 a1"), (7, "a1 a1"), (903, "a1 " * 50_000)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    out = L.score_texts(df, head=50, steps=20)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = out.collect()
    c, n, v = plain(rows)
    # the same model, from plainly counted pairs
    words = [L.END] + sorted((w for w in c if w != L.END), key=lambda w: (-c[w], w))
    assert len(words) > 60  # more than the head
    own = words[:20]
    known = {w: i for i, w in enumerate(own)}
    out_of = lambda w: known[w] if w in known else 20 + zlib.crc32(w[-2:]) % L.CLASSES
    size = 20 + L.CLASSES
    pairs = np.zeros((size, size), np.float32)
    for i, t in rows:
        if not held(i):
            ids = [0] + [out_of(w) for w in L.tokens(t)]
            for a, b in zip(ids, ids[1:]):
                pairs[a, b] += 1
    table = L.LogBilinear(pairs, steps=20).log10_table()
    assert np.allclose((10.0 ** table.astype(float)).sum(axis=1), 1, atol=1e-5)
    in_class = Counter(), Counter()
    for w, k in c.items():
        if w not in known:
            in_class[0][out_of(w)] += k
            in_class[1][out_of(w)] += 1
    want = []
    for i, t in rows:
        ws = L.tokens(t)
        ids = [0] + [out_of(w) for w in ws]
        score = sum(float(table[a, b]) for a, b in zip(ids, ids[1:])) + sum(
            np.log10((c[w] + 1) / (in_class[0][out_of(w)] + in_class[1][out_of(w)] + 1)) for w in ws if w not in known)
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        want.append((i, held(i), len(ws), sum(w in c for w in ws), n, base, score))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5)


def test_classes_are_normalised():
    counts = {b"x1": 5, b"y1": 1}
    n, v = sum(counts.values()), len(counts)
    assert sum((c + 1) / (n + v + 1) for c in counts.values()) + 1 / (n + v + 1) == pytest.approx(1)


def test_beats_the_base_on_held_out_texts(spark, small):
    df = spark.createDataFrame(corpus(600), "doc_id long, text string")
    g = L.score_texts(df, head=100).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert g["sum(score)"] > 0.95 * g["sum(base_score)"]


def test_empty_and_untrained(spark, small):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.score_texts(df, steps=2).count() == 0
    only = next(i for i in range(100) if held(i))
    r = L.score_texts(spark.createDataFrame([(only, "a b")], "doc_id long, text string"), steps=2).first()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0)
    assert np.isfinite(r["score"])


def test_broadcasts_are_plain(spark, monkeypatch):
    """What tasks get is data, not classes of this package, which need not be installed there."""
    import pickle
    sent = []
    before = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, v: (sent.append(v), before(sc, v))[1])
    df = spark.createDataFrame([(i, f"a b c{i % 3}") for i in range(30)], "doc_id long, text string")
    assert L.score_texts(df).count() == 30
    assert sent and all(b"tokenmill" not in pickle.dumps(v) for v in sent)
