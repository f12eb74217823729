"""Decontamination against a plain scan, both join forms, spans and odd rows."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tokenmill.llm import decontaminate as D

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))


def plain(docs, items):
    out = []
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for p in range(len(w) - n + 1) if w else ():
            wins.setdefault(tuple(w[p:p + n]), set()).add(i)
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for p in range(len(w)):
            for n in range(1, 11):
                g = tuple(w[p:p + n])
                if len(g) == n and g in wins:
                    hit |= set(range(p, p + n))
                    found |= wins[g]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(3)
    vocab = ["the", "Cat", "sat", "on", "É", "ß", "7up", "don", "t"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, text(25)), (2, text(12)), (2, text(11)), (3, "only Four words here"), (4, None), (5, " ... "), (None, "nameless item"),
             (6, "single"), (10, "the cat sat")]
    items.append((7, items[0][1]))
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    docs += [(100, "before, " + items[0][1].upper() + " after"), (101, items[1][1] + " x " + items[1][1]), (102, None), (103, ""),
             (104, "ONLY four; WORDS\nhere single"), (None, "nameless-item"), (None, None), (105, "?? !!"),
             (106, "a " * 3000 + items[0][1] + " b" * 3000), (106, "other"), (107, "same"), (107, "same"), (100, "before, " + items[0][1])]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_against_a_plain_scan(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "BROADCAST_BYTES", limit)
    docs, items = cases()
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, window string, n_hit int")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(d, i)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_removal(spark):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    bad = [r[5] for r in [plain([x], items)[0] for x in docs]]
    kept = D.remove_documents(d, i)
    assert kept.columns == ["doc_id", "text"]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((x for x, b in zip(docs, bad) if not b), key=str)
    cut = {r["doc_id"]: r["text"] for r in D.remove_spans(d.filter("doc_id in (100, 101, 102, 105) and (text is null or text not like 'before, _% ')"), i).collect()}
    assert cut[102] is None and cut[105] == "?? !!" and cut[101].split() == ["x"]
    assert D.remove_spans(d.filter("doc_id = 104"), i).first()["text"].strip(" ;\n") == ""


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(d.limit(0), i).count() == 0
    r = D.contamination(d, i.limit(0)).collect()
    assert [tuple(x) for x in r] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert D.contamination(d, i).first()["n_hit"] == 2
    assert D.remove_documents(d, i.limit(0)).count() == 1


def test_long_runs_of_one_window(spark):
    d = spark.createDataFrame([(1, "x " * 20000)], "doc_id long, text string")
    i = spark.createDataFrame([("i", "x " * 15)], "item_id string, text string")
    r = D.contamination(d, i).first()
    assert (r["n_words"], r["n_hit"], r["n_items"]) == (20000, 20000, 1)
