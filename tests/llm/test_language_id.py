"""Language ID: plain out-of-place distances, held-out accuracy, odd rows."""
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tokenmill.llm import language_id as L

TABLE = np.unpackbits(L.letter_table()).astype(bool)


def plain_ngrams(text):
    out = Counter()
    word = ""
    for ch in (text or "").lower() + " ":
        if ch.isalpha():
            word += ch
        elif word:
            padded = "\x01" + word + "\x01"
            out.update(word)
            out.update(padded[i:i + 2] for i in range(len(padded) - 1))
            out.update(padded[i:i + 3] for i in range(len(padded) - 2))
            word = ""
    return out


def code(gram):
    n = 0
    for ch in gram:
        n = n << 21 | ord(ch)
    return n


def test_ngrams():
    for t in [None, "", "12 !!", "a", "Ab", "  Hello, wörld  ", "x1y", "日本 語", "\U0001d4d0b", "é" * 1000 + " z", "İstanbul"]:
        codes, counts = L.ngrams(t, TABLE)
        assert dict(zip(codes.tolist(), counts.tolist())) == {code(g): n for g, n in plain_ngrams(t).items()}


def test_distance():
    size = 5
    prof = {"a": np.array([1, 2, 3, 4, 5]), "b": np.array([9, 3, 2])}
    p = L.Profiles(prof, size)
    own = np.array([3, 1, 77, 9])

    def far(ranks):
        ranks = ranks.tolist()
        return sum(abs(ranks.index(g) - i) if g in ranks else size for i, g in enumerate(own.tolist()))
    d = {k: far(v) for k, v in prof.items()}
    best = min(sorted(d), key=d.get)
    assert p.predict(own) == (best, 1 - d[best] / (len(own) * size))
    assert p.predict(np.zeros(0, np.int64)) == ("und", 0.0) and L.Profiles({}).predict(own) == ("und", 0.0)


def corpus(n=240):
    rng = random.Random(8)
    words = {"xx": ["the", "and", "thing", "house", "over"], "yy": ["und", "schön", "haus", "über", "nicht"], "zz": ["大", "日本", "語学"]}
    return [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randint(1, 40))), k, "src") for i, k in
            ((i, rng.choice(list(words))) for i in range(n))]


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus() + [(1000, None, "xx", "s"), (1001, "", "yy", "s"), (1002, "123 ... !", None, "s"), (None, "the house", None, None),
                       (1003, "the and over " * 30_000, None, "s"), (5, "the and", "xx", "s"), (5, "the and", "xx", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    out = L.identify_languages(df, per_language=50)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"] and len(got) == len(rows)
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(key.encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["lang"]:
            assert r["lang_pred"] == r["lang"]
    assert {r["lang_pred"] for r in got if r["doc_id"] in (None, 1003)} == {"xx"}
    kept = L.reject_unidentified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3


def test_predictions_use_the_text_alone(spark):
    rows = corpus(80)
    a = L.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    other = [(*r[:2], "qq", "else") if r in held else r for r in rows]
    b = L.identify_languages(spark.createDataFrame(other, "doc_id long, text string, lang string, source string"))
    pick = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in d.collect())
    assert pick(a) == pick(b)


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert tuple(L.identify_languages(df).select("lang_pred", "score").first()) == ("und", 0.0)
    assert L.identify_languages(df.limit(0)).count() == 0
    assert L.identify_languages(df.limit(0)).select(F.count("*")).first()[0] == 0


def test_null_and_repeated_ids_leave_no_language_out(spark):
    rows = [(None if k == "xx" else 1 if k == "yy" else i, t, k) for i, t, k, _ in corpus(600)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    for per_language in (20, 0):  # with 0, one row of each language is left
        assert L.learn_profiles(df, per_language).langs == ["xx", "yy", "zz"]
    got = L.identify_languages(df, "id", per_language=20).collect()
    assert len(got) == 600 and all(r["lang_pred"] == r["lang"] for r in got)
