"""Text splitting: golden micro-cases and random strings vs the Python model."""
import random
import time

from pyspark.sql import functions as F

import models as M
from tokenmill.functions.text import (EOT, SPACE_MARK, preprocess_chars, special_segments,
                                      special_segments_many, split_pieces)
from tokenmill.operators.vocab import initial_vocab

G = SPACE_MARK


def _one(spark, expr_fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", expr_fn(F.col("t")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_space_marking_golden(spark):
    assert _one(spark, preprocess_chars, [" a  b"]) == [["a", G, G, "b"]]
    assert _one(spark, preprocess_chars, [""]) == [[]]


def test_pieces_golden(spark):
    got = _one(spark, split_pieces, ["a  b ", " \tfoo", "foo\tbar", "a\r\n\nb"])
    assert got == [["a", G, G + "b", G], [G + "foo"], ["foo", "bar"], ["a", "\r", "\n", "\n", "b"]]


def test_segments_golden(spark):
    def seg(mode):
        return lambda c: special_segments(c, [EOT], mode)
    a = "a" + EOT + "b"
    got = _one(spark, seg("leading"), [a, EOT + EOT + "a"])
    assert [[(s["text"], s["special"]) for s in r] for r in got] == [
        [("a", False), (EOT + "b", False)], [(EOT, True), (EOT, True), ("a", False)]]
    got = _one(spark, seg("all"), [a])
    assert [(s["text"], s["special"]) for s in got[0]] == [("a", False), (EOT, True), ("b", False)]


def test_initial_vocab_golden(spark):
    chars = spark.createDataFrame([("a",), ("Ω",)], "ch string")
    v = {r["token"]: r["text"] for r in initial_vocab(chars, [EOT]).collect()}
    assert v[97] == "a" and v[256] == EOT and v[257] == G and v[258] == "Ω" and len(v) == 259


def _random_text(rng, n):
    alphabet = ["a", "b", "Ω", " ", " ", "\t", "\r", "\n", "\x85", "　", "x", EOT, "Ġ"]
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_random_strings_match_model(spark):
    rng = random.Random(7)
    texts = [_random_text(rng, rng.randint(0, 40)) for _ in range(300)]
    assert _one(spark, preprocess_chars, texts) == [M.preprocess(t) for t in texts]
    assert _one(spark, split_pieces, texts) == [M.pieces(t) for t in texts]
    for mode in ("all", "leading"):
        got = _one(spark, lambda c: special_segments(c, [EOT, "ab"], mode), texts)
        want = [M.segments(t, [EOT, "ab"], mode) for t in texts]
        assert [[(s["text"], s["special"]) for s in r] for r in got] == want


def test_long_runs_split_in_linear_time(spark):
    import time
    text = "a" + "\t" * 1_000_000 + "b" + "\u00a0" * 100_000 + " c"
    began = time.time()
    assert _one(spark, split_pieces, [text]) == [["a", "b", G + "c"]]
    assert time.time() - began < 20


def test_automaton_equals_the_alternation(spark):
    """Specials that hold, overlap and follow each other, in both modes, NULL and empty texts."""
    rng = random.Random(4)
    for trial in range(4):
        specials = ["".join(rng.choice("ab<") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 9))]
        texts = ["".join(rng.choice("ab<c") for _ in range(rng.randint(0, 25))) for _ in range(60)] + ["", "\n\n", "🙂ab", None]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        for mode in ("all", "leading"):
            got = {r.i: r.s for r in df.select("i", special_segments_many(F.col("t"), specials, mode).alias("s")).collect()}
            for i, t in enumerate(texts):
                assert (got[i] is None) == (t is None)
                assert t is None or [(s.text, s.special) for s in got[i]] == M.segments(t, specials, mode), (t, specials, mode)


def test_thousands_of_specials_in_linear_time(spark):
    specials = [f"<{i}>" for i in range(5000)]
    seconds = []
    for n in (20_000, 80_000):
        text = "".join(f"word <{i % 7000}> " for i in range(n))
        df = spark.createDataFrame([(text,)], "t string").select(F.size(special_segments(F.col("t"), specials)).alias("n"))
        start = time.time()
        assert df.first()["n"] == 2 * sum(i % 7000 < 5000 for i in range(n)) + 1
        seconds.append(time.time() - start)
    assert seconds[1] < 20 * max(seconds[0], 0.5)
