"""Pieces of Arrow batches, by the rules of ``split_pieces``."""
import random

import models as M
import numpy as np
import pyarrow as pa
import pytest

from tokenmill.operators import encode, pair_index, tokenizer, vocab
from tokenmill.operators.pieces import split_segments, split_texts

ALPHABET = " \t\r\nab  　é中Ġ\U0001F600 \x85\x1c  "


def test_split_texts_by_model():
    rnd = random.Random(1)
    for n in range(500):
        texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 6))]
        texts = [None if n % 3 == 0 and rnd.random() < 0.3 else t for t in texts]
        special = np.array([bool(t) and n % 2 == 0 and rnd.random() < 0.3 for t in texts], bool)
        want = [[] if not t else [t] if s else M.pieces(t) for t, s in zip(texts, special)]
        for skip in range(min(2, len(texts) + 1)):
            pieces, sizes = split_texts(pa.array(texts, pa.string()).slice(skip), special[skip:])
            assert pieces.to_pylist() == [p for w in want[skip:] for p in w]
            assert sizes.tolist() == [len(w) for w in want[skip:]]


def test_split_segments_marks_specials():
    kind = pa.list_(pa.struct([("text", pa.string()), ("special", pa.bool_())]))
    rows = [[{"text": "a  b", "special": False}, {"text": "<| x", "special": True}], None, [], [{"text": " c", "special": False}]]
    pieces, special, sizes = split_segments(pa.array(rows, kind))
    assert pieces.to_pylist() == ["a", "Ġ", "Ġb", "<| x", "Ġc"]
    assert special.tolist() == [False, False, False, True, False] and sizes.tolist() == [4, 0, 0, 1]


def test_segments_are_cut_by_their_text():
    kind = pa.list_(pa.struct([("text", pa.string()), ("special", pa.bool_())]))
    rows = [[{"text": "x" * 100, "special": False}]] * 5 + [None, []]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, kind)], ["s"])
    assert [b.num_rows for b in tokenizer.in_slices(batch, 0, 200)] == [2, 2, 3]
    assert [b.num_rows for b in tokenizer.in_slices(batch.slice(1), 0, 200)] == [2, 4]


@pytest.mark.parametrize("items", [1, 1 << 21])
def test_distinct_chars_count_documents(spark, monkeypatch, items):
    monkeypatch.setattr(vocab, "TEXT_BYTES", items)
    df = spark.createDataFrame([("  aab",), ("",), (None,), (" ",), ("b中",)], "text string")
    got = {r["ch"]: r["n_docs"] for r in vocab.distinct_chars(df).collect()}
    assert got == {"Ġ": 1, "a": 1, "b": 2, "中": 1}


def test_plans_split_no_text_by_patterns(spark):
    df = spark.createDataFrame([(0, 0, "a b <|endoftext|> c")], "shard_idx int, row_idx long, text string")
    plan = encode.distinct_pieces(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan.split("MapInArrow")[0]
    assert sorted(r["piece"] for r in encode.distinct_pieces(df).collect()) == ["a", "Ġ", "Ġb", "Ġc"]


@pytest.mark.parametrize("items", [1, 1 << 22])
def test_pair_sums_of_changed_strings(spark, monkeypatch, items):
    monkeypatch.setattr(pair_index, "PAIR_BYTES", items)
    df = spark.createDataFrame([(2, "abab"), (3, "xaby"), (5, "xyz"), (7, "a")], "w long, s string")

    def sums(**how):
        rows = pair_index.pair_sums(df, **how).groupBy("pair").sum("d", "changed").collect()
        return {r[0]: r[1] for r in rows if r[1]}, sum(r[2] for r in rows)
    assert sums() == ({"ab": 7, "ba": 2, "xa": 3, "by": 3, "xy": 5, "yz": 5}, 0)
    assert sums(before=[("ab", "N")], merges=[("Ny", "M")]) == ({"xN": -3, "Ny": -3, "xM": 3}, 1)
    assert sums(merges=[("ab", "N")]) == ({"ab": -7, "ba": -2, "xa": -3, "by": -3, "NN": 2, "xN": 3, "Ny": 3}, 2)
