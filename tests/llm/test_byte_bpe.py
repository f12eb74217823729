"""Byte-level BPE against the tokenizer library on whole texts; round trips; odd rows."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tokenmill.llm import byte_bpe as B
from tokenmill.llm.queries import op12_byte_bpe

PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return B.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    chars = "ab 'sStTéß\n\r\t    　\x1c\x85١½中🙂́_-.<|endoftext|>"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(1, 80))) for _ in range(150)]
    return texts + [
        None, "", " ", "  ", "\n\n x", "it's they'll I'VE 's''s", "a" * 5000, " " * 3000 + "b", "xyzzy" * 400, "éü" * 300, "\x01", "a\x01b \x01",
        "\U000105c0\U000105c1 a\U000105c2 9", "﷐ a", "\U00016d70\U00016d71x", "𐐀𐐁", "<|endoftext|>", "a" * 63, "ab" * 33, "!?" * 200, "12345" * 50, "the the the"]


@pytest.mark.parametrize("words", [1, 40, B.CHUNK_WORDS])
def test_whole_texts_against_the_library(spark, ranks, library, words):
    texts = odd_texts()
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3, "doc_id").sortWithinPartitions("doc_id", "text")
    encoded = B.encode(df, ranks, PATTERN, keep=("doc_id", "text"), words=words)
    got = B.decode(encoded, ranks).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")


def test_merge_against_the_library(ranks, library):
    rng = random.Random(1)
    words = ["".join(rng.choice("abeéz中") for _ in range(n)) for n in [1, 2, 3, 5, 9, 20, 40, 70, 200, 900] for _ in range(20)]
    for w in words:
        want = library.encode_ordinary(w)
        assert B.merge(w.encode(), ranks) == want
        assert w.encode() in ranks or B._merge_long(w.encode(), ranks) == want


def test_split_pattern_covers_every_text(spark):
    marked = F.regexp_replace("t", F.lit(B.split_pattern(PATTERN)), F.lit("\x02$0\x03"))
    df = spark.createDataFrame([(t,) for t in odd_texts() if t and "\x01" not in t], "t string").select("t", marked.alias("m"))
    assert all(r.m.replace("\x02", "").replace("\x03", "") == r.t and "\x03" not in r.m.replace("\x03\x02", "")[1:-1] for r in df.collect())


def test_varints():
    v = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 28) - 1, 5])
    data, ends = B.to_varints(v)
    back, stops = B.from_varints(data)
    assert back.tolist() == v.tolist() and stops.tolist() == ends.tolist()
    assert [len(x) for x in B.to_varints(v[:0])] == [0, 0]


def test_clashing_columns_and_no_rows(spark, ranks):
    df = spark.createDataFrame([(1, 2, 3, "a b")], "chunk int, `a.b` int, __row int, text string")
    got = B.encode(df, ranks, PATTERN, keep=("chunk", "a.b", "__row")).collect()
    assert [tuple(r[:3]) for r in got] == [(1, 2, 3)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert B.decode(B.encode(empty, ranks, PATTERN), ranks).collect() == []
    with pytest.raises(ValueError):
        B.encode(df.withColumnRenamed("chunk", "IDS"), ranks, PATTERN, keep=("IDS",))


def test_decode_odd_ids(spark, ranks):
    df = spark.createDataFrame([(1, [64, 65]), (2, []), (3, None), (4, [64, None]), (5, [10 ** 6]), (6, [-1])], "__row int, ids array<int>")
    got = {r["__row"]: r.decoded for r in B.decode(df, ranks).collect()}
    by_rank = {r: t for t, r in ranks.items()}
    assert got == {1: bytearray(by_rank[64] + by_rank[65]), 2: bytearray(), 3: None, 4: None, 5: None, 6: None}


def test_query(spark, library):
    got = {r.doc_id: r for r in op12_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = library.encode_ordinary(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())
