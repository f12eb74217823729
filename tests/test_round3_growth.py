"""Steps of the third round's findings whose time or memory grew too fast, on rows of their own."""
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tokenmill.functions.text import EOT, ints_to_text
from tokenmill.operators import bpe, encode, packing, tokenizer
from tokenmill.plans import catalog as C

TEXTS = ["the theme  then\n", "", None, f"aaab{EOT}ab the", "other Ωthing", f"{EOT}{EOT}", "éé é ab\tab", " "]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _documents(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return d


def test_pairs_of_a_corpus_without_its_table_of_pieces(spark, monkeypatch):
    """counts and first places are those of the table of pieces, which is not shuffled."""
    docs = spark.createDataFrame([(i % 4, i // 4, t) for i, t in enumerate(TEXTS * 2)], "shard_idx int, row_idx long, text string")
    odd = spark.createDataFrame([(None, 2, "zb az ab"), (0, None, "qz qa"), (None, None, "qq")], docs.schema)
    for rows in (docs, docs.unionByName(odd).coalesce(1)):
        for n_bytes in (1, 1 << 21):
            monkeypatch.setattr(bpe, "TEXT_BYTES", n_bytes)
            found = bpe.corpus_pair_counts(rows)
            plan = _plan(found)
            assert plan.count("MapInArrow") == 1 and "keys=[s#" not in plan
            got = {r.pair: (r.n, r["first"]) for r in found.collect()}
            want = {r.pair: (r.n, r["first"]) for r in bpe.pair_counts(bpe.piece_blocks(rows), boundaries=False).collect()}
            assert got == want


def test_repeated_keys_have_the_least_first_place(spark):
    rows = spark.createDataFrame([(0, 1, "xx yy ab"), (0, 1, "ab"), (0, 1, f"{EOT}zab"), (None, None, "b ab"), (None, None, "ab b")],
                                 "shard_idx int, row_idx long, text string").coalesce(1)
    got = {r.pair: r for r in bpe.corpus_pair_counts(rows).collect()}
    assert got["ab"].n == 5 and tuple(got["ab"]["first"]["bkey"]) == (None, None, 0, 0) and got["ab"]["first"]["idx"] == 0
    alone = bpe.corpus_pair_counts(rows.filter("shard_idx = 0")).filter("pair = 'ab'").first()
    assert tuple(alone["first"]["bkey"]) == (0, 1, 0, 0) and alone["first"]["idx"] == 0


def test_merge_tables_come_without_the_table_of_pieces(spark, tmp_path):
    d = _documents(spark, tmp_path)
    v = C.char_vocab(spark, d)
    assert "keys=[s#" not in _plan(C.pass_merges(spark, d, v))
    blocks = bpe.pair_counts(bpe.piece_blocks(C.docs(spark, d)), boundaries=False)
    assert sorted(C.q_pair_counts(spark, d).collect()) == sorted(blocks.select("pair", F.col("n").cast("long")).collect())


def test_pieces_are_encoded_as_arrays():
    """no piece of a slice becomes a Python string."""
    encoder = tokenizer.PieceEncoder({"a": 1, "b": 2, "ab": 3, "abc": 9, "x": -4, "<s>": 5, "\n": 6, "\nab": 7}, {(1, 2): 3})
    pieces = ["ab", "abab", "abc", "\n<s>", "\n<t>", "\n", "\nab", "aΩb", "x", "", "éa"]
    flat, sizes = encoder.encode(pa.array(pieces))
    ends = np.cumsum(sizes)
    got = [[None if c == tokenizer.NONE else int(c) for c in flat[e - n:e]] for e, n in zip(ends, sizes)]
    assert got == [[3], [3, 3], [9], [5], [None], [6], [3], [1, None, 2], [-4], [], [None, 1]]
    assert [encoder(p) for p in pieces] == got


def test_numbers_of_tokens_are_kept_without_the_tokens(spark, tmp_path):
    """The written table has what offsets and totals read."""
    d = _documents(spark, tmp_path)
    (path, *_) = C.char_shard_sizes(spark, d).inputFiles()
    assert "tokens" not in pq.read_schema(path.removeprefix("file:")).names
    every = {(r.shard_idx, r.row_idx): r.n_tokens for r in C.char_shard_tokens(spark, d).collect()}
    got = {(r.shard_idx, r.row_idx): r for r in C.q_doc_offsets(spark, d).collect()}
    assert {k: r.n_tokens for k, r in got.items()} == every and len(every) == 18
    for (s, i), r in got.items():
        assert r.offset == sum(n for (t, j), n in every.items() if t == s and j < i)


def test_windows_inside_a_document_are_not_put_together(spark):
    """one aggregation, of the parts of windows that straddle documents."""
    rows, at = [], 0
    for i, n in enumerate((1, 2, 30, 5, 1, 1, 12, 4, 9)):
        rows.append((0, i, n, list(range(at, at + n))))
        at += n
    toks = spark.createDataFrame(rows, "shard_idx int, row_idx long, n_tokens int, tokens array<int>")
    for context, n_val, n_test, bucket in ((1, 7, 5, 2), (3, 8, 8, 100), (4, 0, 3, 1), (2, 60, 60, 3)):
        df = packing.token_windows(toks, context, n_val, n_test, bucket)
        plan = _plan(df).split("+- == Initial Plan ==")[0]
        assert plan.count("collect_list(") == plan.count("partial_collect_list(") * 2 and "Generate explode(filter" in plan
        w, want = context + 1, []
        for split, lo, hi in (("val", 0, min(at, n_val)), ("test", min(at, n_val), min(at, n_val + n_test)), ("train", min(at, n_val + n_test), at)):
            want += [(split, 0, c, list(range(x, x + context)), list(range(x + 1, x + w))) for c, x in enumerate(range(lo, hi - w + 1, w))]
        assert sorted(tuple(r) for r in df.collect()) == sorted(want)


def test_documents_with_an_unknown_character(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (1, [1, None]), (2, []), (3, [-(1 << 31), 4]), (4, [-(1 << 31), None])], "row_idx long, tokens array<int>")
    assert [r.row_idx for r in encode.apply_oov(rows, "reject").collect()] == [0, 2, 3]
    assert [r.row_idx for r in encode.oov_rejects(rows).collect()] == [1, 4]


def test_numbers_as_text(spark):
    df = spark.createDataFrame([([1, None, -3],), ([],), (None,), ([7],)], "a array<int>")
    assert [r[0] for r in df.select(ints_to_text(F.col("a"))).collect()] == ["1 -3", "", None, "7"]
