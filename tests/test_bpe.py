"""BPE training, encoding and decoding vs the pure-Python model."""
import random
from collections import Counter
from itertools import groupby

from pyspark.sql import functions as F

import models as M
from tokenmill.operators import bpe, decode, encode, pair_index, sampling, segments, vocab
from tokenmill.plans import catalog as C

EOT = M.EOT


def _train(spark, texts, n_merges, block_chars=4096):
    sample = spark.createDataFrame(list(enumerate(texts)), "row_idx long, text string")
    joined = "\n".join(t for t in texts if t)
    n0 = len(M.initial_vocab(M.preprocess(joined), [EOT]))
    res = bpe.train_bpe(bpe.sequence_blocks(sample, block_chars), n0 + n_merges, [EOT])
    merges = [(r.t1, r.t2, r.new_token) for r in res.merges.orderBy("rank").collect()]
    texts_v = [r.text for r in res.vocab.orderBy("token").collect()]
    return res, merges, texts_v, M.train(joined, n0 + n_merges)


def test_top_pair_tie_goes_to_first_seen():
    assert bpe.choose_round([("ab", 1), ("cd", 1)], 1) == ["ab"]
    assert bpe.choose_round([("ab", 5), ("cd", 4), ("bc", 3), ("ef", 2)], 10) == ["ab", "cd"]
    assert bpe.choose_round([("aa", 5), ("cd", 4)], 10) == ["aa"]
    assert bpe.choose_round([("cd", 5), ("aa", 4)], 10) == ["cd"]
    assert bpe.choose_round([("ab", 5), ("cb", 4), ("ad", 3), ("da", 2)], 10) == ["ab", "cb", "ad"]


def test_training_golden_aaa(spark):
    res, merges, texts_v, (mt, mm) = _train(spark, ["aaa"], 2)
    a = ord("a")
    n = len(texts_v) - 2
    assert merges == [(a, a, n), (n, a, n + 1)] == mm


def test_training_matches_model_any_block_size(spark, monkeypatch):
    rng = random.Random(3)
    for trial in range(5):
        monkeypatch.setattr(segments, "GROUP", (2, 3, 4096)[trial % 3])
        texts = ["".join(rng.choice("aab c" if trial else "aaaab") for _ in range(rng.randint(0, 25)))
                 for _ in range(rng.randint(1, 4))]
        bc = rng.choice([2, 3, 7, 4096])
        res, merges, texts_v, (mt, mm) = _train(spark, texts, 12, bc)
        assert merges == mm, (texts, bc)
        assert texts_v == mt


def test_segments_train_as_the_whole_sequence(spark, monkeypatch):
    """Segments over any number of blocks, runs, ties, floors that are reached, training that ends on blocks: the model's merges."""
    rng = random.Random(21)
    used = []
    whole = bpe.segment_table
    monkeypatch.setattr(bpe, "segment_table", lambda blocks, kept, size: used.append(len(kept)) or whole(blocks, kept, size))
    monkeypatch.setattr(pair_index, "WRITE_TABLE", 1)
    for trial, (ranks, share, longest) in enumerate(((2, 10**6, 1 << 20), (1, 10**6, 1 << 20), (1, 3, 1 << 20), (2, 10**6, 4), (1, 10**6, 1 << 20))):
        monkeypatch.setattr(bpe, "SEGMENT_RANKS", ranks)
        monkeypatch.setattr(bpe, "CUT_SHARE", share)
        monkeypatch.setattr(bpe, "SEGMENT_SYMBOLS", longest)
        monkeypatch.setattr(bpe, "DENSE_PAIRS", (0, 1 << 22)[trial % 2])
        monkeypatch.setattr(segments, "GROUP", (2, 3, 4096)[trial % 3])
        texts = ["".join(rng.choice("aaab cdé\U0001f600e") for _ in range(rng.randint(0, 40))) + "xyxyxy" * rng.randint(0, 3) for _ in range(4)]
        n = rng.choice([3, 5])
        block_chars = (2, 3, 7, 5, 4096)[trial]
        res, merges, texts_v, (mt, mm) = _train(spark, texts, n, block_chars)
        assert merges == mm and texts_v == mt, (texts, trial)
    assert len(used) >= 5


def test_rounds_do_not_rewrite_the_sequence(spark, monkeypatch):
    """bpe_merges (F2): the merges come from the distinct segments, which are few beside the text."""
    rows = []
    whole = bpe.train

    def counted(pieces, *a):
        rows.append(pieces.agg(F.sum(F.length("s"))).first()[0])
        return whole(pieces, *a)
    monkeypatch.setattr(bpe, "train", counted)
    monkeypatch.setattr(bpe, "apply_round", lambda *a: 1 / 0)
    rng = random.Random(4)
    words = [("".join(rng.choice("etaoinshrdlucmfw") for _ in range(rng.randint(2, 8)))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(40)]
    res, merges, texts_v, (mt, mm) = _train(spark, texts, 8)
    assert merges == mm and texts_v == mt
    assert len(rows) == 1 and rows[0] < sum(map(len, texts)) / 2


def test_a_pair_below_the_floor_is_not_chosen(spark):
    pieces = spark.createDataFrame([(0, "abab", 3), (1, "cd", 4), (2, "ba", 1)], "pid long, s string, w long")
    for floor, want in ((1, ["ab"]), (6, ["ab"]), (7, [])):
        index = pair_index.PairIndex(pieces, floor=floor)
        assert index.choose(1) == want
        index.close()


def test_merge_pass_order_and_fixpoint(spark):
    # merges (b,c)->X rank 0, (a,b)->Y rank 1: "abc" -> [Y, c] (any-pair passes)
    vocab_rows = [(i, chr(i), "base") for i in range(256)] + [(300, "bc", "merge"), (301, "ab", "merge")]
    v = spark.createDataFrame(vocab_rows, "token int, text string, kind string")
    m = spark.createDataFrame([(0, 98, 99, 300), (1, 97, 98, 301)], "rank int, t1 int, t2 int, new_token int")
    pieces = spark.createDataFrame([("abcx",)], "piece string")
    codes = encode.piece_codes(pieces, v, m).collect()[0]["codes"]
    assert codes == [301, 99, 120]
    v2 = spark.createDataFrame([(i, chr(i), "base") for i in range(256)] + [(400, "aa", "merge"), (401, "aaa", "merge")],
                               "token int, text string, kind string")
    m2 = spark.createDataFrame([(0, 97, 97, 400), (1, 400, 97, 401)], "rank int, t1 int, t2 int, new_token int")
    got = encode.piece_codes(spark.createDataFrame([("aaaab",)], "piece string"), v2, m2).collect()[0]["codes"]
    assert got == [400, 400, 98]


def test_pass_over_chunked_sequences_equals_the_loop(spark, monkeypatch):
    """Runs that cross any number of chunks and groups of chunks."""
    rng = random.Random(8)
    table = {(1, 1): 10, (1, 2): 11, (2, 1): 12}
    merges = spark.createDataFrame([(a, b, n) for (a, b), n in table.items()], "t1 int, t2 int, new_token int")
    seqs = {f"s{k}": [rng.choice((1, 1, 1, 2, 3)) for _ in range(rng.randint(1, 60))] for k in range(12)}
    seqs |= {"ones": [1] * 67, "twice": [1] * 64 + [3] + [1] * 31, "none": [3] * 40}
    rows = spark.createDataFrame([(k, 2 * i, t) for k, s in seqs.items() for i, t in enumerate(s)], "piece string, pos int, tok int")
    for chunk, group in ((2, 2), (6, 3), (10, 4096), (1 << 16, 4096)):
        monkeypatch.setattr(segments, "GROUP", group)
        got = encode.merge_pass(rows, merges, chunk=chunk).orderBy("piece", "pos").collect()
        for k, s in seqs.items():
            hits = [i for i, p in enumerate(zip(s, s[1:])) if p in table]
            at = M.chosen_positions(hits)
            mine = [r for r in got if r.piece == k]
            assert [r.tok for r in mine] == M.replace_at(s, at, {i: table[s[i], s[i + 1]] for i in at}), (k, chunk)
            assert {r.hit for r in mine} == {bool(hits)}
        pairs = encode.mergeable_pairs(rows, merges, chunk=chunk).collect()
        assert sorted((r.piece, r.pos, r.new_token) for r in pairs) == sorted(
            (k, 2 * i, table[p]) for k, s in seqs.items() for i, p in enumerate(zip(s, s[1:])) if p in table)


def test_a_long_sequence_spreads_over_tasks(spark):
    """A million tokens in one sequence: windows hold chunks, and the result is the loop's."""
    n = 1_000_000
    rows = spark.range(n).select(F.lit("x").alias("piece"), F.col("id").alias("pos"), F.when(F.col("id") % 70_000 == 30_000, 2).otherwise(1).alias("tok"))
    merges = spark.createDataFrame([(1, 1, 10)], "t1 int, t2 int, new_token int")
    out = encode.merge_pass(rows, merges)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    specs = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert specs and all("chunk" in line.split("], [")[1] for line in specs)
    seq = [2 if i % 70_000 == 30_000 else 1 for i in range(n)]
    want = sum(len(list(g)) // 2 for k, g in groupby(seq) if k == 1)
    assert dict(out.groupBy("tok").count().collect()) == {10: want, 2: seq.count(2), 1: sum(len(list(g)) % 2 for k, g in groupby(seq) if k == 1)}


def test_encode_decode_real_documents_match_model(spark):
    d = "/root/testdata/sf0.001"
    docs = C.docs(spark, d)
    smp = sampling.training_sample(docs, 0.05, 20_000)
    res = bpe.train_tokenizer(smp, 258 + 40)
    texts_v = [r.text for r in res.vocab.orderBy("token").collect()]
    merges = [(r.t1, r.t2, r.new_token) for r in res.merges.orderBy("rank").collect()]
    joined = "\n".join(r.text for r in smp.orderBy("row_idx").collect())
    mt, mm = M.train(joined, len(texts_v))
    assert merges == mm and texts_v == mt
    # encode + EOT, then decode, on a slice of the corpus with an injected special
    sub = docs.filter(F.col("row_idx") < 6).withColumn("text", F.concat("text", F.lit(EOT), F.lit(" x")))
    toks = encode.shard_tokens(sub, res.vocab, res.merges, [EOT], on_oov="null")
    got = {(r.shard_idx, r.row_idx): r.tokens for r in toks.collect()}
    eot = texts_v.index(EOT)
    for r in sub.collect():
        want = M.encode(r.text, texts_v, mm, [EOT]) + [eot]
        assert got[(r.shard_idx, r.row_idx)] == want
    dec = {(r.shard_idx, r.row_idx): r.text for r in decode.decode_tokens(toks, res.vocab).collect()}
    for r in sub.collect():
        assert dec[(r.shard_idx, r.row_idx)] == M.decode(got[(r.shard_idx, r.row_idx)], texts_v)


def test_oov_policies(spark):
    v = vocab.initial_vocab(spark.createDataFrame([("a",)], "ch string"), [EOT])
    docs = spark.createDataFrame([(0, 0, "a Ω"), (0, 1, "a a")], "shard_idx int, row_idx long, text string")
    kept = encode.shard_tokens(docs, v, None, [EOT], on_oov="reject").collect()
    assert [r.row_idx for r in kept] == [1]
    nulls = encode.shard_tokens(docs, v, None, [EOT], on_oov="null").orderBy("row_idx").collect()
    assert None in nulls[0].tokens


def test_piece_scope_matches_model(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aab c\n") for _ in range(rng.randint(0, 30))) for _ in range(6)]
    docs = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)],
                                 "shard_idx int, row_idx long, text string")
    in_order = [p for t in texts for p in M.pieces(t)]
    n0 = len(M.initial_vocab(sorted({c for p in in_order for c in p}), [EOT]))
    mt, mm = M.train_pieces(in_order, n0 + 10)
    res = bpe.train_bpe(bpe.piece_blocks(docs), n0 + 10, [EOT], scope="piece")
    got = [(r.t1, r.t2, r.new_token) for r in res.merges.orderBy("rank").collect()]
    assert got == mm
    assert [r.text for r in res.vocab.orderBy("token").collect()] == mt


def _piece_corpus(rng, spark, alphabet="aaab bcd\n", n=6, most=40):
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]
    docs = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "shard_idx int, row_idx long, text string")
    return docs, [p for t in texts for p in M.pieces(t)]


def test_index_training_matches_model(spark, monkeypatch):
    """Short lists, ties, many runs, long pieces, a frontier that is too small: always the model's merges."""
    rng = random.Random(11)
    for ranked, fan, frontier, long, dense, n_merges in ((1, 2, 1 << 16, 256, 0, 9), (2, 3, 4, 256, 8, 12), (4, 8, 1, 256, 3, 10), (64, 2, 1 << 16, 3, 0, 14),
                                                         (3, 2, 3, 2, 5, 12), (64, 8, 1 << 16, 256, 1000, 12)):
        for name, value in (("RANKED", ranked), ("FAN", fan), ("FRONTIER", frontier), ("LONG", long), ("DENSE", dense), ("RECENT", 2), ("WRITE_TABLE", 2), ("COLLECTED", 9)):
            monkeypatch.setattr(pair_index, name, value)
        docs, in_order = _piece_corpus(rng, spark)
        n0 = len(M.initial_vocab(sorted({c for p in in_order for c in p}), [EOT]))
        mt, mm = M.train_pieces(in_order, n0 + n_merges)
        res = bpe.train_bpe(bpe.piece_blocks(docs), scope="piece", n_merges=n_merges)
        assert [(r.t1, r.t2, r.new_token) for r in res.merges.orderBy("rank").collect()] == mm, in_order
        assert [r.text for r in res.vocab.orderBy("token").collect()] == mt


def _index(spark, pieces):
    return pair_index.PairIndex(spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(pieces)], "pid long, s string, w long"))


def test_index_counts_equal_a_recount(spark, monkeypatch):
    monkeypatch.setattr(pair_index, "FAN", 3)
    monkeypatch.setattr(pair_index, "LONG", 9)
    monkeypatch.setattr(pair_index, "DENSE", 3)
    monkeypatch.setattr(pair_index, "RECENT", 2)
    rng = random.Random(7)
    pieces = [("".join(rng.choice("aabc") for _ in range(rng.randint(1, 14))), rng.randint(1, 5)) for _ in range(60)]
    index = _index(spark, pieces)
    for merges in ({"aa": "X"}, {"Xb": "Y", "cb": "Z"}, {"ca": "U"}, {"bb": "V"}, {"YX": "W"}, {"ab": "T"}):
        index.choose(1)
        index.merge(merges)
        for p, n in merges.items():
            pieces = [(s.replace(p, n), w) for s, w in pieces]
        want = Counter()
        for s, w in pieces:
            for a, b in zip(s, s[1:]):
                want[a + b] += w
        assert dict(index.counts().collect()) == want
        assert index.frontier == {p: n for p, n in want.items() if n >= index.least}
    index.close()


def test_a_round_reads_the_postings_of_its_merges(spark, monkeypatch):
    """Postings read and pieces changed are those that hold the merged pairs, not the corpus."""
    monkeypatch.setattr(pair_index, "DENSE", 0)
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)] + ["xyq", "pxy"]
    index = _index(spark, [(s, 1) for s in pieces])
    assert index.runs[0].rows == sum(len({s[i:i + 2] for i in range(len(s) - 1)}) for s in pieces)
    index.choose(1)
    index.merge({"xy": "X"})
    index.merge({"ab": "Y", "hi": "Z"})
    holding = [s for s in pieces if "ab" in s or "hi" in s]
    both = sum("ab" in s for s in pieces) + sum("hi" in s for s in pieces)
    assert (index.work[0].read, index.work[0].changed, index.work[0].written) == (2, 2, 6)
    assert (index.work[1].read, index.work[1].changed) == (both, len(holding)) and both < len(pieces) / 3
    plan = index.postings().filter(pair_index.any_of(["ab", "hi"]))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pair,ab)" in plan and "EqualTo(pair,hi)" in plan
    index.close()


def test_extend_vocab_rebuilds_trained_texts(spark):
    res, merges, texts_v, _ = _train(spark, ["the cat sat on the mat", "that hat"], 12)
    base = res.vocab.filter("kind != 'merge'")
    rebuilt = vocab.extend_vocab(base, res.merges)
    assert sorted(tuple(r) for r in rebuilt.collect()) == sorted(tuple(r) for r in res.vocab.collect())
    assert vocab.vocab_size(rebuilt).first()["n_tokens"] == len(texts_v)


def test_text_collisions_keep_the_larger_id(spark):
    # (a, bc) and (ab, c) both give "abc": the lookup keeps the later id, and
    # the collision is reported instead of raising.
    rows = [(97, "a", "base"), (98, "b", "base"), (99, "c", "base"), (300, "ab", "merge"),
            (301, "bc", "merge"), (302, "abc", "merge"), (303, "abc", "merge")]
    v = spark.createDataFrame(rows, "token int, text string, kind string")
    t2t = {r.text: r.token for r in vocab.text_to_token(v).collect()}
    assert t2t["abc"] == 303
    col = vocab.vocab_collisions(v).collect()
    assert [(r.text, r.n_tokens, list(r.tokens)) for r in col] == [("abc", 2, [302, 303])]
    assert tuple(vocab.vocab_size(v).first()) == (7, 6)


def _wide_vocab(spark, n):
    rows = [(i, chr(i), "base") for i in range(256)] + [(256, EOT, "special")]
    rows += [(257 + i, chr(0x4E00 + i), "char") for i in range(n)]
    return spark.createDataFrame(rows, "token int, text string, kind string")


def test_one_behaviour_at_every_vocabulary_size(spark):
    docs = spark.createDataFrame([(0, "ab"), (0, "cd"), (1, None), (2, ""), (3, "aΩ")], "k int, text string")
    toks = spark.createDataFrame([(0, [97, 98]), (0, [99]), (1, None), (2, []), (3, [97, None, 99999, 98])], "k int, tokens array<int>")
    for n in (10, 400, 9000):
        v = _wide_vocab(spark, n)
        got = sorted(((r.k, r.tokens) for r in encode.encode_docs(docs, v).collect()), key=str)
        assert got == sorted([(0, [97, 98]), (0, [99, 100]), (1, None), (2, []), (3, [97, None])], key=str)
        assert sorted(((r.k, r.text) for r in decode.decode_tokens(toks, v).collect()), key=str) == sorted(
            [(0, "ab"), (0, "c"), (1, None), (2, ""), (3, "ab")], key=str)
        chars = sorted(((r.k, r.tokens) for r in vocab.char_tokens(docs, v, strict=False).collect()), key=str)
        assert chars == got


def test_strict_and_failing_modes(spark):
    import pytest
    docs = spark.createDataFrame([(0, 0, "aΩ")], "shard_idx int, row_idx long, text string")
    v = _wide_vocab(spark, 1)
    with pytest.raises(Exception, match="missing from the vocabulary"):
        vocab.char_tokens(docs, v).collect()
    with pytest.raises(Exception, match="missing from the vocabulary"):
        encode.shard_tokens(docs, v, on_oov="fail").collect()


def test_merge_once_against_plain_scan():
    from tokenmill.operators.tokenizer import PieceEncoder
    rng = random.Random(2)
    for _ in range(500):
        table, ids = {}, {c: i for i, c in enumerate("abc")}
        for n in range(rng.randint(0, 6)):
            table[rng.randrange(3 + n), rng.randrange(3 + n)] = 3 + n
        piece = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 12)))
        assert PieceEncoder(ids, table)(piece) == M.encode_piece(piece, ids, table)
