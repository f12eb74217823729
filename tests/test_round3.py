"""Queries and operators of the third round's findings, on rows of their own."""
import random

import pyarrow as pa
from pyspark.sql import functions as F

import models as M
from tokenmill.functions.text import EOT, special_segments
from tokenmill.operators import bpe, encode, tokenizer, vectors
from tokenmill.plans import catalog as C
from tokenmill.sources import shards


def _documents(spark, tmp_path, texts, ids=None):
    d = str(tmp_path)
    rows = list(zip(range(len(texts)) if ids is None else ids, texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return d


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pass_over_whole_sequences_equals_the_loop(spark, monkeypatch):
    rng = random.Random(8)
    table = {(1, 1): 10, (1, 2): 11, (2, 1): 12}
    merges = spark.createDataFrame([(a, b, n) for (a, b), n in table.items()], "t1 int, t2 int, new_token int")
    seqs = {f"s{k}": [rng.choice((1, 1, 1, 2, 3, None)) for _ in range(rng.randint(0, 60))] for k in range(12)}
    seqs |= {"ones": [1] * 67, "none": [3] * 40, "null": None}
    rows = spark.createDataFrame(list(seqs.items()), "piece string, tokens array<int>").coalesce(1)
    for chunk, scan, items in ((1, 1, 1), (3, 1, 50), (1 << 16, 1 << 20, 1 << 19)):
        monkeypatch.setattr(encode, "SCAN_TOKENS", scan)
        monkeypatch.setattr(tokenizer, "SLICE_ITEMS", items)
        out = encode.merge_pass(rows, merges, chunk=chunk)
        assert "Exchange" not in _plan(out).replace("Exchange SinglePartition", "")
        got = {r.piece: r for r in out.collect()}
        pairs = encode.mergeable_pairs(rows, merges, chunk=chunk).collect()
        for k, s in seqs.items():
            if s is None:
                assert got[k].tokens is None and got[k].pos is None and not got[k].hit
                continue
            hits = [i for i, p in enumerate(zip(s, s[1:])) if p in table]
            at = M.chosen_positions(hits)
            assert got[k].tokens == M.replace_at(s, at, {i: table[s[i], s[i + 1]] for i in at}), (k, chunk)
            assert got[k].pos == [i for i in range(len(s)) if i - 1 not in at] and got[k].hit == bool(hits)
            assert sorted(r.pos for r in pairs if r.piece == k) == hits


def test_batches_are_worked_on_in_slices():
    lists = pa.array([["a"] * n for n in (3, 0, 9, 1, 1, 0)])
    parts = list(tokenizer.in_slices(pa.RecordBatch.from_arrays([lists], ["x"]), 0, 4))
    assert [p.num_rows for p in parts] == [2, 1, 3]
    assert [v for p in parts for v in p.column(0).to_pylist()] == lists.to_pylist()


def test_document_pass_shuffles_texts_not_characters(spark, tmp_path):
    texts = ["the theme then ", "", None, "aaaaab" * 90, "other thing"]
    d = _documents(spark, tmp_path, [*texts, "the theme then "], [0, 1, 2, 3, 4, 0])
    df = C.QUERIES["merge_pass_docs"](spark, d)
    assert "Window" not in _plan(df)
    got = {(r.shard_idx, r.row_idx): r for r in df.collect()}
    ids = {r["text"]: r["token"] for r in C.char_vocab(spark, d).collect()}
    merges = {(r.t1, r.t2): r.new_token for r in C.pass_merges(spark, d, C.char_vocab(spark, d)).collect()}
    for doc, text in ((3, texts[3]), (4, texts[4])):
        want = tokenizer.merge_once([ids.get(c) for c in text], merges)
        assert got[doc % 4, doc // 4].codes == " ".join(str(t) for t in want if t is not None)
        assert got[doc % 4, doc // 4].n_tokens == len(want)
    # Documents of one key are one sequence by position, as rows are.
    both = sorted((i, c) for i, c in enumerate(texts[0]) for _ in range(2))
    rows = spark.createDataFrame([("x", i, ids.get(c)) for i, c in both], "piece string, pos int, tok int")
    old = encode.merge_pass(rows, spark.createDataFrame([(a, b, n) for (a, b), n in merges.items()], "t1 int, t2 int, new_token int"))
    assert got[0, 0].n_tokens == old.count() and len(got) == 3


def test_pairs_are_counted_in_slices(spark, monkeypatch):
    """Counts and first places are the plain ones, whatever the slices and the alphabet's size."""
    rng = random.Random(4)
    for alphabet, slice_bytes in (("ab c", 1), ("ab c", 1 << 22), ([chr(0x4E00 + i) for i in range(400)], 1 << 22)):
        monkeypatch.setattr(bpe, "PAIR_BYTES", slice_bytes)
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(20)]
        keys = rng.sample(range(100), 20)
        blocks = spark.createDataFrame([(k, t, rng.randint(1, 1 << 40)) for k, t in zip(keys, texts)], "bkey long, s string, w long")
        counts, first = {}, {}
        for r in blocks.collect():
            for i, p in enumerate(zip(r.s, r.s[1:])):
                counts["".join(p)] = counts.get("".join(p), 0) + r.w
                first["".join(p)] = min(first.get("".join(p), (1000, 0)), (r.bkey, i))
        found = bpe.pair_counts(blocks, boundaries=False)
        plan = _plan(found)
        # The aggregation gets a row a pair and slice: nothing is exploded to a row an occurrence.
        assert "MapInArrow" in plan and "Generate" not in plan
        got = {r.pair: r for r in found.collect()}
        assert {p: r.n for p, r in got.items()} == counts
        assert {p: tuple(r["first"]) for p, r in got.items()} == first


def test_piece_blocks_count_and_first_place(spark, monkeypatch):
    monkeypatch.setattr(tokenizer, "SLICE_ITEMS", 3)
    docs = spark.createDataFrame([(1, 5, "b a b"), (0, 7, "a<|endoftext|>b a"), (None, 2, "a"), (0, 9, None), (0, 1, "")],
                                 "shard_idx int, row_idx long, text string").coalesce(1)
    blocks = bpe.piece_blocks(docs)
    assert "MapInArrow" in _plan(blocks)
    got = {r.s: (tuple(r.bkey), r.w) for r in blocks.collect()}
    assert got == {"a": ((None, 2, 0, 0), 2), "b": ((0, 7, 2, 0), 2), "Ġa": ((0, 7, 2, 1), 2), "Ġb": ((1, 5, 0, 2), 1)}


def test_matrix_blocks_are_multiplied_a_few_at_a_time(spark, monkeypatch):
    """No block becomes Python objects, and a task holds few of them; NULL keys are keys of a block."""
    left = [("x", f"r{i % 7}" if i % 7 else None, i % 5, float(i % 11 - 5) if i % 13 else None) for i in range(35)]
    right = [("x", k, j, float(k * j - 3)) for k in range(1, 6) for j in range(4)]
    right += [("x", None, 1, 5.0)]
    left += [("x", "r1", None, 7.0)]
    a = spark.createDataFrame(left, "batch string, i string, k long, v double")
    b = spark.createDataFrame(right, "batch string, k long, j int, v double")
    want = {}
    for _, i, k, v in left:
        for _, k2, j, u in right:
            if k == k2 and k is not None and v is not None:
                want[i, j] = want.get((i, j), 0) + v * u
    for cells in (1, 1 << 16):
        monkeypatch.setattr(vectors, "PRODUCT_CELLS", cells)
        c = vectors.matmul_blocks(a, b, 2)
        assert "MapInArrow" in _plan(c) and "MapInPandas" not in _plan(c)
        assert {(r.i, r.j): r.v for r in c.collect()} == want


def test_positions_and_tokens_that_windows_hold_are_broadcast(spark, monkeypatch):
    """Large tables of which the windows use little: no row of a position is shuffled."""
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", 64)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tok = spark.range(100).select(F.col("id").cast("int").alias("token"), F.array(F.col("id").cast("float")).alias("vec"))
    pos = spark.range(100).select(F.col("id").cast("int").alias("pos"), F.array(F.col("id").cast("float")).alias("vec"))
    windows = spark.createDataFrame([(0, [3, 5, 3]), (1, [500, 7])], "chunk_idx long, input_ids array<int>")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = vectors.embed_tokens(windows, tok, pos)
        assert "SortMergeJoin" not in _plan(out) and "Exchange hashpartitioning" not in _plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    got = {(r.chunk_idx, r.pos): r.emb for r in out.collect()}
    assert got == {(0, 0): [3.0], (0, 1): [6.0], (0, 2): [5.0], (1, 0): None, (1, 1): [8.0]}


def test_a_shard_may_be_a_folder_of_parts(spark, tmp_path):
    """Rows are counted through the parts of a shard; plain files beside it keep their own."""
    path = str(tmp_path)
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    rows.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.parquet(f"{path}/raw/shard_00003.parquet")
    rows.coalesce(1).write.parquet(f"{path}/one")
    (part,) = (tmp_path / "one").glob("*.parquet")
    part.rename(tmp_path / "raw" / "shard_00007.parquet")
    got = sorted(tuple(r) for r in shards.scan_shards(spark, f"{path}/raw").collect())
    assert got == sorted((s, i, f"t{i}") for s in (3, 7) for i in range(50))


def test_shard_files_are_written_by_many_tasks(spark, tmp_path):
    ids = random.Random(1).sample(range(1000), 200)
    d = _documents(spark, tmp_path, [f"t{i}" for i in ids], ids)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = C.QUERIES["scan_shard_files"](spark, d)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len({f.split("/shard_")[1] for f in df.inputFiles()}) > C.N_SHARDS
    want = [(s, r, f"t{i}") for s in range(4) for r, i in enumerate(sorted(i for i in ids if i % 4 == s))]
    assert sorted(tuple(r) for r in df.collect()) == want
    assert C.QUERIES["scan_shard_files"](spark, _documents(spark, tmp_path / "none", [], [])).count() == 0


def test_texts_without_a_special_are_one_segment(spark):
    texts = ["a b", " ", "", None, "a<|endoftext|>b", "<|end", "x\ny"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for mode in ("all", "leading"):
        got = df.select(special_segments(F.col("text"), [EOT], mode).alias("s")).collect()
        cut = [("a", False), (EOT, True), ("b", False)] if mode == "all" else [("a", False), (EOT + "b", False)]
        assert [None if r.s is None else [tuple(x) for x in r.s] for r in got] == [
            [("a b", False)], [(" ", False)], [], None, cut, [("<|end", False)], [("x\ny", False)]]
