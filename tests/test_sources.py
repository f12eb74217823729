"""Sampling, planning, sinks, incremental processing."""
import os
import re

from pyspark.sql import functions as F

from tokenmill.operators import encode, sampling, vocab
from tokenmill.plans import corpus
from tokenmill.sources import dictionary, manifest, shards, sinks
from tokenmill.streaming import incremental

EOT = "<|endoftext|>"


def test_character_budget_golden(spark):
    docs = spark.createDataFrame([(0, 0, "abc"), (0, 1, ""), (0, 2, "defg"), (1, 0, "zzz")],
                                 "shard_idx int, row_idx long, text string")
    got = sampling.training_sample(docs, 1.0, 5).orderBy("row_idx").collect()
    assert [r.text for r in got] == ["abc", "de"]


def test_negative_ids_have_places_of_their_own(spark):
    docs = spark.createDataFrame([(i, str(i)) for i in range(-9, 10)], "doc_id long, text string")
    got = shards.documents_as_shards(docs, 4).collect()
    assert len({(r.shard_idx, r.row_idx) for r in got}) == 19 and all(4 * r.row_idx + r.shard_idx == int(r.text) for r in got)


def test_budget_over_buckets(spark):
    """Any bucket size and budget gives the running cut; rows behind the cut are filtered before the window."""
    texts = ["abc", "", None, "defg", "x" * 7, "", "yz", "w" * 11, "v", "u" * 5] * 3
    docs = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)] + [(1, 0, "zzz")], "shard_idx int, row_idx long, text string")
    for rows, most in ((1, 5), (2, 8), (4, 30), (7, 31), (64, 33), (3, 1000), (2, 1)):
        got = sampling.training_sample(docs, 1.0, most, bucket_rows=rows).orderBy("row_idx").collect()
        assert "".join(r.text for r in got) == "".join(t or "" for t in texts)[:most]
        assert all(r.text and r.n_chars == len(r.text) for r in got)
    head = docs.filter("shard_idx = 0 AND text <> ''")
    assert sampling.bucket_totals(head, 30, 9, 2) == [(0, 3), (1, 4), (2, 7), (3, 13)]  # rows 0-1, then 2-3, then 4-7
    plan = sampling.training_sample(docs, 1.0, 5, bucket_rows=2)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"row_idx#\d+L < 4\)", plan)
    assert sampling.training_sample(docs, 1.0, 5, shard=9).count() == 0


def test_budget_estimate_and_missing(spark):
    assert shards.estimate_shards_needed(124_000_000) == 50
    present = spark.createDataFrame([(0,), (2,)], "shard_idx int")
    got = [r.file_name for r in shards.missing_shards(spark, 4, present).orderBy("shard_idx").collect()]
    assert got == ["shard_00001.parquet", "shard_00003.parquet"]


def _write_raw(spark, base, n_files):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for i in range(n_files):
        part = docs.filter(F.pmod("doc_id", F.lit(n_files)) == i).orderBy("doc_id").select("text")
        tmp = os.path.join(base, f"tmp{i}")
        part.coalesce(1).write.mode("overwrite").parquet(tmp)
        f = [x for x in os.listdir(tmp) if x.endswith(".parquet")][0]
        os.link(os.path.join(tmp, f), os.path.join(base, "raw", f"shard_{i:05d}.parquet"))


def test_scan_cache_idempotent_and_stream(spark, scratch):
    os.makedirs(os.path.join(scratch, "raw"))
    _write_raw(spark, scratch, 3)
    raw = shards.scan_shards(spark, os.path.join(scratch, "raw"))
    assert sorted(r.shard_idx for r in raw.select("shard_idx").distinct().collect()) == [0, 1, 2]
    v = vocab.initial_vocab(vocab.distinct_chars(raw), [EOT]).cache()
    tok_dir = os.path.join(scratch, "tokens")
    first = corpus.tokenize_and_cache_shards(spark, raw, v, None, tok_dir).collect()
    assert len(first) == 3
    assert corpus.tokenize_and_cache_shards(spark, raw, v, None, tok_dir).count() == 0
    want = encode.shard_tokens(raw, v, None, [EOT]).collect()
    got = sinks.read_token_shards(spark, tok_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    only0 = sinks.read_token_shards(spark, tok_dir, [0])
    assert only0.count() == sum(r.shard_idx == 0 for r in got)
    assert re.search(r"PartitionFilters: \[[^\]]*shard_idx#\d+ = 0", only0._jdf.queryExecution().executedPlan().toString())
    # streaming: first run processes all files, second nothing, a new file one shard
    s_dir, ck = os.path.join(scratch, "stream_tokens"), os.path.join(scratch, "ck")
    incremental.tokenize_new_shards(spark, os.path.join(scratch, "raw"), v, None, s_dir, ck).awaitTermination()
    n1 = sinks.read_token_shards(spark, s_dir).count()
    incremental.tokenize_new_shards(spark, os.path.join(scratch, "raw"), v, None, s_dir, ck).awaitTermination()
    assert sinks.read_token_shards(spark, s_dir).count() == n1 == len(want)
    os.makedirs(os.path.join(scratch, "more"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(5).select("text")
    docs.coalesce(1).write.parquet(os.path.join(scratch, "more", "x"))
    f = [x for x in os.listdir(os.path.join(scratch, "more", "x")) if x.endswith(".parquet")][0]
    os.link(os.path.join(scratch, "more", "x", f), os.path.join(scratch, "raw", "shard_00007.parquet"))
    incremental.tokenize_new_shards(spark, os.path.join(scratch, "raw"), v, None, s_dir, ck).awaitTermination()
    after = sinks.read_token_shards(spark, s_dir)
    assert after.count() == n1 + 5
    assert sorted(r.shard_idx for r in after.select("shard_idx").distinct().collect()) == [0, 1, 2, 7]


def test_tokenizer_roundtrip_on_disk(spark, scratch):
    v = spark.createDataFrame([(0, "a", "base")], "token int, text string, kind string")
    m = spark.createDataFrame([(0, 0, 0, 1)], "rank int, t1 int, t2 int, new_token int")
    sinks.write_tokenizer(v, m, scratch + "/tok")
    v2, m2 = sinks.read_tokenizer(spark, scratch + "/tok")
    assert v2.collect() == v.collect() and m2.collect() == m.collect()


def test_end_to_end_pipeline(spark, scratch):
    """Raw shard files -> trained tokenizer on disk -> cached token shards
    -> windows, equal to the same steps on in-memory tables."""
    from tokenmill.operators import packing
    os.makedirs(os.path.join(scratch, "raw"))
    _write_raw(spark, scratch, 2)
    raw = shards.scan_shards(spark, os.path.join(scratch, "raw"))
    tok_path = os.path.join(scratch, "tokenizer")
    trained = corpus.train_tokenizer_job(raw, 258 + 20, tok_path, shard_fraction=0.1, max_chars=5_000)
    v, m = sinks.read_tokenizer(spark, tok_path)
    assert m.count() == trained.merges.count() == 20
    tok_dir = os.path.join(scratch, "tokens")
    corpus.tokenize_and_cache_shards(spark, raw, v, m, tok_dir)
    got = corpus.windows_job(spark, tok_dir, 16, 300, 200)
    want = packing.token_windows(encode.shard_tokens(raw, trained.vocab, trained.merges, [EOT]), 16, 300, 200)
    key = ["split", "shard_idx", "chunk_idx"]
    assert sorted(map(tuple, got.orderBy(key).collect())) == sorted(map(tuple, want.orderBy(key).collect()))
    assert got.count() > 0


def test_rejects_and_finished_shards(spark, scratch):
    """Shards without a single accepted document are finished too."""
    docs = spark.createDataFrame([(0, 0, "ab"), (0, 1, "aΩ"), (1, 0, "Ω"), (2, 0, ""), (2, 1, None)],
                                 "shard_idx int, row_idx long, text string")
    v = vocab.initial_vocab(spark.createDataFrame([("a",)], "ch string"), [EOT])
    out = os.path.join(scratch, "cache")
    first = corpus.tokenize_and_cache_shards(spark, docs, v, None, out)
    eot = encode.eot_token(v)
    assert sorted(map(tuple, first.collect())) == [(0, 3, 2, 1), (1, 0, 1, 1), (2, 0, 2, 0)]
    assert [tuple(r) for r in sinks.read_token_shards(spark, out).collect()] == [(0, 0, 3, [97, 98, eot])]
    assert sorted(map(tuple, sinks.read_rejects(spark, out).collect())) == [
        (0, 1, "unknown character"), (1, 0, "unknown character")]
    assert sorted(map(tuple, sinks.finished_shards(spark, out).collect())) == sorted(map(tuple, first.collect()))
    again = corpus.tokenize_and_cache_shards(spark, docs, v, None, out)
    assert again.count() == 0 and sinks.read_token_shards(spark, out).count() == 1
    more = docs.union(spark.createDataFrame([(3, 0, "b")], docs.schema))
    assert [r.shard_idx for r in corpus.tokenize_and_cache_shards(spark, more, v, None, out).collect()] == [3]


def _cache(spark, path, rows_per_file=3):
    """Shards 0 to 2 with 10, 4 and 7 documents of known tokens."""
    rows = [(s, r, 1 + r % 4, [100 * s + r] * (1 + r % 4)) for s, n in ((0, 10), (1, 4), (2, 7)) for r in range(n)]
    tokens = spark.createDataFrame(rows, "shard_idx int, row_idx long, n_tokens int, tokens array<int>")
    totals = tokens.groupBy("shard_idx").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"), F.lit(0).cast("long").alias("n_rejected"))
    rejects = tokens.filter("false").select("shard_idx", "row_idx", F.lit("").alias("reason"))
    return tokens, rejects, totals, lambda t=tokens, key=None: sinks.write_run(
        t, rejects, totals.join(t.select("shard_idx").distinct(), "shard_idx"), path, key, rows_per_file)


def test_a_split_is_read_from_its_files(spark, scratch):
    from tokenmill.operators import packing
    tokens, _, _, write = _cache(spark, scratch + "/cache")
    write(tokens.filter("shard_idx = 1"))
    write(tokens.filter("shard_idx <> 1"))
    every = packing.token_windows(tokens, 2, 5, 8)
    key = ["split", "shard_idx", "chunk_idx"]
    for split in ("train", "val", "test"):
        got = sinks.read_split_windows(spark, scratch + "/cache", split, 2, 5, 8).orderBy(key).collect()
        assert got == every.filter(F.col("split") == split).orderBy(key).collect() and got
    # The first 5 tokens are in the first bucket of shard 0: one directory, and offsets inside.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = sinks.read_split(spark, scratch + "/cache", "val", 5, 8)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "offset#" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) == 1, plan
    assert re.search(r"shard_idx#\d+ = 0", scans[0]) and re.search(r"bucket#\d+L (=|<=) 0", scans[0]), scans[0]
    assert "PartitionFilters: [" in scans[0] and "LessThan(offset,5)" in scans[0], scans[0]
    zones = sorted(map(tuple, sinks.token_zones(spark, scratch + "/cache").filter("shard_idx = 0").collect()))
    assert zones == [(0, 0, 0, 6, 3), (0, 1, 6, 7, 3), (0, 2, 13, 8, 3), (0, 3, 21, 2, 1)]
    assert sinks.read_split(spark, scratch + "/cache", "val", 0, 0).count() == 0
    assert sinks.read_split(spark, scratch + "/cache", "test", 1000, 8).count() == 0


def test_a_killed_run_shows_nothing(spark, scratch, monkeypatch):
    import pytest
    path = scratch + "/cache"
    tokens, _, totals, write = _cache(spark, path)
    write(tokens.filter("shard_idx = 0"))

    def killed(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(manifest.Manifest, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            write(tokens)
    assert len(os.listdir(path + "/tokens")) == 2
    for read in (sinks.read_token_shards, sinks.finished_shards, sinks.token_zones):
        assert {r.shard_idx for r in read(spark, path).collect()} == {0}
    write(tokens)  # repeated: shard 0 stays with its run, the others are new
    assert sorted(map(tuple, sinks.read_token_shards(spark, path).collect())) == sorted(map(tuple, tokens.collect()))
    assert sorted(map(tuple, sinks.finished_shards(spark, path).collect())) == sorted(map(tuple, totals.collect()))


def test_two_writers_at_once(spark, scratch):
    """A version is published once; the slower writer decides again and keeps what is its own."""
    path = scratch + "/cache"
    tokens, _, _, write = _cache(spark, path)
    seen = []

    def decide(version, entries):
        if not seen:
            write(tokens.filter("shard_idx < 2"))  # another job, between this one's look and its publishing
        seen.append((version, len(entries)))
        return {"run": "none", "key": None, "shards": [], "all": True} if version == 0 else None
    m = manifest.Manifest(spark, path)
    assert not m.publish(decide) and seen == [(0, 0), (1, 1)] and m.latest()[0] == 1
    assert write(tokens.filter("shard_idx > 0"), "k") and not write(tokens, "k")
    assert sorted(map(tuple, sinks.read_token_shards(spark, path).collect())) == sorted(map(tuple, tokens.collect()))
    assert m.latest()[1][1]["shards"] == [2]


def test_dictionary_runs(spark, scratch, monkeypatch):
    docs = spark.createDataFrame([(0, 0, "ab ab"), (0, 1, "b <|endoftext|>ab"), (1, 0, "ab  zab b"), (1, 1, ""), (1, 2, None), (1, 3, "?")],
                                 "shard_idx int, row_idx long, text string")
    v = vocab.initial_vocab(spark.createDataFrame([("a",), ("b",), ("z",)], "ch string"), [EOT])
    path = scratch + "/dictionary"
    add = lambda some, key: dictionary.extend_dictionary(docs.filter(some), v, None, path, key)
    assert add("shard_idx = 0", "one") == 4 and add("shard_idx = 0", "one") == 0 and add("shard_idx = 0", "again") == 0
    with monkeypatch.context() as m:
        m.setattr(manifest.Manifest, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        try:
            add("true", "two")
        except KeyboardInterrupt:
            pass
    before = dictionary.read_dictionary(spark, path).count()
    assert before == 4 and add("true", "two") == 3 and add("true", "two") == 0
    table = dictionary.read_dictionary(spark, path)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, encode.piece_codes(encode.distinct_pieces(docs), v, None).collect()))
    want = encode.shard_tokens(docs, v, None, on_oov="null").collect()
    got = encode.shard_tokens(docs, v, None, on_oov="null", dictionary=table).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 4


def test_stream_with_dictionary_and_a_nameless_file(spark, scratch):
    os.makedirs(os.path.join(scratch, "raw"))
    _write_raw(spark, scratch, 2)
    raw = os.path.join(scratch, "raw")
    v = vocab.initial_vocab(vocab.distinct_chars(shards.scan_shards(spark, raw)), [EOT])
    want = encode.shard_tokens(shards.scan_shards(spark, raw), v, None, [EOT]).collect()
    os.link(os.path.join(raw, "shard_00000.parquet"), os.path.join(raw, "other.parquet"))
    out, ck, book = (os.path.join(scratch, n) for n in ("out", "ck", "book"))
    run = lambda: incremental.tokenize_new_shards(spark, raw, v, None, out, ck, dictionary_dir=book).awaitTermination()
    run()
    assert sorted(map(tuple, sinks.read_token_shards(spark, out).collect())) == sorted(map(tuple, want))
    assert [tuple(r) for r in sinks.read_rejects(spark, out).collect()] == [(None, None, "no shard number in the file name other.parquet")]
    n, version = dictionary.read_dictionary(spark, book).count(), manifest.Manifest(spark, book).latest()[0]
    run()
    assert (dictionary.read_dictionary(spark, book).count(), manifest.Manifest(spark, book).latest()[0]) == (n, version)
    # The batch repeated, as after a crash: nothing changes.
    batch = shards.scan_shards(spark, raw).withColumn("file", F.lit("other.parquet"))
    incremental.tokenize_batch(batch, f"{ck}#0", v, None, out, dictionary_dir=book)
    assert manifest.Manifest(spark, out).latest()[0] == 1 and manifest.Manifest(spark, book).latest()[0] == version


def test_tokenizer_versions(spark, scratch):
    """Readers see a version once it is complete."""
    v = spark.createDataFrame([(0, "a", "base")], "token int, text string, kind string")
    m = spark.createDataFrame([(0, 0, 0, 1)], "rank int, t1 int, t2 int, new_token int")
    sinks.write_tokenizer(v, m, scratch + "/tok")
    v.write.parquet(scratch + "/tok/v000002/vocab")  # a writer that died
    assert sinks.read_tokenizer(spark, scratch + "/tok")[1].count() == 1
    sinks.write_tokenizer(v.union(v), m, scratch + "/tok")
    assert sinks.read_tokenizer(spark, scratch + "/tok")[0].count() == 2
