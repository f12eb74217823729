"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the given tables (see ``__spark_entry__``). Arrays are rendered as
space-joined strings and floats are rounded, so results compare by value
with the SQL oracles."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import EOT, ints_to_text, preprocess_chars, special_segments, special_segments_many
from ..functions.vectors import rule_matrix
from ..operators import bpe, decode, encode, packing, sampling, vectors, vocab
from ..session import checkpoint_dir, delete_on_exit, move_file, path_exists, written
from ..sources import dictionary, shards, sinks
from ..sources.manifest import new_run
from ..validation import require
from . import corpus

# Parameters of the registered queries.
N_SHARDS = 4                 # document i -> shard i mod 4, row i div 4
SPECIALS = (EOT,)
CONTEXT = 64
N_VAL = 2_000
N_TEST = 2_000
N_WORKERS = 3
CACHE_ROWS = 100             # documents of a bucket of the token cache
MODEL_PARAMS = 124_000_000   # planning estimate -> expected shard count
BUDGET_PARAMS = 50_000       # measured budget: 20 tokens per parameter
SAMPLE = (0.01, 200_000)     # reference defaults
SAMPLE_TIGHT = (0.2, 20_000)  # exercises the truncating character budget
N_MERGES = 48                # merges learned by the registered training query
N_TOP_PAIRS = 5
N_PASS_MERGES = 30           # data-derived merge table for the one-pass query
PASS_CHUNK = 256             # characters of a document that are scanned together
N_TRIGRAMS = 20              # three-character strings whose merges collide
N_MANY_SHARDS = 64
WIDE_ALPHABET = 3000         # characters added to the alphabet
WIDE_VOCAB = 50_257          # whole pieces in the vocabulary
MANY_SPECIALS, SPECIALS_AT_MOST = "[A-Z][a-z][a-z][a-z]", 100_000
MULTI_SPECIALS = ("of", "<|end", EOT)
# Replacements that put unusual white space and characters into the documents.
INJECTED = ((". ", ".\t \u00a0  "), (", ", ",   "), ("\n", " \r\n\t\n"), ("th", "Ω中"), (" a ", "\u2003a\x0b \u3000"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.documents_as_shards(table(spark, sf_dir, "documents"), N_SHARDS)


def char_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character-level vocabulary of the whole corpus (no merges), found by one scan for all its uses."""
    return encode.held_vocab(vocab.initial_vocab(vocab.distinct_chars(docs(spark, sf_dir)), SPECIALS))


def char_shard_tokens(spark: SparkSession, sf_dir: str, columns: Sequence[str] = (*encode.DOC_KEYS, "n_tokens", "tokens")) -> DataFrame:
    """Written, because sizes, offsets and windows each read the token table; of it, what the query reads."""
    toks = encode.shard_tokens(docs(spark, sf_dir), char_vocab(spark, sf_dir), None, SPECIALS)
    return written(toks.select(*columns), "char-tokens")


def char_shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table without the tokens: their numbers are known once a document is encoded."""
    return char_shard_tokens(spark, sf_dir, (*encode.DOC_KEYS, "n_tokens"))


def _tokens_text(df: DataFrame, col: str = "tokens") -> DataFrame:
    return df.withColumn(col, ints_to_text(F.col(col)))


# --- scans, filters, text ---------------------------------------------------

def q_scan_docs(spark, d):
    return docs(spark, d)


def q_nonempty_docs(spark, d):
    return shards.nonempty_docs(docs(spark, d)).select(
        "shard_idx", "row_idx", F.length("text").cast("long").alias("n_chars"))


def q_preprocessed_chars(spark, d):
    c = preprocess_chars(F.col("text"))
    return docs(spark, d).select("shard_idx", "row_idx", F.size(c).cast("long").alias("n_chars"),
                                 F.array_join(c, " ").alias("chars"))


def q_distinct_chars(spark, d):
    return vocab.distinct_chars(docs(spark, d))


def q_initial_vocab(spark, d):
    return char_vocab(spark, d)


def q_pieces(spark, d):
    p = encode.doc_pieces(docs(spark, d), SPECIALS)
    names = F.transform("pieces", lambda x: x["piece"])
    return p.select("shard_idx", "row_idx", F.size("pieces").cast("long").alias("n_pieces"),
                    F.array_join(names, " ").alias("pieces"))


def _injected(spark, d):
    # An end-of-text special before every document and in place of each line break.
    return docs(spark, d).withColumn(
        "text", F.concat(F.lit(EOT), F.regexp_replace("text", "\n", EOT)))


def _segments(spark, d, mode):
    s = _injected(spark, d).select(
        "shard_idx", "row_idx", F.posexplode(special_segments(F.col("text"), SPECIALS, mode))
        .alias("seg_idx", "seg"))
    return s.select("shard_idx", "row_idx", F.col("seg_idx").cast("int").alias("seg_idx"),
                    F.col("seg.special").alias("special"), F.col("seg.text").alias("seg_text"))


def q_special_segments(spark, d):
    return _segments(spark, d, "all")


def q_special_segments_leading(spark, d):
    return _segments(spark, d, "leading")


# --- vocabulary and char-level encoding --------------------------------------

def q_char_tokens(spark, d):
    t = vocab.char_tokens(docs(spark, d), char_vocab(spark, d))
    return _tokens_text(t.withColumn("n_tokens", F.size("tokens").cast("long")))


def q_shard_tokens(spark, d):
    toks = encode.shard_tokens(docs(spark, d), char_vocab(spark, d), None, SPECIALS)
    return _tokens_text(toks.withColumn("n_tokens", F.col("n_tokens").cast("long")))


def q_shard_stats(spark, d):
    return sampling.shard_stats(docs(spark, d), char_shard_sizes(spark, d))


def q_doc_offsets(spark, d):
    return packing.doc_offsets(char_shard_sizes(spark, d)).withColumn(
        "n_tokens", F.col("n_tokens").cast("long"))


# --- sampling and planning ---------------------------------------------------

def q_training_sample(spark, d):
    return sampling.training_sample(docs(spark, d), *SAMPLE)


def q_training_sample_budget(spark, d):
    return sampling.training_sample(docs(spark, d), *SAMPLE_TIGHT)


def q_missing_shards(spark, d):
    n = shards.estimate_shards_needed(MODEL_PARAMS)
    return shards.missing_shards(spark, n, docs(spark, d))


def q_shard_budget(spark, d):
    stats = sampling.shard_stats(docs(spark, d), char_shard_sizes(spark, d))
    budget = int(shards.DEFAULT_TOKENS_PER_PARAM * BUDGET_PARAMS)
    return shards.shards_for_budget(stats, budget).withColumn(
        "est_shards", F.lit(shards.estimate_shards_needed(BUDGET_PARAMS)).cast("long"))


# --- packing -----------------------------------------------------------------

def _windows(spark, d):
    return packing.token_windows(char_shard_tokens(spark, d), CONTEXT, N_VAL, N_TEST)


def q_split_sizes(spark, d):
    return packing.split_sizes(char_shard_sizes(spark, d), CONTEXT, N_VAL, N_TEST)


def q_token_windows(spark, d):
    w = _windows(spark, d)
    return w.select("split", "shard_idx", "chunk_idx", ints_to_text(F.col("input_ids")).alias("input_ids"),
                    ints_to_text(F.col("target_ids")).alias("target_ids"))


def q_worker_stripes(spark, d):
    s = packing.worker_stripes(_windows(spark, d), N_WORKERS)
    return s.groupBy("split", "worker").agg(F.count(F.lit(1)).alias("n_windows"))


def _cache(spark, d, rows_per_file=CACHE_ROWS):
    """A token cache of the documents, in the shared folder: shards 0 and 1 by one run, then the others by E6."""
    path = f"{checkpoint_dir(spark)}/token-cache-{new_run()}"
    delete_on_exit(spark, path)
    every, v = docs(spark, d), written(char_vocab(spark, d), "cache-vocab")
    corpus.tokenize_into(every.filter("shard_idx < 2"), v, None, path, SPECIALS, rows_per_file=rows_per_file)
    corpus.tokenize_and_cache_shards(spark, every, v, None, path, SPECIALS, rows_per_file=rows_per_file)
    return path


def q_cached_tokens(spark, d):
    """The tokens read back from a cache that two jobs published."""
    return _tokens_text(sinks.read_token_shards(spark, _cache(spark, d)).withColumn("n_tokens", F.col("n_tokens").cast("long")))


def q_split_windows(spark, d):
    """S5 + P4 + C4: validation and test windows, read from the files that hold these splits."""
    path = _cache(spark, d)
    val, test = (sinks.read_split_windows(spark, path, split, CONTEXT, N_VAL, N_TEST) for split in ("val", "test"))
    return val.unionByName(test).select("split", "shard_idx", "chunk_idx", ints_to_text(F.col("input_ids")).alias("input_ids"),
                                        ints_to_text(F.col("target_ids")).alias("target_ids"))


# --- BPE: training, encoding and decoding with merges -------------------------

def trained(spark: SparkSession, d: str) -> bpe.TrainedBPE:
    """Tokenizer trained on every piece of the corpus (piece scope): the
    initial vocabulary plus ``N_MERGES`` merges."""
    return bpe.train_bpe(_corpus_piece_blocks(spark, d), specials=SPECIALS, scope="piece", n_merges=N_MERGES)


def _merge_texts(t: bpe.TrainedBPE) -> DataFrame:
    v = t.vocab.select(F.col("token").alias("new_token"), "text")
    return t.merges.join(v, "new_token").select("rank", "t1", "t2", "new_token", "text")


def q_bpe_merges(spark, d):
    """B1 in the reference's scope: all documents, in the order of their ids, are one sequence."""
    text = table(spark, d, "documents").select(F.col("doc_id").alias("row_idx"), "text")
    return _merge_texts(bpe.train_bpe(bpe.sequence_blocks(text), specials=SPECIALS, scope="sequence", n_merges=N_MERGES))


def q_bpe_merges_piece(spark, d):
    """B1 in the scale mode: merges learned over every piece of the corpus."""
    return _merge_texts(trained(spark, d))


def q_vocab_after_merges(spark, d):
    return trained(spark, d).vocab


def trigram_merges(spark, d):
    """Merges whose texts collide: for each of the most frequent three-character strings
    xyz of the corpus pieces, (x,y), (y,z) and both ways to xyz, ids from 10000."""
    blocks = _corpus_piece_blocks(spark, d).filter(F.length("s") >= 3)
    at = F.explode(F.sequence(F.lit(1), F.length("s") - 2))
    grams = blocks.select("w", "s", at.alias("i")).select("w", F.expr("substring(s, i, 3)").alias("gram"))
    counts = grams.groupBy("gram").agg(F.sum("w").alias("n")).orderBy(F.desc("n"), "gram").limit(N_TRIGRAMS)
    ranked = counts.withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "gram")) - 1)
    ids = vocab.text_to_token(char_vocab(spark, d)).filter(F.length("text") == 1)
    for i, name in enumerate(("x", "y", "z"), 1):
        ranked = ranked.join(ids.select(F.col("text").alias(f"c{i}"), F.col("token").alias(name)),
                             F.substring("gram", i, 1) == F.col(f"c{i}"))
    base = (F.lit(10000) + 4 * F.col("r")).cast("int")
    rows = F.array(*[F.struct(a.cast("int").alias("t1"), b.cast("int").alias("t2"), (base + k).alias("new_token")) for k, (a, b) in enumerate(
        [(F.col("x"), F.col("y")), (F.col("y"), F.col("z")), (base, F.col("z")), (F.col("x"), base + 1)])])
    return ranked.select(F.explode(rows).alias("m")).select("m.*")


def q_vocab_collisions(spark, d):
    ext = vocab.extend_vocab(char_vocab(spark, d), trigram_merges(spark, d))
    c = vocab.vocab_collisions(ext)
    return c.select("text", F.col("n_tokens").cast("long").alias("n_tokens"), ints_to_text(F.col("tokens")).alias("tokens"))


def q_encode_docs(spark, d):
    t = trained(spark, d)
    toks = encode.shard_tokens(docs(spark, d), t.vocab, t.merges, SPECIALS)
    return _tokens_text(toks.withColumn("n_tokens", F.col("n_tokens").cast("long")))


def q_decode_docs(spark, d):
    """Round trip: decode(encode(text)) of every document with the trained
    tokenizer; equals the text without dropped whitespace, plus EOT."""
    t = trained(spark, d)
    return decode.decode_tokens(encode.shard_tokens(docs(spark, d), t.vocab, t.merges, SPECIALS), t.vocab)


def q_piece_codes(spark, d):
    t = trained(spark, d)
    pc = encode.piece_codes(encode.distinct_pieces(docs(spark, d), SPECIALS), t.vocab, t.merges)
    return pc.select("piece", ints_to_text(F.col("codes")).alias("codes"))


def q_piece_dictionary(spark, d):
    """The piece dictionary that two batches of shards have extended, the first one repeated."""
    path = f"{checkpoint_dir(spark)}/piece-dictionary-{new_run()}"
    delete_on_exit(spark, path)
    t, every = trained(spark, d), docs(spark, d)
    for key, some in (("first", "shard_idx < 2"), ("first", "shard_idx < 2"), ("second", "true")):
        dictionary.extend_dictionary(every.filter(some), t.vocab, t.merges, path, key, SPECIALS)
    return dictionary.read_dictionary(spark, path).select("piece", ints_to_text(F.col("codes")).alias("codes"))


# --- one behaviour at every vocabulary size, injected text ------------------------

def _wide(spark, d):
    """Every document followed by one of ``WIDE_ALPHABET`` characters from U+4E00 on."""
    code = F.lpad(F.hex(F.lit(0x4E00) + F.pmod(F.col("shard_idx") + N_SHARDS * F.col("row_idx"), F.lit(WIDE_ALPHABET))), 4, "0")
    return docs(spark, d).withColumn("text", F.concat("text", F.lit(" "), F.decode(F.unhex(code), "UTF-16BE")))


def q_encode_wide_alphabet(spark, d):
    """E5 at character level with an alphabet of thousands of characters."""
    wide = _wide(spark, d)
    v = vocab.initial_vocab(vocab.distinct_chars(wide), SPECIALS)
    return _tokens_text(encode.shard_tokens(wide, v, None, SPECIALS).withColumn("n_tokens", F.col("n_tokens").cast("long")))


def q_decode_wide_vocab(spark, d):
    """E1 and E4 with ``WIDE_VOCAB`` whole pieces as vocabulary entries, the most frequent ones."""
    base = char_vocab(spark, d)
    top = (_corpus_piece_blocks(spark, d).filter(F.length("s") > 1).orderBy(F.desc("w"), "s").limit(WIDE_VOCAB)
           .select("s", F.row_number().over(Window.orderBy(F.desc("w"), "s")).alias("r")))
    words = top.select((F.lit(99_999) + F.col("r")).cast("int").alias("token"), F.col("s").alias("text"), F.lit("merge").alias("kind"))
    v = written(base.unionByName(words), "wide-vocab")
    toks = written(encode.shard_tokens(docs(spark, d), v, None, SPECIALS), "wide-tokens")
    text = decode.decode_tokens(toks, v)
    return text.join(toks.select("shard_idx", "row_idx", F.col("n_tokens").cast("long").alias("n_tokens")), ["shard_idx", "row_idx"])


def q_oov_rejects(spark, d):
    """Q5: documents with a character that the vocabulary lacks."""
    v = char_vocab(spark, d)
    other = docs(spark, d).withColumn("text", F.replace("text", F.lit("worthless"), F.lit("Ω")))
    return encode.oov_rejects(encode.shard_tokens(other, v, None, SPECIALS, on_oov="null"))


def _mixed_text(spark, d):
    """Documents with tabs, no-break and repeated spaces, CR LF and characters above U+00FF."""
    t = F.col("text")
    for a, b in INJECTED:
        t = F.replace(t, F.lit(a), F.lit(b))
    return docs(spark, d).withColumn("text", t)


def q_pieces_injected(spark, d):
    p = encode.doc_pieces(_mixed_text(spark, d), ())
    return p.select("shard_idx", "row_idx", F.size("pieces").cast("long").alias("n_pieces"),
                    F.array_join(F.transform("pieces", lambda x: x["piece"]), "|").alias("pieces"))


def q_special_segments_multi(spark, d):
    """T1 + L3 with special texts that hold each other: the longest wins."""
    t = F.replace(F.replace("text", F.lit("\n"), F.lit(EOT)), F.lit(" the "), F.lit(" <|end "))
    s = docs(spark, d).select("shard_idx", "row_idx", F.posexplode(special_segments(t, MULTI_SPECIALS, "all")).alias("seg_idx", "seg"))
    return s.select("shard_idx", "row_idx", F.col("seg_idx").cast("int").alias("seg_idx"),
                    F.col("seg.special").alias("special"), F.col("seg.text").alias("seg_text"))


def q_special_segments_many(spark, d):
    """T1 with hundreds of specials: every capital with three small letters that the benchmark holds."""
    found = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(MANY_SPECIALS), F.lit(0))).alias("s")).distinct()
    specials = sorted(r["s"] for r in found.limit(SPECIALS_AT_MOST + 1).collect())
    require(len(specials) <= SPECIALS_AT_MOST, "too many specials for one list")
    s = docs(spark, d).select("shard_idx", "row_idx", F.posexplode(special_segments_many(F.col("text"), specials)).alias("seg_idx", "seg"))
    return s.select("shard_idx", "row_idx", F.col("seg_idx").cast("int").alias("seg_idx"),
                    F.col("seg.special").alias("special"), F.col("seg.text").alias("seg_text"))


# --- registered building blocks -----------------------------------------------------

def q_scan_shards(spark, d):
    """S1 on the given file: its name holds no shard number, so the index is NULL."""
    return shards.scan_shards(spark, f"{d}/documents.parquet")


def q_scan_shard_files(spark, d):
    """S1 on files called by their shard numbers: the documents by id, a folder of part files a shard."""
    path = f"{checkpoint_dir(spark)}/raw-{new_run()}"
    delete_on_exit(spark, path)
    every = table(spark, d, "documents").select("text", "doc_id", F.pmod("doc_id", F.lit(N_SHARDS)).alias("shard")).filter("shard is not null")
    # Ranges of ids, in order: a task writes a part of a shard.
    every.repartitionByRange("shard", "doc_id").sortWithinPartitions("shard", "doc_id").write.partitionBy("shard").parquet(f"{path}/written")
    for i in range(N_SHARDS):
        if path_exists(spark, f"{path}/written/shard={i}"):
            move_file(spark, f"{path}/written/shard={i}", f"{path}/raw/{shards.SHARD_NAME_FORMAT % i}")
    if not path_exists(spark, f"{path}/raw"):  # no documents
        every.select("text", "doc_id").filter("false").write.parquet(f"{path}/raw/{shards.SHARD_NAME_FORMAT % 0}")
    return shards.scan_shards(spark, f"{path}/raw")


def q_stored_tokenizer(spark, d):
    """The vocabulary of the trained tokenizer, read back from its second stored version."""
    path = f"{checkpoint_dir(spark)}/tokenizer-{new_run()}"
    delete_on_exit(spark, path)
    t = trained(spark, d)
    sinks.write_tokenizer(t.vocab.filter("kind <> 'merge'"), t.merges.filter("false"), path)
    sinks.write_tokenizer(t.vocab, t.merges, path)
    return sinks.read_tokenizer(spark, path)[0].select("token", "text", "kind")


def q_pending_shards(spark, d):
    """Shards of the documents (by id) for which the benchmark holds no item."""
    by = lambda c: F.pmod(F.col(c), F.lit(N_MANY_SHARDS)).cast("int").alias("shard_idx")
    raw = table(spark, d, "documents").select(by("doc_id")).distinct()
    return shards.pending_shards(raw, table(spark, d, "benchmark").select(by("item_id")))


def _pass_rows(spark, d, v):
    return encode.char_lists(encode.distinct_pieces(docs(spark, d), SPECIALS), "piece", v)


def q_piece_lookup(spark, d):
    """Whole pieces in the vocabulary extended by the data-derived merges."""
    v = char_vocab(spark, d)
    ext = vocab.extend_vocab(v, pass_merges(spark, d, v))
    return encode.piece_lookup(encode.distinct_pieces(docs(spark, d), SPECIALS), ext)


def q_mergeable_pairs(spark, d):
    """J4 + W3: neighbours in a piece that the data-derived merge table holds."""
    v = char_vocab(spark, d)
    return encode.mergeable_pairs(_pass_rows(spark, d, v), pass_merges(spark, d, v))


def _corpus_piece_blocks(spark, d):
    return bpe.piece_blocks(docs(spark, d), SPECIALS)


def _corpus_pair_counts(spark, d):
    return bpe.corpus_pair_counts(docs(spark, d), SPECIALS)


def q_pair_counts(spark, d):
    """A2 over every piece of the corpus (piece scope, character symbols)."""
    c = _corpus_pair_counts(spark, d)
    return c.select("pair", F.col("n").cast("long").alias("n"))


def q_top_pairs(spark, d):
    """A3: most frequent pairs, ties to the first occurrence."""
    top = _corpus_pair_counts(spark, d).orderBy(F.desc("n"), F.asc("first")).limit(N_TOP_PAIRS)
    return top.select("pair", F.col("n").cast("long").alias("n"))


def pass_merges(spark, d, chars):
    """A data-derived merge table: the most frequent character pairs of the
    corpus pieces, new ids from 1000 in rank order."""
    v = vocab.text_to_token(chars)
    top = _corpus_pair_counts(spark, d).orderBy(F.desc("n"), F.asc("first")).limit(N_PASS_MERGES)
    ranked = top.select(F.substring("pair", 1, 1).alias("a"), F.substring("pair", 2, 1).alias("b"),
                        F.row_number().over(Window.orderBy(F.desc("n"), F.asc("first"))).alias("r"))
    v1 = v.select(F.col("text").alias("a"), F.col("token").alias("t1"))
    v2 = v.select(F.col("text").alias("b"), F.col("token").alias("t2"))
    return ranked.join(v1, "a").join(v2, "b").select(
        "t1", "t2", (F.lit(999) + F.col("r")).cast("int").alias("new_token"))


def q_merge_pass(spark, d):
    """W3 + J4 + W4: one greedy pass of the data-derived merge table over
    every distinct piece of the corpus."""
    v = char_vocab(spark, d)
    out = encode.merge_pass(_pass_rows(spark, d, v), pass_merges(spark, d, v))
    return out.select("piece", ints_to_text(F.col("tokens")).alias("codes"))


def q_merge_pass_docs(spark, d):
    """The same pass over whole documents: each is one sequence of characters, scanned in chunks.
    Documents of one key are one sequence, in the order of their positions."""
    keys = ["shard_idx", "row_idx"]
    same = docs(spark, d).filter(F.col("text") != "").groupBy(*keys).agg(F.collect_list("text").alias("texts"))
    chars = F.sort_array(F.flatten(F.transform("texts", lambda t: F.transform(F.split(t, ""), lambda c, i: F.struct(i.alias("pos"), c.alias("ch"))))))
    alone = F.size("texts") == 1
    seqs = same.withColumn("chars", F.when(~alone, chars)).select(
        *keys, F.when(~alone, F.transform("chars", lambda c: c["pos"])).alias("pos"),
        F.when(alone, F.element_at("texts", 1)).otherwise(F.array_join(F.transform("chars", lambda c: c["ch"]), "")).alias("text"))
    v = char_vocab(spark, d)
    rows = encode.char_lists(seqs, "text", v).drop("text")
    out = encode.merge_pass(rows, pass_merges(spark, d, v), keys, chunk=PASS_CHUNK)
    # Positions that repeat are ordered by their tokens.
    repeat = F.size("pos") > F.size(F.array_distinct("pos"))
    tied = F.transform(F.sort_array(F.arrays_zip("pos", "tokens")), lambda x: x["tokens"])
    return out.select(*keys, F.size("tokens").cast("long").alias("n_tokens"),
                      ints_to_text(F.when(repeat, tied).otherwise(F.col("tokens"))).alias("codes"))


# --- vector tables ----------------------------------------------------------------

DIM = 64
HEADS = 4
MATRIX_INNER, MATRIX_TILE = 90, 32
TILE = 64
HISTORY, WINDOW_TILE = 12, 2
GAPS = 41                    # vec_id modulo this: 1 no vector, 2 a short one, 3 a missing entry
UNKNOWN = 40                 # tokens with remainder 10 have no vector
UNKNOWN_USER = "view"        # event type whose events have no user
# Weights of the vector queries (deterministic parameters, rule_matrix).
FFN_W1_T = rule_matrix(4 * DIM, DIM, 0.5, 0.125)
FFN_B1 = rule_matrix(1, 4 * DIM, 1.5, 0.01)[0]
FFN_W2_T = rule_matrix(DIM, 4 * DIM, 2.5, 0.0625)
FFN_B2 = rule_matrix(1, DIM, 3.5, 0.01)[0]
PROJ_W_T = rule_matrix(16, DIM, 4.5, 0.125)
PROJ_B = rule_matrix(1, 16, 5.5, 0.01)[0]


def _explode_vec(df: DataFrame, keys: list[str], col: str, idx: str = "d", digits: int = 6) -> DataFrame:
    return df.select(*keys, F.posexplode(col).alias(idx, "val")).select(
        *keys, F.col(idx).cast("int").alias(idx), (F.round("val", digits) + F.lit(0.0)).alias("val"))


def q_matmul_cells(spark, d):
    li = table(spark, d, "lineitem")
    # Cells keyed by plain columns only (no time-zone dependent keys).
    a = li.groupBy(F.col("l_returnflag").alias("batch"), F.col("l_linestatus").alias("i"),
                   F.col("l_linenumber").alias("k")).agg(F.sum("l_quantity").alias("v"))
    b = li.groupBy(F.col("l_returnflag").alias("batch"), F.col("l_linenumber").alias("k"),
                   F.col("l_linestatus").alias("j")).agg(F.sum("l_discount").alias("v"))
    c = vectors.matmul_cells(a, b)
    return c.select("batch", "i", "j", (F.round("v", 4) + F.lit(0.0)).alias("v"))


def q_matmul_blocks(spark, d):
    """V1 by blocks: suppliers by residues of parts, times residues of parts by line numbers."""
    li = table(spark, d, "lineitem")
    inner = F.pmod("l_partkey", F.lit(MATRIX_INNER)).alias("k")
    a = li.groupBy(F.col("l_returnflag").alias("batch"), F.col("l_suppkey").alias("i"), inner).agg(F.sum("l_quantity").alias("v"))
    b = li.groupBy(F.col("l_returnflag").alias("batch"), inner, F.col("l_linenumber").alias("j")).agg(F.sum("l_discount").alias("v"))
    c = vectors.matmul_blocks(a, b, MATRIX_TILE)
    return c.select("batch", "i", "j", (F.round("v", 4) + F.lit(0.0)).alias("v"))


def _gappy(spark, d):
    """The embeddings, some without a vector, with a short one, or with a missing entry."""
    case, at = F.col("vec_id") % GAPS, F.col("embedding")
    vec = F.when(case == 1, F.lit(None)).when(case == 2, F.slice(at, 1, DIM - 1)).when(
        case == 3, F.transform(at, lambda x, i: F.when(i != 5, x))).otherwise(at)
    return table(spark, d, "embeddings").withColumn("embedding", vec)


def _with_rejects(pair: tuple[DataFrame, DataFrame], idx: str = "d") -> DataFrame:
    """A vector's entries, or one row with the reason why it has none."""
    out, bad = pair
    none = bad.select("vec_id", F.lit(None).cast("int").alias(idx), F.lit(None).cast("double").alias("val"), "reason")
    return _explode_vec(out, ["vec_id"], "out", idx).withColumn("reason", F.lit(None).cast("string")).unionByName(none)


def q_vector_standardize(spark, d):
    return _with_rejects(vectors.standardize_vectors(_gappy(spark, d), "embedding", DIM))


def q_ffn_scores(spark, d):
    return _with_rejects(vectors.score_ffn(_gappy(spark, d), "embedding", FFN_W1_T, FFN_B1, FFN_W2_T, FFN_B2))


def q_project_vectors(spark, d):
    return _with_rejects(vectors.project_vectors(_gappy(spark, d), "embedding", PROJ_W_T, PROJ_B), "j")


def q_embed_tokens(spark, d):
    """Char-level windows embedded with the embeddings table as token table
    (token t = row vec_id t, some tokens unknown) and as position table (position p = row p)."""
    emb = table(spark, d, "embeddings")
    tok = emb.filter(F.col("vec_id") % UNKNOWN != 10).select(F.col("vec_id").cast("int").alias("token"), F.col("embedding").alias("vec"))
    pos = emb.select(F.col("vec_id").cast("int").alias("pos"), F.col("embedding").alias("vec"))
    e = vectors.embed_tokens(_windows(spark, d), tok, pos, measure=vectors.sum_of_squares)
    return e.groupBy("split", "shard_idx", "chunk_idx").agg(
        F.round(F.sum("total"), 4).alias("sumsq"), F.sum("unknown").alias("n_unknown"))


def q_causal_pool(spark, d):
    emb = table(spark, d, "embeddings")
    out = vectors.causal_pool(emb, "label", "vec_id", "embedding", n_heads=HEADS, tile=TILE)
    out = out.select(F.col("seq").cast("int").alias("label"), F.col("pos").alias("vec_id"), "out")
    return _explode_vec(out, ["label", "vec_id"], "out")


def q_causal_pool_window(spark, d):
    """V5 with a bounded history: the last ``HISTORY`` rows of the label."""
    emb = table(spark, d, "embeddings")
    out = vectors.causal_pool(emb, "label", "vec_id", "embedding", n_heads=HEADS, tile=WINDOW_TILE, max_history=HISTORY)
    out = out.select(F.col("seq").cast("int").alias("label"), F.col("pos").alias("vec_id"), "out")
    return _explode_vec(out, ["label", "vec_id"], "out")


def q_group_softmax(spark, d):
    """Shares of the events of a user; those of one event type as if their user were unknown."""
    ev = table(spark, d, "events")
    user = F.when(F.col("event_type") != UNKNOWN_USER, F.col("user_id"))
    p = vectors.group_softmax(ev.select("event_id", user.alias("user_id"), "value"), "user_id", "value")
    return p.select("event_id", "user_id", (F.round("p", 9) + F.lit(0.0)).alias("p"))


N_LEVEL2_MERGES = 20


def two_level_merges(spark, d):
    """A data-derived merge table with merges on merges: level 1 is
    :func:`pass_merges` (ids from 1000); one pass of it over every distinct
    piece, then the most frequent adjacent pairs that involve a level-1 token
    (occurrence-weighted, ties by ids) become level 2 (ids from 2000).
    Returns ``(vocab, merges)`` extending the character vocabulary."""
    cv = char_vocab(spark, d)
    l1 = written(pass_merges(spark, d, cv), "level-1")
    rows = encode.char_lists(_corpus_piece_blocks(spark, d).select(F.col("s").alias("piece"), "w"), "piece", cv)
    passed = encode.merge_pass(rows, l1)
    n = F.greatest(F.size("tokens") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("tokens", 1, n), F.slice("tokens", 2, n), lambda x, y: F.struct(x.alias("t1"), y.alias("t2")))
    adj = passed.select("w", F.explode(pairs).alias("p")).select("w", "p.*").filter(
        F.col("t2").isNotNull() & ((F.col("t1") >= 1000) | (F.col("t2") >= 1000)))
    cnt = adj.groupBy("t1", "t2").agg(F.sum("w").alias("n"))
    order = [F.desc("n"), F.asc("t1"), F.asc("t2")]
    l2 = cnt.orderBy(*order).limit(N_LEVEL2_MERGES).select(
        "t1", "t2", (F.lit(1999) + F.row_number().over(Window.orderBy(*order))).cast("int").alias("new_token"))
    merges = written(l1.unionByName(l2).withColumn("rank", F.col("new_token")), "two-levels")
    ext = vocab.extend_vocab(cv.select("token", "text", "kind"), merges)
    return ext, merges


def q_encode_two_level(spark, d):
    """E2 + E3 to the fixpoint with merges on merges: every distinct piece of
    the corpus, whole-piece lookup first."""
    ext, merges = two_level_merges(spark, d)
    pc = encode.piece_codes(encode.distinct_pieces(docs(spark, d), SPECIALS), ext, merges)
    return pc.select("piece", ints_to_text(F.col("codes")).alias("codes"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_docs": q_scan_docs,
    "nonempty_docs": q_nonempty_docs,
    "preprocessed_chars": q_preprocessed_chars,
    "distinct_chars": q_distinct_chars,
    "initial_vocab": q_initial_vocab,
    "pieces": q_pieces,
    "special_segments": q_special_segments,
    "special_segments_leading": q_special_segments_leading,
    "char_tokens": q_char_tokens,
    "shard_tokens": q_shard_tokens,
    "shard_stats": q_shard_stats,
    "doc_offsets": q_doc_offsets,
    "training_sample": q_training_sample,
    "training_sample_budget": q_training_sample_budget,
    "missing_shards": q_missing_shards,
    "shard_budget": q_shard_budget,
    "split_sizes": q_split_sizes,
    "token_windows": q_token_windows,
    "cached_tokens": q_cached_tokens,
    "split_windows": q_split_windows,
    "worker_stripes": q_worker_stripes,
    "pair_counts": q_pair_counts,
    "top_pairs": q_top_pairs,
    "merge_pass": q_merge_pass,
    "merge_pass_docs": q_merge_pass_docs,
    "encode_two_level": q_encode_two_level,
    "bpe_merges": q_bpe_merges,
    "bpe_merges_piece": q_bpe_merges_piece,
    "vocab_after_merges": q_vocab_after_merges,
    "vocab_collisions": q_vocab_collisions,
    "piece_codes": q_piece_codes,
    "piece_dictionary": q_piece_dictionary,
    "encode_docs": q_encode_docs,
    "decode_docs": q_decode_docs,
    "matmul_cells": q_matmul_cells,
    "matmul_blocks": q_matmul_blocks,
    "vector_standardize": q_vector_standardize,
    "ffn_scores": q_ffn_scores,
    "project_vectors": q_project_vectors,
    "embed_tokens": q_embed_tokens,
    "causal_pool": q_causal_pool,
    "causal_pool_window": q_causal_pool_window,
    "group_softmax": q_group_softmax,
    "scan_shards": q_scan_shards,
    "scan_shard_files": q_scan_shard_files,
    "stored_tokenizer": q_stored_tokenizer,
    "pending_shards": q_pending_shards,
    "piece_lookup": q_piece_lookup,
    "mergeable_pairs": q_mergeable_pairs,
    "encode_wide_alphabet": q_encode_wide_alphabet,
    "decode_wide_vocab": q_decode_wide_vocab,
    "oov_rejects": q_oov_rejects,
    "pieces_injected": q_pieces_injected,
    "special_segments_multi": q_special_segments_multi,
    "special_segments_many": q_special_segments_many,
}
