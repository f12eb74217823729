"""End-to-end jobs over a sharded corpus (the reference's pipeline entry
points as Spark jobs)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import EOT
from ..operators import bpe, encode, packing, sampling
from ..session import Written
from ..sources import sinks
from ..sources.shards import pending_shards


def train_tokenizer_job(docs: DataFrame, vocab_size: int, out_path: str | None = None,
                        shard_fraction: float = 0.01, max_chars: int = 200_000,
                        specials: Sequence[str] = (EOT,)) -> bpe.TrainedBPE:
    """Sample shard 0 (L1/L2), train (B1), optionally persist."""
    smp = sampling.training_sample(docs, shard_fraction, max_chars)
    res = bpe.train_tokenizer(smp, vocab_size, specials)
    if out_path:
        sinks.write_tokenizer(res.vocab, res.merges, out_path)
    return res


def tokenize_into(docs: DataFrame, vocab: DataFrame, merges: DataFrame | None, token_dir: str,
                  specials: Sequence[str] = (EOT,), on_oov: str = "reject", key: str | None = None,
                  refused: DataFrame | None = None, dictionary: DataFrame | None = None,
                  rows_per_file: int = sinks.ROWS_PER_FILE) -> DataFrame:
    """E5 + S4: tokenise the shards of ``docs`` into the cache ``token_dir``.

    Accepted documents, rejected documents (with those of ``refused``) and one finished
    record per shard, also for a shard that yields no tokens, are published together, once
    for a ``key``. With a piece ``dictionary`` (piece, codes) pieces are looked up there.
    Returns the totals ``(shard_idx, n_tokens, n_docs, n_rejected)`` of these shards.
    """
    mode = "fail" if on_oov == "fail" else "null"
    held = Written(encode.shard_tokens(docs, vocab, merges, specials, on_oov=mode, dictionary=dictionary), "shard-tokens")
    rejects = encode.oov_rejects(held.df) if on_oov == "reject" else held.df.filter("false").select(
        *encode.DOC_KEYS, F.lit("").alias("reason"))
    accepted = encode.apply_oov(held.df, on_oov) if on_oov == "reject" else held.df
    n_refused = rejects.groupBy("shard_idx").agg(F.count("*").alias("n_rejected"))
    totals = Written(sampling.shard_stats(docs, accepted).join(n_refused, "shard_idx", "left").select(
        "shard_idx", "n_tokens", "n_docs", F.coalesce("n_rejected", F.lit(0)).cast("long").alias("n_rejected")), "shard-totals")
    sinks.write_run(accepted, rejects if refused is None else rejects.unionByName(refused), totals.df, token_dir, key, rows_per_file)
    held.drop()
    return totals.df


def tokenize_and_cache_shards(spark: SparkSession, docs: DataFrame, vocab: DataFrame,
                              merges: DataFrame | None, token_dir: str,
                              specials: Sequence[str] = (EOT,), on_oov: str = "reject",
                              rows_per_file: int = sinks.ROWS_PER_FILE) -> DataFrame:
    """Tokenise every shard that is not finished yet (J6) into the cache.
    Returns the totals of the shards written (empty when nothing was pending)."""
    todo = pending_shards(docs, sinks.finished_shards(spark, token_dir))
    if todo.isEmpty():
        return spark.createDataFrame([], "shard_idx int, n_tokens long, n_docs long, n_rejected long")
    return tokenize_into(todo, vocab, merges, token_dir, specials, on_oov, rows_per_file=rows_per_file)


def windows_job(spark: SparkSession, token_dir: str, context_length: int,
                n_val: int = 5_120_000, n_test: int = 5_120_000) -> DataFrame:
    """S5 -> C1..C3: the packed train/val/test windows of a token cache."""
    return packing.token_windows(sinks.read_token_shards(spark, token_dir), context_length, n_val, n_test)
