"""Training-text sampling (head of shard 0 under a character budget) and
shard statistics."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..validation import require, require_columns


# Rows whose lengths are summed together.
BUCKET_ROWS = 1 << 13


def bucket_totals(head: DataFrame, n_rows: int, max_chars: int, bucket_rows: int = BUCKET_ROWS) -> list[tuple[int, int]]:
    """``(bucket, characters)`` of the first buckets of rows, in order, until ``max_chars`` are
    reached. The range of rows looked at doubles, so not much more than the prefix is read."""
    bucket = F.floor(F.col("row_idx") / bucket_rows).cast("long")
    out, lo, hi = [], 0, bucket_rows
    while True:
        part = head.filter((F.col("row_idx") >= lo) & (F.col("row_idx") < hi)).groupBy(bucket.alias("b")).agg(F.sum(F.length("text")).alias("n"))
        out += sorted(map(tuple, part.collect()))
        if hi >= n_rows or sum(n for _, n in out) >= max_chars:
            return out
        lo, hi = hi, 2 * hi


def training_sample(docs: DataFrame, shard_fraction: float = 0.01,
                    max_chars: int = 200_000, shard: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """L1 + L2 + W2: the first ``max(1, int(n * fraction))`` rows of the shard
    (empty ones count but are skipped), cut to a running character budget;
    the document that crosses the budget is truncated.

    Returns ``(row_idx, text, n_chars)``; joined with newlines these rows
    are the tokenizer's training text. ``row_idx`` is the dense row
    position in the shard, so the head is a pushed-down range filter.
    The bucket in which the budget ends comes from the characters of buckets of rows; rows
    behind it are not read again, and the running sum is taken inside each bucket.
    """
    require(0 < shard_fraction <= 1, "shard_fraction must be in (0, 1]")
    require(max_chars > 0, "max_chars must be > 0")
    require_columns(docs, ["shard_idx", "row_idx", "text"], "training_sample")
    in_shard = docs.filter(F.col("shard_idx") == shard)
    n_rows = in_shard.count()
    n_sample = max(1, int(n_rows * shard_fraction))
    head = in_shard.filter((F.col("row_idx") < n_sample) & F.col("text").isNotNull() & (F.col("text") != ""))
    bases, total = [], 0
    for b, n in bucket_totals(head, n_sample, max_chars, bucket_rows):
        if total < max_chars:
            bases.append((b, total))
        total += n
    end = (bases[-1][0] + 1) * bucket_rows if bases else 0
    table = docs.sparkSession.createDataFrame(bases, "bucket long, base long")  # one row for each bucket before the cut
    rows = head.filter(F.col("row_idx") < end).withColumn("bucket", F.floor(F.col("row_idx") / bucket_rows).cast("long")).join(F.broadcast(table), "bucket")
    w = Window.partitionBy("bucket").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum(F.length("text")).over(w), F.lit(0))
    budget = rows.select("row_idx", "text", before.alias("before")).filter(F.col("before") < max_chars)
    cut = F.expr(f"substring(text, 1, int({max_chars} - before))")
    return budget.select("row_idx", cut.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def shard_stats(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """A4: ``(shard_idx, n_tokens, n_docs)``; ``n_docs`` counts every row of
    the raw shard, empty documents included."""
    require_columns(docs, ["shard_idx"], "shard_stats")
    require_columns(tokens, ["shard_idx", "n_tokens"], "shard_stats")
    n_docs = docs.groupBy("shard_idx").agg(F.count(F.lit(1)).alias("n_docs"))
    n_tok = tokens.groupBy("shard_idx").agg(F.sum("n_tokens").cast("long").alias("n_tokens"))
    return n_docs.join(n_tok, "shard_idx", "left").select(
        "shard_idx", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "n_docs")
