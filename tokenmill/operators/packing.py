"""Packing token shards into train/val/test context windows.

The token stream of a shard is the concatenation of its documents' token
arrays in row order. Nothing is exploded per token: windows inside a document
are slices of it, and the slices of the others are put together again.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..validation import require, require_columns

SPLITS = ("train", "val", "test")
# Rows per bucket of the two-level running sum (a bucket is summed in one task).
PREFIX_BUCKET_ROWS = 1 << 16
# Rows with their token arrays that are packed together.
PACK_BUCKET_ROWS = 1 << 11


def running_offsets(df: DataFrame, part: str, order: str, value: str,
                    out: str = "offset", bucket_rows: int = PREFIX_BUCKET_ROWS) -> DataFrame:
    """Exclusive running sum of ``value`` in ``order`` inside ``part``.

    Two levels, so a huge partition (one giant shard) is not summed in a
    single task: rows are bucketed by ``order div bucket_rows``; bucket
    totals get a running sum over the (small) bucket table, which is added
    to the running sum inside each bucket.
    """
    b = F.floor(F.col(order) / bucket_rows).cast("long")
    x = df.withColumn("_bucket", b)
    totals = x.groupBy(part, "_bucket").agg(F.sum(value).alias("_btot"))
    wb = Window.partitionBy(part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(part, "_bucket", F.coalesce(F.sum("_btot").over(wb), F.lit(0)).alias("_base"))
    wi = Window.partitionBy(part, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = x.withColumn("_in", F.coalesce(F.sum(value).over(wi), F.lit(0)))
    return (inner.join(bases, [part, "_bucket"], "inner")
            .withColumn(out, (F.col("_base") + F.col("_in")).cast("long"))
            .drop("_bucket", "_in", "_base"))


def doc_offsets(tokens: DataFrame) -> DataFrame:
    """W1 on a token shard table: ``(shard_idx, row_idx, n_tokens, offset)``."""
    require_columns(tokens, ["shard_idx", "row_idx", "n_tokens"], "doc_offsets")
    return running_offsets(tokens.select("shard_idx", "row_idx", "n_tokens"),
                           "shard_idx", "row_idx", "n_tokens")


def split_ranges(shard_totals: DataFrame, n_val: int, n_test: int) -> DataFrame:
    """Token ranges of each split per shard
    ``(split, shard_idx, start, length)``. Validation and test come from
    shard 0 only, by token offset (clamped when the shard is short); the
    rest of shard 0 and all other shards are training data."""
    require(n_val >= 0 and n_test >= 0, "n_val and n_test must be >= 0")
    r = shard_totals.select("shard_idx", F.explode(
        split_array(F.col("shard_idx"), F.col("n_tokens"), n_val, n_test)).alias("r"))
    return r.select(F.col("r.split").alias("split"), "shard_idx", F.col("r.start").alias("start"),
                    F.col("r.length").alias("length"))


def split_array(shard: Column, total: Column, n_val: int, n_test: int) -> Column:
    """The split ranges of a shard with ``total`` tokens as an array of structs."""
    def part(name: str, start: Column, length: Column) -> Column:
        return F.struct(F.lit(name).alias("split"), start.cast("long").alias("start"), length.cast("long").alias("length"))
    skip = F.least(total, F.lit(n_val + n_test))
    head = F.array(part("val", F.lit(0), F.least(total, F.lit(n_val))),
                   part("test", F.lit(n_val), F.least(F.greatest(total - n_val, F.lit(0)), F.lit(n_test))),
                   part("train", skip, total - skip))
    return F.when(shard == 0, head).otherwise(F.array(part("train", F.lit(0), total)))


def shard_totals(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("shard_idx").agg(F.sum("n_tokens").cast("long").alias("n_tokens"))


def split_sizes(tokens: DataFrame, context_length: int, n_val: int, n_test: int) -> DataFrame:
    """Per split and shard: tokens and complete windows
    ``(split, shard_idx, n_tokens, n_windows)``."""
    w = context_length + 1
    r = split_ranges(shard_totals(tokens), n_val, n_test)
    return r.select("split", "shard_idx", F.col("length").alias("n_tokens"),
                    F.floor(F.col("length") / w).cast("long").alias("n_windows"))


def token_windows(tokens: DataFrame, context_length: int, n_val: int = 5_120_000,
                  n_test: int = 5_120_000, bucket_rows: int = PACK_BUCKET_ROWS) -> DataFrame:
    """Non-overlapping windows of ``context_length + 1`` tokens per split
    and shard, the incomplete tail of each split dropped; returns
    ``(split, shard_idx, chunk_idx, input_ids, target_ids)`` with targets
    shifted by one.

    A document crossing a split boundary contributes a slice to each side;
    chunk numbers restart at each split's start. Token arrays are shuffled once,
    by (shard, bucket of rows): windows inside a document are cut there, and only the
    slices of windows that straddle documents are shuffled again. Offsets and split
    ranges come from one narrow row per bucket.
    """
    require(context_length >= 1, "context_length must be >= 1")
    require(n_val >= 0 and n_test >= 0, "n_val and n_test must be >= 0")
    require_columns(tokens, ["shard_idx", "row_idx", "n_tokens", "tokens"], "token_windows")
    bucket = F.floor(F.col("row_idx") / bucket_rows).cast("long")
    sums = tokens.groupBy("shard_idx", bucket.alias("bucket")).agg(F.sum("n_tokens").cast("long").alias("n"))
    shard = Window.partitionBy("shard_idx")
    bases = sums.select(
        F.col("shard_idx").alias("b_shard"), F.col("bucket").alias("b_bucket"),
        F.coalesce(F.sum("n").over(shard.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(shard).alias("total"))
    inside = Window.partitionBy("shard_idx", "bucket").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    d = (tokens.select("shard_idx", "row_idx", "n_tokens", "tokens", bucket.alias("bucket"))
         .withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
         .join(bases, (F.col("shard_idx") == F.col("b_shard")) & (F.col("bucket") == F.col("b_bucket"))))
    d = d.select("shard_idx", "bucket", "n_tokens", "tokens", (F.col("base") + F.col("before")).alias("offset"),
                 F.explode(split_array(F.col("shard_idx"), F.col("total"), n_val, n_test)).alias("r"))
    return cut_windows(d, context_length)


def cut_windows(d: DataFrame, context_length: int) -> DataFrame:
    """The complete windows of documents ``(shard_idx, bucket, n_tokens, tokens, offset, r)``: each
    with its token offset in the shard and a range ``r`` (split, start, length) it has tokens in.
    Every document of a range must be there."""
    require(context_length >= 1, "context_length must be >= 1")
    w = context_length + 1
    start = F.col("r.start")
    lo = F.greatest(F.col("offset"), start)
    hi = F.least(F.col("offset") + F.col("n_tokens"), start + F.floor(F.col("r.length") / w).cast("long") * w)
    d = d.withColumn("lo", lo).withColumn("hi", hi).filter(F.col("lo") < F.col("hi"))
    c0 = F.floor((F.col("lo") - start) / w).cast("long")
    c1 = F.floor((F.col("hi") - 1 - start) / w).cast("long")
    # Chunks from first to last lie inside the document; of the others it has a part.
    first = F.when(start + c0 * w == F.col("lo"), c0).otherwise(c0 + 1)
    last = F.when(start + (c1 + 1) * w == F.col("hi"), c1).otherwise(c1 - 1)
    inside = d.filter(first <= last).withColumn("chunk_idx", F.explode(F.sequence(first, last)))
    ends = F.filter(F.array_distinct(F.array(c0, c1)), lambda c: (c < first) | (c > last))
    cut = d.withColumn("chunk_idx", F.explode(ends))
    a = F.greatest(F.col("lo"), start + F.col("chunk_idx") * w)
    b = F.least(F.col("hi"), start + (F.col("chunk_idx") + 1) * w)
    piece = F.slice("tokens", (a - F.col("offset") + 1).cast("int"), (b - a).cast("int"))
    keys = [F.col("r.split").alias("split"), "shard_idx", "chunk_idx"]
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]))
    straddling = cut.select(*keys, a.alias("at"), piece.alias("piece")).groupBy("split", "shard_idx", "chunk_idx").agg(joined.alias("window"))
    win = inside.select(*keys, piece.alias("window")).unionByName(straddling)
    keys = ["split", "shard_idx", "chunk_idx"]
    return win.select(*keys, F.slice("window", 1, context_length).alias("input_ids"),
                      F.slice("window", 2, context_length).alias("target_ids"))


def select_split(windows: DataFrame, split: str, num_workers: int = 1) -> DataFrame:
    """C4/P5: one split, with the loader worker of each window."""
    require(split in SPLITS, f"no split is called {split!r}; there are {', '.join(SPLITS)}")
    return worker_stripes(windows.filter(F.col("split") == split), num_workers)


def worker_stripes(windows: DataFrame, num_workers: int) -> DataFrame:
    """All splits with their loader worker ``(…, worker)``. Training windows belong to
    worker ``shard_idx mod num_workers``; validation and test are read whole by every
    worker, so they are kept once (worker 0)."""
    require(num_workers >= 1, "num_workers must be >= 1")
    worker = F.when(F.col("split") == "train", F.pmod(F.col("shard_idx"), F.lit(num_workers))).otherwise(0)
    return windows.withColumn("worker", worker.cast("int"))
