"""Token-shard cache and tokenizer tables on disk.

A token cache is a folder of published runs (:mod:`.manifest`). A run has the tables
``tokens`` (the accepted documents with their token ``offset`` in their shard, partitioned
by ``shard_idx`` and by ``bucket``, a range of rows), ``rejects`` (the others, with a
reason), ``zones`` (one row a bucket: the offsets that it spans) and ``done`` (one row a
shard: its totals). A shard whose documents were all empty or rejected is done too, and
not tokenised again. A shard counts in the run that was published first.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packing import SPLITS, cut_windows, running_offsets, split_array
from ..session import child_names, path_exists, touch
from ..validation import TokenmillError, require, require_columns
from .manifest import Manifest, new_run

# Rows of a bucket: a huge shard is written by several tasks instead of one.
ROWS_PER_FILE = 200_000

TOKENS_SCHEMA = "row_idx long, n_tokens int, offset long, tokens array<int>, shard_idx int, bucket long"
REJECTS_SCHEMA = "shard_idx int, row_idx long, reason string"
ZONES_SCHEMA = "shard_idx int, bucket long, first_offset long, n_tokens long, n_docs long"
DONE_SCHEMA = "shard_idx int, n_tokens long, n_docs long, n_rejected long"
FINISHED = "FINISHED"


def write_run(tokens: DataFrame, rejects: DataFrame, stats: DataFrame, path: str, key: str | None = None,
              rows_per_file: int = ROWS_PER_FILE) -> bool:
    """Write and publish the tokens ``(shard_idx, row_idx, n_tokens, tokens)``, rejects
    ``(shard_idx, row_idx, reason)`` and totals ``(shard_idx, n_tokens, n_docs, n_rejected)`` of
    some shards. Shards that another run has published keep that run's data. A ``key`` is
    published once; writing it again changes nothing (False)."""
    require_columns(tokens, ["shard_idx", "row_idx", "n_tokens", "tokens"], "write_run")
    require_columns(rejects, ["shard_idx", "row_idx", "reason"], "write_run")
    spark = tokens.sparkSession
    manifest, run = Manifest(spark, path), new_run()
    if key is not None and any(e["key"] == key for e in manifest.latest()[1]):
        return False
    at = lambda table: manifest.run_path(table, run)
    # A bucket's rows are together and in order after the running sum, and are written so.
    placed = running_offsets(tokens.select("shard_idx", "row_idx", "n_tokens", "tokens"), "shard_idx", "row_idx", "n_tokens",
                             bucket_rows=rows_per_file)
    placed = placed.withColumn("bucket", F.floor(F.col("row_idx") / rows_per_file).cast("long"))
    placed.select("row_idx", "n_tokens", "offset", "tokens", "shard_idx", "bucket").write.partitionBy("shard_idx", "bucket").parquet(at("tokens"))
    rejects.select("shard_idx", "row_idx", "reason").write.parquet(at("rejects"))
    stats.select("shard_idx", "n_tokens", "n_docs", "n_rejected").write.parquet(at("done"))
    spans = spark.read.schema(TOKENS_SCHEMA).parquet(at("tokens")).groupBy("shard_idx", "bucket").agg(
        F.min("offset").alias("first_offset"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    spans.coalesce(1).write.parquet(at("zones"))
    mine = sorted(r["shard_idx"] for r in spark.read.schema(DONE_SCHEMA).parquet(at("done")).select("shard_idx").collect())

    def decide(_: int, entries: list[dict]) -> dict | None:
        if key is not None and any(e["key"] == key for e in entries):
            return None
        taken = {s for e in entries for s in e["shards"]}
        return {"run": run, "key": key, "shards": [s for s in mine if s not in taken], "all": taken.isdisjoint(mine)}
    return manifest.publish(decide)


def _read(spark: SparkSession, path: str, table: str, schema: str, shards: list[int] | None = None) -> DataFrame:
    """A table of all published runs; of the given shards only, if any are given."""
    manifest = Manifest(spark, path)
    entries = manifest.latest()[1]
    df = manifest.read(table, schema, entries)
    for e in entries:
        if not e["all"]:  # the run wrote shards that another one had published
            df = df.filter((F.col("run") != e["run"]) | F.col("shard_idx").isin(e["shards"]))
    return (df if shards is None else df.filter(F.col("shard_idx").isin(list(shards)))).drop("run")


def read_token_shards(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """The token table; a shard list becomes a partition filter (only
    those directories are read)."""
    return _read(spark, path, "tokens", TOKENS_SCHEMA, shards).select("shard_idx", "row_idx", "n_tokens", "tokens")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "rejects", REJECTS_SCHEMA)


def finished_shards(spark: SparkSession, path: str) -> DataFrame:
    """Totals of the finished shards ``(shard_idx, n_tokens, n_docs, n_rejected)``."""
    return _read(spark, path, "done", DONE_SCHEMA)


def token_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone index ``(shard_idx, bucket, first_offset, n_tokens, n_docs)``."""
    return _read(spark, path, "zones", ZONES_SCHEMA)


def read_split(spark: SparkSession, path: str, split: str, n_val: int, n_test: int) -> DataFrame:
    """S5 + P4: the documents that hold tokens of one split, with the range of the split in
    their shard: ``(shard_idx, bucket, row_idx, n_tokens, tokens, offset, r)``.

    Validation and test are ranges of shard 0: the zone index gives the buckets that
    overlap, which become partition filters, and the offsets filter inside their files.
    Of shard 0, training skips the buckets before its range in the same way.
    """
    require(split in SPLITS, f"no split is called {split!r}; there are {', '.join(SPLITS)}")
    totals = finished_shards(spark, path).filter("n_tokens > 0").select(F.col("shard_idx").alias("r_shard"), F.col("n_tokens").alias("total"))
    ranges = totals.select("r_shard", F.explode(split_array(F.col("r_shard"), F.col("total"), n_val, n_test)).alias("r")).filter(F.col("r.split") == split)
    head = ranges.filter("r_shard = 0").select("r.start", "r.length").first()
    rows = _read(spark, path, "tokens", TOKENS_SCHEMA, None if split == "train" else [0])
    if head is not None:
        lo, hi = head["start"], head["start"] + head["length"]
        overlap = token_zones(spark, path).filter((F.col("shard_idx") == 0) & (F.col("first_offset") < hi) & (F.col("first_offset") + F.col("n_tokens") > lo))
        first, last = overlap.agg(F.min("bucket"), F.max("bucket")).first()
        inside = F.col("bucket").between(first, last) & (F.col("offset") < hi) & (F.col("offset") + F.col("n_tokens") > lo) \
            if first is not None else F.lit(False)
        rows = rows.filter(inside if split != "train" else (F.col("shard_idx") != 0) | inside)
    return rows.join(ranges, F.col("shard_idx") == F.col("r_shard")).select("shard_idx", "bucket", "row_idx", "n_tokens", "tokens", "offset", "r")


def read_split_windows(spark: SparkSession, path: str, split: str, context_length: int, n_val: int, n_test: int) -> DataFrame:
    """The windows of one split, read from the files that hold it: ``(split, shard_idx,
    chunk_idx, input_ids, target_ids)``."""
    return cut_windows(read_split(spark, path, split, n_val, n_test), context_length)


def write_tokenizer(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """A tokenizer is two small tables, ``vocab`` and ``merges``, in a new version
    folder; readers see the version only once both are complete."""
    spark = vocab.sparkSession
    taken = [int(n[1:]) for n in child_names(spark, path) if n[:1] == "v" and n[1:].isdigit()]
    version = f"{path}/v{max(taken, default=0) + 1:06d}"
    vocab.select("token", "text", "kind").write.parquet(f"{version}/vocab")
    merges.select("rank", "t1", "t2", "new_token").write.parquet(f"{version}/merges")
    touch(spark, f"{version}/{FINISHED}")


def read_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The latest finished version."""
    for name in reversed(child_names(spark, path)):
        if path_exists(spark, f"{path}/{name}/{FINISHED}"):
            return spark.read.parquet(f"{path}/{name}/vocab"), spark.read.parquet(f"{path}/{name}/merges")
    raise TokenmillError(f"no finished tokenizer in {path}")


def write_windows(windows: DataFrame, path: str, num_workers: int) -> None:
    """C4 export: every split's windows with their loader worker, partitioned
    by ``(split, worker)`` so that each data-loader worker reads one
    directory. Validation and test windows are kept once (worker 0)."""
    from ..operators.packing import worker_stripes
    striped = worker_stripes(windows, num_workers)
    (striped.repartition("split", "worker", "shard_idx")
     .write.mode("overwrite").partitionBy("split", "worker").parquet(path))
