"""The piece dictionary kept between runs: piece -> codes of one tokenizer.

A folder of published runs (:mod:`.manifest`), each with the pieces that were new to it. A
batch adds the pieces that no earlier run has; so does the same batch when it is repeated,
that is, nothing if it was published, everything if it was not. Of two jobs that extend
the dictionary at once, the slower one looks again at what the other has added.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import EOT
from ..operators import encode
from .manifest import Manifest, new_run

SCHEMA = "piece string, codes array<int>"


def read_dictionary(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(piece, codes)`` of all runs, or of those up to a version; a piece is there once."""
    manifest = Manifest(spark, path)
    return manifest.read("pieces", SCHEMA, manifest.latest()[1][:version]).select("piece", "codes")


def extend_dictionary(docs: DataFrame, vocab: DataFrame, merges: DataFrame | None, path: str, key: str,
                      specials: Sequence[str] = (EOT,), special_mode: str = "all") -> int:
    """Add the pieces of ``docs`` that the dictionary lacks, encoded with the tokenizer.

    ``key`` names the batch: one that was published before adds nothing. Returns the number
    of pieces added. A dictionary belongs to one tokenizer.
    """
    spark = docs.sparkSession
    manifest = Manifest(spark, path)
    while True:
        version, entries = manifest.latest()
        if any(e["key"] == key for e in entries):
            return 0
        known = read_dictionary(spark, path, version).select("piece")
        fresh = encode.distinct_pieces(docs, specials, special_mode).join(known, "piece", "left_anti")
        run = new_run()
        at = manifest.run_path("pieces", run)
        encode.piece_codes(fresh, vocab, merges).select("piece", F.col("codes").cast("array<int>").alias("codes")).write.parquet(at)
        if manifest.publish(lambda now, _: {"run": run, "key": key, "shards": [], "all": True} if now == version else None):
            return spark.read.schema(SCHEMA).parquet(at).count()
