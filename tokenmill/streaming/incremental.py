"""Process only new shards, restartably, as a file stream.

New shard files landing in the raw directory are picked up by the parquet
file source; each micro-batch is tokenised and published as one run of the token cache,
under a key made of the checkpoint and the batch's number. The checkpoint records which
files were processed, so a restart does nothing until new files arrive; a batch
that is repeated after a crash publishes once. With a dictionary folder the pieces of each batch are
first added to the piece dictionary there, and the batch is encoded from it.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import EOT
from ..plans.corpus import tokenize_into
from ..sources.dictionary import extend_dictionary, read_dictionary
from ..sources.shards import SHARD_NAME_PATTERN, TEXT_COLUMN

RAW_SCHEMA = StructType([StructField(TEXT_COLUMN, StringType())])
# New shard files that one micro-batch takes at most; the rest follow in the next.
FILES_PER_BATCH = 1000


def shard_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """Streaming document table ``(shard_idx, row_idx, text, file)``; ``shard_idx`` is NULL for a
    file whose name holds no number."""
    raw = (spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(raw_dir))
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_name"), SHARD_NAME_PATTERN, 1).try_cast("int").alias("shard_idx"),
        F.col("_metadata.row_index").cast("long").alias("row_idx"),
        F.col(TEXT_COLUMN).alias("text"), F.col("_metadata.file_name").alias("file"))


def tokenize_batch(df: DataFrame, key: str, vocab: DataFrame, merges: DataFrame | None, token_dir: str,
                   specials: Sequence[str] = (EOT,), on_oov: str = "reject", dictionary_dir: str | None = None) -> None:
    """One micro-batch ``(shard_idx, row_idx, text, file)`` into the cache, once for ``key``. A file
    without a shard number gives one reject, with its name."""
    if df.isEmpty():
        return
    docs = df.filter("shard_idx IS NOT NULL").select("shard_idx", "row_idx", "text")
    nameless = df.filter("shard_idx IS NULL").select("file").distinct().select(
        F.lit(None).cast("int").alias("shard_idx"), F.lit(None).cast("long").alias("row_idx"),
        F.concat(F.lit("no shard number in the file name "), "file").alias("reason"))
    dictionary = None
    if dictionary_dir:
        extend_dictionary(docs, vocab, merges, dictionary_dir, key, specials)
        dictionary = read_dictionary(df.sparkSession, dictionary_dir)
    tokenize_into(docs, vocab, merges, token_dir, specials, on_oov, key, nameless, dictionary)


def tokenize_new_shards(spark: SparkSession, raw_dir: str, vocab: DataFrame, merges: DataFrame | None,
                        token_dir: str, checkpoint: str, specials: Sequence[str] = (EOT,),
                        on_oov: str = "reject", dictionary_dir: str | None = None) -> StreamingQuery:
    """Start an available-now stream that tokenises every raw shard file not
    yet seen by ``checkpoint`` into ``token_dir``; returns the query (call
    ``awaitTermination()``)."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        tokenize_batch(df, f"{checkpoint}#{epoch_id}", vocab, merges, token_dir, specials, on_oov, dictionary_dir)

    return (shard_stream(spark, raw_dir).writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
