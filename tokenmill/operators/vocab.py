"""Vocabulary tables: distinct characters, initial vocabulary, lookups.

``vocab(token int, text string, kind string)`` with kind in
``base | char | special | merge``. The text -> token direction is a derived
view: when two tokens share a text the later (larger) id wins.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.text import N_BASE, SPACE_MARK, preprocess_text
from ..plans.strategy import collect_checked
from ..validation import TokenmillError, require_columns
from .tokenizer import TEXT_BYTES, lookup_chars, map_slices, text_code_points


def distinct_chars(docs: DataFrame) -> DataFrame:
    """A1: distinct training-time characters ``(ch, n_docs)``.

    The documents that hold a character are counted by arrays in slices of documents, so the
    shuffle carries at most (slices x alphabet) rows, partially aggregated on the map side.
    """
    require_columns(docs, ["text"], "distinct_chars")

    def make():
        place = np.zeros(0x110000, np.int64)

        def count(batch: pa.RecordBatch) -> list[pa.Array]:
            codes, sizes = text_code_points(batch.column(0))
            seen = np.zeros(len(place), bool)
            seen[codes] = True
            symbols = np.flatnonzero(seen)
            place[symbols] = np.arange(len(symbols))
            at = np.repeat(np.arange(len(sizes)) * len(symbols), sizes) + place[codes]
            if len(sizes) * len(symbols) > max(1 << 20, 4 * len(codes)):
                at = np.unique(at) % max(1, len(symbols))
                n = np.bincount(at, minlength=len(symbols))
            else:
                held = np.zeros(len(sizes) * len(symbols), bool)
                held[at] = True
                n = held.reshape(len(sizes), len(symbols)).sum(axis=0, dtype=np.int64)
            return [pa.array([chr(c) for c in symbols], pa.string()), pa.array(n, pa.int64())]
        return count
    schema = StructType([StructField("ch", StringType()), StructField("n", LongType())])
    part = map_slices(docs.select(preprocess_text(F.col("text")).alias("text")), "text", schema, make, TEXT_BYTES)
    return part.groupBy("ch").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_docs"))


def initial_vocab(chars: DataFrame, specials: Sequence[str] = ()) -> DataFrame:
    """U1 + L4: ids 0..255 are chr(0..255); then every other candidate
    (characters of ``chars.ch``, the space marker, the special texts) in
    code-point order, ids dense from 256.

    The ordering window runs over the distinct candidate set, which is
    bounded by the alphabet (plus the specials), not by the corpus.
    """
    require_columns(chars, ["ch"], "initial_vocab")
    spark = chars.sparkSession
    base = spark.range(N_BASE).select(
        F.col("id").cast("int").alias("token"), F.chr(F.col("id")).alias("text"),
        F.lit("base").alias("kind"))
    extra = [SPACE_MARK, *specials]
    fixed = spark.createDataFrame([(t,) for t in extra], "text string")
    candidates = chars.select(F.col("ch").alias("text")).unionByName(fixed).distinct()
    new = candidates.join(base.select("text"), "text", "left_anti")
    spec = F.array(*[F.lit(s) for s in specials]) if specials else F.array().cast("array<string>")
    ranked = new.select(
        (F.lit(N_BASE - 1) + F.row_number().over(Window.orderBy("text"))).cast("int").alias("token"),
        "text",
        F.when(F.array_contains(spec, F.col("text")), "special").otherwise("char").alias("kind"))
    return base.unionByName(ranked)


def text_to_token(vocab: DataFrame) -> DataFrame:
    """Lookup direction ``(text, token)``; collisions keep the largest id."""
    require_columns(vocab, ["token", "text"], "text_to_token")
    return vocab.groupBy("text").agg(F.max("token").alias("token"))


def vocab_collisions(vocab: DataFrame) -> DataFrame:
    """Texts held by more than one token ``(text, n_tokens, tokens)``."""
    return (vocab.groupBy("text")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.sort_array(F.collect_list("token")).alias("tokens"))
            .filter(F.col("n_tokens") > 1))


def vocab_size(vocab: DataFrame) -> DataFrame:
    """``(n_tokens, n_texts)``; the two differ exactly when texts collide."""
    return vocab.agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("text").alias("n_texts"))


def char_tokens(docs: DataFrame, vocab: DataFrame, strict: bool = True) -> DataFrame:
    """Training-time characters of each document as token ids
    ``(…keys, tokens array<int>)``, one row per input row; NULL for a NULL text.

    A character missing from the vocabulary is NULL, and with ``strict`` it
    fails the job. One map-only stage at every vocabulary size.
    """
    require_columns(docs, ["text"], "char_tokens")
    keys = [c for c in docs.columns if c != "text"]
    return lookup_chars(docs.select(*keys, preprocess_text(F.col("text")).alias("__chars")), "__chars", vocab, strict)


def extend_vocab(vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """Add one ``merge`` row per merge, text = text(t1) + text(t2).

    Merges may build on earlier merges, whose ids are smaller. Both tables are
    vocabulary-sized, so the texts are put together on the driver.
    """
    require_columns(merges, ["t1", "t2", "new_token"], "extend_vocab")
    texts = {r["token"]: r["text"] for r in collect_checked(vocab.select("token", "text"), "the vocabulary")}
    added = []
    for r in sorted(collect_checked(merges.select("t1", "t2", "new_token"), "the merge table"), key=lambda r: r["new_token"]):
        if r["t1"] not in texts or r["t2"] not in texts:
            raise TokenmillError("extend_vocab: a merge refers to an unknown token")
        texts[r["new_token"]] = texts[r["t1"]] + texts[r["t2"]]
        added.append((r["new_token"], texts[r["new_token"]], "merge"))
    known = vocab.select("token", "text", "kind")
    return known.unionByName(vocab.sparkSession.createDataFrame(added, "token int, text string, kind string"))
