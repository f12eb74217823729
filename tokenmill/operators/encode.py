"""Encoding documents to token ids (segment -> pieces -> codes).

Documents stay one row with a list of pieces. Each distinct piece of a batch is
looked up whole in the vocabulary (E2), else merged to a fixpoint (E3); the codes of
a document are put together in the same stage. There is one path for every
vocabulary size, no shuffle and nothing cached.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from ..functions.text import EOT, segment_pieces, special_segments
from ..plans.strategy import collect_checked, ship
from ..validation import TokenmillError, require, require_columns
from . import segments
from .pieces import split_segments
from .tokenizer import (NONE, SCAN_TOKENS, TEXT_BYTES, MergeTable, as_lists, encode_lists, list_sizes, lookup_chars, map_slices,
                        merge_table, ranges)
from .vocab import text_to_token

DOC_KEYS = ("shard_idx", "row_idx")
# Positions of a sequence that are scanned in one task.
CHUNK_TOKENS = 1 << 16
OOV_MODES = ("reject", "null", "fail")


def doc_pieces(docs: DataFrame, specials: Sequence[str] = (EOT,),
               special_mode: str = "all") -> DataFrame:
    """T1-T3 per document: ``(keys…, pieces array<struct<piece, special>>)``."""
    require_columns(docs, ["text"], "doc_pieces")
    keys = [c for c in docs.columns if c != "text"]
    segs = special_segments(F.col("text"), list(specials), special_mode)
    return docs.select(*keys, segment_pieces(segs).alias("pieces"))


def piece_occurrences(pieces: DataFrame) -> DataFrame:
    """One row per piece occurrence ``(keys…, piece_idx, piece, special)``; a
    document without pieces keeps one row with a NULL piece."""
    keys = [c for c in pieces.columns if c != "pieces"]
    ex = pieces.select(*keys, F.posexplode_outer("pieces").alias("piece_idx", "p"))
    return ex.select(*keys, "piece_idx", F.col("p.piece").alias("piece"),
                     F.col("p.special").alias("special"))


def distinct_pieces(docs: DataFrame, specials: Sequence[str] = (EOT,), special_mode: str = "all") -> DataFrame:
    """The corpus's distinct standard pieces ``(piece)``; the repeats in a slice of documents are
    dropped before the shuffle."""
    require_columns(docs, ["text"], "distinct_pieces")
    segs = docs.select(special_segments(F.col("text"), list(specials), special_mode).alias("segs"))

    def make():
        def distinct(batch: pa.RecordBatch) -> list[pa.Array]:
            pieces, special, _ = split_segments(batch.column(0))
            return [(pieces.filter(pa.array(~special)) if special.any() else pieces).unique()]
        return distinct
    return map_slices(segs, "segs", StructType([StructField("piece", StringType())]), make, TEXT_BYTES).distinct()


def char_lists(texts: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """``texts`` with the characters of ``column`` as ``tokens array<int>``, NULL for an unknown one."""
    keys = [F.col(f"`{c}`") for c in texts.columns]
    return lookup_chars(texts.select(*keys, F.col(column).alias("__chars")), "__chars", vocab, strict=False)


def _neighbour(rows: DataFrame, keys: list[str], chunk: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (keys…, pos, tok) with ``chunk`` and ``nxt``, the token that follows; and the keys of
    the sequences that have more than one chunk."""
    rows = rows.withColumn("chunk", F.floor(F.col("pos") / chunk).cast("long"))
    long = rows.filter("chunk > 0").select(*keys).distinct()
    edges = rows.join(long, keys, "left_semi").groupBy(*keys, "chunk").agg(
        F.min_by("tok", "pos").alias("first"), F.max_by("tok", "pos").alias("last"))
    edges = segments.neighbour_edges(edges, keys, "chunk").select(*keys, "chunk", "next_first")
    w = Window.partitionBy(*keys, "chunk").orderBy("pos")
    inner = rows.withColumn("nxt", F.lead("tok").over(w)).withColumn("ends", F.lead("pos").over(w).isNull())
    nxt = F.when(F.col("ends"), F.col("next_first")).otherwise(F.col("nxt"))
    return inner.join(edges, [*keys, "chunk"], "left").withColumn("nxt", nxt).drop("next_first", "ends"), long


def _scanned(rows: DataFrame, merges: DataFrame, chunk: int, fields: list[StructField],
             out: Callable[..., list[pa.Array]]) -> DataFrame:
    """Whole sequences ``(…, tokens)`` through one pass; ``out`` makes the columns after the keys."""
    require(chunk >= 1, "chunk must be >= 1")
    keys = [f for f in rows.schema.fields if f.name not in ("tokens", "pos")]
    given = "pos" in rows.columns
    table = merge_table(merges)
    shared = ship(rows.sparkSession, table, 128 * len(table), "the merge table")
    step = chunk * max(1, SCAN_TOKENS // chunk)

    def make():
        merge = MergeTable(shared.value)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            lists = batch.column(batch.num_columns - 1)
            sizes = list_sizes(lists)
            flat = pc.fill_null(lists.flatten().cast(pa.int64()), NONE).to_numpy(zero_copy_only=False)
            at = ranges(np.zeros(len(sizes), np.int64), sizes)
            if given:
                places = batch.column(batch.num_columns - 2)
                mine = np.repeat(places.is_valid().to_numpy(zero_copy_only=False), sizes)
                at[mine] = places.flatten().to_numpy(zero_copy_only=False)
            return out(batch.columns[:len(keys)], flat, sizes, at, lists, merge.scan(flat, sizes, step))
        return run
    named = [F.col(f"`{f.name}`") for f in keys]
    return map_slices(rows.select(*named, *(["pos"] if given else []), "tokens"), "tokens", StructType([*keys, *fields]), make)


def _merge_lists(rows: DataFrame, merges: DataFrame, chunk: int) -> DataFrame:
    def out(keys, flat, sizes, at, lists, scanned):
        found, tokens, kept = scanned
        seq = np.repeat(np.arange(len(sizes)), sizes)
        hit = np.bincount(seq[found != NONE], minlength=len(sizes)) > 0
        left, null = np.bincount(seq[kept], minlength=len(sizes)), lists.is_null() if lists.null_count else None
        return [*keys, pa.array(hit), as_lists(at[kept], left, null), as_lists(tokens[kept], left, null)]
    ints = ArrayType(IntegerType())
    return _scanned(rows, merges, chunk, [StructField("hit", BooleanType()), StructField("pos", ints), StructField("tokens", ints)], out)


def _pairs_of_lists(rows: DataFrame, merges: DataFrame, chunk: int) -> DataFrame:
    def out(keys, flat, sizes, at, lists, scanned):
        i = np.flatnonzero(scanned[0] != NONE)
        seq = pa.array(np.repeat(np.arange(len(sizes)), sizes)[i])
        return [*[k.take(seq) for k in keys], *[pa.array(x.astype(np.int32)) for x in (at[i], flat[i], flat[i + 1], scanned[0][i])]]
    return _scanned(rows, merges, chunk, [StructField(c, IntegerType()) for c in ("pos", "tok", "nxt", "new_token")], out)


def merge_pass(rows: DataFrame, merges: DataFrame, key: str | Sequence[str] = "piece", chunk: int = CHUNK_TOKENS) -> DataFrame:
    """W3 + J4 + W4: one left-to-right pass over every sequence.

    ``rows`` is ``(key, pos, tok)``. A pair (tok, next tok) that is in the
    merge table is merged; overlapping candidates are resolved greedily from
    the left (within a run of consecutive mergeable positions every second
    one is taken, starting with the first). Returns the new rows plus
    ``hit`` (the sequence had at least one mergeable pair this pass).

    Sequences are scanned in chunks of ``chunk`` positions. What reaches a chunk from the
    chunks before it, its first position being taken or not, is composed from their
    summaries (:mod:`.segments`), so a sequence of any length spreads over tasks.

    ``rows`` may also hold each sequence whole: ``(key, …, tokens array<int>)``, with ``pos
    array<int>`` if positions are not 0, 1, 2, …. These are scanned where they are, again
    chunks of positions at a time, and nothing is shuffled: ``(key, …, hit, pos, tokens)``,
    one row a sequence.
    """
    if "tokens" in rows.columns:
        return _merge_lists(rows, merges, chunk)
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys, "chunk").orderBy("pos")
    m = merges.select(F.col("t1").alias("tok"), F.col("t2").alias("nxt"), "new_token")
    step, long = _neighbour(rows.select(*keys, "pos", "tok"), keys, chunk)
    step = step.join(m, ["tok", "nxt"], "left")
    h = F.col("new_token").isNotNull()
    step = step.withColumn("rn", F.row_number().over(w))
    step = step.withColumn("last_miss", F.max(F.when(~h, F.col("rn")).otherwise(F.lit(0)))
                           .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # After a miss a chunk's last run decides; without one, an odd chunk turns the bit over.
    chunks = step.join(long, keys, "left_semi").groupBy(*keys, "chunk").agg(
        F.count("*").alias("n"), F.max("last_miss").alias("miss"), F.max(h).alias("hit"))
    odd = F.pmod(F.col("n") - F.col("miss"), F.lit(2))
    chunks = chunks.withColumn("fixed", F.when(F.col("miss") > 0, odd)).withColumn("flips", odd)
    states = segments.states_before(chunks, keys, "chunk").select(*keys, "chunk", "state")
    step = step.join(states, [*keys, "chunk"], "left").withColumn("state", F.coalesce("state", F.lit(0)))
    open_run = F.when(F.col("last_miss") == 0, F.col("state")).otherwise(0)
    step = step.withColumn("pick", h & (F.pmod(F.col("rn") - F.col("last_miss") - 1 + open_run, F.lit(2)) == 0))
    step = step.withColumn("consumed", F.coalesce(F.lag("pick", 1).over(w), F.col("state") == 1))
    step = step.withColumn("hit", F.max(h).over(Window.partitionBy(*keys, "chunk")))
    hits = chunks.groupBy(*keys).agg(F.max("hit").alias("any_hit"))
    return step.filter(~F.col("consumed")).join(hits, keys, "left").select(
        *keys, "pos", F.when(F.col("pick"), F.col("new_token")).otherwise(F.col("tok")).alias("tok"),
        F.coalesce("any_hit", "hit").alias("hit"))


def mergeable_pairs(rows: DataFrame, merges: DataFrame, key: str = "piece", chunk: int = CHUNK_TOKENS) -> DataFrame:
    """J4 + W3: ``(key, pos, tok, nxt, new_token)`` of the neighbours that the merge table holds.
    ``rows`` may hold whole sequences, as in :func:`merge_pass`."""
    if "tokens" in rows.columns:
        return _pairs_of_lists(rows, merges, chunk)
    m = merges.select(F.col("t1").alias("tok"), F.col("t2").alias("nxt"), "new_token")
    return _neighbour(rows.select(key, "pos", "tok"), [key], chunk)[0].join(m, ["tok", "nxt"]).select(key, "pos", "tok", "nxt", "new_token")


def piece_lookup(pieces: DataFrame, vocab: DataFrame) -> DataFrame:
    """J1 + E2: ``(piece, token)``; NULL for a piece that is not a vocabulary text."""
    return pieces.select("piece").join(text_to_token(vocab).withColumnRenamed("text", "piece"), "piece", "left")


def piece_codes(pieces: DataFrame, vocab: DataFrame, merges: DataFrame | None) -> DataFrame:
    """E2 + E3 dictionary ``(piece, codes array<int>)`` of the distinct pieces.

    A piece whose whole text is a vocabulary entry is one token; the others
    start from per-character ids (NULL for an unknown character) and are
    merged to a fixpoint with the merge table.
    """
    require_columns(pieces, ["piece"], "piece_codes")
    distinct = pieces.select("piece").filter(F.col("piece").isNotNull()).distinct()
    return encode_lists(distinct.select("piece", F.array("piece").alias("one")), "one", vocab, merges) \
        .withColumnRenamed("tokens", "codes")


def encode_docs(docs: DataFrame, vocab: DataFrame, merges: DataFrame | None = None,
                specials: Sequence[str] = (EOT,), special_mode: str = "all") -> DataFrame:
    """``(keys…, tokens array<int>)``, one row per row of ``docs``.

    NULL tokens stand for unknown characters or unknown specials; a NULL text has
    NULL tokens and an empty one no tokens; rows with equal keys stay apart.
    """
    require_columns(docs, ["text"], "encode_docs")
    keys = [c for c in docs.columns if c != "text"]
    segs = docs.select(*keys, special_segments(F.col("text"), list(specials), special_mode).alias("__segments"))
    return encode_lists(segs, "__segments", vocab, merges)


def encode_from_dictionary(docs: DataFrame, dictionary: DataFrame, vocab: DataFrame, specials: Sequence[str] = (EOT,),
                           special_mode: str = "all") -> DataFrame:
    """E1 by a piece dictionary ``(piece, codes)`` that holds every piece of ``docs``: as
    :func:`encode_docs`, for documents with distinct keys. Pieces are exploded, joined, and put
    together by position; the dictionary has a row a piece, so a frequent piece is a skewed
    side of the join that can be split."""
    keys = [c for c in docs.columns if c != "text"]
    rows = piece_occurrences(doc_pieces(docs, specials, special_mode))
    texts = text_to_token(vocab).filter(F.col("text").isin(list(specials))).select(
        F.col("text").alias("piece"), F.array("token").alias("codes"), F.lit(True).alias("special"))
    table = dictionary.select("piece", "codes", F.lit(False).alias("special")).unionByName(texts)
    found = rows.join(table, ["piece", "special"], "left")
    unknown = F.when(F.col("piece").isNotNull(), F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>"))
    parts = F.sort_array(F.collect_list(F.struct("piece_idx", F.coalesce("codes", unknown).alias("codes"))))
    return found.groupBy(*keys).agg(F.flatten(F.transform(parts, lambda p: p["codes"])).alias("tokens"))


def held_vocab(vocab: DataFrame) -> DataFrame:
    """The vocabulary as a table of its own rows: what it is derived from (a corpus scan, often) is
    run once, not for every lookup. Bounded by the size of a vocabulary, which the driver holds anyway."""
    return vocab.sparkSession.createDataFrame(collect_checked(vocab, "the vocabulary"), vocab.schema)


def eot_token(vocab: DataFrame, eot_text: str = EOT) -> int:
    """Id of the end-of-text special (a vocabulary without it is an error)."""
    row = text_to_token(vocab).filter(F.col("text") == eot_text).select("token").first()
    if row is None:
        raise TokenmillError(f"end-of-text text {eot_text!r} is not in the vocabulary")
    return int(row["token"])


def _unknown() -> Column:
    # The search for a value is compiled, and says false only of an array without NULL; it goes over most documents.
    return F.when(~F.array_contains("tokens", F.lit(-(1 << 31))), F.lit(False)).otherwise(F.exists("tokens", lambda t: t.isNull()))


def apply_oov(tokens: DataFrame, on_oov: str) -> DataFrame:
    """Q5 policy for documents containing an unknown-character token (NULL):
    ``reject`` drops them (:func:`oov_rejects` has them), ``null`` keeps them,
    ``fail`` fails the job."""
    require(on_oov in OOV_MODES, f"on_oov must be one of {OOV_MODES}")
    if on_oov == "null":
        return tokens
    if on_oov == "fail":
        checked = F.when(_unknown(), F.raise_error(F.lit("a document contains a character missing from the vocabulary"))) \
            .otherwise(F.col("tokens"))
        return tokens.withColumn("tokens", checked)
    return tokens.filter(~_unknown())


def oov_rejects(tokens: DataFrame) -> DataFrame:
    """Rejects table ``(keys…, reason)`` for documents with unknown tokens."""
    keys = [c for c in tokens.columns if c not in ("tokens", "n_tokens")]
    return tokens.filter(_unknown()).select(*keys, F.lit("unknown character").alias("reason"))


def shard_tokens(docs: DataFrame, vocab: DataFrame, merges: DataFrame | None = None,
                 specials: Sequence[str] = (EOT,), special_mode: str = "all",
                 on_oov: str = "reject", eot_text: str = EOT, dictionary: DataFrame | None = None) -> DataFrame:
    """E5: every non-empty document encoded and followed by the end-of-text
    token: ``(shard_idx, row_idx, n_tokens, tokens)``. With ``on_oov='null'`` the
    result also feeds :func:`oov_rejects`. ``dictionary``: as in :func:`encode_from_dictionary`."""
    require_columns(docs, [*DOC_KEYS, "text"], "shard_tokens")
    vocab = held_vocab(vocab)
    eot = eot_token(vocab, eot_text)
    nonempty = docs.filter(F.col("text").isNotNull() & (F.col("text") != "")).select(*DOC_KEYS, "text")
    enc = encode_docs(nonempty, vocab, merges, specials, special_mode) if dictionary is None else encode_from_dictionary(
        nonempty, dictionary, vocab, specials, special_mode)
    enc = apply_oov(enc.select(*DOC_KEYS, "tokens"), on_oov)
    return enc.select(*DOC_KEYS, (F.size("tokens") + 1).alias("n_tokens"), F.concat("tokens", F.array(F.lit(eot))).alias("tokens"))
