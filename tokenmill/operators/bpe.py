"""Byte-pair-encoding training as a loop of Spark jobs.

The training text is held as *blocks* ``(bkey, s, w)``: ``s`` is a string
whose code points are token symbols (a character token is the character
itself; a merged token gets a fresh private-use code point). With this
representation

* pair counting (A2) is numpy over the code points of a slice of blocks, then an
  aggregate of the slices' counts,
* picking the most frequent pair (A3) is a distributed top-k
  (count desc, first occurrence asc),
* greedy left-to-right replacement of a pair (B2) is ``replace`` of a two-symbol
  string, which scans left to right without overlap.

Two scopes:

``sequence`` -- the reference semantics: the training text is one sequence
(documents joined by a line break), cut into fixed-size blocks; pairs that
straddle a block boundary are counted and merged through a per-block
summary (first/last symbol, trailing run) scanned in block order.

``piece`` -- the scale mode: blocks are the distinct encode-time pieces with
their frequency as weight; no pair crosses a piece, and merges are trained
only where they can fire at encode time.

Several merges are applied per round, exactly: the ranked pairs are taken while
no pair starts with a token that another one ends with (a self-pair ``(a, a)`` only
alone). Occurrences of such pairs never overlap, so one merge does not change the
count of another; a pair that a merge creates, ``(x, N)`` or ``(N, y)``, comes from
an occurrence of ``(x, a)`` or ``(b, y)``, which chains with the merge and therefore
ranks after the prefix. This gives the same merges, ids and order as one-at-a-time
training.

In the sequence scope the text is first cut into *segments* between two symbols whose pair is
rarer than a floor. Merges only ever join what stands side by side in the text, and each
occurrence of a pair has a place in the text of its own where its halves meet; so a pair that reaches
over a cut occurs less often than the floor, at any time of the training. As long as the most frequent pair
reaches the floor, the distinct segments, with their numbers and first places, give the merges of the whole
sequence, ties included, and they are trained on as pieces are. When no pair reaches the floor, a lower one
follows. Once a floor would leave hardly a cut, rounds go over all blocks: the
state is written after each, and the table before goes.

The piece scope works on an index from pairs to the pieces that hold them
(:mod:`.pair_index`): a round reads and writes the pieces that its merges change.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import EOT, SPACE_MARK, special_segments
from ..session import Written
from ..validation import require, require_columns
from . import segments
from .packing import running_offsets
from .pair_index import PAIR_BYTES, Work, choose_round, count_pairs, cutter, replace_pairs, train
from .pieces import split_texts
from .tokenizer import TEXT_BYTES, list_sizes, map_slices, text_code_points
from .vocab import initial_vocab

SCOPES = ("sequence", "piece")
# Code points of merged tokens while training: planes 4 to 16, which hold no assigned
# characters but private ones. A vocabulary must fit; this is checked before the start.
_SYMBOL_BASE, _SYMBOL_LIMIT = 0x40000, 0x10FFFD
# Pairs of symbols of a slice that are counted in a dense table.
DENSE_PAIRS = 1 << 22
# Documents whose lengths are summed together, with their texts.
TEXT_BUCKET_ROWS = 1 << 12


def _jq(s: str) -> str:
    """Java-regex literal quote."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# --- building the blocks -------------------------------------------------------

def sequence_blocks(sample: DataFrame, block_chars: int = 4096) -> DataFrame:
    """Training text of the ``sequence`` scope as fixed-size blocks.

    ``sample`` is ``(row_idx, text)`` (e.g. :func:`training_sample`); the
    text is the rows joined by ``\\n`` in ``row_idx`` order, preprocessed
    (a space at position 0 dropped, other spaces marked). Returns
    ``(bkey long, s string, w long)``.
    """
    require_columns(sample, ["row_idx", "text"], "sequence_blocks")
    require(block_chars >= 2, "block_chars must be >= 2")
    rows = sample.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    ends = rows.agg(F.min("row_idx").alias("lo"), F.max("row_idx").alias("hi")).first()
    t = F.when(F.col("row_idx") == F.lit(ends["lo"]), F.regexp_replace("text", "^ ", "")) \
        .otherwise(F.col("text"))
    t = F.replace(t, F.lit(" "), F.lit(SPACE_MARK))
    t = F.when(F.col("row_idx") == F.lit(ends["hi"]), t).otherwise(F.concat(t, F.lit("\n")))
    parts = rows.select("row_idx", t.alias("t")).withColumn("n", F.length("t").cast("long")) \
        .filter(F.col("n") > 0).withColumn("p", F.lit(0))
    offs = running_offsets(parts, "p", "row_idx", "n", bucket_rows=TEXT_BUCKET_ROWS)
    b0 = F.floor(F.col("offset") / block_chars).cast("long")
    b1 = F.floor((F.col("offset") + F.col("n") - 1) / block_chars).cast("long")
    sl = offs.withColumn("bkey", F.explode(F.sequence(b0, b1)))
    sl = sl.withColumn("a", F.greatest(F.col("offset"), F.col("bkey") * block_chars)) \
        .withColumn("b", F.least(F.col("offset") + F.col("n"), (F.col("bkey") + 1) * block_chars))
    sl = sl.select("bkey", "a", F.expr("substring(t, int(a - offset + 1), int(b - a))").alias("piece"))
    return sl.groupBy("bkey").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("a", "piece"))), lambda x: x["piece"]), "").alias("s")) \
        .withColumn("w", F.lit(1).cast("long"))


def piece_blocks(docs: DataFrame, specials: Sequence[str] = (EOT,)) -> DataFrame:
    """Blocks of the ``piece`` scope: distinct standard pieces with their
    frequency; ``bkey`` is the piece's first occurrence
    ``(shard_idx, row_idx, piece_idx)`` (an ordering key, no global rank)."""
    require_columns(docs, ["shard_idx", "row_idx", "text"], "piece_blocks")
    segs = docs.select("shard_idx", "row_idx", F.posexplode(
        special_segments(F.col("text"), list(specials))).alias("seg_idx", "seg"))
    std = segs.filter(~F.col("seg.special")).select("shard_idx", "row_idx", "seg_idx", F.col("seg.text").alias("text"))
    keys = [f for f in std.schema.fields if f.name != "text"]
    bkey = StructField("bkey", StructType([*keys, StructField("piece_idx", IntegerType())]))

    def make():
        def count(batch: pa.RecordBatch) -> list[pa.Array]:
            batch = in_order(batch, len(keys))
            pieces, sizes = split_texts(batch.column(len(keys)))
            encoded = pieces.dictionary_encode()
            codes = encoded.indices.to_numpy(zero_copy_only=False)
            # Codes are given in the order of first occurrences.
            first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
            ends = np.cumsum(sizes)
            row = np.searchsorted(ends, first, "right")
            idx = first - np.concatenate([[0], ends])[row]
            at = pa.StructArray.from_arrays([*[k.take(pa.array(row)) for k in batch.columns[:-1]], pa.array(idx, pa.int32())],
                                            names=[f.name for f in bkey.dataType.fields])
            return [encoded.dictionary, at, pa.array(np.bincount(codes, minlength=len(first)), pa.int64())]
        return count
    part = map_slices(std, "text", StructType([StructField("s", StringType()), bkey, StructField("w", LongType())]), make, TEXT_BYTES)
    return part.groupBy("s").agg(F.min("bkey").alias("bkey"), F.sum("w").alias("w"))


def in_order(batch: pa.RecordBatch, n_keys: int) -> pa.RecordBatch:
    """The rows in the order of the first ``n_keys`` columns, which may be structs; NULL first."""
    keys = pa.Table.from_batches([batch.select(list(range(n_keys)))])
    while any(pa.types.is_struct(t) for t in keys.schema.types):
        keys = keys.flatten()
    names = [str(i) for i in range(keys.num_columns)]
    order = pc.sort_indices(keys.rename_columns(names), sort_keys=[(n, "ascending") for n in names], null_placement="at_start")
    return batch.take(order)


def corpus_pair_counts(docs: DataFrame, specials: Sequence[str] = (EOT,)) -> DataFrame:
    """A2 over every standard piece of ``docs``: what ``pair_counts(piece_blocks(docs), False)`` gives.

    The pieces of a slice of documents are counted where they are split, and the pairs inside them
    by these counts. Sums and first places of the slices add up to those of the corpus, so only
    a row a pair and slice is shuffled, no piece.
    """
    require_columns(docs, ["shard_idx", "row_idx", "text"], "corpus_pair_counts")
    segs = docs.select("shard_idx", "row_idx", special_segments(F.col("text"), list(specials)).alias("segs"))
    keys = [f for f in segs.schema.fields if f.name != "segs"]
    places = [*keys, StructField("seg_idx", IntegerType()), StructField("piece_idx", IntegerType())]

    def make():
        pairs_of = slice_pairs()

        def count(batch: pa.RecordBatch) -> list[pa.Array]:
            parts = []
            for rows in once_each(in_order(batch, len(keys)), len(keys)):
                flat, lists = rows.column(len(keys)).flatten(), list_sizes(rows.column(len(keys)))
                special = flat.field("special").to_numpy(zero_copy_only=False).astype(bool)
                pieces, sizes = split_texts(flat.field("text"), special)
                std = np.flatnonzero(~np.repeat(special, sizes))
                encoded = pieces.take(pa.array(std)).dictionary_encode() if special.any() else pieces.dictionary_encode()
                codes = encoded.indices.to_numpy(zero_copy_only=False)
                names, n, block, idx = pairs_of(encoded.dictionary, np.bincount(codes, minlength=len(encoded.dictionary)))
                # Codes are given in the order of first occurrences.
                piece = std[np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))[block]]
                ends, segments_end = np.cumsum(sizes), np.cumsum(lists)
                seg = np.searchsorted(ends, piece, "right")
                doc = np.searchsorted(segments_end, seg, "right")
                at = [seg - (segments_end - lists)[doc], piece - (ends - sizes)[seg]]
                bkey = pa.StructArray.from_arrays([*[k.take(pa.array(doc)) for k in rows.columns[:-1]], *[pa.array(a, pa.int32()) for a in at]],
                                                  names=[f.name for f in places])
                parts.append([names, pa.array(n, pa.int64()), bkey, idx])
            return [pa.concat_arrays(x) for x in zip(*parts)]
        return count
    schema = StructType([StructField("pair", StringType()), StructField("w", LongType()), StructField("bkey", StructType(places)),
                         StructField("idx", IntegerType())])
    return map_slices(segs, "segs", schema, make, TEXT_BYTES).groupBy("pair").agg(F.sum("w").alias("n"), F.min(F.struct("bkey", "idx")).alias("first"))


def once_each(batch: pa.RecordBatch, n_keys: int) -> Iterator[pa.RecordBatch]:
    """A batch in the order of its first ``n_keys`` columns, as batches in which no key comes twice."""
    same = np.ones(max(0, batch.num_rows - 1), bool)
    for k in batch.columns[:n_keys]:
        a, b = k.slice(0, len(same)), k.slice(1)
        equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null()))
        same &= equal.to_numpy(zero_copy_only=False)
    if not same.any():
        yield batch
        return
    at = np.arange(batch.num_rows)
    nth = at - np.maximum.accumulate(np.where(np.concatenate([[False], same]), 0, at))
    for i in range(int(nth.max()) + 1):
        yield batch.take(pa.array(np.flatnonzero(nth == i)))


# --- one round -------------------------------------------------------------------

def slice_pairs() -> Callable[[pa.Array, np.ndarray], tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]]:
    """A function of texts and their weights: the pairs of neighbours, their weighted counts, and the text and
    the index in it of each pair's first occurrence."""
    dense = np.zeros(0x110000, np.int64)

    def count(texts: pa.Array, weights: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
        codes, sizes = text_code_points(texts)
        seen = np.zeros(len(dense), bool)
        seen[codes] = True
        symbols = np.flatnonzero(seen)
        dense[symbols] = np.arange(len(symbols))
        pairs, n, at = count_pairs(dense[codes], len(symbols), sizes, weights)
        ends = np.cumsum(sizes)
        row = np.searchsorted(ends, at, "right")
        names = [chr(symbols[a]) + chr(symbols[b]) for a, b in zip(*np.divmod(pairs, max(1, len(symbols))))]
        return pa.array(names, pa.string()), n, row, pa.array(at - (ends - sizes)[row], pa.int32())
    return count


def _partial_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, w, bkey, idx)``: of each slice of blocks, counts of the pairs of neighbours inside a
    block and their first occurrences there."""
    blocks = blocks.filter(F.length("s") >= 2).select("bkey", F.col("w").cast("long").alias("w"), "s")
    bkey = blocks.schema["bkey"]

    def make():
        pairs_of = slice_pairs()

        def count(batch: pa.RecordBatch) -> list[pa.Array]:
            batch = in_order(batch, 1)
            names, n, row, idx = pairs_of(batch.column(2), batch.column(1).to_numpy(zero_copy_only=False))
            return [names, pa.array(n), batch.column(0).take(pa.array(row)), idx]
        return count
    schema = StructType([StructField("pair", StringType()), StructField("w", LongType()), bkey, StructField("idx", IntegerType())])
    return map_slices(blocks, "s", schema, make, PAIR_BYTES)


def pair_counts(blocks: DataFrame, boundaries: bool) -> DataFrame:
    """A2: ``(pair, n, first)`` -- ``pair`` is the two symbols, ``n`` the
    weighted count (overlapping occurrences counted), ``first`` the first
    occurrence ``(bkey, idx)``. Occurrences are counted by arrays in slices of blocks, so that
    the aggregation gets a row a pair and slice."""
    inner = _partial_counts(blocks)
    if boundaries:
        summ = _summary(blocks)
        edge = summ.filter(F.col("next_first").isNotNull()).select(
            F.concat("last", "next_first").alias("pair"), F.lit(1).cast("long").alias("w"), "bkey", (F.col("len") - 1).alias("idx"))
        inner = inner.unionByName(edge)
    return inner.groupBy("pair").agg(F.sum("w").alias("n"),
                                     F.min(F.struct("bkey", "idx")).alias("first"))


def neighbour_counts(blocks: DataFrame) -> tuple[Written, int | None]:
    """``(pair, n)`` of :func:`pair_counts` over the blocks (none empty) of one sequence, without the first places; and
    the length of a block, if all but the last one have the same and none is missing."""
    def make():
        dense = np.zeros(0x110000, np.int32)

        def count(batch: pa.RecordBatch) -> list[pa.Array]:
            codes, sizes = text_code_points(batch.column(1))
            seen = np.zeros(len(dense), bool)
            seen[codes] = True
            symbols = np.flatnonzero(seen)
            k = len(symbols)
            dense[symbols] = np.arange(k)
            d = dense[codes] if k * k < 1 << 31 else dense[codes].astype(np.int64)
            pair, ends = d[:-1] * k + d[1:], np.cumsum(sizes)
            over = pair[ends[:-1] - 1]  # of two blocks
            if k * k <= DENSE_PAIRS:
                n = np.bincount(pair, minlength=k * k) - np.bincount(over, minlength=k * k)
                found = np.flatnonzero(n)
                n = n[found]
            else:
                found, n = np.unique(pair, return_counts=True)
                np.subtract.at(n, np.searchsorted(found, over), 1)
                found, n = found[n > 0], n[n > 0]
            names = [chr(symbols[a]) + chr(symbols[b]) for a, b in zip(*np.divmod(found, max(1, k)))]
            edges = [chr(a) + chr(b) for a, b in zip(codes[ends - sizes], codes[ends - 1])]
            return [pa.array(names + edges, pa.string()), pa.array(np.append(n, sizes), pa.int64()),
                    pa.concat_arrays([pa.nulls(len(names), pa.int64()), batch.column(0)])]
        return count
    # With a bkey: the first and the last symbol of a block, and its length.
    schema = StructType([StructField("pair", StringType()), StructField("n", LongType()), StructField("bkey", LongType())])
    found = Written(map_slices(blocks.select(F.col("bkey").cast("long").alias("bkey"), "s"), "s", schema, make, PAIR_BYTES), "bpe-neighbours")
    ends = found.df.filter(F.col("bkey").isNotNull()).select("bkey", F.substring("pair", 1, 1).alias("first"), F.substring("pair", 2, 1).alias("last"))
    edge = segments.neighbour_edges(ends, [], "bkey").filter(F.col("next_first").isNotNull()).select(
        F.concat("last", "next_first").alias("pair"), F.lit(1).cast("long").alias("n"))
    inner = found.df.filter(F.col("bkey").isNull()).select("pair", "n")
    counts = Written(inner.unionByName(edge).groupBy("pair").agg(F.sum("n").alias("n")), "bpe-counts")
    lengths = found.df.filter(F.col("bkey").isNotNull()).agg(
        F.max("n").alias("n"), F.count("*").alias("rows"), F.min("bkey").alias("lo"), F.max("bkey").alias("hi"),
        F.min(F.struct("n", (-F.col("bkey")).alias("at"))).alias("least"), F.sum("n").alias("total")).first()
    found.drop()
    even = lengths["rows"] and lengths["hi"] - lengths["lo"] + 1 == lengths["rows"] and (
        lengths["least"]["n"] == lengths["n"] or (-lengths["least"]["at"] == lengths["hi"]
                                                  and lengths["total"] == lengths["n"] * (lengths["rows"] - 1) + lengths["least"]["n"]))
    return counts, lengths["n"] if even else None


def _summary(blocks: DataFrame) -> DataFrame:
    """One row per block with its neighbours' edge symbols (block order)."""
    s = blocks.select("bkey", F.length("s").alias("len"), F.substring("s", 1, 1).alias("first"), F.substring(F.reverse("s"), 1, 1).alias("last"))
    return segments.neighbour_edges(s, [], "bkey")


def _trailing(symbol: str) -> Column:
    """Length of the run of ``symbol`` at the end of a block."""
    return F.length(F.regexp_extract(F.reverse("s"), "^(?:" + _jq(symbol) + ")*", 0))


def _open_runs(blocks: DataFrame, symbol: str) -> DataFrame:
    """``(bkey, first, state)``: state is 1 if a run of ``symbol`` of odd length reaches a block's start,
    so that its last symbol is free for the block's first. A block that is one run keeps or turns over
    the parity that reaches it; another's trailing run fixes the parity after it."""
    tail, n = _trailing(symbol), F.length("s")
    runs = blocks.select("bkey", F.substring("s", 1, 1).alias("first"),
                         F.when(tail < n, tail % 2).alias("fixed"), (n % 2).alias("flips"))
    return segments.states_before(runs, [], "bkey").select("bkey", "first", "state")


def apply_round(blocks: DataFrame, merges: dict[str, str], boundaries: bool) -> DataFrame:
    """B2 for one round: replace every chosen pair (two-symbol string ->
    new symbol), greedily left to right, across block boundaries when the
    blocks form one sequence."""
    s = F.col("s")
    pairs = list(merges.items())
    self_pair = len(pairs) == 1 and pairs[0][0][0] == pairs[0][0][1]
    if not boundaries:
        return blocks.select("bkey", replace_pairs(s, pairs).alias("s"), "w")

    if self_pair:
        (p, new), = pairs
        flags = _open_runs(blocks, p[0]).withColumn("drop_first", (F.col("first") == p[0]) & (F.col("state") == 1))
        # The block before a block that loses its first symbol ends in the merged one.
        summ = _summary(blocks).select("bkey", (F.col("next_first") == p[0]).alias("goes_on"))
        run = blocks.select("bkey", _trailing(p[0]).alias("tail"), F.length("s").alias("n")).join(
            flags.select("bkey", "drop_first", "state"), "bkey").join(summ, "bkey")
        whole = F.col("tail") + F.when(F.col("tail") == F.col("n"), F.col("state")).otherwise(0)
        flags = run.select("bkey", "drop_first", F.when(F.col("goes_on") & (F.pmod(whole, F.lit(2)) == 1), F.lit(new)).alias("new_last"))
    else:
        mp = F.create_map(*[x for p, n in pairs for x in (F.lit(p), F.lit(n))])
        flags = _summary(blocks).select(
            "bkey",
            F.coalesce(F.element_at(mp, F.concat("prev_last", "first")).isNotNull(), F.lit(False)).alias("drop_first"),
            F.element_at(mp, F.concat("last", "next_first")).alias("new_last"))
    # One narrow row per block; the planner sees its size.
    j = blocks.join(flags, "bkey")
    s1 = F.when(F.col("drop_first"), F.expr("substring(s, 2)")).otherwise(F.col("s"))
    j = j.select("bkey", "w", replace_pairs(s1, pairs).alias("s"), "new_last")
    s2 = F.when(F.col("new_last").isNotNull(),
                F.concat(F.expr("substring(s, 1, length(s) - 1)"), F.col("new_last"))).otherwise(F.col("s"))
    return j.select("bkey", s2.alias("s"), "w").filter(F.length("s") > 0)


# --- the training loop -----------------------------------------------------------

@dataclass
class TrainedBPE:
    vocab: DataFrame    # (token, text, kind)
    merges: DataFrame   # (rank, t1, t2, new_token)
    rounds: int
    work: list[Work] = field(default_factory=list)  # of each round, in the piece scope


def train_bpe(blocks: DataFrame, vocab_size: int | None = None, specials: Sequence[str] = (EOT,),
              scope: str = "sequence", max_per_round: int = 64, n_merges: int | None = None) -> TrainedBPE:
    """B1: learn merges until ``vocab_size`` tokens exist, or ``n_merges`` merges, or no
    pair is left.

    ``blocks`` comes from :func:`sequence_blocks` or :func:`piece_blocks`
    (matching ``scope``). The initial vocabulary is built from the blocks'
    characters (U1). The driver only holds the chosen pairs of each round, the most
    frequent pairs and the symbol table of the vocabulary (bounded by ``vocab_size``).
    """
    require(scope in SCOPES, f"scope must be one of {SCOPES}")
    require(max_per_round >= 1, "max_per_round must be >= 1")
    spark = blocks.sparkSession
    blocks = blocks.select("bkey", "s", "w").filter(F.length("s") > 0)
    counts, size = None, None
    if scope == "sequence":
        state = Written(blocks.repartition("bkey"), "bpe-state")
        counts, size = neighbour_counts(state.df)
    else:  # ids in the order of first occurrences
        state = Written(blocks.orderBy("bkey").select(F.monotonically_increasing_id().alias("pid"), "s", "w"), "bpe-pieces")
    if counts and not counts.df.isEmpty():  # each symbol has a neighbour
        chars = counts.df.select(F.explode(F.array(F.substring("pair", 1, 1), F.substring("pair", 2, 1))).alias("ch")).distinct()
    else:
        chars = state.df.select(F.explode(F.array_distinct(F.split("s", ""))).alias("ch")).filter(F.col("ch") != "").distinct()
    rows = sorted(initial_vocab(chars, specials).collect(), key=lambda r: r["token"])  # 256 + alphabet + specials
    text_of = {r["token"]: r["text"] for r in rows}
    tok_of_sym = {r["text"]: r["token"] for r in rows if len(r["text"]) == 1}
    goal = vocab_size if vocab_size is not None else len(rows) + (n_merges or 0)
    symbols = (chr(c) for c in range(_SYMBOL_BASE, _SYMBOL_LIMIT + 1) if chr(c) not in tok_of_sym)
    room = _SYMBOL_LIMIT + 1 - _SYMBOL_BASE - sum(_SYMBOL_BASE <= ord(c) <= _SYMBOL_LIMIT for c in tok_of_sym)
    require(goal - len(rows) <= room, f"at most {room} merges can be trained")
    merges: list[tuple[int, int, int, int]] = []

    def left() -> int:
        return goal - len(rows) - len(merges)

    def take(pairs: list[str]) -> dict[str, str]:
        chosen = {}
        for pair in pairs:
            token, symbol = len(rows) + len(merges), next(symbols)
            t1, t2 = tok_of_sym[pair[0]], tok_of_sym[pair[1]]
            merges.append((len(merges), t1, t2, token))
            text_of[token] = text_of[t1] + text_of[t2]
            tok_of_sym[symbol] = token
            chosen[pair] = symbol
        return chosen

    if scope == "sequence":
        rounds, work = _train_sequence(state, counts, size, len(rows), left, take, max_per_round,
                                       lambda: {sym: len(text_of[t]) for sym, t in tok_of_sym.items() if len(text_of[t]) > 1}), []
    else:
        work = train(state.df, len(rows), left, take, max_per_round)
        rounds = len(work)
        state.drop()
    kinds = {r["token"]: r["kind"] for r in rows}
    vocab = spark.createDataFrame([(t, text_of[t], kinds.get(t, "merge")) for t in sorted(text_of)],
                                  "token int, text string, kind string")
    return TrainedBPE(vocab=vocab, merges=spark.createDataFrame(merges, "rank int, t1 int, t2 int, new_token int"),
                      rounds=rounds, work=work)


def _train_sequence(state: Written, counts: Written, size: int | None, alphabet: int, left: Callable[[], int],
                    take: Callable[[list[str]], dict[str, str]], max_per_round: int, lengths: Callable[[], dict[str, int]]) -> int:
    """Rounds over one sequence with the ``counts`` of its pairs and blocks of ``size``, by its segments as far as these
    go, then by its blocks; returns their number. ``lengths`` gives the characters of merged symbols."""
    done: list[dict[str, str]] = []

    def noted(pairs: list[str]) -> dict[str, str]:
        done.append(take(pairs))
        return done[-1]

    ranks, floor = SEGMENT_RANKS * left(), None
    while left() > 0:
        kept, least = _frequent_pairs(counts.df, ranks)
        if not kept or (floor is not None and least >= floor):
            break
        with segment_table(state.df, kept, size) as segs:
            if segs is None:
                break
            merges = [m for chosen in done for m in chosen.items()]
            pieces = segs.select("pid", replace_pairs(F.col("s"), merges).alias("s") if merges else "s", "w")
            # Where blocks are not of one size, a place is no number of characters.
            train(pieces, alphabet + len(merges), left, noted, max_per_round, least, lengths if size else None)
        ranks, floor = 2 * ranks, least
    counts.drop()
    if left() > 0:
        for chosen in done:
            state = _next_state(state, chosen)
    while (n := left()) > 0:
        top = pair_counts(state.df, True).orderBy(F.desc("n"), F.asc("first")).limit(min(max_per_round, n)).collect()
        pairs = choose_round([(r["pair"], r["n"]) for r in top], n)
        if not pairs:
            break
        state = _next_state(state, noted(pairs))
    state.drop()
    return len(done)


def _next_state(state: Written, merges: dict[str, str]) -> Written:
    after = Written(apply_round(state.df, merges, True), "bpe-state")
    state.drop()
    return after


# --- segments of a sequence ----------------------------------------------------------

#: The first floor is the count of the pair of this rank, times the merges wanted; the last of n merges has about that of rank 1.7 n.
SEGMENT_RANKS, RANKS_AT_MOST = 2, 1 << 11
#: One in so many neighbours, at least, must be cut apart; else segments are long and hardly any two are the same.
CUT_SHARE = 8
#: Symbols of the longest segment.
SEGMENT_SYMBOLS = 1 << 20
INNER, HEAD, TAIL = 0, 1, 2


def _frequent_pairs(counts: DataFrame, ranks: int) -> tuple[list[str], int]:
    """The pairs that no segment is cut between, and the least number of times that they occur: all pairs of
    that count and above, at most ``ranks``, such that enough other neighbours are left to be cut apart."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.orderBy(F.desc("n"), "pair").limit(min(ranks, RANKS_AT_MOST) + 1).collect()
    n = [r["n"] for r in top]
    sums = np.cumsum(n)
    for size in range(min(len(n) - 1, ranks, RANKS_AT_MOST), 0, -1):
        if n[size] < n[size - 1] and CUT_SHARE * (total - int(sums[size - 1])) >= total:
            return [r["pair"] for r in top[:size]], n[size - 1]
    return [], 0


def _cut_blocks(blocks: DataFrame, kept: Sequence[str]) -> DataFrame:
    """``(s, bkey, idx, w, kind)``: the distinct segments (of two symbols and more) inside the blocks of a slice, with their number and
    first place; and what stands before a block's first cut (HEAD) and after its last one (TAIL), or the block if there is none (both)."""
    def make():
        parts = cutter(kept)

        def cut(batch: pa.RecordBatch) -> list[pa.Array]:
            batch = in_order(batch, 1)
            segs, begin, end, row, codes, starts = parts(batch.column(1))
            idx = begin - starts[row]
            kind = np.where(idx == 0, HEAD, INNER) + np.where(end == np.append(starts[1:], len(codes))[row], TAIL, INNER)
            inner, edge = np.flatnonzero((kind == INNER) & (end - begin > 1)), np.flatnonzero(kind != INNER)
            encoded = segs.take(pa.array(inner)).dictionary_encode()
            order = encoded.indices.to_numpy(zero_copy_only=False)
            # Codes are given in the order of first occurrences.
            first = inner[np.flatnonzero(np.diff(np.maximum.accumulate(order), prepend=-1))]
            at = np.concatenate([first, edge])
            times = np.concatenate([np.bincount(order, minlength=len(first)), np.ones(len(edge), np.int64)])
            return [pa.concat_arrays([encoded.dictionary, segs.take(pa.array(edge))]), batch.column(0).take(pa.array(row[at])),
                    pa.array(idx[at], pa.int32()), pa.array(times, pa.int64()), pa.array(kind[at], pa.int32())]
        return cut
    bkey = StructField("bkey", LongType())
    schema = StructType([StructField("s", StringType()), bkey, StructField("idx", IntegerType()), StructField("w", LongType()), StructField("kind", IntegerType())])
    return map_slices(blocks.select(F.col("bkey").cast("long").alias("bkey"), "s"), "s", schema, make, PAIR_BYTES)


def _chains(edges: DataFrame, kept: Sequence[str]) -> DataFrame:
    """``edges`` (s, bkey, idx, kind) with the ``chain`` they belong to, the ``place`` of its first one: a tail, or a head that is cut off from the
    block before."""
    place = 2 * F.col("bkey") + F.when(F.col("kind") == TAIL, 1).otherwise(0)
    rows = edges.select("s", "bkey", "idx", "kind", place.alias("place"), F.substring("s", 1, 1).alias("first"),
                        F.substring(F.reverse("s"), 1, 1).alias("last"))
    near = segments.neighbour_edges(rows, [], "place")
    goes_on = (F.col("kind") != TAIL) & F.coalesce(F.concat("prev_last", "first").isin(list(kept)), F.lit(False))
    near = near.select("s", "bkey", "idx", "place", F.when(~goes_on, F.col("place")).alias("start"),
                       F.floor(F.col("place") / segments.GROUP).cast("long").alias("grp"))
    groups = near.groupBy("grp").agg(F.max("start").alias("start")).select(
        F.col("grp").alias("g"), F.max("start").over(Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = F.max("start").over(Window.partitionBy("grp").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return near.withColumn("inside", inside).join(groups, F.col("grp") == F.col("g")).select(
        "s", "bkey", "idx", "place", F.coalesce("inside", "before").alias("chain"))


@contextmanager
def segment_table(blocks: DataFrame, kept: Sequence[str], size: int | None = None) -> Iterator[DataFrame | None]:
    """``(pid, s, w)``: the distinct segments of the sequence in ``blocks``, which is cut between all neighbours but the pairs
    ``kept``; ``pid`` is the first place, in characters if blocks have ``size``. None if one is longer than ``SEGMENT_SYMBOLS``.

    Segments that reach over blocks are put together from what stands at the blocks' ends. What
    the table is read from is dropped after use.
    """
    cut = Written(_cut_blocks(blocks, kept), "bpe-cut")
    chains = Written(_chains(cut.df.filter(F.col("kind") != INNER), kept), "bpe-chains")
    longest = chains.df.groupBy("chain").agg(F.sum(F.length("s")).alias("n")).agg(F.max("n")).first()[0] or 0
    joined = chains.df.groupBy("chain").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "s"))), lambda x: x["s"]), "").alias("s"),
        F.min(F.struct("bkey", "idx")).alias("at")).select("s", "at.bkey", "at.idx", F.lit(1).cast("long").alias("w"))
    every = cut.df.filter(F.col("kind") == INNER).select("s", "bkey", "idx", "w").unionByName(joined.filter(F.length("s") > 1))
    pid = (F.shiftleft("bkey", 32) if size is None else F.col("bkey") * size) + F.col("idx")
    yield every.groupBy("s").agg(F.min(pid).alias("pid"), F.sum("w").alias("w")) if longest <= SEGMENT_SYMBOLS else None
    cut.drop()
    chains.drop()


def train_tokenizer(sample: DataFrame, vocab_size: int, specials: Sequence[str] = (EOT,),
                    block_chars: int = 4096, max_per_round: int = 64) -> TrainedBPE:
    """``Tokenizer.train`` on a training sample ``(row_idx, text)``: the
    reference semantics (``sequence`` scope)."""
    return train_bpe(sequence_blocks(sample, block_chars), vocab_size, specials,
                     "sequence", max_per_round)
