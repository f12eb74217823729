"""B1/B2 in the piece scope: an inverted index from pairs to the pieces that hold them.

A *posting* ``(pair, pid, ver, s, w, d)`` says that the piece ``pid`` (weight ``w``) reads
``s`` since round ``ver`` and holds ``pair``; a null ``s`` says that it no longer does. ``d``
is what this changed in the pair's weighted count, so a pair's count is the sum of its
``d``. A piece that changes gets a posting for each pair that it holds or held: the latest
posting of a piece under any of its pairs has its present string, and a round needs no
table of pieces. It reads the postings of its merges' pairs, and writes those of the pieces
that change.

Postings are Parquet tables sorted by pair (*runs*), with the filter on pairs pushed into
the scan. Each round adds a run; once ``FAN`` runs of about the same size (or smaller) stand
at the end, they become one. So a posting is rewritten about once each time the index
grows by that factor, not once a round.

The driver holds the *frontier*: the counts of all pairs that occur at least ``least`` times,
at most ``FRONTIER`` of them. Replacements only lower the count of an old pair, and the
postings of a round hold every occurrence of its new pairs, so the frontier stays exact by
each round's sums of ``d``. Only when no pair of it is left is the whole index summed up
again, for a lower ``least``.

The first merges are in a good part of all pieces, and writing the postings of these over
and over would cost more than it saves. So training starts on the plain table of pieces,
which a round goes through whole; the replacements since it was last written are applied on
the way. The index is built once rounds (the mean of the last ``RECENT``) change at most one
in ``DENSE`` pieces. Pieces beyond ``LONG`` symbols, which would repeat their string in very many
postings, stay in the table.
"""
from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import Written
from .pieces import text_buffers
from .tokenizer import code_points, map_slices, text_code_points

# Bytes of blocks whose pairs are counted together.
PAIR_BYTES = 1 << 22
FAN = 8
FRONTIER = 1 << 16
LONG = 256
#: The index is built once the last rounds change at most one in this many pieces; 0: at the
#: start. A changed piece costs some ten postings, written; an unchanged one a look at its string.
DENSE, RECENT = 128, 8
#: Most frequent pairs that a round looks at.
RANKED = 64
#: Rounds between two writes of the table.
WRITE_TABLE = 4
#: Count changes, at most, that are collected without asking first whether the frontier has the
#: pair. A round changes at most two pairs a merge for each symbol.
COLLECTED = 1 << 20
#: Least count of an empty frontier: no pair belongs to it.
NEVER = 1 << 62
POSTING = "pair string, pid long, ver int, s string, w long, d long"


def neighbours(s: Column) -> Column:
    """All two neighbouring symbols of a string, as an array of two-symbol strings."""
    symbols = F.split(s, "")
    n = F.greatest(F.length(s) - 1, F.lit(0))
    return F.zip_with(F.slice(symbols, 1, n), F.slice(symbols, 2, n), lambda x, y: F.concat(x, y))


def count_pairs(dense: np.ndarray, n_symbols: int, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbours in blocks of symbols (0 … ``n_symbols`` - 1) that lie one behind the other:
    their codes ``first * n_symbols + second``, weighted counts, and places in ``dense``."""
    inner = np.ones(len(dense), bool)
    inner[np.cumsum(sizes) - 1] = False
    at = np.flatnonzero(inner)
    pair = dense[at] * n_symbols + dense[at + 1]
    w = np.repeat(weights, sizes)[at]
    if n_symbols ** 2 > max(1 << 16, 4 * len(pair)):
        codes, first, pair = np.unique(pair, return_index=True, return_inverse=True)
    else:
        first = np.full(n_symbols ** 2, -1)
        first[pair[::-1]] = np.arange(len(pair))[::-1]  # of a repeated index the last one stays
        codes = np.flatnonzero(first >= 0)
        first, dense_code = first[codes], np.zeros(n_symbols ** 2, np.int64)
        dense_code[codes] = np.arange(len(codes))
        pair = dense_code[pair]
    n = np.zeros(len(codes), np.int64)
    np.add.at(n, pair, w)
    return codes, n, at[first]


# Stands between strings that are worked on as one: no text holds a surrogate.
_APART = "\ud800"


def pair_sums(rows: DataFrame, before: Sequence[tuple[str, str]] = (), merges: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """``(pair, d, changed)`` of each slice of ``rows`` (w, s): the pairs of neighbours, each with the sum of the
    ``w`` of its occurrences. ``before`` is replaced first. With ``merges`` only strings that these change
    count, as they are after them less as they were; the first row's ``changed`` is the number of these."""
    def make():
        dense = np.zeros(0x110000, np.int64)

        def count(batch: pa.RecordBatch) -> list[pa.Array]:
            texts, w = batch.column(1).to_pylist(), batch.column(0).to_numpy(zero_copy_only=False)
            whole = reduce(lambda t, p: t.replace(*p), before, _APART.join(texts))
            was, changed = whole.split(_APART), 0
            if merges is not None:
                now = reduce(lambda t, p: t.replace(*p), merges, whole).split(_APART)
                at = [i for i, (a, b) in enumerate(zip(was, now)) if a != b]
                was, w, changed = [was[i] for i in at] + [now[i] for i in at], np.concatenate([-w[at], w[at]]), len(at)
            codes, sizes = code_points(was), np.fromiter(map(len, was), np.int64, len(was))
            seen = np.zeros(len(dense), bool)
            seen[codes] = True
            symbols = np.flatnonzero(seen)
            dense[symbols] = np.arange(len(symbols))
            pairs, d, _ = count_pairs(dense[codes], len(symbols), sizes, w)
            some = d != 0
            names = [chr(symbols[a]) + chr(symbols[b]) for a, b in zip(*np.divmod(pairs[some], max(1, len(symbols))))]
            return [pa.array(names, pa.string()), pa.array(d[some], pa.int64()),
                    pa.array([changed if i == 0 else 0 for i in range(len(names))], pa.int64())]
        return count
    schema = StructType([StructField("pair", StringType()), StructField("d", LongType()), StructField("changed", LongType())])
    return map_slices(rows.filter(F.length("s") > 1).select("w", "s"), "s", schema, make, PAIR_BYTES)


# Pairs of symbols that are looked up in a dense table.
DENSE_KEPT = 1 << 24


def cutter(kept: Sequence[str]) -> Callable[[pa.Array], tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A function that cuts texts, none empty, between all neighbours but the pairs ``kept``: the parts, and of each the first
    symbol and the end, and the text it is in; the code points of all texts, and where each text starts."""
    symbols = sorted({c for p in kept for c in p})
    n = len(symbols) + 1
    dense = np.zeros(0x110000, np.int32)
    dense[[ord(c) for c in symbols]] = np.arange(1, n)
    codes_kept = np.array(sorted(int(dense[ord(p[0])]) * n + int(dense[ord(p[1])]) for p in kept), np.int64)
    table = np.zeros(n * n, bool) if n * n <= DENSE_KEPT else None
    if table is not None:
        table[codes_kept] = True

    def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        codes, sizes = text_code_points(texts)
        d = dense[codes] if table is not None else dense[codes].astype(np.int64)
        pair = d[:-1] * n + d[1:]
        apart = np.ones(len(codes), bool)  # from the symbol before
        apart[1:] = ~(np.isin(pair, codes_kept) if table is None else table[pair])
        starts = np.cumsum(sizes) - sizes
        apart[starts] = True
        begin = np.flatnonzero(apart)
        width = np.ones(len(codes), np.int8)
        for least in (0x80, 0x800, 0x10000):
            width += codes >= least
        places = np.concatenate([np.zeros(1, np.int32), np.cumsum(width, dtype=np.int32)])[np.append(begin, len(codes))]
        parts = pa.StringArray.from_buffers(len(begin), pa.py_buffer(places), pa.py_buffer(bytes(text_buffers(texts)[0])))
        row = np.repeat(np.arange(len(sizes)), np.diff(np.append(np.searchsorted(begin, starts), len(begin))))
        return parts, begin, np.append(begin[1:], len(codes)), row, codes, starts
    return cut


def cut_pieces(rows: DataFrame, kept: Sequence[str], lengths: dict[str, int]) -> DataFrame:
    """``(pid, w, s)``: the parts, of two symbols and more, of ``rows`` (pid, w, s) cut between all neighbours but the pairs
    ``kept``. The pid of a part is the piece's and the length of the symbols before it, 1 if ``lengths`` has no other. Equal
    parts of a slice are one row, with the least pid and the sum of ``w``."""
    def make():
        cut = cutter(kept)
        length = np.ones(0x110000, np.int64)
        length[[ord(c) for c in lengths]] = list(lengths.values())

        def parts(batch: pa.RecordBatch) -> list[pa.Array]:
            pid, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            segs, begin, end, row, codes, starts = cut(batch.column(2))
            before = np.concatenate([[0], np.cumsum(length[codes])])
            long = np.flatnonzero(end - begin > 1)
            encoded = segs.take(pa.array(long)).dictionary_encode()
            at, row = encoded.indices.to_numpy(zero_copy_only=False), row[long]
            first, times = np.full(len(encoded.dictionary), NEVER), np.zeros(len(encoded.dictionary), np.int64)
            np.minimum.at(first, at, pid[row] + before[begin[long]] - before[starts[row]])
            np.add.at(times, at, w[row])
            return [pa.array(first, pa.int64()), pa.array(times, pa.int64()), encoded.dictionary]
        return parts
    schema = StructType([StructField("pid", LongType()), StructField("w", LongType()), StructField("s", StringType())])
    return map_slices(rows.filter(F.length("s") > 1).select("pid", "w", "s"), "s", schema, make, PAIR_BYTES)


def replace_pairs(s: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Every pair (two symbols -> one) replaced in turn, each greedily left to right.
    One expression of constant size, whose code is compiled once for all rounds."""
    table = F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(n).alias("new")) for p, n in pairs])
    return F.aggregate(table, s, lambda acc, x: F.replace(acc, x["pair"], x["new"]))


def any_of(pairs: Iterable[str]) -> Column:
    """``pair`` is one of a few; as equalities, which the scan can use to skip row groups and pages.
    Their number is filled up to a power of two, so that rounds share their compiled code."""
    pairs = list(pairs)
    pairs += pairs[:1] * ((1 << (len(pairs) - 1).bit_length()) - len(pairs))
    return reduce(lambda a, b: a | b, [F.col("pair") == F.lit(p) for p in pairs])


def choose_round(ranked: list[tuple[str, int]], room: int) -> list[str]:
    """The longest prefix of the ranked pairs that can be merged at once (no token both
    starts one pair and ends another; a self-pair only on its own), at most ``room``."""
    taken: list[str] = []
    starts: set[str] = set()
    ends: set[str] = set()
    for pair, _ in ranked[:room]:
        a, b = pair[0], pair[1]
        if a == b and not taken:
            return [pair]
        if a == b or a in ends or b in starts:
            break
        taken.append(pair)
        starts.add(a)
        ends.add(b)
    return taken


@dataclass
class Run:
    table: Written
    rows: int


@dataclass
class Work:
    """What a round did: pairs merged, postings read for them (all pieces, before there is an index),
    pieces changed, postings written."""
    pairs: int
    read: int
    changed: int
    written: int


class PairIndex:
    """The index over ``pieces`` (pid, s, w), where pids are distinct and in the order that decides ties.
    Pairs that occur less than ``floor`` times are not chosen. With ``lengths``, which gives the
    lengths of symbols that are not 1, pids are places in a text; pieces are then cut between rarer pairs as merges go on."""

    def __init__(self, pieces: DataFrame, alphabet: int = 0, floor: int = 1, lengths: Callable[[], dict[str, int]] | None = None):
        self.spark = pieces.sparkSession
        self.symbols = alphabet
        self.floor = floor
        self.lengths = lengths
        self.round = 0
        self.work: list[Work] = []
        self.recounts = 0
        self.runs: list[Run] = []
        seen = Observation()
        self._table: Written | None = Written(pieces.filter(F.length("s") > 1).observe(seen, F.count(F.lit(1)).alias("rows")), "bpe-table")
        self.pieces = seen.get["rows"]
        self._pending: dict[str, str] = {}
        self.frontier: dict[str, int] = {}
        self.least = NEVER
        if DENSE == 0:
            self._build()

    def _build(self) -> None:
        """Postings for the pieces of the table that are not too long."""
        now = self._table_now().withColumn("was", F.lit(None).cast("string"))
        short = now.filter(F.length("s").between(2, LONG))
        self.runs = [self._write(self._sorted(self._changes(short, "was", "s", self.round)))]
        self._write_table(now.filter(F.length("s") > LONG).select("pid", "w", "s"))
        if self._table.df.isEmpty():
            self._table.drop()
            self._table = None

    # --- tables -------------------------------------------------------------------

    def _changes(self, rows: DataFrame, old: str, new: str, ver: int) -> DataFrame:
        """Postings of ``rows`` (pid, w) whose string went from ``old`` (null: nothing) to ``new``."""
        before = F.coalesce(neighbours(F.col(old)), F.array().cast("array<string>"))
        at = rows.select("pid", "w", F.col(new).alias("s"), before.alias("was"), neighbours(F.col(new)).alias("is"))
        at = at.select("*", F.explode(F.array_union("was", "is")).alias("pair"))
        times = lambda c: F.size(F.filter(c, lambda p: p == F.col("pair")))
        return at.select("pair", "pid", F.lit(ver).alias("ver"), F.when(F.array_contains("is", F.col("pair")), F.col("s")).alias("s"),
                         "w", (F.col("w") * (times("is") - times("was"))).alias("d"))

    def _sorted(self, postings: DataFrame) -> DataFrame:
        """Ranges of pairs; a pair with very many pieces may span several."""
        return postings.repartitionByRange("pair", F.xxhash64("pid")).sortWithinPartitions("pair")

    def _write(self, postings: DataFrame) -> Run:
        seen = Observation()
        table = Written(postings.observe(seen, F.count(F.lit(1)).alias("rows")), "bpe-postings")
        return Run(table, seen.get["rows"])

    def postings(self, runs: Sequence[Run] | None = None) -> DataFrame:
        return self.spark.read.schema(POSTING).parquet(*[r.table.path for r in (self.runs if runs is None else runs)])

    def _settle(self) -> None:
        """Join the last runs while ``FAN`` of them are of about the same size or smaller."""
        def grade(run: Run) -> int:
            return max(run.rows, 1).bit_length() // FAN.bit_length()

        while True:
            top = grade(self.runs[-1])
            some = list(takewhile(lambda r: grade(r) <= top, reversed(self.runs)))
            if len(some) < FAN:
                return
            old = self.runs[-len(some):]
            joined = self.postings(old).groupBy("pair", "pid").agg(
                F.max("ver").alias("ver"), F.max_by("s", F.col("ver")).alias("s"), F.max("w").alias("w"), F.sum("d").alias("d"))
            if len(old) == len(self.runs):
                joined = joined.filter("s is not null")
            self.runs[-len(some):] = [self._write(self._sorted(joined))]
            for run in old:
                run.table.drop()

    def close(self) -> None:
        if self._table:
            self._table.drop()
        for run in self.runs:
            run.table.drop()

    # --- pieces without postings ---------------------------------------------------------

    def _table_now(self) -> DataFrame:
        s = replace_pairs(F.col("s"), list(self._pending.items())) if self._pending else F.col("s")
        return self._table.df.select("pid", "w", s.alias("s"))

    def _write_table(self, now: DataFrame) -> None:
        before, self._table = self._table, Written(now, "bpe-table")
        self._pending = {}
        before.drop()

    def _cut_table(self) -> None:
        """The table with its pieces cut between pairs that are rarer than the floor: these stay rarer, as do
        the pairs that come from them, and shorter pieces are more often the same."""
        kept = [p for p, n in self.frontier.items() if n >= self.floor]
        seen = Observation()
        parts = cut_pieces(self._table_now(), kept, self.lengths())
        self._write_table(parts.groupBy("s").agg(F.min("pid").alias("pid"), F.sum("w").alias("w")).select("pid", "w", "s").observe(
            seen, F.count(F.lit(1)).alias("rows")))
        self.pieces = seen.get["rows"]

    def _merge_table(self, merges: dict[str, str], seen: Observation) -> DataFrame:
        """Count changes ``(pair, d)`` in the table."""
        sums = pair_sums(self._table.df, list(self._pending.items()), list(merges.items()))
        return sums.observe(seen, F.sum("changed").alias("rows")).select("pair", "d")

    # --- counts -----------------------------------------------------------------------

    def counts(self) -> DataFrame:
        """``(pair, n)`` of all pairs."""
        every = [self.postings().select("pair", "d")] if self.runs else []
        if self._table:
            every.append(pair_sums(self._table.df, list(self._pending.items())).select("pair", "d"))
        return reduce(DataFrame.union, every).groupBy("pair").agg(F.sum("d").alias("n")).filter("n > 0")

    def _recount(self) -> bool:
        """Fill the frontier with the most frequent pairs; false if there are none."""
        self.recounts += 1
        table = Written(self.counts(), "bpe-counts")
        step = F.floor(4 * F.log2("n")).cast("int")  # 19 % apart
        sizes = dict(table.df.groupBy(step.alias("step")).count().collect())
        total, lowest = 0, max(sizes, default=0)
        for at in sorted(sizes, reverse=True):
            total += sizes[at]
            if total > FRONTIER and at != max(sizes):
                break
            lowest = at
        rows = table.df.filter(step >= lowest).collect() if sizes and sizes[max(sizes)] <= FRONTIER else []
        self.frontier = {r["pair"]: r["n"] for r in rows}
        self.least = min(self.frontier.values(), default=NEVER)
        table.drop()
        return bool(sizes)

    def first_places(self, pairs: DataFrame | Sequence[str]) -> DataFrame:
        """``(pair, place)``: the first occurrence (pid, idx) of pairs, given as a list of a few or as a table (pair)."""
        def of(df: DataFrame) -> DataFrame:
            return df.join(pairs, "pair", "left_semi") if isinstance(pairs, DataFrame) else df.filter(any_of(pairs))

        found = []
        if self.runs:
            latest = of(self.postings()).groupBy("pair", "pid").agg(F.max_by("s", "ver").alias("s")).filter("s is not null")
            found.append(latest.select("pair", "pid", F.expr("instr(s, pair)").cast("int").alias("idx")))
        if self._table:
            at = self._table_now()
            if not isinstance(pairs, DataFrame):
                at = at.filter(F.exists(F.array(*[F.lit(p) for p in pairs]), lambda p: F.contains(F.col("s"), p)))
            at = of(at.select("pid", F.posexplode(neighbours(F.col("s"))).alias("idx", "pair")))
            found.append(at.select("pair", "pid", (F.col("idx") + 1).alias("idx")))
        return reduce(DataFrame.union, found).groupBy("pair").agg(F.min(F.struct("pid", "idx")).alias("place"))

    def choose(self, room: int) -> list[str]:
        """The pairs that :func:`choose_round` takes from all pairs, ranked by count and first place.

        Places decide among equal counts only, so they are looked up just for equal counts
        that the prefix reaches. A run of equal counts that the list cuts off waits for a
        later round; if all of the list is one such run, all of its pairs are ranked.
        """
        while not self.frontier:
            if not self._recount():
                return []
            if not self.frontier:  # more pairs are equally frequent than the driver may hold
                counts = self.counts()
                most = counts.agg(F.max("n")).first()[0]
                if most < self.floor:
                    return []
                return self._ranked(counts.filter(F.col("n") == most).select("pair"), most, room)
        top = heapq.nlargest(RANKED + 1, self.frontier.items(), key=lambda x: x[1])
        top = [x for x in top if x[1] >= self.floor]
        if not top:
            return []
        if len(top) > RANKED:
            cut = top[-1][1]
            top = [x for x in top if x[1] > cut]
            if not top:
                tied = [(p,) for p, n in self.frontier.items() if n == cut]
                return self._ranked(self.spark.createDataFrame(tied, "pair string"), cut, room)
        times = Counter(n for _, n in top)
        clear = list(takewhile(lambda x: times[x[1]] == 1, top))
        chosen = choose_round(clear, room)
        if len(chosen) == room or len(chosen) < len(clear) or len(clear) == len(top) or (chosen and chosen[0][0] == chosen[0][1]):
            return chosen
        place = {r["pair"]: tuple(r["place"]) for r in self.first_places([p for p, n in top if times[n] > 1]).collect()}
        return choose_round(sorted(top, key=lambda x: (-x[1], place.get(x[0], ()))), room)

    def _ranked(self, tied: DataFrame, n: int, room: int) -> list[str]:
        rows = self.first_places(tied).orderBy("place").limit(min(room, RANKED)).collect()
        return choose_round([(r["pair"], n) for r in rows], room)

    # --- a round --------------------------------------------------------------------------

    def merge(self, merges: dict[str, str]) -> None:
        """Replace the chosen pairs (two symbols -> one) in the pieces that hold them."""
        self.round += 1
        self.symbols += len(merges)
        work, changes, in_table = Work(len(merges), 0, 0, 0), [], Observation()
        if self.runs:
            run = self._merge_postings(merges, work)
            changes.append(self.postings([run]).select("pair", "d"))
            self.runs.append(run)
        if self._table:
            changes.append(self._merge_table(merges, in_table))
        self._update(reduce(DataFrame.union, changes), merges, work.written if not self._table else None)
        if self._table:
            self._pending.update(merges)
            work.read += self.pieces if not self.runs else 0
            work.changed += in_table.get["rows"] or 0
        self.work.append(work)
        if self.runs:
            self._settle()
        elif len(self.work) >= RECENT and sum(w.changed for w in self.work[-RECENT:]) * DENSE <= self.pieces * RECENT:
            self._build()
        if self._table and len(self._pending) and self.round % WRITE_TABLE == 0:
            # The frontier has all pairs of the floor and above if it goes as far down.
            if self.lengths and not self.runs and self.least <= self.floor:
                self._cut_table()
            else:
                self._write_table(self._table_now())

    def _merge_postings(self, merges: dict[str, str], work: Work) -> Run:
        read, seen = Observation(), Observation()
        found = self.postings().filter(any_of(merges)).observe(read, F.count(F.lit(1)).alias("rows"))
        latest = found.groupBy("pid").agg(F.max_by(F.struct("s", "w"), F.struct("ver", F.col("s").isNotNull())).alias("p")).select("pid", "p.*")
        held = latest.filter("s is not null").observe(seen, F.count(F.lit(1)).alias("rows"))
        held = held.withColumn("t", replace_pairs(F.col("s"), list(merges.items())))
        run = self._write(self._changes(held, "s", "t", self.round).sortWithinPartitions("pair"))
        work.read, work.changed, work.written = read.get["rows"], seen.get["rows"], run.rows
        return run

    def _update(self, changes: DataFrame, merges: dict[str, str], rows: int | None) -> None:
        sums = changes.groupBy("pair").agg(F.sum("d").alias("d"))
        new = list(merges.values())
        new += new[:1] * ((1 << (len(new) - 1).bit_length()) - len(new))
        is_new = lambda c: reduce(lambda a, b: a | b, [c == F.lit(n) for n in new])
        fresh = is_new(F.substring("pair", 1, 1)) | is_new(F.substring("pair", 2, 1))
        most = 2 * self.symbols * len(merges)
        if min(most, most if rows is None else rows) > COLLECTED:
            known = self.spark.createDataFrame([(p,) for p in self.frontier] or [("",)], "pair string").withColumn("known", F.lit(True))
            sums = sums.join(F.broadcast(known), "pair", "left").filter(F.col("known") | (fresh & (F.col("d") >= self.least)))
        least = F.lit(self.least)
        for pair, d in sums.filter(F.when(fresh, F.col("d") >= least).otherwise(F.col("d") != 0)).select("pair", "d").collect():
            if pair in self.frontier:
                self.frontier[pair] += d
            elif pair[0] in new or pair[1] in new:
                self.frontier[pair] = d
        self.frontier = {p: n for p, n in self.frontier.items() if n >= self.least}


def train(pieces: DataFrame, alphabet: int, goal: Callable[[], int], take: Callable[[list[str]], dict[str, str]],
          max_per_round: int, floor: int = 1, lengths: Callable[[], dict[str, int]] | None = None) -> list[Work]:
    """Choose and merge until ``goal()`` merges are left none, or no pair is that occurs ``floor`` times. ``take``
    turns the chosen pairs into their new symbols. Returns the work of each round."""
    index = PairIndex(pieces, alphabet, floor, lengths)
    while (left := goal()) > 0 and (pairs := index.choose(min(max_per_round, left))):
        index.merge(take(pairs))
    index.close()
    return index.work
