"""Spelling variants: words one edit apart, by composing finite-state machines.

The vocabulary is an acyclic acceptor A. With E, the transducer of exactly one inserted,
deleted or replaced code point, the composition A o E o A accepts the pairs of near
words. It is enumerated per initial state, so that no task holds the vocabulary.

Partitions. Two near words differ first at some position i, and agree before it and, past
the edit, after it. The positions from 0 to the shorter word's length n are cut into two
windows. For a window, all words that share n and what lies outside of it start from one
state of the composition: what is left of them, the *bodies*, is a small vocabulary. A word
is in two partitions as the shorter and in two as the longer of a pair. A partition of more
than ``MOST_WORDS`` words, or with bodies beyond ``MOST_CHARS``, has its window halved,
until it is small or its window is one position.

In a partition the bodies become minimised acceptors (equal right languages are one
state, found bottom up). The composition walks pairs of states: on equal labels both go
on; an edit is taken once; after it, both must accept the same rest. What a state pair
accepts is worked out once. Each pair of words has one first difference, therefore one
window, and is enumerated once.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

MIN_LENGTH, MIN_COUNT = 5, 3
#: A word takes the form of its most frequent near word if that is this many times as frequent.
RATIO = 2
MOST_WORDS, MOST_CHARS = 8192, 64


# --- inside a task ---------------------------------------------------------------------

class Acceptor:
    """The minimised acyclic acceptor of some words; ``arcs[state]`` maps a label to a state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._states: dict[tuple, int] = {}
        words = sorted(set(words))
        self.start = self._state(words, 0, len(words), 0)

    def _state(self, words: list[str], at: int, end: int, depth: int) -> int:
        """The state that accepts the rests, from ``depth``, of the sorted words at:end."""
        final = at < end and len(words[at]) == depth
        arcs, i = {}, at + final
        while i < end:
            label, j = words[i][depth], i + 1
            while j < end and words[j][depth] == label:
                j += 1
            arcs[label] = self._state(words, i, j, depth + 1)
            i = j
        key = (final, *arcs.items())
        if key not in self._states:
            self._states[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._states[key]


class Composition:
    """Pairs of words one edit apart: the left one is accepted by ``left``, the right one by ``right``."""

    def __init__(self, left: Acceptor, right: Acceptor):
        self.left, self.right = left, right
        self._rest: dict[tuple[int, int], list[str]] = {}
        self._pairs: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def rest(self, p: int, q: int) -> list[str]:
        """Words that both the left state ``p`` and the right state ``q`` accept (the edit is spent)."""
        known = self._rest.get((p, q))
        if known is None:
            known = [""] if self.left.final[p] and self.right.final[q] else []
            there = self.right.arcs[q]
            for label, to in self.left.arcs[p].items():
                if label in there:
                    known += [label + r for r in self.rest(to, there[label])]
            self._rest[p, q] = known
        return known

    def replaced(self, p: int, q: int) -> list[tuple[str, str]]:
        """Pairs from here that differ by one replaced label, the smaller one on the left."""
        known = self._pairs.get((p, q))
        if known is None:
            known = []
            for c, to in self.left.arcs[p].items():
                for d, there in self.right.arcs[q].items():
                    if c < d:
                        known += [(c + r, d + r) for r in self.rest(to, there)]
                    elif c == d:
                        known += [(c + u, d + v) for u, v in self.replaced(to, there)]
            self._pairs[p, q] = known
        return known

    def inserted(self, p: int, q: int, at_end: bool) -> list[tuple[str, str]]:
        """Pairs from here whose right word has one label more. Of equal results the one with
        the insertion furthest to the right counts: what follows differs from the label. At
        the very end it counts if ``at_end``."""
        known = self._pairs.get((p, q))
        if known is None:
            known = []
            here = self.left.arcs[p]
            for d, there in self.right.arcs[q].items():
                known += [(r, d + r) for r in self.rest(p, there) if (r[0] != d if r else at_end)]
                if d in here:
                    known += [(d + u, d + v) for u, v in self.inserted(here[d], there, at_end)]
            self._pairs[p, q] = known
        return known


def near_bodies(shorter: list[str], longer: list[str], at_end: bool) -> list[tuple[str, str]]:
    """Near pairs of a partition: among ``shorter`` by a replacement, and into ``longer`` by an insertion."""
    out = []
    if shorter:
        a = Acceptor(shorter)
        if len(shorter) > 1:
            out += Composition(a, a).replaced(a.start, a.start)
        if longer:
            b = Acceptor(longer)
            out += Composition(a, b).inserted(a.start, b.start, at_end)
    return out


# --- on Spark ------------------------------------------------------------------------------

_KEY = ["n", "lo", "hi", "head", "tail"]


def _cut(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Rows (word, count, n, longer) seen through the window lo:hi of first differences."""
    more = F.col("longer").cast("int")
    rows = rows.withColumn("lo", lo.cast("int")).withColumn("hi", hi.cast("int"))
    stop = F.least(F.col("hi"), F.col("n")) + more
    return rows.select("word", "count", "n", "longer", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")).alias("head"),
                       F.substring("word", stop + 1, F.length("word")).alias("tail"),
                       F.substring("word", F.col("lo") + 1, stop - F.col("lo")).alias("body"))


def partitions(words: DataFrame, most_words: int = MOST_WORDS, most_chars: int = MOST_CHARS) -> DataFrame:
    """``words`` (word, count) in partitions of the composition: the rows of :func:`_cut`."""
    roles = words.filter("word <> ''").select("word", "count", F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"))
    roles = roles.withColumn("n", F.length("word") - F.col("longer").cast("int"))

    def halves(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
        middle = F.floor((lo + hi) / 2)
        at = rows.select("word", "count", "n", "longer", F.explode(F.array(
            F.struct(lo.alias("a"), middle.alias("b")), F.struct(middle.alias("a"), hi.alias("b")))).alias("w")).filter("w.a < w.b")
        return _cut(at, F.col("w.a"), F.col("w.b"))

    now, out = halves(roles, F.lit(0), F.col("n") + 1), None
    while True:
        big = now.filter("hi - lo > 1").groupBy(*_KEY).agg(F.count("*").alias("rows"), F.max(F.length("body")).alias("chars"))
        big = materialise(big.filter((F.col("rows") > 1) & ((F.col("rows") > most_words) | (F.col("chars") > most_chars))).select(*_KEY), "spelling-big")
        whole = big.isEmpty()
        done = now if whole else now.join(big, _KEY, "left_anti")
        out = done if out is None else out.unionByName(done)
        if whole:
            return out
        now = materialise(halves(now.join(big, _KEY, "left_semi"), F.col("lo"), F.col("hi")), "spelling-halves")


def near_pairs(words: DataFrame, most_words: int = MOST_WORDS, most_chars: int = MOST_CHARS) -> DataFrame:
    """``(u, v, u_count, v_count)``: every two of ``words`` (word, count; distinct) one edit apart, once."""
    def enumerate_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, found = ("u", "v", "u_count", "v_count"), []

        def flush(key: tuple, bodies: tuple[dict, dict]) -> None:
            shorter, longer = bodies
            if not shorter or len(shorter) + len(longer) < 2:
                return
            n, _, hi, head, tail = key
            for a, b in near_bodies(list(shorter), list(longer), hi > n):
                found.append((head + a + tail, head + b + tail, shorter[a], longer[b] if len(b) > len(a) else shorter[b]))

        def table() -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [()] * 4
            types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], list(names))

        now, bodies = None, ({}, {})
        for b in batches:
            columns = [b.column(c).to_pylist() for c in (*_KEY, "longer", "body", "count")]
            for *key, longer, body, count in zip(*columns):
                if key != now:
                    if now is not None:
                        flush(now, bodies)
                    now, bodies = key, ({}, {})
                bodies[longer][body] = count
            if len(found) > 1 << 16:
                yield table()
                found.clear()
        if now is not None:
            flush(now, bodies)
        yield table()

    rows = partitions(words, most_words, most_chars).repartition(*_KEY).sortWithinPartitions(*_KEY)
    return rows.mapInArrow(enumerate_pairs, "u string, v string, u_count long, v_count long")


def count_words(occurrences: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, count)`` of the words of ``occurrences`` (word, a row each) that are long and frequent enough."""
    long_enough = occurrences.filter(F.length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("count")).filter(F.col("count") >= min_count)


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms`` (word, form): forms followed to the last, by doubling the
    steps. A form is more frequent than its word, so there is no cycle."""
    now, turn = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots-0"), 0
    while True:
        further = now.select(F.col("word").alias("via"), F.col("root").alias("next"))
        if now.join(further, F.col("root") == F.col("via"), "left_semi").isEmpty():
            return now
        turn += 1
        now = materialise(now.join(further, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("next", "root").alias("root")), f"spelling-roots-{turn}")


def group_variants(occurrences: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``occurrences`` (word, a row each).

    Words of at least ``min_length`` code points and ``min_count`` occurrences (n) count, null
    ones don't. Two are near if they differ by exactly one inserted, deleted or replaced code
    point. The form is the near word of largest n (ties: smallest in code-point order), if
    that n is at least ``ratio`` (2 or more) times the word's own; else null. The root is the
    last form when forms are followed, the word itself if it has none. No words give no rows.
    """
    words = materialise(count_words(occurrences.select("word"), min_length, min_count), "spelling-words")
    pairs = near_pairs(words)
    sides = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("v_count").alias("near_n")),
                                           F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("u_count").alias("near_n")))).alias("s"))
    best = sides.select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    joined = words.join(best, "word", "left").withColumn("taken", -F.col("best.n") >= ratio * F.col("count"))
    chosen = materialise(joined.select("word", F.when(F.col("taken"), F.col("best.near")).alias("form"), F.col("count").alias("n"),
                                       F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                       F.when(F.col("taken"), -F.col("best.n")).alias("form_n")), "spelling-forms")
    roots = last_forms(chosen.filter("form is not null"))
    return chosen.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
