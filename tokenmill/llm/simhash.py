"""SimHash near-duplicates compared on bit planes.

A fingerprint has bit b set if more than half of the text's word shingles have it
set in their 64-bit hash. Two fingerprints link if they differ in at most
``RADIUS`` bits; documents are grouped by the components of these links.

Candidates. The 64 bits are cut into eight bytes. Two fingerprints at distance two
or less agree on at least six bytes, so they meet under one of the 28 keys that
leave two bytes out. A key fixes 48 bits: a bucket holds 65,536 distinct
fingerprints at most, whatever the corpus, and needs no cap. Equal fingerprints
are one row here, so copies cost nothing.

Comparison. A bucket is stored vertically, one bit plane per bit position with 64
fingerprints to a machine word. A query's difference to all of them is one XOR per
plane, added to bitwise counters with carries; blocks of words whose lanes all
exceed the radius are abandoned. A bucket gives one link from each member to the
smallest of its group there, not its pairs.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, packed, unpacked
from .components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Planes between two looks at which blocks of lanes still matter.
LOOK_EVERY = 8
#: Counter words that one batch of queries may use.
BATCH_WORDS = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as an unsigned integer; 0 without words."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and space with tab to CR.
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, ws), np.int64, len(ws))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:len(ws) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    votes = np.zeros(64, np.int64)
    h = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        votes += np.unpackbits(h[at:at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long (the same 64 bits)."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64))
    return run(text)


def close_pairs(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of the unsigned fingerprints at most ``radius`` bits apart."""
    n = len(fps)
    varying = int(np.bitwise_or.reduce(fps) ^ np.bitwise_and.reduce(fps)) if n else 0
    bits = [b for b in range(64) if varying >> b & 1]
    words = (n + 63) // 64
    planes = []
    for b in bits:
        packed = np.zeros(words * 8, np.uint8)
        on = np.packbits((fps >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little")
        packed[:len(on)] = on
        planes.append(packed.view("<u8"))
    lanes = np.zeros(words * 64, np.uint8)
    lanes[n:] = 1
    unused = np.packbits(lanes, bitorder="little").view("<u8")
    digits = max(1, radius.bit_length())
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    left, right = [], []
    step = max(1, BATCH_WORDS // max(1, words))
    for at in range(0, n, step):
        q = fps[at:at + step]
        first = at // 64  # pairs with earlier fingerprints are found from their side
        cols = np.arange(first, words)
        counters = [np.zeros((len(q), len(cols)), np.uint64) for _ in range(digits)]
        over = np.repeat(unused[None, first:], len(q), axis=0)

        def beyond():
            """Lanes whose count is above the radius."""
            more, same = over.copy(), ~over
            for t in reversed(range(digits)):
                if radius >> t & 1:
                    same &= counters[t]
                else:
                    more |= same & counters[t]
                    same &= ~counters[t]
            return more

        for k, b in enumerate(bits):
            mine = np.where(q >> np.uint64(b) & np.uint64(1), ones, np.uint64(0))
            carry = planes[k][cols][None, :] ^ mine[:, None]
            for t in range(digits):
                counters[t], carry = counters[t] ^ carry, counters[t] & carry
            over |= carry
            if k % LOOK_EVERY == LOOK_EVERY - 1 and len(cols) > 1:
                live = (beyond() != ones).any(axis=0)
                if not live.all():
                    cols, over = cols[live], over[:, live]
                    counters = [c[:, live] for c in counters]
                    if not len(cols):
                        break
        if not len(cols):
            continue
        near = ~beyond()
        rows, at_word = np.nonzero(near)
        if len(rows):
            found = np.unpackbits(near[rows, at_word][:, None].view(np.uint8), axis=1, bitorder="little")
            hit, lane = np.nonzero(found)
            i, j = rows[hit] + at, cols[at_word[hit]] * 64 + lane
            keep = j > i
            left.append(i[keep])
            right.append(j[keep])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def bucket_links(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """``(member, smallest of its group)`` within one bucket of distinct longs."""
    values = np.sort(np.asarray(values, np.int64))
    i, j = close_pairs(values.view(np.uint64), radius)
    label = np.arange(len(values))
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    while (label[label] != label).any():
        label = label[label]
    moved = np.nonzero(label != np.arange(len(values)))[0]
    return values[moved], values[label[moved]]


def masks(radius: int = RADIUS) -> list[int]:
    """Signed masks of the keys: all bytes but ``radius`` ones."""
    out = []
    for skip in combinations(range(8), radius):
        m = sum(0xFF << 8 * b for b in range(8) if b not in skip)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(u, v)`` links that span the groups of the distinct longs in column ``fp``."""
    if not 1 <= radius <= 2:
        raise ValueError("the keys bound their buckets for a radius of 1 or 2")
    keys = F.array(*[F.struct(F.lit(k).cast("tinyint").alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for k, m in enumerate(masks(radius))])
    buckets = (fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.band", "k.key")
               .groupBy("band", "key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps"))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [bucket_links(v, radius) for v in batch["fps"]]
            yield pd.DataFrame({"u": np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]),
                                "v": np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])})

    return buckets.mapInPandas(link, "u long, v long").distinct()


def fingerprint_groups(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(node, root)``: the group's smallest fingerprint for every other one linked to it."""
    return connected_components(fingerprint_links(fps.select("fp").distinct(), radius))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links. Null and wordless texts
    have fingerprint zero and link like any other; rows with a null id are members,
    and where a component has no id at all its ``component_id`` is null; repeated rows
    stay; an empty table stays empty.
    """
    fps = materialise(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")),
                      "simhash-fps")
    low = fps.groupBy("fp").agg(F.min("id").alias("low"))
    groups = fingerprint_groups(low, radius)
    rooted = low.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "simhash-roots")
    comps = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = materialise(rooted.join(comps, "root").select("fp", "component_id"), "simhash-components")
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` per component: the smallest id, null ids last; ties by text hash."""
    rows = materialise(packed(docs, fingerprint_column(F.col(text_col), shingle).alias("__fp"),
                              F.monotonically_increasing_id().alias("__at")), "simhash-rows")
    # What decides, narrow: the row numbers are fixed by the written table.
    given, text = F.col("__row").getField(id_col), F.col("__row").getField(text_col)
    order = F.struct(given.isNull().alias("no_id"), given.alias("id"), F.xxhash64(text).alias("h"), F.col("__at").alias("row"))
    narrow = materialise(rows.select(F.col("__fp").alias("fp"), order.alias("o")), "simhash-narrow")
    low = narrow.groupBy("fp").agg(F.min("o").alias("low"))
    groups = fingerprint_groups(low, radius)
    rooted = low.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    stays = rooted.groupBy("root").agg(F.min("low")["row"].alias("row")).select("row")
    gone = materialise(narrow.select(F.col("o.row").alias("row")).join(stays, "row", "left_anti"), "simhash-gone")
    return unpacked(rows.join(gone, F.col("__at") == F.col("row"), "left_anti"), docs)
