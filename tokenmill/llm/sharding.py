"""Placement of documents by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime
size: ``offset + j * skip (mod size)``, a permutation because the size is prime.
Shards take turns; at its turn a shard claims the first free slot of its order.
A document's key hashes to a slot, and the slot names the shard. Adding or
removing a shard moves few slots, and shards differ by one slot at most.

The table has ``size`` entries, a parameter, so it is broadcast and a placement
is one lookup in a dense array; documents are never shuffled.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, unpacked

SIZE = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _hash60(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def preference(shard: str, size: int) -> tuple[int, int]:
    """``(offset, skip)`` of a shard's preference order."""
    return _hash60(f"offset:{shard}") % size, _hash60(f"skip:{shard}") % (size - 1) + 1


def lookup_table(shards: list[str], size: int = SIZE) -> list[int]:
    """For each slot the index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime")
    if size < len(shards):
        raise ValueError("the table needs a slot for each shard")
    orders = [preference(s, size) for s in shards]
    step = [0] * len(shards)
    owner = [-1] * size
    for claim in range(size):
        i = claim % len(shards)
        offset, skip = orders[i]
        while owner[(offset + step[i] * skip) % size] >= 0:
            step[i] += 1
        owner[(offset + step[i] * skip) % size] = i
    return owner


def slot_of(key: Column, size: int) -> Column:
    """Slot of a string key: the first 60 bits of its MD5, modulo the size."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(size))


def document_key(id_col: Column, text: Column) -> Column:
    """A document's key: its id, or, where that is null, its text, so that rows
    without an id don't all fall on one shard."""
    return F.coalesce(id_col.cast("string"), F.concat(F.lit("text:"), F.md5(text)), F.lit("null"))


def _table_rows(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    owners = ",".join(map(str, lookup_table(shards, size)))
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(owners), ",")).alias("__slot", "__owner")).select(
        F.col("__slot").cast("long"), F.col("__owner").cast("int"))


def assign_shards(df: DataFrame, key: Column, shards: list[str] | tuple[str, ...] = SHARDS,
                  size: int = SIZE) -> DataFrame:
    """Every row of ``df`` with ``slot`` (long) and ``shard`` (int, index into ``shards``).

    ``key`` is a string column. A null key counts as the empty string; equal keys
    (repeated rows) get equal shards; an empty table stays empty; input columns
    called ``slot`` or ``shard`` are replaced.
    """
    lut = F.broadcast(_table_rows(df.sparkSession, list(shards), size))
    keyed = packed(df, slot_of(F.coalesce(key, F.lit("")), size).alias("__at"))
    joined = keyed.join(lut, F.col("__at") == F.col("__slot"))
    return unpacked(joined, df, slot=F.col("__slot"), shard=F.col("__owner"))
