"""Scans over long sequences that are cut into chunks.

What a chunk does to the state of a left-to-right scan is summarised by a function of the
state that reaches it. For greedy picking (take a candidate unless the one before it was
taken) the state is one bit, "the last element was taken", and a chunk's function either
fixes the bit or keeps or flips the bit that comes in. Such functions compose
associatively, so the state before every chunk is a running composition: inside groups of
``GROUP`` chunks, then over the groups. No task holds a whole sequence, and after that
every chunk is scanned on its own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Chunks whose summaries are composed in one task.
GROUP = 4096


def _group(order: str, size: int) -> Column:
    return F.floor(F.col(order) / size).cast("long").alias("__group")


def neighbour_edges(chunks: DataFrame, keys: list[str], order: str, group: int | None = None) -> DataFrame:
    """``chunks`` (keys…, order, first, last) with ``next_first`` and ``prev_last``, the edges of the
    chunks after and before it in its sequence (null at the ends)."""
    s = chunks.withColumn("__group", _group(order, group or GROUP))
    groups = s.groupBy(*keys, "__group").agg(F.min_by("first", order).alias("g_first"), F.max_by("last", order).alias("g_last"))
    over = Window.partitionBy(*keys).orderBy("__group")
    renamed = [F.col(k).alias(f"__{k}") for k in keys]
    groups = groups.select(*renamed, F.col("__group").alias("__g"), F.lead("g_first").over(over).alias("after"), F.lag("g_last").over(over).alias("before"))
    o = Window.partitionBy(*keys, "__group").orderBy(order)
    near = s.select("*", F.lead("first").over(o).alias("near_first"), F.lag("last").over(o).alias("near_last"))
    same = F.col("__group") == F.col("__g")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return near.join(groups, same).select(*chunks.columns, F.coalesce("near_first", "after").alias("next_first"),
                                          F.coalesce("near_last", "before").alias("prev_last"))


def states_before(chunks: DataFrame, keys: list[str], order: str, group: int | None = None) -> DataFrame:
    """``chunks`` (keys…, order, fixed, flips) with ``state``, the bit that reaches each chunk; 0 at the
    start of a sequence.

    ``fixed``: the bit after the chunk whatever comes in, or null; then ``flips`` is 1 if
    the chunk turns the incoming bit over, 0 if it keeps it.
    """
    def running(df: DataFrame, w) -> DataFrame:
        """``known`` and ``turned``: the composition of all rows before, a fixed bit or null, then a flip."""
        df = df.withColumn("__all", F.pmod(F.sum("flips").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(2)))
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        last = F.last(F.col("fixed").bitwiseXOR(F.col("__all")), ignorenulls=True).over(before)
        turned = F.pmod(F.col("__all") + F.col("flips"), F.lit(2))
        return df.withColumn("turned", turned).withColumn("known", last.bitwiseXOR(turned))

    bits = chunks.withColumn("fixed", F.col("fixed").cast("long")).withColumn(
        "flips", F.when(F.col("fixed").isNull(), F.col("flips")).otherwise(0).cast("long")).withColumn("__group", _group(order, group or GROUP))
    inside = running(bits, Window.partitionBy(*keys, "__group").orderBy(order))
    # The function of a group: that of its last chunk after what comes before it there.
    fixed = F.coalesce("fixed", F.col("known").bitwiseXOR(F.col("flips")))
    groups = inside.groupBy(*keys, "__group").agg(F.max_by(fixed, order).alias("fixed"), F.pmod(F.sum("flips"), F.lit(2)).alias("flips"))
    groups = running(groups.withColumn("flips", F.when(F.col("fixed").isNull(), F.col("flips")).otherwise(0).cast("long")),
                     Window.partitionBy(*keys).orderBy("__group"))
    reach = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__group").alias("__g"), F.coalesce("known", "turned").alias("reach"))
    same = F.col("__group") == F.col("__g")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return inside.join(reach, same).select(*chunks.columns, F.coalesce("known", F.col("reach").bitwiseXOR(F.col("turned"))).alias("state"))
