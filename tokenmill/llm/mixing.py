"""Mixing sources to target weights with Sainte-Lague apportionment.

1. Targets. Sources, by code point and null last, weigh 1, 2, 3 and again. They
   share all words by weight; a source's target stops at ``max_repeat`` times its
   size and the excess is shared again by weight until no target is above.
2. Quotas. The mix is a sequence of ``n_shards * blocks_per_shard`` blocks of equal
   size. If they leave a source off its target by more than one part in ``MIN_BLOCKS``
   (and a word), blocks are halved until the smallest positive target has that many or
   a block is about a word. Block after block goes to the source with the highest
   quotient ``target / (2 * blocks so far + 1)``; the blocks of shard s are the s-th
   part of that sequence, so every shard has integer quotas and all shards together
   are apportioned too. Blocks that a source has in any case are computed, so the
   rows compared are a few per source, however many blocks there are.
3. Selection. The seeded order of a source's documents (MD5 of seed and id) deals
   its words into blocks; a quota of q takes blocks 0 to q - 1 and goes around
   again after the last one. The end of a block may cut a document.

Nothing gathers a source in one task: word offsets are two running sums, one
inside (source, bucket of the seeded order) and one over the at most 4096 bucket
totals of a source. Sources are summaries of one row each.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, packed, token_count, unpacked
from .sharding import document_key

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
N_SHARDS = 16
BLOCKS_PER_SHARD = 256
#: Targets are met up to one part in so many, or about a word.
MIN_BLOCKS = 16
SEED = "mix-1"
#: Hex digits of the seeded order that make a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sizes`` (source, source_size; one row a source) with ``rank``, ``weight``, ``target``, ``total``.

    Integer arithmetic decides which sources are capped: in the order of size per
    weight they are a prefix, the sources whose cap is at most their share of what
    the capped ones before them leave.
    """
    every = Window.partitionBy(F.lit(0))
    ranked = (sizes
              .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                 (F.col("rank") - 1) % len(weights) + 1).cast("long"))
              .withColumn("total", F.sum("source_size").over(every)))
    before = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("rank")).rowsBetween(
        Window.unboundedPreceding, -1)
    big = "decimal(25,0)"
    n = F.lit(max_repeat)
    capped = (F.col("source_size").cast(big) * n * (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              <= F.col("weight") * (F.col("total") - n * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast(big))
    marked = ranked.withColumn("capped", capped)
    free = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), n * F.col("source_size"))).over(every), F.lit(0))
    free_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    return (marked
            .withColumn("free", free.cast("long")).withColumn("free_weight", free_weight)
            .withColumn("target", F.when(F.col("capped"), (n * F.col("source_size")).cast("double"))
                        .otherwise((F.col("weight") * F.col("free")).cast("double") / F.col("free_weight")))
            .select("source", "source_size", "rank", "weight", "target", "total"))


def apportioned(targets: DataFrame, houses: Column) -> DataFrame:
    """``(house, source, rank, quota)``: blocks of each source, for each number of blocks in the array ``houses``.

    A source's k-th block has the quotient target / (2k - 1). With S sources and H
    blocks none gets more than target * (H + S/2) / total + 1/2 or, up to rounding,
    less than target * (H - S/2) / total - 1/2; only the blocks between are compared,
    some 5S rows.
    """
    every = Window.partitionBy("house")
    share = F.col("target") / F.col("total")
    sure = F.greatest(F.floor(share * (F.col("house") - F.col("n") / 2) + 0.5) - 1, F.lit(0).cast("long"))
    most = F.floor(share * (F.col("house") + F.col("n") / 2) + 0.5) + 1
    order = Window.partitionBy("house").orderBy(F.col("quotient").desc(), F.col("rank"), F.col("k"))
    return (targets.filter("target > 0").withColumn("house", F.explode(houses))
            .withColumn("n", F.count("*").over(every))
            .withColumn("sure", sure).withColumn("left", F.col("house") - F.sum("sure").over(every))
            .withColumn("k", F.explode(F.sequence(F.col("sure") + 1, F.greatest(most, F.col("sure") + 1))))
            .withColumn("quotient", F.col("target") / (2 * F.col("k") - 1))
            .withColumn("won", (F.row_number().over(order) <= F.col("left")).cast("long"))
            .groupBy("house", "source", "rank").agg((F.max("sure") + F.sum("won")).alias("quota")))


def shard_quotas(targets: DataFrame, n_shards: int = N_SHARDS,
                 blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """``(shard, source, rank, quota)``: blocks that each shard takes from each source,
    what the shards up to it take less what those before it do."""
    houses = F.sequence(*[F.lit(x).cast("long") for x in (blocks_per_shard, n_shards * blocks_per_shard, blocks_per_shard)])
    before = F.coalesce(F.lag("quota").over(Window.partitionBy("rank").orderBy("house")), F.lit(0))
    return (apportioned(targets, houses).withColumn("quota", F.col("quota") - before).filter("quota > 0")
            .select((F.col("house") / blocks_per_shard - 1).cast("int").alias("shard"), "source", "rank", "quota"))


def fine_blocks(targets: DataFrame, n_shards: int = N_SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD) -> int:
    """Blocks a shard: doubled until the smallest positive target has ``MIN_BLOCKS``, or blocks are about a word.

    With S sources, H blocks and ``MIN_BLOCKS`` for the smallest target, S is at most
    H / ``MIN_BLOCKS``: rounding and the share taken by other sources' rounding
    (``apportioned``) are each at most half of one part in ``MIN_BLOCKS``.
    """
    least, total = targets.filter("target > 0").agg(F.min("target"), F.max("total")).first()
    fine = max(blocks_per_shard, (total or 0) // n_shards)
    while least is not None and least * n_shards * blocks_per_shard < MIN_BLOCKS * total and blocks_per_shard < fine:
        blocks_per_shard = min(2 * blocks_per_shard, fine)
    return blocks_per_shard


def source_plan(targets: DataFrame, max_repeat: int = MAX_REPEAT, n_shards: int = N_SHARDS,
                blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """``targets`` with ``take``, the words that the mix takes from each source."""
    def plan(blocks: int) -> DataFrame:
        quotas = apportioned(targets, F.array(F.lit(blocks).cast("long"))).select("rank", "quota")
        # quota * total may be beyond a long
        take = F.expr(f"(cast(coalesce(quota, 0L) as decimal(19,0)) * cast(total as decimal(19,0))) div cast({blocks} as decimal(19,0))")
        return materialise(targets.join(quotas, "rank", "left").withColumn(
            "take", F.least(F.col("source_size") * max_repeat, take)).drop("quota"), "mix-plan")

    out = plan(n_shards * blocks_per_shard)
    off = F.abs(F.col("take") - F.col("target")) > F.greatest(F.lit(1.0), F.col("target") / MIN_BLOCKS)
    fine = blocks_per_shard if out.filter(off).isEmpty() else fine_blocks(out, n_shards, blocks_per_shard)
    return out if fine == blocks_per_shard else plan(n_shards * fine)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, n_shards: int = N_SHARDS,
                blocks_per_shard: int = BLOCKS_PER_SHARD, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` (its source's) and ``taken``.

    ``taken`` counts the words that the mix takes from the row, repeats counted,
    at most ``max_repeat`` times its size. Null texts have size 0 and are never
    taken; null sources are one source, the last; rows with a null id or equal ids
    are ordered by their text and each counts; an empty table stays empty; input
    columns named like an output are replaced.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), document_key(F.col(id_col), F.col(text_col))))
    # A null source gets a key of its own, so that plain equality can join it.
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    rows = packed(docs, token_count(F.col(text_col)).alias("__size"), order.alias("__order"), key.alias("__source"),
                  F.substring(order, 1, BUCKET_DIGITS).alias("__bucket"), F.xxhash64(F.col(text_col)).alias("__tie"))
    totals = materialise(rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("words")), "mix-totals")

    sizes = totals.groupBy("__source").agg(F.sum("words").alias("source_size")).select(
        "__source", F.when(F.col("__source") != "", F.substring("__source", 2, 2 ** 31 - 1)).alias("source"),
        "source_size")
    targets = source_targets(sizes.select("source", "source_size"), weights, max_repeat)
    plan = source_plan(targets, max_repeat, n_shards, blocks_per_shard).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("__source"), "source_size", "target", "take")

    start = F.coalesce(F.sum("words").over(
        Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = (totals.withColumn("__start", start).drop("words").join(plan, "__source")
               .select(F.col("__source").alias("__b_source"), F.col("__bucket").alias("__b_bucket"), "__start",
                       F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                       F.col("take").alias("__take")))
    inside = (Window.partitionBy("__source", "__bucket")
              .orderBy("__order", "__tie", "__size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0))).join(
        buckets, (F.col("__source") == F.col("__b_source")) & (F.col("__bucket") == F.col("__b_bucket")))
    first = F.col("__start") + F.col("__before")
    passes = F.floor(F.col("__take") / F.col("__source_size"))
    rest = F.col("__take") - passes * F.col("__source_size")
    part = F.greatest(F.least(first + F.col("__size"), rest) - first, F.lit(0))
    taken = F.when(F.col("__size") > 0, passes * F.col("__size") + part).otherwise(0).cast("long")
    return unpacked(placed, docs, size=F.col("__size"), source_size=F.col("__source_size"), target=F.col("__target"),
                    taken=taken)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **kw) -> DataFrame:
    """The mix as rows of ``docs``: every document as often as its words are taken.

    A document that a block's end cuts counts as taken if at least half of its
    words are; documents without words are not part of a mix.
    """
    mixed = mix_sources(packed(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                               F.col(source_col).alias("source")), "id", "text", "source", **kw)
    times = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    each = mixed.filter("size > 0").select("__row", times.alias("times")).filter("times > 0")
    return unpacked(each.select("__row", F.explode(F.sequence(F.lit(1), "times"))), docs)
