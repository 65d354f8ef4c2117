"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: the sources share a number of words by weight, but none gets more than MOST times its own size; what is cut off
goes to the others by weight, until none is above. In one ordering by size over weight the cut sources come first, so
running sums find the level without a loop.

Blocks: a source's texts are dealt to shards of about SHARD_ROWS rows by seeded hash, and stand in each shard in seeded
order. A source is taken whole as often as its target holds it, counted in words. Only the rest is apportioned, in blocks of BLOCK words (texts
may span blocks; a source of few words has smaller ones, FEW at least): a shard's votes are its part of the rest, and a block goes to the
highest quotient votes / (2 * seats + 1). The divisor form of the method, with the block as its divisor, gives each shard
round(votes / block) blocks; then the shards with the next highest quotients get one more, or those with the lowest give one back, until
the source has round(rest / block). A shard takes its blocks as a run of words, round the end, that starts at a block drawn by hash.
As the order is a seeded shuffle, such a run is a random choice of texts.

Null texts have size 0 and nothing is taken of them. A null source is a source of its own, last in order. Texts with the
same id and text are alike in order; each is counted. No row is dropped: taken says how many words of it the mix uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 32
FEW = 32
SHARD_ROWS = 1_000
SEED = 7


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0) -> DataFrame:
    """source_size, rows and target of each source (__source, __size in; one row per source out).

    The windows without partition run over one row per source.
    """
    every = Window.orderBy(F.col("__source").asc_nulls_last())
    per = sizes.groupBy("__source").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("__rows"))
    place = (F.row_number().over(every) - 1) % len(weights)
    per = per.withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("__weight"), F.col("__source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * F.lit(share)
    # The level if all sources before this one are cut and this one and the later ones are not.
    level = (total - F.coalesce(F.sum(F.lit(MOST) * F.col("source_size")).over(before), F.lit(0))) / (
        F.sum("__weight").over(whole) - F.coalesce(F.sum("__weight").over(before), F.lit(0)))
    leveled = per.withColumn("__level", level).withColumn("__cut", F.lit(MOST) * F.col("source_size") < F.col("__level") * F.col("__weight"))
    open_level = F.min(F.when(~F.col("__cut"), F.struct(F.col("source_size") / F.col("__weight"), F.col("__level").alias("level")))).over(whole)["level"]
    target = F.when(F.col("__cut"), F.lit(float(MOST)) * F.col("source_size")).otherwise(F.col("__weight") * open_level)
    return leveled.select("__source", "source_size", "__rows", F.least(target, F.lit(float(MOST)) * F.col("source_size")).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: float = 1.0, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """One row per row of df: id_col, size, source_size, target, taken."""
    sizes = saved(df.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), word_count(F.col(text_col)).alias("__size")), "sizes")
    goal = saved(targets(sizes, weights, share), "targets")
    rows = sizes.join(goal, sizes["__source"].eqNullSafe(goal["__source"]), "left").drop(goal["__source"])
    key = F.xxhash64(F.lit(seed), F.col("__id"), F.col("__source"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("__rows") / SHARD_ROWS))
    rows = rows.select("*", key.alias("__key")).withColumn("__shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("__key")), shards))
    line = Window.partitionBy("__source", "__shard").orderBy("__key", "__id", "__size")
    end = F.sum("__size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__end", end).withColumn("__from", F.col("__end") - F.col("__size"))
    joined = rows.join(_runs(rows, seed, block), F.col("__source").eqNullSafe(F.col("__of")) & (F.col("__shard") == F.col("__in")))

    def overlap(start, stop):
        return F.greatest(F.lit(0), F.least(F.col("__end"), stop) - F.greatest(F.col("__from"), start))

    stop = F.col("__start") + F.col("__length")
    run = overlap(F.col("__start"), F.least(stop, F.col("__all")))
    again = overlap(F.lit(0), stop - F.col("__all"))
    taken = (F.col("__full") * F.col("__size") + run + again).cast("long")
    return joined.select(F.col("__id").alias(id_col), F.col("__size").alias("size"), "source_size", "target", taken.alias("taken"))


def _runs(rows: DataFrame, seed: int, block: int) -> DataFrame:
    """Of each shard (__of, __in): __all (its words), __full (how often all are taken), __start and __length of its run. The window holds one row per shard."""
    shards = rows.groupBy("__source", "__shard", "source_size", "target").agg(F.sum("__size").alias("__all"))
    some = F.col("source_size") > 0
    full = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    shards = shards.withColumn("__full", full).withColumn("__block", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("source_size") / FEW))))
    shards = shards.withColumn("__rest", F.greatest(F.lit(0.0), F.col("target") - F.col("__full") * F.col("source_size")))
    votes = F.when(some, F.col("__rest") * F.col("__all") / F.col("source_size")).otherwise(F.lit(0.0))
    shards = shards.withColumn("__votes", votes).withColumn("__seats", F.floor(votes / F.col("__block") + 0.5))
    source = Window.partitionBy("__source")
    missing = F.floor(F.col("__rest") / F.col("__block") + 0.5) - F.sum("__seats").over(source)
    more = F.row_number().over(source.orderBy((F.col("__votes") / (2 * F.col("__seats") + 1)).desc(), "__shard"))
    given = F.when(F.col("__seats") > 0, F.col("__votes") / (2 * F.col("__seats") - 1))
    less = F.row_number().over(source.orderBy(given.asc_nulls_last(), "__shard"))
    shards = shards.withColumns({"__missing": missing, "__more": more, "__less": less})
    change = F.when(F.col("__more") <= F.col("__missing"), 1).when(F.col("__less") <= -F.col("__missing"), -1).otherwise(0)
    seats = F.greatest(F.lit(0), F.col("__seats") + change)
    blocks = F.ceil(F.col("__all") / F.col("__block"))
    start = F.when(blocks > 0, F.pmod(F.xxhash64(F.lit(seed + 2), F.col("__source"), F.col("__shard")), blocks) * F.col("__block")).otherwise(F.lit(0))
    return shards.select(F.col("__source").alias("__of"), F.col("__shard").alias("__in"), "__all", "__full", start.alias("__start"),
                         F.least(seats * F.col("__block"), F.col("__all")).alias("__length"))
