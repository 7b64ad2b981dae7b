"""Joins whose broadcast side is size-checked, and joins that do not gather a frequent key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we broadcast on purpose; beyond it the join shuffles and
# AQE may still switch to a broadcast from measured sizes, or split skew.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   dim_rows: int | None = None, dim_bytes: int | None = None,
                   max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a fact frame with a dimension. The dimension is broadcast only when
    its exact row count and payload size are known (e.g. measured by
    `dense_ids`) and both are within bounds; otherwise a shuffle join is
    planned (AQE may still broadcast from measured sizes or split skew)."""
    if dim_rows is not None and dim_bytes is not None and dim_rows <= max_rows and dim_bytes <= max_bytes:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


#: Frequent keys that leave a split join, per shuffle partition. A key beyond them holds
#: less than 1 / (HEAVY_PER_PARTITION * partitions) of the rows, a fraction of one task's share.
HEAVY_PER_PARTITION = 4
#: Places over which the rows of a frequent key are dealt.
SALTS = 1 << 20


def join_split(fact: DataFrame, dim: DataFrame, key: str, weight: str, how: str = "left",
               heavy: int | None = None) -> DataFrame:
    """`fact` with the columns of `dim` (one row per `key`, NULL is a key of its own), joined so that
    no key gathers its rows in one task, with or without adaptive execution.

    `weight` is a column of `dim`: how many fact rows hold its key, as the aggregate that made `dim`
    has counted. The `heavy` keys of largest weight (default: HEAVY_PER_PARTITION for each shuffle
    partition, so their number is known) are broadcast with their values. Fact rows that have
    found their value there take part in the shuffle join under a salt that no row of `dim` has,
    so they are dealt over all tasks; every other row joins as usual. Both joins are in one
    plan: `fact` is read once and shuffled once. `weight` is dropped, `how` is "left" or "inner"."""
    if how not in ("left", "inner"):
        raise ValueError("join_split joins left or inner")
    spark = fact.sparkSession
    k = heavy if heavy is not None else HEAVY_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in dim.columns if c not in (key, weight)]
    values = F.struct(F.lit(True).alias("__found"), *[F.col(f"`{c}`") for c in names])
    side = dim.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{weight}`").alias("__weight"), values.alias("__value"))
    top = side.orderBy(F.col("__weight").desc(), "__key").limit(k).select(
        F.col("__key").alias("__heavy"), F.col("__value").alias("__heavy_value"))
    marked = fact.join(F.broadcast(top), fact[key].eqNullSafe(F.col("__heavy")), "left").withColumn(
        "__salt", F.when(F.col("__heavy_value.__found"), F.pmod(F.xxhash64(*[fact[c] for c in fact.columns]), F.lit(SALTS)) + 1)
        .otherwise(F.lit(0)))
    # a weight is never negative; a plain 0 would be folded into the condition and leave the join's keys
    rest = side.withColumn("__zero", F.least(F.col("__weight"), F.lit(0)).cast("long"))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__zero"))
    joined = marked.join(rest, same, "left").withColumn("__value", F.coalesce("__heavy_value", "__value"))
    if how == "inner":
        joined = joined.where(F.col("__value.__found"))
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], *[F.col(f"__value.`{c}`").alias(c) for c in names])
