"""Imputation values: group means (F1/F2), global median (D2/E4), global mean.

The reference takes group means with `avg(..).over(Window.partitionBy(key))`
and the global mean with an empty-partition window. Both put a whole group
(or the whole table) into one task. Here a group mean is a hash aggregate
(partial aggregation map-side, so a key holding a third of the rows is reduced
before the shuffle) joined back on the key; AQE turns the join into a
broadcast when the measured aggregate is small. The silver jobs join back by
`join_split`: the aggregate counts its rows, and the most frequent keys leave the
shuffle join, so a hot key is dealt over all tasks with or without AQE. Global values are scalar subqueries: one partial aggregate per
task, one row at the end, folded into the projection without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.joins import join_split


def group_means(df: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """One row per distinct `key` (NULL is its own group) with avg of each value."""
    return df.groupBy(key).agg(*[F.avg(v).alias(name) for name, v in values.items()])


def attach_group_means(df: DataFrame, key: str, values: dict[str, Column],
                       source: DataFrame | None = None, split: bool = False) -> DataFrame:
    """`df` plus one column per entry of `values`: the mean of that expression
    over the rows of `source` (default `df`) sharing `key` (window-mean
    semantics, NULL keys form a group). `split` takes the frequent keys out of
    the shuffle join (`join_split`) instead of leaving them to AQE."""
    source = df if source is None else source
    if split:
        means = source.groupBy(key).agg(*[F.avg(v).alias(name) for name, v in values.items()],
                                        F.count(F.lit(1)).alias("__rows"))
        return join_split(df, means, key, "__rows")
    means = group_means(source, key, values).withColumnRenamed(key, "__mean_key")
    joined = df.join(means, df[key].eqNullSafe(means["__mean_key"]), "left")
    return joined.drop("__mean_key")


def global_value(df: DataFrame, agg: Column) -> Column:
    """A one-value aggregate of `df` as a lazily evaluated scalar Column."""
    return df.select(agg).scalar()


def approx_median(c: Column, accuracy: int = 10000) -> Column:
    """Median as `percentile_approx(c, 0.5)`: a value of the column."""
    return F.percentile_approx(c, 0.5, accuracy)
