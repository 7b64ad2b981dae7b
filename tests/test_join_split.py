"""Joins that deal a frequent key over all tasks, without adaptive execution."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from quire.operators.ids import Numbered
from quire.operators.impute import attach_group_means
from quire.operators.joins import join_split
from quire.plans import gold

SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}


@pytest.fixture()
def plain(spark):
    """The session without adaptive execution and without broadcasts by size."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def skewed(spark, hot):
    """60,000 rows, a third of them on the key `hot`, a ninth on the key 'second'."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).when(F.col("id") % 9 == 1, F.lit("second")) \
        .otherwise((F.col("id") % 5000).cast("string"))
    return spark.range(60_000).select(F.col("id").alias("i"), key.alias("k"), (F.col("id") % 7).alias("v"))


def rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.mark.parametrize("hot", ["null", None])
def test_no_task_holds_twice_the_median(plain, hot):
    df = skewed(plain, hot)
    out = attach_group_means(df, "k", {"m": F.col("v")}, split=True).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * median(sizes)
    means = df.groupBy("k").agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    plainly = df.alias("f").join(means.alias("d"), F.expr("f.k <=> d.k")).withColumn("p", F.spark_partition_id())
    hot_sizes = [r["count"] for r in plainly.groupBy("p").count().collect()]
    assert max(hot_sizes) > 5 * median(hot_sizes)  # what the split avoids


@pytest.mark.parametrize("heavy", [0, 1, 2, None])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_as_a_plain_join(plain, heavy, how):
    df = skewed(plain, None).where("i < 3000").unionByName(skewed(plain, None).where("i < 30"))  # with repeated rows
    dim = df.groupBy("k").agg(F.avg("v").alias("m"), F.lit(None).cast("string").alias("empty"), F.count("*").alias("n")).where("k IS NULL OR k <> '7'")
    got = join_split(df, dim, "k", "n", how, heavy)
    assert got.columns == ["i", "k", "v", "m", "empty"]
    want = df.alias("f").join(dim.alias("d"), F.expr("f.k <=> d.k"), how).select("f.*", "d.m", "d.empty")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_fact_is_shuffled_once(plain):
    df = skewed(plain, "null")
    plan = attach_group_means(df, "k", {"m": F.col("v")}, split=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert "hashpartitioning(coalesce(k" in plan and "__salt" in plan


def test_bridge_is_the_same_beyond_the_broadcast_bound(spark):
    books = spark.createDataFrame([(i, "a, b" if i % 2 else "b, c, b") for i in range(50)] + [(None, "a")], "id int, genres string")
    pairs = gold.genre_pairs(books)
    small = gold.genre_dictionary(pairs)
    large = Numbered(small.frame, 10**9, 10**12)
    assert [tuple(r) for r in gold.book_genre(pairs, large).collect()] == [tuple(r) for r in gold.book_genre(pairs, small).collect()]
