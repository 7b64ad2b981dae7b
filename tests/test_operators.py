"""Dedupe, insert-ignore merge, group means, dense ids."""

from pyspark.sql import functions as F

from quire.operators.dedupe import dedupe_by_key, insert_ignore, new_rows
from quire.operators.ids import dense_ids
from quire.operators.impute import attach_group_means, global_value
from quire.operators.joins import join_dimension


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dedupe_survivor_is_smallest_row_nulls_first(spark):
    df = spark.createDataFrame([("k", "b", 2), ("k", None, 9), ("k", "a", 1), ("j", "z", 0)],
                               "k string, a string, b int")
    assert rows(dedupe_by_key(df, "k"), "k") == [("j", "z", 0), ("k", None, 9)]


def test_dedupe_is_independent_of_partitioning(spark):
    base = spark.range(0, 5000).select((F.col("id") % 37).alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
    a = rows(dedupe_by_key(base.repartition(1), "k"), "k")
    b = rows(dedupe_by_key(base.repartition(13, "v"), "k"), "k")
    assert a == b and len(a) == 37


def test_hot_key_is_reduced_map_side(spark):
    # a third of the rows share one key: the plan has a partial aggregate before the shuffle
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("v"))
    out = dedupe_by_key(df, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert out.where("k = 0").collect()[0]["v"] == 0


def test_insert_ignore_first_version_wins_and_is_idempotent(spark):
    stored = spark.createDataFrame([("1", "old"), ("2", "old")], "id string, v string")
    staged = spark.createDataFrame([("2", "new"), ("3", "b"), ("3", "a"), (None, "x")], "id string, v string")
    merged = insert_ignore(stored, staged, "id")
    assert rows(merged, "id") == [("1", "old"), ("2", "old"), ("3", "a")]
    again = insert_ignore(merged, staged, "id")
    assert rows(again, "id") == rows(merged, "id")
    assert new_rows(merged, staged, "id").count() == 0


def test_group_means_match_window_semantics(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 10), (None, 20), ("b", None)], "k string, v int")
    out = attach_group_means(df, "k", {"m": F.col("v")})
    key = lambda t: (str(t[0]), t[1] if t[1] is not None else -1)
    got = sorted(((r.k, r.v, r.m) for r in out.collect()), key=key)
    exp = sorted([("a", 1, 1.5), ("a", 2, 1.5), (None, 10, 15.0), (None, 20, 15.0), ("b", None, None)], key=key)
    assert got == exp


def test_global_value_is_a_scalar_subquery(spark):
    df = spark.range(1, 11)
    out = df.select("id", global_value(df, F.avg("id")).alias("m"))
    assert "Subquery" in out._jdf.queryExecution().executedPlan().toString()
    assert {r.m for r in out.collect()} == {5.5}


def test_dense_ids_stable_across_partitioning(spark):
    words = spark.createDataFrame([(w,) for w in "pear apple fig kiwi lime plum date".split()], "w string")
    a, n, size = dense_ids(words.repartition(1), ["w"], "id")
    b, m, _ = dense_ids(words.repartition(5), ["w"], "id")
    assert n == m == 7 and size == len("pearapplefigkiwilimeplumdate") + 8 * 7
    assert rows(a, "w") == rows(b, "w")
    assert [r.id for r in a.orderBy("w").collect()] == list(range(7))


def test_dimension_broadcast_only_when_size_known(spark):
    fact = spark.range(100).select((F.col("id") % 3).alias("k"))
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, name string")
    plain = join_dimension(fact, dim, "k", dim_rows=3)  # size unknown: no hint
    assert "broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()
    with_b = join_dimension(fact, dim, "k", dim_rows=3, dim_bytes=3 * 17)
    assert "Broadcast" in with_b._jdf.queryExecution().optimizedPlan().toString() or \
        "broadcast" in with_b._jdf.queryExecution().analyzed().toString().lower()
    assert with_b.count() == 100


def test_bucketed_merge_does_not_shuffle_stored_side(spark):
    from quire.operators.dedupe import merge_into_bucketed_table
    table = "bronze_items_raw_t"
    staged = spark.range(0, 400).select((F.col("id") % 300).cast("string").alias("k"), F.col("id").alias("v"))
    added = merge_into_bucketed_table(staged, table, "k", buckets=4)
    assert added.count() == 300 and spark.table(table).count() == 300
    more = spark.range(250, 350).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    assert merge_into_bucketed_table(more, table, "k", buckets=4).count() == 50
    assert spark.table(table).count() == 350
    probe = new_rows(spark.table(table), more, "k")
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # only the staged side's de-dup
    spark.sql(f"DROP TABLE {table}")


def test_hot_key_join_back_is_split_by_aqe(spark):
    """A third of the rows share one author: with broadcasts off, the group-mean
    join-back is a sort-merge join whose hot partition AQE splits."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(300000).select(
            F.when(F.col("id") % 3 == 0, F.lit("null")).otherwise((F.col("id") % 5000).cast("string")).alias("a"),
            (F.col("id") % 97).alias("v"), F.lit("x" * 50).alias("pad"))
        out = attach_group_means(df, "a", {"m": F.col("v")})
        hot = out.where("a = 'null'").agg(F.count(F.lit(1)), F.min("m"), F.max("m")).collect()[0]
        assert hot[0] == 100000 and hot[1] == hot[2]
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
