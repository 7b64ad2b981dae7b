"""Operators against brute-force Python on random small fixtures."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import validate as V
from quire.operators.ids import dense_ids
from quire.operators.impute import attach_group_means

SETTINGS = settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(words=st.sets(st.text(alphabet="abcяж É1", min_size=0, max_size=5), min_size=1, max_size=40),
       parts=st.integers(1, 6))
def test_dense_ids_are_sorted_ranks(spark, words, parts):
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(parts)
    numbered, n, size = dense_ids(df, ["w"], "id")
    got = {r.w: r.id for r in numbered.collect()}
    assert n == len(words)
    assert got == {w: i for i, w in enumerate(sorted(words, key=lambda x: x.encode()))}
    assert size == sum(len(w.encode()) for w in words) + 8 * len(words)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-5, 5))),
                     min_size=1, max_size=40))
def test_group_means_match_python(spark, rows):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "i int, k string, v int")
    got = {r.i: r.m for r in attach_group_means(df, "k", {"m": F.col("v")}).collect()}
    groups = defaultdict(list)
    for k, v in rows:
        if v is not None:
            groups[k].append(v)
    for i, (k, _) in enumerate(rows):
        vals = groups.get(k)
        exp = sum(vals) / len(vals) if vals else None
        assert (got[i] is None and exp is None) or abs(got[i] - exp) < 1e-12


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 25)), st.sampled_from(["H", "S", "X", None])),
                     min_size=1, max_size=40))
def test_expectation_counts_match_python(spark, rows):
    df = spark.createDataFrame(rows, "a int, c string")
    exps = [V.not_null("a"), V.between("a", 0, 21), V.in_set("c", ["H", "S"]), V.unique("a"),
            V.max_between("a", max_value=21)]
    got = {r.expectation: r for r in V.validate(df, "t", exps).collect()}
    a = [x for x, _ in rows]
    nn = [x for x in a if x is not None]
    counts = defaultdict(int)
    for x in nn:
        counts[x] += 1
    assert got[V.NOT_NULL].unexpected_count == a.count(None)
    assert got[V.BETWEEN].unexpected_count == sum(1 for x in nn if x < 0 or x > 21)
    assert got[V.IN_SET].unexpected_count == sum(1 for _, c in rows if c is not None and c not in ("H", "S"))
    assert got[V.UNIQUE].unexpected_count == sum(n for n in counts.values() if n > 1)
    dups = [x for x, k in counts.items() if k > 1]
    assert got[V.UNIQUE].example_unexpected == (str(min(dups)) if dups else None)
    outside = [x for x in nn if x < 0 or x > 21]
    assert got[V.BETWEEN].example_unexpected == (str(min(outside)) if outside else None)
    assert got[V.MAX_BETWEEN].observed_value == (float(max(nn)) if nn else None)
    assert got[V.MAX_BETWEEN].success == (bool(nn) and max(nn) <= 21)
    assert all(r.element_count == len(rows) for r in got.values())
