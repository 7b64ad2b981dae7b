"""Declarative expectation suites and the publish gate.

Every single-column check of a suite is a `count_if` / `count` / `max` of one
aggregate. If the candidate is the result of a job and the suite has one unique
column, the aggregate is grouped by that column and rolled up to one row: the
number of rows of each value is then known too, so the job is evaluated once,
and not shuffled again where it left its rows by that column. A candidate that
is only read from files keeps its rows in place: one aggregate without keys,
and per uniqueness check a grouped count of that column alone.
The one-row result is turned into one row per expectation with `inline`, so
nothing but the final pass/fail flag reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.sources.schemas import VALIDATION_RESULT

NOT_NULL, BETWEEN, IN_SET, UNIQUE, MAX_BETWEEN = (
    "expect_column_values_to_not_be_null", "expect_column_values_to_be_between",
    "expect_column_distinct_values_to_be_in_set", "expect_column_values_to_be_unique",
    "expect_column_max_to_be_between")


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = ()
    mostly: float = 1.0


def not_null(c, mostly=1.0):
    return Expectation(NOT_NULL, c, mostly=mostly)


def between(c, min_value=None, max_value=None, mostly=1.0):
    return Expectation(BETWEEN, c, min_value, max_value, mostly=mostly)


def in_set(c, values):
    return Expectation(IN_SET, c, value_set=tuple(values))


def unique(c):
    return Expectation(UNIQUE, c)


def max_between(c, min_value=None, max_value=None):
    return Expectation(MAX_BETWEEN, c, min_value, max_value)


# --- fixed values: the three suites of the reference, in their order --------
MAX_YEAR = 2023
SUITES: dict[str, list[Expectation]] = {
    "gold_books": [
        not_null("id"), not_null("authorid"), not_null("publisherid"),
        between("editionyear", 1900, MAX_YEAR), in_set("covertype", ["H", "S"]),
        max_between("rating", max_value=5.0), unique("id"),
        not_null("editionyear"), not_null("pages"), between("pages", 0, 10000),
        not_null("language"), between("agerestrictions", 0, 21), not_null("agerestrictions"),
        not_null("haveread"), not_null("planned"), not_null("reviews"), not_null("quotes"),
        between("haveread", 0), between("planned", 0), between("reviews", 0), between("quotes", 0),
    ],
    "gold_authors": [
        not_null("authorid"), unique("authorid"),
        not_null("liked"), not_null("neutral"), not_null("disliked"), not_null("favorite"),
        not_null("reading"),
        between("liked", 0), between("neutral", 0), between("disliked", 0), between("favorite", 0),
        between("reading", 0),
    ],
    "gold_publishers": [
        not_null("publisherid"), unique("publisherid"),
        not_null("favorite"), between("favorite", 0),
        not_null("books"), between("books", 1),
        not_null("years"), between("years", 1900, MAX_YEAR),
    ],
}
# ---------------------------------------------------------------------------


def _outside(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


def _duplicated_rows(df: DataFrame, column: str) -> tuple[Column, Column]:
    """(rows whose non-null value occurs more than once, smallest such value),
    from one grouped count evaluated as a scalar subquery."""
    c = F.col(column)
    dup = df.where(c.isNotNull()).groupBy(c).count().where(F.col("count") > 1)
    both = dup.select(F.struct(F.sum("count").alias("n"), F.min(c).alias("v"))).scalar()
    return F.coalesce(both.getField("n"), F.lit(0)).cast("long"), both.getField("v").cast("string")


def _percent(unexpected: Column, denominator: Column) -> Column:
    return F.when(denominator > 0,
                  unexpected.cast("double") * F.lit(100.0) / denominator.cast("double"))


def _single_column_metrics(exps: list[Expectation]) -> list[tuple[str, str, Column]]:
    """(name, aggregate that merges two of them, aggregate expression)."""
    metrics = [("__n", "sum", F.count(F.lit(1)))]
    for i, e in enumerate(exps):
        c = F.col(e.column)
        metrics.append((f"__nn{i}", "sum", F.count(c)))
        if e.kind == NOT_NULL:
            metrics.append((f"__u{i}", "sum", F.count_if(c.isNull())))
        elif e.kind in (BETWEEN, IN_SET):
            bad = _outside(c, e.min_value, e.max_value) if e.kind == BETWEEN else ~c.isin(*e.value_set)
            metrics.append((f"__u{i}", "sum", F.count_if(bad)))
            metrics.append((f"__x{i}", "min", F.min(F.when(bad, c))))
        elif e.kind == MAX_BETWEEN:
            metrics.append((f"__o{i}", "max", F.max(c)))
        elif e.kind != UNIQUE:
            raise ValueError(f"unknown expectation {e.kind}")
    return metrics


def _typed(name: str, value: Column) -> Column:
    """Examples are text, observed values double."""
    if name.startswith("__x"):
        value = value.cast("string")
    elif name.startswith("__o"):
        value = value.cast("double")
    return value.alias(name)


def _metrics(df: DataFrame, exps: list[Expectation], with_unique: bool = True) -> list[Column]:
    """The aggregate expressions of one pass over `df` (uniqueness checks as
    scalar subqueries when `with_unique`)."""
    metrics = [_typed(name, value) for name, _, value in _single_column_metrics(exps)]
    for i, e in enumerate(exps):
        if e.kind == UNIQUE and with_unique:
            count, example = _duplicated_rows(df, e.column)
            metrics += [count.alias(f"__u{i}"), example.alias(f"__x{i}")]
    return metrics


def _rolled_up(df: DataFrame, exps: list[Expectation], key: str) -> DataFrame:
    """The one-row metrics of a suite whose only unique column is `key`, from one
    aggregate by that column: its groups hold the partial results of every check,
    and their sizes answer the uniqueness check. Partial aggregation reduces a
    frequent (or null) key in every task."""
    parts = _single_column_metrics(exps)
    groups = df.groupBy(F.col(key).alias("__key")).agg(*[value.alias(name) for name, _, value in parts])
    twice = F.col("__key").isNotNull() & (F.col("__n") > 1)
    merge = {"sum": lambda n: F.coalesce(F.sum(n), F.lit(0)), "min": F.min, "max": F.max}
    unique_ones = [i for i, e in enumerate(exps) if e.kind == UNIQUE]
    return groups.agg(
        *[_typed(name, merge[how](name)) for name, how, _ in parts],
        *[F.coalesce(F.sum(F.when(twice, F.col("__n"))), F.lit(0)).alias(f"__u{i}") for i in unique_ones],
        *[F.min(F.when(twice, F.col("__key"))).cast("string").alias(f"__x{i}") for i in unique_ones])


def _only_read(df: DataFrame) -> bool:
    """Whether `df` is read from tables with nothing but projections, filters and unions above."""
    nodes = [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        children = node.children()
        if children.size() and node.nodeName() not in ("Project", "Filter", "SubqueryAlias", "Union", "View"):
            return False
        nodes += [children.apply(k) for k in range(children.size())]
    return True


def _one_row(df: DataFrame, exps: list[Expectation]) -> DataFrame:
    keys = {e.column for e in exps if e.kind == UNIQUE}
    if len(keys) == 1 and not _only_read(df):
        return _rolled_up(df, exps, keys.pop())
    return df.agg(*_metrics(df, exps))


def _assemble(one: DataFrame, suite: str, exps: list[Expectation]) -> DataFrame:
    """One-row metrics frame -> one result row per expectation."""
    rows = []
    n = F.col("__n")
    for i, e in enumerate(exps):
        nn = F.col(f"__nn{i}")
        observed = F.lit(None).cast("double")
        example = F.col(f"__x{i}") if e.kind in (BETWEEN, IN_SET, UNIQUE) else F.lit(None).cast("string")
        if e.kind == MAX_BETWEEN:
            observed = F.col(f"__o{i}")
            unexpected = F.lit(None).cast("long")
            percent = F.lit(None).cast("double")
            success = observed.isNotNull() & ~_outside(observed, e.min_value, e.max_value)
        else:
            unexpected = F.col(f"__u{i}").cast("long")
            denom = n if e.kind == NOT_NULL else nn
            percent = _percent(unexpected, denom)
            ok_share = (denom - unexpected).cast("double") / denom.cast("double")
            success = (denom == 0) | (ok_share >= F.lit(float(e.mostly)))
        rows.append(F.struct(
            F.lit(suite).alias("suite"), F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column_name"), success.alias("success"),
            n.cast("long").alias("element_count"), unexpected.alias("unexpected_count"),
            percent.alias("unexpected_percent"), observed.alias("observed_value"),
            example.alias("example_unexpected")))
    out = one.select(F.inline(F.array(*rows)))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in VALIDATION_RESULT.fields])


def validate(df: DataFrame, suite: str, expectations: list[Expectation] | None = None) -> DataFrame:
    """One row per expectation: suite, expectation, column_name, success,
    element_count, unexpected_count, unexpected_percent, observed_value and
    example_unexpected (the smallest offending value, as text)."""
    exps = SUITES[suite] if expectations is None else expectations
    return _assemble(_one_row(df, exps), suite, exps)


def write_and_validate(df: DataFrame, suite: str, writer,
                       expectations: list[Expectation] | None = None, reread=None) -> DataFrame:
    """Write `df` with `writer(frame)` and evaluate the suite while writing:
    the single-column checks ride along the write as `DataFrame.observe`
    metrics (no extra pass); uniqueness checks, which need a grouped count,
    then run on the key columns only, of `reread()` (the written data) when
    given, else of `df`. Returns the same rows as `validate`."""
    from pyspark.sql import Observation

    exps = SUITES[suite] if expectations is None else expectations
    spark = df.sparkSession
    obs = Observation(f"suite_{suite}")
    writer(df.observe(obs, *_metrics(df, exps, with_unique=False)))
    values = dict(obs.get)
    fields = [T.StructField(k, T.DoubleType() if k.startswith("__o") else
                            T.StringType() if k.startswith("__x") else T.LongType(), True) for k in values]
    one = spark.createDataFrame([tuple(values[f.name] for f in fields)], T.StructType(fields))
    uniques = [(i, e) for i, e in enumerate(exps) if e.kind == UNIQUE]
    if uniques:
        extra = []
        source = reread() if reread is not None else df
        for i, e in uniques:
            count, example = _duplicated_rows(source, e.column)
            extra += [count.alias(f"__u{i}"), example.alias(f"__x{i}")]
        one = one.select("*", *extra)
    return _assemble(one, suite, exps)


def gate_decision(results: DataFrame) -> DataFrame:
    """One row per suite: passed (all expectations succeeded) and failures."""
    return results.groupBy("suite").agg(
        F.bool_and(F.coalesce(F.col("success"), F.lit(False))).alias("passed"),
        F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed_expectations"))


class ValidationFailed(RuntimeError):
    pass


def publish_if_valid(candidate: DataFrame, suite: str, writer, results_writer=None) -> DataFrame:
    """Validate the candidate frame and call `writer(candidate)` only if every
    expectation of `suite` passed (L7). The result rows go to
    `results_writer` when given. Raises ValidationFailed otherwise."""
    results = validate(candidate, suite)
    if results_writer is not None:
        results_writer(results)
    failed = results.where(~F.coalesce(F.col("success"), F.lit(False))).select("expectation", "column_name")
    bad = failed.collect()  # at most one row per expectation of the suite
    if bad:
        raise ValidationFailed(f"{suite}: " + ", ".join(f"{r[0]}({r[1]})" for r in bad))
    writer(candidate)
    return results
