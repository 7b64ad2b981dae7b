"""Expectation suites and checkpoints as files, runs that can be compared.

A suite file is JSON: a name and a list of expectations, each a type with its
arguments. A checkpoint file (YAML, or JSON) lists which suite judges which
table. Whatever the library doesn't evaluate is refused when the file is read: unknown
types and arguments, missing columns, two expectations of one type on one column (their
results could not be told apart).

The results of each run are appended to a table under the run's name; `compare`
sets a run beside another, expectation by expectation."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.validate import (BETWEEN, IN_SET, MAX_BETWEEN, NOT_NULL, UNIQUE, Expectation, validate)
from quire.sources.schemas import VALIDATION_RESULT

_ARGUMENTS = {NOT_NULL: {"mostly"}, BETWEEN: {"min_value", "max_value", "mostly"}, IN_SET: {"value_set"},
              UNIQUE: set(), MAX_BETWEEN: {"min_value", "max_value"}}
_BOUNDED = (BETWEEN, MAX_BETWEEN)
KEY = ["suite", "expectation", "column_name"]


class SuiteError(ValueError):
    """A suite or checkpoint file that can't be run as it stands."""


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: tuple[Expectation, ...]


@dataclass(frozen=True)
class Validation:
    asset: str
    suite: str


def _number(value, what: str) -> float | None:
    if value is not None and (isinstance(value, bool) or not isinstance(value, (int, float))):
        raise SuiteError(f"{what} is not a number: {value!r}")
    return value


def _expectation(entry: dict, where: str) -> Expectation:
    kind, args = entry.get("expectation_type"), dict(entry.get("kwargs") or {})
    if kind not in _ARGUMENTS:
        raise SuiteError(f"{where}: unknown expectation {kind!r}")
    column = args.pop("column", None)
    if not isinstance(column, str) or not column:
        raise SuiteError(f"{where}: {kind} names no column")
    where = f"{where}: {kind}({column})"
    if unknown := sorted(k for k, v in args.items() if k not in _ARGUMENTS[kind] and not (k == "mostly" and v == 1)):
        raise SuiteError(f"{where} has arguments that are not evaluated: {', '.join(unknown)}")
    mostly = _number(args.get("mostly", 1.0), f"{where} mostly")
    if mostly is None or not 0 <= mostly <= 1:
        raise SuiteError(f"{where} mostly is not between 0 and 1")
    low, high = (_number(args.get(k), f"{where} {k}") for k in ("min_value", "max_value"))
    if kind in _BOUNDED and low is None and high is None:
        raise SuiteError(f"{where} has no bound")
    values = args.get("value_set")
    if kind == IN_SET and (not isinstance(values, list) or not values):
        raise SuiteError(f"{where} has no value set")
    return Expectation(kind, column, low, high, tuple(values or ()), float(mostly))


def parse_suite(text: str, source: str = "suite") -> Suite:
    """The suite of a JSON text."""
    try:
        data = json.loads(text)
    except ValueError as e:
        raise SuiteError(f"{source} is not JSON: {e}") from e
    name, entries = (data.get("expectation_suite_name"), data.get("expectations")) if isinstance(data, dict) else (None, None)
    if not name or not isinstance(entries, list):
        raise SuiteError(f"{source} has no expectation_suite_name or no list of expectations")
    found = tuple(_expectation(e if isinstance(e, dict) else {}, f"{source}[{i}]") for i, e in enumerate(entries))
    seen = [(e.kind, e.column) for e in found]
    if twice := sorted({k for k in seen if seen.count(k) > 1}):
        raise SuiteError(f"{source}: more than one of {twice}")
    return Suite(name, found)


def suite_text(suite: Suite) -> str:
    """The file of a suite; `parse_suite` gives it back."""
    entries = []
    for e in suite.expectations:
        args = {"column": e.column}
        if "mostly" in _ARGUMENTS[e.kind]:
            args["mostly"] = e.mostly
        args |= {k: v for k, v in (("min_value", e.min_value), ("max_value", e.max_value)) if v is not None}
        if e.kind == IN_SET:
            args["value_set"] = list(e.value_set)
        entries.append({"expectation_type": e.kind, "kwargs": args})
    return json.dumps({"expectation_suite_name": suite.name, "expectations": entries}, indent=1, ensure_ascii=False) + "\n"


def parse_checkpoint(text: str, source: str = "checkpoint") -> list[Validation]:
    """The validations of a checkpoint: JSON, or YAML where a YAML parser is installed."""
    try:
        data = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise SuiteError(f"{source} is not JSON, and no YAML parser is installed") from e
        try:
            data = yaml.safe_load(text)
        except yaml.YAMLError as e:
            raise SuiteError(f"{source} is neither JSON nor YAML: {e}") from e
    entries = data.get("validations") if isinstance(data, dict) else None
    if not entries:
        raise SuiteError(f"{source} has no validations")
    out = []
    for i, v in enumerate(entries):
        v = v if isinstance(v, dict) else {}
        asset = (v.get("batch_request") or {}).get("data_asset_name")
        suite = v.get("expectation_suite_name") or data.get("expectation_suite_name")
        if not asset or not suite:
            raise SuiteError(f"{source}[{i}] names no table or no suite")
        out.append(Validation(asset, suite))
    return out


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file from wherever the session can read."""
    rows = spark.read.text(path, wholetext=True).collect()
    if len(rows) != 1:
        raise SuiteError(f"{path} is not one file with text")
    return rows[0][0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def run_checkpoint(spark: SparkSession, path: str, suite_folder: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The result rows of all validations of a checkpoint file. Suites are read from
    `<suite_folder>/<suite>.json`, the judged tables taken from `tables` by asset name."""
    results = None
    for v in parse_checkpoint(read_text(spark, path), path):
        file = f"{suite_folder.rstrip('/')}/{v.suite}.json"
        suite = parse_suite(read_text(spark, file), file)
        if suite.name != v.suite:
            raise SuiteError(f"{file} holds the suite {suite.name!r}")
        if v.asset not in tables:
            raise SuiteError(f"{path} judges {v.asset!r}, which is not given")
        if absent := sorted({e.column for e in suite.expectations} - set(tables[v.asset].columns)):
            raise SuiteError(f"{v.asset} has no column {', '.join(absent)}")
        one = validate(tables[v.asset], suite.name, list(suite.expectations))
        results = one if results is None else results.unionByName(one)
    return results


def record_run(results: DataFrame, path: str, run: str) -> None:
    """Store the results of a run under its name; a run that is repeated replaces its rows."""
    results.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


def read_run(spark: SparkSession, path: str, run: str) -> DataFrame:
    return spark.read.schema(VALIDATION_RESULT).parquet(f"{path.rstrip('/')}/run={run}")


def compare(now: DataFrame, before: DataFrame) -> DataFrame:
    """Per expectation of either run: success then and now, unexpected rows then and now,
    and change: broken, fixed, added, removed or same (by success)."""
    a = before.select(*KEY, F.coalesce("success", F.lit(False)).alias("success_before"), F.col("unexpected_count").alias("unexpected_before"))
    b = now.select(*KEY, F.coalesce("success", F.lit(False)).alias("success_now"), F.col("unexpected_count").alias("unexpected_now"))
    was, is_ = F.col("success_before"), F.col("success_now")
    return a.join(b, KEY, "full_outer").withColumn(
        "change", F.when(was.isNull(), "added").when(is_.isNull(), "removed").when(was & ~is_, "broken")
        .when(~was & is_, "fixed").otherwise("same"))
