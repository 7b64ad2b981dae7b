"""Suite and checkpoint files, compared runs; the frontier's memory."""

import json

import pytest

from conftest import SF_SMALL
from quire.operators import suites as S
from quire.operators import validate as V
from quire.plans import daily, frontier, rejects
from quire.sources.blocks import book_pages, listing_pages


def _entry(kind=V.NOT_NULL, **kwargs):
    return {"expectation_type": kind, "kwargs": kwargs, "meta": {"notes": "any"}}


def _file(*entries):
    return json.dumps({"data_asset_type": None, "expectation_suite_name": "s", "expectations": list(entries)})


def test_suites_come_back_from_their_files():
    assert sum(len(x) for x in V.SUITES.values()) == 41
    for name, exps in V.SUITES.items():
        suite = S.parse_suite(S.suite_text(S.Suite(name, tuple(exps))))
        assert suite == S.Suite(name, tuple(exps))


@pytest.mark.parametrize("text, message", [
    ("{", "not JSON"), ("[]", "no expectation_suite_name"), (_file(_entry("expect_magic", column="a")), "unknown expectation"),
    (_file(_entry()), "names no column"), (_file(_entry(column="a", row_condition="b > 1")), "row_condition"),
    (_file(_entry(V.UNIQUE, column="a", mostly=0.5)), "mostly"), (_file(_entry(column="a", mostly=2)), "between 0 and 1"),
    (_file(_entry(V.BETWEEN, column="a")), "no bound"), (_file(_entry(V.BETWEEN, column="a", min_value="x")), "not a number"),
    (_file(_entry(V.IN_SET, column="a", value_set=[])), "no value set"),
    (_file(_entry(column="a"), _entry(column="a", mostly=0.9)), "more than one"), (_file("x"), "unknown expectation")])
def test_refused_suites(text, message):
    with pytest.raises(S.SuiteError, match=message):
        S.parse_suite(text)


def test_checkpoints():
    yaml = "name: c\nconfig_version: 1.0\nvalidations:\n  - batch_request:\n      data_asset_name: gold.a\n    expectation_suite_name: s\n"
    want = [S.Validation("gold.a", "s")]
    as_json = json.dumps({"expectation_suite_name": "s", "validations": [{"batch_request": {"data_asset_name": "gold.a"}}]})
    assert S.parse_checkpoint(as_json) == want
    try:
        import yaml as _  # noqa: F401
        assert S.parse_checkpoint(yaml) == want
    except ImportError:
        with pytest.raises(S.SuiteError, match="no YAML parser"):
            S.parse_checkpoint(yaml)
    for broken in ("{}", '{"validations": [{}]}', '{"validations": [{"batch_request": {"data_asset_name": "a"}}]}'):
        with pytest.raises(S.SuiteError):
            S.parse_checkpoint(broken)


def test_checkpoint_runs_are_stored_and_compared(spark, scratch):
    S.write_text(spark, f"{scratch}/s.json", _file(_entry(column="a"), _entry(V.BETWEEN, column="b", min_value=0), _entry(V.UNIQUE, column="a")))
    S.write_text(spark, f"{scratch}/c.json", json.dumps({"expectation_suite_name": "s", "validations": [
        {"batch_request": {"data_asset_name": "t"}}]}))
    table = lambda rows: {"t": spark.createDataFrame(rows, "a int, b int")}
    run = lambda rows: S.run_checkpoint(spark, f"{scratch}/c.json", scratch, table(rows))
    S.record_run(run([(1, 1), (None, 2), (3, -1)]), f"{scratch}/runs", "d1")
    for _ in range(2):
        S.record_run(run([(1, 1), (1, 5)]), f"{scratch}/runs", "d2")
    S.write_text(spark, f"{scratch}/s.json", _file(_entry(column="a"), _entry(V.BETWEEN, column="b", min_value=3)))
    one, two = (S.read_run(spark, f"{scratch}/runs", d) for d in ("d1", "d2"))
    assert (one.count(), two.count()) == (3, 3)
    change = {(r.expectation, r.column_name): (r.unexpected_before, r.unexpected_now, r.change) for r in S.compare(two, one).collect()}
    assert change == {(V.NOT_NULL, "a"): (1, 0, "fixed"), (V.BETWEEN, "b"): (1, 0, "fixed"), (V.UNIQUE, "a"): (0, 2, "broken")}
    gone = {r.change for r in S.compare(two, one.limit(0)).collect()} | {r.change for r in S.compare(one.limit(0), two).collect()}
    assert gone == {"added", "removed"}
    with pytest.raises(S.SuiteError, match="not given"):
        S.run_checkpoint(spark, f"{scratch}/c.json", scratch, {})
    with pytest.raises(S.SuiteError, match="no column b"):
        S.run_checkpoint(spark, f"{scratch}/c.json", scratch, {"t": spark.createDataFrame([(1,)], "a int")})


def test_a_seen_listing_extracts_nothing(spark, scratch):
    layout, seen = daily.Layout(f"{scratch}/lake"), frontier.SeenUrls(spark, "seen_urls_days", buckets=4)
    spark.sql("DROP TABLE IF EXISTS seen_urls_days")
    listing, pages = listing_pages(spark, SF_SMALL), book_pages(spark, SF_SMALL)
    half = listing.where("page_id < 4")
    first = frontier.crawl_day(spark, layout, half, pages, seen, "d1")
    open_rejects = rejects.RejectLog(spark, rejects.reject_root(layout, "books")).open()
    assert first.count() + open_rejects.count() == pages.where("page_id < 80").count()
    assert frontier.crawl_day(spark, layout, half, pages, seen, "d2", retry=False).count() == 0
    assert spark.table("seen_urls_days").where("first_run = 'd2'").count() == 0
    frontier.crawl_day(spark, layout, listing, pages, seen, "d3")
    assert spark.table("seen_urls_days").count() == pages.count()
    attempts = {r.attempts for r in rejects.RejectLog(spark, rejects.reject_root(layout, "books")).open().where("first_run = 'd1'").collect()}
    assert attempts == {2}  # landed again on d3 only
    assert seen.unseen(spark.createDataFrame([(None,), ("new",), ("new",)], "url string")).collect()[0][0] == "new"
    spark.sql("DROP TABLE seen_urls_days")


def test_the_seen_set_is_not_shuffled(spark):
    spark.sql("DROP TABLE IF EXISTS seen_urls_plan")
    seen = frontier.SeenUrls(spark, "seen_urls_plan", buckets=4)
    seen.mark(spark.range(2000).selectExpr("concat('u', id) AS url"), "d1")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        found = seen.unseen(spark.range(1900, 2100).selectExpr("concat('u', id) AS url"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount" in plan
        assert found.count() == 100
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE seen_urls_plan")
