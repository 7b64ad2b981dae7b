"""Rejected pages: reasons, attempts, replay over days."""

from pyspark.sql import functions as F

from quire.plans import daily, rejects as R
from quire.sources.blocks import book_pages
from quire.sources.schemas import BRONZE
from conftest import SF_SMALL


def _landed(spark, rows):
    return spark.createDataFrame(rows, "url string, reasons array<string>")


def _open(log):
    return {r.url: (r.reasons, r.attempts, r.first_run, r.last_run) for r in log.open().collect()}


def test_attempts_repairs_and_pages_that_did_not_land(spark, scratch):
    log = R.RejectLog(spark, f"{scratch}/r")
    log.record(_landed(spark, [("a", ["x"]), ("b", ["x", "y"]), ("c", ["y"]), ("whole", []), (None, ["n"]), (None, ["n", "x"])]), "d1")
    assert _open(log) == {"a": (["x"], 1, "d1", "d1"), "b": (["x", "y"], 1, "d1", "d1"), "c": (["y"], 1, "d1", "d1"),
                          "": (["n"], 1, "d1", "d1")}
    assert log.resolved().count() == 0
    # a is repaired (one of two landings), b has one reason less, c did not land, d is new
    day2 = _landed(spark, [("a", ["x"]), ("a", []), ("b", ["y"]), ("d", ["x"])])
    for _ in range(2):  # repeated under its name: counts once
        log.record(day2, "d2")
        assert _open(log) == {"b": (["y"], 2, "d1", "d2"), "c": (["y"], 1, "d1", "d1"), "": (["n"], 1, "d1", "d1"),
                              "d": (["x"], 1, "d2", "d2")}
        assert [tuple(r) for r in log.resolved().collect()] == [("a", 2, "d1", "d2")]
    before = _open(log)
    log.record(_landed(spark, []), "d3")
    assert _open(log) == before
    log.record(_landed(spark, [("a", ["x"])]), "d4")  # broken again: a new reject
    assert _open(log)["a"] == (["x"], 1, "d4", "d4")


def test_a_repaired_page_enters_bronze_once(spark, scratch):
    layout = daily.Layout(f"{scratch}/lake")
    pages = book_pages(spark, SF_SMALL).where("page_id < 120")
    whole = '<div class="bc-rating">4,5</div></body>'
    broken = pages.where("page_id = 29")
    repaired = broken.selectExpr("page_id", "url", f"replace(html, '</body>', '{whole}') AS html")
    first = R.ingest_pages(spark, layout, pages, "d1")
    assert "29" not in {r.id for r in first.collect()}
    log = R.RejectLog(spark, R.reject_root(layout, "books"))
    reasons = {r.url.split("/book/")[1].split("-")[0]: r.reasons for r in log.open().collect()}
    assert reasons["29"] == ["no_rating_block"] and reasons["31"] == ["no_author_link"] and reasons["37"] == ["no_edition_block"]
    assert [r.id for r in R.ingest_pages(spark, layout, repaired, "d2").collect()] == ["29"]
    assert R.ingest_pages(spark, layout, repaired.unionByName(pages), "d3").count() == 0
    bronze = spark.read.schema(BRONZE["books"]).parquet(layout.bronze("books"))
    assert bronze.where("id = '29'").count() == 1
    assert [(r.attempts, r.resolved_run) for r in log.resolved().where("url LIKE '%/29-%'").collect()] == [(2, "d2")]


def test_publisher_pages(spark, scratch):
    from quire.sources.blocks import publisher_pages

    layout = daily.Layout(f"{scratch}/lake")
    pages = publisher_pages(spark, SF_SMALL)
    added = R.ingest_pages(spark, layout, pages, "d1", "publishers")
    rejects = R.RejectLog(spark, R.reject_root(layout, "publishers")).open()
    assert {tuple(r.reasons) for r in rejects.select("reasons").collect()} <= {("no_book_count",)}
    assert added.count() + rejects.count() == pages.count()


def test_pages_of_a_run_are_extracted_once(spark, scratch):
    """Both tables of the log come from one evaluation of a run's records (F1)."""
    read = spark.sparkContext.accumulator(0)

    def seen(url):
        read.add(1)
        return url

    log = R.RejectLog(spark, f"{scratch}/r")
    for k, run in enumerate(("d1", "d2"), 1):
        rows = _landed(spark, [(f"u{i}", [] if i % 3 == k else ["x"]) for i in range(40)])
        log.record(rows.select(F.udf(seen, "string")("url").alias("url"), "reasons"), run)
        assert read.value == 40 * k
    assert log.open().count() == 27 and log.resolved().count() == 13
