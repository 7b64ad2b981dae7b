"""A crawl frontier with memory.

The URLs that were extracted before are kept in a catalog table, bucketed by a hash
of the URL and sorted in each bucket. A day's distinct URLs are shuffled into the same
buckets and anti-joined there: what was seen is read where it lies and never moves, so
a day's shuffle follows the day's listing, not the history.

URLs are marked as seen after their pages are in bronze: a run that stops in between
extracts them again, and the insert-ignore merge leaves bronze as it was. Rejected
pages (plans/rejects.py) are extracted again when they land again, unless `retry` is
off. NULL URLs are no pages and are left out; a URL that is listed twice counts once; an
empty listing adds nothing. Each day adds at most one file to a bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.dedupe import merge_into_bucketed_table, new_rows
from quire.plans import daily
from quire.plans import pages as P
from quire.plans.rejects import RejectLog, ingest_pages, reject_root


class SeenUrls:
    """The seen-set in catalog table `table`; `buckets` is fixed when it is created."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets

    def unseen(self, urls: DataFrame) -> DataFrame:
        """One row per URL of `urls` (url, ...) that is not in the seen-set."""
        if not self.spark.catalog.tableExists(self.table):
            self.mark(urls.select("url").limit(0), "")
        return new_rows(self.spark.table(self.table), urls, "url")

    def mark(self, urls: DataFrame, run: str) -> DataFrame:
        """Add URLs under the name of the run that saw them first; returns those that are new."""
        return merge_into_bucketed_table(urls.select("url", F.lit(run).alias("first_run")), self.table, "url", self.buckets)


def crawl_day(spark: SparkSession, layout: daily.Layout, listing: DataFrame, pages: DataFrame, seen: SeenUrls, run: str,
              retry: bool = True) -> DataFrame:
    """The book pages among `pages` (url, html) that the day's listing pages link to and no earlier
    run has extracted: into bronze or the open rejects, then marked. Returns bronze's new rows."""
    todo = seen.unseen(P.book_frontier(listing).select("url"))
    if retry:
        todo = todo.unionByName(RejectLog(spark, reject_root(layout, "books")).open().select("url")).distinct()
    todo = todo.checkpoint(eager=True)
    landed = pages.join(todo, "url", "left_semi").checkpoint(eager=True)
    added = ingest_pages(spark, layout, landed, run)
    seen.mark(landed.select("url"), run)
    return added
