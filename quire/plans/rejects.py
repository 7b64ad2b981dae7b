"""Rejected pages that come back (C15): reasons, a table of open rejects, replay.

A page whose record lacks a required field is a reject with reason codes. Open
rejects are kept per URL with the number of attempts; each day's landed pages are
matched with them, so a page that was repaired leaves the open rejects, enters bronze
once (insert-ignore by its key) and is noted as resolved, one that is still broken
counts a further attempt with its new reasons, and one that did not land stays as it is.

Of several landings of a URL in one run a whole one counts, else the one with the
fewest reasons. A run that is repeated under its name counts once. Pages without a URL are
one entry with the URL ''. An empty landing changes nothing. The two tables are
published together (sources/versions.py), after bronze holds the accepted records: a run
that stops in between is repeated without loss."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.dedupe import dedupe_by_key
from quire.plans import daily
from quire.plans import pages as P
from quire.session import ensure_checkpoint_dir
from quire.sources.schemas import BRONZE
from quire.sources.versions import Versions

BOOK_REASONS = {"id": "no_id_in_url", "booktitle": "no_title", "author": "no_author", "authorid": "no_author_link",
                "isbn": "no_info_block", "rating": "no_rating_block", "haveread": "no_counters_block",
                "series": "no_edition_block"}
PUBLISHER_REASONS = {"publisherid": "no_id_in_url", "books": "no_book_count"}

OPEN = T.StructType([T.StructField("url", T.StringType()), T.StructField("reasons", T.ArrayType(T.StringType())),
                     T.StructField("attempts", T.LongType()), T.StructField("first_run", T.StringType()),
                     T.StructField("last_run", T.StringType())])
RESOLVED = T.StructType([T.StructField("url", T.StringType()), T.StructField("attempts", T.LongType()),
                         T.StructField("first_run", T.StringType()), T.StructField("resolved_run", T.StringType())])


def with_reasons(records: DataFrame, reasons: dict[str, str]) -> DataFrame:
    """`records` with `reasons`: the codes of the required fields that are NULL, in the
    order of the mapping; empty for a whole record."""
    codes = F.array(*[F.when(F.col(c).isNull(), F.lit(code)) for c, code in reasons.items()])
    return records.withColumn("reasons", F.array_compact(codes))


def landings(judged: DataFrame) -> DataFrame:
    """(url, reasons) of a run: one row per URL, the best landing of each."""
    rows = judged.select(F.coalesce("url", F.lit("")).alias("url"), F.size("reasons").alias("n"), "reasons")
    return dedupe_by_key(rows, "url", order=["n", "reasons"]).select("url", "reasons")


def replay(open_rejects: DataFrame, landed: DataFrame, run: str) -> tuple[DataFrame, DataFrame]:
    """(open rejects, newly resolved ones) after the `landings` of a run."""
    now = landed.select("url", F.col("reasons").alias("found"))
    both = open_rejects.join(now, "url", "full_outer")
    again = F.col("found").isNotNull() & ~F.col("last_run").eqNullSafe(F.lit(run))
    whole = F.col("found").isNotNull() & (F.size("found") == 0)
    attempts = (F.coalesce("attempts", F.lit(0)) + again.cast("long")).alias("attempts")
    first = F.coalesce("first_run", F.lit(run)).alias("first_run")
    still = both.where(~whole).select(
        "url", F.coalesce("found", "reasons").alias("reasons"), attempts, first,
        F.when(F.col("found").isNotNull(), F.lit(run)).otherwise(F.col("last_run")).alias("last_run"))
    resolved = both.where(whole & F.col("attempts").isNotNull()) \
        .select("url", attempts, "first_run", F.lit(run).alias("resolved_run"))
    return still, resolved


class RejectLog:
    """The open and resolved rejects of an entity under `root` (shared storage)."""

    def __init__(self, spark: SparkSession, root: str):
        self.layer = Versions(spark, root)

    def open(self) -> DataFrame:
        return self.layer.read("open", OPEN)

    def resolved(self) -> DataFrame:
        return self.layer.read("resolved", RESOLVED)

    def record(self, judged: DataFrame, run: str) -> None:
        """Match the records of a run (url, reasons) with the open rejects and publish both tables."""
        ensure_checkpoint_dir(judged.sparkSession)
        landed = landings(judged).checkpoint(eager=True)  # both tables read it: the pages are extracted once
        still, resolved = replay(self.open(), landed, run)
        draft = self.layer.begin()
        draft.write("open", still, OPEN)
        draft.append("resolved", resolved, RESOLVED)
        draft.commit()
        self.layer.vacuum()


def reject_root(layout: daily.Layout, entity: str) -> str:
    return f"{layout.root}/rejects/{entity}"


def ingest_pages(spark: SparkSession, layout: daily.Layout, pages: DataFrame, run: str, entity: str = "books") -> DataFrame:
    """A run's landed book or publisher pages: whole records are merged into bronze, the others
    logged. Returns the rows that bronze gained. The pages are extracted once."""
    extract, reasons = {"books": (P.book_records, BOOK_REASONS), "publishers": (P.publisher_records, PUBLISHER_REASONS)}[entity]
    judged = with_reasons(extract(pages, keep=["url"]), reasons).checkpoint(eager=True)
    added = daily.merge_bronze(spark, layout, entity, judged.where(F.size("reasons") == 0).select(*BRONZE[entity].names))
    RejectLog(spark, reject_root(layout, entity)).record(judged, run)
    return added
