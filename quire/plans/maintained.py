"""silver.books kept up to date by batches instead of being built again from all of bronze.

What imputation needs of the books seen so far is kept in mergeable form beside them:

    publisher_sums, author_sums   per raw key: sums and counts of known years and pages (F1, F2)
    page_counts                   per number of pages: how many bronze rows have it (E4; an exact
                                  quantile sketch, one row per distinct number)
    waiting                       the bronze rows whose year or pages are imputed
    cleaned                       clean rows by raw id and the day they were built

A batch appends its own sums and counts, and builds the rows of its books and of those waiting books whose
publisher or author it holds; if it moves the median, of all books that wait for pages. Bronze is not read. Of
the sums, only those of keys of rebuilt books are merged. Readers take the newest
row of a raw id (`books`). Compaction (`Versions.append` with a key) adds up the sums and drops the replaced rows.
The tables of one update become visible by one commit; a run that stops before has changed nothing. An update
is told each bronze row once: what an insert-ignore merge has added, with its raw ids unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import cleaning as C
from quire.operators.dedupe import dedupe_by_key
from quire.operators.joins import join_split
from quire.plans import silver
from quire.session import ensure_checkpoint_dir
from quire.sources.schemas import BRONZE, SILVER
from quire.sources.versions import Versions


def _sums(key: T.StructField, *numbers: str) -> T.StructType:
    return T.StructType([key, *[T.StructField(c, T.LongType()) for c in numbers]])


PUBLISHER_SUMS = _sums(T.StructField("publisherid", T.StringType()), "year_sum", "year_n", "n")
AUTHOR_SUMS = _sums(T.StructField("authorid", T.StringType()), "year_sum", "year_n", "pages_sum", "pages_n", "n")
PAGE_COUNTS = _sums(T.StructField("pages", T.DoubleType()), "n")
CLEANED = T.StructType([T.StructField("raw_id", T.StringType()), T.StructField("day", T.LongType()), *SILVER["books"].fields])


def _added_up(sums: DataFrame) -> DataFrame:
    key, *numbers = sums.columns
    return sums.groupBy(key).agg(*[F.sum(c).alias(c) for c in numbers])


def _newest(cleaned: DataFrame) -> DataFrame:
    rest = [c for c in cleaned.columns if c != "raw_id"]
    return cleaned.groupBy("raw_id").agg(F.max(F.struct(*rest)).alias("row")).select("raw_id", "row.*")


def _mean(kind: str, name: str) -> Column:
    return F.try_divide(F.col(f"{kind}_sum").cast("double"), F.col(f"{kind}_n")).alias(name)


def lower_median(counts: DataFrame) -> float | None:
    """The smallest value with at least half of the rows at or below it. Values are sorted
    by range; only the rows per range (one number each) and the result reach the driver."""
    placed = _added_up(counts).repartitionByRange("pages").withColumn("part", F.spark_partition_id()).checkpoint()
    parts = sorted(tuple(r) for r in placed.groupBy("part").agg(F.sum("n")).collect())
    rest = (sum(n for _, n in parts) + 1) // 2
    for part, n in parts:
        if rest <= n:
            upto = F.sum("n").over(Window.partitionBy("part").orderBy("pages"))
            return placed.where(F.col("part") == part).withColumn("upto", upto).where(F.col("upto") >= rest).agg(F.min("pages")).first()[0]
        rest -= n
    return None


class MaintainedBooks:
    def __init__(self, spark: SparkSession, root: str, corrected: bool = False):
        self.layer, self.corrected = Versions(spark, root), corrected
        ensure_checkpoint_dir(spark)

    def update(self, added: DataFrame) -> int:
        """Take in `added` (new bronze books); returns how many books were built."""
        draft = self.layer.begin()
        added = added.select(*BRONZE["books"].names)
        kept = added.withColumn("publisherid", C.sentinel_to_null("publisherid")).na.drop("all", subset=["publisherid"])
        year, pages = C.int_lenient("editionyear"), C.int_lenient(C.sentinel_to_null("pages"))
        years = [F.sum(year).alias("year_sum"), F.count(year).alias("year_n")]
        of_pages = [F.sum(pages).alias("pages_sum"), F.count(pages).alias("pages_n")]
        rows = F.count(F.lit(1)).alias("n")
        counted = added.select(C.double_lenient("pages").alias("pages")).where("pages IS NOT NULL").groupBy("pages").agg(rows)

        before = lower_median(self.layer.read("page_counts", PAGE_COUNTS))
        draft.append("page_counts", counted, PAGE_COUNTS, "pages", _added_up)
        draft.append("publisher_sums", kept.groupBy("publisherid").agg(*years, rows), PUBLISHER_SUMS, "publisherid", _added_up)
        draft.append("author_sums", kept.groupBy("authorid").agg(*years, *of_pages, rows), AUTHOR_SUMS, "authorid", _added_up)
        median = lower_median(draft.read("page_counts", PAGE_COUNTS))

        again = self._waiting(kept, moved=median != before)
        draft.append("waiting", kept.where(silver.needs_year() | silver.needs_pages()), BRONZE["books"], "authorid")
        build = kept.unionByName(again).checkpoint(eager=True)
        publishers = self._sums_of(draft.read("publisher_sums", PUBLISHER_SUMS), build).select(
            "publisherid", _mean("year", "__year_pub"), "n")
        authors = self._sums_of(draft.read("author_sums", AUTHOR_SUMS), build).select(
            "authorid", _mean("year", "__year_author"), _mean("pages", "__pages_author"), "n")
        means = join_split(join_split(build, publishers, "publisherid", "n"), authors, "authorid", "n")
        cleaned = silver.clean_books(means, F.lit(median).cast("double").try_cast("int"), self.corrected,
                                     F.col("id").alias("raw_id"), F.lit(draft.number).alias("day"))
        draft.append("cleaned", cleaned, CLEANED, "raw_id", _newest)
        draft.commit()
        self.layer.vacuum()
        return build.count()

    def _waiting(self, kept: DataFrame, moved: bool) -> DataFrame:
        """The waiting books of earlier batches whose imputed values this batch can change."""
        old = self.layer.read("waiting", BRONZE["books"])
        for key in ("publisherid", "authorid"):
            held = kept.select(F.col(key).alias(f"__{key}")).distinct().withColumn(f"__has_{key}", F.lit(True))
            old = old.join(held, F.col(key).eqNullSafe(F.col(f"__{key}")), "left")
        touched = F.col("__has_publisherid").isNotNull() | F.col("__has_authorid").isNotNull()
        if moved:
            touched = touched | silver.needs_pages()
        return old.where(touched).select(*BRONZE["books"].names)

    @staticmethod
    def _sums_of(sums: DataFrame, build: DataFrame) -> DataFrame:
        """The sums of the keys of `build`, added up."""
        key = sums.columns[0]
        held = build.select(F.col(key).alias("__held")).distinct()
        return _added_up(sums.join(held, F.col(key).eqNullSafe(F.col("__held")), "left_semi"))

    def books(self) -> DataFrame:
        """silver.books of everything taken in so far."""
        rows = _newest(self.layer.read("cleaned", CLEANED))
        return dedupe_by_key(rows.select(*SILVER["books"].names), "id")
