"""Silver jobs: clean, impute, de-duplicate and type each bronze entity.

Rule order follows the reference (imputation windows see raw string keys and
pre-clean values); each stage is one projection so Catalyst sees a flat plan
instead of ~45 stacked `withColumn`s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import cleaning as C
from quire.operators.dedupe import dedupe_by_key
from quire.operators.impute import approx_median, attach_group_means, global_value
from quire.sources.schemas import SILVER


def _sentinel_or_null(c: str):
    col = F.col(c)
    return (col == F.lit(C.SENTINEL)) | col.isNull()


def books(bronze: DataFrame, corrected: bool = False, unique: bool = False) -> DataFrame:
    """silver.books from an all-string bronze books frame (J1-J17). `unique`:
    the frame is known to hold one row per raw key (a merged bronze table)."""
    # Median of pages over the raw frame (duplicates, dropped rows and
    # outliers included), truncated to int; a scalar subquery, not a join.
    median_pages = global_value(bronze, approx_median(C.double_lenient("pages"))).try_cast("int")

    # J1 + C5: publisher sentinel -> NULL, drop rows without publisher.
    kept = bronze.withColumn("publisherid", C.sentinel_to_null("publisherid")) \
        .na.drop("all", subset=["publisherid"])
    # J2 (first half): one row per raw id, deterministic survivor.
    once = kept if unique else dedupe_by_key(kept, "id")

    # F1 / F2: group means over raw string keys of the de-duplicated rows.
    year_num = C.int_lenient("editionyear")
    pages_num = C.int_lenient(C.sentinel_to_null("pages"))
    means = attach_group_means(once, "publisherid", {"__year_pub": year_num}, split=True)
    means = attach_group_means(means, "authorid", {"__year_author": year_num,
                                                    "__pages_author": pages_num}, source=once, split=True)

    # J2 (second half): different raw ids may share their digits.
    return _conform(dedupe_by_key(clean_books(means, median_pages, corrected), "id"), "books")


def needs_year() -> Column:
    return _sentinel_or_null("editionyear")


def needs_pages() -> Column:
    pages_raw = C.sentinel_to_null("pages")
    return pages_raw.isNull() | (C.int_lenient(pages_raw) > C.PAGES_OUTLIER)


def clean_books(means: DataFrame, median_pages: Column, corrected: bool = False, *more: Column) -> DataFrame:
    """Bronze books with the means of their publisher and author (`__year_pub`, `__year_author`,
    `__pages_author`) as clean rows, not yet one per id; columns of `more` follow."""
    year = F.when(needs_year(), F.coalesce(F.col("__year_pub"), F.col("__year_author"))) \
        .otherwise(C.int_lenient("editionyear").cast("double"))
    pages = F.when(needs_pages(), F.coalesce(F.col("__pages_author"), median_pages.cast("double"))) \
        .otherwise(C.double_lenient(C.sentinel_to_null("pages")))
    return means.select(
        C.first_int("id").alias("id"),
        F.col("booktitle"),
        F.col("author"),
        C.first_int("authorid").alias("authorid"),
        C.strip_list_syntax(C.sentinel_to_default("isbn", C.DEFAULT_ISBN)).alias("isbn"),
        year.try_cast("int").alias("editionyear"),
        pages.try_cast("int").alias("pages"),
        C.size_normalize("size", corrected).alias("size"),
        C.cover_code("covertype").alias("covertype"),
        C.language_fill("language", "booktitle").alias("language"),
        C.sentinel_to_null("copiesissued").alias("copiesissued"),
        C.int_lenient(C.sentinel_to_default("agerestrictions", C.DEFAULT_AGE)).alias("agerestrictions"),
        C.genres_clean("genres").alias("genres"),
        C.translator_clean("translatorname", corrected).alias("translatorname"),
        C.rating_clean("rating").alias("rating"),
        *[C.int_lenient(C.sentinel_to_default(c, "0")).alias(c)
          for c in ("haveread", "planned", "reviews", "quotes")],
        C.sentinel_to_default("series", C.DEFAULT_SERIES).alias("series"),
        C.first_int("publisherid").alias("publisherid"),
        *more,
    )


def authors(bronze: DataFrame, unique: bool = False) -> DataFrame:
    """silver.authors (J18-J20); `unique` as for books."""
    once = bronze if unique else dedupe_by_key(bronze, "authorid")
    counters = ("liked", "neutral", "disliked", "favorite", "reading")
    typed = once.select(
        C.first_int("authorid").alias("authorid"),
        F.col("name"),
        C.empty_to_default("originalname", C.DEFAULT_ORIGINALNAME).alias("originalname"),
        *[C.int_lenient(C.sentinel_to_default(c, "0")).alias(c) for c in counters],
    )
    return _conform(dedupe_by_key(typed, "authorid"), "authors")


def publishers(bronze: DataFrame, unique: bool = False) -> DataFrame:
    """silver.publishers (J21-J26); `unique` as for books."""
    once = bronze if unique else dedupe_by_key(bronze, "publisherid")
    # Global mean of years over the de-duplicated rows, truncated.
    mean_years = global_value(once, F.avg(C.double_lenient("years"))).try_cast("int")
    typed = once.select(
        C.first_int("publisherid").alias("publisherid"),
        C.publisher_name_clean("name").alias("name"),
        C.int_lenient(C.book_count_clean("books")).alias("books"),
        F.when(F.col("years").isNull(), mean_years).otherwise(C.int_lenient("years")).alias("years"),
        C.sentinel_to_default("page", C.DEFAULT_PAGE).alias("page"),
        C.int_lenient(C.null_to_default(C.strip_parens("favorite"), "0")).alias("favorite"),
    )
    return _conform(dedupe_by_key(typed, "publisherid"), "publishers")


def _conform(df: DataFrame, entity: str) -> DataFrame:
    """Project to the silver schema: column order and types."""
    schema = SILVER[entity]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
