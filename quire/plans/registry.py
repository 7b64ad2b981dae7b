"""Named queries over the driver tables, one per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame over whole
tables; `quire.oracle` holds the DuckDB SQL that must return the same rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import cleaning as C
from quire.operators import suites as S
from quire.operators import validate as V
from quire.operators.dedupe import dedupe_by_key, distinct_rows, insert_ignore, new_rows
from quire.operators.impute import approx_median, attach_group_means, global_value
from quire.plans import daily, gold, pages as P, rejects as R, silver
from quire.plans.frontier import SeenUrls
from quire.plans.maintained import MaintainedBooks
from quire.session import ensure_checkpoint_dir
from quire.sources import blocks, io
from quire.sources.bronze_views import bronze
from quire.sources.schemas import BRONZE, GOLD
from quire.sources.versions import Versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query | None = None, *, name: str | None = None):
    """Register a query under its function name, or under `name`."""
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


def _bb(spark, d):
    return bronze(spark, d, "books")


def _ba(spark, d):
    return bronze(spark, d, "authors")


def _bp(spark, d):
    return bronze(spark, d, "publishers")


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _silver_books(spark, d):
    return silver.books(_bb(spark, d))


def silver_books_table(spark, d, corrected: bool = False):
    """silver.books computed once and checkpointed, for queries that read it
    more than once (dictionary + bridge, suite aggregate + uniqueness check).
    In the daily job the written silver table plays this role."""
    ensure_checkpoint_dir(spark)
    return silver.books(_bb(spark, d), corrected).checkpoint(eager=True)


# --- projections and predicates ---------------------------------------------

@query
def sentinel_to_null(spark, d):
    b = _bb(spark, d)
    return b.select("id", *[C.sentinel_to_null(c).alias(c)
                            for c in ("pages", "language", "copiesissued", "publisherid")])


@query
def sentinel_to_default(spark, d):
    b = _bb(spark, d)
    return b.select("id",
                    C.sentinel_to_default("isbn", C.DEFAULT_ISBN).alias("isbn"),
                    C.sentinel_to_default("series", C.DEFAULT_SERIES).alias("series"),
                    C.sentinel_to_default("agerestrictions", C.DEFAULT_AGE).alias("agerestrictions"),
                    C.sentinel_to_default("translatorname", C.DEFAULT_TRANSLATOR).alias("translatorname"))


@query
def empty_to_default(spark, d):
    a = _ba(spark, d)
    return a.select("authorid", C.empty_to_default("originalname", C.DEFAULT_ORIGINALNAME).alias("originalname"))


@query
def null_to_default(spark, d):
    p = _bp(spark, d)
    return p.select("publisherid",
                    C.null_to_default(C.strip_parens("favorite"), "0").alias("favorite"),
                    C.null_to_default("years", "unknown").alias("years"))


@query
def drop_all_null(spark, d):
    b = _bb(spark, d).withColumn("publisherid", C.sentinel_to_null("publisherid"))
    return b.na.drop("all", subset=["publisherid"]).select("id", "publisherid")


@query
def lenient_cast_projection(spark, d):
    b = _bb(spark, d)
    return b.select(C.first_int("id").alias("id"), C.first_int("authorid").alias("authorid"),
                    C.first_int("publisherid").alias("publisherid"),
                    C.int_lenient("editionyear").alias("editionyear"),
                    C.int_lenient("pages").alias("pages"),
                    C.int_lenient("copiesissued").alias("copiesissued"),
                    C.double_lenient("planned").alias("planned"))


@query
def cover_code_map(spark, d):
    return _bb(spark, d).select("id", "covertype", C.cover_code("covertype").alias("cover_code"))


@query
def list_string_clean(spark, d):
    b = _bb(spark, d)
    items = C.list_items("genres")
    return b.select("id", C.strip_list_syntax("isbn").alias("isbn"),
                    C.genres_clean("genres").alias("genres"),
                    F.array_join(items, "|").alias("genre_items"), F.size(items).cast("long").alias("n_items"))


@query
def size_normalize(spark, d):
    b = _bb(spark, d)
    return b.select("id", C.size_normalize("size").alias("size"),
                    C.size_normalize("size", corrected=True).alias("size_corrected"))


@query
def translator_clean(spark, d):
    b = _bb(spark, d)
    return b.select("id", C.translator_clean("translatorname").alias("translatorname"),
                    C.translator_clean("translatorname", corrected=True).alias("translatorname_corrected"))


@query
def decimal_comma_rating(spark, d):
    return _bb(spark, d).select("id", C.rating_clean("rating").alias("rating"))


@query
def language_from_script(spark, d):
    b = _bb(spark, d)
    return b.select("id", "booktitle", C.language_fill("language", "booktitle").alias("language"))


# --- imputation ----------------------------------------------------------------

def _books_once(spark, d):
    b = _bb(spark, d).withColumn("publisherid", C.sentinel_to_null("publisherid"))
    return dedupe_by_key(b.na.drop("all", subset=["publisherid"]), "id")


@query
def impute_year_by_group(spark, d):
    once = _books_once(spark, d)
    y = C.int_lenient("editionyear")
    m = attach_group_means(once, "publisherid", {"y_pub": y}, split=True)
    m = attach_group_means(m, "authorid", {"y_auth": y}, source=once, split=True)
    raw = F.col("editionyear")
    year = F.when((raw == C.SENTINEL) | raw.isNull(), F.coalesce("y_pub", "y_auth")).otherwise(y.cast("double"))
    return m.select("id", "publisherid", "authorid", year.try_cast("int").alias("editionyear"))


@query
def impute_pages_by_group_median(spark, d):
    b = _bb(spark, d)
    med = global_value(b, approx_median(C.double_lenient("pages"))).try_cast("int")
    once = _books_once(spark, d)
    raw = C.sentinel_to_null("pages")
    m = attach_group_means(once, "authorid", {"p_auth": C.int_lenient(raw)}, split=True)
    pages = F.when(raw.isNull() | (C.int_lenient(raw) > C.PAGES_OUTLIER),
                   F.coalesce(F.col("p_auth"), med.cast("double"))).otherwise(C.double_lenient(raw))
    return m.select("id", "authorid", pages.try_cast("int").alias("pages"))


@query
def impute_global_mean(spark, d):
    p = dedupe_by_key(_bp(spark, d), "publisherid")
    mean = global_value(p, F.avg(C.double_lenient("years"))).try_cast("int")
    return p.select("publisherid", F.when(F.col("years").isNull(), mean)
                    .otherwise(C.int_lenient("years")).alias("years"))


@query
def median_scalar(spark, d):
    b = _bb(spark, d)
    return b.agg(approx_median(C.double_lenient("pages")).alias("median_pages"),
                 F.count(F.lit(1)).alias("n_rows"))


# --- de-duplication and merge -----------------------------------------------------

def _lineitem_rows(spark, d):
    li = _table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"))


@query(name="dedupe_by_key")
def dedupe_by_key_query(spark, d):
    return dedupe_by_key(_lineitem_rows(spark, d), ["l_orderkey", "l_linenumber"])


@query(name="distinct_rows")
def distinct_rows_query(spark, d):
    li = _table(spark, d, "lineitem")
    return distinct_rows(li.select("l_orderkey", "l_returnflag", "l_linestatus"))


def _stored_orders(spark, d):
    """Stored order table derived from lineitem: one row per order key."""
    li = _table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("amount"))
    return dedupe_by_key(li, "orderkey")


def _staged_orders(spark, d):
    o = _table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("amount"))


@query
def insert_ignore_merge(spark, d):
    return insert_ignore(_stored_orders(spark, d), _staged_orders(spark, d), "orderkey")


@query
def new_keys_anti_join(spark, d):
    return new_rows(_stored_orders(spark, d), _staged_orders(spark, d), "orderkey")


@query
def referenced_entities_semi_join(spark, d):
    c = _table(spark, d, "customer")
    o = _table(spark, d, "orders")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi") \
        .select("c_custkey", "c_name", "c_nationkey")


@query
def entity_urls(spark, d):
    """Follow-on scope (D5, K20, C17): URLs of the authors and publishers
    referenced by this batch of books."""
    b = _bb(spark, d)
    a = b.where(F.col("authorid") != C.SENTINEL).select(F.lit("author").alias("entity"),
                                                       F.col("authorid").alias("ref"))
    p = b.where(F.col("publisherid") != C.SENTINEL).select(F.lit("publisher").alias("entity"),
                                                          F.col("publisherid").alias("ref"))
    refs = a.unionByName(p).distinct()
    return refs.select("entity", "ref", F.concat(F.lit("/"), "entity", F.lit("/"), "ref").alias("url"))


# --- gold -----------------------------------------------------------------------------

@query
def genre_inverted_index(spark, d):
    post = gold.genre_postings(gold.genre_pairs(_silver_books(spark, d)))
    return post.select("genre", F.col("block").cast("long").alias("block"),
                       F.array_join("book_ids", ",").alias("book_ids"), "n_books")


@query
def genre_dictionary(spark, d):
    return gold.genre_dictionary(gold.genre_pairs(_silver_books(spark, d))).frame


@query
def genre_dictionary_incremental(spark, d):
    """The dictionary of a second day: genres of the books shipped on the first days of 1995 are stored
    with their ids, the genres of all books are added."""
    sb = silver_books_table(spark, d)
    shipped = _table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit("1995-01-03").cast("timestamp")) \
        .select(F.col("l_partkey").cast("int").alias("id"))
    stored = gold.genre_dictionary(gold.genre_pairs(sb.join(shipped, "id", "left_semi"))).frame
    return gold.extend_dictionary(stored, gold.genre_pairs(sb))[0].frame


@query
def bronze_merged_and_compacted(spark, d):
    """Bronze authors after five daily merges of two last digits of the id each, which also bring back
    authors of an earlier day; small files are rewritten on the way."""
    layout = daily.Layout(_scratch(spark, "bronze-days"))
    staged = _ba(spark, d)
    digit = F.substring("authorid", -1, 1).cast("int")
    for day in range(5):
        daily.merge_bronze(spark, layout, "authors", staged.where(digit.isin(2 * day, 2 * day + 1, day)))
    return Versions(spark, layout.bronze_root()).read("authors_raw", BRONZE["authors"])


@query
def book_genre_bridge(spark, d):
    return gold.build(silver_books_table(spark, d)).book_genre


@query
def gold_books_projection(spark, d):
    return gold.books(_silver_books(spark, d))


@query
def silver_books(spark, d):
    return _silver_books(spark, d)


@query
def silver_books_maintained(spark, d):
    """silver.books after three batches of bronze books, built from the sums and counts kept beside them."""
    kept, staged = MaintainedBooks(spark, _scratch(spark, "maintained")), _bb(spark, d)
    for day in range(3):
        kept.update(new_rows(staged.limit(0), staged.where(F.pmod(F.crc32("id"), F.lit(3)) == day), "id").checkpoint())
    return kept.books()


@query
def silver_books_corrected(spark, d):
    """silver.books with the size and translator rules as intended (§7.1 #4)."""
    return silver.books(_bb(spark, d), corrected=True)


@query
def genre_dictionary_corrected(spark, d):
    """Genre dictionary with genres trimmed after the split (§7.1 #7)."""
    sb = silver.books(_bb(spark, d), corrected=True)
    return gold.genre_dictionary(gold.genre_pairs(sb, corrected=True)).frame  # read once


@query
def silver_authors(spark, d):
    return silver.authors(_ba(spark, d))


@query
def silver_publishers(spark, d):
    return silver.publishers(_bp(spark, d))


@query
def gold_authors_merge(spark, d):
    """Insert-ignore of silver authors into a gold table that already holds
    the authors referenced by orders placed before 1995 (B7)."""
    sa = silver.authors(_ba(spark, d))
    o = _table(spark, d, "orders")
    earlier = o.where(F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp")) \
        .select(F.col("o_custkey").cast("int").alias("authorid"))
    existing = sa.join(earlier, "authorid", "left_semi").withColumn("name", F.upper("name"))
    return gold.merge_entity(existing, sa, "authors")


# --- validation --------------------------------------------------------------------------

def _kind_query(kind):
    def run(spark, d):
        exps = [e for e in V.SUITES["gold_books"] if e.kind == kind]
        return V.validate(silver_books_table(spark, d), "gold_books", exps)
    return run


for _name, _kind in [("expect_not_null", V.NOT_NULL), ("expect_between", V.BETWEEN),
                     ("expect_in_set", V.IN_SET), ("expect_unique", V.UNIQUE),
                     ("expect_max_between", V.MAX_BETWEEN)]:
    QUERIES[_name] = _kind_query(_kind)


@query
def suite_report_books(spark, d):
    return V.validate(gold.books(silver_books_table(spark, d)), "gold_books")


@query
def suite_report_books_observed(spark, d):
    """The books suite evaluated while the gold books candidate is written
    (observe metrics + key-column uniqueness on the written copy)."""
    path = _scratch(spark, "gold-books-candidate")
    candidate = gold.books(_silver_books(spark, d))
    return V.write_and_validate(candidate, "gold_books", lambda df: io.overwrite(df, path),
                                reread=lambda: spark.read.parquet(path))


@query
def suite_report_authors(spark, d):
    return V.validate(silver.authors(_ba(spark, d)), "gold_authors")


@query
def suite_report_publishers(spark, d):
    return V.validate(silver.publishers(_bp(spark, d)), "gold_publishers")


@query
def gate_decision(spark, d):
    results = suite_report_books(spark, d).unionByName(suite_report_authors(spark, d)) \
        .unionByName(suite_report_publishers(spark, d))
    return V.gate_decision(results)


def _checkpoint_run(spark, d, tables, validations):
    """The results of a checkpoint file and suite files, which are written first."""
    folder = _scratch(spark, "suites")
    for name in validations.values():
        S.write_text(spark, f"{folder}/{name}.json", S.suite_text(S.Suite(name, tuple(V.SUITES[name]))))
    entries = [{"batch_request": {"data_asset_name": a}, "expectation_suite_name": s} for a, s in validations.items()]
    S.write_text(spark, f"{folder}/checkpoint.json", json.dumps({"validations": entries}))
    return S.run_checkpoint(spark, f"{folder}/checkpoint.json", folder, tables)


@query
def checkpoint_report(spark, d):
    """The three suites read from files, run by a checkpoint file over the three candidates."""
    tables = {"gold.books": gold.books(silver_books_table(spark, d)), "gold.authors": silver.authors(_ba(spark, d)),
              "gold.publishers": silver.publishers(_bp(spark, d))}
    return _checkpoint_run(spark, d, tables, {t: t.replace(".", "_") for t in tables})


@query
def suite_runs_compared(spark, d):
    """The publishers suite over two runs, on the staged table and on the records of the publisher
    pages; both are stored, the second is compared with the first (L6)."""
    path = _scratch(spark, "suite-runs")
    pages = P.publisher_records(blocks.publisher_pages(spark, d)).where(F.col("books").isNotNull())
    for run, table in (("staged", silver.publishers(_bp(spark, d))), ("pages", silver.publishers(pages))):
        S.record_run(_checkpoint_run(spark, d, {"gold.publishers": table}, {"gold.publishers": "gold_publishers"}), path, run)
    return S.compare(S.read_run(spark, path, "pages"), S.read_run(spark, path, "staged"))


# --- pages --------------------------------------------------------------------------------

@query
def link_extract(spark, d):
    return P.links(_table(spark, d, "pages"))


@query
def link_frontier_distinct(spark, d):
    return P.frontier(P.links(_table(spark, d, "pages")))


@query
def html_first_element_text(spark, d):
    pg = blocks.spread(_table(spark, d, "pages").select("page_id", "html"), "page_id")
    return pg.select("page_id", P.element_text("html", "title").alias("title"),
                     P.element_text("html", "h1").alias("h1"))


@query
def listing_book_frontier(spark, d):
    """Listing pages rendered from `part` -> book anchors by class -> distinct
    book URLs and ids (crawl fan-out)."""
    return P.book_frontier(blocks.listing_pages(spark, d))


@query
def listing_unseen_books(spark, d):
    """The book URLs of the listing pages that were not seen before (K20, H2); the books shipped on
    the first days of 1995 were seen on an earlier day."""
    shipped = _table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit("1995-01-03").cast("timestamp")) \
        .select(F.col("l_partkey").alias("p_partkey"))
    earlier = _table(spark, d, "part").join(shipped, "p_partkey", "left_semi").select(
        F.concat(F.lit("https://books.example.org/book/"), F.col("p_partkey").cast("string"), F.lit("-"),
                 F.replace("p_name", F.lit(" "), F.lit("-"))).alias("url"))
    seen = SeenUrls(spark, f"seen_{uuid.uuid4().hex}")
    seen.mark(earlier, "earlier")
    ensure_checkpoint_dir(spark)
    found = seen.unseen(P.book_frontier(blocks.listing_pages(spark, d))).checkpoint(eager=True)
    spark.sql(f"DROP TABLE {seen.table}")
    return found


@query
def html_attribute(spark, d):
    pg = _table(spark, d, "pages")
    return pg.select("page_id", P.attribute("html", "html", "lang").alias("lang"),
                     P.attribute("html", "a", "href").alias("first_href"))


@query
def id_from_url(spark, d):
    pg = _table(spark, d, "pages")
    return pg.select("page_id", C.id_from_url("url", r"^[a-z]+://[^/]+/[a-z]{2}/").alias("url_id"))


@query
def labelled_field_cascade(spark, d):
    info = blocks.info_blocks(spark, d)
    f = P.info_fields("info")
    return info.select("book_key", *[v.alias(k) for k, v in f.items()])


@query
def regex_all_matches(spark, d):
    info = blocks.info_blocks(spark, d)
    line = F.regexp_extract("info", P.ISBN_LINE, 0)
    found = C.all_matches(line, P.ISBN_NUMBER)
    return info.select("book_key", F.array_join(found, ",").alias("isbns"), F.size(found).cast("long").alias("n_isbn"))


@query
def nth_line(spark, d):
    st = blocks.stat_blocks(spark, d)
    return st.select("book_key", P.rating("rating_block").alias("rating"),
                     *[P.stat("stat_block", c).alias(c) for c in P.STAT_LINES],
                     P.series("edition_block").alias("series"))


@query
def book_pages_to_bronze(spark, d):
    """Whole ingest step on book pages rendered from `part` (K17 + K3 + C16)."""
    return P.accepted_books(blocks.book_pages(spark, d))


@query
def book_page_rejects(spark, d):
    """The side frame of book pages that lack a block or the author link."""
    return P.split_rejects(P.book_records(blocks.book_pages(spark, d)), P.BOOK_REQUIRED)[1]


@query
def book_page_reject_reasons(spark, d):
    """The rejected book pages with their reason codes."""
    judged = R.with_reasons(P.book_records(blocks.book_pages(spark, d)), R.BOOK_REASONS)
    return judged.where(F.size("reasons") > 0).select("id", F.array_join("reasons", ",").alias("reasons"))


@query
def book_rejects_replayed(spark, d):
    """Open and resolved rejects after two runs over landed book pages (C15): every page lands on
    the first; on the second two thirds land again, half of those without a rating with one."""
    log = R.RejectLog(spark, _scratch(spark, "rejects"))
    again = blocks.relanded_book_pages(spark, d)
    for run, landed in (("day1", blocks.book_pages(spark, d)), ("day2", again)):
        log.record(R.with_reasons(P.book_records(landed, keep=["url"]), R.BOOK_REASONS), run)
    book_id = C.id_from_url("url", P.BOOK_URL_PREFIX).alias("id")
    still = log.open().select(book_id, F.array_join("reasons", ",").alias("reasons"), "attempts", "first_run", "last_run",
                              F.lit(False).alias("resolved"))
    done = log.resolved().select(book_id, F.lit("").alias("reasons"), "attempts", "first_run",
                                 F.col("resolved_run").alias("last_run"), F.lit(True).alias("resolved"))
    return still.unionByName(done)


@query
def book_pages_to_bronze_parsed(spark, d):
    """Same records with the blocks cut by the stdlib HTML parser, a check of the native cut."""
    return P.split_rejects(P.book_records(blocks.book_pages(spark, d), parser="html"), P.BOOK_REQUIRED)[0]


@query
def html_class_text(spark, d):
    """Text of the first element selected by class (K2 with a class selector)."""
    pg = _table(spark, d, "pages")
    return pg.select("page_id", P.element_text("html", "div", "ad").alias("ad_text"))


@query
def silver_books_from_pages(spark, d):
    """Pages -> bronze records -> silver books, end to end."""
    recs = P.accepted_books(blocks.book_pages(spark, d))
    # silver reads bronze three times (median, rows, group means): cut the
    # lineage so the extraction runs once, as the daily job's bronze table does
    ensure_checkpoint_dir(spark)
    return silver.books(recs.checkpoint(eager=True))


@query
def author_pages_to_bronze(spark, d):
    """Author pages rendered from `customer` -> bronze authors rows."""
    return P.author_records(blocks.author_pages(spark, d))


@query
def publisher_pages_to_bronze(spark, d):
    """Publisher pages rendered from `supplier` -> accepted bronze publishers
    rows (K19); pages without a book count are rejects (C15)."""
    accepted, _ = P.split_rejects(P.publisher_records(blocks.publisher_pages(spark, d)), ["books"])
    return accepted


@query
def publisher_page_rejects(spark, d):
    """The side frame of rejected publisher pages."""
    _, rejects = P.split_rejects(P.publisher_records(blocks.publisher_pages(spark, d)), ["books"])
    return rejects


@query
def referenced_author_records(spark, d):
    """Follow-on scope on pages (D5, K20): author records only for the authors
    that this batch's book pages link to (semi join on distinct ids)."""
    refs = P.accepted_books(blocks.book_pages(spark, d)).select("authorid").where(F.col("authorid") != C.SENTINEL)
    authors = P.author_records(blocks.author_pages(spark, d))
    return authors.join(refs.distinct(), "authorid", "left_semi")


@query
def referenced_publisher_records(spark, d):
    """Follow-on scope on pages (D5, K20): accepted publisher records only for
    the publishers that this batch's book pages link to."""
    refs = P.accepted_books(blocks.book_pages(spark, d)).select("publisherid") \
        .where(F.col("publisherid") != C.SENTINEL)
    accepted, _ = P.split_rejects(P.publisher_records(blocks.publisher_pages(spark, d)), ["books"])
    return accepted.join(refs.distinct(), "publisherid", "left_semi")


@query
def silver_authors_from_pages(spark, d):
    return silver.authors(P.author_records(blocks.author_pages(spark, d)))


@query
def silver_publishers_from_pages(spark, d):
    recs = P.publisher_records(blocks.publisher_pages(spark, d)).where(F.col("books").isNotNull())
    return silver.publishers(recs)


# --- file sources and sinks --------

def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder, deleted when the session ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)  # only a folder that exists is noted for deletion
    fs.deleteOnExit(folder)
    return path


@query
def overwrite_keep_schema(spark, d):
    """Gold books written twice into a table with fixed types: the second write
    replaces the rows, the table keeps its schema (B2)."""
    path, table = _scratch(spark, "gold-books"), f"gold_books_{uuid.uuid4().hex}"
    spark.createDataFrame([], GOLD["books"]).write.mode("overwrite").option("path", path).saveAsTable(table)
    books = gold.books(silver_books_table(spark, d))
    io.overwrite_keep_schema(spark, books.where("id % 2 = 0"), table)
    io.overwrite_keep_schema(spark, books.select(*[F.col(c).cast("string") for c in books.columns]), table)
    spark.sql(f"DROP TABLE {table}")  # the files of a table with a path stay
    return spark.read.schema(GOLD["books"]).parquet(path)


@query
def csv_roundtrip(spark, d):
    """Bronze books -> headerless CSV (B3) -> read back with the bronze schema (A3)."""
    path = _scratch(spark, "staged-books")
    io.write_staged_csv(_bb(spark, d), path)
    return io.read_staged_csv(spark, path, "books")


@query
def text_roundtrip(spark, d):
    """Frontier links -> text file, one URL per line (B4) -> read back (A5)."""
    path = _scratch(spark, "links")
    io.write_links(P.frontier(P.links(_table(spark, d, "pages"))), path, "link")
    return io.read_links(spark, path)

