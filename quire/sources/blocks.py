"""Book information blocks and book pages rendered from the `part` table.

The driver's `pages` table holds generic web pages; the labelled blocks the
book extractor reads (ISBN, year, page-count forms, print run, format,
cover, language, age limit, genres, translators, rating and reader stats,
edition) are rendered here from `part` rows with one SQL text that Spark and
DuckDB both run, so extraction works on data that grows with the tables.
`chr(10)` is a newline and `chr(160)` a no-break space in both dialects.
"""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession

from quire.sources.bronze_views import sql_over


INFO_EXPR = """concat(
  CASE WHEN p_partkey % 9 = 0 THEN '' ELSE concat('ISBN: 978-5-', CAST(1000000 + p_partkey AS STRING), '-X, 5-17-', CAST(100000 + p_size AS STRING), '-1', chr(10)) END,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('Год издания: ', CAST(1950 + p_size AS STRING), chr(10)) END,
  CASE p_partkey % 8 WHEN 0 THEN ''
    WHEN 1 THEN concat('Количество страниц: ', CAST(p_size * 10 AS STRING), chr(10))
    WHEN 2 THEN concat('Страниц: ', CAST(p_size * 10 AS STRING), chr(10))
    WHEN 3 THEN concat('Объем: ', CAST(p_size * 10 AS STRING), ' стр.', chr(10))
    ELSE concat('Кол-во страниц: ', CAST(p_size * 10 AS STRING), chr(10)) END,
  CASE WHEN p_partkey % 6 = 0 THEN ''
    WHEN p_partkey % 2 = 0 THEN concat('Тираж: ', CAST(p_size AS STRING), chr(160), '000 экз.', chr(10))
    ELSE concat('Тираж: ', CAST(p_size * 100 AS STRING), ' экз.', chr(10)) END,
  CASE p_partkey % 4 WHEN 0 THEN ''
    WHEN 1 THEN concat('Формат: 84x108/32 (130x200 мм) Возрастные ограничения: ', CAST(p_partkey % 19 AS STRING), chr(10))
    WHEN 2 THEN concat('Размер: ', CAST(p_size AS STRING), 'x90 мм', chr(10))
    ELSE concat('Формат: 60x90/16', chr(10)) END,
  CASE p_partkey % 5 WHEN 0 THEN concat('Тип обложки: Мягкая обложка', chr(10))
    WHEN 1 THEN concat(chr(10), 'Твёрдый переплет, ламинация', chr(10))
    WHEN 2 THEN concat(chr(10), 'Издание: обложка мягкий картон', chr(10))
    ELSE '' END,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('Язык: ', chr(10), ' ', CASE WHEN p_partkey % 2 = 0 THEN 'Русский' ELSE 'English' END, chr(10)) END,
  CASE WHEN p_partkey % 10 = 0 THEN '' ELSE concat('Возрастные ограничения: ', CAST(p_partkey % 19 AS STRING), chr(10)) END,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('Жанры: ', p_type, ' №', CAST(p_size AS STRING), 'в', chr(160), ', ', replace(p_name, ' ', ', '), chr(10), 'Теги: ', p_brand, chr(10)) END,
  CASE WHEN p_partkey % 4 = 1 THEN '' ELSE concat('Переводчик: Иванов, ', p_brand, chr(10)) END)"""

RATING_EXPR = """concat(CAST(p_partkey % 5 AS STRING), ',', CAST(p_size % 10 AS STRING), chr(160), chr(10), 'оценок: ', CAST(p_size AS STRING))"""

STAT_EXPR = """CASE WHEN p_partkey % 3 = 0 THEN concat(CAST(p_size AS STRING), chr(10), 'Прочитали')
  ELSE concat(CAST(p_size AS STRING), chr(10), 'Прочитали', chr(10), CAST(p_size * 2 AS STRING), chr(10), 'Планируют', chr(10),
    CAST(p_size % 3 AS STRING), chr(10), 'Отзывы', chr(10), 'Цитаты', chr(10), CAST(p_size % 4 AS STRING)) END"""

EDITION_EXPR = """concat('Издание', chr(10), CASE WHEN p_partkey % 14 = 0 THEN '' ELSE concat(' ', p_type, ' ') END)"""

INFO_SQL = f"SELECT p_partkey AS book_key, {INFO_EXPR} AS info FROM part\n"
STAT_SQL = (f"SELECT p_partkey AS book_key, {RATING_EXPR} AS rating_block, {STAT_EXPR} AS stat_block, "
            f"{EDITION_EXPR} AS edition_block FROM part\n")

# A book page in the layout the extractor expects (title, author link,
# information block, rating, stats, edition table with a publisher link), with
# what real pages hold besides: a comment and a script with markup in them, a
# class that only begins like a wanted one, a block nested in a block of its
# own tag, upper-case tags and other ways to write an attribute. Every 29th
# page lacks its rating, every 31st its author link, every 37th its edition.
BOOK_PAGE_SQL = f"""
SELECT p_partkey AS page_id,
  concat('https://books.example.org/book/', CAST(p_partkey AS STRING), '-', replace(p_name, ' ', '-')) AS url,
  concat('<html><body><!-- <h1 class="bc__book-title">old</h1> -->',
    '<script>var s = "<div class=bc-info>no</div>";</script>',
    CASE WHEN p_partkey % 4 = 0 THEN concat('<H1 title="a > b" CLASS = "wide bc__book-title">Книга ', p_name, '</H1>')
      ELSE concat('<h1 class="bc__book-title">', p_name, '</h1>') END,
    '<h2 class="bc-author">',
    CASE WHEN p_partkey % 31 = 0 THEN p_brand ELSE concat(
      '<a class="bc-author__link" href=', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '"' END,
      '/author/', replace(p_brand, 'Brand#', ''), '-', lower(replace(p_brand, '#', '')),
      CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '"' END, '>', p_brand, '</a>') END, '</h2>',
    '<div class="bc-info">', CASE WHEN p_partkey % 3 = 0 THEN '<div class="share"></div>' ELSE '' END,
    replace(replace({INFO_EXPR}, '&', '&amp;'), chr(10), concat('<br>', chr(10))), '</div>',
    '<div class="bc-rating-medium">9,9</div>',
    CASE WHEN p_partkey % 29 = 0 THEN '' ELSE concat('<div class="bc-rating">', {RATING_EXPR}, '</div>') END,
    '<div class="bc-stat">', {STAT_EXPR}, '</div>',
    CASE WHEN p_partkey % 37 = 0 THEN '' ELSE concat(
      '<table class="bc-edition"><tr><td>', replace({EDITION_EXPR}, chr(10), concat('</td></tr>', chr(10), '<tr><td>')), '</td></tr>',
      CASE WHEN p_partkey % 13 = 0 THEN ''
        ELSE concat(chr(10), '<tr><td><a class="bc-edition__link" href="/publisher/', CAST(p_partkey % 17 AS STRING), '-pub">pub</a></td></tr>') END,
      chr(10), '<tr><td><a class="bc-edition__link" href="/series/', CAST(p_size AS STRING), '">series</a></td></tr></table>') END,
    '</body></html>') AS html
FROM part
"""

# An author page: profile name and status, five counters by title attribute.
AUTHOR_PAGE_SQL = """
SELECT c_custkey AS page_id,
  concat('https://books.example.org/author/', CAST(c_custkey AS STRING), '-', lower(replace(c_name, '#', '-'))) AS url,
  concat('<html><body><div class="header-profile"><span class="header-profile-login">', c_name, '</span>', chr(10),
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('<span class="header-profile-status">', c_mktsegment, chr(10), '</span>') END,
    '<div class="stats">',
    CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('<span title="Писатель понравился">', CAST(c_custkey % 100 AS STRING), '</span>') END,
    '<span title="Отнеслись нейтрально">', CAST(c_nationkey AS STRING), '</span>',
    CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '<span title="Писатель не понравился">4</span>' END,
    '<span title="Почитатели творчества"><b>', CAST(c_custkey % 10 AS STRING), '</b></span>',
    CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '<span title="Читателей">7</span>' END,
    '</div></div></body></html>') AS html
FROM customer
"""

# A publisher page: title, list items with counts, founding-year paragraph,
# site link and favourites count; every 11th page lacks the book count.
PUBLISHER_PAGE_SQL = """
SELECT s_suppkey AS page_id,
  concat('https://books.example.org/publisher/', CAST(s_suppkey AS STRING), '-', lower(replace(s_name, '#', '-'))) AS url,
  concat('<html><head><title id="title-head">Издательство «', s_name, '» &amp; Co</title></head><body><ul>',
    '<li class="standard"><a href="/publisher/', CAST(s_suppkey AS STRING), '/authors">Авторы (', CAST(s_nationkey AS STRING), ')</a></li>',
    CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE concat('<li class="standard"><a href="/publisher/', CAST(s_suppkey AS STRING),
      '/books">Книги (', CAST(s_nationkey + 1 AS STRING), ')</a></li>') END,
    '</ul><p>О компании</p>',
    CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat('<p><b>Год основания: </b>', chr(10), CAST(1900 + s_suppkey % 120 AS STRING), ' </p>') END,
    CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE concat('<a class="publisher-link" href="https://', lower(replace(s_name, '#', '')), '.example.org">', lower(replace(s_name, '#', '')), '.example.org</a>') END,
    CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE concat('<span class="count-in-fav">(', CAST(s_suppkey AS STRING), ')</span>') END,
    '</body></html>') AS html
FROM supplier
"""

# A listing page of new books: 20 books per page (part keys k*20 .. k*20+19),
# each a titled anchor of the listing's item class, plus navigation anchors.
LISTING_PAGE_SIZE = 20
LISTING_PAGE_SQL = f"""
SELECT page_no AS page_id,
  concat('https://books.example.org/books/novelties/listview/biglist/~', CAST(page_no + 1 AS STRING)) AS url,
  concat('<html><body><nav><a class="nav-link" href="/books/novelties">new</a></nav><ul>',
    array_join(array_sort(collect_list(item)), ''),
    '</ul><a class="pagination" href="/books/novelties/listview/biglist/~', CAST(page_no + 2 AS STRING), '">next</a></body></html>') AS html
FROM (SELECT CAST(floor(p_partkey / {LISTING_PAGE_SIZE}) AS BIGINT) AS page_no,
        concat('<li><a class="book-item__link" href="/book/', CAST(p_partkey AS STRING), '-', replace(p_name, ' ', '-'), '">', p_name, '</a></li>') AS item
      FROM part
      )
GROUP BY page_no
"""


def _render(spark: SparkSession, sf_dir: str, sql: str, table: str, key: str) -> DataFrame:
    """Run a rendering SQL text over a driver table spread over the session's
    cores.

    Rendering and regex extraction cost far more per row than the scan; a
    small table read as one split would run all of it in one task. A large
    scan already has more splits than cores and is left as it is (no shuffle
    of big inputs)."""
    return sql_over(spark, sql, table, spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"), key))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-repartition `df` on `key` only when it has fewer partitions than
    the session's default parallelism."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):  # no RDD view (Spark Connect): leave the layout to the scan
        return df
    return df.repartition(cores, key) if parts < cores else df


def info_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(spark, sf_dir, INFO_SQL, "part", "p_partkey")


def stat_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(spark, sf_dir, STAT_SQL, "part", "p_partkey")


def book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(spark, sf_dir, BOOK_PAGE_SQL, "part", "p_partkey")


def relanded_book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second landing of two thirds of the book pages, where every second missing rating is there."""
    repaired = BOOK_PAGE_SQL.replace("p_partkey % 29 = 0", "p_partkey % 58 = 0")
    return _render(spark, sf_dir, f"{repaired} WHERE p_partkey % 3 <> 0", "part", "p_partkey")


def author_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(spark, sf_dir, AUTHOR_PAGE_SQL, "customer", "c_custkey")


def publisher_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(spark, sf_dir, PUBLISHER_PAGE_SQL, "supplier", "s_suppkey")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(spark, sf_dir, LISTING_PAGE_SQL, "part", "p_partkey")
