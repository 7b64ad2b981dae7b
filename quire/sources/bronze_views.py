"""Bronze-shaped views over the driver's TPC-H-like tables.

The reference lands its catalogue as all-string bronze tables. We have no
crawl here, so each bronze table is re-shaped from a driver table with one
SQL text that Spark and DuckDB both run unchanged: every row of the source
table is kept; the CASE arms only plant the three missing-value encodings
('null' string, "['null']" list, SQL NULL) and the dirty formats the cleaning
rules exist for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BRONZE_BOOKS_SQL = """
SELECT concat(CAST(p_partkey AS STRING), '-', replace(p_name, ' ', '-')) AS id,
  CASE WHEN p_partkey % 4 = 0 THEN concat('Книга ', p_name) ELSE p_name END AS booktitle,
  p_brand AS author,
  CASE WHEN p_partkey % 11 = 0 THEN 'null' ELSE replace(p_brand, 'Brand#', '') END AS authorid,
  CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE concat('[''978-5-', CAST(1000000 + p_partkey AS STRING), '-X'']') END AS isbn,
  CASE WHEN p_partkey % 5 = 0 THEN 'null' ELSE CAST(1950 + p_size AS STRING) END AS editionyear,
  CASE WHEN p_partkey % 7 = 0 THEN 'null' WHEN p_partkey % 97 = 0 THEN '20000' ELSE CAST(p_size AS STRING) END AS pages,
  CASE WHEN p_partkey % 6 = 0 THEN 'null' WHEN p_partkey % 6 = 1 THEN '84x108/32 (130x200 мм)' WHEN p_partkey % 6 = 2 THEN '130.5х200' ELSE '60 x 90; mm' END AS size,
  CASE WHEN p_partkey % 3 = 0 THEN 'null' WHEN p_partkey % 3 = 1 THEN 'Мягкая' ELSE 'твёрдый' END AS covertype,
  CASE WHEN p_partkey % 2 = 0 THEN 'null' ELSE 'English' END AS language,
  CASE WHEN p_partkey % 8 = 0 THEN 'null' ELSE CAST(p_size * 100 AS STRING) END AS copiesissued,
  CASE WHEN p_partkey % 10 = 0 THEN 'null' ELSE CAST(p_partkey % 19 AS STRING) END AS agerestrictions,
  CASE WHEN p_partkey % 17 = 0 THEN '[''null'']' ELSE concat('[''', replace(p_name, ' ', ''', '''), ''', ''', p_type, ''']') END AS genres,
  CASE WHEN p_partkey % 4 = 1 THEN 'null' ELSE '[''Иванов и Петров, стр.12'']' END AS translatorname,
  CASE WHEN p_partkey % 23 = 0 THEN 'null' ELSE concat(CAST(p_partkey % 5 AS STRING), ',', CAST(p_size % 10 AS STRING)) END AS rating,
  CASE WHEN p_partkey % 12 = 0 THEN 'null' ELSE CAST(p_size AS STRING) END AS haveread,
  CAST(p_size * 2 AS STRING) AS planned, CAST(p_size % 3 AS STRING) AS reviews, CAST(p_size % 4 AS STRING) AS quotes,
  CASE WHEN p_partkey % 14 = 0 THEN 'null' ELSE p_type END AS series,
  CASE WHEN p_partkey % 13 = 0 THEN 'null' ELSE concat(CAST(p_partkey % 17 AS STRING), '-pub') END AS publisherid
FROM part
"""

BRONZE_AUTHORS_SQL = """
SELECT concat(CAST(c_custkey AS STRING), '-', replace(c_name, '#', '-')) AS authorid, c_name AS name,
  CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN 'null' ELSE c_mktsegment END AS originalname,
  CASE WHEN c_custkey % 7 = 0 THEN 'null' ELSE CAST(c_custkey % 100 AS STRING) END AS liked,
  CAST(c_nationkey AS STRING) AS neutral, CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '4' END AS disliked,
  CAST(c_custkey % 10 AS STRING) AS favorite, CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '7' END AS reading
FROM customer
"""

BRONZE_PUBLISHERS_SQL = """
SELECT concat(CAST(s_suppkey AS STRING), '-pub') AS publisherid, concat('Издательство «', s_name, '»') AS name,
  concat('Книги (', CAST(s_nationkey + 1 AS STRING), ')') AS books,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(1900 + s_suppkey % 120 AS STRING) END AS years,
  CASE WHEN s_suppkey % 4 = 0 THEN 'null' ELSE s_name END AS page,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN 'null' ELSE concat('(', CAST(s_suppkey AS STRING), ')') END AS favorite
FROM supplier
"""

BRONZE_SQL = {"books": BRONZE_BOOKS_SQL, "authors": BRONZE_AUTHORS_SQL,
              "publishers": BRONZE_PUBLISHERS_SQL}
SOURCE_TABLE = {"books": "part", "authors": "customer", "publishers": "supplier"}


def sql_over(spark: SparkSession, sql: str, table: str, df: DataFrame) -> DataFrame:
    """Run a shared SQL text whose only input is `FROM <table>`, binding the
    DataFrame directly (no session-global temp view; the scan stays lazy and
    prunable)."""
    return spark.sql(sql.replace(f"FROM {table}\n", f"FROM {{{table}}}\n"), **{table: df})


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """All-string bronze table `entity` (books | authors | publishers) from sf_dir."""
    table = SOURCE_TABLE[entity]
    return sql_over(spark, BRONZE_SQL[entity], table, spark.read.parquet(f"{sf_dir}/{table}.parquet"))

