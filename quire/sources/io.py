"""Readers and writers of the three layers.

Tables live as Parquet folders (or catalog tables); staging files are
headerless CSV and URL lists are text, as in the reference's landing area.
A JDBC source is supported through options that split the scan into
parallel ranges, which the reference's single-partition reads lack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.sources.csv_ranges import read_csv_ranges
from quire.sources.schemas import BRONZE

CSV_NULL_MARKER = "\u0000"
# Reader options of staged CSV (batch and stream). Unquoted empty fields come
# back as `nullValue`, quoted "" as ''; a marker that never occurs in text
# keeps the two apart.
STAGED_CSV_READ = {"header": "false", "multiLine": "true", "quote": '"', "escape": '"',
                   "encoding": "UTF-8", "nullValue": CSV_NULL_MARKER, "lineSep": "\n"}


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetchsize: int = 10000, driver: str | None = None) -> dict[str, str]:
    """Options for `spark.read.format('jdbc')` (A1/A2). With a numeric
    partition column the scan is split into `num_partitions` range queries."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC scan needs lower_bound, upper_bound, num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def jdbc_buckets(key: str, n: int, bucket_sql: str = "mod(abs(hashtext({key})), {n})") -> list[str]:
    """WHERE clauses that split a scan into `n` parts by a hash of a string key
    (range partitioning takes numbers and dates only). `bucket_sql` is the
    database's expression for a bucket in 0 .. n-1; null keys are in bucket 0."""
    if n < 1:
        raise ValueError("a scan has at least one part")
    bucket = bucket_sql.format(key=key, n=n)
    return [f"{bucket} = {i}" + (f" OR {key} IS NULL" if i == 0 else "") for i in range(n)]


def read_jdbc_buckets(spark: SparkSession, url: str, table: str, key: str, n: int,
                      properties: dict[str, str] | None = None, **kwargs) -> DataFrame:
    """A table with a string key, read by `n` tasks (A1)."""
    return spark.read.jdbc(url, table, predicates=jdbc_buckets(key, n, **kwargs), properties=properties or {})


def jdbc_write_options(url: str, table: str, user: str | None = None, password: str | None = None,
                       truncate: bool = False, batchsize: int = 10000, num_partitions: int | None = None,
                       driver: str | None = None) -> dict[str, str]:
    """Options of a JDBC sink. With mode "overwrite", `truncate` empties the
    table and keeps its schema, indexes and grants (B2); without it the table is
    dropped and created (B1). `num_partitions` bounds the connections."""
    opts = {"url": url, "dbtable": table, "truncate": str(truncate).lower(), "batchsize": str(batchsize)}
    given = {"user": user, "password": password, "driver": driver,
             "numPartitions": None if num_partitions is None else str(num_partitions)}
    return opts | {k: v for k, v in given.items() if v is not None}


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "overwrite") -> None:
    df.write.format("jdbc").mode(mode).options(**options).save()


def read_table(spark: SparkSession, source: str, fmt: str = "parquet",
               options: dict[str, str] | None = None) -> DataFrame:
    """A table by path (parquet / csv / text), by catalog name ("table") or by
    JDBC options ("jdbc", `source` ignored)."""
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.options(**(options or {}))
    if fmt == "jdbc":
        return reader.format("jdbc").load()
    return reader.format(fmt).load(source)


def read_staged_csv(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Headerless staged CSV with the all-string bronze schema (A3). A BOM is
    dropped, quoted fields may hold newlines and doubled quotes; an empty
    unquoted field is NULL, an empty quoted field is ''. A large file is read by
    many tasks (csv_ranges)."""
    return read_csv_ranges(spark, path, BRONZE[entity], STAGED_CSV_READ)


def write_staged_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headerless CSV sink (B3): quotes doubled, NULL written empty and ''
    written quoted so that the reader tells them apart; blanks at the edges of a
    value and CRLF inside one stay as they are."""
    df.write.mode(mode).options(header="false", quote='"', escape='"', ignoreLeadingWhiteSpace="false",
                                ignoreTrailingWhiteSpace="false").csv(path)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line (A5)."""
    return spark.read.text(path).select(F.col("value").alias("url")).where(F.col("url") != "")


def write_links(df: DataFrame, path: str, column: str = "url") -> None:
    """URL list sink."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Drop-and-create overwrite."""
    df.write.mode("overwrite").parquet(path)


def overwrite_keep_schema(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Overwrite the rows of an existing catalog table, keeping its schema
    (B2): columns are taken by name and cast to the table's types."""
    target = spark.table(table).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in target.fields]).write.insertInto(table, overwrite=True)


def append(df: DataFrame, path: str) -> None:
    """Append sink (H3)."""
    df.write.mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored Parquet table, or an empty frame of `schema` on first run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
