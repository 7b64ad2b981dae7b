"""The daily job: staged batch -> bronze merge -> silver -> validate -> gold.

Every step is a Spark job over whole tables; the driver only sequences them
and reads the validation verdict (a handful of rows). All outputs go under
`root`, which on a cluster must be shared storage. Each step is deterministic
(total-order survivors, checkpointed ids), so task retries after a lost
executor rewrite identical rows, and re-running the whole job with the same
batch changes nothing (insert-ignore merges).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.dedupe import merge_into_bucketed_table, new_rows_of_batch
from quire.operators.validate import ValidationFailed, validate, write_and_validate
from quire.plans import gold, silver
from quire.sources import io
from quire.sources.schemas import BRONZE, GOLD, KEYS
from quire.sources.versions import KEEP, Versions

ENTITIES = ("books", "authors", "publishers")


@dataclass(frozen=True)
class Layout:
    root: str

    def bronze_root(self) -> str:
        return f"{self.root}/bronze"

    def bronze(self, entity: str) -> str:
        """Where the merged bronze table lies (needs a session)."""
        return self._published(self.bronze_root(), f"{entity}_raw")

    def silver(self, entity: str) -> str:
        return f"{self.root}/silver/{entity}"

    def gold_root(self) -> str:
        return f"{self.root}/gold"

    def gold(self, table: str) -> str:
        """Where the published version of a gold table lies (needs a session)."""
        return self._published(self.gold_root(), table)

    @staticmethod
    def _published(root: str, table: str) -> str:
        spark = SparkSession.getActiveSession()
        published = Versions(spark, root).path(table) if spark is not None else None
        return published or f"{root}/{table}"

    def results(self) -> str:
        return f"{self.root}/validation/results"


def merge_bronze(spark: SparkSession, layout: Layout, entity: str, staged: DataFrame) -> DataFrame:
    """Insert-ignore a staged batch into bronze `<entity>_raw` (B6). The new
    rows are checkpointed first: computed once, and the returned frame does
    not change when the table it was compared against grows. Bronze is a layer of versions:
    the batch becomes visible by one commit, and small files of earlier batches are rewritten with it in the
    order of the key, so that their number stays bounded over the days. A batch without new rows writes nothing."""
    layer, table = Versions(spark, layout.bronze_root()), f"{entity}_raw"
    draft = layer.begin()
    draft.adopt(table)
    stored = io.read_or_empty(spark, layout.bronze(entity), BRONZE[entity]) if table not in layer.tables() \
        else layer.read(table, BRONZE[entity])
    added = new_rows_of_batch(stored, staged.select(*BRONZE[entity].names), KEYS[entity]).checkpoint(eager=True)
    if table not in draft.tables or not added.isEmpty():
        draft.append(table, added, BRONZE[entity], KEYS[entity])
        draft.commit()
        layer.vacuum(KEEP * len(ENTITIES))  # every run commits once for each entity
    return added


def merge_bronze_table(entity: str, staged: DataFrame, table_prefix: str = "bronze_",
                       buckets: int | None = None) -> DataFrame:
    """Catalog-table variant of `merge_bronze`: `<prefix><entity>_raw` is kept
    bucketed by its key, so the daily anti join never shuffles the stored rows."""
    return merge_into_bucketed_table(staged.select(*BRONZE[entity].names),
                                     f"{table_prefix}{entity}_raw", KEYS[entity], buckets)


def build_silver(spark: SparkSession, layout: Layout, corrected: bool = False) -> DataFrame:
    """Write the three silver tables. The gold books suite (its columns are all
    in silver books) is evaluated while silver books is written, so the gate
    needs no further scan of it; returns those result rows. Insert-ignore keeps
    bronze unique by its raw key, so that de-duplication is left out."""
    read = lambda e: spark.read.schema(BRONZE[e]).parquet(layout.bronze(e))
    books_results = write_and_validate(
        silver.books(read("books"), corrected, unique=True), "gold_books",
        lambda df: io.overwrite(df, layout.silver("books")),
        reread=lambda: spark.read.parquet(layout.silver("books")))
    io.overwrite(silver.authors(read("authors"), unique=True), layout.silver("authors"))
    io.overwrite(silver.publishers(read("publishers"), unique=True), layout.silver("publishers"))
    return books_results.checkpoint(eager=True)


def publish_gold(spark: SparkSession, layout: Layout, corrected: bool = False,
                 books_results: DataFrame | None = None, keep_versions: int = KEEP) -> DataFrame:
    """Validate all three candidate gold tables, then publish only if all pass
    (L6, L7). On success books are overwritten within their schema (B2), authors /
    publishers get their new keys (insert-ignore, B7), the genre dictionary its new genres, and
    the bridge is rebuilt. The five tables are written to a new version and published by
    one commit; a run that stops anywhere before leaves the old five. Versions beyond
    `keep_versions` are removed. The result rows are appended to the validation table either way."""
    layer = Versions(spark, layout.gold_root())
    sb = spark.read.parquet(layout.silver("books"))
    candidates = {"gold_books": gold.books(sb)}
    added = {}
    for entity in ("authors", "publishers"):
        existing = layer.read(entity, GOLD[entity])
        staged = spark.read.parquet(layout.silver(entity))
        # computed once: validated as part of the merged table, then appended
        added[entity] = new_rows_of_batch(existing, staged.select(*existing.columns), KEYS[entity]).checkpoint(eager=True)
        candidates[f"gold_{entity}"] = existing.unionByName(added[entity])

    results = books_results
    for suite, df in candidates.items():
        if suite == "gold_books" and books_results is not None:
            continue  # evaluated while silver books was written
        r = validate(df, suite)
        results = r if results is None else results.unionByName(r)
    results = results.checkpoint(eager=True)  # one evaluation for the table and the verdict
    io.append(results, layout.results())
    failed = results.where(~F.coalesce(F.col("success"), F.lit(False))) \
        .select("suite", "expectation", "column_name").collect()  # at most 41 rows
    if failed:
        raise ValidationFailed("; ".join(f"{r[0]}: {r[1]}({r[2]})" for r in failed))

    draft = layer.begin()
    draft.write("books", candidates["gold_books"], GOLD["books"])
    for entity in ("authors", "publishers"):
        draft.append(entity, added[entity], GOLD[entity])
    tables = gold.build(sb, corrected, layer.read("genres", GOLD["genres"]))
    draft.append("genres", tables.new_genres, GOLD["genres"])
    draft.write("book_genre", tables.book_genre, GOLD["book_genre"])
    draft.commit()
    layer.vacuum(keep_versions)
    return results


def run(spark: SparkSession, staged: dict[str, DataFrame], root: str, corrected: bool = False) -> DataFrame:
    """One daily run over staged batches {entity: all-string frame}."""
    layout = Layout(root)
    for entity in ENTITIES:
        merge_bronze(spark, layout, entity, staged[entity])
    books_results = build_silver(spark, layout, corrected)
    return publish_gold(spark, layout, corrected, books_results)

