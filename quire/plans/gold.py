"""Gold jobs: books dimension, genre dictionary, book-genre bridge, and the
insert-ignore of authors / publishers (J27-J29, E3, G1, G3, D4, B7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.dedupe import insert_ignore
from quire.operators.ids import Numbered, dense_ids
from quire.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, join_dimension, join_split
from quire.sources.schemas import GOLD_BOOKS_DROPPED, KEYS

GENRE_SEPARATOR = ", "
# Postings of the inverted index are cut into blocks of book ids that share
# `book_id div POSTING_BLOCK`, so no row ever holds more than this many ids.
POSTING_BLOCK = 1024


def books(silver_books: DataFrame) -> DataFrame:
    """gold.books: silver.books without four descriptive columns."""
    return silver_books.drop(*GOLD_BOOKS_DROPPED)


def genre_pairs(silver_books: DataFrame, corrected: bool = False) -> DataFrame:
    """(book_id, genre) for every listed genre: lower-case, split on ', ',
    explode (I1, I15, I16). Genres are not trimmed unless `corrected`."""
    genre = F.explode(F.split(F.lower(F.col("genres")), GENRE_SEPARATOR)).alias("genre")
    pairs = silver_books.select(F.col("id").alias("book_id"), genre)
    if corrected:
        pairs = pairs.withColumn("genre", F.trim("genre"))
    return pairs


def genre_dictionary(pairs: DataFrame) -> Numbered:
    """gold.genres(genre, id): distinct genres numbered densely in genre order
    (J28, G3). Returns the frame (checkpointed, so ids are fixed) with its row
    count and payload bytes."""
    return dense_ids(pairs.select("genre").distinct(), ["genre"], "id")


def extend_dictionary(stored: DataFrame, pairs: DataFrame) -> tuple[Numbered, DataFrame]:
    """gold.genres over several days: (the whole dictionary, its new rows). Genres of the stored
    dictionary (genre, id) keep their ids, those of genres that no book has any more included; new
    genres follow the largest stored id in genre order. Only new genres are sorted and numbered."""
    fresh = pairs.select("genre").distinct().join(stored.select("genre"), "genre", "left_anti")
    numbered = dense_ids(fresh, ["genre"], "id")
    last, rows, size = stored.agg(F.max("id"), F.count(F.lit(1)), F.sum(F.octet_length("genre") + 8)).first()
    first = 0 if last is None else last + 1
    added = numbered.frame.select("genre", (F.col("id") + first).alias("id"))
    return Numbered(stored.select("genre", "id").unionByName(added), rows + numbered.rows,
                    (size or 0) + numbered.payload_bytes), added


def book_genre(pairs: DataFrame, genres: Numbered) -> DataFrame:
    """gold.book_genre(genre_id, book_id): distinct pairs with a known book id,
    joined to the dictionary (D4; broadcast only within the measured size
    bounds, else split at the frequent genres), sorted by book (G1)."""
    known = pairs.where(F.col("book_id").isNotNull()).distinct()
    if genres.rows <= BROADCAST_MAX_ROWS and genres.payload_bytes <= BROADCAST_MAX_BYTES:
        bridged = join_dimension(known, genres.frame, "genre", "inner",
                                 dim_rows=genres.rows, dim_bytes=genres.payload_bytes)
    else:  # a popular genre is dealt over all tasks
        weights = known.groupBy("genre").agg(F.count(F.lit(1)).alias("__rows"))
        bridged = join_split(known, genres.frame.join(weights, "genre"), "genre", "__rows", "inner")
    return bridged.select(F.col("id").alias("genre_id"), "book_id") \
        .orderBy("book_id", "genre_id")


def genre_postings(pairs: DataFrame, block: int = POSTING_BLOCK) -> DataFrame:
    """Inverted index genre -> sorted set of book ids (E3), cut into blocks of
    at most `block` ids so a popular genre is many bounded rows, not one
    unbounded array; partial aggregation dedupes map-side."""
    known = pairs.where(F.col("book_id").isNotNull())
    grouped = known.groupBy("genre", F.floor(F.col("book_id") / block).alias("block")) \
        .agg(F.array_sort(F.collect_set("book_id")).alias("book_ids"))
    return grouped.withColumn("n_books", F.size("book_ids").cast("long"))


def merge_entity(gold_existing: DataFrame, silver: DataFrame, entity: str) -> DataFrame:
    """gold.authors / gold.publishers after insert-ignore of silver."""
    return insert_ignore(gold_existing, silver.select(*gold_existing.columns), KEYS[entity])


@dataclass
class GoldTables:
    books: DataFrame
    genres: DataFrame
    book_genre: DataFrame
    genre_count: int
    new_genres: DataFrame | None = None


def build(silver_books: DataFrame, corrected: bool = False, stored_genres: DataFrame | None = None) -> GoldTables:
    """The gold tables of silver books. With the dictionary of earlier days, known genres keep their ids."""
    pairs = genre_pairs(silver_books, corrected)
    genres, added = (genre_dictionary(pairs), None) if stored_genres is None else extend_dictionary(stored_genres, pairs)
    return GoldTables(books(silver_books), genres.frame, book_genre(pairs, genres), genres.rows, added)
