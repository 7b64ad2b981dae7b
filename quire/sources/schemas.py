"""Table schemas of the three layers (bronze all-string, silver/gold typed)."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


BOOK_COLUMNS = [
    "id", "booktitle", "author", "authorid", "isbn", "editionyear", "pages", "size",
    "covertype", "language", "copiesissued", "agerestrictions", "genres",
    "translatorname", "rating", "haveread", "planned", "reviews", "quotes", "series",
    "publisherid",
]
AUTHOR_COLUMNS = ["authorid", "name", "originalname", "liked", "neutral", "disliked",
                  "favorite", "reading"]
PUBLISHER_COLUMNS = ["publisherid", "name", "books", "years", "page", "favorite"]

# Natural keys of the bronze / silver / gold tables.
KEYS = {"books": "id", "authors": "authorid", "publishers": "publisherid"}

BRONZE = {
    "books": _strings(BOOK_COLUMNS),
    "authors": _strings(AUTHOR_COLUMNS),
    "publishers": _strings(PUBLISHER_COLUMNS),
}

_INT, _STR, _DBL, _LONG = T.IntegerType(), T.StringType(), T.DoubleType(), T.LongType()

_BOOK_TYPES = {
    "id": _INT, "authorid": _INT, "editionyear": _INT, "pages": _INT,
    "agerestrictions": _INT, "haveread": _INT, "planned": _INT, "reviews": _INT,
    "quotes": _INT, "publisherid": _INT, "rating": _DBL,
}

SILVER = {
    "books": T.StructType([T.StructField(c, _BOOK_TYPES.get(c, _STR), True)
                           for c in BOOK_COLUMNS]),
    "authors": T.StructType([T.StructField(c, _STR if c in ("name", "originalname") else _INT, True)
                             for c in AUTHOR_COLUMNS]),
    "publishers": T.StructType([T.StructField(c, _STR if c in ("name", "page") else _INT, True)
                                for c in PUBLISHER_COLUMNS]),
}

# gold.books drops four descriptive columns of silver.books.
GOLD_BOOKS_DROPPED = ["genres", "author", "translatorname", "copiesissued"]

GOLD = {
    "books": T.StructType([f for f in SILVER["books"].fields if f.name not in GOLD_BOOKS_DROPPED]),
    "genres": T.StructType([T.StructField("genre", _STR, True), T.StructField("id", _LONG, False)]),
    "book_genre": T.StructType([T.StructField("genre_id", _LONG, False),
                                T.StructField("book_id", _INT, True)]),
    # Keys stay INT in gold too, so the star joins without casts.
    "authors": SILVER["authors"],
    "publishers": SILVER["publishers"],
}

VALIDATION_RESULT = T.StructType([
    T.StructField("suite", _STR, False),
    T.StructField("expectation", _STR, False),
    T.StructField("column_name", _STR, False),
    T.StructField("success", T.BooleanType(), True),
    T.StructField("element_count", _LONG, True),
    T.StructField("unexpected_count", _LONG, True),
    T.StructField("unexpected_percent", _DBL, True),
    T.StructField("observed_value", _DBL, True),
    T.StructField("example_unexpected", _STR, True),
])
