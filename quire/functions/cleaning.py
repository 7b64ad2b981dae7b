"""Column -> Column cleaning helpers (sentinels, lenient casts, regex rules).

Every helper is a built-in Spark expression, so a whole cleaning stage stays
inside one whole-stage-codegen Project. Under ANSI mode (Spark 4 default)
plain casts throw on dirty text, so all lenient casts are `try_cast`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's for equal results -------
SENTINEL = "null"                     # string written by the extractors on failure
SENTINEL_LIST = "['null']"            # stringified one-element list, genres only
DEFAULT_ISBN = "unknown"
DEFAULT_SIZE = "130x200"
DEFAULT_AGE = "13"
DEFAULT_GENRE = "Проза"
DEFAULT_TRANSLATOR = "unknown"
DEFAULT_SERIES = "Standalone"
DEFAULT_ORIGINALNAME = "unknown"
DEFAULT_PAGE = "none"
DEFAULT_LANGUAGE_CYRILLIC = "Русский"
PAGES_OUTLIER = 10000
SOFT_COVER_WORDS = ["мягкая", "мягкий"]
HARD_COVER_WORDS = ["твёрдая", "твердый", "твёрдый", "твердая"]
SIZE_NOISE_REGEX = r"\.|\,|\-|\~|\;|мм|mm"
SIZE_TIMES_LITERAL = r"XХх×\*"        # a literal run in the reference, not a class
SIZE_TIMES_CLASS = r"[XХх×*]"         # what was meant
TRANSLATOR_NOISE_REGEX = r"\d|\-|стр\.|роман"
TRANSLATOR_AND_REGEX = r"\sи\s"
TRANSLATOR_AND_REFERENCE = ",s"       # Java replacement ",\s" yields a literal s
TRANSLATOR_AND_CORRECTED = ", "
PUBLISHER_NAME_NOISE_REGEX = r"\«|\»|Издательство"
BOOK_COUNT_NOISE_REGEX = r"\(|\)|Книги"
PARENS_REGEX = r"\(|\)"
LIST_BRACKETS_REGEX = r"\[|\]"
CYRILLIC_REGEX = r"[\p{IsCyrillic}]"
# ---------------------------------------------------------------------------


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c, sentinel: str = SENTINEL) -> Column:
    """'null' -> NULL; SQL NULL stays NULL."""
    c = as_col(c)
    return F.when(c == F.lit(sentinel), F.lit(None).cast("string")).otherwise(c)


def sentinel_to_default(c, default: str, sentinel: str = SENTINEL) -> Column:
    """'null' -> default; SQL NULL stays NULL (C2). Default is kept a string so
    the column type never silently changes under ANSI coercion."""
    c = as_col(c)
    return F.when(c == F.lit(sentinel), F.lit(default)).otherwise(c)


def empty_to_default(c, default: str) -> Column:
    """'' -> default; 'null' and NULL untouched."""
    c = as_col(c)
    return F.when(c == F.lit(""), F.lit(default)).otherwise(c)


def null_to_default(c, default) -> Column:
    """SQL NULL -> default (C4)."""
    return F.coalesce(as_col(c), F.lit(default))


def double_lenient(c) -> Column:
    """String -> double; unparsable -> NULL."""
    return as_col(c).try_cast("double")


def int_lenient(c) -> Column:
    """String -> int the way a non-ANSI cast reads it: blanks trimmed,
    '2005.5' -> 2005, '-2.7' -> -2; text, NaN and overflow -> NULL (C9)."""
    return as_col(c).try_cast("double").try_cast("int")


def first_int(c) -> Column:
    """First run of ASCII digits -> int; no digits -> NULL (I14). Also drops a
    leading BOM or a trailing slug from ids."""
    return F.regexp_extract(as_col(c), r"\d+", 0).try_cast("int")


def strip_list_syntax(c) -> Column:
    """"['a', 'b']" -> "a, b": delete brackets, then quotes."""
    return F.replace(F.regexp_replace(as_col(c), LIST_BRACKETS_REGEX, ""), F.lit("'"), F.lit(""))


def list_items(c) -> Column:
    """Stringified list -> array of items with spaces removed."""
    return F.split(F.regexp_replace(as_col(c), r"[\[\]' ]", ""), ",")


def cover_code(c) -> Column:
    """Cover type spelled 6 ways -> H / S; sentinel -> S; other text kept."""
    c = as_col(c)
    low = F.lower(c)
    return (F.when(c == F.lit(SENTINEL), F.lit("S"))
            .when(low.isin(*SOFT_COVER_WORDS), F.lit("S"))
            .when(low.isin(*HARD_COVER_WORDS), F.lit("H"))
            .otherwise(c))


def size_normalize(c, corrected: bool = False) -> Column:
    """Book format: default for sentinel, drop punctuation and units, spaces,
    unify the multiplication sign, keep the part inside parentheses (J6)."""
    s = sentinel_to_default(c, DEFAULT_SIZE)
    s = F.regexp_replace(s, SIZE_NOISE_REGEX, "")
    s = F.replace(s, F.lit(" "), F.lit(""))
    s = F.regexp_replace(s, SIZE_TIMES_CLASS if corrected else SIZE_TIMES_LITERAL, "x")
    s = F.regexp_replace(s, r".+\(", "")
    return F.regexp_replace(s, r"\).*", "")


def translator_clean(c, corrected: bool = False) -> Column:
    """Translator names: default, list syntax, digits / dashes / page marks,
    conjunction to comma (J12)."""
    s = strip_list_syntax(sentinel_to_default(c, DEFAULT_TRANSLATOR))
    s = F.regexp_replace(s, TRANSLATOR_NOISE_REGEX, "")
    return F.regexp_replace(s, TRANSLATOR_AND_REGEX,
                            TRANSLATOR_AND_CORRECTED if corrected else TRANSLATOR_AND_REFERENCE)


def rating_clean(c) -> Column:
    """Decimal comma -> dot, then sentinel -> 0, as double."""
    return double_lenient(sentinel_to_default(F.replace(as_col(c), F.lit(","), F.lit(".")), "0"))


def genres_clean(c) -> Column:
    """"['null']" -> default genre; list syntax stripped."""
    return strip_list_syntax(sentinel_to_default(c, DEFAULT_GENRE, sentinel=SENTINEL_LIST))


def has_cyrillic(c) -> Column:
    return as_col(c).rlike(CYRILLIC_REGEX)


def language_fill(language, title) -> Column:
    """'null' -> NULL; a missing language with a Cyrillic title -> Русский."""
    lang = sentinel_to_null(language)
    return F.when(lang.isNull() & has_cyrillic(title), F.lit(DEFAULT_LANGUAGE_CYRILLIC)).otherwise(lang)


def publisher_name_clean(c) -> Column:
    """Drop guillemets and the word for publishing house; not trimmed."""
    return F.regexp_replace(as_col(c), PUBLISHER_NAME_NOISE_REGEX, "")


def book_count_clean(c) -> Column:
    """'Книги (345)' -> ' 345' (I13)."""
    return F.regexp_replace(as_col(c), BOOK_COUNT_NOISE_REGEX, "")


def strip_parens(c) -> Column:
    return F.regexp_replace(as_col(c), PARENS_REGEX, "")


def strip_ws(c) -> Column:
    """Leading and trailing whitespace removed (not only spaces)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def squeeze_whitespace(c, space_to: str = " ") -> Column:
    """Runs of newlines -> one newline, runs of spaces -> `space_to`, stripped."""
    s = F.regexp_replace(as_col(c), r"\n+", "\n")
    s = F.regexp_replace(s, r" +", space_to)
    return strip_ws(s)


def drop_nbsp(c) -> Column:
    """Delete no-break space U+00A0 and en space U+2002."""
    return F.translate(as_col(c), "\u00a0\u2002", "")


def nth_line(c, i: int, default: str | None = SENTINEL) -> Column:
    """Line i (0-based) of a text block; missing line -> default."""
    line = F.get(F.split(as_col(c), "\n"), i)
    return line if default is None else F.coalesce(line, F.lit(default))


def first_match(c, patterns: list[str], group: int = 0) -> Column:
    """Value of the first pattern that matches (I22); NULL when none does."""
    parts = [F.nullif(F.regexp_extract(as_col(c), p, group), F.lit("")) for p in patterns]
    return F.coalesce(*parts)


def all_matches(c, pattern: str, group: int = 0) -> Column:
    """Array of every match of `pattern`."""
    return F.regexp_extract_all(as_col(c), F.lit(pattern), group)


def id_from_url(url, prefix_regex: str) -> Column:
    """Entity id from a URL: text after the prefix up to the first '-', '/', '?'
    or '#' (C16). Empty when the prefix is absent."""
    return F.regexp_extract(as_col(url), prefix_regex + r"([^-/?#]*)", 1)


def url_from_id(id_col, prefix: str) -> Column:
    """C17."""
    return F.concat(F.lit(prefix), as_col(id_col))
