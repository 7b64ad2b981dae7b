"""DuckDB SQL that must return the same rows as each registered Spark query.

Written independently in DuckDB's dialect (RE2 regexes with the 'g' flag for
replace-all, `TRY_CAST(trunc(..))` because DuckDB rounds double -> int,
window functions where the Spark side uses aggregates and joins). Only the
bronze views, information blocks and expectation specs are shared text/data.
"""

from __future__ import annotations

from quire.operators import validate as V
from quire.sources import blocks
from quire.sources.bronze_views import BRONZE_SQL


# --- fixed values, written out here so that no rule comes from the engine -------
BOOK_COUNT_NOISE_REGEX = r"\(|\)|Книги"
DEFAULT_AGE = "13"
DEFAULT_GENRE = "Проза"
DEFAULT_ISBN = "unknown"
DEFAULT_LANGUAGE_CYRILLIC = "Русский"
DEFAULT_ORIGINALNAME = "unknown"
DEFAULT_PAGE = "none"
DEFAULT_SERIES = "Standalone"
DEFAULT_SIZE = "130x200"
DEFAULT_TRANSLATOR = "unknown"
HARD_COVER_WORDS = ["твёрдая", "твердый", "твёрдый", "твердая"]
LIST_BRACKETS_REGEX = r"\[|\]"
PAGES_OUTLIER = 10000
PARENS_REGEX = r"\(|\)"
SENTINEL = "null"
SENTINEL_LIST = "['null']"
SIZE_NOISE_REGEX = r"\.|\,|\-|\~|\;|мм|mm"
SIZE_TIMES_CLASS = r"[XХх×*]"
SIZE_TIMES_LITERAL = r"XХх×\*"
SOFT_COVER_WORDS = ["мягкая", "мягкий"]
TRANSLATOR_AND_CORRECTED = ", "
TRANSLATOR_AND_REFERENCE = ",s"
TRANSLATOR_AND_REGEX = r"\sи\s"
TRANSLATOR_NOISE_REGEX = r"\d|\-|стр\.|роман"
ISBN_LINE = r"ISBN: [-X0-9]{10,18}.+"
ISBN_NUMBER = r"[-X0-9]{10,18}"
YEAR_LABEL = r"(?:^|[^\p{L}\p{N}_])Год.издания: (\d+)"
PAGES_PATTERNS = [r"Количество.страниц.*\d+", r"Страниц.+\d+", r"\d+.стр", r"Кол-во.страниц.*\d+"]
COPIES_LABEL = r"Тираж.? ((?:\d+[\s\x{00A0}]?)+)"
SIZE_PATTERNS = [r"Формат: .+", r"Размер: .+"]
SIZE_LABELS = r"Возрастные ограничения: .+|Формат:|Размер:"
COVER_LINE = r"Тип обложки: .+|\n.+[Пп]ереплет.+|\n.+[Оо]бложка.+"
COVER_WORD = r"[Мм]ягкий|[Мм]ягкая|[Тт]в[её]рдый|[Тт]в[её]рдая"
LANGUAGE_LABEL = r"Язык: \n (.+)"
AGE_LABEL = r"Возрастные.ограничения: (\d+)"
GENRES_BETWEEN = r"(?s)Жанры:(.*?)Теги:"
GENRES_NOISE = r" \n |\n|№\d+в"
TRANSLATOR_LABEL = r"Перевод[чик]*[и]*: (.+)"
STAT_LINES = {"haveread": 0, "planned": 2, "reviews": 4, "quotes": 7}
C1_NUMBERS = "".join(map(chr, [0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F]))
C1_MEANT = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&laquo;", "«"), ("&raquo;", "»"), ("&amp;", "&")]
COUNTERS = {"liked": "Писатель понравился", "neutral": "Отнеслись нейтрально",
            "disliked": "Писатель не понравился", "favorite": "Почитатели творчества", "reading": "Читателей"}
BOOKS_LABEL = "Книги ("
FOUNDED_LABEL = "Год основания: "
ANCHOR = r"<a\s[^>]*>"
HREF = r"\shref=[\"']?([^\"'\s>]*)"
# ---------------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- rule fragments --------------------------------------------------------------
def s_null(x):
    return f"(CASE WHEN {x} = 'null' THEN NULL ELSE {x} END)"


def s_def(x, d, sentinel="null"):
    return f"(CASE WHEN {x} = {q(sentinel)} THEN {q(d)} ELSE {x} END)"


def e_def(x, d):
    return f"(CASE WHEN {x} = '' THEN {q(d)} ELSE {x} END)"


def dbl(x):
    return f"TRY_CAST({x} AS DOUBLE)"


def int_len(x):
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def trunc_int(x):
    return f"TRY_CAST(trunc({x}) AS INTEGER)"


def first_int(x):
    return f"TRY_CAST(regexp_extract({x}, '\\d+', 0) AS INTEGER)"


def rx(x, pattern, repl):
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def strip_list(x):
    return f"replace({rx(x, LIST_BRACKETS_REGEX, '')}, '''', '')"


def cover(x):
    soft = ", ".join(q(w) for w in SOFT_COVER_WORDS)
    hard = ", ".join(q(w) for w in HARD_COVER_WORDS)
    return (f"(CASE WHEN {x} = 'null' THEN 'S' WHEN lower({x}) IN ({soft}) THEN 'S' "
            f"WHEN lower({x}) IN ({hard}) THEN 'H' ELSE {x} END)")


def size(x, corrected=False):
    s = s_def(x, DEFAULT_SIZE)
    s = rx(s, SIZE_NOISE_REGEX, "")
    s = f"replace({s}, ' ', '')"
    s = rx(s, SIZE_TIMES_CLASS if corrected else SIZE_TIMES_LITERAL, "x")
    s = rx(s, r".+\(", "")
    return rx(s, r"\).*", "")


def translator(x, corrected=False):
    s = strip_list(s_def(x, DEFAULT_TRANSLATOR))
    s = rx(s, TRANSLATOR_NOISE_REGEX, "")
    return rx(s, TRANSLATOR_AND_REGEX, TRANSLATOR_AND_CORRECTED if corrected else TRANSLATOR_AND_REFERENCE)


def rating(x):
    r = f"replace({x}, ',', '.')"
    return dbl(s_def(r, "0"))


def genres(x):
    return strip_list(s_def(x, DEFAULT_GENRE, sentinel=SENTINEL_LIST))


def language(lang, title):
    n = s_null(lang)
    return f"(CASE WHEN {n} IS NULL AND regexp_matches({title}, '\\p{{Cyrillic}}') THEN {q(DEFAULT_LANGUAGE_CYRILLIC)} ELSE {n} END)"


def order_all(cols):
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def dedupe(src, key, cols):
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in cols if c not in keys]
    return (f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order_all(others)}) = 1")


BOOK_COLS = ["id", "booktitle", "author", "authorid", "isbn", "editionyear", "pages", "size",
             "covertype", "language", "copiesissued", "agerestrictions", "genres", "translatorname",
             "rating", "haveread", "planned", "reviews", "quotes", "series", "publisherid"]
AUTHOR_COLS = ["authorid", "name", "originalname", "liked", "neutral", "disliked", "favorite", "reading"]
PUB_COLS = ["publisherid", "name", "books", "years", "page", "favorite"]


def with_bronze(*entities) -> str:
    names = {"books": "bb", "authors": "ba", "publishers": "bp"}
    return "WITH " + ", ".join(f"{names[e]} AS ({BRONZE_SQL[e]})" for e in entities)


# --- silver ------------------------------------------------------------------------
def books_once_ctes() -> str:
    kept = f"SELECT * REPLACE ({s_null('publisherid')} AS publisherid) FROM bb"
    return (f"kept AS ({kept}), kept2 AS (SELECT * FROM kept WHERE publisherid IS NOT NULL), "
            f"once AS ({dedupe('kept2', 'id', BOOK_COLS)})")


MEDIAN = f"SELECT quantile_disc({dbl('pages')}, 0.5) AS med FROM bb"


def silver_books_ctes(corrected: bool = False) -> str:
    y = int_len("editionyear")
    p_raw = s_null("pages")
    num = (f"num AS (SELECT *, {y} AS y_num, {int_len(p_raw)} AS p_num, {p_raw} AS p_raw, "
           f"avg({y}) OVER (PARTITION BY publisherid) AS y_pub, "
           f"avg({y}) OVER (PARTITION BY authorid) AS y_auth, "
           f"avg({int_len(p_raw)}) OVER (PARTITION BY authorid) AS p_auth FROM once)")
    year = (f"(CASE WHEN editionyear = 'null' OR editionyear IS NULL THEN coalesce(y_pub, y_auth) "
            f"ELSE CAST(y_num AS DOUBLE) END)")
    pages = (f"(CASE WHEN p_raw IS NULL OR p_num > {PAGES_OUTLIER} THEN "
             f"coalesce(p_auth, CAST({trunc_int('(SELECT med FROM medv)')} AS DOUBLE)) ELSE {dbl('p_raw')} END)")
    cleaned = f"""cleaned AS (SELECT {first_int('id')} AS id, booktitle, author, {first_int('authorid')} AS authorid,
      {strip_list(s_def('isbn', DEFAULT_ISBN))} AS isbn, {trunc_int(year)} AS editionyear,
      {trunc_int(pages)} AS pages, {size('size', corrected)} AS size, {cover('covertype')} AS covertype,
      {language('language', 'booktitle')} AS language, {s_null('copiesissued')} AS copiesissued,
      {int_len(s_def('agerestrictions', DEFAULT_AGE))} AS agerestrictions, {genres('genres')} AS genres,
      {translator('translatorname', corrected)} AS translatorname, {rating('rating')} AS rating,
      {', '.join(f"{int_len(s_def(c, '0'))} AS {c}" for c in ('haveread', 'planned', 'reviews', 'quotes'))},
      {s_def('series', DEFAULT_SERIES)} AS series, {first_int('publisherid')} AS publisherid FROM num)"""
    return (f"medv AS ({MEDIAN}), {books_once_ctes()}, {num}, {cleaned}, "
            f"silver_books AS ({dedupe('cleaned', 'id', BOOK_COLS)})")


def silver_authors_ctes() -> str:
    counters = ", ".join(f"{int_len(s_def(c, '0'))} AS {c}" for c in AUTHOR_COLS[3:])
    typed = (f"SELECT {first_int('authorid')} AS authorid, name, "
             f"{e_def('originalname', DEFAULT_ORIGINALNAME)} AS originalname, {counters} FROM a_once")
    return (f"a_once AS ({dedupe('ba', 'authorid', AUTHOR_COLS)}), a_typed AS ({typed}), "
            f"silver_authors AS ({dedupe('a_typed', 'authorid', AUTHOR_COLS)})")


def silver_publishers_ctes() -> str:
    mean = f"(SELECT {trunc_int(f"avg({dbl('years')})")} FROM p_once)"
    typed = (f"SELECT {first_int('publisherid')} AS publisherid, {rx('name', '«|»|Издательство', '')} AS name, "
             f"{int_len(rx('books', BOOK_COUNT_NOISE_REGEX, ''))} AS books, "
             f"(CASE WHEN years IS NULL THEN {mean} ELSE {int_len('years')} END) AS years, "
             f"{s_def('page', DEFAULT_PAGE)} AS page, "
             f"{int_len(f"coalesce({rx('favorite', PARENS_REGEX, '')}, '0')")} AS favorite FROM p_once")
    return (f"p_once AS ({dedupe('bp', 'publisherid', PUB_COLS)}), p_typed AS ({typed}), "
            f"silver_publishers AS ({dedupe('p_typed', 'publisherid', PUB_COLS)})")


def gold_books_select() -> str:
    keep = [c for c in BOOK_COLS if c not in ("genres", "author", "translatorname", "copiesissued")]
    return f"SELECT {', '.join(keep)} FROM silver_books"


GENRE_PAIRS = ("pairs AS (SELECT id AS book_id, unnest(string_split(lower(genres), ', ')) AS genre "
               "FROM silver_books WHERE genres IS NOT NULL)")
GENRES = "dict AS (SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS id FROM (SELECT DISTINCT genre FROM pairs))"


# --- validation ----------------------------------------------------------------------
def _outside(c, e):
    parts = []
    if e.min_value is not None:
        parts.append(f"{c} < {e.min_value}")
    if e.max_value is not None:
        parts.append(f"{c} > {e.max_value}")
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


def expectation_sql(table: str, suite: str, e: V.Expectation) -> str:
    c = e.column
    head = f"SELECT {q(suite)} AS suite, {q(e.kind)} AS expectation, {q(c)} AS column_name"
    n = "count(*)"
    if e.kind == V.MAX_BETWEEN:
        obs = f"CAST(max({c}) AS DOUBLE)"
        ok = f"({obs} IS NOT NULL AND NOT {_outside(obs, e)})"
        return (f"{head}, {ok} AS success, {n} AS element_count, CAST(NULL AS BIGINT) AS unexpected_count, "
                f"CAST(NULL AS DOUBLE) AS unexpected_percent, {obs} AS observed_value, "
                f"CAST(NULL AS VARCHAR) AS example_unexpected FROM {table}")
    x = "CAST(NULL AS VARCHAR)"
    if e.kind == V.NOT_NULL:
        u, d = f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)"
    elif e.kind == V.BETWEEN:
        u, d = f"count(*) FILTER (WHERE {_outside(c, e)})", f"count({c})"
        x = f"CAST(min({c}) FILTER (WHERE {_outside(c, e)}) AS VARCHAR)"
    elif e.kind == V.IN_SET:
        vals = ", ".join(q(v) for v in e.value_set)
        u, d = f"count(*) FILTER (WHERE {c} NOT IN ({vals}))", f"count({c})"
        x = f"CAST(min({c}) FILTER (WHERE {c} NOT IN ({vals})) AS VARCHAR)"
    else:  # unique
        dups = f"(SELECT {c} AS v, count(*) AS k FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        u = f"(SELECT coalesce(sum(k), 0) FROM {dups})"
        x = f"(SELECT CAST(min(v) AS VARCHAR) FROM {dups})"
        d = f"count({c})"
    pct = f"(CASE WHEN {d} > 0 THEN CAST({u} AS DOUBLE) * 100.0 / CAST({d} AS DOUBLE) END)"
    ok = f"({d} = 0 OR CAST({d} - {u} AS DOUBLE) / CAST({d} AS DOUBLE) >= {float(e.mostly)})"
    return (f"{head}, {ok} AS success, {n} AS element_count, CAST({u} AS BIGINT) AS unexpected_count, "
            f"{pct} AS unexpected_percent, CAST(NULL AS DOUBLE) AS observed_value, {x} AS example_unexpected FROM {table}")


def suite_sql(table: str, suite: str, exps=None) -> str:
    exps = V.SUITES[suite] if exps is None else exps
    return " UNION ALL ".join(expectation_sql(table, suite, e) for e in exps)


# --- pages -----------------------------------------------------------------------------
def decode_char_refs(x):
    """Written out apart from the engine's patterns: numbers by regex, characters by chr()."""
    def char(number):
        n = f"TRY_CAST({number} AS BIGINT)"
        plain = (f"CASE WHEN {n} BETWEEN 1 AND 55295 OR {n} BETWEEN 57344 AND 1114111 THEN chr(CAST({n} AS INTEGER)) "
                 f"ELSE chr(65533) END")
        return f"translate({plain}, {q(C1_NUMBERS)}, {q(C1_MEANT)})"

    dec, hx = "'^[0-9]+;'", "'^[xX][0-9a-fA-F]+;'"
    digits = "ltrim(string_split(t, ';')[1], '0')"
    hex_digits = "ltrim(substr(string_split(t, ';')[1], 2), '0')"
    piece = (f"CASE WHEN regexp_matches(t, {dec}) THEN concat({char(digits)}, regexp_replace(t, {dec}, '')) "
             f"WHEN regexp_matches(t, {hx}) THEN concat({char(f"concat('0x', {hex_digits})")}, "
             f"regexp_replace(t, {hx}, '')) ELSE concat('&#', t) END")
    parts = f"string_split({x}, '&#')"
    return (f"(CASE WHEN contains({x}, '&#') THEN concat({parts}[1], array_to_string(list_transform("
            f"list_slice({parts}, 2, len({parts})), lambda t: {piece}), '')) ELSE {x} END)")


def unescape(x):
    s = decode_char_refs(x)
    for ent, ch in ENTITIES:
        s = f"replace({s}, {q(ent)}, {q(ch)})"
    return f"(CASE WHEN contains({x}, '&') THEN {s} ELSE {x} END)"


def seen(html):
    """The page without comments, scripts and style sheets."""
    return rx(html, r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", "")


def first_text(html, pattern, space_to=" "):
    """Text of group 1 of `pattern` on the seen page; null without a match."""
    s = unescape(rx(f"regexp_extract({seen(html)}, {q(pattern)}, 1)", "<[^>]+>", ""))
    s = rx(s, r"\n+", "\n")
    s = rx(s, " +", space_to)
    s = rx(s, r"^\s+|\s+$", "")
    return f"(CASE WHEN regexp_matches({seen(html)}, {q(pattern)}) THEN {s} END)"


LINKS = f"""links AS (
  SELECT page_id, href,
    CASE WHEN regexp_matches(href, '^[a-z]+://') THEN href
         WHEN starts_with(href, '//') THEN concat(regexp_extract(url, '^[a-z]+:', 0), href) WHEN starts_with(href, '/') THEN concat(regexp_extract(url, '^[a-z]+://[^/]+', 0), href)
         ELSE href END AS link
  FROM (SELECT page_id, url, regexp_extract(tag, {q(HREF)}, 1) AS href
        FROM (SELECT page_id, url, unnest(regexp_extract_all({seen('html')}, {q(ANCHOR)}, 0)) AS tag FROM pages))
  WHERE href <> '')"""


def or_sentinel(x):
    return f"coalesce(nullif({x}, ''), 'null')"


def py_list(arr):
    return f"concat('[''', array_to_string({arr}, ''', '''), ''']')"


def first_match(x, patterns):
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({x}, {q(p)}, 0), '')" for p in patterns) + ")"


def drop_nbsp(x):
    return f"replace(replace({x}, chr(160), ''), chr(8194), '')"


def info_fields(x):
    isbn_line = f"regexp_extract({x}, {q(ISBN_LINE)}, 0)"
    genre_block = f"regexp_extract({x}, {q(GENRES_BETWEEN)}, 1)"
    genre_clean = rx(drop_nbsp(genre_block), GENRES_NOISE, "")
    trans = f"trim(regexp_extract({x}, {q(TRANSLATOR_LABEL)}, 1))"
    size_hit = f"coalesce({first_match(x, SIZE_PATTERNS)}, '')"
    return {
        "isbn": f"(CASE WHEN {isbn_line} <> '' THEN {py_list(f'regexp_extract_all({isbn_line}, {q(ISBN_NUMBER)}, 0)')} ELSE 'null' END)",
        "editionyear": or_sentinel(f"regexp_extract({x}, {q(YEAR_LABEL)}, 1)"),
        "pages": or_sentinel(f"regexp_extract(coalesce({first_match(x, PAGES_PATTERNS)}, ''), '\\d+', 0)"),
        "size": or_sentinel(f"trim({rx(size_hit, SIZE_LABELS, '')})"),
        "covertype": or_sentinel(f"regexp_extract(regexp_extract({x}, {q(COVER_LINE)}, 0), {q(COVER_WORD)}, 0)"),
        "language": or_sentinel(f"trim(regexp_extract({x}, {q(LANGUAGE_LABEL)}, 1))"),
        "copiesissued": or_sentinel(f"trim(regexp_extract({x}, {q(COPIES_LABEL)}, 1))"),
        "agerestrictions": or_sentinel(f"regexp_extract({x}, {q(AGE_LABEL)}, 1)"),
        "genres": py_list(f"(CASE WHEN regexp_matches({x}, {q(GENRES_BETWEEN)}) THEN string_split({genre_clean}, ',') ELSE ['null'] END)"),
        "translatorname": f"(CASE WHEN {trans} <> '' THEN {py_list(f'string_split({trans}, chr(44))')} ELSE 'null' END)",
    }


def nth(x, i, default="'null'"):
    line = f"string_split({drop_nbsp(x)}, chr(10))[{i + 1}]"
    return line if default is None else f"coalesce({line}, {default})"


# --- the query set -----------------------------------------------------------------------
def build() -> dict[str, str]:
    o: dict[str, str] = {}
    bb = with_bronze("books")
    o["sentinel_to_null"] = f"{bb} SELECT id, " + ", ".join(
        f"{s_null(c)} AS {c}" for c in ("pages", "language", "copiesissued", "publisherid")) + " FROM bb"
    o["sentinel_to_default"] = (f"{bb} SELECT id, {s_def('isbn', DEFAULT_ISBN)} AS isbn, "
                                f"{s_def('series', DEFAULT_SERIES)} AS series, "
                                f"{s_def('agerestrictions', DEFAULT_AGE)} AS agerestrictions, "
                                f"{s_def('translatorname', DEFAULT_TRANSLATOR)} AS translatorname FROM bb")
    o["empty_to_default"] = (f"{with_bronze('authors')} SELECT authorid, "
                             f"{e_def('originalname', DEFAULT_ORIGINALNAME)} AS originalname FROM ba")
    o["null_to_default"] = (f"{with_bronze('publishers')} SELECT publisherid, "
                            f"coalesce({rx('favorite', PARENS_REGEX, '')}, '0') AS favorite, "
                            f"coalesce(years, 'unknown') AS years FROM bp")
    o["drop_all_null"] = (f"{bb}, k AS (SELECT id, {s_null('publisherid')} AS publisherid FROM bb) "
                          f"SELECT id, publisherid FROM k WHERE publisherid IS NOT NULL")
    o["lenient_cast_projection"] = (f"{bb} SELECT {first_int('id')} AS id, {first_int('authorid')} AS authorid, "
                                    f"{first_int('publisherid')} AS publisherid, {int_len('editionyear')} AS editionyear, "
                                    f"{int_len('pages')} AS pages, {int_len('copiesissued')} AS copiesissued, "
                                    f"{dbl('planned')} AS planned FROM bb")
    o["cover_code_map"] = f"{bb} SELECT id, covertype, {cover('covertype')} AS cover_code FROM bb"
    items = f"string_split({rx('genres', r"[\[\]' ]", '')}, ',')"
    o["list_string_clean"] = (f"{bb} SELECT id, {strip_list('isbn')} AS isbn, {genres('genres')} AS genres, "
                              f"array_to_string({items}, '|') AS genre_items, len({items}) AS n_items FROM bb")
    o["size_normalize"] = f"{bb} SELECT id, {size('size')} AS size, {size('size', True)} AS size_corrected FROM bb"
    o["translator_clean"] = (f"{bb} SELECT id, {translator('translatorname')} AS translatorname, "
                             f"{translator('translatorname', True)} AS translatorname_corrected FROM bb")
    o["decimal_comma_rating"] = f"{bb} SELECT id, {rating('rating')} AS rating FROM bb"
    o["language_from_script"] = f"{bb} SELECT id, booktitle, {language('language', 'booktitle')} AS language FROM bb"

    y = int_len("editionyear")
    o["impute_year_by_group"] = (
        f"{bb}, {books_once_ctes()}, w AS (SELECT *, avg({y}) OVER (PARTITION BY publisherid) AS y_pub, "
        f"avg({y}) OVER (PARTITION BY authorid) AS y_auth FROM once) "
        f"SELECT id, publisherid, authorid, {trunc_int(f'(CASE WHEN editionyear = {q(SENTINEL)} OR editionyear IS NULL THEN coalesce(y_pub, y_auth) ELSE CAST({y} AS DOUBLE) END)')} AS editionyear FROM w")
    p_raw = s_null("pages")
    o["impute_pages_by_group_median"] = (
        f"{bb}, medv AS ({MEDIAN}), {books_once_ctes()}, w AS (SELECT *, avg({int_len(p_raw)}) OVER (PARTITION BY authorid) AS p_auth FROM once) "
        f"SELECT id, authorid, {trunc_int(f'(CASE WHEN {p_raw} IS NULL OR {int_len(p_raw)} > {PAGES_OUTLIER} THEN coalesce(p_auth, CAST({trunc_int('(SELECT med FROM medv)')} AS DOUBLE)) ELSE {dbl(p_raw)} END)')} AS pages FROM w")
    o["impute_global_mean"] = (
        f"{with_bronze('publishers')}, p_once AS ({dedupe('bp', 'publisherid', PUB_COLS)}) "
        f"SELECT publisherid, (CASE WHEN years IS NULL THEN (SELECT {trunc_int(f"avg({dbl('years')})")} FROM p_once) "
        f"ELSE {int_len('years')} END) AS years FROM p_once")
    o["median_scalar"] = f"{bb} SELECT quantile_disc({dbl('pages')}, 0.5) AS median_pages, count(*) AS n_rows FROM bb"

    li_cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    li = ("li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
          "l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem)")
    o["dedupe_by_key"] = f"WITH {li} {dedupe('li', ['l_orderkey', 'l_linenumber'], li_cols)}"
    o["distinct_rows"] = "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem"
    stored = ("s0 AS (SELECT l_orderkey AS orderkey, l_linestatus AS status, l_extendedprice AS amount FROM lineitem), "
              f"stored AS ({dedupe('s0', 'orderkey', ['orderkey', 'status', 'amount'])}), "
              "staged0 AS (SELECT o_orderkey AS orderkey, o_orderstatus AS status, o_totalprice AS amount FROM orders WHERE o_orderkey IS NOT NULL), "
              f"staged AS ({dedupe('staged0', 'orderkey', ['orderkey', 'status', 'amount'])}), "
              "added AS (SELECT * FROM staged WHERE orderkey NOT IN (SELECT orderkey FROM stored))")
    o["insert_ignore_merge"] = f"WITH {stored} SELECT * FROM stored UNION ALL SELECT * FROM added"
    o["new_keys_anti_join"] = f"WITH {stored} SELECT * FROM added"
    o["referenced_entities_semi_join"] = ("SELECT c_custkey, c_name, c_nationkey FROM customer "
                                          "WHERE c_custkey IN (SELECT o_custkey FROM orders)")
    o["entity_urls"] = (f"{bb}, refs AS (SELECT DISTINCT * FROM (SELECT 'author' AS entity, authorid AS ref FROM bb WHERE authorid <> 'null' "
                        f"UNION ALL SELECT 'publisher' AS entity, publisherid AS ref FROM bb WHERE publisherid <> 'null')) "
                        f"SELECT entity, ref, concat('/', entity, '/', ref) AS url FROM refs")

    sb = f"WITH bb AS ({BRONZE_SQL['books']}), {silver_books_ctes()}"
    o["silver_books"] = f"{sb} SELECT * FROM silver_books"
    o["silver_books_maintained"] = o["silver_books"]
    o["gold_books_projection"] = f"{sb} {gold_books_select()}"
    o["overwrite_keep_schema"] = o["gold_books_projection"]
    o["genre_inverted_index"] = (f"{sb}, {GENRE_PAIRS} SELECT genre, CAST(floor(book_id / 1024) AS BIGINT) AS block, "
                                 f"array_to_string(list_sort(list(DISTINCT book_id)), ',') AS book_ids, "
                                 f"count(DISTINCT book_id) AS n_books FROM pairs WHERE book_id IS NOT NULL "
                                 f"GROUP BY genre, floor(book_id / 1024)")
    o["genre_dictionary"] = f"{sb}, {GENRE_PAIRS}, {GENRES} SELECT genre, id FROM dict"
    o["genre_dictionary_incremental"] = (
        f"{sb}, {GENRE_PAIRS}, "
        f"shipped AS (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-03'), "
        f"old AS (SELECT genre, row_number() OVER (ORDER BY encode(genre)) - 1 AS id FROM "
        f"(SELECT DISTINCT genre FROM pairs WHERE book_id IN (SELECT l_partkey FROM shipped))) "
        f"SELECT genre, id FROM old UNION ALL "
        f"SELECT genre, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY encode(genre)) - 1 AS id FROM "
        f"(SELECT DISTINCT genre FROM pairs WHERE genre NOT IN (SELECT genre FROM old))")
    o["book_genre_bridge"] = (f"{sb}, {GENRE_PAIRS}, {GENRES} SELECT DISTINCT d.id AS genre_id, p.book_id "
                              f"FROM pairs p JOIN dict d ON p.genre = d.genre WHERE p.book_id IS NOT NULL")
    sa = f"WITH ba AS ({BRONZE_SQL['authors']}), {silver_authors_ctes()}"
    sp = f"WITH bp AS ({BRONZE_SQL['publishers']}), {silver_publishers_ctes()}"
    o["bronze_merged_and_compacted"] = f"{with_bronze('authors')} SELECT * FROM ba"
    o["silver_authors"] = f"{sa} SELECT * FROM silver_authors"
    o["silver_publishers"] = f"{sp} SELECT * FROM silver_publishers"
    o["gold_authors_merge"] = (
        f"{sa}, earlier AS (SELECT CAST(o_custkey AS INTEGER) AS authorid FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01'), "
        f"existing AS (SELECT authorid, upper(name) AS name, originalname, liked, neutral, disliked, favorite, reading "
        f"FROM silver_authors WHERE authorid IN (SELECT authorid FROM earlier)), "
        f"staged AS (SELECT * FROM silver_authors WHERE authorid IS NOT NULL), "
        f"added AS (SELECT * FROM ({dedupe('staged', 'authorid', AUTHOR_COLS)}) WHERE authorid NOT IN (SELECT authorid FROM existing)) "
        f"SELECT * FROM existing UNION ALL SELECT * FROM added")

    for name, kind in [("expect_not_null", V.NOT_NULL), ("expect_between", V.BETWEEN),
                       ("expect_in_set", V.IN_SET), ("expect_unique", V.UNIQUE),
                       ("expect_max_between", V.MAX_BETWEEN)]:
        exps = [e for e in V.SUITES["gold_books"] if e.kind == kind]
        o[name] = f"{sb} {suite_sql('silver_books', 'gold_books', exps)}"
    o["suite_report_books"] = f"{sb}, gold_books AS ({gold_books_select()}) {suite_sql('gold_books', 'gold_books')}"
    o["suite_report_books_observed"] = o["suite_report_books"]
    o["suite_report_authors"] = f"{sa} {suite_sql('silver_authors', 'gold_authors')}"
    o["suite_report_publishers"] = f"{sp} {suite_sql('silver_publishers', 'gold_publishers')}"
    all_three = (f"WITH bb AS ({BRONZE_SQL['books']}), ba AS ({BRONZE_SQL['authors']}), bp AS ({BRONZE_SQL['publishers']}), "
                 f"{silver_books_ctes()}, {silver_authors_ctes()}, {silver_publishers_ctes()}, "
                 f"gold_books AS ({gold_books_select()}), results AS ({suite_sql('gold_books', 'gold_books')} UNION ALL "
                 f"{suite_sql('silver_authors', 'gold_authors')} UNION ALL {suite_sql('silver_publishers', 'gold_publishers')})")
    o["checkpoint_report"] = f"{all_three} SELECT * FROM results"
    o["gate_decision"] = (f"{all_three} SELECT suite, bool_and(coalesce(success, FALSE)) AS passed, "
                          f"count(*) FILTER (WHERE NOT coalesce(success, FALSE)) AS failed_expectations "
                          f"FROM results GROUP BY suite")

    o["link_extract"] = f"WITH {LINKS} SELECT page_id, href, link FROM links"
    o["csv_roundtrip"] = BRONZE_SQL["books"]
    o["text_roundtrip"] = f"WITH {LINKS} SELECT DISTINCT link AS url FROM links WHERE link <> ''"
    o["link_frontier_distinct"] = f"WITH {LINKS} SELECT DISTINCT link FROM links"
    o["html_first_element_text"] = (f"SELECT page_id, {first_text('html', '(?s)<title>(.*?)</title>')} AS title, "
                                    f"{first_text('html', '(?s)<h1>(.*?)</h1>')} AS h1 FROM pages")
    o["html_attribute"] = (f"SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang, "
                           f"regexp_extract({seen('html')}, '<a href=\"([^\"]*)\"', 1) AS first_href FROM pages")
    o["id_from_url"] = "SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/[a-z]{2}/([^-/?#]*)', 1) AS url_id FROM pages"
    f = info_fields("info")
    o["labelled_field_cascade"] = (f"WITH b AS ({blocks.INFO_SQL}) SELECT book_key, "
                                   + ", ".join(f"{v} AS {k}" for k, v in f.items()) + " FROM b")
    found = f"regexp_extract_all(regexp_extract(info, {q(ISBN_LINE)}, 0), {q(ISBN_NUMBER)}, 0)"
    o["regex_all_matches"] = (f"WITH b AS ({blocks.INFO_SQL}) SELECT book_key, array_to_string({found}, ',') AS isbns, "
                              f"len({found}) AS n_isbn FROM b")
    stats = ", ".join(f"{nth('stat_block', i)} AS {c}" for c, i in STAT_LINES.items())
    o["nth_line"] = (f"WITH b AS ({blocks.STAT_SQL}) SELECT book_key, {nth('rating_block', 0)} AS rating, {stats}, "
                     f"coalesce({rx(nth('edition_block', 1, None), r'^\s+|\s+$', '')}, 'null') AS series FROM b")
    recs = book_records_sql()
    o["book_pages_to_bronze"] = f"WITH {recs} SELECT * FROM recs"
    o["book_pages_to_bronze_parsed"] = o["book_pages_to_bronze"]
    o["book_page_rejects"] = f"WITH {recs} SELECT * FROM broken"
    codes = {"id": "no_id_in_url", "booktitle": "no_title", "author": "no_author", "authorid": "no_author_link",
             "isbn": "no_info_block", "rating": "no_rating_block", "haveread": "no_counters_block", "series": "no_edition_block"}

    def reasons(rating_missing: str) -> str:
        missing = {c: rating_missing if c == "rating" else f"{c} IS NULL" for c in codes}
        return "concat_ws(',', " + ", ".join(f"CASE WHEN {missing[c]} THEN '{code}' END" for c, code in codes.items()) + ")"

    o["book_page_reject_reasons"] = f"WITH {recs}, r AS (SELECT * FROM broken) SELECT id, {reasons('rating IS NULL')} AS reasons FROM r"
    second = "CAST(id AS BIGINT) % 3 <> 0"
    o["book_rejects_replayed"] = (
        f"WITH {recs}, r AS (SELECT id, {second} AS again, "
        f"{reasons(f'(rating IS NULL AND (NOT ({second}) OR CAST(id AS BIGINT) % 58 = 0))')} AS reasons FROM broken) "
        "SELECT id, reasons, CAST(CASE WHEN again THEN 2 ELSE 1 END AS BIGINT) AS attempts, 'day1' AS first_run, "
        "CASE WHEN again THEN 'day2' ELSE 'day1' END AS last_run, reasons = '' AS resolved FROM r")
    o["listing_book_frontier"] = (
        f"WITH part_pages AS ({blocks.LISTING_PAGE_SQL.replace("array_join(array_sort(collect_list(item)), '')", "array_to_string(list_sort(list(item)), '')")}), "
        f"tags AS (SELECT url, unnest(regexp_extract_all(html, {q(ANCHOR)}, 0)) AS tag FROM part_pages), "
        f"hrefs AS (SELECT url, regexp_extract(tag, {q(HREF)}, 1) AS href FROM tags "
        f"WHERE regexp_matches(tag, {q('class="book-item__link"')})), "
        "lk AS (SELECT DISTINCT CASE WHEN regexp_matches(href, '^[a-z]+://') THEN href "
        "WHEN starts_with(href, '//') THEN concat(regexp_extract(url, '^[a-z]+:', 0), href) WHEN starts_with(href, '/') THEN concat(regexp_extract(url, '^[a-z]+://[^/]+', 0), href) ELSE href END AS link "
        "FROM hrefs WHERE href <> '') "
        "SELECT link AS url, regexp_extract(link, '/book/([^-/?#]*)', 1) AS book_id FROM lk")
    o["listing_unseen_books"] = (
        f"WITH listed AS ({o['listing_book_frontier']}) SELECT * FROM listed WHERE url NOT IN "
        "(SELECT concat('https://books.example.org/book/', p_partkey, '-', replace(p_name, ' ', '-')) FROM part "
        "WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-03'))")
    o["html_class_text"] = f"SELECT page_id, {first_text('html', '(?s)<div class="ad">(.*?)</div>')} AS ad_text FROM pages"
    o["silver_books_from_pages"] = (f"WITH {recs}, bb AS (SELECT * FROM recs), "
                                    f"{silver_books_ctes()} SELECT * FROM silver_books")
    return o


AUTHOR_ID = "regexp_extract(ah, '/author/([^-/?#]*)', 1)"
PUBLISHER_ID = "regexp_extract(ph, '/publisher/([^-/?#]*)', 1)"


def book_records_sql() -> str:
    """CTEs `found` (every rendered book page), `recs` (the accepted ones) and
    `broken`. Blocks are cut by the layout of the rendered pages, not by nesting."""
    f = info_fields("info")

    def href(cls, path):
        pattern = f'<a class="{cls}" href="?({path}[^">]*)'
        return f"regexp_extract({seen('html')}, {q(pattern)}, 1)"

    blocks_sel = (
        f"SELECT url, {first_text('html', '(?is)bc__book-title">(.*?)</h1>')} AS title, "
        f"{first_text('html', '(?s)<h2 class="bc-author">(.*?)</h2>')} AS author, "
        f"{first_text('html', '(?s)<div class="bc-info">(.*)</div><div class="bc-rating-medium">')} AS info, "
        f"{first_text('html', '(?s)<div class="bc-rating">(.*?)</div>')} AS rb, "
        f"{first_text('html', '(?s)<div class="bc-stat">(.*?)</div>', space_to='')} AS sb, "
        f"{first_text('html', '(?s)<table class="bc-edition">(.*?)</table>')} AS eb, "
        f"{href('bc-author__link', '')} AS ah, {href('bc-edition__link', '/publisher')} AS ph FROM pg")
    stats = ", ".join(f"CASE WHEN sb IS NOT NULL THEN {nth('sb', i)} END AS {c}" for c, i in STAT_LINES.items())
    fields = ", ".join(f"CASE WHEN info IS NOT NULL THEN {f[c]} END AS {c}" for c in (
        "isbn", "editionyear", "pages", "size", "covertype", "language", "copiesissued", "agerestrictions",
        "genres", "translatorname"))
    rec = (f"SELECT nullif(regexp_extract(url, '/book/([^-/?#]*)', 1), '') AS id, title AS booktitle, author, "
           f"CASE WHEN ah <> '' THEN {or_sentinel(AUTHOR_ID)} END AS authorid, {fields}, "
           f"CASE WHEN rb IS NOT NULL THEN {nth('rb', 0)} END AS rating, {stats}, "
           f"CASE WHEN eb IS NOT NULL THEN coalesce({rx(nth('eb', 1, None), r'^\s+|\s+$', '')}, 'null') END AS series, "
           f"{or_sentinel(PUBLISHER_ID)} AS publisherid FROM blk")
    whole = ("id IS NOT NULL AND booktitle IS NOT NULL AND author IS NOT NULL AND authorid IS NOT NULL "
             "AND isbn IS NOT NULL AND rating IS NOT NULL AND haveread IS NOT NULL AND series IS NOT NULL")
    return (f"pg AS ({blocks.BOOK_PAGE_SQL}), blk AS ({blocks_sel}), found AS ({rec}), "
            f"recs AS (SELECT * FROM found WHERE {whole}), broken AS (SELECT * FROM found WHERE NOT ({whole}))")


def node_text(inner):
    return rx(unescape(rx(inner, "<[^>]+>", "")), r"\n+", "")


def first_node_text(tag, attr, value):
    pat = q(f'(?s)<{tag} {attr}="{value}"[^>]*>(.*?)</{tag}>')
    return f"(CASE WHEN regexp_matches(html, {pat}) THEN {node_text(f'regexp_extract(html, {pat}, 1)')} ELSE 'null' END)"


def author_records_sql() -> str:
    counters = ", ".join(f"{first_node_text('span', 'title', t)} AS {c}"
                         for c, t in COUNTERS.items())
    return (f"apg AS ({blocks.AUTHOR_PAGE_SQL}), arecs AS (SELECT "
            f"nullif(regexp_extract(url, '/author/([^-/?#]*)', 1), '') AS authorid, "
            f"{first_node_text('span', 'class', 'header-profile-login')} AS name, "
            f"{first_node_text('span', 'class', 'header-profile-status')} AS originalname, {counters} FROM apg)")


def publisher_records_sql() -> str:
    items = (f"list_filter(regexp_extract_all(html, {q('(?s)<li class="standard">(.*?)</li>')}, 1), "
             f"lambda x: contains(x, {q(BOOKS_LABEL)}))[1]")
    paras = (f"list_filter(regexp_extract_all(html, {q('(?s)<p>(.*?)</p>')}, 1), "
             f"lambda x: contains(x, {q(FOUNDED_LABEL)}))[1]")
    year = f"regexp_extract({paras}, {q('(?s)' + FOUNDED_LABEL.strip() + '(.*)')}, 1)"
    return (f"ppg AS ({blocks.PUBLISHER_PAGE_SQL}), precs AS (SELECT "
            f"nullif(regexp_extract(url, '/publisher/([^-/?#]*)', 1), '') AS publisherid, "
            f"{first_node_text('title', 'id', 'title-head')} AS name, "
            f"{node_text(items)} AS books, {rx(rx(year, '<[^>]+>', ''), r'\s+', '')} AS years, "
            f"{first_node_text('a', 'class', 'publisher-link')} AS page, "
            f"{first_node_text('span', 'class', 'count-in-fav')} AS favorite FROM ppg)")


def add_corrected(o: dict[str, str]) -> None:
    sbc = f"WITH bb AS ({BRONZE_SQL['books']}), {silver_books_ctes(corrected=True)}"
    o["silver_books_corrected"] = f"{sbc} SELECT * FROM silver_books"
    pairs = ("pairs AS (SELECT book_id, trim(genre) AS genre FROM (SELECT id AS book_id, "
             "unnest(string_split(lower(genres), ', ')) AS genre FROM silver_books WHERE genres IS NOT NULL))")
    o["genre_dictionary_corrected"] = f"{sbc}, {pairs}, {GENRES} SELECT genre, id FROM dict"


def add_entity_pages(o: dict[str, str]) -> None:
    o["author_pages_to_bronze"] = f"WITH {author_records_sql()} SELECT * FROM arecs"
    o["publisher_pages_to_bronze"] = f"WITH {publisher_records_sql()} SELECT * FROM precs WHERE books IS NOT NULL"
    o["publisher_page_rejects"] = f"WITH {publisher_records_sql()} SELECT * FROM precs WHERE books IS NULL"
    o["referenced_author_records"] = (
        f"WITH {book_records_sql()}, {author_records_sql()} SELECT * FROM arecs "
        "WHERE authorid IN (SELECT authorid FROM recs WHERE authorid <> 'null')")
    o["referenced_publisher_records"] = (
        f"WITH {book_records_sql()}, {publisher_records_sql()} SELECT * FROM precs "
        "WHERE books IS NOT NULL AND publisherid IN (SELECT publisherid FROM recs WHERE publisherid <> 'null')")
    o["silver_authors_from_pages"] = (f"WITH {author_records_sql()}, ba AS (SELECT * FROM arecs), "
                                      f"{silver_authors_ctes()} SELECT * FROM silver_authors")
    o["silver_publishers_from_pages"] = (f"WITH {publisher_records_sql()}, bp AS (SELECT * FROM precs WHERE books IS NOT NULL), "
                                         f"{silver_publishers_ctes()} SELECT * FROM silver_publishers")
    from_pages = o["silver_publishers_from_pages"].replace("SELECT * FROM silver_publishers", suite_sql("silver_publishers", "gold_publishers"))
    o["suite_runs_compared"] = (
        f"WITH a AS ({o['suite_report_publishers']}), b AS ({from_pages}) "
        "SELECT coalesce(a.suite, b.suite) AS suite, coalesce(a.expectation, b.expectation) AS expectation, "
        "coalesce(a.column_name, b.column_name) AS column_name, a.success AS success_before, a.unexpected_count AS unexpected_before, "
        "b.success AS success_now, b.unexpected_count AS unexpected_now, "
        "CASE WHEN a.suite IS NULL THEN 'added' WHEN b.suite IS NULL THEN 'removed' WHEN a.success AND NOT b.success THEN 'broken' "
        "WHEN NOT a.success AND b.success THEN 'fixed' ELSE 'same' END AS change "
        "FROM a FULL JOIN b ON a.suite = b.suite AND a.expectation = b.expectation AND a.column_name = b.column_name")


ORACLE_SQL = build()
add_entity_pages(ORACLE_SQL)
add_corrected(ORACLE_SQL)
