"""Extraction from landed web pages (K1-K20), as native column expressions.

The reference fetches each URL and walks it with a DOM parser in a
4-process pool. Here the input is a `pages(page_id, url, html)` DataFrame and
every rule is a built-in expression evaluated per row inside Spark tasks, so
the work spreads with the pages. Selectors cover what the reference uses:
first whole element by tag (and class or attribute), attribute of the first
matching tag, anchors by class (`quire.functions.markup`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import cleaning as C
from quire.functions import markup as M

# --- fixed values: labels of the book information block --------------------
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
# --- fixed values: page selectors and URL paths ----------------------------
BOOK_BLOCKS = {"booktitle": ("h1", "bc__book-title"), "author": ("h2", "bc-author"), "info": ("div", "bc-info"),
               "rating_block": ("div", "bc-rating"), "stat_block": ("div", "bc-stat"), "edition_block": ("table", "bc-edition")}
BLOCK_SPACES = {"stat_block": ""}  # what runs of blanks become, where not one blank
AUTHOR_LINK_CLASS = "bc-author__link"
EDITION_LINK_CLASS = "bc-edition__link"
LISTING_ITEM_CLASS = "book-item__link"
BOOK_URL_PREFIX = r"/book/"
AUTHOR_URL_PREFIX = r"/author/"
PUBLISHER_URL_PREFIX = r"/publisher/"
# ---------------------------------------------------------------------------


def node_text(inner) -> Column:
    """Text of an element the way the entity parsers read it: tags dropped,
    entities decoded, newlines deleted, nothing trimmed."""
    return F.regexp_replace(M.unescape(M.strip_tags(inner)), r"\n+", "")


def element_texts(html, tag: str, cls: str | None = None) -> Column:
    """Inner HTML of every matching <tag>, as an array."""
    return M.all_elements(M.visible(html), tag, cls)


def first_node_texts(page: Column, selectors: dict[str, tuple]) -> Column:
    """A struct with node_text of the first element of a `visible` page for each name -> (tag, class,
    attribute); 'null' when there is none (K18). One expression decodes all of them."""
    found = F.array(*[M.first_element(page, *s) for s in selectors.values()])
    texts = F.transform(found, lambda inner: F.coalesce(node_text(inner), F.lit(C.SENTINEL)))
    return M.let(texts, lambda t: F.struct(*[F.get(t, F.lit(i)).alias(name) for i, name in enumerate(selectors)]))


def element_text(html, tag: str, cls: str | None = None, space_to: str = " ") -> Column:
    """Text of the first matching element: tags dropped, entities decoded,
    newline and space runs squeezed, trimmed (K2, I18). NULL when absent."""
    return _block_text(M.visible(html), tag, cls, space_to)


def _block_text(page: Column, tag: str, cls: str | None = None, space_to: str = " ") -> Column:
    inner = M.first_element(page, tag, cls)
    return C.squeeze_whitespace(M.unescape(M.strip_tags(inner)), space_to)


def attribute(html, tag: str, attr: str) -> Column:
    """Value of `attr` on the first <tag> carrying it (K3); '' when absent."""
    values = F.transform(M.open_tags(M.visible(html), tag), lambda t: M.attribute_of(t, attr))
    return F.coalesce(F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0)), F.lit(""))


def site_root(url) -> Column:
    return F.regexp_extract(C.as_col(url), r"^[a-z]+://[^/]+", 0)


def links(pages: DataFrame, anchor_class: str | None = None) -> DataFrame:
    """(page_id, href, link): every anchor href of each page, made absolute
    against the page's site (K1). With `anchor_class`, only anchors whose
    class attribute lists it."""
    tags = pages.select("page_id", "url",
                        F.explode(M.open_tags(M.visible("html"), "a")).alias("tag"))
    if anchor_class is not None:
        tags = tags.where(M.has_class(F.col("tag"), anchor_class))
    href = C.strip_ws(M.attribute_of(F.col("tag"), "href"))
    out = tags.select("page_id", "url", href.alias("href")).where(F.col("href") != "")
    link = (F.when(F.col("href").rlike(r"^[a-z]+://"), F.col("href"))
            .when(F.col("href").startswith("//"),
                  F.concat(F.regexp_extract("url", r"^[a-z]+:", 0), F.col("href")))
            .when(F.col("href").startswith("/"), F.concat(site_root("url"), F.col("href")))
            .otherwise(F.col("href")))
    return out.select("page_id", "href", link.alias("link"))


def book_frontier(listing: DataFrame) -> DataFrame:
    """Crawl fan-out (K20, K1, H2, C16): book anchors of the listing pages ->
    distinct absolute book URLs with their ids."""
    found = links(listing, anchor_class=LISTING_ITEM_CLASS)
    urls = found.select("link").distinct()
    return urls.select(F.col("link").alias("url"), C.id_from_url("link", BOOK_URL_PREFIX).alias("book_id"))


def split_rejects(records: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects): records missing any required field go to the side
    frame instead of failing the batch (C15)."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    return records.where(complete), records.where(~complete)


def anchor_href(tags: Column, cls: str, must_contain: str | None = None) -> Column:
    """href of the first of the <a> `tags` of a page whose class list holds `cls`
    (and whose href contains `must_contain`), whatever the attribute order (K3);
    NULL when there is none."""
    hrefs = F.transform(F.filter(tags, lambda t: M.has_class(t, cls)), lambda t: M.attribute_of(t, "href"))
    keep = (lambda x: x.contains(must_contain)) if must_contain is not None else (lambda x: x.isNotNull())
    return F.get(F.filter(hrefs, keep), F.lit(0))


def frontier(link_rows: DataFrame) -> DataFrame:
    """Distinct links across all pages (H1, H2)."""
    return link_rows.select("link").distinct()


# --- labelled information block (K4-K16) -----------------------------------

def py_list_literal(items: Column) -> Column:
    """Render an array of strings the way a Python list prints: ['a', 'b']."""
    return F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))


def or_sentinel(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(C.SENTINEL))


def isbn_list(info) -> Column:
    line = F.regexp_extract(C.as_col(info), ISBN_LINE, 0)
    return F.when(line != "", py_list_literal(C.all_matches(line, ISBN_NUMBER))).otherwise(F.lit(C.SENTINEL))


def edition_year(info) -> Column:
    return or_sentinel(F.regexp_extract(C.as_col(info), YEAR_LABEL, 1))


def page_count(info) -> Column:
    hit = C.first_match(info, PAGES_PATTERNS)
    return or_sentinel(F.regexp_extract(F.coalesce(hit, F.lit("")), r"\d+", 0))


def copies(info) -> Column:
    return or_sentinel(F.trim(F.regexp_extract(C.as_col(info), COPIES_LABEL, 1)))


def size(info) -> Column:
    hit = F.coalesce(C.first_match(info, SIZE_PATTERNS), F.lit(""))
    return or_sentinel(F.trim(F.regexp_replace(hit, SIZE_LABELS, "")))


def cover(info) -> Column:
    line = F.regexp_extract(C.as_col(info), COVER_LINE, 0)
    return or_sentinel(F.regexp_extract(line, COVER_WORD, 0))


def language(info) -> Column:
    return or_sentinel(F.trim(F.regexp_extract(C.as_col(info), LANGUAGE_LABEL, 1)))


def age_limit(info) -> Column:
    return or_sentinel(F.regexp_extract(C.as_col(info), AGE_LABEL, 1))


def genres(info) -> Column:
    """Text between the genre and tag labels, cleaned, as a printed list;
    missing -> "['null']" (K12)."""
    block = F.regexp_extract(C.as_col(info), GENRES_BETWEEN, 1)
    has = F.regexp_like(C.as_col(info), F.lit(GENRES_BETWEEN))
    cleaned = F.regexp_replace(C.drop_nbsp(block), GENRES_NOISE, "")
    return py_list_literal(F.when(has, F.split(cleaned, ",")).otherwise(F.array(F.lit(C.SENTINEL))))


def translators(info) -> Column:
    names = F.trim(F.regexp_extract(C.as_col(info), TRANSLATOR_LABEL, 1))
    return F.when(names != "", py_list_literal(F.split(names, ","))).otherwise(F.lit(C.SENTINEL))


def rating(block) -> Column:
    return C.nth_line(C.drop_nbsp(block), 0)


def stat(block, name: str) -> Column:
    return C.nth_line(C.drop_nbsp(block), STAT_LINES[name])


def series(block) -> Column:
    """Line 1 of the edition block, stripped; 'null' only when it is missing."""
    return F.coalesce(C.strip_ws(C.nth_line(C.drop_nbsp(block), 1, default=None)), F.lit(C.SENTINEL))


def info_fields(info) -> dict[str, Column]:
    """All labelled fields of one information block."""
    return {
        "isbn": isbn_list(info), "editionyear": edition_year(info), "pages": page_count(info),
        "size": size(info), "covertype": cover(info), "language": language(info),
        "copiesissued": copies(info), "agerestrictions": age_limit(info),
        "genres": genres(info), "translatorname": translators(info),
    }


# --- fixed values: selectors of the author and publisher pages -------------
AUTHOR_NAME_CLASS = "header-profile-login"
AUTHOR_ORIGINAL_NAME_CLASS = "header-profile-status"
AUTHOR_COUNTER_TITLES = {"liked": "Писатель понравился", "neutral": "Отнеслись нейтрально",
                         "disliked": "Писатель не понравился", "favorite": "Почитатели творчества",
                         "reading": "Читателей"}
PUBLISHER_TITLE_ID = "title-head"
PUBLISHER_LIST_CLASS = "standard"
PUBLISHER_BOOKS_LABEL = "Книги ("
PUBLISHER_YEAR_LABEL = "Год основания: "
PUBLISHER_LINK_CLASS = "publisher-link"
PUBLISHER_FAVORITE_CLASS = "count-in-fav"
# ---------------------------------------------------------------------------

# --- whole records (K17-K19) -------------------------------------------------


# a page must have its six blocks and the author link
BOOK_REQUIRED = ["id", "booktitle", "author", "authorid", "isbn", "rating", "haveread", "series"]


def book_records(pages: DataFrame, parser: str = "native", keep: list[str] | None = None) -> DataFrame:
    """One all-string bronze books row per book page (K17). A field whose block
    (or author link) the page lacks is NULL; `split_rejects` with BOOK_REQUIRED
    parts such rows from the whole ones (C15). `keep` names columns of the pages
    to go along.

    Three projections: comments and scripts are dropped, the HTML is cut into
    its blocks, and every field is read from its (short) block, so no search of
    the page runs once per field. `parser="html"` cuts the blocks with the
    stdlib HTML parser instead (pandas UDF, one walk of the page), as a check of the native one."""
    kept = {c: f"__kept{i}" for i, c in enumerate(keep or [])}
    seen = pages.select("url", "html", M.visible("html").alias("page"), *[F.col(c).alias(k) for c, k in kept.items()])
    if parser == "html":
        from quire.functions.html_parse import element_texts_parsed
        texts = element_texts_parsed(F.col("html"), [(*s, None, BLOCK_SPACES.get(b, " ")) for b, s in BOOK_BLOCKS.items()])
        found = F.struct(texts.alias("texts"), M.open_tags(F.col("page"), "a").alias("anchors"))
    else:  # one cut of the page, and one expression decodes all blocks
        found = M.let(M.first_elements(F.col("page"), list(BOOK_BLOCKS.values()), "a"), lambda e: F.struct(
            F.transform(e["elements"], lambda inner: M.unescape(M.strip_tags(inner))).alias("texts"), e["opened"].alias("anchors")))

    def block(t: Column, i: int, name: str) -> Column:
        text = F.get(t, F.lit(i))
        return (text if parser == "html" else C.squeeze_whitespace(text, BLOCK_SPACES.get(name, " "))).alias(name)

    # one generated row per page: filters on its fields are not pushed into the
    # cut, which would run it once per filter
    cut = seen.select(*kept.values(), F.inline(F.transform(F.array(found), lambda f: F.struct(
        F.nullif(C.id_from_url("url", BOOK_URL_PREFIX), F.lit("")).alias("id"),
        anchor_href(f["anchors"], AUTHOR_LINK_CLASS).alias("a_href"),
        anchor_href(f["anchors"], EDITION_LINK_CLASS, must_contain="publisher").alias("p_href"),
        *[block(f["texts"], i, name) for i, name in enumerate(BOOK_BLOCKS)]))))

    def of(block: str, value: Column) -> Column:
        return F.when(F.col(block).isNotNull(), value)

    fields = info_fields("info")
    return cut.select(
        *[F.col(k).alias(c) for c, k in kept.items()], "id", "booktitle", "author",
        of("a_href", or_sentinel(C.id_from_url("a_href", AUTHOR_URL_PREFIX))).alias("authorid"),
        *[of("info", fields[c]).alias(c) for c in ("isbn", "editionyear", "pages", "size", "covertype",
                                                   "language", "copiesissued", "agerestrictions", "genres",
                                                   "translatorname")],
        of("rating_block", rating("rating_block")).alias("rating"),
        *[of("stat_block", stat("stat_block", c)).alias(c) for c in ("haveread", "planned", "reviews", "quotes")],
        of("edition_block", series("edition_block")).alias("series"),
        or_sentinel(C.id_from_url("p_href", PUBLISHER_URL_PREFIX)).alias("publisherid"),
    )


def accepted_books(pages: DataFrame) -> DataFrame:
    """Records of the book pages that have everything they need."""
    return split_rejects(book_records(pages), BOOK_REQUIRED)[0]


def author_records(pages: DataFrame) -> DataFrame:
    """One all-string bronze authors row per author page (K18): name,
    original name and five counters; a missing element reads 'null'."""
    selectors = {"name": ("span", AUTHOR_NAME_CLASS), "originalname": ("span", AUTHOR_ORIGINAL_NAME_CLASS),
                 **{c: ("span", None, ("title", t)) for c, t in AUTHOR_COUNTER_TITLES.items()}}
    return pages.select("url", M.visible("html").alias("page")).select(
        F.nullif(C.id_from_url("url", AUTHOR_URL_PREFIX), F.lit("")).alias("authorid"),
        first_node_texts(F.col("page"), selectors).alias("t")).select("authorid", *[F.col(f"t.{c}") for c in selectors])


def publisher_records(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One all-string bronze publishers row per publisher page (K19). `books`
    is the text of the first list item naming the book count; a page without
    one is a reject (NULL books, filter with `.where(books IS NOT NULL)`).
    `years` is the value after the founding-year label with tags and blanks
    removed, NULL when no paragraph carries the label. `keep` names columns of
    the pages to go along."""
    kept = {c: f"__kept{i}" for i, c in enumerate(keep or [])}
    h = F.col("page")
    items = F.filter(M.all_elements(h, "li", PUBLISHER_LIST_CLASS),
                     lambda x: x.contains(PUBLISHER_BOOKS_LABEL))
    paras = F.filter(M.all_elements(h, "p"), lambda x: x.contains(PUBLISHER_YEAR_LABEL))
    year_text = F.regexp_extract(F.get(paras, 0), r"(?s)" + PUBLISHER_YEAR_LABEL.strip() + r"(.*)", 1)
    selectors = {"name": ("title", None, ("id", PUBLISHER_TITLE_ID)), "page": ("a", PUBLISHER_LINK_CLASS),
                 "favorite": ("span", PUBLISHER_FAVORITE_CLASS)}
    seen = pages.select("url", M.visible("html").alias("page"), *[F.col(c).alias(k) for c, k in kept.items()])
    return seen.select(
        *kept.values(), F.nullif(C.id_from_url("url", PUBLISHER_URL_PREFIX), F.lit("")).alias("publisherid"),
        first_node_texts(h, selectors).alias("t"),
        node_text(F.get(items, 0)).alias("books"),
        F.regexp_replace(M.strip_tags(year_text), r"\s+", "").alias("years"),
    ).select(*[F.col(k).alias(c) for c, k in kept.items()], "publisherid", F.col("t.name"), "books", "years", F.col("t.page"), F.col("t.favorite"))
