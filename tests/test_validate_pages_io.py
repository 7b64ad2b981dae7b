"""Expectation suites and gate; page extraction; file round trips; daily job."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, book, bronze_frame
from quire.functions import markup as M
from quire.operators import dedupe
from quire.operators import validate as V
from quire.plans import pages as P
from quire.plans import daily, silver
from quire.sources import io
from quire.sources.bronze_views import bronze


def test_suite_has_41_expectations():
    assert [len(V.SUITES[s]) for s in ("gold_books", "gold_authors", "gold_publishers")] == [21, 12, 8]


def test_expectations_pass_and_fail(spark):
    df = spark.createDataFrame([(1, 5, "H", 4.0), (2, None, "S", 5.0), (2, 30, "X", 6.0)],
                               "id int, age int, cover string, rating double")
    exps = [V.not_null("age"), V.between("age", 0, 21), V.in_set("cover", ["H", "S"]),
            V.unique("id"), V.max_between("rating", max_value=5.0), V.not_null("id")]
    r = {row.expectation + ":" + row.column_name: row for row in V.validate(df, "t", exps).collect()}
    nn = r[V.NOT_NULL + ":age"]
    assert not nn.success and nn.unexpected_count == 1 and abs(nn.unexpected_percent - 100 / 3) < 1e-9
    bt = r[V.BETWEEN + ":age"]
    assert not bt.success and bt.unexpected_count == 1 and bt.unexpected_percent == 50.0
    assert r[V.IN_SET + ":cover"].unexpected_count == 1
    assert r[V.UNIQUE + ":id"].unexpected_count == 2
    mx = r[V.MAX_BETWEEN + ":rating"]
    assert not mx.success and mx.observed_value == 6.0
    assert r[V.NOT_NULL + ":id"].success
    assert (bt.example_unexpected, r[V.IN_SET + ":cover"].example_unexpected,
            r[V.UNIQUE + ":id"].example_unexpected, nn.example_unexpected) == ("30", "X", "2", None)


def test_mostly_threshold(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (4,)], "a int")
    r = V.validate(df, "t", [V.not_null("a", mostly=0.75), V.not_null("a", mostly=0.8)]).collect()
    assert [x.success for x in r] == [True, False]


def test_gate_blocks_publish(spark):
    written = []
    bad = spark.createDataFrame([(None, 1, 1, 1990), (2, 0, 1, 1990)], "publisherid int, favorite int, books int, years int")
    with pytest.raises(V.ValidationFailed):
        V.publish_if_valid(bad, "gold_publishers", written.append)
    assert written == []
    good = spark.createDataFrame([(1, 1, 1, 1990), (2, 0, 1, 1990)], "publisherid int, favorite int, books int, years int")
    V.publish_if_valid(good, "gold_publishers", written.append)
    assert len(written) == 1


BOOK_PAGE = """<html><head><title>T &amp; U</title></head><body>
<h1 class="bc__book-title">  Война   и мир </h1>
<h2 class="bc-author"><a class="bc-author__link" href="/author/63979-lev-tolstoj">Лев Толстой</a></h2>
<div class="bc-info">ISBN: 978-5-17-090335-2, 5-17-123456-X<br>
Год издания: 2015<br>
Количество страниц: 1300<br>
Тираж: 5\u00a0000 экз.<br>
Формат: 84x108/32 (130x200 мм) Возрастные ограничения: 16<br>
Тип обложки: Твердый переплет<br>
Язык: <br>
 Русский<br>
Жанры: Проза №3в\u00a0, Классика<br>
Теги: x<br>
Переводчик: Иванов, Петров</div>
<div class="bc-rating">4,5
оценок</div><div class="bc-stat">10
Прочитали
20
Планируют
3
Отзывы
Цитаты
7</div>
<table class="bc-edition"><tr><td>Издание</td></tr>
<tr><td> Эксклюзивная классика </td></tr>
<tr><td><a class="bc-edition__link" href="/publisher/311-ast">АСТ</a></td></tr></table>
<a class="book-item__link" href="/book/1">x</a><a href="https://other.org/p">y</a>
</body></html>"""


def test_book_page_record(spark):
    pages = spark.createDataFrame([(1, "https://site.org/book/85378-voyna-i-mir", BOOK_PAGE)],
                                  "page_id long, url string, html string")
    r = P.book_records(pages).collect()[0].asDict()
    assert r["id"] == "85378" and r["authorid"] == "63979" and r["publisherid"] == "311"
    assert r["booktitle"] == "Война и мир" and r["author"] == "Лев Толстой"
    assert r["isbn"] == "['978-5-17-090335-2', '5-17-123456-X']"
    assert r["editionyear"] == "2015" and r["pages"] == "1300"
    assert r["copiesissued"] == "5\u00a0000"
    assert r["size"] == "84x108/32 (130x200 мм)"
    assert r["covertype"] == "Твердый" and r["language"] == "Русский" and r["agerestrictions"] == "16"
    assert r["genres"] == "[' Проза ', ' Классика']"
    assert r["translatorname"] == "['Иванов', ' Петров']"
    assert r["rating"] == "4,5"
    assert (r["haveread"], r["planned"], r["reviews"], r["quotes"]) == ("10", "20", "3", "7")
    assert r["series"] == "Эксклюзивная классика"
    silver_row = silver.books(P.book_records(pages)).collect()[0]
    assert silver_row.id == 85378 and silver_row.rating == 4.5 and silver_row.covertype == "H"


def test_pages_without_a_block_are_rejects(spark):
    whole = "https://site.org/book/85378-x"
    cut = [BOOK_PAGE.replace(x, "other") for x in ("bc__book-title", "bc-author__link", "bc-info", "bc-rating", "bc-stat", "bc-edition\"")]
    pages = spark.createDataFrame([(0, whole, BOOK_PAGE), *[(i + 1, whole, h) for i, h in enumerate(cut)], (9, whole, None)],
                                  "page_id long, url string, html string")
    ok, bad = P.split_rejects(P.book_records(pages), P.BOOK_REQUIRED)
    assert ok.count() == 1 == P.accepted_books(pages).count() and bad.count() == 7


def test_links_by_class_and_absolute(spark):
    pages = spark.createDataFrame([(1, "https://site.org/x/y", BOOK_PAGE)], "page_id long, url string, html string")
    all_links = {r.link for r in P.links(pages).collect()}
    assert "https://site.org/author/63979-lev-tolstoj" in all_links and "https://other.org/p" in all_links
    only = [r.link for r in P.links(pages, anchor_class="book-item__link").collect()]
    assert only == ["https://site.org/book/1"]
    title = pages.select(P.element_text("html", "title")).collect()[0][0]
    assert title == "T & U"


def test_csv_round_trip_keeps_null_empty_quote_newline(spark, scratch):
    rows = [{"authorid": "\ufeff1", "name": 'a "q" b', "originalname": "", "liked": None,
             "neutral": "line1\nline2", "disliked": "4", "favorite": "5", "reading": ""}]
    df = bronze_frame(spark, "authors", rows)
    io.write_staged_csv(df, f"{scratch}/a")
    back = io.read_staged_csv(spark, f"{scratch}/a", "authors").collect()[0].asDict()
    assert back["name"] == 'a "q" b' and back["neutral"] == "line1\nline2"
    assert back["originalname"] == "" and back["liked"] is None and back["reading"] == ""


def test_text_round_trip(spark, scratch):
    df = spark.createDataFrame([("https://a/1",), ("https://a/2",)], "url string")
    io.write_links(df, f"{scratch}/l")
    assert sorted(r.url for r in io.read_links(spark, f"{scratch}/l").collect()) == ["https://a/1", "https://a/2"]


def test_jdbc_options_partitioned():
    o = io.jdbc_options("jdbc:exampledb://db/x", "bronze.books_raw", partition_column="id",
                        lower_bound=0, upper_bound=1000, num_partitions=8)
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id" and o["dbtable"] == "bronze.books_raw"
    with pytest.raises(ValueError):
        io.jdbc_options("u", "t", partition_column="id")


def test_daily_job_merges_idempotently_and_gates(spark, scratch):
    staged = {e: bronze(spark, SF_SMALL, e) for e in daily.ENTITIES}
    layout = daily.Layout(scratch)
    for e in daily.ENTITIES:
        daily.merge_bronze(spark, layout, e, staged[e])
    n = spark.read.parquet(layout.bronze("books")).count()
    added = daily.merge_bronze(spark, layout, "books", staged["books"])
    assert added.count() == 0 and spark.read.parquet(layout.bronze("books")).count() == n
    daily.build_silver(spark, layout)
    # driver-shaped books have Latin titles with language 'null' -> not-null check fails
    with pytest.raises(V.ValidationFailed):
        daily.publish_gold(spark, layout)


def test_daily_job_publishes_clean_batch(spark, scratch):
    b = bronze_frame(spark, "books", [book(id=str(i), covertype="Мягкая", rating="4,5", agerestrictions="12",
                                           haveread="1", planned="2", reviews="3", quotes="4",
                                           genres="['Роман', 'Проза']") for i in range(1, 6)])
    a = bronze_frame(spark, "authors", [{"authorid": "7", "name": "n", "originalname": "o", "liked": "1",
                                         "neutral": "1", "disliked": "1", "favorite": "1", "reading": "1"}])
    p = bronze_frame(spark, "publishers", [{"publisherid": "5-pub", "name": "x", "books": "Книги (3)",
                                            "years": "1999", "page": "p", "favorite": "(2)"}])
    results = daily.run(spark, {"books": b, "authors": a, "publishers": p}, scratch)
    assert results.where("NOT success").count() == 0
    layout = daily.Layout(scratch)
    assert spark.read.parquet(layout.gold("books")).count() == 5
    assert spark.read.parquet(layout.gold("genres")).count() == 2
    assert spark.read.parquet(layout.gold("book_genre")).count() == 10
    daily.run(spark, {"books": b, "authors": a, "publishers": p}, scratch)
    assert spark.read.parquet(layout.gold("authors")).count() == 1


def test_daily_job_is_all_or_nothing(spark, scratch):
    b = bronze_frame(spark, "books", [book(id="1", covertype="Мягкая", rating="4,5", agerestrictions="12",
                                           haveread="1", planned="2", reviews="3", quotes="4")])
    a = bronze_frame(spark, "authors", [{"authorid": "7", "name": "n", "originalname": "o", "liked": "-5",
                                         "neutral": "1", "disliked": "1", "favorite": "1", "reading": "1"}])
    p = bronze_frame(spark, "publishers", [{"publisherid": "5-pub", "name": "x", "books": "Книги (3)",
                                            "years": "1999", "page": "p", "favorite": "(2)"}])
    with pytest.raises(V.ValidationFailed, match="gold_authors"):
        daily.run(spark, {"books": b, "authors": a, "publishers": p}, scratch)
    layout = daily.Layout(scratch)
    import os
    assert not os.path.exists(layout.gold("books"))  # books passed but were not published alone
    assert spark.read.parquet(layout.results()).where("NOT success").count() == 1


def test_parser_path_handles_nested_blocks(spark):
    from quire.functions.html_parse import element_text_parsed, first_element_text
    nested = BOOK_PAGE.replace('<div class="bc-info">', '<div class="bc-info"><div class="row">ISBN block</div>\n')
    pages = spark.createDataFrame([(1, "https://site.org/book/85378-x", nested)], "page_id long, url string, html string")
    native_info = pages.select(P.element_text("html", "div", "bc-info")).collect()[0][0]
    parsed_info = pages.select(element_text_parsed(F.col("html"), "div", "bc-info")).collect()[0][0]
    assert native_info == parsed_info
    assert parsed_info.startswith("ISBN block\nISBN: 978") and parsed_info.endswith("Иванов, Петров")
    r = P.book_records(pages, parser="html").collect()[0].asDict()
    assert r["editionyear"] == "2015" and r["translatorname"] == "['Иванов', ' Петров']"
    assert first_element_text("<p>a<br>b &amp; c</p>", "p") == "ab & c"
    assert first_element_text("<div>x</div>", "span") is None


def test_overwrite_keeps_target_schema(spark):
    spark.sql("CREATE TABLE gold_books_t (id INT, rating DOUBLE, series STRING) USING parquet")
    try:
        df = spark.createDataFrame([("x", "7", 4)], "series string, id string, rating int")
        io.overwrite_keep_schema(spark, df, "gold_books_t")
        io.overwrite_keep_schema(spark, df, "gold_books_t")
        rows = spark.table("gold_books_t").collect()
        assert [tuple(r) for r in rows] == [(7, 4.0, "x")]
        assert [f.dataType.simpleString() for f in spark.table("gold_books_t").schema] == ["int", "double", "string"]
    finally:
        spark.sql("DROP TABLE gold_books_t")


def test_read_table_by_path_and_name(spark):
    part = io.read_table(spark, f"{SF_SMALL}/part.parquet")
    part.createOrReplaceTempView("part_t")
    assert io.read_table(spark, "part_t", fmt="table").count() == part.count() > 0
    assert io.read_table(spark, f"{SF_SMALL}/part.parquet", options={"mergeSchema": "false"}).columns == part.columns


def test_staged_csv_with_file_bom(spark, scratch):
    path = f"{scratch}/bom.csv"
    with open(path, "w", encoding="utf-8-sig") as fh:  # the landing files start with a BOM
        fh.write('12-slug,"Name, with comma","",,"line1\nline2",4,5,6\n')
    r = io.read_staged_csv(spark, path, "authors").collect()[0].asDict()
    assert r["authorid"] == "12-slug" and r["name"] == "Name, with comma"
    assert r["originalname"] == "" and r["liked"] is None and r["neutral"] == "line1\nline2"


def test_split_rejects_and_listing_frontier(spark):
    recs = spark.createDataFrame([("1", "Книги (3)"), ("2", None)], "publisherid string, books string")
    ok, bad = P.split_rejects(recs, ["books"])
    assert [r.publisherid for r in ok.collect()] == ["1"] and [r.publisherid for r in bad.collect()] == ["2"]
    listing = spark.createDataFrame([(0, "https://s.org/books/new", BOOK_PAGE + '<a class="x book-item__link" href="/book/7-a">a</a>')],
                                    "page_id long, url string, html string")
    got = sorted((r.url, r.book_id) for r in P.book_frontier(listing).collect())
    assert got == [("https://s.org/book/1", "1"), ("https://s.org/book/7-a", "7")]


def test_selectors_accept_single_quotes_and_any_attribute_order(spark):
    html = ("<html lang='ru'><h1 class='bc__book-title x'>T</h1>"
            "<a href='/author/5-x' class='bc-author__link'>A</a>"
            "<a href='/series/3' class='bc-edition__link'>s</a><a class=\"bc-edition__link\" href='/publisher/9-p'>p</a></html>")
    pages = spark.createDataFrame([(1, "https://s.org/book/1-t", html)], "page_id long, url string, html string")
    r = P.book_records(pages).collect()[0]
    assert (r.booktitle, r.authorid, r.publisherid) == ("T", "5", "9")
    assert pages.select(P.attribute("html", "html", "lang")).collect()[0][0] == "ru"
    assert [x.link for x in P.links(pages, anchor_class="bc-author__link").collect()] == ["https://s.org/author/5-x"]


def test_page_count_forms_size_fallback_and_missing_labels(spark):
    infos = ["Количество страниц: 320", "Страниц: 288", "Объем: 96 стр.", "Кол-во страниц: 64",
             "Размер: 60x90 мм\nТираж: 3000", "ничего"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(infos)], "i int, info string")
    got = [(r.pages, r.size, r.copies) for r in df.select(
        "i", P.page_count("info").alias("pages"), P.size("info").alias("size"), P.copies("info").alias("copies"))
        .orderBy("i").collect()]
    assert [g[0] for g in got] == ["320", "288", "96", "64", "null", "null"]
    assert got[4][1:] == ("60x90 мм", "3000") and got[5][1:] == ("null", "null")


def test_staged_csv_empty_last_field_is_null(spark, scratch):
    path = f"{scratch}/last.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('7,"n","o",1,2,3,4,\n8,"m","",1,2,3,4,""\n')
    rows = {r.authorid: r.reading for r in io.read_staged_csv(spark, path, "authors").collect()}
    assert rows == {"7": None, "8": ""}


def test_write_and_validate_matches_validate(spark, scratch):
    sb = silver.books(bronze(spark, SF_SMALL, "books"))
    observed = V.write_and_validate(sb, "gold_books", lambda df: df.write.mode("overwrite").parquet(f"{scratch}/sb"))
    plain = V.validate(sb, "gold_books")
    key = lambda r: (r.expectation, r.column_name)
    assert sorted(map(tuple, observed.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert spark.read.parquet(f"{scratch}/sb").count() == sb.count()
    assert key(observed.collect()[0]) == ("expect_column_values_to_not_be_null", "id")


def test_tag_names_must_end(spark):
    html = "<pre>code</pre><picture>x</picture><p class='a'>para</p><link rel='x'><li>item</li>"
    df = spark.createDataFrame([(html,)], "html string")
    r = df.select(P.element_text("html", "p").alias("p"), P.element_text("html", "li").alias("li"),
                  F.array_join(P.element_texts("html", "p"), "|").alias("ps")).collect()[0]
    assert (r.p, r.li, r.ps) == ("para", "item", "para")


def test_attribute_names_must_start_after_whitespace(spark):
    html = ('<html data-lang="xx" lang="ru"><a data-href="/wrong" href="/right" data-class="bc-author__link">a</a>'
            '<a class="bc-author__link" href="/author/7-x">b</a><div subclass="bc-info">no</div><div class="bc-info">yes</div></html>')
    pages = spark.createDataFrame([(1, "https://s.org/book/1", html)], "page_id long, url string, html string")
    assert pages.select(P.attribute("html", "html", "lang")).collect()[0][0] == "ru"
    assert [r.href for r in P.links(pages).collect()] == ["/right", "/author/7-x"]
    assert pages.select(P.element_text("html", "div", "bc-info")).collect()[0][0] == "yes"
    assert P.book_records(pages).collect()[0].authorid == "7"


def test_protocol_relative_links(spark):
    html = '<a href="//cdn.example.org/x">c</a><a href="/y">y</a><a href="z">z</a>'
    pages = spark.createDataFrame([(1, "http://s.org/p/q", html)], "page_id long, url string, html string")
    assert [r.link for r in P.links(pages).collect()] == ["http://cdn.example.org/x", "http://s.org/y", "z"]


def test_character_references_decode_once(spark):
    df = spark.createDataFrame([("Пр&#1080;вет &#x41D;&#X41d; &#128512; a&#b &amp;#39; &amp;amp; &#39;",)], "t string")
    assert df.select(M.unescape("t")).collect()[0][0] == "Привет НН 😀 a&#b &#39; &amp; '"


def test_nbsp_entity_is_a_no_break_space(spark):
    df = spark.createDataFrame([("<div class='bc-rating'>4,5&nbsp;\nоценок</div>",)], "html string")
    text = df.select(P.element_text("html", "div", "bc-rating").alias("t")).collect()[0].t
    assert text == "4,5\u00a0\nоценок"
    assert df.select(P.rating(P.element_text("html", "div", "bc-rating"))).collect()[0][0] == "4,5"


def test_daily_job_corrected_mode(spark, scratch):
    b = bronze_frame(spark, "books", [book(id=str(i), covertype="Мягкая", rating="4,5", agerestrictions="12",
                                           haveread="1", planned="2", reviews="3", quotes="4", size="130Х200",
                                           translatorname="['Иванов и Петров']", genres="['Роман', ' Проза']")
                                      for i in range(1, 4)])
    a = bronze_frame(spark, "authors", [{"authorid": "7", "name": "n", "originalname": "o", "liked": "1",
                                         "neutral": "1", "disliked": "1", "favorite": "1", "reading": "1"}])
    p = bronze_frame(spark, "publishers", [{"publisherid": "5-pub", "name": "x", "books": "Книги (3)",
                                            "years": "1999", "page": "p", "favorite": "(2)"}])
    daily.run(spark, {"books": b, "authors": a, "publishers": p}, scratch, corrected=True)
    layout = daily.Layout(scratch)
    s = spark.read.parquet(layout.silver("books")).collect()[0]
    assert (s.size, s.translatorname) == ("130x200", "Иванов, Петров")
    assert sorted(r.genre for r in spark.read.parquet(layout.gold("genres")).collect()) == ["проза", "роман"]


def test_read_or_empty_on_first_run(spark, scratch):
    from quire.sources.schemas import BRONZE
    df = io.read_or_empty(spark, f"{scratch}/nothing-here", BRONZE["publishers"])
    assert df.count() == 0 and df.columns == BRONZE["publishers"].names


def test_csv_round_trip_keeps_edge_blanks_and_crlf(spark, scratch):
    rows = [{"authorid": "1", "name": "  x  ", "originalname": "a\r\nb", "liked": " ", "neutral": "c\nd",
             "disliked": "", "favorite": None, "reading": "e\r"}]
    df = bronze_frame(spark, "authors", rows)
    io.write_staged_csv(df, f"{scratch}/authors")
    assert io.read_staged_csv(spark, f"{scratch}/authors", "authors").collect() == df.collect()


def test_bad_character_references_never_fail(spark):
    html = "<h1>&#9999999; &#xD800; &#0; &#151; &#x97; &#000000041; &#x0000000041; &#99999999999999999999; &#x; &#;</h1>"
    got = spark.createDataFrame([(html,)], "html string").select(P.element_text("html", "h1")).first()[0]
    assert got == "\ufffd \ufffd \ufffd \u2014 \u2014 ) A \ufffd &#x; &#;"


def test_classes_match_as_whole_tokens(spark):
    html = '<div class="bc-rating-medium">WRONG</div><div class="a bc-rating b">4,5</div><div class="x">y</div>'
    one = spark.createDataFrame([(html,)], "html string")
    assert one.select(P.element_text("html", "div", "bc-rating")).first()[0] == "4,5"
    assert one.select(P.element_text("html", "div", "bc-info")).first()[0] is None


def test_elements_equal_the_html_parser(spark):
    from quire.functions.html_parse import first_element_text
    pages = ['<div class="bc-info">a<DIV>b<div>c</div></div>d</div>e', '<div class="x">n</div>', None, "",
             '<!-- <div class="bc-info">no</div> --><div class="bc-info" title="a>b">yes</div>',
             '<script>s="<div class=bc-info>js</div>"</script><DIV CLASS = bc-info>real</DIV>',
             "<div class='k bc-info j'>84&times;108&ensp;&eacute; &unknown; &amp;lt; a & b</div>",
             '<div class="bc-info">never <div>closed', '<div data-class="bc-info">no</div><div class=\'bc-info\'></div>']
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(P.element_text("html", "div", "bc-info")).collect()]
    assert got == [first_element_text(h, "div", "bc-info") if h is not None else None for h in pages]
    assert got[0] == "abcd" and got[1] is None and got[5] == "real" and got[6].startswith("84×108")


def test_paragraphs_and_items_end_where_they_do(spark):
    html = "<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul><p>x<b>y</b><p>z</p><p>w<div>v</div>"
    r = spark.createDataFrame([(html,)], "html string").select(
        P.element_texts("html", "p"), P.element_texts("html", "li")).first()
    assert r[0] == ["x<b>y</b>", "z", "w"] and r[1] == ["abcd", "b", "c", "e"]


def test_every_form_of_an_attribute(spark):
    html = ("<a href=\"/book/o'neil\">1</a><a href=/book/2>2</a><A HREF='/book/3'>3</A><a href = \"/book/5\">5</a>"
            "<a href='/q?a=1&amp;b=2'>6</a><!-- <a href='/no'>x</a> --><a data-href='/no'>7</a><a href>8</a>")
    pages = spark.createDataFrame([(1, "http://s.org/p", html)], "page_id long, url string, html string")
    assert [r.href for r in P.links(pages).collect()] == ["/book/o'neil", "/book/2", "/book/3", "/book/5", "/q?a=1&b=2"]


def test_long_tags_and_many_references(spark):
    html = "<p " + "a" * 50_000 + " class='k'>" + "&amp;" * 2_000 + "x" * 100_000 + "</p>"
    got = spark.createDataFrame([(html,)], "html string").select(P.element_text("html", "p", "k")).first()[0]
    assert got == "&" * 2_000 + "x" * 100_000


def test_jdbc_string_key_buckets_and_write_options():
    parts = io.jdbc_buckets("id", 3)
    assert len(parts) == 3 and parts[0].endswith("= 0 OR id IS NULL") and parts[2] == "mod(abs(hashtext(id)), 3) = 2"
    assert io.jdbc_buckets("k", 1, bucket_sql="crc32({key}) % {n}") == ["crc32(k) % 1 = 0 OR k IS NULL"]
    o = io.jdbc_write_options("jdbc:exampledb://db/x", "gold.books", user="u", truncate=True, num_partitions=4)
    assert o["truncate"] == "true" and o["numPartitions"] == "4" and o["user"] == "u" and "password" not in o
    assert io.jdbc_write_options("u", "t")["truncate"] == "false"


def test_batch_merge_shuffles_no_stored_key(spark, scratch):
    stored = spark.range(20_000).selectExpr("cast(id as string) AS authorid")
    stored.write.parquet(f"{scratch}/stored")
    stored = spark.read.parquet(f"{scratch}/stored")
    staged = spark.createDataFrame([("5", "a"), ("x", "b"), ("x", "c"), (None, "d")], "authorid string, name string")
    got = dedupe.new_rows_of_batch(stored, staged, "authorid")
    assert [tuple(r) for r in got.collect()] == [("x", "b")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("LeftSemi")


def test_unique_input_gives_the_same_silver(spark):
    rows = [{"id": str(i), "publisherid": str(i % 3), "authorid": str(i % 4), "editionyear": str(1990 + i), "pages": str(100 + i)}
            for i in range(20)]
    df = bronze_frame(spark, "books", rows)
    assert sorted(silver.books(df, unique=True).collect(), key=str) == sorted(silver.books(df).collect(), key=str)


def test_suite_in_one_grouped_pass_equals_the_plain_one(spark):
    exps = [V.not_null("k"), V.not_null("s", mostly=0.5), V.between("n", 0, 10), V.in_set("s", ["a", "b"]), V.unique("k"),
            V.max_between("n", max_value=100.0), V.unique("k")]
    rows = [(k, s, n) for k, s, n in zip([1, 1, 2, None, None, 3, 10, 10, 10, 4], "abcab" * 2, [5, -3, 11, None, 4, 100, 9, 12, 0, None])]
    rows += [(77, "z", 1)] * 300  # one key with most of the rows
    base = spark.createDataFrame(rows, "k long, s string, n int").repartition(5)
    for df in (base, base.where("k < 0"), base.where("k IS NULL"), base.where("s = 'a'")):
        assert not V._only_read(df)
        plain = V._assemble(df.agg(*V._metrics(df, exps)), "t", exps)
        assert [tuple(r) for r in V.validate(df, "t", exps).collect()] == [tuple(r) for r in plain.collect()]


def test_suite_uses_the_rows_where_the_job_left_them(spark, scratch):
    base = spark.createDataFrame([(i % 50, i) for i in range(500)], "k long, n int")
    df = base.repartition(4, "k").groupBy("k").agg(F.max("n").alias("n"))
    exps = [V.not_null("n"), V.unique("k"), V.between("n", 0)]
    result = V.validate(df, "t", exps)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("hashpartitioning(k") == 1  # the job's own shuffle; the second aggregate needs none
    df.write.parquet(f"{scratch}/t")
    read = spark.read.parquet(f"{scratch}/t")
    assert V._only_read(read.where("n > 3").select("k", "n").union(read)) and not V._only_read(df)
    assert [tuple(r) for r in V.validate(read, "t", exps).collect()] == [tuple(r) for r in result.collect()]


def test_the_html_parser_walks_a_page_once(spark, monkeypatch):
    """All blocks of a page come from one function call and one walk (F2), and are those of a walk for each."""
    from quire.functions import html_parse as H

    pages = spark.createDataFrame([(1, "https://x/book/1-a", "<h1 class='bc__book-title'>t</h1>")], "page_id int, url string, html string")
    plan = P.book_records(pages, parser="html")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("ArrowEvalPython" in line for line in plan.splitlines()) == 1 and len(set(re.findall(r"parse\(html#\d+\)#\d+", plan))) == 1
    walks = []
    feed = H._FirstElements.feed
    monkeypatch.setattr(H._FirstElements, "feed", lambda self, data: (walks.append(1), feed(self, data))[1])
    chosen = [("div", "a", None, " "), ("div", None, ("title", "b"), ""), ("br", None, None, " "), ("i", None, None, " "), ("div", None, None, " ")]
    for page in ('<div class="a">x<div title=b>y  z</div>\n\n<br>w</div><div title="b">v</div>', "<div title=b>open  <i>", "", None):
        del walks[:]
        got = H.first_element_texts(page, chosen)
        assert len(walks) == (page is not None)
        assert got == [H.first_element_text(page, *s) for s in chosen]
    assert H.first_element_texts('<div class="a">x<div title=b>y  z</div></div>', chosen) == ["xy z", "yz", None, None, "xy z"]
