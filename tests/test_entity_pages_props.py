"""Author / publisher page records and property tests of the merge operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.operators.dedupe import dedupe_by_key, insert_ignore
from quire.plans import pages as P
from quire.plans import silver

AUTHOR_PAGE = """<html><body><span class="header-profile-login">Лев
Толстой</span><span class="header-profile-status">Leo &amp; Tolstoy</span>
<span title="Писатель понравился">1 200</span><span title="Отнеслись нейтрально">30</span>
<span title="Почитатели творчества"><b>5</b></span></body></html>"""

PUBLISHER_PAGE = """<html><head><title id="title-head">Издательство «АСТ»</title></head><body>
<ul><li class="standard"><a href="/a">Авторы (3)</a></li><li class="standard"><a href="/b">Книги (345)</a></li></ul>
<p>intro</p><p><b>Год основания: </b>
1990 </p><a class="publisher-link" href="https://ast.ru">ast.ru</a>
<span class="count-in-fav">(12)</span></body></html>"""


def test_author_record(spark):
    pages = spark.createDataFrame([(1, "https://s/author/63979-lev", AUTHOR_PAGE)], "page_id long, url string, html string")
    r = P.author_records(pages).collect()[0].asDict()
    assert r == {"authorid": "63979", "name": "ЛевТолстой", "originalname": "Leo & Tolstoy", "liked": "1 200",
                 "neutral": "30", "disliked": "null", "favorite": "5", "reading": "null"}
    s = silver.authors(P.author_records(pages)).collect()[0]
    assert s.authorid == 63979 and s.liked is None and s.disliked == 0 and s.favorite == 5


def test_publisher_record_and_reject(spark):
    no_books = PUBLISHER_PAGE.replace("Книги (345)", "Серии (2)")
    pages = spark.createDataFrame([(1, "https://s/publisher/311-ast", PUBLISHER_PAGE),
                                   (2, "https://s/publisher/312-x", no_books)], "page_id long, url string, html string")
    rows = {r.publisherid: r.asDict() for r in P.publisher_records(pages).collect()}
    assert rows["311"] == {"publisherid": "311", "name": "Издательство «АСТ»", "books": "Книги (345)",
                           "years": "1990", "page": "ast.ru", "favorite": "(12)"}
    assert rows["312"]["books"] is None
    s = silver.publishers(P.publisher_records(pages).where("books IS NOT NULL")).collect()
    assert [(x.publisherid, x.name, x.books, x.years, x.favorite) for x in s] == [(311, " АСТ", 345, 1990, 12)]


keys = st.sampled_from(["a", "b", "c", "d", None])
vals = st.one_of(st.none(), st.text(alphabet="xyz", max_size=2))
rows_st = st.lists(st.tuples(keys, vals, st.integers(-3, 3)), max_size=25)


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stored=rows_st, staged=rows_st)
def test_insert_ignore_properties(spark, stored, staged):
    schema = "k string, v string, n int"
    st_df = dedupe_by_key(spark.createDataFrame([r for r in stored if r[0] is not None], schema), "k")
    sg_df = spark.createDataFrame(staged, schema)
    merged = insert_ignore(st_df, sg_df, "k")
    got = [tuple(r) for r in merged.collect()]
    ks = [r[0] for r in got]
    assert len(ks) == len(set(ks))                               # key unique
    old = {tuple(r) for r in st_df.collect()}
    assert old <= set(got)                                       # stored rows kept as they were
    assert set(ks) == {r[0] for r in old} | {r[0] for r in staged if r[0] is not None}
    again = insert_ignore(merged, sg_df, "k")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(got, key=str)   # idempotent
    # the survivor of a new key is the smallest staged row (NULLs first)
    for k in set(ks) - {r[0] for r in old}:
        cands = [r for r in staged if r[0] == k]
        best = min(cands, key=lambda r: ((r[1] is not None, r[1] or ""), r[2]))
        assert (k, best[1], best[2]) in got
