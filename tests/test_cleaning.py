"""Column rules on the hand-made edge rows of FIXTURES.md section 2."""

from pyspark.sql import functions as F

from quire.functions import cleaning as C


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_three_missing_encodings(spark):
    vals = ["null", None, "", "x"]
    assert one_col(spark, vals, C.sentinel_to_null) == [None, None, "", "x"]
    assert one_col(spark, vals, lambda c: C.sentinel_to_default(c, "d")) == ["d", None, "", "x"]
    assert one_col(spark, vals, lambda c: C.empty_to_default(c, "u")) == ["null", None, "u", "x"]
    assert one_col(spark, vals, lambda c: C.null_to_default(c, "0")) == ["null", "0", "", "x"]


def test_lenient_int_reads_like_non_ansi_cast(spark):
    vals = ["2005.5", "-2.7", " 12 ", "abc", "", "null", "NaN", "99999999999", None]
    assert one_col(spark, vals, C.int_lenient) == [2005, -2, 12, None, None, None, None, None, None]


def test_first_int_strips_bom_and_slug(spark):
    vals = ["\ufeff12", "12-slug", "abc", "x7y8", None]
    assert one_col(spark, vals, C.first_int) == [12, 12, None, 7, None]


def test_list_syntax(spark):
    vals = ["['978-5-17-1', '5-17-123456-X']"]
    assert one_col(spark, vals, C.strip_list_syntax) == ["978-5-17-1, 5-17-123456-X"]
    got = one_col(spark, ["['a', ' b']"], lambda c: F.array_join(C.list_items(c), "|"))
    assert got == ["a|b"]


def test_size_rules_reference_and_corrected(spark):
    vals = ["84x108/32 (130x200 мм)", "130.5х200", "60 x 90; mm", "a (b) c (d) e", "130-200", "null", "130X200"]
    ref = one_col(spark, vals, C.size_normalize)
    assert ref == ["130x200", "1305х200", "60x90", "d", "130200", "130x200", "130X200"]
    fixed = one_col(spark, vals, lambda c: C.size_normalize(c, corrected=True))
    assert fixed[1] == "1305x200" and fixed[6] == "130x200"


def test_cover_codes(spark):
    vals = ["Мягкая", "мягкий", "Твёрдая", "твердый", "твёрдый", "твердая", "null", "другое", None]
    assert one_col(spark, vals, C.cover_code) == ["S", "S", "H", "H", "H", "H", "S", "другое", None]


def test_language_from_title_script(spark):
    df = spark.createDataFrame([(None, "Война и мир"), ("null", "War"), ("null", "Мир"), ("English", "Мир")],
                               "language string, title string")
    got = [r[0] for r in df.select(C.language_fill("language", "title")).collect()]
    assert got == ["Русский", None, "Русский", "English"]


def test_genres_and_translator(spark):
    assert one_col(spark, ["['null']", "['A', 'b']", "[' a', ' b']"], C.genres_clean) == \
        ["Проза", "A, b", " a,  b"]
    tr = ["['Иванов и Петров, стр.12']", "null"]
    assert one_col(spark, tr, C.translator_clean) == ["Иванов,sПетров, ", "unknown"]
    assert one_col(spark, tr, lambda c: C.translator_clean(c, corrected=True))[0] == "Иванов, Петров, "


def test_rating_decimal_comma(spark):
    assert one_col(spark, ["4,5", "null", "5", "x"], C.rating_clean) == [4.5, 0.0, 5.0, None]


def test_publisher_rules(spark):
    assert one_col(spark, ["Издательство «АСТ»"], C.publisher_name_clean) == [" АСТ"]
    assert one_col(spark, ["Книги (345)"], lambda c: C.int_lenient(C.book_count_clean(c))) == [345]
    fav = one_col(spark, [None, "null", "(12)"],
                  lambda c: C.int_lenient(C.null_to_default(C.strip_parens(c), "0")))
    assert fav == [0, None, 12]


def test_text_helpers(spark):
    assert one_col(spark, ["a\n\n\nb   c  "], C.squeeze_whitespace) == ["a\nb c"]
    assert one_col(spark, ["5\u00a0000\u2002"], C.drop_nbsp) == ["5000"]
    assert one_col(spark, ["a\nb\nc"], lambda c: C.nth_line(c, 1)) == ["b"]
    assert one_col(spark, ["a"], lambda c: C.nth_line(c, 4)) == ["null"]
    assert one_col(spark, ["x 12 стр"], lambda c: C.first_match(c, [r"Страниц.+\d+", r"\d+.стр"])) == ["12 стр"]
    assert one_col(spark, ["https://h.org/author/123-name"],
                   lambda c: C.id_from_url(c, "/author/")) == ["123"]
