"""Spark cleaning rules against brute-force Python versions on random text."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import cleaning as C

ALPHABET = "ab12 .,-~;()[]'Xх×*мmиn\n"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=1, max_size=30)
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_size(s, corrected=False):
    s = "130x200" if s == "null" else s
    s = re.sub(r"\.|\,|\-|\~|\;|мм|mm", "", s)
    s = s.replace(" ", "")
    s = re.sub(r"[XХх×*]" if corrected else r"XХх×\*", "x", s)
    s = re.sub(r".+\(", "", s)
    return re.sub(r"\).*", "", s)


def py_translator(s, corrected=False):
    s = "unknown" if s == "null" else s
    s = re.sub(r"\[|\]", "", s).replace("'", "")
    s = re.sub(r"[0-9]|\-|стр\.|роман", "", s)
    return re.sub(r"[ \t\n\x0b\f\r]и[ \t\n\x0b\f\r]", ", " if corrected else ",s", s)


def py_first_int(s):
    m = re.search(r"[0-9]+", s)
    if not m:
        return None
    v = int(m.group(0))
    return v if v < 2 ** 31 else None


def spark_col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", fn(F.col("x"))).orderBy("i").collect()]


@SETTINGS
@given(values=texts)
def test_size_rule_matches_python(spark, values):
    assert spark_col(spark, values, C.size_normalize) == [py_size(v) for v in values]
    assert spark_col(spark, values, lambda c: C.size_normalize(c, True)) == [py_size(v, True) for v in values]


@SETTINGS
@given(values=texts)
def test_translator_rule_matches_python(spark, values):
    assert spark_col(spark, values, C.translator_clean) == [py_translator(v) for v in values]


@SETTINGS
@given(values=st.lists(st.text(alphabet="0123456789ab-\ufeff ", max_size=12), min_size=1, max_size=30))
def test_first_int_matches_python(spark, values):
    assert spark_col(spark, values, C.first_int) == [py_first_int(v) for v in values]
