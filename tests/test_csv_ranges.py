"""Parallel reader of quoted CSV against the built-in multiLine reader."""

import random

import pytest
from pyspark.sql import types as T

from quire.sources.csv_ranges import csv_records, end_state, read_csv_ranges
from quire.sources.io import STAGED_CSV_READ

COLUMNS = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(4)])
FIELDS = ["", '""', "abc", '"x,y"', '"a\nb"', '"q""q"', '"\n\n"', '"""\n"""', 'st"ray', '" , "', "é", ' "lead', '"1\n2,""\n3"', '"a"b', '"cr\r\nlf"']


def _text(rows, seed):
    rng = random.Random(seed)
    return "".join(",".join(rng.choice(FIELDS) for _ in COLUMNS) + rng.choice(["\n", "\n\n"]) for _ in range(rows))


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)
    yield cut
    for n, v in old.items():
        spark.conf.set(n, v)


def _same(spark, path):
    want = spark.read.schema(COLUMNS).options(**STAGED_CSV_READ).csv(path).collect()
    got = read_csv_ranges(spark, path, COLUMNS, STAGED_CSV_READ).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return len(got)


@pytest.mark.parametrize("size", [11, 13, 50, 4096])
def test_every_cut_gives_the_rows_of_the_multiline_reader(spark, small_splits, tmp_path, size):
    rows = 40 if size < 50 else 400
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + _text(rows, size).encode())
    (tmp_path / "b.csv").write_bytes(_text(rows, size + 1).encode().rstrip(b"\n"))
    (tmp_path / "c.csv").write_bytes(b"")
    small_splits(size)
    assert _same(spark, str(tmp_path)) == 2 * rows


def test_a_newline_in_quotes_at_every_place_of_a_cut(spark, small_splits, tmp_path):
    for i in range(16):  # the quoted newline moves across the cuts at multiples of 16
        (tmp_path / f"{i}.csv").write_text("x" * i + ',"left\nright, ""\n""",b,c\nlast,,,\n')
    small_splits(16)
    assert _same(spark, str(tmp_path)) == 32


def test_one_record_over_many_splits_and_files_without_quotes(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('1,"' + "line\n" * 500 + '",x,y\n2,,,\n')
    (tmp_path / "b.csv").write_text("1,2,3,4\n" * 300)
    small_splits(128)
    assert _same(spark, str(tmp_path)) == 302


def test_large_files_are_read_by_many_tasks(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text(_text(2000, 5))
    small_splits(2048)
    assert csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 10


def test_a_changed_cut_is_an_error(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text(_text(200, 6))
    small_splits(1024)
    records = csv_records(spark, str(tmp_path))
    small_splits(300)
    with pytest.raises(Exception, match="cut differently"):
        records.count()


def test_empty_file_and_broken_bytes(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    assert read_csv_ranges(spark, str(tmp_path / "empty.csv"), COLUMNS, STAGED_CSV_READ).count() == 0
    (tmp_path / "broken.csv").write_bytes(b'\xff,"\xc3\n",c,d\n')
    assert read_csv_ranges(spark, str(tmp_path / "broken.csv"), COLUMNS, STAGED_CSV_READ).first()[:4] == ("�", "�\n", "c", "d")


def test_state_after_a_line():
    for line, inside, after in [(b'a,"b', False, True), (b'b",c', True, False), (b'""', True, True), (b'a"b', False, False),
                                (b'"a""', False, True), (b'"a"x"y', False, False), (b"", True, True), (b'",x', True, False)]:
        assert end_state(line, inside) is after
