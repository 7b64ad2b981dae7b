"""silver.books kept up to date by batches equals the full run over all of them."""

import random

from conftest import book, bronze_frame
from quire.plans import silver
from quire.plans.maintained import PAGE_COUNTS, MaintainedBooks, lower_median
from quire.sources.schemas import SILVER


def some_books(day, n=40):
    """Books of few publishers and authors with unknown years and pages, outliers, shared digits and a null author."""
    r = random.Random(day)
    return [book(id=f"{day}{i}" + ("x" if i % 9 == 0 else ""), publisherid=r.choice(["1-a", "2-b", "null", f"{day}-c"]),
                 authorid=r.choice(["1", "2", "null", None, str(100 + day)]),
                 editionyear=r.choice(["null", "1990", "2001", None, "x"]),
                 pages=r.choice(["null", "100", "250", "90000", None, str(300 + day)])) for i in range(n)] + [
        book(id=f"{day}0", publisherid="1-a", authorid="1", editionyear="null", pages="null")]  # digits of "<day>0x"


def test_batches_give_the_rows_of_the_full_run(spark, scratch):
    kept, all_rows, built = MaintainedBooks(spark, f"{scratch}/kept"), [], []
    assert kept.books().count() == 0
    for day in (1, 2, 3):
        rows = some_books(day) if day != 2 else some_books(day, 3)
        all_rows += rows
        built.append(kept.update(bronze_frame(spark, "books", rows)))
        if day > 1:
            full = silver.books(bronze_frame(spark, "books", all_rows), unique=True)
            got = kept.books()
            assert [f.dataType for f in got.schema] == [f.dataType for f in SILVER["books"].fields]
            assert sorted(map(str, got.collect())) == sorted(map(str, full.collect())) and full.count() > 20
    assert built[1] < built[0]  # a small batch builds its own books and those that wait for its keys


def test_lower_median(spark):
    for values in ([], [(3.0, 1)], [(1.0, 2), (5.0, 2)], [(1.0, 2), (5.0, 3)], [(float(i % 7), i) for i in range(1, 40)]):
        plain = sorted(v for v, n in values for _ in range(n))
        want = plain[(len(plain) + 1) // 2 - 1] if plain else None
        assert lower_median(spark.createDataFrame(values, PAGE_COUNTS)) == want
