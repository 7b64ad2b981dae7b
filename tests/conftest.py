import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quire.session import build_session  # noqa: E402
from quire.sources.schemas import BRONZE  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("QUIRE_SCRATCH", tempfile.mkdtemp(prefix="quire-tests-"))
    warehouse = tempfile.mkdtemp(prefix="warehouse-", dir=os.environ["QUIRE_SCRATCH"])
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g", "spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quire-t-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))


def bronze_frame(spark, entity, rows):
    """All-string bronze frame from dicts (missing keys -> NULL)."""
    names = BRONZE[entity].names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], BRONZE[entity])


def book(**kw):
    base = {"id": "1", "booktitle": "Title", "author": "A", "authorid": "7", "isbn": "null",
            "editionyear": "2000", "pages": "100", "size": "null", "covertype": "null",
            "language": "English", "copiesissued": "null", "agerestrictions": "null",
            "genres": "['null']", "translatorname": "null", "rating": "null", "haveread": "null",
            "planned": "null", "reviews": "null", "quotes": "null", "series": "null",
            "publisherid": "5-pub"}
    base.update(kw)
    return base
