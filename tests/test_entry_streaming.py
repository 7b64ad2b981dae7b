"""Driver contract and the streaming ingest."""

import __spark_entry__ as E
from conftest import SF_SMALL, bronze_frame
from quire.sources import io
from quire.streaming.ingest import start_bronze_ingest


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["genre", "genre_id", "n_books"]
    assert df.count() > 0


def test_every_query_has_an_oracle_except_trained_and_tokenized_ones():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(k.startswith("op") or k == "pipeline" for k in set(q) - set(o))


def test_queries_run_on_smallest_tables(spark):
    for name in ["silver_books", "gate_decision", "book_genre_bridge", "link_extract", "csv_roundtrip"]:
        assert E.queries()[name](spark, SF_SMALL).count() >= 0


def test_streaming_merge_is_insert_ignore(spark, scratch):
    landing, raw, ck = f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/ck"
    row = {"publisherid": "1-pub", "name": "a", "books": "1", "years": "1990", "page": "p", "favorite": "1"}
    io.write_staged_csv(bronze_frame(spark, "publishers", [row]), f"{landing}/day1")
    start_bronze_ingest(spark, f"{landing}/*", raw, "publishers", ck).awaitTermination()
    changed = dict(row, name="b")
    io.write_staged_csv(bronze_frame(spark, "publishers", [changed, dict(row, publisherid="2-pub")]),
                        f"{landing}/day2")
    start_bronze_ingest(spark, f"{landing}/*", raw, "publishers", ck).awaitTermination()
    got = {r.publisherid: r.name for r in spark.read.parquet(raw).collect()}
    assert got == {"1-pub": "a", "2-pub": "a"}


def test_streaming_merge_into_bucketed_table(spark, scratch):
    landing, ck, table = f"{scratch}/landing", f"{scratch}/ck", "bronze_publishers_raw_s"
    row = {"publisherid": "1-pub", "name": "a", "books": "1", "years": "1990", "page": "p", "favorite": "1"}
    io.write_staged_csv(bronze_frame(spark, "publishers", [row, dict(row, publisherid="2-pub")]), f"{landing}/d1")
    start_bronze_ingest(spark, f"{landing}/*", None, "publishers", ck, table=table).awaitTermination()
    io.write_staged_csv(bronze_frame(spark, "publishers", [dict(row, name="b"), dict(row, publisherid="3-pub")]),
                        f"{landing}/d2")
    start_bronze_ingest(spark, f"{landing}/*", None, "publishers", ck, table=table).awaitTermination()
    got = {r.publisherid: r.name for r in spark.table(table).collect()}
    assert got == {"1-pub": "a", "2-pub": "a", "3-pub": "a"}
    spark.sql(f"DROP TABLE {table}")


def test_cli_stages_three_batches(spark):
    from quire.__main__ import staged_batches
    from quire.sources.schemas import BRONZE
    for from_pages in (False, True):
        batches = staged_batches(spark, SF_SMALL, from_pages)
        assert {e: b.columns for e, b in batches.items()} == {e: BRONZE[e].names for e in batches}
        assert all(b.count() > 0 for b in batches.values())
