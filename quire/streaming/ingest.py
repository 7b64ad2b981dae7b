"""Incremental bronze ingest with Structured Streaming.

The reference lands a CSV per day, truncates a staging table, bulk-loads it
and merges it into the accumulated table with insert-ignore. Here the landing
folder is a file stream; each micro-batch is merged into bronze `<entity>_raw`
with the same insert-ignore operator. `trigger(availableNow=True)` processes
whatever landed since the last run and stops, which is the daily batch; the
stream checkpoint remembers which files were merged. A batch replayed after a
failure appends nothing new, because its keys are already stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.operators.dedupe import merge_into_bucketed_table, new_rows
from quire.sources import io
from quire.sources.schemas import BRONZE, KEYS


def staged_stream(spark: SparkSession, landing_dir: str, entity: str) -> DataFrame:
    """Headerless all-string CSV files arriving in `landing_dir` (A3 as a stream)."""
    return spark.readStream.schema(BRONZE[entity]).options(**io.STAGED_CSV_READ).csv(landing_dir)


def merge_batch(spark: SparkSession, raw_path: str, entity: str, table: str | None = None):
    """foreachBatch function: insert-ignore one micro-batch into the Parquet
    folder `raw_path`, or into the bucketed catalog table `table` when given
    (then the stored rows are not shuffled for the anti join)."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        if table is not None:
            merge_into_bucketed_table(batch, table, KEYS[entity])
            return
        stored = io.read_or_empty(spark, raw_path, BRONZE[entity])
        io.append(new_rows(stored, batch, KEYS[entity]), raw_path)
    return merge


def start_bronze_ingest(spark: SparkSession, landing_dir: str, raw_path: str | None, entity: str,
                        checkpoint_location: str, available_now: bool = True,
                        table: str | None = None) -> StreamingQuery:
    writer = (staged_stream(spark, landing_dir, entity).writeStream
              .foreachBatch(merge_batch(spark, raw_path, entity, table))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
