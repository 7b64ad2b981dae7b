"""Stable dense surrogate ids.

The reference numbers genres with `monotonically_increasing_id`, which
depends on the partition layout of each evaluation, so two writes of the same
plan may disagree. Here the id is the rank of the row in a total order of
unique key columns, computed without a single-partition window:

1. range-sort by the keys and checkpoint to the session's reliable checkpoint
   folder - this fixes the layout, so a lost executor recomputes nothing that
   could move a row to another partition;
2. count rows per partition (one small row per partition);
3. id = rows in earlier partitions + position inside the partition.

Step 3 is a projection plus a broadcast of the per-partition offsets, whose
size is bounded by the number of partitions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import ensure_checkpoint_dir


class Numbered(NamedTuple):
    frame: DataFrame
    rows: int
    payload_bytes: int  # UTF-8 bytes of string values + 8 per other value, ids included


def dense_ids(df: DataFrame, order: list[str], id_col: str = "id") -> Numbered:
    """Attach 0-based ids in ascending order of `order` (which must be unique
    per row). Returns the frame with its exact row count and payload size,
    measured in the same small job, so a caller can decide on a broadcast."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ordered = df.orderBy(*order).checkpoint(eager=True)
    pid = F.spark_partition_id()
    widths = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, T.StringType)
              else F.lit(8) for f in df.schema.fields] + [F.lit(8)]
    counts = ordered.groupBy(pid.alias("pid")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(sum(widths[1:], widths[0])).alias("bytes")).collect()
    offsets, total, payload = [], 0, 0
    for row in sorted(counts, key=lambda r: r["pid"]):  # one row per partition
        offsets.append((row["pid"], total))
        total += row["count"]
        payload += row["bytes"] or 0
    off = spark.createDataFrame(offsets, "pid INT, base BIGINT")
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    numbered = ordered.select("*", pid.alias("pid"), local.alias("__pos"))
    out = numbered.join(F.broadcast(off), "pid").select(
        *[F.col(c) for c in df.columns], (F.col("base") + F.col("__pos")).alias(id_col))
    return Numbered(out, total, payload)
