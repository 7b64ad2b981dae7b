"""De-duplication and insert-ignore merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (E1); partial aggregation removes copies map-side."""
    return df.distinct()


def dedupe_by_key(df: DataFrame, key, order: list[str] | None = None) -> DataFrame:
    """One row per key (E2). The survivor is the smallest row in the order of
    `order` (default: the other columns in schema order), ascending with NULLs
    first, so the result does not depend on partitioning or task timing.

    Expressed as `min(struct(...))` per key: an aggregate with a partial
    (map-side) step, so a key holding a large share of the rows is reduced
    in every task before the shuffle, never gathered into one sort. The
    ordering columns must be orderable types (no maps).
    """
    keys = _keys(key)
    others = order or [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in others]
    packed = F.struct(*[F.col(c) for c in others + rest]).alias("__row")
    agg = df.groupBy(*keys).agg(F.min(packed).alias("__row"))
    return agg.select(*[F.col(k) for k in keys], *[F.col("__row")[c].alias(c) for c in others + rest]) \
        .select(*df.columns)


def new_rows(stored: DataFrame, staged: DataFrame, key) -> DataFrame:
    """Staged rows whose key is not stored yet (D1): staged is first reduced to
    one deterministic row per key, NULL keys are left out (a key column is
    NOT NULL), then anti-joined on the key."""
    keys = _keys(key)
    staged = staged.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    once = dedupe_by_key(staged, keys)
    return once.join(stored.select(*keys), keys, "left_anti")


def new_rows_of_batch(stored: DataFrame, staged: DataFrame, key) -> DataFrame:
    """`new_rows` for a batch that is small beside the stored table. The reduced
    batch is checkpointed and measured; within the broadcast bound its keys go to
    the stored rows' tasks, which pass on only the keys that the batch holds, so
    no other stored key is shuffled. A larger batch takes the plain anti join."""
    keys = _keys(key)
    staged = staged.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    once = dedupe_by_key(staged, keys).checkpoint(eager=True)
    size = F.sum(sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(0)))
    rows, payload = once.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    known = stored.select(*keys)
    if rows <= BROADCAST_MAX_ROWS and payload <= BROADCAST_MAX_BYTES:
        known = known.join(F.broadcast(once.select(*keys)), keys, "left_semi")
    return once.join(known, keys, "left_anti")


def insert_ignore(stored: DataFrame, staged: DataFrame, key) -> DataFrame:
    """Stored table after `INSERT ... ON CONFLICT (key) DO NOTHING` of staged
    (B6/B7, H3): the first stored version of a key wins forever."""
    added = new_rows(stored, staged.select(*stored.columns), key)
    return stored.unionByName(added)


def merge_into_bucketed_table(staged: DataFrame, table: str, key: str, buckets: int | None = None) -> DataFrame:
    """Insert-ignore `staged` into catalog table `table`, stored bucketed and
    sorted by `key` (B6 at scale).

    The staged side's de-dup shuffles it by `key` into
    `spark.sql.shuffle.partitions` partitions; with the same bucket count the
    stored side is read already partitioned, so the anti join moves no stored
    rows. Returns the appended rows (computed once, from a checkpoint)."""
    spark = staged.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = lambda df: (df.write.mode("append").format("parquet")
                         .bucketBy(n, key).sortBy(key).saveAsTable(table))
    if not spark.catalog.tableExists(table):
        writer(staged.limit(0))
    added = new_rows(spark.table(table), staged, key).checkpoint(eager=True)
    writer(added)
    return added
