"""Spark session settings shared by tests, bench and the daily job.

Nothing here is cluster specific: on a cluster the submitter's own
configuration wins, and `ensure_checkpoint_dir` only fills in a folder when
the cluster did not name one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI stays on (Spark 4 default); every
# lenient cast in the library is an explicit try_cast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a shuffle join into a broadcast when the MEASURED size of a
    # side (e.g. per-author means) is below this; it is a runtime size check.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of dictionaries / extracted records go away with their RDDs
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session_conf(master: str | None = None, shuffle_partitions: int | None = None,
                 extra: dict | None = None) -> dict[str, str]:
    """The settings `build_session` applies. `master=None` leaves the master
    (and the memory) chosen by spark-submit alone; `shuffle_partitions=None`
    keeps the submitted value."""
    conf = dict(DEFAULT_CONF)
    if master is not None:
        conf["spark.master"] = master
        if master.startswith("local"):
            conf["spark.driver.memory"] = "16g"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return conf


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quire", extra: dict | None = None) -> SparkSession:
    """Session with the library's settings (see `session_conf`)."""
    builder = SparkSession.builder.appName(app_name)
    for k, v in session_conf(master, shuffle_partitions, extra).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    On a cluster `spark.checkpoint.dir` must point at shared storage and is
    set by whoever submits the job; we only read it. When it is unset (unit
    tests, local runs) a fresh local folder is created for this process.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()
