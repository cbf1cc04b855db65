"""SparkSession construction and shared cluster settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (coalesces the many small
# aggregate shuffles, switches joins to broadcast only when the runtime size of
# a side is under the threshold, splits skewed join partitions), UTC dates so
# day boundaries match the oracle, and no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shiplens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the shared settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # runtime SQL settings also apply when the session already existed
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


TASK_BYTES = "16m"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def small_join_tasks(spark: SparkSession) -> None:
    """Let adaptive execution merge shuffle partitions up to ``TASK_BYTES`` only.

    With its default of 64 MB (compressed) a task of the fact joins sorts several hundred MB, which
    grows with the tables until that size is reached and spills where executors are
    small.  A size that the session was given is kept.
    """
    if not spark.sparkContext.getConf().contains(_ADVISORY) and spark.conf.get(_ADVISORY) in ("67108864b", "64MB", "64m"):
        spark.conf.set(_ADVISORY, TASK_BYTES)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    The cluster names it in ``spark.checkpoint.dir``; it is read from the
    session.  Only when it is unset on a ``local`` master (tests, one machine) a
    fresh scratch folder is created and registered; on any other master a
    missing setting is an error, because executors share no local disk.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and "
                               f"all executors share (master {sc.master})")
        d = tempfile.mkdtemp(prefix="shiplens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialize_small(df):
    """Cut the lineage of a small derived table (cut positions, encoding maps, thresholds).

    Reliable checkpoint into the shared checkpoint folder (never a local
    checkpoint): survives executor loss and keeps downstream plans flat.
    Only used for tables whose size is bounded by the number of groups.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used at the entry of multi-pass operators (positional split, rolling medians,
    feature table) so that every pass scans one columnar copy instead of re-running
    the upstream joins; lineage is cut at the written table.  A DataFrame that is
    already such a copy is returned as is.
    """
    if getattr(df, "_shiplens_materialized", False):
        return df
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._shiplens_materialized = True
    out._shiplens_path = path
    return out


def release(df) -> None:
    """Delete the copy that ``materialize`` wrote for ``df``, once nothing reads it any more."""
    path = getattr(df, "_shiplens_path", None)
    if path is None:
        return
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    df._shiplens_path = None
