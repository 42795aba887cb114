"""Spark session settings shared by tests, bench and the driver entry point.

Operators never create sessions; they take DataFrames. These helpers only
exist so that every caller gets the same engine settings (AQE, UTC, no UI)
and a reliable checkpoint directory taken from the cluster configuration.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Engine settings. AQE re-plans joins from runtime sizes (broadcast only
# when the measured side is under the threshold), coalesces small shuffle
# partitions and splits skewed ones. Timestamps are wall-clock values.
ENGINE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of intermediates are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Static and runtime broadcast limits: sides above these are shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "visitmart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings above.

    ``shuffle_partitions`` is only set when given; the cluster's setting holds
    otherwise. ``extra`` must name ``spark.checkpoint.dir`` where the cluster's
    defaults do not.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("VISITMART_DRIVER_MEMORY", "8g"))
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def local_session(folder: str, *args, **kw) -> SparkSession:
    """``build_session`` on one machine (tests, benchmarks): where the defaults
    name no checkpoint folder, ``folder`` is used."""
    try:
        return build_session(*args, **kw)
    except ValueError:
        SparkSession.getActiveSession().stop()
        return build_session(*args, **kw | {"extra": {"spark.checkpoint.dir": folder, **kw.get("extra", {})}})


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it.

    There is no fallback: a folder of one machine would be invisible to the
    other executors, so a session without the setting is an error.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if sc.getCheckpointDir() is None:      # each call would add a new sub-folder
        sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write a reused intermediate as a table in the shared checkpoint
    folder and read it back: the Spark form of ``SELECT ... INTO #temp``.

    Lineage is cut, so a lost executor costs a re-read of the table, not a
    recomputation of the upstream plan. (``Dataset.checkpoint`` would run the
    upstream plan twice, once to count and once to write.) Each call gets a
    fresh folder; nothing is overwritten while being read.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/visitmart/tmp/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _listed(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, list(fs.listStatus(root)) if fs.exists(root) else []


def file_status(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files in a folder; none if there is no such folder."""
    return [(f.getPath().getName(), f.getLen()) for f in _listed(spark, path)[1] if f.isFile()]


def _folders(spark: SparkSession, path: str):
    """(file system, [(name, modified ms, path)]) of the folders in a folder."""
    fs, found = _listed(spark, path)
    return fs, [(f.getPath().getName(), f.getModificationTime(), f.getPath()) for f in found if f.isDirectory()]


def remove_old(spark: SparkSession, path: str, older_than_hours: float, keep=()) -> list[str]:
    """Delete the folders in ``path`` untouched for that long, except ``keep``;
    returns their names. Choose a time longer than any job that may read them."""
    limit = (time.time() - older_than_hours * 3600) * 1000
    fs, found = _folders(spark, path)
    gone = [(name, p) for name, at, p in found if at < limit and name not in keep and not name.startswith("_")]
    for _, p in gone:
        fs.delete(p, True)
    return [name for name, _ in gone]


def remove_old_temp(spark: SparkSession, older_than_hours: float = 48) -> list[str]:
    """Delete temp tables that ``materialize`` left in the shared folder."""
    return remove_old(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/visitmart/tmp", older_than_hours)
