"""SparkSession construction and the shared checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Broadcast only below a fixed size; anything larger takes a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # checkpoint files of collected DataFrames are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Only for a local master (tests, bench): the driver JVM is the whole cluster.
LOCAL_CONF = {"spark.driver.memory": "16g"}


def get_session(master: str | None = None, app: str = "lapse",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        for k, v in LOCAL_CONF.items():
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local master (one machine: tests, bench) may leave it unset and gets a
    private folder; on a cluster that would be another disk on every machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="lapse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


# Called with (name, frame) before a frame is written; scripts/plans.py reports these plans.
MATERIALIZE_HOOKS: list = []


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    read it back (lineage cut, survives executor loss).

    Used where one intermediate feeds several passes of the same query (the
    activity table, the valid ratios, the scored table).  Unlike an RDD
    checkpoint the table is columnar: later passes read only the columns
    they use, with filters pushed into the scan.
    """
    spark = df.sparkSession
    for hook in MATERIALIZE_HOOKS:
        hook(name, df)
    path = scratch_table(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_table(spark: SparkSession, name: str) -> str:
    """Path for a written intermediate table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
