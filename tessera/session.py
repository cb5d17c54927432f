"""SparkSession construction and cluster-safe helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs regardless of cluster size.  Everything else (executor
# count, memory, shuffle partitions at 100 TB) belongs to the deployment.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only where it is unset on
    a local master (tests) fall back to a fresh scratch folder.  On a cluster
    every machine would write to a folder of its own, so that is an error."""
    sc = spark.sparkContext
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or sc.getConf().get("spark.checkpoint.dir", None)
               or sc.getCheckpointDir())
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        if spark.conf.get("spark.checkpoint.dir", None) is None:
            spark.conf.set("spark.checkpoint.dir", current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in a fresh folder under the shared
    checkpoint directory and read it back.

    Like a reliable checkpoint it survives executor loss and cuts the plan,
    but the frame is computed exactly once (an RDD checkpoint runs the
    lineage a second time to write its files) and the copy is columnar, so
    later scans prune columns and push filters.  Texts take less disk by zstd than by Spark's usual codec."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-table-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# Tables that cut_lineage wrote for this driver.
_SCRATCH: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Removes the tables that :func:`cut_lineage` wrote for this driver, once the
    results that read them are written; returns their number.  A long-lived driver
    calls it between jobs."""
    hadoop, n = spark.sparkContext._jvm.org.apache.hadoop.fs, 0
    while _SCRATCH:
        folder = hadoop.Path(_SCRATCH.pop())
        n += bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))
    return n
