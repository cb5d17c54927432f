"""Messages stream in, memories are summarised when full and go on.

Every micro-batch continues the memories of the sessions that it touches with
the batch operator (one model call for all sessions of a task that are due at
a time) and writes them to a folder of its own; a replayed batch overwrites
its folder.  Every ``compact_every``-th folder holds the newest memories of all
sessions, and nothing older is read again, so state is one memory a session
and at most that many folders of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.summaries import MEMORY_SCHEMA, continue_memories
from tessera.sources.vector_store import path_exists
from tessera.streaming.runner import run_available_now

COMPACT_EVERY = 32


def newest(spark: SparkSession, path: str, first: int, before: int) -> DataFrame:
    """Newest memories in the folders of the batches ``first`` .. ``before - 1``."""
    folders = [f"{path}/batch_id={k}" for k in range(max(0, first), before) if path_exists(spark, f"{path}/batch_id={k}")]
    if not folders:
        return spark.createDataFrame([], f"{MEMORY_SCHEMA}, batch_id int")
    rows = spark.read.schema(f"{MEMORY_SCHEMA}, batch_id int").option("basePath", path).parquet(*folders)
    last = rows.groupBy("session_id").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, ["session_id", "batch_id"], "left_semi")


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the newest batch with a finished folder at ``path`` (-1: none)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return -1
    names = [f.getPath().getName() for f in fs.listStatus(folder) if fs.exists(hadoop.Path(f.getPath(), "_SUCCESS"))]
    return max((int(n.partition("=")[2]) for n in names if n.startswith("batch_id=")), default=-1)


def summarizing_memory(messages_stream: DataFrame, path: str, limit: int, complete_fn_factory, *,
                       checkpoint: str | None = None, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Drains the stream; returns the newest memory of every session, also where a restart
    on the same checkpoint and ``path`` finds nothing new.  Batches
    are taken as they arrive; within one, ``seq`` decides the order."""
    spark = messages_stream.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        whole = batch_id % compact_every == 0
        base = batch_id - compact_every if whole else batch_id - batch_id % compact_every
        before = newest(spark, path, base, batch_id).drop("batch_id")
        messages = df.select("session_id", "seq", "type", "text").persist()
        try:
            if not whole:
                before = before.join(messages.select("session_id").distinct(), "session_id", "left_semi")
            continue_memories(messages, limit, complete_fn_factory, before).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            messages.unpersist()

    run_available_now(messages_stream, name="summaries", foreach_batch=batch, checkpoint=checkpoint)
    last = last_batch(spark, path)
    return newest(spark, path, last - last % compact_every, last + 1).drop("batch_id")
