"""Running a streaming query to completion (``availableNow``) with its
checkpoint in the shared checkpoint folder, so a restarted driver resumes
exactly where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.vector_store import scratch_path


def run_available_now(stream: DataFrame, sink_path: str | None = None, *, name: str = "stream",
                      output_mode: str = "append", checkpoint: str | None = None,
                      foreach_batch: Callable[[DataFrame, int], None] | None = None, empty_batches: bool = True) -> str:
    """Process everything available now, then stop; returns the sink path.

    ``empty_batches=False`` runs no batch without input: state that expires by processing time asks for
    one more at all times, so a stream of it would never stop."""
    spark = stream.sparkSession
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, before if empty_batches else "false")
    try:
        return _drain(stream, sink_path, name, output_mode, checkpoint, foreach_batch)
    finally:
        spark.conf.set(setting, before)


def _drain(stream: DataFrame, sink_path: str | None, name: str, output_mode: str, checkpoint: str | None,
           foreach_batch: Callable[[DataFrame, int], None] | None) -> str:
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        q = writer.foreachBatch(foreach_batch).trigger(availableNow=True).start()
    else:
        sink_path = sink_path or scratch_path(spark, f"{name}-out")
        q = writer.format("parquet").option("path", sink_path).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sink_path or ""


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files at ``path``: a folder or a glob (a single
    file is streamed through a glob that matches just that file)."""
    reader = spark.readStream.schema(schema)
    if path.endswith(".parquet"):
        path = path[:-len("t")] + "[t]"
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)
