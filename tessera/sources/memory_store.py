"""Conversation store: an append-only message table and a per-session JSON
file format.

The table is parquet partitioned by the number of buckets that its writer chose
and a hash bucket of the session id, so a session's rows live in one folder:
reading some sessions scans only their buckets, and deleting them rewrites
only those (dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64  # for small tables; choose it so that a bucket is some hundred MB
MESSAGE_COLUMNS = ("session_id", "seq", "type", "text", "tool_requests", "tool_result_id")
CONTENT_TYPE = "array<struct<type:string,text:string,mime:string,data:string>>"
JSON_MESSAGE = (f"struct<seq:bigint,type:string,text:string,contents:{CONTENT_TYPE},"
                "tool_requests:array<struct<id:string,name:string,arguments:string>>,"
                "tool_result_id:string>")


STORED = ("session_id string, seq bigint, type string, text string, tool_requests array<struct<id:string,name:string,arguments:string>>, "
          "tool_result_id string, ts timestamp, n_buckets int, bucket int")


def _bucket(n: int) -> F.Column:
    return F.pmod(F.xxhash64("session_id"), F.lit(n)).cast("int")


def append_messages(messages: DataFrame, path: str, stamp: bool = False, buckets: int = BUCKETS) -> None:
    """Append turns; ``stamp`` sets ``ts`` to the write time (interactive use),
    batch jobs keep the order carried by ``seq``.  A table keeps the number of
    buckets that it began with."""
    spark = messages.sparkSession
    df = messages.select(*MESSAGE_COLUMNS)
    if stamp:
        df = df.withColumn("ts", F.current_timestamp())
    n = _buckets_of(spark, path) or buckets
    (df.withColumns({"n_buckets": F.lit(n), "bucket": _bucket(n)}).sortWithinPartitions("bucket", "session_id", "seq")
     .write.mode("append").partitionBy("n_buckets", "bucket").parquet(path))


def _buckets_of(spark: SparkSession, path: str) -> int | None:
    """The table's number of buckets, told by its folders; None if there is none."""
    from tessera.sources.vector_store import path_exists

    if not path_exists(spark, path):
        return None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    names = [x.getPath().getName() for x in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)]
    found = {int(x.split("=")[1]) for x in names if x.startswith("n_buckets=")}
    return found.pop() if found else None


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def touched_buckets(sessions: DataFrame, n: int) -> list[int]:
    """Buckets that hold any of the sessions: at most ``n`` numbers."""
    return sorted(r[0] for r in sessions.select(_bucket(n)).distinct().collect())


def read_sessions(spark: SparkSession, path: str, sessions: DataFrame) -> DataFrame:
    """Rows of the given sessions; only their buckets are scanned."""
    n = _buckets_of(spark, path)
    rows = read_messages(spark, path)
    if n is None:
        return rows.limit(0)
    wanted = sessions.select("session_id").distinct()
    return rows.where(F.col("bucket").isin(touched_buckets(wanted, n))).join(wanted, "session_id", "left_semi")


# Consecutive seq values numbered together when positions are assigned.
POS_BUCKET = 4096


def scan_sessions(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """Full history of the given sessions, oldest first (``pos`` from 0)."""
    return with_positions(messages.join(sessions.select("session_id").distinct(), "session_id", "left_semi"))


def with_positions(messages: DataFrame) -> DataFrame:
    """``pos`` in the order of ``seq`` (nulls first, ties by the rows' own values), from 0 in each session.  Positions are
    assigned per seq range plus an offset (``ranked``), so a very long session
    is not numbered in one task."""
    from tessera.operators.util import ranked

    out = ranked(messages, ["session_id"], ["seq"], F.floor(F.col("seq") / POS_BUCKET).cast("bigint"), "pos")
    return out.withColumn("pos", (F.col("pos") - 1).cast("int"))


def delete_sessions(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """All messages except those of the given sessions (anti join)."""
    return messages.join(sessions.select("session_id").distinct(), "session_id", "left_anti")


def delete_stored_sessions(spark: SparkSession, path: str, sessions: DataFrame) -> list[int]:
    """Deletes the sessions from the table and returns the touched buckets.

    What stays of those buckets is first written to the shared scratch folder,
    then replaces them; buckets left empty are removed.  Other buckets are not
    read.  Run again after a failure, it does the same."""
    from tessera.session import cut_lineage

    n = _buckets_of(spark, path)
    if n is None:
        return []
    gone = sessions.select("session_id").distinct()
    touched = touched_buckets(gone, n)
    kept = cut_lineage(delete_sessions(read_messages(spark, path).where(F.col("bucket").isin(touched)), gone))
    (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("n_buckets", "bucket").parquet(path))
    left = {r[0] for r in kept.select("bucket").distinct().collect()}  # at most n numbers
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for bucket in set(touched) - left:
        folder = hadoop.Path(f"{path}/n_buckets={n}/bucket={bucket}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return touched


# Messages per JSON object at most (a session spans several lines when longer).
JSON_CHUNK = 1000


def save_sessions_json(messages: DataFrame, path: str, chunk: int = JSON_CHUNK) -> None:
    """JSON lines ``{session_id, chunk, messages:[...]}``: a session's messages
    in ``seq`` order, split into objects of at most ``chunk`` consecutive
    ``seq`` values, so no group (and no line) grows with the session.

    Text-only messages are written in the legacy shape (``text`` without
    ``contents``)."""
    msg = F.struct(F.col("seq"), F.col("type"), F.col("text"), F.col("tool_requests"),
                   F.col("tool_result_id"))
    (messages.withColumn("chunk", F.floor(F.col("seq") / chunk).cast("bigint"))
     .groupBy("session_id", "chunk")
     .agg(F.array_sort(F.collect_list(msg)).alias("messages"))
     .write.mode("overwrite").json(path))


def load_sessions_json(spark: SparkSession, path: str) -> DataFrame:
    """Explode the session JSON lines back to rows (any number of lines per
    session); legacy messages get their text lifted into one TEXT part."""
    raw = spark.read.schema(f"session_id string, chunk bigint, messages array<{JSON_MESSAGE}>").json(path)
    rows = raw.select("session_id", F.explode("messages").alias("m")).select("session_id", "m.*")
    lifted = F.when(F.col("contents").isNull() & F.col("text").isNotNull(), F.array(F.struct(
        F.lit("TEXT").alias("type"), F.col("text").alias("text"), F.lit(None).cast("string").alias("mime"),
        F.lit(None).cast("string").alias("data")))).otherwise(F.col("contents"))
    return rows.withColumn("contents", lifted)
