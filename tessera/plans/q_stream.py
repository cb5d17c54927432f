"""Registered queries: Structured Streaming operators, each drained with
``availableNow`` and compared with its batch equivalent."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tessera.plans import fixtures as FX
from tessera.plans.knowledge import knowledge_rows
from tessera.plans.q_knowledge import _RETRIEVAL_SQL, RAG_K, RAG_MIN_SCORE
from tessera.plans.q_memory import MEMORY_LIMIT, WINDOW_N, memory_sql
from tessera.plans.q_tools import _MATCH_SQL, TIMEOUT_SECONDS
from tessera.plans.registry import register
from tessera.plans.standin import extractive_answer_factory
from tessera.session import cut_lineage
from tessera.sources.tables import table
from tessera.sources.vector_store import scratch_path, store_scan
from tessera.streaming.ingest import ingest_stream
from tessera.streaming.questions import answer_stream
from tessera.streaming.runner import file_stream, run_available_now
from tessera.streaming.sessions import expiring_window, latest_windows, running_window, stored_windows
from tessera.streaming.summaries import summarizing_memory
from tessera.streaming.tool_calls import CALL_SCHEMA, match_as_they_come, stream_match

WATERMARK_DELAY_SECONDS = 3600


STREAM_PARTS, FILES_PER_PART = 3, 4
EVENTS_A_KEY = 512
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocksdb(spark):
    """State stores of the streams started within are RocksDB's."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(setting, old)


def _stream(spark, sf_dir, name, order, key):
    """The table as a stream of several micro-batches: its rows by ranges of
    ``order``, one range after the other (nulls in the first), rows of a ``key`` together."""
    rows = table(spark, sf_dir, name)
    bounds = rows.approxQuantile(order, [k / STREAM_PARTS for k in range(1, STREAM_PARTS)], 0.01)
    path = scratch_path(spark, f"{name}-stream")
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = rows
        if low is not None:
            part = part.where(F.col(order) >= low)
        if high is not None:
            early = F.col(order) < high
            part = part.where(early | F.col(order).isNull() if low is None else early)
        part.repartition(FILES_PER_PART, key).write.mode("append").parquet(path)
    return file_stream(spark, path, rows.schema, max_files_per_trigger=FILES_PER_PART)


@register("stream_ingest", r"""
WITH t AS (SELECT doc_id, text FROM documents
           WHERE len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) > 0)) > 0)
SELECT min(doc_id) AS doc_id FROM t GROUP BY md5(text)
""")
def q_stream_ingest(spark, sf_dir):
    """Documents arriving as a stream are ingested batch by batch
    (idempotent by content id); the store then holds one row per text."""
    path = scratch_path(spark, "stream-store")
    docs = _stream(spark, sf_dir, "documents", "doc_id", "doc_id").select("doc_id", "text")
    ingest_stream(docs, path, "kb", None, parse_docs=False, split=False)
    return store_scan(spark, path, "kb").select(F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"))


@register("stream_session_window", f"""
WITH {FX.MESSAGES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq DESC) AS rn FROM messages)
SELECT session_id, seq, type, (row_number() OVER (PARTITION BY session_id ORDER BY seq) - 1)::INTEGER AS pos
FROM r WHERE rn <= {WINDOW_N}
""")
def q_stream_session_window(spark, sf_dir):
    """Running last-4 window per session kept in bounded state; the
    newest emitted window equals the batch window."""
    msgs = FX.messages(spark, sf_dir, _stream(spark, sf_dir, "conversations", "turn", "conv_id"))
    out = run_available_now(running_window(msgs, WINDOW_N), name="session-window")
    return latest_windows(spark.read.parquet(out)).select("session_id", "seq", "type", "pos")


@register("stream_window_stored", f"""
WITH {FX.MESSAGES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq DESC) AS rn FROM messages)
SELECT session_id, seq, type FROM r WHERE rn <= {WINDOW_N}
""")
def q_stream_window_stored(spark, sf_dir):
    """The same windows as list state with expiry; after the stream has stopped they are read
    from its state store."""
    msgs = FX.messages(spark, sf_dir, _stream(spark, sf_dir, "conversations", "turn", "conv_id"))
    checkpoint = scratch_path(spark, "window-state")
    with _rocksdb(spark):
        run_available_now(expiring_window(msgs, WINDOW_N), name="window-state", checkpoint=checkpoint, empty_batches=False)
        return cut_lineage(stored_windows(spark, checkpoint)).select("session_id", "seq", "type")


@register("stream_tool_results", _MATCH_SQL + "SELECT session_id, request_id, seq, result, matched FROM m")
def q_stream_tool_results(spark, sf_dir):
    """T4/T5: calls and results as two streams joined with watermarks and
    the time-out interval, one row a call as in the batch query.  The events are copied to a stream
    folder followed by one sentinel event past the last time-out, so the
    watermark passes every call and the unmatched ones are emitted."""
    calls, results, own = _tool_streams(spark, sf_dir)
    matched = stream_match(calls, results, TIMEOUT_SECONDS, WATERMARK_DELAY_SECONDS)
    out = run_available_now(matched, name="tool-stream")
    return spark.read.parquet(out).where(~F.col("seq").eqNullSafe(own)).select("session_id", "request_id", "seq", "result", "matched")


def _tool_streams(spark, sf_dir):
    """All calls and results, and one of each past the last time-out in a later micro-batch; the seq of that call."""
    src = scratch_path(spark, "events-stream")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{src}/part=0")
    last, least = events.agg(F.max("ts"), F.min("event_id")).first()
    own = min(least or 0, 0) - 2  # event ids that no event has
    # one sentinel per input stream (a call and a result): the query's
    # watermark is the minimum over both streams.
    sentinel = (spark.range(2).select(
        (F.col("id") + own).alias("event_id"),
        (F.lit(last) + F.expr(f"INTERVAL {TIMEOUT_SECONDS + 2 * WATERMARK_DELAY_SECONDS} SECONDS"))
        .cast(events.schema["ts"].dataType).alias("ts"),
        F.lit(-1).cast("bigint").alias("user_id"),
        F.when(F.col("id") == 0, "click").otherwise("purchase").alias("event_type"),
        F.lit(99.0).alias("value"), F.lit('{"k": 0}').alias("props")))
    sentinel.write.parquet(f"{src}/part=1")
    # first micro-batch: all event files; second: the sentinel (files are
    # taken oldest first), so the watermark passes every call at the end
    n_files = len(spark.read.parquet(f"{src}/part=0").inputFiles())
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(max(1, n_files)))
              .option("recursiveFileLookup", "true").parquet(src))
    return FX.tool_calls(spark, sf_dir, stream), FX.tool_results(spark, sf_dir, stream), own


@register("stream_tool_calls_early", _MATCH_SQL + "SELECT session_id, request_id, seq, result, matched, matched AS early FROM m")
def q_stream_tool_calls_early(spark, sf_dir):
    """T4/T5: the same calls with state and timers: those with a result come out in the
    micro-batch that brings it (``early``), the others when the watermark passes their time-out."""
    calls, results, own = _tool_streams(spark, sf_dir)
    keys = table(spark, sf_dir, "events").count() // EVENTS_A_KEY + 1
    path = scratch_path(spark, "tool-calls")

    def batch(df, batch_id):
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with _rocksdb(spark):
        run_available_now(match_as_they_come(calls, results, TIMEOUT_SECONDS, WATERMARK_DELAY_SECONDS, keys), name="tool-calls", foreach_batch=batch)
    rows = spark.read.schema(f"{CALL_SCHEMA}, batch_id int").parquet(path).where(F.col("kind") == "call")
    return rows.where(~F.col("seq").eqNullSafe(own)).select("session_id", "request_id", "seq", "result", "matched", (F.col("batch_id") == 0).alias("early"))


@register("stream_questions", _RETRIEVAL_SQL + """
SELECT query_id, rank::INTEGER AS rank, doc_id, round(score, 3) AS score FROM r WHERE rank <= 5
""")
def q_stream_questions(spark, sf_dir):
    """Questions arriving as a stream, each batch searched against a
    static de-duplicated document store (top 5, relevance >= 0.75)."""
    rows = knowledge_rows(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          parse_docs=False, split=False)
    store = cut_lineage(rows.where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    questions = _stream(spark, sf_dir, "benchmark", "item_id", "item_id").select(F.col("item_id").alias("query_id"), "text")
    out = answer_stream(questions, store, scratch_path(spark, "answers"), k=RAG_K, min_score=RAG_MIN_SCORE)
    hits = spark.read.parquet(out)
    return hits.select("query_id", "rank", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                       F.round("score", 3).alias("score"))


@register("stream_memory_summarize", memory_sql())
def q_stream_memory_summarize(spark, sf_dir):
    """Turns streamed in several micro-batches; a full memory (4 messages) is
    summarised when the next message comes.  Returns each session's newest
    memory, the same as the batch query's."""
    msgs = FX.messages(spark, sf_dir, _stream(spark, sf_dir, "conversations", "turn", "conv_id"))
    return summarizing_memory(msgs, scratch_path(spark, "summaries"), MEMORY_LIMIT, extractive_answer_factory)
