"""Tool-call log operators: result matching with time-out, hallucinated
tools, per-request caps, completeness, executions and token usage.

Call schema: ``session_id, request_id, name, arguments, ts TIMESTAMP, seq``.
Result schema: ``session_id, request_id, result, ts TIMESTAMP, seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import errors as E
from tessera.functions.text import is_blank, normalize_tool_name
from tessera.operators.util import ranked

# Texts of the original agent.
TOOL_EXECUTION_FAILED = "Tool execution failed"
HALLUCINATED_TOOL = "This is a hallucinated tool execution request"
MAX_TOOL_EXECUTIONS = 100
DEFAULT_TIMEOUT_SECONDS = 10

KEY = ("session_id", "request_id")


def match_results(calls: DataFrame, results: DataFrame,
                  timeout_seconds: float | None = DEFAULT_TIMEOUT_SECONDS) -> DataFrame:
    """For every call, the earliest non-blank result of the same (session,
    request id) with ``call.ts <= result.ts <= call.ts + timeout``.

    An as-of lookup, not a pair join: calls and results are unioned, and one
    running ``last(..., ignorenulls)`` over the rows in falling order of time
    holds the next result of each call.  The window is partitioned by key *and* a time bucket of width
    ``timeout`` (each result is placed in its own bucket and the one before),
    so a request id with many events is split over its time range and no
    candidate pairs are ever materialised.

    Adds ``result`` (the text, or ``Tool execution failed``), ``matched``,
    ``result_seq``.  A null session, request id or time matches nothing: such calls stay, unmatched, spread
    over as many groups as they have times and seqs.
    """
    good = results.where(~is_blank("result"))
    for c in (*KEY, "ts"):
        good = good.where(F.col(c).isNotNull())
    known = F.col("session_id").isNotNull() & F.col("request_id").isNotNull() & F.col("ts").isNotNull()
    if timeout_seconds is None:
        width = None
        cb = F.lit(0).cast("bigint")
    else:
        width = int(timeout_seconds * 1_000_000)
        cb = F.floor(F.unix_micros(F.col("ts")) / F.lit(width)).cast("bigint")
    # The call rows ride along as a struct so no join back is needed.
    call_struct = F.struct(*[F.col(x) for x in calls.columns])
    c = calls.select(*KEY, "ts", "seq", F.when(known, cb).otherwise(F.xxhash64("ts", "seq")).alias("_pb"), F.lit(0).alias("_kind"),
                     F.lit(None).cast("string").alias("_res"), call_struct.alias("_call"))
    r = good.select(*KEY, "ts", "seq", cb.alias("_rb"), F.lit(1).alias("_kind"),
                    F.col("result").alias("_res"),
                    F.lit(None).cast(c.schema["_call"].dataType).alias("_call"))
    if width is None:
        r = r.withColumnRenamed("_rb", "_pb")
    else:
        r = r.withColumn("_pb", F.explode(F.array(F.col("_rb"), F.col("_rb") - 1))).drop("_rb")
    ev = c.unionByName(r)
    w = (Window.partitionBy(*KEY, "_pb").orderBy(F.desc("ts"), F.desc("_kind"), F.desc("seq"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.last(F.when(F.col("_kind") == 1, F.struct(F.col("ts").alias("ts"), F.col("_res").alias("res"),
                                                       F.col("seq").alias("seq"))), ignorenulls=True)
    found = ev.withColumn("_next", nxt.over(w)).where(F.col("_kind") == 0)
    in_time = known & F.col("_next").isNotNull()
    if width is not None:
        in_time = in_time & F.coalesce(F.unix_micros(F.col("_next.ts")) - F.unix_micros(F.col("ts")) <= width, F.lit(False))
    return found.select("_call.*", F.when(in_time, F.col("_next.seq")).alias("result_seq"),
                        in_time.alias("matched"),
                        F.when(in_time, F.col("_next.res")).otherwise(F.lit(TOOL_EXECUTION_FAILED))
                        .alias("result"))


def clean_catalog(catalog: DataFrame, required: tuple[str, ...] = ("name", "description")) -> DataFrame:
    """Normalise tool names (each whitespace char -> ``_``); rows with a blank
    mandatory field get ``error_code`` 701192."""
    bad = F.lit(False)
    for c in required:
        bad = bad | is_blank(c)
    return (catalog.withColumn("tool_name", normalize_tool_name("name"))
            .withColumn("error_code", F.when(bad, F.lit(E.INVALID_TOOL_CONFIG))))


def flag_hallucinated(calls: DataFrame, catalog: DataFrame) -> DataFrame:
    """Calls whose tool is not in the (clean) catalog get ``known = false``
    and the fixed hallucination text as their result."""
    names = catalog.where(F.col("error_code").isNull()).select(
        F.col("tool_name").alias("name")).distinct().withColumn("_known", F.lit(True))
    out = calls.join(names, "name", "left")
    return (out.withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")
            .withColumn("hallucination", F.when(~F.col("known"), F.lit(HALLUCINATED_TOOL))))


# Width of the time buckets used to split a busy request when numbering calls.
CALL_BUCKET_SECONDS = 3600


def cap_calls(calls: DataFrame, cap: int = MAX_TOOL_EXECUTIONS, *,
              request_cols: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """Number the known calls of each request by time; calls beyond ``cap``
    get ``error_code`` 701191.  Unknown tools do not count; calls without a time come first, those without a
    request's columns are one request's.  Numbering is
    split by hour (``ranked``), so one request with a huge log does not land
    in a single task."""
    hour = F.floor(F.unix_micros(F.col("ts")) / F.lit(CALL_BUCKET_SECONDS * 1_000_000)).cast("bigint")
    is_known = F.coalesce(F.col("known"), F.lit(False))
    known = ranked(calls.where(is_known), list(request_cols), ["ts", "seq"], hour, "call_no")
    unknown = calls.where(~is_known).withColumn("call_no", F.lit(None).cast("int"))
    return (known.unionByName(unknown)
            .withColumn("error_code", F.when(F.col("call_no") > cap, F.lit(E.TOO_MANY_TOOL_CALLS))))


def batch_completeness(matched: DataFrame, correlation_cols: tuple[str, ...]) -> DataFrame:
    """Per correlation: requested, collected and whether all results are in."""
    return (matched.groupBy(*correlation_cols)
            .agg(F.count(F.lit(1)).alias("requested"),
                 F.count_if(F.col("matched")).alias("collected"))
            .withColumn("complete", F.col("collected") >= F.col("requested")))


def executions(matched: DataFrame, *, request_cols: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """Ordered list of (request, result) per request of the calls without
    ``error_code`` (so at most the cap of ``cap_calls``), and ``n_over``, the number of
    calls that the cap refused."""
    over = F.col("error_code").isNotNull() if "error_code" in matched.columns else F.lit(False)
    ex = F.struct(F.col("ts"), F.col("seq"), F.struct(F.col("request_id").alias("id"), F.col("name"),
                                                      F.col("arguments")).alias("request"),
                  F.col("result"))
    return (matched.groupBy(*request_cols)
            .agg(F.array_sort(F.collect_list(F.when(~over, ex))).alias("_ex"), F.count_if(over).alias("n_over"))
            .select(*request_cols, F.transform("_ex", lambda e: F.struct(e["request"].alias("request"),
                                                                         e["result"].alias("result")))
                    .alias("tool_executions"), "n_over"))


def token_usage(model_calls: DataFrame, *, request_col: str = "request_id") -> DataFrame:
    """Input / output / total tokens summed per request (partial aggregate)."""
    return (model_calls.groupBy(request_col)
            .agg(F.sum("input_tokens").cast("bigint").alias("input_tokens"),
                 F.sum("output_tokens").cast("bigint").alias("output_tokens"),
                 F.sum(F.col("input_tokens") + F.col("output_tokens")).cast("bigint").alias("total_tokens"),
                 F.count(F.lit(1)).alias("calls")))
