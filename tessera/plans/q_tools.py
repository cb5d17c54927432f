"""Registered queries: tool-call log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import tool_args_map
from tessera.operators import tools as TL
from tessera.plans import fixtures as FX
from tessera.plans.registry import register

# The event fixture spans a month with a few events per user and day, so the
# batch queries use a one-week answer time-out (the operator default is 10 s).
TIMEOUT_SECONDS = 7 * 24 * 3600

_MATCH_SQL = f"""
WITH {FX.TOOL_CALLS_SQL}, {FX.TOOL_RESULTS_SQL},
good AS (SELECT * FROM tool_results WHERE regexp_replace(coalesce(result, ''), '^\\s+|\\s+$', '', 'g') <> ''),
cand AS (SELECT c.session_id, c.request_id, c.seq, c.name, c.ts, c.arguments, g.result AS res, g.ts AS rts, g.seq AS rseq
         FROM tool_calls c LEFT JOIN good g
           ON g.session_id = c.session_id AND g.request_id = c.request_id
          AND g.ts >= c.ts AND g.ts <= c.ts + INTERVAL {TIMEOUT_SECONDS} SECOND),
pick AS (SELECT *, row_number() OVER (PARTITION BY session_id, request_id, seq ORDER BY rts, rseq) AS rn FROM cand),
m AS (SELECT session_id, request_id, seq, name, ts, arguments, coalesce(res, 'Tool execution failed') AS result,
             res IS NOT NULL AS matched FROM pick WHERE rn = 1)
"""


def _matched(spark, sf_dir):
    return TL.match_results(FX.tool_calls(spark, sf_dir), FX.tool_results(spark, sf_dir), TIMEOUT_SECONDS)


@register("tool_results_join", _MATCH_SQL + "SELECT session_id, request_id, seq, result, matched FROM m")
def q_tool_results_join(spark, sf_dir):
    """J-3: each call gets its earliest non-blank result within the time-out,
    otherwise 'Tool execution failed'."""
    return _matched(spark, sf_dir).select("session_id", "request_id", "seq", "result", "matched")


_CATALOG_SQL = f"""
WITH {FX.TOOL_CATALOG_SQL},
cat AS (SELECT name, regexp_replace(name, '\\s', '_', 'g') AS tool_name,
               CASE WHEN regexp_replace(coalesce(name, ''), '^\\s+|\\s+$', '', 'g') = ''
                      OR regexp_replace(coalesce(description, ''), '^\\s+|\\s+$', '', 'g') = ''
                    THEN '701192' END AS error_code FROM tool_catalog)
"""


@register("tool_catalog_clean", _CATALOG_SQL + "SELECT name, tool_name, error_code FROM cat")
def q_tool_catalog_clean(spark, sf_dir):
    """Tool names normalised, blank mandatory fields -> 701192."""
    return TL.clean_catalog(FX.tool_catalog(spark, sf_dir)).select("name", "tool_name", "error_code")


@register("tool_hallucinated", _CATALOG_SQL.replace("WITH ", f"WITH {FX.TOOL_CALLS_SQL}, ", 1) + """
SELECT c.session_id, c.seq, c.name, k.tool_name IS NOT NULL AS known,
       CASE WHEN k.tool_name IS NULL THEN 'This is a hallucinated tool execution request' END AS hallucination
FROM tool_calls c LEFT JOIN (SELECT DISTINCT tool_name FROM cat WHERE error_code IS NULL) k ON k.tool_name = c.name
""")
def q_tool_hallucinated(spark, sf_dir):
    """J-4: calls of tools missing from the catalog get a fixed text."""
    cat = TL.clean_catalog(FX.tool_catalog(spark, sf_dir))
    return TL.flag_hallucinated(FX.tool_calls(spark, sf_dir), cat).select(
        "session_id", "seq", "name", "known", "hallucination")


@register("tool_call_cap", _CATALOG_SQL.replace("WITH ", f"WITH {FX.TOOL_CALLS_SQL}, ", 1) + """
, k AS (SELECT c.*, c.name IN (SELECT tool_name FROM cat WHERE error_code IS NULL) AS known FROM tool_calls c),
n AS (SELECT session_id, seq, CASE WHEN known THEN row_number() OVER (PARTITION BY session_id, known ORDER BY ts, seq) END AS call_no
      FROM k)
SELECT session_id, seq, call_no::INTEGER AS call_no, CASE WHEN call_no > 100 THEN '701191' END AS error_code FROM n
""")
def q_tool_call_cap(spark, sf_dir):
    """At most 100 known-tool calls per request (session); later ones
    are quarantined with 701191."""
    cat = TL.clean_catalog(FX.tool_catalog(spark, sf_dir))
    flagged = TL.flag_hallucinated(FX.tool_calls(spark, sf_dir), cat)
    return TL.cap_calls(flagged).select("session_id", "seq", "call_no", "error_code")


@register("tool_call_cap_nulls", f"""
WITH {FX.TOOL_CALLS_SQL},
c AS (SELECT CASE WHEN seq % 3 > 0 THEN session_id END AS session_id, CASE WHEN seq % 11 > 0 THEN ts END AS ts,
             CASE WHEN seq % 7 > 0 THEN seq END AS seq, seq % 5 > 0 AS known FROM tool_calls),
n AS (SELECT *, CASE WHEN known THEN row_number() OVER (PARTITION BY session_id, known ORDER BY ts NULLS FIRST, seq NULLS FIRST) END AS call_no FROM c)
SELECT session_id, count(*) AS n_calls, count(call_no) AS n_numbered, max(call_no)::INTEGER AS last_no,
       sum(CASE WHEN ts IS NOT NULL THEN call_no END)::BIGINT AS timed_nos, count(*) FILTER (WHERE call_no > 100) AS n_over
FROM n GROUP BY session_id
""")
def q_tool_call_cap_nulls(spark, sf_dir):
    """W6 on calls a third of which lack their session, others their time or seq: all are
    numbered, those without a time first."""
    c = FX.tool_calls(spark, sf_dir)
    c = c.select(F.when(F.col("seq") % 3 > 0, F.col("session_id")).alias("session_id"), "request_id", "name",
                 F.when(F.col("seq") % 11 > 0, F.col("ts")).alias("ts"), F.when(F.col("seq") % 7 > 0, F.col("seq")).alias("seq"),
                 (F.col("seq") % 5 > 0).alias("known"))
    return TL.cap_calls(c).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_calls"), F.count("call_no").alias("n_numbered"), F.max("call_no").alias("last_no"),
        F.sum(F.when(F.col("ts").isNotNull(), F.col("call_no"))).alias("timed_nos"), F.count("error_code").alias("n_over"))


@register("tool_args_decode", f"""
WITH {FX.TOOL_CALLS_SQL},
r AS (SELECT seq, regexp_replace(arguments, ',(\\s*[}}\\]])', '\\1', 'g') AS j FROM tool_calls),
k AS (SELECT seq, j, unnest(json_keys(j)) AS key FROM r WHERE json_valid(j))
SELECT seq, key, json_extract_string(j, '$."' || key || '"') AS value FROM k
""")
def q_tool_args_decode(spark, sf_dir):
    """JSON tool arguments with trailing commas repaired, as key/value rows."""
    c = FX.tool_calls(spark, sf_dir)
    return c.select("seq", F.explode(tool_args_map("arguments")).alias("key", "value"))


@register("tool_batch_complete", _MATCH_SQL + """
SELECT session_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS requested,
       count(*) FILTER (WHERE matched) AS collected,
       count(*) FILTER (WHERE matched) >= count(*) AS complete
FROM m GROUP BY ALL
""")
def q_tool_batch_complete(spark, sf_dir):
    """A5: per (session, day) batch: requested vs collected results."""
    m = _matched(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return TL.batch_completeness(m, ("session_id", "day"))


@register("tool_executions", _MATCH_SQL + """
, d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM m),
n AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, seq) AS call_no FROM d)
SELECT day, (count(*) FILTER (WHERE call_no <= 100))::INTEGER AS n_executions, count(*) FILTER (WHERE call_no > 100) AS n_over,
       string_agg(request_id || '=' || result, '|' ORDER BY ts, seq) FILTER (WHERE call_no <= 100) AS executions
FROM n GROUP BY day
""")
def q_tool_executions(spark, sf_dir):
    """Ordered (request, result) list of each request (a day's calls,
    which are more than the cap of 100), and the number of calls over the cap."""
    m = _matched(spark, sf_dir).withColumns({"known": F.lit(True), "day": F.date_format("ts", "yyyy-MM-dd")})
    ex = TL.executions(TL.cap_calls(m, request_cols=("day",)), request_cols=("day",))
    return ex.select("day", F.size("tool_executions").alias("n_executions"), "n_over",
                     F.array_join(F.transform("tool_executions", lambda e: F.concat(
                         e["request"]["id"], F.lit("="), e["result"])), "|").alias("executions"))


@register("token_usage_sum", f"""
WITH {FX.MODEL_CALLS_SQL}
SELECT request_id, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
       sum(input_tokens + output_tokens)::BIGINT AS total_tokens, count(*) AS calls
FROM model_calls GROUP BY request_id
""")
def q_token_usage_sum(spark, sf_dir):
    """A1: token usage summed over all model calls of a request."""
    return TL.token_usage(FX.model_calls(spark, sf_dir))
