"""Conversation memory over a message table.

Message schema: ``session_id STRING, seq BIGINT, type STRING (SYSTEM / USER /
AI / TOOL), text STRING, tool_requests ARRAY<STRUCT<id,name,arguments>>,
tool_result_id STRING``.  Every operator is keyed by ``session_id``; per
session ordering is ``seq``.  Top-N windows compile to ``WindowGroupLimit``
(a partial limit before the shuffle), so a session holding a large share of
all rows is cut down map-side; whole sessions are never collected into one
array before a window has bounded them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.util import max_by_key, own_hash, previous_value

DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."
TOOL_REQUEST_TEXT = "Tool Execution Request"
# Fixed value: prefix of the summary message that replaces an overflowing history.
SUMMARY_PREFIX = ("This session is being continued from a previous conversation that ran out of "
                  "context. The summary below covers the earlier portion of the conversation.\n\n")
# Our own instruction text for the summarising model call.
SUMMARY_PROMPT = ("Summarise the conversation below so that it can be continued without it. "
                  "Reply with <summary>...</summary>.\n\n")

# Consecutive seq values processed together by the skew-safe windows.
SEQ_BUCKET = 4096

# Consecutive seq values of a transcript joined in one group, and bytes of transcript in one string.
TRANSCRIPT_WIDTH = 1000
TRANSCRIPT_BYTES = 8 * 1024 * 1024

ROLE_TO_TYPE = {"system": "SYSTEM", "user": "USER", "assistant": "AI", "tool": "TOOL"}


def role_type(role) -> Column:
    r = F.lower(F.col(role) if isinstance(role, str) else role)
    m = F.create_map(*[x for kv in ROLE_TO_TYPE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[r]


def last_n(messages: DataFrame, n: int, *, session_col: str = "session_id",
           order_cols: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Last ``n`` messages per session (newest by ``order_cols``), returned with
    ``pos`` = 0 for the oldest kept message.  Nulls are oldest; messages that are equal in the order are
    ordered by their own values, so the same ones stay in every run."""
    tie = own_hash(messages)
    w = Window.partitionBy(session_col).orderBy(*[F.col(c).desc() for c in order_cols], tie.desc())
    kept = messages.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    w2 = Window.partitionBy(session_col).orderBy(F.col("_rn").desc())
    return kept.withColumn("pos", (F.row_number().over(w2) - 1).cast("int")).drop("_rn")


def fix_system_message(messages: DataFrame, default_text: str = DEFAULT_SYSTEM_PROMPT, *,
                       session_col: str = "session_id") -> DataFrame:
    """Keep only the first SYSTEM message of a session; sessions without one
    get ``default_text`` as a SYSTEM message, its seq one below their least.

    The first is that of the least seq (null least of all), of several by their own
    values, so exactly one row stays; rows without a session are a session.  Only system
    messages pass a window (with a limit before the shuffle); others aren't shuffled."""
    is_sys = F.coalesce(F.col("type") == "SYSTEM", F.lit(False))
    by = Window.partitionBy(session_col).orderBy(F.col("seq").asc_nulls_first(), own_hash(messages))
    first = messages.where(is_sys).withColumn("_rn", F.row_number().over(by)).where(F.col("_rn") == 1).drop("_rn")
    lacking = (messages.groupBy(session_col).agg(F.min("seq").alias("_min_seq"), F.bool_or(is_sys).alias("_has"))
               .where(~F.col("_has")))
    generated = lacking.select(session_col, (F.col("_min_seq") - 1).alias("seq"),
                               F.lit("SYSTEM").alias("type"), F.lit(default_text).alias("text"))
    for c in messages.columns:
        if c not in generated.columns:
            generated = generated.withColumn(c, F.lit(None).cast(messages.schema[c].dataType))
    return messages.where(~is_sys).unionByName(first).unionByName(generated.select(*messages.columns))


def sanitize_tool_messages(messages: DataFrame, strict: bool = False, *,
                           session_col: str = "session_id") -> DataFrame:
    """Drop tool results without an earlier unconsumed request, then drop AI
    messages whose requests are not all answered.

    It is decided on slim events: a result of (session, id, seq) is kept iff a
    request comes with it or was the last event before it; an id is answered iff
    it has a kept result.  Both are told by seq ranges, so a busy (session, id)
    is spread over its ranges.  The verdicts meet the messages by all that they
    follow from (session, seq, ids), so no message stands for another: copies of
    a message share its fate, and differing messages of one seq have their own.
    Messages without tool events are not shuffled.  With ``strict`` a kept result
    whose request message was dropped is dropped too.
    """
    is_tool = F.coalesce(F.col("type") == "TOOL", F.lit(False))
    asks = F.coalesce(F.col("type") == "AI", F.lit(False)) & (F.coalesce(F.size("tool_requests"), F.lit(0)) > 0)
    plain = messages.where(~is_tool & ~asks)
    ids = F.when(is_tool, F.array(F.col("tool_result_id"))).otherwise(F.col("tool_requests.id"))
    # Structs are keys in which a null equals a null.
    called = messages.where(is_tool | asks).withColumn(
        "_key", F.struct(F.col(session_col).alias("s"), F.col("seq").alias("seq"), is_tool.alias("result"), ids.alias("ids")))
    calls = (called.select("_key").distinct()
             .select("_key", F.col("_key.seq").alias("_seq"), F.col("_key.result").alias("_result"), F.explode("_key.ids").alias("_id"))
             .withColumn("_pair", F.struct(F.col("_key.s"), F.col("_id")))
             .withColumn("_range", F.coalesce(F.floor(F.col("_seq") / SEQ_BUCKET).cast("bigint"), F.lit(-2**63))))  # null seqs come first
    calls = previous_value(calls, ["_pair"], ["_seq", "_result"], "_result", F.col("_range"), "_before")
    calls = calls.withColumn("_kept", F.col("_result") & F.coalesce(~F.col("_before"), F.lit(False)))
    calls = max_by_key(calls, ["_pair"], "_kept", "_range", "_answered")
    verdicts = calls.groupBy("_key").agg(F.min(F.when(F.col("_result"), F.col("_kept")).otherwise(F.col("_answered"))).alias("_stays"))
    if strict:
        gone = calls.join(verdicts, "_key").withColumn("_gone", ~F.col("_result") & ~F.col("_stays"))
        verdicts = (max_by_key(gone, ["_pair"], "_gone", "_range", "_taken").groupBy("_key")
                    .agg(F.min(F.col("_stays") & ~(F.col("_result") & F.col("_taken"))).alias("_stays")))
    return plain.unionByName(called.join(verdicts.where("_stays"), "_key", "left_semi").drop("_key"))


def tool_request_text(messages: DataFrame) -> DataFrame:
    """AI messages with tool requests but no text get a fixed text."""
    needs = ((F.col("type") == "AI") & (F.coalesce(F.size("tool_requests"), F.lit(0)) > 0)
             & F.col("text").isNull())
    return messages.withColumn("text", F.when(needs, F.lit(TOOL_REQUEST_TEXT)).otherwise(F.col("text")))


def transcript_line(type_col="type", text_col="text") -> Column:
    t, x = F.col(type_col), F.col(text_col)
    return (F.when(t == "USER", F.concat(F.lit("User: "), F.coalesce(x, F.lit("")), F.lit("\n")))
            .when((t == "AI") & x.isNotNull(), F.concat(F.lit("Assistant: "), x, F.lit("\n"))))


def _lines(messages: DataFrame, session_col: str, width: int) -> DataFrame:
    return (messages.select(session_col, F.floor(F.col("seq") / width).cast("bigint").alias("chunk"), "seq", transcript_line().alias("line"))
            .where(F.col("line").isNotNull()))


def transcript_chunks(messages: DataFrame, *, session_col: str = "session_id", width: int = TRANSCRIPT_WIDTH) -> DataFrame:
    """``session_id, chunk, text, n_lines``: the ``User: / Assistant:`` transcript in
    ordered chunks of ``width`` consecutive ``seq`` values, so no group grows with
    the session."""
    return (_lines(messages, session_col, width).groupBy(session_col, "chunk")
            .agg(F.array_sort(F.collect_list(F.struct("seq", "line"))).alias("_l"))
            .select(session_col, "chunk", F.array_join(F.transform("_l", lambda x: x["line"]), "").alias("text"), F.size("_l").alias("n_lines")))


def transcript(messages: DataFrame, *, session_col: str = "session_id", width: int = TRANSCRIPT_WIDTH,
               max_bytes: int = TRANSCRIPT_BYTES) -> DataFrame:
    """``session_id, part, transcript, n_lines``: ordered ``User: / Assistant:``
    transcripts, one string (part 0) per session.  A longer one has several parts,
    in order whole: those chunks are joined that begin in the same ``max_bytes``,
    told by lengths summed before, so no string is longer than ``max_bytes`` and
    one chunk."""
    before = Window.partitionBy(session_col).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(F.col(session_col), F.col("chunk")).alias("_at")  # a key in which a null equals a null
    parts = (_lines(messages, session_col, width).groupBy(session_col, "chunk").agg(F.sum(F.octet_length("line")).alias("_bytes"))
             .select(at, F.floor(F.coalesce(F.sum("_bytes").over(before), F.lit(0)) / max_bytes).cast("bigint").alias("part")))
    return (transcript_chunks(messages, session_col=session_col, width=width).withColumn("_at", at).join(parts, "_at")
            .groupBy(session_col, "part").agg(F.array_sort(F.collect_list(F.struct("chunk", "text"))).alias("_c"), F.sum("n_lines").cast("int").alias("n_lines"))
            .select(session_col, "part", F.array_join(F.transform("_c", lambda x: x["text"]), "").alias("transcript"), "n_lines"))


def overflow(messages: DataFrame, limit: int, *, session_col: str = "session_id") -> DataFrame:
    """Sessions whose history size reached ``limit`` (partial aggregate)."""
    return (messages.groupBy(session_col).agg(F.count(F.lit(1)).alias("n_messages"))
            .withColumn("overflow", F.col("n_messages") >= limit))


def history_validate(history: DataFrame, *, session_col: str = "session_id",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A chat history is valid iff every row has role user/assistant and a
    non-NULL content; returns ``session_id, n_messages, valid, error_code``."""
    ok = F.col(role_col).isin("user", "assistant") & F.col(text_col).isNotNull()
    return (history.groupBy(session_col)
            .agg(F.count(F.lit(1)).alias("n_messages"), F.bool_and(F.coalesce(ok, F.lit(False))).alias("valid"))
            .withColumn("error_code", F.when(~F.col("valid"), F.lit("701172"))))


def rebuild_with_summary(system_msgs: DataFrame, summaries: DataFrame, *,
                         session_col: str = "session_id") -> DataFrame:
    """New memory = first system message (seq 0) + summary as a USER message
    (seq 1).  ``summaries``: ``session_id, summary``, and ``part`` where a summary
    comes in several: its later parts follow as USER messages."""
    part = F.col("part") if "part" in summaries.columns else F.lit(0)
    sys_rows = system_msgs.select(session_col, F.lit(0).cast("bigint").alias("seq"),
                                  F.lit("SYSTEM").alias("type"), "text")
    sum_rows = summaries.select(session_col, (part + 1).cast("bigint").alias("seq"),
                                F.lit("USER").alias("type"),
                                F.concat(F.when(part == 0, F.lit(SUMMARY_PREFIX)).otherwise(F.lit("")), F.col("summary")).alias("text"))
    return sys_rows.unionByName(sum_rows)


def trim_list(arr, n: int | None) -> Column:
    """Last ``n`` elements of an array column; ``None`` keeps everything."""
    a = F.col(arr) if isinstance(arr, str) else arr
    if n is None:
        return a
    return F.when(F.size(a) > n, F.slice(a, -n, n)).otherwise(a)
