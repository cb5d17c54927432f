"""Registered queries: conversation memory."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import summary_extract
from tessera.operators import memory as M
from tessera.plans import fixtures as FX
from tessera.operators.summaries import continue_memories
from tessera.plans import sqlgen as G
from tessera.plans.standin import extractive_answer_factory, failing_answer_factory
from tessera.plans.registry import register
from tessera.sources import memory_store as MS
from tessera.sources.tables import table
from tessera.sources.vector_store import scratch_path

WINDOW_N = 4
OVERFLOW_LIMIT = 6


@register("memory_window", f"""
WITH {FX.MESSAGES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq DESC) AS rn FROM messages)
SELECT session_id, seq, type, (row_number() OVER (PARTITION BY session_id ORDER BY seq) - 1)::INTEGER AS pos
FROM r WHERE rn <= {WINDOW_N}
""")
def q_memory_window(spark, sf_dir):
    """Last 4 messages per session, oldest first."""
    return M.last_n(FX.messages(spark, sf_dir), WINDOW_N).select("session_id", "seq", "type", "pos")


def _stored(spark, sf_dir) -> str:
    """The messages written as a table, user turns first."""
    path = scratch_path(spark, "memory")
    msgs = FX.messages(spark, sf_dir)
    MS.append_messages(msgs.where(F.col("type") == "USER"), path)
    MS.append_messages(msgs.where(F.col("type") != "USER"), path)
    return path


@register("memory_scan", f"""
WITH {FX.MESSAGES_SQL},
s AS (SELECT DISTINCT session_id FROM messages WHERE type = 'SYSTEM')
SELECT session_id, seq, (row_number() OVER (PARTITION BY session_id ORDER BY seq) - 1)::INTEGER AS pos
FROM messages WHERE session_id IN (SELECT session_id FROM s)
""")
def q_memory_scan(spark, sf_dir):
    """Full history (oldest first) of a set of sessions given as a table
    (here: those with a system message) from a message table on disk, whose
    other buckets are not scanned."""
    path = _stored(spark, sf_dir)
    wanted = FX.messages(spark, sf_dir).where(F.col("type") == "SYSTEM").select("session_id")
    return MS.with_positions(MS.read_sessions(spark, path, wanted)).select("session_id", "seq", "pos")


@register("memory_nulls", f"""
WITH {FX.MESSAGES_SQL},
m AS (SELECT CASE WHEN hash_key % 4 > 0 THEN session_id END AS session_id, CASE WHEN hash_key % 5 > 0 THEN seq END AS seq, type, text
      FROM (SELECT *, session_id::BIGINT + 3 * seq AS hash_key FROM messages)),
p AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq NULLS FIRST) - 1 AS pos,
             row_number() OVER (PARTITION BY session_id ORDER BY seq DESC NULLS LAST) AS back FROM m),
s AS (SELECT session_id, count(*) AS n, max(pos)::INTEGER AS last_pos, sum(CASE WHEN seq IS NOT NULL THEN pos END)::BIGINT AS known_pos,
             count(*) FILTER (WHERE back <= {WINDOW_N}) AS n_window, count(*) FILTER (WHERE type = 'SYSTEM') AS n_system FROM p GROUP BY session_id)
SELECT session_id, n, last_pos, known_pos, n_window, n - n_system + 1 AS n_fixed FROM s
""")
def q_memory_nulls(spark, sf_dir):
    """S6, W2 and W4 on messages some of which lack session or seq: no row is lost in positions,
    windows hold N, and every session, also that of null, has one system message."""
    m, key = FX.messages(spark, sf_dir), F.col("session_id").cast("bigint") + 3 * F.col("seq")
    m = m.withColumn("_key", key).withColumns({"session_id": F.when(F.col("_key") % 4 > 0, F.col("session_id")), "seq": F.when(F.col("_key") % 5 > 0, F.col("seq"))}).drop("_key")
    at = MS.with_positions(m).select(F.struct("session_id").alias("s"), F.lit(1).alias("a"), F.col("pos").alias("last_pos"),
                                     F.when(F.col("seq").isNotNull(), F.col("pos")).alias("known_pos"), F.lit(0).alias("w"), F.lit(0).alias("f"))
    none = F.lit(None).cast("int")
    window = M.last_n(m, WINDOW_N).select(F.struct("session_id").alias("s"), F.lit(0).alias("a"), none.alias("last_pos"), none.alias("known_pos"), F.lit(1).alias("w"), F.lit(0).alias("f"))
    fixed = M.fix_system_message(m).select(F.struct("session_id").alias("s"), F.lit(0).alias("a"), none.alias("last_pos"), none.alias("known_pos"), F.lit(0).alias("w"), F.lit(1).alias("f"))
    return (at.unionByName(window).unionByName(fixed).groupBy("s").agg(
        F.sum("a").alias("n"), F.max("last_pos").alias("last_pos"), F.sum("known_pos").alias("known_pos"), F.sum("w").alias("n_window"), F.sum("f").alias("n_fixed"))
        .select("s.session_id", "n", "last_pos", "known_pos", "n_window", "n_fixed"))


@register("memory_append", f"""
WITH {FX.MESSAGES_SQL} SELECT session_id, seq, type FROM messages
""")
def q_memory_append(spark, sf_dir):
    """Append user turns, then the other turns, to a memory table."""
    path = scratch_path(spark, "memory")
    msgs = FX.messages(spark, sf_dir)
    MS.append_messages(msgs.where(F.col("type") == "USER"), path)
    MS.append_messages(msgs.where(F.col("type") != "USER"), path)
    return MS.read_messages(spark, path).select("session_id", "seq", "type")


@register("memory_json_roundtrip", f"""
WITH {FX.MESSAGES_SQL}
SELECT session_id, seq, type, 'TEXT' AS content_type, text FROM messages
""")
def q_memory_json_roundtrip(spark, sf_dir):
    """Save sessions as JSON (one object per session), load back;
    legacy messages with text only are lifted to one TEXT content part."""
    path = scratch_path(spark, "memory-json")
    MS.save_sessions_json(FX.messages(spark, sf_dir), path)
    back = MS.load_sessions_json(spark, path)
    return back.select("session_id", "seq", "type", F.col("contents")[0]["type"].alias("content_type"),
                       F.col("contents")[0]["text"].alias("text"))


@register("memory_delete_sessions", f"""
WITH {FX.MESSAGES_SQL}
SELECT session_id, seq FROM messages
WHERE session_id NOT IN (SELECT session_id FROM messages WHERE type = 'SYSTEM')
""")
def q_memory_delete_sessions(spark, sf_dir):
    """Delete a set of sessions (here: those with a system message) from a
    message table on disk; what is left is read back."""
    path = _stored(spark, sf_dir)
    gone = FX.messages(spark, sf_dir).where(F.col("type") == "SYSTEM").select("session_id")
    MS.delete_stored_sessions(spark, path, gone)
    return MS.read_messages(spark, path).select("session_id", "seq")


@register("system_message_fix", f"""
WITH {FX.AGENT_LOG_SQL},
f AS (SELECT session_id, min(seq) FILTER (WHERE type = 'SYSTEM') AS first_sys, min(seq) AS min_seq
      FROM agent_log GROUP BY session_id)
SELECT a.session_id, a.seq, a.type FROM agent_log a JOIN f USING (session_id)
WHERE a.type <> 'SYSTEM' OR a.seq = f.first_sys
UNION ALL
SELECT session_id, min_seq - 1, 'SYSTEM' FROM f WHERE first_sys IS NULL
""")
def q_system_message_fix(spark, sf_dir):
    """One system message per session, the first; a default one is added
    in front where none exists."""
    return M.fix_system_message(FX.agent_log(spark, sf_dir)).select("session_id", "seq", "type")


_SANITIZE_SQL = f"""
WITH {FX.AGENT_LOG_SQL},
ev AS (SELECT session_id, seq, tid, 0 AS kind FROM agent_log WHERE event_type = 'click'
       UNION ALL SELECT session_id, seq, tid, 1 FROM agent_log WHERE event_type = 'purchase'),
l AS (SELECT *, lag(kind) OVER (PARTITION BY session_id, tid ORDER BY seq, kind) AS prev FROM ev),
kept AS (SELECT session_id, seq, tid FROM l WHERE kind = 1 AND prev = 0),
ans AS (SELECT DISTINCT session_id, tid FROM kept),
bad AS (SELECT e.session_id, e.seq FROM ev e LEFT JOIN ans a USING (session_id, tid)
        WHERE e.kind = 0 AND a.tid IS NULL)
"""


@register("memory_sanitize", _SANITIZE_SQL + """
SELECT session_id, seq, type FROM agent_log
WHERE (type <> 'TOOL' AND (session_id, seq) NOT IN (SELECT (session_id, seq) FROM bad))
   OR (type = 'TOOL' AND (session_id, seq) IN (SELECT (session_id, seq) FROM kept))
""")
def q_memory_sanitize(spark, sf_dir):
    """W5/J-5: drop orphan tool results and unanswered tool requests."""
    return M.sanitize_tool_messages(FX.agent_log(spark, sf_dir)).select("session_id", "seq", "type")


@register("memory_sanitize_strict", f"""
WITH {FX.AGENT_LOG_SQL},
req AS (SELECT session_id, seq, tid FROM agent_log WHERE event_type = 'click'
        UNION ALL SELECT session_id, seq, 'q' || tid FROM agent_log WHERE event_type = 'click' AND seq % 2 = 0),
ev AS (SELECT session_id, seq, tid, 0 AS kind FROM req
       UNION ALL SELECT session_id, seq, tid, 1 FROM agent_log WHERE event_type = 'purchase'),
l AS (SELECT *, lag(kind) OVER (PARTITION BY session_id, tid ORDER BY seq, kind) AS prev FROM ev),
kept AS (SELECT session_id, seq, tid FROM l WHERE kind = 1 AND prev = 0),
ans AS (SELECT DISTINCT session_id, tid FROM kept),
bad AS (SELECT DISTINCT r.session_id, r.seq FROM req r LEFT JOIN ans a USING (session_id, tid) WHERE a.tid IS NULL),
gone AS (SELECT DISTINCT session_id, tid FROM req JOIN bad USING (session_id, seq)),
good AS (SELECT k.session_id, k.seq FROM kept k LEFT JOIN gone g USING (session_id, tid) WHERE g.tid IS NULL)
SELECT session_id, seq, type FROM agent_log
WHERE (type <> 'TOOL' AND (session_id, seq) NOT IN (SELECT (session_id, seq) FROM bad))
   OR (type = 'TOOL' AND (session_id, seq) IN (SELECT (session_id, seq) FROM good))
""")
def q_memory_sanitize_strict(spark, sf_dir):
    """W5 strict: messages that ask for two results of which one never comes are
    dropped, and with them the results that they got."""
    return M.sanitize_tool_messages(FX.double_log(spark, sf_dir), strict=True).select("session_id", "seq", "type")


@register("tool_request_text", f"""
WITH {FX.AGENT_LOG_SQL}
SELECT session_id, seq, CASE WHEN event_type = 'click' THEN 'Tool Execution Request' ELSE text END AS text
FROM agent_log
""")
def q_tool_request_text(spark, sf_dir):
    """AI tool-request messages without text get a fixed text."""
    return M.tool_request_text(FX.agent_log(spark, sf_dir)).select("session_id", "seq", "text")


@register("memory_overflow", f"""
WITH {FX.MESSAGES_SQL}
SELECT session_id, count(*) AS n_messages, count(*) >= {OVERFLOW_LIMIT} AS overflow
FROM messages GROUP BY session_id
""")
def q_memory_overflow(spark, sf_dir):
    """Sessions whose history reached the limit (6)."""
    return M.overflow(FX.messages(spark, sf_dir), OVERFLOW_LIMIT)


_TRANSCRIPT_SQL = f"""
WITH {FX.MESSAGES_SQL},
l AS (SELECT session_id, seq, CASE WHEN type = 'USER' THEN 'User: ' || coalesce(text, '') || chr(10)
                                   WHEN type = 'AI' AND text IS NOT NULL THEN 'Assistant: ' || text || chr(10) END AS line
      FROM messages),
t AS (SELECT session_id, string_agg(line, '' ORDER BY seq) AS transcript, count(*)::INTEGER AS n_lines
      FROM l WHERE line IS NOT NULL GROUP BY session_id)
"""


@register("transcript", _TRANSCRIPT_SQL + "SELECT session_id, transcript, n_lines FROM t")
def q_transcript(spark, sf_dir):
    """User/Assistant transcript of every session (one over
    ``TRANSCRIPT_BYTES`` has a row for each part)."""
    return M.transcript(FX.messages(spark, sf_dir)).select("session_id", "transcript", "n_lines")


@register("memory_rebuild", f"""
WITH {FX.MESSAGES_SQL},
l AS (SELECT session_id, seq, CASE WHEN type = 'USER' THEN 'User: ' || coalesce(text, '') || chr(10)
                                   WHEN type = 'AI' AND text IS NOT NULL THEN 'Assistant: ' || text || chr(10) END AS line
      FROM messages),
t AS (SELECT session_id, string_agg(line, '' ORDER BY seq) AS transcript FROM l WHERE line IS NOT NULL GROUP BY session_id),
s AS (SELECT session_id, arg_min(text, seq) AS text FROM messages WHERE type = 'SYSTEM' GROUP BY session_id)
SELECT session_id, 0::BIGINT AS seq, 'SYSTEM' AS type, text FROM s WHERE session_id IN (SELECT session_id FROM t)
UNION ALL
SELECT session_id, 1::BIGINT, 'USER', '{M.SUMMARY_PREFIX.replace(chr(10), "' || chr(10) || '")}' || transcript FROM t
""")
def q_memory_rebuild(spark, sf_dir):
    """Memory rebuilt as system message + summary message (the summary
    here is the transcript of the whole session)."""
    msgs = FX.messages(spark, sf_dir)
    tr = M.transcript(msgs).select("session_id", "part", F.col("transcript").alias("summary"))
    sys_msgs = (msgs.where(F.col("type") == "SYSTEM").groupBy("session_id")
                .agg(F.min_by("text", "seq").alias("text")).join(tr, "session_id", "left_semi"))
    return M.rebuild_with_summary(sys_msgs, tr)


MEMORY_LIMIT = 4


def memory_sql(fails: str = "false") -> str:
    """Memories after all messages, one message a step; the model fails where
    ``fails`` (over ``prompt``) holds."""
    body = "CASE WHEN mem[1].type = 'SYSTEM' THEN mem[2:] ELSE mem END"
    line = ("CASE WHEN x.type = 'USER' THEN 'User: ' || coalesce(x.text, '') || chr(10) "
            "WHEN x.type = 'AI' AND x.text IS NOT NULL THEN 'Assistant: ' || x.text || chr(10) ELSE '' END")
    summary = {"seq": "mem[-1].seq", "type": "'USER'", "text": f"{G.q(M.SUMMARY_PREFIX)} || {G.summary_of('answer')}"}
    return f"""
WITH RECURSIVE {FX.MESSAGES_SQL},
m AS (SELECT session_id, seq::BIGINT AS seq, type, text, row_number() OVER (PARTITION BY session_id ORDER BY seq) AS i FROM messages),
r AS (
  SELECT session_id, i, [{{'seq': seq, 'type': type, 'text': text}}] AS mem FROM m WHERE i = 1
  UNION ALL
  SELECT session_id, i, list_append(CASE
      WHEN len(mem) < {MEMORY_LIMIT} OR len(mem) <= 2 THEN mem
      WHEN {fails} THEN CASE WHEN mem[1].type = 'SYSTEM' THEN list_concat(mem[1:1], mem[3:]) ELSE mem[2:] END
      ELSE list_append(CASE WHEN mem[1].type = 'SYSTEM' THEN mem[1:1] ELSE mem[1:0] END,
                       {{'seq': {summary['seq']}, 'type': {summary['type']}, 'text': {summary['text']}}}) END,
      {{'seq': seq, 'type': type, 'text': text}}) AS mem
  FROM (SELECT *, {G.extractive_answer('prompt')} AS answer
        FROM (SELECT session_id, m.i AS i, m.seq AS seq, m.type AS type, m.text AS text, mem,
                     {G.q(M.SUMMARY_PROMPT)} || array_to_string(list_transform({body}, lambda x: {line}), '') AS prompt
              FROM r JOIN m USING (session_id) WHERE m.i = r.i + 1))),
f AS (SELECT session_id, mem FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY i DESC) AS rn FROM r) WHERE rn = 1)
SELECT session_id, mem[u.k].seq AS seq, mem[u.k].type AS type, mem[u.k].text AS text, (u.k - 1)::INTEGER AS pos
FROM f, unnest(range(1, len(mem) + 1)) AS u(k)
"""


@register("memory_summarize", memory_sql())
def q_memory_summarize(spark, sf_dir):
    """Memories after all messages; a full one (4 messages) is summarised
    when the next message comes, which is then added."""
    return continue_memories(FX.messages(spark, sf_dir), MEMORY_LIMIT, extractive_answer_factory)


@register("memory_summarize_failing", memory_sql("length(prompt) % 3 = 0"))
def q_memory_summarize_failing(spark, sf_dir):
    """M7: the same where the model raises for some prompts; those memories drop
    their oldest message instead, the others are summarised."""
    return continue_memories(FX.messages(spark, sf_dir), MEMORY_LIMIT, failing_answer_factory)


@register("summary_extract", """
WITH o AS (SELECT conv_id, turn,
             CASE WHEN role = 'assistant' THEN '<analysis>draft</analysis>' || chr(10) || '<summary>' || chr(10)
                  || text || chr(10) || '</summary>' WHEN role = 'user' THEN text ELSE '' END AS answer
           FROM conversations)
SELECT conv_id, turn,
  CASE WHEN answer IS NULL OR length(answer) = 0 THEN ''
       WHEN regexp_matches(answer, '(?s)<summary>\\s*(.+?)\\s*</summary>')
         THEN regexp_extract(answer, '(?s)<summary>\\s*(.+?)\\s*</summary>', 1)
       ELSE regexp_replace(answer, '^\\s+|\\s+$', '', 'g') END AS summary
FROM o
""")
def q_summary_extract(spark, sf_dir):
    """The <summary> part of model answers (answers shaped from turns)."""
    c = table(spark, sf_dir, "conversations")
    answer = (F.when(F.col("role") == "assistant",
                     F.concat(F.lit("<analysis>draft</analysis>\n<summary>\n"), F.col("text"),
                              F.lit("\n</summary>")))
              .when(F.col("role") == "user", F.col("text")).otherwise(F.lit("")))
    return c.select("conv_id", "turn", summary_extract(answer).alias("summary"))


@register("history_validate", """
SELECT conv_id::VARCHAR AS session_id, count(*) AS n_messages,
       bool_and(coalesce(role IN ('user', 'assistant') AND text IS NOT NULL, false)) AS valid,
       CASE WHEN NOT bool_and(coalesce(role IN ('user', 'assistant') AND text IS NOT NULL, false))
            THEN '701172' END AS error_code
FROM conversations GROUP BY conv_id
""")
def q_history_validate(spark, sf_dir):
    """A history is usable iff all roles are user/assistant with content."""
    c = table(spark, sf_dir, "conversations").withColumn("session_id", F.col("conv_id").cast("string"))
    return M.history_validate(c)


@register("list_trim", """
SELECT conv_id, turn, array_to_string(CASE WHEN len(w) > 5 THEN w[len(w) - 4:] ELSE w END, ' ') AS tail
FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)
""")
def q_list_trim(spark, sf_dir):
    """Trim an in-hand list (the words of each turn) to its last 5."""
    c = table(spark, sf_dir, "conversations")
    w = F.split("text", " ")
    return c.select("conv_id", "turn", F.array_join(M.trim_list(w, 5), " ").alias("tail"))


@register("session_default", """
SELECT event_id, CASE WHEN length(coalesce(s, '')) = 0 THEN 'default' ELSE s END AS session_id
FROM (SELECT event_id, CASE WHEN event_type = 'signup' THEN '' WHEN event_type = 'error' THEN NULL
                            ELSE user_id::VARCHAR END AS s FROM events)
""")
def q_session_default(spark, sf_dir):
    """Blank / NULL session ids become 'default'."""
    from tessera.functions.text import session_default
    e = table(spark, sf_dir, "events")
    s = (F.when(F.col("event_type") == "signup", F.lit("")).when(F.col("event_type") == "error", F.lit(None))
         .otherwise(F.col("user_id").cast("string")))
    return e.select("event_id", session_default(s).alias("session_id"))
