"""Stand-in inputs shaped from the driver's tables.

Each builder only renames / re-types columns of a test table into the schema
an operator expects (fixed mappings, no operator work).  All rows are mapped,
except where a row is of another kind than the schema holds: the tool tables
take the events of the types that stand for calls, results and tools.  The ``*_SQL`` strings build the same rows in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


# typed_docs: documents with mixed-case declared types (Spanish ones carry an
# unknown type) plus pages declared as HTML.
def typed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    p = table(spark, sf_dir, "pages")
    dtype = (F.when(F.col("lang") == "en", "markdown-to-text")
             .when(F.col("lang") == "fr", "Markdown-To-Text")
             .when(F.col("lang") == "de", "MARKDOWN-TO-TEXT")
             .otherwise("rtf-to-text"))
    return (d.select(F.lit("documents").alias("origin"), "doc_id", dtype.alias("type"),
                     F.col("text").alias("payload"))
            .unionByName(p.select(F.lit("pages").alias("origin"), F.col("page_id").alias("doc_id"),
                                  F.lit("HTML-to-text").alias("type"),
                                  F.col("html").alias("payload"))))


TYPED_DOCS_SQL = """
typed_docs AS (
  SELECT 'documents' AS origin, doc_id,
         CASE WHEN lang = 'en' THEN 'markdown-to-text' WHEN lang = 'fr' THEN 'Markdown-To-Text'
              WHEN lang = 'de' THEN 'MARKDOWN-TO-TEXT' ELSE 'rtf-to-text' END AS type,
         text AS payload FROM documents
  UNION ALL
  SELECT 'pages', page_id, 'HTML-to-text', html FROM pages)
"""


# segments_json: one request per document; the payload shape depends on the
# language: a JSON array with one segment (en), plain text (fr), an empty
# JSON array (de), or two segments of which the second has empty text (es).
def segments_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    one = F.to_json(F.array(F.struct(F.col("text"), F.create_map(F.lit("source"), F.col("source"))
                                     .alias("metadata"))))
    two = F.to_json(F.array(
        F.struct(F.col("text"), F.create_map(F.lit("lang"), F.col("lang")).alias("metadata")),
        F.struct(F.lit("").alias("text"), F.create_map().cast("map<string,string>").alias("metadata"))))
    payload = (F.when(F.col("lang") == "en", one).when(F.col("lang") == "fr", F.col("text"))
               .when(F.col("lang") == "de", F.lit("[]")).otherwise(two))
    return d.select(F.col("doc_id").alias("req_id"), payload.alias("input"))


SEGMENTS_JSON_SQL = """
segments_json AS (
  SELECT doc_id AS req_id,
    CASE WHEN lang = 'en' THEN to_json([{'text': text, 'metadata': MAP {'source': source}}])::VARCHAR
         WHEN lang = 'fr' THEN text
         WHEN lang = 'de' THEN '[]'
         ELSE to_json([{'text': text, 'metadata': MAP {'lang': lang}},
                       {'text': '', 'metadata': MAP {}::MAP(VARCHAR, VARCHAR)}])::VARCHAR END AS input
  FROM documents)
"""


# embeddings_json: one request per stored vector; by label: a single object
# (0), an array holding the vector and an empty one (1), a vector of the
# wrong dimension (2: only its first half is serialised), broken JSON (3),
# otherwise an array with one object.
def embeddings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    obj = F.struct(F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"),
                   F.col("embedding"),
                   F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"))
    empty = F.struct(F.lit("empty").alias("text"), F.array().cast("array<float>").alias("embedding"),
                     F.create_map().cast("map<string,string>").alias("metadata"))
    half = obj.withField("embedding", F.slice("embedding", 1, F.size("embedding") / 2))
    payload = (F.when(F.col("label") == 0, F.to_json(obj))
               .when(F.col("label") == 1, F.to_json(F.array(obj, empty)))
               .when(F.col("label") == 2, F.to_json(F.array(half)))
               .when(F.col("label") == 3, F.concat(F.lit("[{\"text\": \"vector "),
                                                   F.col("vec_id").cast("string"), F.lit("\"")))
               .otherwise(F.to_json(F.array(obj))))
    return e.select(F.col("vec_id").alias("req_id"), payload.alias("input"))


EMBEDDINGS_JSON_SQL = """
embeddings_json AS (
  SELECT vec_id AS req_id,
    CASE WHEN label = 0 THEN to_json({'text': 'vector ' || vec_id, 'embedding': embedding,
                                      'metadata': MAP {'label': label::VARCHAR}})::VARCHAR
         WHEN label = 1 THEN to_json([{'text': 'vector ' || vec_id, 'embedding': embedding,
                                       'metadata': MAP {'label': label::VARCHAR}},
                                      {'text': 'empty', 'embedding': []::FLOAT[],
                                       'metadata': MAP {}::MAP(VARCHAR, VARCHAR)}])::VARCHAR
         WHEN label = 2 THEN to_json([{'text': 'vector ' || vec_id,
                                       'embedding': embedding[1:len(embedding) // 2],
                                       'metadata': MAP {'label': label::VARCHAR}}])::VARCHAR
         WHEN label = 3 THEN '[{"text": "vector ' || vec_id || '"'
         ELSE to_json([{'text': 'vector ' || vec_id, 'embedding': embedding,
                        'metadata': MAP {'label': label::VARCHAR}}])::VARCHAR END AS input
  FROM embeddings)
"""


# messages: one row per conversation turn.
def messages(spark: SparkSession, sf_dir: str, conversations: DataFrame | None = None) -> DataFrame:
    from tessera.operators.memory import role_type
    c = conversations if conversations is not None else table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").alias("seq"),
                    role_type("role").alias("type"), "text",
                    F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>")
                    .alias("tool_requests"),
                    F.lit(None).cast("string").alias("tool_result_id"))


MESSAGES_SQL = """
messages AS (
  SELECT conv_id::VARCHAR AS session_id, turn AS seq,
         CASE lower(role) WHEN 'system' THEN 'SYSTEM' WHEN 'user' THEN 'USER'
              WHEN 'assistant' THEN 'AI' WHEN 'tool' THEN 'TOOL' END AS type, text
  FROM conversations)
"""


# agent_log: every event as a message of its user's session (seq = event id):
# signup -> SYSTEM, view -> USER, click -> AI tool request for id k<k> with no
# text, purchase -> TOOL result for id k<k>, error -> AI text answer.
def agent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    tid = F.concat(F.lit("k"), F.get_json_object("props", "$.k"))
    typ = (F.when(F.col("event_type") == "signup", "SYSTEM").when(F.col("event_type") == "view", "USER")
           .when(F.col("event_type").isin("click", "error"), "AI").otherwise("TOOL"))
    text = (F.when(F.col("event_type") == "click", F.lit(None).cast("string"))
            .when(F.col("event_type") == "purchase",
                  F.concat(F.lit("result "), F.col("value").cast("string")))
            .otherwise(F.col("props")))
    reqs = F.when(F.col("event_type") == "click", F.array(F.struct(
        tid.alias("id"), F.lit("lookup").alias("name"), F.col("props").alias("arguments"))))
    return e.select(F.col("user_id").cast("string").alias("session_id"), F.col("event_id").alias("seq"),
                    typ.alias("type"), text.alias("text"), reqs.alias("tool_requests"),
                    F.when(F.col("event_type") == "purchase", tid).alias("tool_result_id"))


AGENT_LOG_SQL = """
agent_log AS (
  SELECT user_id::VARCHAR AS session_id, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN 'SYSTEM' WHEN event_type = 'view' THEN 'USER'
              WHEN event_type IN ('click', 'error') THEN 'AI' ELSE 'TOOL' END AS type,
         CASE WHEN event_type = 'click' THEN NULL
              WHEN event_type = 'purchase' THEN 'result ' || value::VARCHAR ELSE props END AS text,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'k' || json_extract_string(props, '$.k') END AS tid,
         event_type
  FROM events)
"""


# double_log: the agent log in which every request message with an even seq asks
# for a second result, q<k>, which never comes.
def double_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = agent_log(spark, sf_dir)
    second = F.transform("tool_requests", lambda r: r.withField("id", F.concat(F.lit("q"), r["id"])))
    return log.withColumn("tool_requests", F.when(F.col("seq") % 2 == 0, F.concat("tool_requests", second)).otherwise(F.col("tool_requests")))


# tool_calls: click and view events as calls of tools "search" / "browse";
# request id k<k>; views carry a trailing comma in their JSON arguments.
def tool_calls(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = events if events is not None else table(spark, sf_dir, "events")
    e = e.where(F.col("event_type").isin("click", "view"))
    return e.select(F.col("user_id").cast("string").alias("session_id"),
                    F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("request_id"),
                    F.when(F.col("event_type") == "click", "search").otherwise("browse").alias("name"),
                    F.when(F.col("event_type") == "view", F.replace("props", F.lit("}"), F.lit(",}")))
                    .otherwise(F.col("props")).alias("arguments"),
                    F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"))


TOOL_CALLS_SQL = """
tool_calls AS (
  SELECT user_id::VARCHAR AS session_id, 'k' || json_extract_string(props, '$.k') AS request_id,
         CASE WHEN event_type = 'click' THEN 'search' ELSE 'browse' END AS name,
         CASE WHEN event_type = 'view' THEN replace(props, '}', ',}') ELSE props END AS arguments,
         ts, event_id AS seq
  FROM events WHERE event_type IN ('click', 'view'))
"""


# tool_results: purchase events as results for request id k<k>; small
# values give a blank result.
def tool_results(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = events if events is not None else table(spark, sf_dir, "events")
    e = e.where(F.col("event_type") == "purchase")
    return e.select(F.col("user_id").cast("string").alias("session_id"),
                    F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("request_id"),
                    F.when(F.col("value") < 5, F.lit(" "))
                    .otherwise(F.concat(F.lit("paid "), F.col("value").cast("string"))).alias("result"),
                    F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"))


TOOL_RESULTS_SQL = """
tool_results AS (
  SELECT user_id::VARCHAR AS session_id, 'k' || json_extract_string(props, '$.k') AS request_id,
         CASE WHEN value < 5 THEN ' ' ELSE 'paid ' || value::VARCHAR END AS result, ts, event_id AS seq
  FROM events WHERE event_type = 'purchase')
"""


# tool_catalog: one tool per event type except "view"; the signup tool has
# a blank description and names carry whitespace.
def tool_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type").distinct().where(F.col("event_type") != "view")
    name = (F.when(F.col("event_type") == "click", "search").when(F.col("event_type") == "signup", "sign up")
            .when(F.col("event_type") == "error", "report\terror").otherwise("buy now"))
    desc = F.when(F.col("event_type") == "signup", F.lit("  ")).otherwise(F.concat(F.lit("Tool for "),
                                                                                  F.col("event_type")))
    return e.select(name.alias("name"), desc.alias("description"))


TOOL_CATALOG_SQL = """
tool_catalog AS (
  SELECT CASE event_type WHEN 'click' THEN 'search' WHEN 'signup' THEN 'sign up'
              WHEN 'error' THEN 'report' || chr(9) || 'error' ELSE 'buy now' END AS name,
         CASE WHEN event_type = 'signup' THEN '  ' ELSE 'Tool for ' || event_type END AS description
  FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'))
"""


# model_calls: every conversation turn is a model call of request conv_id;
# user turns count as input tokens, assistant turns as output tokens (words).
def model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.functions.text import word_count
    c = table(spark, sf_dir, "conversations")
    wc = word_count("text").cast("bigint")
    return c.select(F.col("conv_id").alias("request_id"), F.col("turn").alias("call_no"),
                    F.when(F.col("role") == "user", wc).otherwise(F.lit(0).cast("bigint")).alias("input_tokens"),
                    F.when(F.col("role") == "assistant", wc).otherwise(F.lit(0).cast("bigint"))
                    .alias("output_tokens"))


MODEL_CALLS_SQL = """
model_calls AS (
  SELECT conv_id AS request_id, turn AS call_no,
         CASE WHEN role = 'user' THEN (CASE WHEN length(trim(text)) = 0 THEN 0 ELSE len(string_split(trim(text), ' ')) END) ELSE 0 END::BIGINT AS input_tokens,
         CASE WHEN role = 'assistant' THEN (CASE WHEN length(trim(text)) = 0 THEN 0 ELSE len(string_split(trim(text), ' ')) END) ELSE 0 END::BIGINT AS output_tokens
  FROM conversations)
"""


# store_meta: documents with their metadata map (quality only where the
# document is labelled, so that key is sometimes missing).
def store_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    m = F.map_filter(F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"),
                                  F.lit("n_chars"), F.col("n_chars").cast("string"),
                                  F.lit("quality"), F.col("quality").cast("string")),
                     lambda k, v: v.isNotNull())
    return d.join(lab, "doc_id", "left").select("doc_id", m.alias("metadata"))


STORE_META_SQL = """
store_meta AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars::VARCHAR AS n_chars, l.quality::VARCHAR AS quality
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""


# attachments: one chat request per document; the attachment JSON shape
# depends on the language (object / array with an untyped entry / array with
# an unsupported and a mixed-case text type / none).  German requests carry
# an empty prompt.
def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")

    def att(t, c):
        return F.struct(F.lit(t).alias("type"), c.alias("content"))
    untyped = F.struct(F.lit("no type").alias("content"))
    js = (F.when(F.col("lang") == "en", F.to_json(att("text/plain", F.col("source"))))
          .when(F.col("lang") == "fr", F.concat(F.lit("["), F.to_json(att("image/png", F.col("source"))),
                                                F.lit(","), F.to_json(untyped), F.lit("]")))
          .when(F.col("lang") == "de", F.to_json(F.array(att("application/zip", F.col("source")),
                                                         att("TEXT/markdown", F.col("lang"))))))
    prompt = F.when(F.col("lang") == "de", F.lit("")).otherwise(
        F.concat(F.lit("Summarise document "), F.col("doc_id").cast("string")))
    return d.select(F.col("doc_id").alias("req_id"), prompt.alias("prompt"), js.alias("attachments"))


ATTACHMENTS_SQL = """
attachments AS (
  SELECT doc_id AS req_id,
         CASE WHEN lang = 'de' THEN '' ELSE 'Summarise document ' || doc_id END AS prompt,
         CASE WHEN lang = 'en' THEN to_json({'type': 'text/plain', 'content': source})::VARCHAR
              WHEN lang = 'fr' THEN '[' || to_json({'type': 'image/png', 'content': source})::VARCHAR || ','
                                    || to_json({'content': 'no type'})::VARCHAR || ']'
              WHEN lang = 'de' THEN to_json([{'type': 'application/zip', 'content': source},
                                             {'type': 'TEXT/markdown', 'content': lang}])::VARCHAR END AS attachments
  FROM documents)
"""
