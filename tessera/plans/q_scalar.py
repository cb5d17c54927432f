"""Registered queries: filters, prompts, message parts, coercion, responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import prompt as P
from tessera.functions.filters import compile_filter
from tessera.functions.text import flatten_metadata
from tessera.operators.infer import coerce_output
from tessera.plans import fixtures as FX
from tessera.plans.registry import register
from tessera.sources.tables import table

# name -> (filter text, DuckDB predicate over store_meta)
FILTERS = {
    "filter_eq": ('metadataKey("lang").isEqualTo("fr")', "coalesce(lang = 'fr', false)"),
    "filter_ne": ('metadataKey("quality").isNotEqualTo(1)',
                  "coalesce(NOT (quality = '1'), true)"),
    "filter_gt": ('metadataKey("n_chars").isGreaterThan(2000)', "coalesce(TRY_CAST(n_chars AS DOUBLE) > 2000, false)"),
    "filter_ge": ('metadataKey("n_chars").isGreaterThanOrEqualTo("1000")',
                  "coalesce(TRY_CAST(n_chars AS DOUBLE) >= 1000, false)"),
    "filter_lt": ('metadataKey("n_chars").isLessThan(500)', "coalesce(TRY_CAST(n_chars AS DOUBLE) < 500, false)"),
    "filter_le": ('metadataKey("source").isLessThanOrEqualTo("src3")', "coalesce(source <= 'src3', false)"),
    "filter_in": ('metadataKey("lang").isIn("de", "es")', "coalesce(lang IN ('de', 'es'), false)"),
    "filter_not_in": ('metadataKey("quality").isNotIn("0")', "coalesce(NOT (quality IN ('0')), true)"),
    "filter_and": ('and(metadataKey("lang").isEqualTo("en"), metadataKey("quality").isEqualTo(1), '
                   'metadataKey("n_chars").isLessThan(3000))',
                   "coalesce(lang = 'en', false) AND coalesce(quality = '1', false) "
                   "AND coalesce(TRY_CAST(n_chars AS DOUBLE) < 3000, false)"),
    "filter_or": ('or(metadataKey("lang").isEqualTo("de"), metadataKey("source").isIn("src1", "src2"))',
                  "coalesce(lang = 'de', false) OR coalesce(source IN ('src1', 'src2'), false)"),
    "filter_not": ('not(metadataKey("quality").isEqualTo("1"))',
                   "NOT coalesce(quality = '1', false)"),
    "filter_empty": ("", "true"),
}


def _filter_query(name, text):
    def q(spark, sf_dir):
        return FX.store_meta(spark, sf_dir).where(compile_filter(text)).select("doc_id")
    q.__doc__ = f"F1-F12: store rows matching {text or '(no filter)'}."
    return q


for _name, (_text, _sql) in FILTERS.items():
    register(_name, f"WITH {FX.STORE_META_SQL} SELECT doc_id FROM store_meta WHERE {_sql}")(
        _filter_query(_name, _text))


# Numbers near 2 ** 53, where doubles run together, and texts that only look like
# numbers: by document, n = 9007199254740000 + doc_id and code = "<x>.0", "1_<x>" or "<x>".
_EXACT = {
    "filter_exact_eq": ('metadataKey("n").isEqualTo("9007199254740993")', "n = '9007199254740993'"),
    "filter_exact_gt": ('metadataKey("n").isGreaterThan("9007199254740100")', "n::DECIMAL(38,0) > 9007199254740100"),
    "filter_number_text": ('or(metadataKey("code").isEqualTo("1"), metadataKey("code").isGreaterThan("1_5"), metadataKey("code").isLessThan("-0.5"))',
                           "code = '1' OR code > '1_5' OR (CASE WHEN doc_id % 3 <> 1 THEN code::DECIMAL(38,6) < -0.5 ELSE code < '-0.5' END)"),
}


def _exact_query(name, text):
    def q(spark, sf_dir):
        i = F.col("doc_id")
        x = (i % 11 - 2).cast("string")
        code = F.when(i % 3 == 0, F.concat(x, F.lit(".0"))).when(i % 3 == 1, F.concat(F.lit("1_"), x)).otherwise(x)
        meta = F.create_map(F.lit("n"), (i + 9007199254740000).cast("string"), F.lit("code"), code)
        docs = table(spark, sf_dir, "documents").select("doc_id", meta.alias("metadata"))
        return docs.where(compile_filter(text)).select("doc_id")
    q.__doc__ = f"F1, F3-F6: exact numbers and texts that look like numbers: {text}."
    return q


for _name, (_text, _sql) in _EXACT.items():
    register(_name, f"""
WITH d AS (SELECT doc_id, (9007199254740000 + doc_id)::VARCHAR AS n, (doc_id % 11 - 2)::VARCHAR AS x FROM documents),
e AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN x || '.0' WHEN 1 THEN '1_' || x ELSE x END AS code FROM d)
SELECT doc_id FROM e WHERE {_sql}""")(_exact_query(_name, _text))


PROMPT_TEMPLATE = 'Question ${item_id}: ${text}\nContext: ${exists(context) ? context : "none"}'


@register("prompt_render", """
SELECT item_id, 'Question ' || item_id || ': ' || text || chr(10) || 'Context: none' AS prompt FROM benchmark
""")
def q_prompt_render(spark, sf_dir):
    """Template with placeholders and a guarded (missing) one."""
    b = table(spark, sf_dir, "benchmark")
    return P.render_prompts(b, PROMPT_TEMPLATE).select("item_id", "prompt")


@register("system_prompt", """
WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN text END AS r,
                  CASE WHEN role = 'user' AND length(text) > 100 THEN text END AS i
           FROM conversations)
SELECT conv_id, turn, CASE WHEN coalesce(length(r) > 0, false) OR coalesce(length(i) > 0, false)
  THEN (CASE WHEN coalesce(length(r) > 0, false) THEN '# Role' || chr(10) || r || chr(10) || chr(10) ELSE '' END)
    || (CASE WHEN coalesce(length(i) > 0, false) THEN '## Instructions' || chr(10) || i ELSE '' END)
  ELSE 'You are a helpful assistant.' END AS system_prompt
FROM c
""")
def q_system_prompt(spark, sf_dir):
    """System prompt from a role and instructions (by turn: system text as
    role, a long user text as instructions)."""
    c = table(spark, sf_dir, "conversations")
    role = F.when(F.col("role") == "system", F.col("text"))
    instr = F.when((F.col("role") == "user") & (F.length("text") > 100), F.col("text"))
    return c.select("conv_id", "turn", P.system_prompt(role, instr).alias("system_prompt"))


_PARTS_SQL = f"""
WITH {FX.ATTACHMENTS_SQL},
a AS (SELECT req_id, prompt, CASE WHEN ltrim(attachments) LIKE '[%'
               THEN from_json(attachments, '[{{"type":"VARCHAR","content":"VARCHAR"}}]')
               WHEN attachments IS NOT NULL THEN [from_json(attachments, '{{"type":"VARCHAR","content":"VARCHAR"}}')] END AS arr
      FROM attachments),
e AS (SELECT req_id, u.i AS i, arr[u.i] AS x FROM a, unnest(range(1, coalesce(len(arr), 0) + 1)) AS u(i)),
parts AS (SELECT req_id, i, CASE WHEN lower(x.type) LIKE 'text/%' THEN 'TEXT' ELSE 'IMAGE' END AS kind,
                 x.content AS text, CASE WHEN lower(x.type) LIKE 'image/%' THEN x.type END AS mime
          FROM e WHERE x.type IS NOT NULL AND (lower(x.type) LIKE 'text/%' OR lower(x.type) LIKE 'image/%'))
"""


@register("attachment_route", _PARTS_SQL + """
SELECT req_id, (row_number() OVER (PARTITION BY req_id ORDER BY i) - 1)::INTEGER AS pos, kind, text, mime FROM parts
""")
def q_attachment_route(spark, sf_dir):
    """Attachments routed by MIME type (text/*, image/*; others dropped)."""
    a = FX.attachments(spark, sf_dir)
    return a.select("req_id", F.posexplode(P.attachment_parts("attachments")).alias("pos", "p")).select(
        "req_id", "pos", "p.kind", "p.text", "p.mime")


@register("user_message_parts", _PARTS_SQL + """
, allp AS (SELECT req_id, 0 AS i, 'TEXT' AS kind, prompt AS text, NULL AS mime FROM a WHERE length(prompt) > 0
           UNION ALL SELECT * FROM parts)
SELECT req_id, (row_number() OVER (PARTITION BY req_id ORDER BY i) - 1)::INTEGER AS pos, kind, text, mime FROM allp
""")
def q_user_message_parts(spark, sf_dir):
    """User message = non-empty prompt + attachment parts."""
    a = FX.attachments(spark, sf_dir)
    return a.select("req_id", F.posexplode(P.user_message_parts("prompt", "attachments")).alias("pos", "p")).select(
        "req_id", "pos", "p.kind", "p.text", "p.mime")


@register("metadata_flatten", f"""
WITH {FX.STORE_META_SQL},
kv AS (SELECT doc_id, 'lang' AS k, lang AS v FROM store_meta UNION ALL SELECT doc_id, 'source', source FROM store_meta
       UNION ALL SELECT doc_id, 'n_chars', n_chars FROM store_meta UNION ALL SELECT doc_id, 'quality', quality FROM store_meta)
SELECT doc_id, 'meta_' || k AS key, coalesce(v, '') AS value FROM kv
""")
def q_metadata_flatten(spark, sf_dir):
    """Metadata keys prefixed with meta_, NULL values as ''."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    m = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"),
                     F.lit("n_chars"), F.col("n_chars").cast("string"),
                     F.lit("quality"), F.col("quality").cast("string"))
    return d.join(lab, "doc_id", "left").select("doc_id", F.explode(flatten_metadata(m)).alias("key", "value"))


@register("output_coerce", """
WITH o AS (SELECT event_id,
             CASE event_type WHEN 'click' THEN 'integer' WHEN 'view' THEN 'float' WHEN 'purchase' THEN 'boolean'
                             WHEN 'signup' THEN 'string' ELSE 'json' END AS output_type,
             CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k') WHEN 'view' THEN value::VARCHAR
                             WHEN 'purchase' THEN (CASE WHEN value > 20 THEN ' True ' ELSE 'no' END)
                             ELSE props END AS answer FROM events)
SELECT event_id, output_type,
  CASE WHEN output_type = 'integer' AND regexp_matches(trim(answer), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(answer) AS INTEGER) END AS int_value,
  CASE WHEN output_type = 'float' THEN TRY_CAST(trim(answer) AS FLOAT) END AS float_value,
  CASE WHEN output_type = 'boolean' THEN lower(trim(answer)) = 'true' END AS bool_value,
  CASE WHEN output_type = 'string' THEN answer END AS str_value,
  CASE WHEN output_type NOT IN ('string', 'integer', 'float', 'boolean') THEN '701173' END AS error_code
FROM o
""")
def q_output_coerce(spark, sf_dir):
    """Model answers coerced to the requested output type."""
    e = table(spark, sf_dir, "events")
    ty = (F.when(F.col("event_type") == "click", "integer").when(F.col("event_type") == "view", "float")
          .when(F.col("event_type") == "purchase", "boolean").when(F.col("event_type") == "signup", "string")
          .otherwise("json"))
    ans = (F.when(F.col("event_type") == "click", F.get_json_object("props", "$.k"))
           .when(F.col("event_type") == "view", F.col("value").cast("string"))
           .when(F.col("event_type") == "purchase", F.when(F.col("value") > 20, F.lit(" True ")).otherwise(F.lit("no")))
           .otherwise(F.col("props")))
    o = e.select("event_id", ty.alias("output_type"), ans.alias("answer"))
    cols = coerce_output("answer", "output_type")
    return o.select("event_id", "output_type", *[c.alias(n) for n, c in cols.items()])


@register("response_struct", f"""
WITH {FX.MODEL_CALLS_SQL}
SELECT request_id, call_no, to_json({{'content': 'call ' || call_no,
  'tokenUsage': {{'inputTokenCount': input_tokens, 'outputTokenCount': output_tokens,
                 'totalTokenCount': input_tokens + output_tokens}},
  'finishReason': 'STOP', 'toolExecutions': []}})::VARCHAR AS response
FROM model_calls
""")
def q_response_struct(spark, sf_dir):
    """P20: response object with fixed field order, serialised as JSON."""
    m = FX.model_calls(spark, sf_dir)
    r = P.response_struct(F.concat(F.lit("call "), F.col("call_no").cast("string")), "input_tokens",
                          "output_tokens")
    return m.select("request_id", "call_no", F.to_json(r).alias("response"))
