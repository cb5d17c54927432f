"""Registered queries: splitting, decoding, validation, embedding, ingest,
store round-trips and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import content_uuid
from tessera.operators import validate as VAL
from tessera.operators.embed import hash_embed, token_buckets
from tessera.operators.ingest import dedup_first, drop_existing
from tessera.operators.split import split_documents, split_window
from tessera.plans import fixtures as FX
from tessera.plans import sqlgen as G
from tessera.plans.knowledge import (DEFAULT_DIM, get_from_knowledge, ingest_summary,
                                     knowledge_rows, rag_context)
from tessera.operators.util import spread
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources.tables import table
from tessera.sources.vector_store import (load_snapshot, save_snapshot, scratch_path,
                                          store_append, store_scan)

RAG_K = 5
RAG_MIN_SCORE = 0.75


def _docs(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("split_recursive", G.split_sql("Recursive", 1000, 200))
def q_split_recursive(spark, sf_dir):
    """Recursive split (paragraph, line, sentence, word, cut), 1000/200."""
    return split_documents(_docs(spark, sf_dir), "Recursive", 1000, 200)


@register("split_paragraph", G.split_sql("ByParagraph", 1000, 200))
def q_split_paragraph(spark, sf_dir):
    """G1: paragraph split (then sentence, word, cut), 1000/200."""
    return split_documents(_docs(spark, sf_dir), "ByParagraph", 1000, 200)


@register("split_sentence", G.split_sql("BySentence", 1000, 200))
def q_split_sentence(spark, sf_dir):
    """Sentence split (then word, cut), 1000/200."""
    return split_documents(_docs(spark, sf_dir), "BySentence", 1000, 200)


@register("split_window", """
SELECT doc_id, u.i::INTEGER AS index, substr(text, u.i * 800 + 1, 1000) AS text
FROM documents, unnest(range(0, (greatest(length(text) - 200 - 1, 0) // 800) + 1)) AS u(i)
WHERE length(text) > 0
""")
def q_split_window(spark, sf_dir):
    """Fixed 1000-character windows advancing by 800."""
    return split_window(_docs(spark, sf_dir), 1000, 200)


_SEG_TYPE = '[{"text":"VARCHAR","metadata":"MAP(VARCHAR, VARCHAR)"}]'
_META_SQL = ("array_to_string(list_sort(list_transform(map_entries({m}), "
             "lambda e: e.key || '=' || e.value)), ';')")


def _meta(col):
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(col), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


_SEGMENTS_DECODED_SQL = f"""
WITH {FX.SEGMENTS_JSON_SQL},
d AS (SELECT req_id, input,
        CASE WHEN json_valid(input) AND json_type(input) = 'ARRAY'
             THEN from_json(input, '{_SEG_TYPE}') END AS arr FROM segments_json),
e AS (SELECT req_id, CASE WHEN coalesce(len(arr), 0) > 0 THEN arr
        ELSE [{{'text': input, 'metadata': MAP {{}}::MAP(VARCHAR, VARCHAR)}}] END AS segs FROM d),
x AS (SELECT req_id, (u.i - 1)::INTEGER AS pos, segs[u.i].text AS text, segs[u.i].metadata AS m
      FROM e, unnest(range(1, len(segs) + 1)) AS u(i))
"""


def _segments_decoded(spark, sf_dir):
    sj = FX.segments_json(spark, sf_dir)
    return sj.select("req_id", F.posexplode(VAL.decode_segments("input")).alias("pos", "seg"))


@register("segments_decode", _SEGMENTS_DECODED_SQL + f"""
SELECT req_id, len(list(pos))::INTEGER AS n_segments FROM x GROUP BY req_id
""")
def q_segments_decode(spark, sf_dir):
    """P10: JSON segment arrays; plain text / [] become one segment."""
    sj = FX.segments_json(spark, sf_dir)
    return sj.select("req_id", F.size(VAL.decode_segments("input")).alias("n_segments"))


@register("segments_explode", _SEGMENTS_DECODED_SQL + f"""
SELECT req_id, pos, text, {_META_SQL.format(m='m')} AS meta FROM x
""")
def q_segments_explode(spark, sf_dir):
    """Decoded segments exploded to rows with their position."""
    return _segments_decoded(spark, sf_dir).select(
        "req_id", "pos", F.col("seg.text").alias("text"), _meta(F.col("seg.metadata")).alias("meta"))


@register("validate_segments", _SEGMENTS_DECODED_SQL + """
SELECT req_id, pos, CASE WHEN text IS NULL OR length(text) = 0 THEN '701162' END AS error_code FROM x
""")
def q_validate_segments(spark, sf_dir):
    """segments with NULL / empty text are quarantined (701162)."""
    return _segments_decoded(spark, sf_dir).select(
        "req_id", "pos", VAL.segment_error(F.col("seg.text")).alias("error_code"))


_EMB_TYPE = '{"text":"VARCHAR","embedding":"FLOAT[]","metadata":"MAP(VARCHAR, VARCHAR)"}'
_EMBEDDINGS_DECODED_SQL = f"""
WITH {FX.EMBEDDINGS_JSON_SQL},
d AS (SELECT req_id, input, json_valid(input) AS ok, ltrim(input) LIKE '[%' AS is_arr FROM embeddings_json),
p AS (SELECT req_id,
        CASE WHEN ok AND is_arr THEN from_json(input, '[{_EMB_TYPE}]')
             WHEN ok THEN [from_json(input, '{_EMB_TYPE}')] END AS arr FROM d),
x AS (SELECT req_id, (u.i - 1)::INTEGER AS pos, arr[u.i].text AS text, arr[u.i].embedding AS embedding
      FROM p, unnest(CASE WHEN coalesce(len(arr), 0) > 0 THEN range(1, len(arr) + 1) ELSE [NULL] END) AS u(i))
"""


def _embeddings_decoded(spark, sf_dir):
    ej = FX.embeddings_json(spark, sf_dir)
    return ej.select("req_id", F.posexplode_outer(VAL.decode_embeddings("input")).alias("pos", "e"))


@register("embeddings_decode", _EMBEDDINGS_DECODED_SQL + """
SELECT req_id, pos, text, len(embedding)::INTEGER AS dim FROM x
""")
def q_embeddings_decode(spark, sf_dir):
    """JSON array of embeddings or a single object."""
    return _embeddings_decoded(spark, sf_dir).select(
        "req_id", "pos", F.col("e.text").alias("text"),
        F.when(F.col("e.embedding").isNotNull(), F.size("e.embedding")).alias("dim"))


@register("validate_embeddings", _EMBEDDINGS_DECODED_SQL + """
SELECT req_id, pos, CASE WHEN text IS NULL OR length(text) = 0 OR embedding IS NULL
  OR len(embedding) = 0 THEN '701111' END AS error_code FROM x
""")
def q_validate_embeddings(spark, sf_dir):
    """text and vector must be non-empty (701111)."""
    return _embeddings_decoded(spark, sf_dir).select(
        "req_id", "pos", VAL.embedding_error(F.col("e.text"), F.col("e.embedding")).alias("error_code"))


@register("validate_dimension", _EMBEDDINGS_DECODED_SQL + """
SELECT req_id, pos, CASE WHEN text IS NULL OR length(text) = 0 OR embedding IS NULL
  OR len(embedding) = 0 OR len(embedding) <> 64 THEN '701111' END AS error_code FROM x
""")
def q_validate_dimension(spark, sf_dir):
    """F16: vectors must have the store's dimension (64 here)."""
    return _embeddings_decoded(spark, sf_dir).select(
        "req_id", "pos",
        VAL.embedding_error(F.col("e.text"), F.col("e.embedding"), 64).alias("error_code"))


@register("query_vector_decode", """
WITH q AS (SELECT vec_id, CASE WHEN label = 3 THEN '[]' WHEN label = 4 THEN NULL
                               ELSE to_json(embedding)::VARCHAR END AS input FROM embeddings),
v AS (SELECT vec_id, CASE WHEN json_valid(input) THEN from_json(input, '["FLOAT"]') END AS v FROM q)
SELECT vec_id, CASE WHEN coalesce(len(v), 0) > 0 THEN len(v) END::INTEGER AS dim,
       CASE WHEN coalesce(len(v), 0) = 0 THEN '701121' END AS error_code FROM v
""")
def q_query_vector_decode(spark, sf_dir):
    """Query vector from JSON; empty / NULL -> 701121."""
    e = table(spark, sf_dir, "embeddings")
    inp = (F.when(F.col("label") == 3, F.lit("[]")).when(F.col("label") == 4, F.lit(None))
           .otherwise(F.to_json("embedding")))
    v = VAL.decode_query_vector(inp)
    return e.select("vec_id", F.size(v).alias("dim"),
                    F.when(v.isNull(), F.lit("701121")).alias("error_code")).withColumn(
        "dim", F.when(F.col("dim") > 0, F.col("dim")))


_TOKENS_SQL = r"""
toks AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS tok FROM documents),
counts AS (SELECT doc_id, (('0x' || substr(md5(tok), 1, 8))::BIGINT % 256)::INTEGER AS bucket,
                  count(*) AS cnt FROM toks WHERE length(tok) > 0 GROUP BY ALL)
"""


@register("hash_embed", f"WITH {_TOKENS_SQL} SELECT doc_id, bucket, cnt FROM counts")
def q_hash_embed(spark, sf_dir):
    """M1: token -> bucket assignment of the hashing embedder (dim 256), as
    sparse counts per document."""
    d = _docs(spark, sf_dir)
    return (d.select("doc_id", F.explode(token_buckets("text", DEFAULT_DIM)).alias("bucket"))
            .groupBy("doc_id", "bucket").agg(F.count(F.lit(1)).alias("cnt")))


@register("hash_embed_dense", f"""
WITH {_TOKENS_SQL},
m AS (SELECT *, max(cnt) OVER (PARTITION BY doc_id) AS mx FROM counts)
SELECT doc_id, len(list(bucket))::INTEGER AS nnz, min(bucket) FILTER (WHERE cnt = mx)::INTEGER AS top_bucket,
       256 AS dim
FROM m GROUP BY doc_id
""")
def q_hash_embed_dense(spark, sf_dir):
    """M1: dense L2-normalised vectors; non-zero count and arg-max bucket."""
    e = hash_embed(_docs(spark, sf_dir), DEFAULT_DIM).where(F.col("embedding").isNotNull())
    v = F.col("embedding")
    return e.select("doc_id", F.size(F.filter(v, lambda x: x > 0)).alias("nnz"),
                    (F.array_position(v, F.array_max(v)) - 1).cast("int").alias("top_bucket"),
                    F.size(v).alias("dim"))


@register("ingest_dedup", f"""
WITH c AS (SELECT {G.uuid3('text')} AS id, doc_id, lang FROM documents),
k AS (SELECT id, min(doc_id) AS doc_id FROM c GROUP BY id)
SELECT id, doc_id FROM k WHERE id NOT IN (SELECT id FROM c WHERE lang = 'en')
""")
def q_ingest_dedup(spark, sf_dir):
    """J-2: content ids, first copy (lowest doc_id) wins, and ids already in
    the store (here: a store holding the English documents) are skipped."""
    d = table(spark, sf_dir, "documents")
    rows = d.select(content_uuid("text").alias("id"), "doc_id", F.lit(0).alias("index"))
    existing = d.where(F.col("lang") == "en").select(content_uuid("text").alias("id"))
    kept, _ = dedup_first(rows, ["doc_id", "index"])
    new, _ = drop_existing(kept, existing)
    return new.select("id", "doc_id")


def _embedded_docs(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return hash_embed(d, DEFAULT_DIM).select(
        content_uuid("text").alias("id"), "embedding", "text",
        F.create_map(F.lit("doc_id"), F.col("doc_id").cast("string"),
                     F.lit("lang"), F.col("lang")).alias("metadata"), "lang", "doc_id")


def _write_lang_store(spark, sf_dir) -> str:
    path = scratch_path(spark, "store")
    # one write: each document goes to the namespace of its language
    store_append(_embedded_docs(spark, sf_dir), path, "docs", namespace_col="lang")
    return path


@register("store_append", """
SELECT 'docs' AS store, lang AS namespace, doc_id, length(text)::BIGINT AS n_chars FROM documents
""")
def q_store_append(spark, sf_dir):
    """Append vectors to a store (one namespace per language, one write),
    read everything back."""
    path = _write_lang_store(spark, sf_dir)
    return store_scan(spark, path).select("store", "namespace", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                                          F.length("text").cast("bigint").alias("n_chars"))


@register("store_namespace_scan", """
SELECT doc_id, lang AS namespace FROM documents WHERE lang = 'fr'
""")
def q_store_namespace_scan(spark, sf_dir):
    """S3: select one namespace of a store (partition pruning)."""
    path = _write_lang_store(spark, sf_dir)
    return store_scan(spark, path, "docs", "fr").select(
        F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"), "namespace")


@register("store_numeric_namespaces", """
SELECT doc_id, CASE lang WHEN 'en' THEN '7' WHEN 'fr' THEN '007' ELSE 'abc' END AS namespace FROM documents WHERE lang <> 'en'
""")
def q_store_numeric_namespaces(spark, sf_dir):
    """S3: namespaces that look like numbers are texts: 7, 007 and abc are
    three, and a scan of one gives no other's rows."""
    ns = F.when(F.col("lang") == "en", "7").when(F.col("lang") == "fr", "007").otherwise("abc")
    path = scratch_path(spark, "store")
    store_append(_embedded_docs(spark, sf_dir).withColumn("namespace", ns), path, "docs", namespace_col="namespace")
    rows = store_scan(spark, path, "docs", "007").unionByName(store_scan(spark, path, "docs", "abc"))
    return rows.select(F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"), "namespace")


@register("store_snapshot_roundtrip", """
SELECT doc_id, length(text)::BIGINT AS n_chars, lang
FROM documents
""")
def q_store_snapshot_roundtrip(spark, sf_dir):
    """Save a store as a JSON snapshot and load it back by schema."""
    path = scratch_path(spark, "snapshot")
    e = _embedded_docs(spark, sf_dir).select("id", "embedding", "text", "metadata",
                                             F.lit("docs").alias("store"),
                                             F.lit("__default__").alias("namespace"))
    save_snapshot(e, path)
    back = load_snapshot(spark, path)
    return back.select(F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                       F.length("text").cast("bigint").alias("n_chars"),
                       F.col("metadata")["lang"].alias("lang"))


@register("ingest_summary", f"""
WITH {FX.TYPED_DOCS_SQL},
p AS (SELECT origin, doc_id,
        CASE WHEN lower(type) = 'markdown-to-text' THEN payload
             WHEN lower(type) = 'html-to-text' THEN {G.html_text('payload')} END AS text
      FROM typed_docs),
v AS (SELECT *, text IS NOT NULL AND length(text) > 0 AND
        len(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0)) > 0 AS ok
      FROM p),
g AS (SELECT {G.uuid3('text')} AS id FROM v WHERE ok),
s AS (SELECT 'invalid' AS status, count(*) FILTER (WHERE NOT ok) AS n FROM v
      UNION ALL SELECT 'written', count(DISTINCT id) FROM g
      UNION ALL SELECT 'duplicate', count(*) - count(DISTINCT id) FROM g)
SELECT status, n, status IN ('written', 'duplicate') AS success FROM s WHERE n > 0
""")
def q_ingest_summary(spark, sf_dir):
    """A3/A4: ingest outcome counts (written / duplicate / invalid) with the
    success flag, over parse -> embed -> validate -> dedup of all documents
    and pages."""
    rows = knowledge_rows(spread(FX.typed_docs(spark, sf_dir)), split=False,
                          key_cols=("origin", "doc_id"))
    return ingest_summary(rows)


_ADD_SQL = f"""
WITH {FX.TYPED_DOCS_SQL},
parsed AS (
  SELECT origin || ':' || doc_id AS doc_id,
         CASE WHEN lower(type) = 'markdown-to-text' THEN payload
              WHEN lower(type) = 'html-to-text' THEN {G.html_text('payload')} END AS text
  FROM typed_docs),
good AS (SELECT doc_id, text FROM parsed WHERE text IS NOT NULL),
sp AS (SELECT * FROM ({G.split_sql("Recursive", 1000, 200, source="good")})),
seg AS (SELECT split_part(doc_id, ':', 1) AS origin, split_part(doc_id, ':', 2)::BIGINT AS doc_num, index, text
        FROM sp WHERE error_code IS NULL
          AND len(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0)) > 0),
ids AS (SELECT {G.uuid3('text')} AS id, origin, doc_num, index, text FROM seg),
firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY origin, doc_num, index) AS rn FROM ids)
SELECT id, origin, doc_num AS doc_id, index, length(text)::INTEGER AS n_chars FROM firsts WHERE rn = 1
"""


@register("add_to_knowledge", _ADD_SQL)
def q_add_to_knowledge(spark, sf_dir):
    """M4: parse -> recursive split -> embed -> validate -> dedup -> store,
    then the stored rows are read back."""
    from tessera.plans.knowledge import add_to_knowledge
    path = scratch_path(spark, "kb")
    docs = spread(FX.typed_docs(spark, sf_dir))
    add_to_knowledge(docs, path, "kb", None, key_cols=("origin", "doc_id"))
    return store_scan(spark, path, "kb").select(
        "id", F.col("metadata")["origin"].alias("origin"),
        F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
        F.col("metadata")["index"].cast("int").alias("index"),
        F.length("text").alias("n_chars"))


@register("add_to_knowledge_buckets", _ADD_SQL)
def q_add_to_knowledge_buckets(spark, sf_dir):
    """J-2/M4: a bucketed store filled by two ingests, then given all inputs once more: its filters tell
    which buckets to open, and nothing is written twice."""
    from tessera.plans.knowledge import add_to_knowledge
    path = scratch_path(spark, "kb-buckets")
    docs = spread(FX.typed_docs(spark, sf_dir))
    parts = [docs.where("origin = 'documents'"), docs.where("origin <> 'documents'"), docs]
    for part in parts:
        add_to_knowledge(part, path, "kb", None, key_cols=("origin", "doc_id"), id_buckets=True)
    return store_scan(spark, path, "kb").select(
        "id", F.col("metadata")["origin"].alias("origin"),
        F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
        F.col("metadata")["index"].cast("int").alias("index"),
        F.length("text").alias("n_chars"))


_RETRIEVAL_SQL = f"""
WITH {_TOKENS_SQL},
btoks AS (SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS tok FROM benchmark),
bcounts AS (SELECT item_id, (('0x' || substr(md5(tok), 1, 8))::BIGINT % 256)::INTEGER AS bucket,
                   count(*) AS cnt FROM btoks WHERE length(tok) > 0 GROUP BY ALL),
ids AS (SELECT doc_id, {G.uuid3('text')} AS id FROM documents),
firsts AS (SELECT id, min(doc_id) AS doc_id FROM ids GROUP BY id),
dn AS (SELECT doc_id, sqrt(sum(cnt * cnt)) AS n FROM counts GROUP BY doc_id),
qn AS (SELECT item_id, sqrt(sum(cnt * cnt)) AS n FROM bcounts GROUP BY item_id),
dp AS (SELECT b.item_id, c.doc_id, sum(b.cnt * c.cnt) AS dp FROM bcounts b JOIN counts c USING (bucket)
       GROUP BY ALL),
sc AS (SELECT dp.item_id AS query_id, f.id, f.doc_id,
              round((1 + dp.dp / (qn.n * dn.n)) / 2, 6) AS score
       FROM dp JOIN firsts f ON f.doc_id = dp.doc_id JOIN qn USING (item_id) JOIN dn ON dn.doc_id = dp.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
      FROM sc WHERE score >= {RAG_MIN_SCORE})
"""


def _kb_hits(spark, sf_dir):
    rows = knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
    # the store is materialised once (reliable checkpoint in the shared
    # folder), as an ingest would have written it, and then searched
    kept = cut_lineage(rows.where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = get_from_knowledge(kept, questions, RAG_K, RAG_MIN_SCORE)
    return questions, hits


@register("get_from_knowledge", _RETRIEVAL_SQL + """
SELECT query_id, rank::INTEGER AS rank, doc_id, round(score, 3) AS score FROM r WHERE rank <= 5
""")
def q_get_from_knowledge(spark, sf_dir):
    """M5: embed the benchmark questions, search the de-duplicated document
    store, top 5 with relevance >= 0.75."""
    _, hits = _kb_hits(spark, sf_dir)
    return hits.select("query_id", "rank", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                       F.round("score", 3).alias("score"))


@register("rag_context", _RETRIEVAL_SQL + """
, ctx AS (SELECT query_id, string_agg(d.text, '\n\n' ORDER BY rank) AS context, count(*) AS n_matches
        FROM r JOIN documents d USING (doc_id) WHERE rank <= 5 GROUP BY query_id)
SELECT b.item_id AS query_id, coalesce(ctx.context, '') AS context, coalesce(ctx.n_matches, 0)::INTEGER AS n_matches
FROM benchmark b LEFT JOIN ctx ON ctx.query_id = b.item_id
""")
def q_rag_context(spark, sf_dir):
    """J-6: each question with its retrieved passages joined in rank order."""
    questions, hits = _kb_hits(spark, sf_dir)
    return rag_context(questions.select("query_id"), hits).select("query_id", "context", "n_matches")


def flagship(spark, sf_dir):
    """documents -> recursive split -> hash embed -> dedup'd store (written
    to the shared scratch folder) -> benchmark passages as queries -> top 5."""
    from tessera.plans.knowledge import add_to_knowledge
    path = scratch_path(spark, "flagship")
    add_to_knowledge(_docs(spark, sf_dir), path, "kb", None, parse_docs=False)
    store = store_scan(spark, path, "kb")
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = get_from_knowledge(store, questions, RAG_K, RAG_MIN_SCORE)
    return hits.select("query_id", "rank", "score",
                       F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                       F.col("metadata")["index"].cast("int").alias("segment"), "text")


@register("batch_complete", f"""
SELECT item_id, {G.extractive_answer("'Summarise:' || chr(10) || chr(10) || text")} AS answer FROM benchmark
""")
def q_batch_complete(spark, sf_dir):
    """M2: chat completion over a table of prompts (the benchmark passages)
    through the Arrow-batched hook, with the deterministic stand-in model."""
    from tessera.functions.prompt import render_prompts
    from tessera.operators.infer import complete
    from tessera.plans.standin import extractive_answer_factory
    b = table(spark, sf_dir, "benchmark")
    prompts = render_prompts(b, "Summarise:\n\n${text}")
    return complete(prompts.select("item_id", "prompt"), extractive_answer_factory).select("item_id", "answer")


@register("batch_complete_kept", f"""
SELECT item_id, {G.extractive_answer("'Summarise:' || chr(10) || chr(10) || text")} AS answer, 0 AS unkept FROM benchmark
""")
def q_batch_complete_kept(spark, sf_dir):
    """M1/M2: the same prompts asked twice through a memo of answers, the second time of a model that
    always fails: every answer comes from the memo (``unkept``: answers it lacks)."""
    from tessera.functions.prompt import render_prompts
    from tessera.operators.infer import complete
    from tessera.operators.memo import Memo
    from tessera.plans.standin import broken_answer_factory, extractive_answer_factory
    prompts = render_prompts(table(spark, sf_dir, "benchmark"), "Summarise:\n\n${text}").select("item_id", "prompt")
    memo = Memo(scratch_path(spark, "memo"), "extractive", attempts=1)
    complete(prompts, extractive_answer_factory, memo=memo)
    again = complete(prompts, broken_answer_factory, memo=memo)
    return again.select("item_id", "answer", F.col("answer").isNull().cast("int").alias("unkept"))


@register("rag_chat", _RETRIEVAL_SQL + f"""
, ctx AS (SELECT query_id, string_agg(d.text, chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS n
          FROM r JOIN documents d USING (doc_id) WHERE rank <= 5 GROUP BY query_id),
pr AS (SELECT b.item_id AS query_id, coalesce(ctx.n, 0)::INTEGER AS n_matches,
         'Answer the question using the knowledge below.' || chr(10) || chr(10) || 'Question: ' || b.text
         || chr(10) || chr(10) || 'Knowledge:' || chr(10) || coalesce(ctx.context, '') AS prompt
       FROM benchmark b LEFT JOIN ctx ON ctx.query_id = b.item_id)
SELECT query_id, n_matches, {G.extractive_answer('prompt')} AS answer, {G.extractive_answer('prompt')} AS str_value,
       NULL::VARCHAR AS error_code
FROM pr
""")
def q_rag_chat(spark, sf_dir):
    """M6: each benchmark passage as a question: retrieve from the document
    store, render the prompt with the knowledge, complete, coerce."""
    from tessera.plans.standin import extractive_answer_factory
    from tessera.plans.knowledge import rag_chat
    rows = knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
    store = cut_lineage(rows.where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    qs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"),
                                                  F.col("text").alias("question"))
    return rag_chat(qs, store, extractive_answer_factory, k=RAG_K, min_score=RAG_MIN_SCORE).select(
        "query_id", "n_matches", "answer", "str_value", "error_code")


_PARSE_CODES_SQL = f"""
WITH {FX.TYPED_DOCS_SQL}
SELECT CASE WHEN lower(type) NOT IN ('markdown-to-text', 'html-to-text', 'pdf-to-text', 'doc-to-text',
                 'docx-to-text', 'ppt-to-text', 'pptx-to-text', 'xls-to-text', 'xlsx-to-text') THEN '701143'
            WHEN payload IS NULL THEN '701141' END AS code
FROM typed_docs
"""


@register("quarantine_codes", f"""
SELECT stage, code AS error_code, count(*) AS n FROM (
  SELECT 'parse' AS stage, code FROM ({_PARSE_CODES_SQL})
  UNION ALL
  SELECT 'ingest', code FROM ({_EMBEDDINGS_DECODED_SQL}
    SELECT CASE WHEN text IS NULL OR length(text) = 0 OR embedding IS NULL OR len(embedding) = 0
                  OR len(embedding) <> 64 THEN '701111' END AS code FROM x)
  UNION ALL
  SELECT 'embed', code FROM ({_SEGMENTS_DECODED_SQL}
    SELECT CASE WHEN text IS NULL OR length(text) = 0 THEN '701162' END AS code FROM x)
) WHERE code IS NOT NULL GROUP BY ALL
""")
def q_quarantine_codes(spark, sf_dir):
    """§2.12: quarantined rows per stage and error code (parse, embedding
    ingest validation, segment validation)."""
    from tessera.operators.parse import parse
    p = parse(FX.typed_docs(spark, sf_dir)).select(F.lit("parse").alias("stage"), F.col("error_code"))
    e = _embeddings_decoded(spark, sf_dir).select(
        F.lit("ingest").alias("stage"),
        VAL.embedding_error(F.col("e.text"), F.col("e.embedding"), 64).alias("error_code"))
    s = _segments_decoded(spark, sf_dir).select(F.lit("embed").alias("stage"),
                                                VAL.segment_error(F.col("seg.text")).alias("error_code"))
    return (p.unionByName(e).unionByName(s).where(F.col("error_code").isNotNull())
            .groupBy("stage", "error_code").agg(F.count(F.lit(1)).alias("n")))


@register("validate_knowledge", _EMBEDDINGS_DECODED_SQL + """
SELECT req_id, pos, CASE WHEN embedding IS NULL OR text IS NULL THEN '701171' END AS error_code FROM x
""")
def q_validate_knowledge(spark, sf_dir):
    """knowledge items handed to chat need an embedding and the embedded
    text (701171); the decoded embedding requests serve as knowledge items."""
    return _embeddings_decoded(spark, sf_dir).select(
        "req_id", "pos", VAL.knowledge_error(F.col("e.embedding"), F.col("e.text")).alias("error_code"))


@register("validate_segments_request", _SEGMENTS_DECODED_SQL + """
, c AS (SELECT req_id, pos, CASE WHEN text IS NULL OR length(text) = 0 THEN '701162' END AS code FROM x)
SELECT req_id, pos, coalesce(code, min(code) OVER (PARTITION BY req_id)) AS error_code FROM c
""")
def q_validate_segments_request(spark, sf_dir):
    """F14 in request mode: one invalid segment rejects every segment of its
    request (the original all-or-nothing rule)."""
    rows = _segments_decoded(spark, sf_dir).select(
        "req_id", "pos", VAL.segment_error(F.col("seg.text")).alias("error_code"))
    return VAL.request_mode(rows, "req_id")


@register("add_to_store", _EMBEDDINGS_DECODED_SQL + f"""
, v AS (SELECT * FROM x WHERE text IS NOT NULL AND length(text) > 0 AND embedding IS NOT NULL
                          AND len(embedding) = 64)
SELECT DISTINCT {G.uuid3('text')} AS id, text FROM v
""")
def q_add_to_store(spark, sf_dir):
    """S2/J-2 for pre-computed vectors (the decoded embedding requests):
    validate (dimension 64), content ids, first copy wins, append; the store
    is read back."""
    from tessera.plans.knowledge import add_to_store
    rows = _embeddings_decoded(spark, sf_dir).select("req_id", "pos", F.col("e.text").alias("text"),
                                                     F.col("e.embedding").alias("embedding"),
                                                     F.col("e.metadata").alias("metadata"))
    path = scratch_path(spark, "vectors")
    add_to_store(rows, path, "vectors", None, dim=64, order_cols=("req_id", "pos"))
    return store_scan(spark, path, "vectors").select("id", "text")


_FILTERED_SQL = _RETRIEVAL_SQL.replace(f"WHERE score >= {RAG_MIN_SCORE})",
                                       f"JOIN documents USING (doc_id) WHERE score >= {RAG_MIN_SCORE} AND lang = 'en' AND n_chars > 1000)")


@register("get_from_knowledge_filtered", _FILTERED_SQL + """
SELECT query_id, rank::INTEGER AS rank, doc_id, round(score, 3) AS score FROM r WHERE rank <= 5
""")
def q_get_from_knowledge_filtered(spark, sf_dir):
    """M4/M5/F: the user's metadata (language, length) goes through ingest into
    the store, and a metadata filter limits what the questions find."""
    from tessera.plans.knowledge import add_to_knowledge
    meta = F.create_map(F.lit("lang"), F.col("lang"), F.lit("n_chars"), F.col("n_chars").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", meta.alias("meta"))
    path = scratch_path(spark, "kb-meta")
    add_to_knowledge(docs, path, "kb", None, parse_docs=False, split=False, metadata_col="meta")
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = get_from_knowledge(store_scan(spark, path, "kb"), questions, RAG_K, RAG_MIN_SCORE,
                              store_filter='and(metadataKey("lang").isEqualTo("en"), metadataKey("n_chars").isGreaterThan(1000))')
    return hits.select("query_id", "rank", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"), F.round("score", 3).alias("score"))


def letter_embedder():
    """A user model for the queries: how often each of a, e, i, o, u is in the text."""
    import numpy as np

    def fn(texts):
        return np.array([[t.lower().count(c) for c in "aeiou"] for t in texts], dtype=np.float32)
    return fn


@register("add_to_knowledge_model", f"""
WITH c AS (SELECT {G.uuid3('text')} AS id, doc_id, lang, text FROM documents),
f AS (SELECT id, arg_min(doc_id, doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, min(text) AS text FROM c GROUP BY id)
SELECT id, doc_id, lang, length(lower(text)) - length(replace(lower(text), 'e', '')) AS e FROM f
""")
def q_add_to_knowledge_model(spark, sf_dir):
    """M1/M4: ingest with a user model as embedder; the second ingest of the
    same documents adds nothing.  The stored vectors are read back."""
    from tessera.operators.embed import model_embedder
    from tessera.plans.knowledge import add_to_knowledge
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.create_map(F.lit("lang"), F.col("lang")).alias("meta"))
    path = scratch_path(spark, "kb-model")
    for _ in range(2):
        add_to_knowledge(docs, path, "kb", None, parse_docs=False, split=False, metadata_col="meta", dim=5,
                         embedder=model_embedder(letter_embedder, 5))
    return store_scan(spark, path, "kb").select("id", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                                                F.col("metadata")["lang"].alias("lang"), F.col("embedding")[1].cast("bigint").alias("e"))


@register("get_from_two_namespaces", _RETRIEVAL_SQL + f"""
, n AS (SELECT query_id, score, ns, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, ns) AS rank, doc_id
        FROM (SELECT DISTINCT query_id, score, id, doc_id FROM sc WHERE score >= {RAG_MIN_SCORE}) CROSS JOIN (VALUES ('a'), ('b')) AS x(ns))
SELECT query_id, rank::INTEGER AS rank, ns AS namespace, doc_id, round(score, 3) AS score FROM n WHERE rank <= 5
""")
def q_get_from_two_namespaces(spark, sf_dir):
    """S3/M5: the same documents in two namespaces of a store are two hits each,
    every one with its own namespace."""
    path = scratch_path(spark, "kb-two")
    rows = cut_lineage(knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
                       .where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    for ns in ("a", "b"):
        store_append(rows, path, "kb", ns)
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = get_from_knowledge(store_scan(spark, path, "kb"), questions, RAG_K, RAG_MIN_SCORE)
    return hits.select("query_id", "rank", "namespace", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"), F.round("score", 3).alias("score"))


@register("get_from_replayed_store", _RETRIEVAL_SQL + """
SELECT query_id, rank::INTEGER AS rank, doc_id, round(score, 3) AS score, 0 AS left_over FROM r WHERE rank <= 5
""")
def q_get_from_replayed_store(spark, sf_dir):
    """A store to which the same rows were appended twice gives each hit once, before and after
    it is compacted (``left_over``: rows beyond one an identity, after)."""
    from tessera.sources.vector_store import compact_store
    path = scratch_path(spark, "kb-replayed")
    rows = cut_lineage(knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
                       .where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    for _ in range(2):
        store_append(rows, path, "kb")
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = cut_lineage(get_from_knowledge(store_scan(spark, path, "kb"), questions, RAG_K, RAG_MIN_SCORE))
    if compact_store(spark, path) != rows.count():
        raise AssertionError("the second copy of every row should have gone")
    stored = store_scan(spark, path, "kb")
    again = get_from_knowledge(stored, questions, RAG_K, RAG_MIN_SCORE).select("query_id", "rank", "id")
    left = stored.count() - rows.count()
    return hits.join(again, ["query_id", "rank", "id"]).select("query_id", "rank", F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"),
                                                               F.round("score", 3).alias("score"), F.lit(left).cast("int").alias("left_over"))


def _choosy_embedder():
    """``letter_embedder`` as a model that raises where a text's number of characters is a multiple of 3."""
    embed = letter_embedder()

    def fn(texts):
        if any(len(t) % 3 == 0 for t in texts):
            raise RuntimeError("the model is not available")
        return embed(texts)
    return fn


@register("add_to_knowledge_failing", f"""
WITH c AS (SELECT {G.uuid3('text')} AS id, doc_id, text FROM documents WHERE length(coalesce(text, '')) > 0),
f AS (SELECT id, min(text) AS text, count(*) AS n FROM c GROUP BY id)
SELECT id, n AS copies, CASE WHEN length(text) % 3 = 0 THEN '701161' END AS error_code FROM f
UNION ALL SELECT NULL, 1, '701162' FROM documents WHERE length(coalesce(text, '')) = 0
""")
def q_add_to_knowledge_failing(spark, sf_dir):
    """M1/§2.12: ingest with a model that fails for a third of all texts: those are in the quarantine
    table with 701161, the others in the store."""
    from tessera.operators.embed import model_embedder
    from tessera.plans.knowledge import add_to_knowledge
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path, bad = scratch_path(spark, "kb-failing"), scratch_path(spark, "kb-failing-quarantine")
    add_to_knowledge(docs, path, "kb", None, parse_docs=False, split=False, dim=5, embedder=model_embedder(_choosy_embedder, 5), quarantine_path=bad)
    copies = docs.where("length(text) > 0").groupBy(content_uuid("text").alias("id")).agg(F.count(F.lit(1)).alias("copies"))
    stored = store_scan(spark, path, "kb").select("id").join(copies, "id").select("id", "copies", F.lit(None).cast("string").alias("error_code"))
    return stored.unionByName(spark.read.parquet(bad).select("id", "copies", "error_code"))


@register("rag_chat_failing", _RETRIEVAL_SQL + f"""
, ctx AS (SELECT query_id, string_agg(d.text, chr(10) || chr(10) ORDER BY rank) AS context
          FROM r JOIN documents d USING (doc_id) WHERE rank <= 5 GROUP BY query_id),
pr AS (SELECT b.item_id AS query_id, 'Answer the question using the knowledge below.' || chr(10) || chr(10) || 'Question: ' || b.text
         || chr(10) || chr(10) || 'Knowledge:' || chr(10) || coalesce(ctx.context, '') AS prompt
       FROM benchmark b LEFT JOIN ctx ON ctx.query_id = b.item_id)
SELECT query_id, CASE WHEN length(prompt) % 3 <> 0 THEN {G.extractive_answer('prompt')} END AS answer,
       CASE WHEN length(prompt) % 3 = 0 THEN '701174' ELSE '701173' END AS error_code
FROM pr
""")
def q_rag_chat_failing(spark, sf_dir):
    """M6/§2.12: a model that fails for a third of all prompts gives 701174 there, also where the
    output type asked for (an integer) doesn't fit the others (701173)."""
    from tessera.plans.knowledge import rag_chat
    from tessera.plans.standin import failing_answer_factory
    rows = knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
    store = cut_lineage(rows.where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    qs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return rag_chat(qs, store, failing_answer_factory, k=RAG_K, min_score=RAG_MIN_SCORE, output_type="integer").select("query_id", "answer", "error_code")


@register("match_list", _RETRIEVAL_SQL + """
SELECT query_id, count(*)::INTEGER AS n, string_agg(doc_id || ':' || round(score, 3)::DECIMAL(5,3), ',' ORDER BY rank) AS matches FROM r WHERE rank <= 5 GROUP BY query_id
""")
def q_match_list(spark, sf_dir):
    """M5: the hits of each question as one list, in the documented result shape."""
    from tessera.plans.knowledge import match_list
    rows = knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
    store = cut_lineage(rows.where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    lists = match_list(get_from_knowledge(store, questions, RAG_K, RAG_MIN_SCORE))
    one = F.transform("matches", lambda m: F.concat(m["embedded"]["metadata"]["doc_id"], F.lit(":"), F.round(m["score"], 3).cast("decimal(5,3)").cast("string")))
    return lists.select("query_id", F.size("matches").alias("n"), F.array_join(one, ",").alias("matches"))


@register("stream_ingest_quarantine", r"""
SELECT doc_id, CASE WHEN doc_id % 7 = 3 OR length(coalesce(text, '')) = 0 THEN '701162' ELSE '701161' END AS error_code FROM documents
WHERE doc_id % 7 = 3 OR len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: length(x) > 0)) = 0
""")
def q_stream_ingest_quarantine(spark, sf_dir):
    """T1/§2.12: a stream in which some texts are empty (here: a seventh); their
    rows, and those of texts without a token, are the whole quarantine table, and the stream goes on."""
    from tessera.plans.q_stream import _stream
    from tessera.streaming.ingest import ingest_stream
    docs = _stream(spark, sf_dir, "documents", "doc_id", "doc_id")
    text = F.when(F.col("doc_id") % 7 != 3, F.col("text")).otherwise(F.lit(""))
    store, bad = scratch_path(spark, "kb-poison"), scratch_path(spark, "kb-quarantine")
    ingest_stream(docs.select("doc_id", text.alias("text")), store, "kb", parse_docs=False, split=False, quarantine_path=bad)
    return spark.read.parquet(bad).select(F.col("metadata")["doc_id"].cast("bigint").alias("doc_id"), "error_code")


_CHAT_SQL = _RETRIEVAL_SQL + f"""
, {FX.MESSAGES_SQL},
ctx AS (SELECT query_id, string_agg(d.text, chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS n
        FROM r JOIN documents d USING (doc_id) WHERE rank <= 5 GROUP BY query_id),
h AS (SELECT session_id, least(count(*), 3) AS n_history, max(seq) AS last_seq FROM messages GROUP BY session_id),
a AS (SELECT b.item_id AS request_id, CASE WHEN b.item_id % 4 = 3 THEN 'default' ELSE b.item_id::VARCHAR END AS session_id, b.text AS prompt,
        coalesce(n, 0)::INTEGER AS n_matches,
        CASE WHEN length(coalesce(context, '')) > 0 THEN chr(10) || chr(10) || 'Knowledge:' || chr(10) || context
             WHEN b.item_id % 2 = 0 THEN 'file ' || b.item_id ELSE b.text END AS said
      FROM benchmark b LEFT JOIN ctx ON ctx.query_id = b.item_id),
c AS (SELECT a.*, coalesce(n_history, 0)::INTEGER AS n_history, coalesce(last_seq, -1) AS last_seq, length(said) % 5 = 0 AS failed,
             {G.extractive_answer('said')} AS content FROM a LEFT JOIN h USING (session_id))
"""


def _chat(spark, sf_dir):
    """Benchmark passages as requests (every fourth without a session, every
    second with a text attached) to the sessions of the conversations."""
    from tessera.plans.chat import chat
    from tessera.plans.standin import extractive_chat_factory
    rows = knowledge_rows(_docs(spark, sf_dir), parse_docs=False, split=False)
    store = cut_lineage(rows.where(F.col("status") == "written").select("id", "embedding", "text", "metadata"))
    i = F.col("item_id")
    attached = F.to_json(F.struct(F.lit("text/plain").alias("type"), F.concat(F.lit("file "), i.cast("string")).alias("content")))
    requests = table(spark, sf_dir, "benchmark").select(
        i.alias("request_id"), F.when(i % 4 != 3, i.cast("string")).alias("session_id"), F.col("text").alias("prompt"),
        F.when(i % 2 == 0, attached).alias("attachments"))
    messages = FX.messages(spark, sf_dir)
    return messages, *chat(requests, messages, extractive_chat_factory, max_history=3, store=store, k=RAG_K, min_score=RAG_MIN_SCORE)


@register("chat_with_memory", _CHAT_SQL + """
SELECT request_id, session_id, n_history, n_matches, CASE WHEN NOT failed THEN content END AS content,
       CASE WHEN NOT failed THEN n_history + length(content) END::BIGINT AS total_tokens,
       CASE WHEN NOT failed THEN 'STOP' END AS finish_reason, CASE WHEN failed THEN '701174' END AS error_code FROM c
""")
def q_chat_with_memory(spark, sf_dir):
    """Chat over requests with session window, system prompt,
    attachments and knowledge; failed calls have a code of their own."""
    _, responses, _ = _chat(spark, sf_dir)
    r = F.col("response")
    return responses.select("request_id", "session_id", "n_history", "n_matches", r["content"].alias("content"),
                            r["tokenUsage"]["totalTokenCount"].alias("total_tokens"), r["finishReason"].alias("finish_reason"), "error_code")


@register("chat_memory_after", _CHAT_SQL + """
, t AS (SELECT request_id, session_id, last_seq, 0 AS turn, 'USER' AS type, prompt AS text FROM c WHERE NOT failed
        UNION ALL SELECT request_id, session_id, last_seq, 1, 'AI', content FROM c WHERE NOT failed)
SELECT session_id, seq::BIGINT AS seq, type, text FROM messages
UNION ALL
SELECT session_id, (last_seq + row_number() OVER (PARTITION BY session_id ORDER BY request_id, turn))::BIGINT, type, text FROM t
""")
def q_chat_memory_after(spark, sf_dir):
    """The message table on disk after the turns of those chats were
    appended to it."""
    from tessera.sources import memory_store as MS
    messages, _, turns = _chat(spark, sf_dir)
    path = scratch_path(spark, "chat-memory")
    MS.append_messages(messages, path)
    MS.append_messages(turns, path)
    return MS.read_messages(spark, path).select("session_id", "seq", "type", "text")
