"""Registered queries: vector expressions and similarity search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import vector as V
from tessera.operators.search import vector_topk
from tessera.plans.registry import register
from tessera.sources.tables import table

EMB_DIM = 64  # dimension of the ``embeddings`` fixture vectors
TOPK_K = 5
TOPK_MIN_SCORE = 0.6


_TOPK_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (
  SELECT q.vec_id AS query_id, s.vec_id AS id,
         round((1 + list_dot_product(q.e, s.e)
                / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(s.e, s.e)))) / 2, 6) AS score
  FROM v q, v s),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
      FROM p WHERE score >= 0.6)
SELECT query_id, id, score, rank::INTEGER AS rank FROM r WHERE rank <= 5
"""


def _topk(spark, sf_dir, strategy):
    emb = table(spark, sf_dir, "embeddings")
    store = emb.select(F.col("vec_id").alias("id"), "embedding")
    queries = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    return vector_topk(store, queries, TOPK_K, TOPK_MIN_SCORE, dim=EMB_DIM, strategy=strategy)


@register("vector_topk", _TOPK_SQL)
def q_vector_topk(spark, sf_dir):
    """Every stored vector is also a query: exact top-5 by (1+cos)/2 >= 0.6,
    with the strategy that the size of the query side allows."""
    return _topk(spark, sf_dir, None)


@register("vector_topk_blocked", _TOPK_SQL)
def q_vector_topk_blocked(spark, sf_dir):
    """The same by blocks of store and queries, as for query sets that don't fit
    in a task."""
    return _topk(spark, sf_dir, "blocked")


@register("cosine_pairs", """
WITH x AS (SELECT vec_id, label, u.i AS pos, embedding[u.i]::DOUBLE AS val
           FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(i)),
c AS (SELECT label, pos, avg(val) AS val FROM x GROUP BY label, pos),
d AS (SELECT x.vec_id, x.label, sum(x.val * c.val) AS dt FROM x JOIN c USING (label, pos)
      GROUP BY x.vec_id, x.label),
nx AS (SELECT vec_id, sqrt(sum(val * val)) AS n FROM x GROUP BY vec_id),
nc AS (SELECT label, sqrt(sum(val * val)) AS n FROM c GROUP BY label)
SELECT d.vec_id, d.label, round(d.dt / (nx.n * nc.n), 6) AS cosine
FROM d JOIN nx USING (vec_id) JOIN nc USING (label)
""")
def q_cosine_pairs(spark, sf_dir):
    """Cosine of every vector with the centroid of its label (V1 as a native
    HOF dot product).  The centroid is a per-(label, position) average, so the
    group size is bounded by the vector dimension, not by the data."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    cells = emb.select("label", F.posexplode("embedding").alias("pos", "val"))
    centroid = (cells.groupBy("label", "pos").agg(F.avg(F.col("val").cast("double")).alias("val"))
                .groupBy("label")
                .agg(F.array_sort(F.collect_list(F.struct("pos", "val"))).alias("c"))
                .select("label", F.transform("c", lambda s: s["val"]).alias("centroid")))
    return (emb.join(centroid, "label")
            .select("vec_id", "label",
                    F.round(V.cosine("embedding", "centroid"), 6).alias("cosine")))


@register("vector_normalize", """
SELECT vec_id, len(embedding)::INTEGER AS dim,
       round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm_in,
       round(sqrt(list_sum(list_transform(embedding,
             lambda x: pow(x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 2)))), 6) AS norm_out
FROM embeddings
""")
def q_vector_normalize(spark, sf_dir):
    """Unit-normalise every vector (V3); report the norm before and after."""
    emb = table(spark, sf_dir, "embeddings")
    unit = emb.select("vec_id", "embedding", V.normalize("embedding", as_float=False).alias("unit"))
    return unit.select("vec_id", F.size("embedding").alias("dim"),
                       F.round(V.l2_norm("embedding"), 6).alias("norm_in"),
                       F.round(V.l2_norm("unit"), 6).alias("norm_out"))


@register("vector_topk_approx", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
planes AS (SELECT t.t AS t, b.b AS b, list_transform(range(0, 64), lambda p:
             CASE WHEN substr(md5('17:' || t.t || ':' || b.b || ':' || p), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS s
           FROM range(0, 12) AS t(t), range(0, 3) AS b(b)),
codes AS (SELECT vec_id, t, sum(CASE WHEN list_dot_product(e, s) > 0 THEN 1 << b ELSE 0 END) AS code FROM v, planes GROUP BY vec_id, t),
cand AS (SELECT DISTINCT q.vec_id AS query_id, c.vec_id AS id FROM codes q JOIN codes c ON q.t = c.t AND q.code = c.code),
p AS (SELECT query_id, id, round((1 + list_dot_product(a.e, b.e)
             / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)))) / 2, 6) AS score
      FROM cand JOIN v a ON a.vec_id = query_id JOIN v b ON b.vec_id = id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM p WHERE score >= 0.6)
SELECT query_id, id, score, rank::INTEGER AS rank FROM r WHERE rank <= 5
""")
def q_vector_topk_approx(spark, sf_dir):
    """J-7: approximate top-5 (12 LSH tables x 3 bits) with exact re-scoring;
    every stored vector is also a query."""
    from tessera.operators.search import vector_topk_approx
    emb = table(spark, sf_dir, "embeddings")
    store = emb.select(F.col("vec_id").alias("id"), "embedding")
    queries = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    return vector_topk_approx(store, queries, TOPK_K, TOPK_MIN_SCORE, dim=EMB_DIM, n_tables=12, n_bits=3)


@register("vector_index_topk", """
SELECT vec_id AS query_id, 5 AS n_hits, true AS itself_first, true AS scores_right, true AS recall_reached, true AS few_scored FROM embeddings
""")
def q_vector_index_topk(spark, sf_dir):
    """J-7: approximate top-5 of every stored vector from a stored index (16 lists, 12 probed; 32 codes of
    4 bits a vector; 6 of 512 rows of a list scored by their vectors), held against the exact search: hits by query, whether
    the vector itself is first, whether all scores are the exact ones, and, over all
    queries, recall@5 of 0.9 or more with under 15 % of all pairs scored by vectors."""
    from tessera.operators.search import vector_topk
    from tessera.operators.vector_index import build_index, index_topk
    from tessera.session import cut_lineage
    from tessera.sources.vector_store import scratch_path
    emb = table(spark, sf_dir, "embeddings")
    store, queries = emb.select(F.col("vec_id").alias("id"), "embedding"), emb.select(F.col("vec_id").alias("query_id"), "embedding")
    path = scratch_path(spark, "vector-index")
    build_index(store, path, dim=EMB_DIM, n_lists=16)
    hits = cut_lineage(index_topk(spark, path, queries, TOPK_K, n_probe=12))
    exact = vector_topk(store, queries, TOPK_K, dim=EMB_DIM).select("query_id", "id", F.lit(1).alias("_top"))
    q, s = queries.withColumnRenamed("embedding", "_q"), store.withColumnRenamed("embedding", "_s")
    cos = (1 + V.cosine("_q", "_s")) / 2
    rows = (hits.join(exact, ["query_id", "id"], "left").join(q, "query_id").join(s, "id").groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_hits"),
        F.bool_or((F.col("rank") == 1) & (F.col("score") == 1.0)).alias("itself_first"),
        F.bool_and(F.abs(cos - F.col("score")) < 2e-6).alias("scores_right"),
        F.count("_top").alias("_found"), F.max("n_scored").alias("_scored")))
    whole = rows.agg((F.sum("_found") >= 0.9 * TOPK_K * F.count(F.lit(1))).alias("recall_reached"),
                     (F.sum("_scored") < 0.15 * F.count(F.lit(1)) * F.count(F.lit(1))).alias("few_scored"))
    return rows.drop("_found", "_scored").join(F.broadcast(whole))  # one row


@register("vector_search_one", """
WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings ORDER BY vec_id LIMIT 1),
s AS (SELECT vec_id AS id, round((1 + list_dot_product(embeddings.embedding::DOUBLE[], q.e)
          / (sqrt(list_dot_product(embeddings.embedding::DOUBLE[], embeddings.embedding::DOUBLE[]))
             * sqrt(list_dot_product(q.e, q.e)))) / 2, 6) AS score FROM embeddings, q)
SELECT id, score FROM s WHERE score >= 0.6 ORDER BY score DESC, id LIMIT 5
""")
def q_vector_search_one(spark, sf_dir):
    """W1 (one request): the first stored vector searched against the whole
    store with orderBy + limit (TakeOrderedAndProject)."""
    from tessera.operators.search import search_one
    emb = table(spark, sf_dir, "embeddings")
    first = emb.orderBy("vec_id").select("embedding").limit(1).collect()[0]["embedding"]
    return search_one(emb.select(F.col("vec_id").alias("id"), "embedding"), first, TOPK_K, TOPK_MIN_SCORE)
