"""Similarity search: many query vectors against a vector store.

Exact search (``vector_topk``) never pairs rows in Spark.  A query set
proven small by one capped pass is broadcast and every store partition is
scored where it lies (numpy matrix product per Arrow batch, running top-k
per partition).  Larger query sets use a blocked product: store rows are
hashed into ``store_blocks`` blocks and query rows into ``query_blocks``;
each (store block, query block) cell is one cogroup group, so no task holds
more than one block of each side.  In both, ``min_score`` is applied first
and only the local top-k per query under the final total order (score desc,
id asc) is shuffled, which makes the final windowed ``row_number`` exact.

Approximate search (``vector_topk_approx``) uses the same group scorer keyed
by random-hyperplane LSH buckets; ``search_one`` serves a single request with
``orderBy(...).limit(k)``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Memory budget for one side of one block in a task (bytes of DOUBLE vectors).
BLOCK_BYTES = 16 * 1024 * 1024
# Scores materialised at once inside a block (rows x cols of DOUBLE), and store rows among them.
SCORE_CHUNK_CELLS = 512 * 1024
SCORE_CHUNK_ROWS = 4096
# A cosine so far below the one that a score stands for can't round up to that score (6 digits).
COSINE_SLACK = 2e-6


def _blocks(n_rows: int, dim: int, minimum: int) -> int:
    per_block = max(1, BLOCK_BYTES // max(1, dim * 8))
    return max(minimum, math.ceil(n_rows / per_block), 1)


def _matrix(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series.values])


def _unit(mat: np.ndarray) -> np.ndarray:
    """The rows at length 1, in place; a row without a direction gets NaN, which is near nothing."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.divide(mat, np.linalg.norm(mat, axis=1)[:, None], out=mat)


def _local_topk(ids: np.ndarray, smat: np.ndarray, qids: np.ndarray, qunit: np.ndarray,
                k: int, min_score: float | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top-k (score desc, id asc) of one block; scores are (1+cos)/2 rounded to 6.
    ``qunit`` has rows of length 1.  ``min_score`` is one number or one for each query.  Rows of one id are one, with its
    best score.  Chunks of at most ``SCORE_CHUNK_CELLS`` cosines (FLOAT) are met by what each query
    asks for at least, which rises with its k-th hit so far; only the others are scored by DOUBLE products, rounded and sorted."""
    if len(ids) == 0 or len(qids) == 0:
        return qids[:0], ids[:0], np.zeros(0)
    order = np.argsort(ids, kind="stable")
    ids, sunit = ids[order], _unit(smat[order])
    first = np.r_[True, ids[1:] != ids[:-1]]
    number, firsts = np.cumsum(first) - 1, np.flatnonzero(first)
    least = np.broadcast_to(np.asarray(min_score, dtype=np.float64), (len(qids),))
    coarse, rows, slack = qunit.astype(np.float32), sunit.astype(np.float32), _float_slack(sunit.shape[1])
    width = min(len(ids), SCORE_CHUNK_ROWS)
    step = max(1, SCORE_CHUNK_CELLS // width)
    out_q, out_s, out_v = [], [], []
    for lo in range(0, len(qids), step):
        q, floor = qunit[lo:lo + step], least[lo:lo + step].copy()
        hits = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(ids), width):
            cos = coarse[lo:lo + step] @ rows[at:at + width].T
            qi, si = _near(cos, floor, slack)
            if len(qi) > 4 * k * len(q):  # many: the chunk's own k-th hits tell more
                floor = np.maximum(floor, _kth(cos, first[at:at + width], k) - slack)
                qi, si = _near(cos, floor, slack)
            sc = np.round((1.0 + np.einsum("nd,nd->n", q[qi], sunit[at + si])) / 2.0, 6)
            good = sc >= floor[qi]
            if good.any():
                hits = _reduce_topk(*(np.concatenate(x) for x in zip(hits, (qi[good], number[at + si[good]], sc[good]))), k)
                _raise_floor(floor, hits[0], hits[2], k)
        out_q.append(lo + hits[0])
        out_s.append(hits[1])
        out_v.append(hits[2])
    return qids[np.concatenate(out_q)], ids[firsts[np.concatenate(out_s)]], np.concatenate(out_v)


def _float_slack(dim: int) -> float:
    """No FLOAT product of unit vectors is further off (an addition and a product by 2^-24 each, twice for the sides' own rounding)."""
    return COSINE_SLACK + (dim + 4) * 2.0 ** -23


def _near(cos: np.ndarray, floor: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Places whose score may be ``floor`` or more (never a NaN)."""
    return np.divmod(_places(cos >= (2.0 * floor - 1.0 - slack).astype(cos.dtype)[:, None]), cos.shape[1])


def _places(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero``, looking at eight places at a time: nearly all are False."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    eights = flat[:whole].reshape(-1, 8)
    some = np.flatnonzero(flat[:whole].view(np.uint64))
    row, at = np.nonzero(eights[some])
    return np.concatenate([some[row] * 8 + at, whole + np.flatnonzero(flat[whole:])])


def _kth(cos: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Score of each query's k-th hit in a chunk, of which ``first`` marks where ids begin (the
    chunk may begin within one)."""
    cos = np.where(np.isnan(cos), -np.inf, cos)
    if not first.all():
        cos = np.maximum.reduceat(cos, np.flatnonzero(np.r_[True, first[1:]]), axis=1)
    n = cos.shape[1]
    return np.round((1.0 + np.partition(cos, n - k, axis=1)[:, n - k]) / 2.0, 6) if n >= k else np.full(len(cos), -np.inf)


def _raise_floor(floor: np.ndarray, q: np.ndarray, sc: np.ndarray, k: int) -> None:
    """Where reduced hits (by query number) have a k-th, no lower score is asked for."""
    last = np.flatnonzero(q[k - 1:] == q[:len(q) - k + 1]) + k - 1 if len(q) >= k else np.zeros(0, np.int64)
    floor[q[last]] = np.maximum(floor[q[last]], sc[last])


# Most tasks that cells are dealt to.
CELL_TASKS = 2000


def _score_groups(s: DataFrame, q: DataFrame, keys: list[str], k: int, min_score: float,
                  qid_type: T.DataType, id_type: T.DataType, n_groups: int) -> DataFrame:
    """Cogroup store rows (``_id, _v``) and query rows (``_qid, _qv``) on
    ``keys`` and keep each group's local top-k per query.  The ``n_groups`` groups are dealt to tasks by their
    number: their work grows with both sides, so tasks joined by their bytes would be uneven."""
    out_schema = T.StructType([
        T.StructField("_qid", qid_type), T.StructField("_id", id_type),
        T.StructField("score", T.DoubleType())])

    def score_block(sdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        if len(sdf) == 0 or len(qdf) == 0:
            return pd.DataFrame({"_qid": pd.Series([], dtype=object),
                                 "_id": pd.Series([], dtype=object),
                                 "score": pd.Series([], dtype="float64")})
        qi, si, sc = _local_topk(sdf["_id"].to_numpy(), _matrix(sdf["_v"]),
                                 qdf["_qid"].to_numpy(), _unit(_matrix(qdf["_qv"])), k,
                                 qdf["_least"].to_numpy(dtype=np.float64) if "_least" in qdf else min_score)
        return pd.DataFrame({"_qid": qi, "_id": si, "score": sc})

    tasks = min(2 * n_groups, CELL_TASKS)
    return (s.repartition(tasks, *keys).groupBy(*keys).cogroup(q.repartition(tasks, *keys).groupBy(*keys))
            .applyInPandas(score_block, out_schema))


def _reduce_topk(q: np.ndarray, i: np.ndarray, sc: np.ndarray, k: int):
    """Keep the first ``k`` (score desc, id asc) candidates of every query; an id counts once, with its best score."""
    if len(q) == 0:
        return q, i, sc
    order = np.lexsort((-sc, i, q))
    q, i, sc = q[order], i[order], sc[order]
    once = np.r_[True, (q[1:] != q[:-1]) | (i[1:] != i[:-1])]
    q, i, sc = q[once], i[once], sc[once]
    order = np.lexsort((i, -sc, q))
    q, i, sc = q[order], i[order], sc[order]
    first = np.r_[True, q[1:] != q[:-1]]
    starts = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    keep = (np.arange(len(q)) - starts) < k
    return q[keep], i[keep], sc[keep]


def _broadcast_scores(s: DataFrame, queries_pdf: pd.DataFrame, k: int, min_score: float | np.ndarray,
                      qid_type: T.DataType, id_type: T.DataType) -> DataFrame:
    """Score every store partition against a broadcast query matrix; each
    partition keeps a running top-k across its Arrow batches, so it emits at
    most ``k`` rows per query."""
    spark = s.sparkSession
    bc = spark.sparkContext.broadcast((queries_pdf["_qid"].to_numpy(), _unit(_matrix(queries_pdf["_qv"])), min_score))
    out_schema = T.StructType([T.StructField("_qid", qid_type), T.StructField("_id", id_type),
                               T.StructField("score", T.DoubleType())])

    def run(batches):
        bq, bmat, least = bc.value
        number = np.arange(len(bq))
        floor = np.broadcast_to(np.asarray(least, dtype=np.float64), (len(bq),)).copy()
        hits, n_reduced = [], 0
        for pdf in batches:
            for at in range(0, len(pdf), SCORE_CHUNK_ROWS):
                part = pdf.iloc[at:at + SCORE_CHUNK_ROWS]
                found = _local_topk(part["_id"].to_numpy(), _matrix(part["_v"]), number, bmat, k, floor)
                if len(found[0]):
                    hits.append(found)
                if sum(len(x[0]) for x in hits) > 2 * n_reduced + KEPT_HITS:
                    hits = [_reduce_topk(*(np.concatenate(x) for x in zip(*hits)), k)]
                    n_reduced = len(hits[0][0])
                    _raise_floor(floor, hits[0][0], hits[0][2], k)
        if hits:
            q, i, sc = _reduce_topk(*(np.concatenate(x) for x in zip(*hits)), k)
            for at in range(0, len(q), KEPT_HITS):
                yield pd.DataFrame({"_qid": bq[q[at:at + KEPT_HITS]], "_id": i[at:at + KEPT_HITS], "score": sc[at:at + KEPT_HITS]})

    return s.select("_id", "_v").mapInPandas(run, out_schema)


# Largest query matrix (rows x dim x 8 bytes) shipped to every executor.
BROADCAST_QUERY_BYTES = 16 * 1024 * 1024
# Hits that a task keeps beyond twice the reduced ones before it reduces them again.
KEPT_HITS = 64 * 1024


# One in so many store rows is scored first, to know a score that each query's
# k-th hit reaches at least.
FLOOR_SHARE = 64


def _once(partial: DataFrame) -> DataFrame:
    """One row per query and id, with its best score, dealt by query (so ranks need no other shuffle)."""
    return partial.repartition("_qid").groupBy("_qid", "_id").agg(F.max("score").alias("score"))


def _kth_scores(partial: DataFrame, k: int) -> DataFrame:
    """``_qid, _least``: the k-th best score of the queries that have k hits."""
    w = Window.partitionBy("_qid").orderBy(F.col("score").desc(), F.col("_id").asc())
    return (_once(partial).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == k)
            .select("_qid", F.col("score").alias("_least")))


def _cells(s: DataFrame, q: DataFrame, store_blocks: int, query_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to the cells of a grid of blocks."""
    return (s.withColumn("_sb", F.pmod(F.xxhash64("_id"), F.lit(store_blocks)).cast("int"))
            .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))),
            q.withColumn("_qb", F.pmod(F.xxhash64("_qid"), F.lit(query_blocks)).cast("int"))
            .withColumn("_sb", F.explode(F.sequence(F.lit(0), F.lit(store_blocks - 1)))))


def vector_topk(store: DataFrame, queries: DataFrame, k: int, min_score: float = 0.0, *,
                id_col: str = "id", vec_col: str = "embedding",
                query_id_col: str = "query_id", query_vec_col: str = "embedding",
                store_blocks: int | None = None, query_blocks: int | None = None,
                dim: int | None = None, strategy: str | None = None, floor_share: int = FLOOR_SHARE) -> DataFrame:
    """Exact top-``k`` store rows per query by cosine relevance ``(1+cos)/2``.

    ``min_score`` is applied before ranking.  Result columns:
    ``query_id, id, score, rank`` (names taken from the arguments).  Vectors of
    another width than ``dim`` (default: the widest stored) and such with a null element match nothing.  Several
    store rows of one id are one hit, with the best of their scores; several queries of one id are one query.

    One in ``floor_share`` store rows is scored first: the k-th hit among them
    bounds the k-th hit of all, so later only rows at or above that bound leave
    a task, about ``k * floor_share`` a query however many tasks there are.

    Two physical strategies; both give the same rows:

    * *broadcast*: the query matrix (at most ``BROADCAST_QUERY_BYTES``, proved by
      one capped pass that also fetches it) is sent once to every executor and
      every store partition is scored where it lies; the store is never shuffled.
    * *blocked* (larger query sets): store rows are hashed into ``store_blocks``
      and queries into ``query_blocks``, and every (store block, query block) cell
      is one cogroup group.  The numbers of blocks follow from the row counts,
      so that a block of either side is at most ``BLOCK_BYTES``.

    ``strategy`` forces one of ``"broadcast"`` / ``"blocked"``.
    """
    from tessera.session import cut_lineage

    if dim is None:  # the widest stored vector, so that no bound is too small
        dim = store.agg(F.max(F.size(vec_col))).first()[0] or 1
    id_type = store.schema[id_col].dataType
    qid_type = queries.schema[query_id_col].dataType
    s = (store.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"))
         .where(F.col("_v").isNotNull() & (F.size("_v") == dim)))
    q = (queries.select(F.col(query_id_col).alias("_qid"), F.col(query_vec_col).alias("_qv"))
         .where(F.col("_qv").isNotNull() & (F.size("_qv") == dim)))
    in_first = F.pmod(F.xxhash64("_id"), F.lit(floor_share)) == 0
    first = s.where(in_first)
    limit_rows = max(1, BROADCAST_QUERY_BYTES // max(1, dim * 8))
    qpdf = None
    if strategy == "broadcast" or (strategy is None and query_blocks is None and store_blocks is None):
        qpdf = q.limit(limit_rows + 1).toPandas()
        if len(qpdf) > limit_rows:
            if strategy == "broadcast":
                raise ValueError("query side exceeds the broadcast bound; use strategy='blocked'")
            qpdf = None
    if qpdf is not None:
        found = _kth_scores(_broadcast_scores(first, qpdf, k, min_score, qid_type, id_type), k).toPandas()  # a row a query
        at = dict(zip(found["_qid"], found["_least"]))
        least = np.array([at.get(x, min_score) for x in qpdf["_qid"]], dtype=np.float64)
        partial = _broadcast_scores(s, qpdf, k, least, qid_type, id_type)
    else:
        sizes = s.agg(F.count(F.lit(1)).alias("all"), F.count_if(in_first).alias("first")).first()
        store_blocks = store_blocks or _blocks(sizes["all"], dim, 2 * store.sparkSession.sparkContext.defaultParallelism)
        query_blocks = query_blocks or _blocks(q.count(), dim, 1)
        first_blocks = _blocks(sizes["first"], dim, 1)  # few, as the queries go to each
        found = _kth_scores(_score_groups(*_cells(first, q, first_blocks, query_blocks), ["_sb", "_qb"], k, min_score, qid_type, id_type,
                                          first_blocks * query_blocks), k)
        bounded = cut_lineage(q.join(found, "_qid", "left").withColumn("_least", F.coalesce("_least", F.lit(float(min_score)))))
        partial = _score_groups(*_cells(s, bounded, store_blocks, query_blocks), ["_sb", "_qb"], k, min_score, qid_type, id_type,
                                store_blocks * query_blocks)
    w = Window.partitionBy("_qid").orderBy(F.col("score").desc(), F.col("_id").asc())
    return (_once(partial).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select(F.col("_qid").alias(query_id_col), F.col("_id").alias(id_col),
                    "score", F.col("rank").cast("int").alias("rank")))


def sign_planes(dim: int, n_tables: int, n_bits: int, seed: int) -> np.ndarray:
    """Hyperplanes with components +1 and -1, told by the md5 of
    ``seed:table:bit:place`` (first hex digit under 8: +1), so that any engine
    can make the same codes."""
    return np.array([[1.0 if hashlib.md5(f"{seed}:{t}:{b}:{p}".encode()).hexdigest()[0] < "8" else -1.0 for p in range(dim)]
                     for t in range(n_tables) for b in range(n_bits)]).reshape(n_tables * n_bits, dim)


def _lsh_codes(dim: int, n_tables: int, n_bits: int, seed: int):
    """pandas UDF: one bucket code per table from random hyperplanes (sign
    random projection, Charikar 2002).  The hyperplane matrix is fixed by
    the parameters (``n_tables * n_bits * dim`` doubles)."""
    planes = sign_planes(dim, n_tables, n_bits, seed)
    weights = (1 << np.arange(n_bits)).astype(np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def codes(vs: pd.Series) -> pd.Series:
        m = _matrix(vs)
        if m.shape[0] == 0:
            return pd.Series([], dtype=object)
        bits = (m @ planes.T > 0).reshape(len(vs), n_tables, n_bits)
        return pd.Series(list((bits * weights).sum(axis=2).astype(np.int32)))
    return codes.asNondeterministic()  # evaluate once; never copied into pushed filters


def lsh_codes(vec, dim: int, n_tables: int = 8, n_bits: int = 6, seed: int = 17):
    """Column: the ``n_tables`` bucket codes of a vector (store them at ingest
    as an index column and pass it as ``store_codes_col`` to search)."""
    c = F.col(vec) if isinstance(vec, str) else vec
    return _lsh_codes(dim, n_tables, n_bits, seed)(c)


def vector_topk_approx(store: DataFrame, queries: DataFrame, k: int, min_score: float = 0.0, *,
                       dim: int, id_col: str = "id", vec_col: str = "embedding",
                       query_id_col: str = "query_id", query_vec_col: str = "embedding",
                       n_tables: int = 8, n_bits: int = 6, seed: int = 17,
                       block_rows: int | None = None, store_codes_col: str | None = None, floor_share: int = FLOOR_SHARE) -> DataFrame:
    """Approximate top-``k``: candidates share an LSH bucket in at least one
    of ``n_tables`` tables; candidates are scored exactly.

    With ``store_codes_col`` the store's codes are read from that column
    (computed at ingest by ``lsh_codes`` with the same parameters) instead of
    being recomputed.  Buckets are equi-join keys of a cogroup.  A hot bucket (many vectors) is
    split into sub-blocks on both sides (the other side is replicated per
    sub-block), sized from a pre-aggregated count per bucket; that count
    table has at most ``n_tables * 2**n_bits`` rows, so broadcasting it is
    bounded by the parameters.  No candidate pairs are materialised: each
    group emits only its local top-k.  As in ``vector_topk``, one in ``floor_share`` store rows is
    scored first, among the same candidates, and bounds each query's k-th hit.
    """
    from tessera.session import cut_lineage

    if block_rows is None:
        block_rows = max(1, BLOCK_BYTES // max(1, dim * 8))
    codes = _lsh_codes(dim, n_tables, n_bits, seed)
    id_type = store.schema[id_col].dataType
    qid_type = queries.schema[query_id_col].dataType
    # Stored codes (an index column written at ingest with the same
    # parameters) spare the store side from being coded twice per search.
    store_codes = F.col(store_codes_col) if store_codes_col else codes(F.col("_v"))
    s = (store.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"),
                      *([F.col(store_codes_col)] if store_codes_col else []))
         .where(F.col("_v").isNotNull() & (F.size("_v") > 0))
         .select("_id", "_v", F.posexplode(store_codes).alias("_t", "_b")))
    q = (queries.select(F.col(query_id_col).alias("_qid"), F.col(query_vec_col).alias("_qv"))
         .where(F.col("_qv").isNotNull() & (F.size("_qv") > 0)))

    def coded(q: DataFrame) -> DataFrame:
        return q.select("*", F.posexplode(codes(F.col("_qv"))).alias("_t", "_b"))

    def counts(df: DataFrame, **named) -> DataFrame:
        return df.groupBy("_t", "_b").agg(*[F.count_if(c).alias(n) for n, c in named.items()])

    def blocks(n: str):
        return F.ceil(F.col(n) / F.lit(block_rows)).cast("int")

    in_first = F.pmod(F.xxhash64("_id"), F.lit(floor_share)) == 0
    sizes = cut_lineage(counts(s, _all=F.lit(True), _first=in_first).join(counts(coded(q), _asked=F.lit(True)), ["_t", "_b"])
                        .select("_t", "_b", blocks("_all").alias("_all"), blocks("_first").alias("_first"), blocks("_asked").alias("_nq")))

    def scored(s: DataFrame, q: DataFrame, n: str) -> DataFrame:
        dealt = F.broadcast(sizes.select("_t", "_b", F.col(n).alias("_ns"), "_nq").where("_ns > 0"))  # <= n_tables * 2**n_bits rows
        s = (s.join(dealt, ["_t", "_b"])
             .withColumn("_sb", F.pmod(F.xxhash64("_id"), F.col("_ns")).cast("int"))
             .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_nq") - 1))))
        q = (coded(q).join(dealt, ["_t", "_b"])
             .withColumn("_qb", F.pmod(F.xxhash64("_qid"), F.col("_nq")).cast("int"))
             .withColumn("_sb", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1))))
        cells = sizes.agg(F.sum(F.col(n) * F.col("_nq"))).first()[0] or 1
        return _score_groups(s.drop("_ns", "_nq"), q.drop("_ns", "_nq"), ["_t", "_b", "_sb", "_qb"], k, min_score, qid_type, id_type, cells)

    found = cut_lineage(_kth_scores(scored(s.where(in_first), q, "_first"), k))
    bounded = q.join(found, "_qid", "left").withColumn("_least", F.coalesce("_least", F.lit(float(min_score))))
    partial = scored(s, bounded, "_all")
    # the same pair can be found through several tables: same exact score
    pairs = partial.groupBy("_qid", "_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("_qid").orderBy(F.col("score").desc(), F.col("_id").asc())
    return (pairs.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select(F.col("_qid").alias(query_id_col), F.col("_id").alias(id_col),
                    "score", F.col("rank").cast("int").alias("rank")))


def search_one(store: DataFrame, query_vector: list[float], k: int, min_score: float = 0.0, *,
               id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Top-``k`` for a single query vector given on the driver (one request):
    a native dot-product filter + ``orderBy(...).limit(k)``, which plans as a
    distributed ``TakeOrderedAndProject`` (per-partition top-k, no full sort).
    """
    from tessera.functions.vector import dot, l2_norm

    q = F.array(*[F.lit(float(x)) for x in query_vector])
    qn = float(np.linalg.norm(np.asarray(query_vector, dtype=np.float64)))
    score = F.round((F.lit(1.0) + dot(vec_col, q) / F.nullif(l2_norm(vec_col) * F.lit(qn), F.lit(0.0))) / F.lit(2.0), 6)
    return (store.select(F.col(id_col).alias(id_col), score.alias("score"))
            .where(F.col("score") >= min_score)
            .orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(k))
