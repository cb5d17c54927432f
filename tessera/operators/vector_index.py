"""A stored index for approximate similarity search: coarse lists of
product-quantised vectors.

*Build.*  Centroids come from rounds of k-means that Spark runs: tasks add up
their vectors by nearest centroid, and only those sums (numbers of lists and
dimensions) reach the driver.  What a vector differs from its centroid by is
cut into sub-vectors, each replaced by the nearest of a few code words, trained
in the same way.  Rows are stored by list number, a partition column.

*Search.*  A query looks only into the lists whose centroids are nearest; the
other lists' files are pruned by their partition.  There, every row is scored
by its codes: rows are decoded once by table look-up, and all queries are
multiplied with what the codes stand for.  Just the best few of every
:data:`SHORTLIST_ROWS` rows are scored by
their vectors.  The store is never shuffled: queries are broadcast in
blocks of checked size, and tasks send their best ``k`` rows a query.

Vectors are normalised when they are stored, so scores need no norms."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.operators.search import BROADCAST_QUERY_BYTES, _float_slack, _places, _raise_floor, _reduce_topk

#: Rows that the index is trained on at most, chosen by a hash of their ids; every row is indexed.
TRAIN_ROWS = 500_000
#: A shortlist is taken of so many rows of a list, so that recall doesn't fall as lists grow.
SHORTLIST_ROWS = 512
_CELLS = 4 * 1024 * 1024
# Scores by codes that are held at once, so that they stay in a core's cache, and rows among them (a whole number of shortlists).
_GUESS_CELLS = 512 * 1024
_GUESS_ROWS = 4 * SHORTLIST_ROWS


@dataclass(frozen=True)
class Model:
    """Unit centroids [list, dim] and code words [sub-vector, code, width]."""
    centroids: np.ndarray
    words: np.ndarray

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def lists(self, units: np.ndarray) -> np.ndarray:
        return _nearest(units[:, None, :], self.centroids[None])[:, 0]

    def rest(self, units: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """What is left of the vectors without their centroids, by sub-vector."""
        return (units - self.centroids[lists]).reshape(len(units), len(self.words), -1)

    def decode(self, number: int, codes: np.ndarray) -> np.ndarray:
        """What the codes of rows of a list stand for."""
        return self.centroids[number] + self.words[np.arange(len(self.words)), codes].reshape(len(codes), self.dim)


def _nearest(parts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Number of the nearest word (least distance, then least number) of each part: parts [row, sub, width]."""
    out = np.empty(parts.shape[:2], np.int64)
    half = 0.5 * (words ** 2).sum(2)
    step = max(1, _CELLS // words.shape[1])
    for a in range(0, len(parts), step):
        for s in range(len(words)):
            out[a:a + step, s] = np.argmax(parts[a:a + step, s] @ words[s].T - half[s], axis=1)
    return out


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), dim)


def unit_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """``_id, _v``: vectors of width ``dim`` without nulls, at length one.  Others, and vectors of length zero or
    that isn't finite, have no direction: they are left out and match nothing, as in the exact search."""
    raw = df.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v")).where(
        (F.size("_v") == dim) & ~F.exists("_v", lambda x: x.isNull()))
    kind = T.StructType([raw.schema["_id"], T.StructField("_v", T.ArrayType(T.FloatType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(1), dim)
            with np.errstate(all="ignore"):
                unit = m / np.linalg.norm(m, axis=1, keepdims=True)
            good = np.isfinite(unit).all(1) & (np.abs(unit).max(1, initial=0) > 0)
            flat = pa.array(unit[good].astype(np.float32).ravel())
            offsets = pa.array(np.arange(0, (int(good.sum()) + 1) * dim, dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), pa.ListArray.from_arrays(offsets, flat)], names=["_id", "_v"])

    return raw.mapInArrow(run, kind)


def _lloyd(units: DataFrame, words: np.ndarray, rounds: int, on_sphere: bool, parts_of) -> np.ndarray:
    """Rounds of k-means over ``parts_of(matrix)`` [row, sub, width].  A task sends one sum a word; a word without
    parts stays.  Sums are rounded to 9 places, so their order hardly matters."""
    n_sub, n_words, width = words.shape
    for _ in range(rounds):
        shared = units.sparkSession.sparkContext.broadcast(words)

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now = shared.value
            sums, counts = np.zeros((n_sub * n_words, width)), np.zeros(n_sub * n_words, np.int64)
            for batch in batches:
                parts = parts_of(batch.column(0))
                at = (_nearest(parts, now) + np.arange(n_sub) * n_words).ravel()
                np.add.at(sums, at, parts.reshape(-1, width))
                counts += np.bincount(at, minlength=len(counts))
            met = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(met, width)), pa.array(np.tile(np.arange(width), len(met))),
                                              pa.array(sums[met].ravel()), pa.array(np.repeat(counts[met], width))], names=["w", "p", "total", "n"])

        rows = (units.select("_v").mapInArrow(add, "w long, p long, total double, n long").groupBy("w", "p")
                .agg(F.round(F.sum("total"), 9).alias("total"), F.sum("n").alias("n")).collect())  # at most words x width rows
        words = words.copy()
        for r in rows:
            words[r.w // n_words, r.w % n_words, r.p] = r.total / r.n
        if on_sphere:
            norm = np.linalg.norm(words, axis=2, keepdims=True)
            words = words / np.where(norm > 0, norm, 1)
        shared.destroy()
    return words


def train(units: DataFrame, dim: int, n_lists: int, n_sub: int, n_codes: int, rounds: int = 6) -> Model:
    """Centroids and code words from ``units`` (of :func:`unit_vectors`), or from :data:`TRAIN_ROWS` of them by a hash of the ids."""
    from tessera.session import cut_lineage

    if dim % n_sub:
        raise ValueError(f"{n_sub} sub-vectors don't divide {dim} dimensions")
    share = min(1.0, TRAIN_ROWS / max(1, units.count()))
    sample = cut_lineage(units.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < F.lit(share * (1 << 20))))
    seeds = [r._v for r in sample.orderBy(F.xxhash64("_id", F.lit(1)), "_id").limit(max(n_lists, n_codes)).collect()]
    if not seeds:
        return Model(np.zeros((n_lists, dim)), np.zeros((n_sub, n_codes, dim // n_sub)))
    first = np.array(seeds, np.float64)
    centroids = _lloyd(sample, np.resize(first, (n_lists, dim))[None], rounds, True, lambda c: _matrix(c, dim)[:, None, :])[0]
    coarse = Model(centroids, np.zeros((n_sub, 1, dim // n_sub)))

    def rest(col):
        units = _matrix(col, dim)
        return coarse.rest(units, coarse.lists(units))
    start = coarse.rest(first, coarse.lists(first))
    words = np.resize(start, (n_codes, n_sub, dim // n_sub)).transpose(1, 0, 2).copy()
    return Model(centroids, _lloyd(sample, words, rounds, False, rest))


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    rows = [("list", 0, k, v.tolist()) for k, v in enumerate(model.centroids)] + [("word", s, k, v.tolist()) for s, book in enumerate(model.words) for k, v in enumerate(book)]
    spark.createDataFrame(rows, "kind string, sub int, number int, vector array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> Model:
    """The stored centroids and code words: (lists + codes) x dimensions numbers."""
    rows = spark.read.parquet(f"{path}/model").orderBy("kind", "sub", "number").collect()
    lists = np.array([r.vector for r in rows if r.kind == "list"])
    words = [r for r in rows if r.kind == "word"]
    n_sub = max(r.sub for r in words) + 1
    return Model(lists, np.array([r.vector for r in words]).reshape(n_sub, len(words) // n_sub, -1))


def append_index(df: DataFrame, path: str, *, id_col: str = "id", vec_col: str = "embedding", rows_per_file: int = 1_000_000) -> None:
    """Adds rows to a built index: ``id, codes, embedding`` (length one) by list.  A list of many rows is
    written by several tasks."""
    spark = df.sparkSession
    model = load_model(spark, path)
    shared = spark.sparkContext.broadcast(model)
    units = unit_vectors(df, id_col, vec_col, model.dim)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            units = _matrix(batch.column(1), m.dim)
            lists = m.lists(units)
            codes = _nearest(m.rest(units, lists), m.words).astype(np.uint8)
            flat = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists.astype(np.int32)), flat, batch.column(1)], names=["id", "list", "codes", "embedding"])

    if model.words.shape[1] > 256:
        raise ValueError("codes are bytes: at most 256 code words")
    kind = T.StructType([T.StructField("id", units.schema["_id"].dataType), T.StructField("list", T.IntegerType()),
                         T.StructField("codes", T.BinaryType()), T.StructField("embedding", T.ArrayType(T.FloatType(), False))])
    rows = units.mapInArrow(encode, kind)
    files = max(1, math.ceil(df.count() / len(model.centroids) / rows_per_file))
    rows = rows.repartition(F.col("list"), F.pmod(F.xxhash64("id"), F.lit(files))).sortWithinPartitions("list", "id")
    rows.write.mode("append").partitionBy("list").parquet(f"{path}/rows")


def build_index(df: DataFrame, path: str, *, dim: int, n_lists: int, n_sub: int = 32, n_codes: int = 16, rounds: int = 6,
                id_col: str = "id", vec_col: str = "embedding") -> Model:
    """Trains and stores an index of ``df`` at ``path`` and returns its model.  Repeated rows are stored as
    often as they come; rows without a usable vector are left out."""
    model = train(unit_vectors(df, id_col, vec_col, dim), dim, n_lists, n_sub, n_codes, rounds)
    save_model(df.sparkSession, model, path)
    append_index(df, path, id_col=id_col, vec_col=vec_col)
    return model


def index_rows(spark: SparkSession, path: str, lists: list[int] | None = None) -> DataFrame:
    """Stored rows; of ``lists`` only, by their partitions."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows if lists is None else rows.where(F.col("list").isin([int(x) for x in lists]))


def score_list(units: np.ndarray, model: Model, number: int, codes: np.ndarray, stored: np.ndarray, ids: np.ndarray, k: int,
               shortlist: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best ``k`` rows of one list for each query (its place, id, score) at its ``least`` score or more, and how many rows a
    query was scored against by vectors (``stored``, FLOAT).  All rows are scored by their codes first, by distance: no codes of a list are
    nearer to a vector than its own, so a stored query meets itself.  Of the shortlist, rows that are
    among the best by FLOAT products get their scores by DOUBLE ones."""
    names, named = np.unique(ids, return_inverse=True)
    once = len(names) == len(ids)
    coarse, wide, exact = units.astype(np.float32), np.column_stack([units, np.ones(len(units))]), stored.astype(np.float64)
    least, slack = least.copy(), _float_slack(model.dim)
    out, scored = [], 0
    for lo in range(0, len(ids), _GUESS_ROWS):
        decoded = model.decode(number, codes[lo:lo + _GUESS_ROWS])
        decoded = np.vstack([decoded.T, -0.5 * (decoded ** 2).sum(1)])
        n = decoded.shape[1]
        keep = min(shortlist * math.ceil(n / SHORTLIST_ROWS), n)
        scored += keep
        step = max(1, _GUESS_CELLS // max(n, keep * model.dim))
        for a in range(0, len(units), step):
            q = coarse[a:a + step]
            # as FLOAT, rows of the same codes are level whatever the order of additions
            best = lo + _best((wide[a:a + step] @ decoded).astype(np.float32), keep)
            cos = np.einsum("qd,qtd->qt", q, np.take(stored, best, axis=0))
            floor = 2 * least[a:a + step] - 1
            if keep > k and once:  # only what may be among the k best
                floor = np.maximum(floor, np.partition(cos, keep - k, axis=1)[:, keep - k])
                least[a:a + step] = np.maximum(least[a:a + step], (1 + floor - slack) / 2 - 1e-6)
            place, at = np.nonzero(cos >= (floor - slack)[:, None])
            rows, place = best[place, at], place + a
            score = np.round((1 + np.einsum("nd,nd->n", units[place], exact[rows])) / 2, 6)
            hit = score >= least[place]
            out.append((place[hit], named[rows[hit]], score[hit]))
    place, found, score = _reduce_topk(*(np.concatenate(x) for x in zip(*out)), k)
    return place, names[found], score, scored


def _best(guess: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` greatest of each row, of equal ones the first."""
    n = guess.shape[1]
    if keep == n:
        return np.tile(np.arange(n), (len(guess), 1))
    row, at = np.divmod(_places(guess >= np.partition(guess, n - keep, axis=1)[:, n - keep, None]), n)
    if len(row) > keep * len(guess):  # ties with the last
        order = np.lexsort((at, -guess[row, at], row))
        row, at = row[order], at[order]
        at = at[np.arange(len(row)) - np.searchsorted(row, row) < keep]
    return at.reshape(len(guess), keep)


def index_topk(spark: SparkSession, path: str, queries: DataFrame, k: int, *, n_probe: int, shortlist: int = 6, min_score: float = 0.0,
               query_id_col: str = "query_id", query_vec_col: str = "embedding") -> DataFrame:
    """``query_id, id, score, rank, n_scored``: approximate top-``k`` by cosine relevance ``(1+cos)/2``, rounded to 6 places,
    ties by id.  A query looks into the ``n_probe`` nearest lists; of each, the best ``shortlist`` rows by codes for every
    :data:`SHORTLIST_ROWS` rows or part of them (of an Arrow batch) are scored by their vectors, which ``n_scored`` counts.

    Queries go to all executors in blocks of at most ``BROADCAST_QUERY_BYTES``; each block reads the lists that it
    probes.  Queries with null, zero or odd vectors have no hits; a repeated query id is one query with several vectors' hits.
    An index without rows gives no hits."""
    model = load_model(spark, path)
    units = unit_vectors(queries, query_id_col, query_vec_col, model.dim)
    blocks = max(1, math.ceil(units.count() * model.dim * 8 / BROADCAST_QUERY_BYTES))
    id_type, qid_type = index_rows(spark, path).schema["id"].dataType, units.schema["_id"].dataType
    kind = T.StructType([T.StructField("_qid", qid_type), T.StructField("_id", id_type), T.StructField("score", T.DoubleType()), T.StructField("_n", T.LongType())])
    found = None
    for b in range(blocks):
        part = units.where(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == b).toArrow()
        qids = part.column("_id").to_numpy()
        matrix = _matrix(part.column("_v").combine_chunks(), model.dim) if part.num_rows else np.zeros((0, model.dim))
        near = np.argsort(-(matrix @ model.centroids.T), axis=1, kind="stable")[:, :n_probe]
        shared = spark.sparkContext.broadcast((qids, matrix, near, model))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            qids, matrix, near, model = shared.value
            held = (np.zeros(0, np.int64), None, np.zeros(0))
            least, scored = np.full(len(qids), float(min_score)), np.zeros(len(qids), np.int64)
            for batch in batches:
                lists = batch.column(1).to_numpy(zero_copy_only=False)
                for number in np.unique(lists):
                    rows = batch.filter(pa.array(lists == number))
                    asking = np.flatnonzero((near == number).any(1))
                    if not len(asking):
                        continue
                    codes = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint8).reshape(len(rows), -1)
                    stored = rows.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), model.dim)
                    place, ids, score, n = score_list(matrix[asking], model, int(number), codes, stored,
                                                      rows.column(0).to_numpy(zero_copy_only=False), k, shortlist, least[asking])
                    scored[asking] += n
                    known = ids[:0] if held[1] is None else held[1]
                    held = _reduce_topk(np.concatenate([held[0], asking[place]]), np.concatenate([known, ids]), np.concatenate([held[2], score]), k)
                    _raise_floor(least, held[0], held[2], k)
            place, ids, score = held[0], np.zeros(0, object) if held[1] is None else held[1], held[2]
            first = np.r_[True, place[1:] != place[:-1]] if len(place) else np.zeros(0, bool)
            count = np.where(first, scored[place], 0)
            yield pa.RecordBatch.from_arrays([pa.array(qids[place].tolist(), to_arrow_type(qid_type)), pa.array(ids.tolist(), to_arrow_type(id_type)),
                                              pa.array(score), pa.array(count.astype(np.int64))], names=["_qid", "_id", "score", "_n"])

        hits = index_rows(spark, path, np.unique(near).tolist()).select("id", "list", "codes", "embedding").mapInArrow(run, kind)
        found = hits if found is None else found.unionByName(hits)
    by = Window.partitionBy("_qid").orderBy(F.col("score").desc(), F.col("_id").asc())
    return (found.withColumn("rank", F.row_number().over(by)).withColumn("n_scored", F.sum("_n").over(Window.partitionBy("_qid"))).where(F.col("rank") <= k)
            .select(F.col("_qid").alias(query_id_col), F.col("_id").alias("id"), "score", F.col("rank").cast("int").alias("rank"), "n_scored"))
