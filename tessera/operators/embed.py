"""Embedding: a native feature-hashing embedder and a hook for user models.

The hashing embedder (feature hashing, Weinberger et al., ICML 2009) is a
deterministic baseline, not a semantic model: tokens are lower-cased runs of
letters/digits, bucket = first 32 bits of md5(token) mod ``dim``, the vector
is the L2-normalised bucket-count histogram.  Tokens are told apart in
the JVM; an Arrow UDF numbers them (the MD5 of each different token of a slice
of a batch) and builds the histograms (one vectorised ``np.bincount`` per slice,
no per-token Python).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.errors import EMBEDDING_GENERATION
from tessera.operators.memo import Memo, ask_once

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), TOKEN_SPLIT), lambda x: F.length(x) > 0)


def token_buckets(text, dim: int) -> Column:
    """array<int>: the hash bucket of every token, in token order."""
    return F.transform(tokens(text), lambda tok: F.pmod(
        F.conv(F.substring(F.md5(tok), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int"))


# Rows and tokens whose histograms are built at once, whatever Spark's batch.
SLICE_ROWS, SLICE_TOKENS = 1024, 512 * 1024


def histograms(buckets: pa.Array, dim: int) -> pa.Array:
    """The unit histogram of each list of bucket numbers; null where there is none."""
    lens = pc.fill_null(pc.list_value_length(buckets), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    parts, at, done = [], 0, 0
    while at < len(buckets):
        end = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, done + SLICE_TOKENS, side="right"))))
        end = min(end, len(buckets))
        n = end - at
        flat = buckets.slice(at, n).flatten().to_numpy(zero_copy_only=False)
        cells = np.repeat(np.arange(n, dtype=np.int64) * dim, lens[at:end]) + flat
        counts = np.bincount(cells, minlength=n * dim).reshape(n, dim).astype(np.float64)[lens[at:end] > 0]
        unit = (counts / np.linalg.norm(counts, axis=1, keepdims=True)).astype(np.float32)
        bounds = np.r_[0, np.cumsum(np.where(lens[at:end] > 0, dim, 0))].astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(unit.ravel()), mask=pa.array(lens[at:end] == 0)))
        at, done = end, ends[end - 1]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))


# Bytes of text that are cut into tokens at once: the more, the fewer tokens are hashed again.
SLICE_BYTES = 8 << 20


def numbered(words: pa.Array, dim: int) -> pa.Array:
    """As :func:`token_buckets`, of tokens that are joined by single blanks: array<int>, null for null."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    parts, at, done = [], 0, 0
    while at < len(words):
        end = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        found = pc.split_pattern(words.slice(at, end - at), " ")
        lens = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
        coded = found.flatten().dictionary_encode()
        tokens_ = coded.dictionary.cast(pa.binary()).to_pylist()
        heads = np.frombuffer(b"".join([md5(t).digest() for t in tokens_]), ">u4")[::4]
        numbers = np.where([t != b"" for t in tokens_], heads % dim, -1).astype(np.int32)
        flat = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        some = flat >= 0  # a blank at the begin or end has nothing on its other side
        bounds = np.r_[0, np.cumsum(some)][np.r_[0, np.cumsum(lens)]].astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat[some]), mask=pc.is_null(found)))
        at, done = end, ends[end - 1]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _histogram_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def histogram(words: pa.Array) -> pa.Array:
        return histograms(numbered(words, dim), dim)
    # Non-deterministic only to the optimizer: it must not copy the UDF into
    # a pushed-down filter (that would evaluate it twice, once before a
    # repartition on the unspread input).
    return histogram.asNondeterministic()


def hash_embed(df: DataFrame, dim: int = 256, *, text_col: str = "text",
               out_col: str = "embedding") -> DataFrame:
    """Add ``out_col`` ARRAY<FLOAT>(dim); NULL when the text has no token."""
    hist = _histogram_udf(dim)
    return (df.withColumn("_words", F.regexp_replace(F.lower(F.col(text_col)), TOKEN_SPLIT, " "))
            .withColumn(out_col, hist(F.col("_words"))).drop("_words"))


# Texts given to a model at once.
MODEL_ROWS = 512


def model_embed(df: DataFrame, embed_fn_factory: Callable[[], Callable[[list[str]], np.ndarray]],
                dim: int, *, text_col: str = "text", out_col: str = "embedding", code_col: str | None = None, memo: Memo | None = None) -> DataFrame:
    """Embed with a user model: the factory runs once per partition (load the
    model there), the model sees batches of at most ``MODEL_ROWS`` texts and returns a (batch, dim)
    matrix; row order is preserved.  The other columns pass by as Arrow.

    Null texts get a null vector and don't reach the model.  If a call fails, each
    text is tried alone; those that fail again get a null vector and, in
    ``code_col`` if named, 701161.  With ``memo`` a text is embedded once and its vector
    kept for later runs."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.FloatType()))])

    def vectors(fn, texts: list[str]) -> list:
        try:
            mat = np.asarray(fn(texts), dtype=np.float32)
        except Exception:  # noqa: BLE001 - whatever a model raises
            return [None] if len(texts) == 1 else [v for t in texts for v in vectors(fn, [t])]
        if mat.shape != (len(texts), dim):
            raise ValueError(f"embedder returned {mat.shape}, expected {(len(texts), dim)}")
        return list(mat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            for at in range(0, batch.num_rows, MODEL_ROWS):
                part = batch.slice(at, MODEL_ROWS)
                out = [None] * part.num_rows
                texts = part.column(text_col).to_pylist()
                some = [k for k, t in enumerate(texts) if t is not None]
                if some:
                    fn = fn or embed_fn_factory()
                    for k, v in zip(some, vectors(fn, [texts[k] for k in some])):
                        out[k] = v
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.list_(pa.float32()))], names=[*part.schema.names, out_col])

    def ask_factory():
        fn = embed_fn_factory()
        return lambda texts: vectors(fn, texts)

    if memo is not None:
        out = ask_once(df, memo, ask_factory, T.ArrayType(T.FloatType()), text_col=text_col, out_col=out_col)
    else:
        out = df.mapInArrow(run, schema)
    if code_col is not None:
        out = out.withColumn(code_col, F.when(F.col(text_col).isNotNull() & F.col(out_col).isNull(), F.lit(EMBEDDING_GENERATION)))
    return out


#: An embedder adds ARRAY<FLOAT> column ``out_col`` for ``text_col`` (null for null
#: texts); its attribute ``dim``, if it has one, is the vectors' width.
Embedder = Callable[..., DataFrame]


def _of_width(dim: int, embedder: Embedder) -> Embedder:
    embedder.dim = dim
    return embedder


def hashing_embedder(dim: int) -> Embedder:
    return _of_width(dim, lambda df, *, text_col="text", out_col="embedding": hash_embed(df, dim, text_col=text_col, out_col=out_col))


def model_embedder(embed_fn_factory: Callable[[], Callable[[list[str]], np.ndarray]], dim: int, memo: Memo | None = None) -> Embedder:
    return _of_width(dim, lambda df, *, text_col="text", out_col="embedding": model_embed(
        df, embed_fn_factory, dim, text_col=text_col, out_col=out_col, memo=memo))
