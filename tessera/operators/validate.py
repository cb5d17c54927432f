"""Decoding of JSON request payloads and row validation (quarantine codes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import errors as E

SEGMENT_SCHEMA = "array<struct<text:string,metadata:map<string,string>>>"
EMBEDDING_STRUCT = "struct<text:string,embedding:array<float>,metadata:map<string,string>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decode_segments(payload) -> Column:
    """JSON array of segments; anything else (plain text, ``[]``, broken JSON)
    becomes one segment holding the whole input with empty metadata."""
    p = _c(payload)
    arr = F.from_json(p, SEGMENT_SCHEMA)
    single = F.array(F.struct(p.alias("text"),
                              F.create_map().cast("map<string,string>").alias("metadata")))
    return F.when(F.coalesce(F.size(arr), F.lit(0)) > 0, arr).otherwise(single)


def decode_embeddings(payload) -> Column:
    """JSON array of embedding objects, or one object -> array of structs
    (NULL when neither parses)."""
    p = _c(payload)
    arr = F.from_json(p, f"array<{EMBEDDING_STRUCT}>")
    one = F.from_json(p, EMBEDDING_STRUCT)
    is_arr = F.ltrim(p).startswith("[")
    return F.when(is_arr, arr).otherwise(F.when(one.isNotNull(), F.array(one)))


def decode_query_vector(payload) -> Column:
    """JSON number array -> ARRAY<FLOAT>; NULL when empty or invalid."""
    v = F.from_json(_c(payload), "array<float>")
    return F.when(F.size(v) > 0, v)


def segment_error(text) -> Column:
    t = _c(text)
    return F.when(t.isNull() | (F.length(t) == 0), F.lit(E.INVALID_EMBED_INPUT))


def embedding_error(text, embedding, dim: int | None = None) -> Column:
    t, v = _c(text), _c(embedding)
    bad = t.isNull() | (F.length(t) == 0) | v.isNull() | (F.size(v) <= 0)
    if dim is not None:
        bad = bad | (F.size(v) != dim)
    return F.when(bad, F.lit(E.INVALID_INGEST))


def knowledge_error(embedding, embedded_text) -> Column:
    return F.when(_c(embedding).isNull() | _c(embedded_text).isNull(), F.lit(E.INVALID_KNOWLEDGE))


def request_mode(df: DataFrame, group_col: str, code_col: str = "error_code") -> DataFrame:
    """The original all-or-nothing rule: one bad row rejects its whole
    request (the first code of the group is given to every row)."""
    first_bad = df.groupBy(group_col).agg(F.min(code_col).alias("_req_code"))
    return (df.join(first_bad, group_col, "left")
            .withColumn(code_col, F.coalesce(F.col(code_col), F.col("_req_code")))
            .drop("_req_code"))
