"""Exact de-duplication by content-defined chunk recipes.

A text is cut into chunks at positions its own characters decide (sentence
ends and line ends, with a least and a greatest chunk length), every distinct
chunk travels once to be verified, and whole texts are then compared as
ordered lists of chunk identifiers, which are about a thirtieth of the text.
Everything on the path is built-in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT_AFTER = "\\n.!?。！？"


def normalise(text: Column) -> Column:
    """Null becomes the empty text; A-Z (only) are lower-cased.  A text of
    ASCII alone takes the faster ``lower``, which does the same there."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, _UPPER, _LOWER)))


def chunks(text: Column, shortest: int = 256, longest: int = 4096) -> Column:
    """Content-defined chunks: each ends at the first sentence or line end from
    its ``shortest``-th character on, or at ``longest`` characters.  Joined
    they give the text; the empty text has none.  The quantifiers are
    possessive, so the pattern never goes back."""
    pattern = f"(?s).{{1,{shortest - 1}}}+[^{CUT_AFTER}]{{0,{longest - shortest}}}+.?"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_id(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shortest: int = 256, longest: int = 4096, identify=chunk_id) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id`` (largest id of the equal
    texts), ``group_size``, ``kept``, ``text_sha256`` (of the normalised text).

    Texts are equal when identical after lower-casing A-Z.  Null and empty
    texts are equal to each other; a null id ranks below all others; of rows
    that repeat id and text exactly one is kept.  Other columns are not read,
    so their names cannot clash.  An empty table gives an empty result.

    ``identify`` maps a chunk to a 64-bit identifier.  Identifiers are verified
    against the chunk texts; where one stands for several texts, the texts'
    ranks join the recipe, so equal recipes always mean equal texts."""
    text = docs.select(F.col(id_col).alias("_id"), normalise(F.col(text_col)).alias("_text"))
    cut = text.select("_id", F.sha2("_text", 256).alias("_sha"), chunks(F.col("_text"), shortest, longest).alias("_chunks"))
    # Written once: the recipes are read without the chunks, the chunks without cutting again.
    cut = cut_lineage(cut.select("*", F.monotonically_increasing_id().alias("_row"), F.transform("_chunks", identify).alias("_recipe")))
    rows = cut.drop("_chunks")

    pieces = cut.select("_sha", F.posexplode("_chunks").alias("_pos", "_chunk")).withColumn("_h", identify(F.col("_chunk")))
    distinct = pieces.select("_h", "_chunk").distinct()
    shared = cut_lineage(distinct.groupBy("_h").count().where("count > 1").select("_h"))
    keys = ["_recipe"]
    if not shared.isEmpty():
        rank = F.row_number().over(Window.partitionBy("_h").orderBy("_chunk"))
        ranks = distinct.join(shared, "_h").withColumn("_rank", rank)
        patches = (pieces.join(ranks, ["_h", "_chunk"]).groupBy("_sha")
                   .agg(F.sort_array(F.collect_set(F.struct("_pos", "_rank"))).alias("_patch")))
        rows = rows.join(patches, "_sha", "left").withColumn("_patch", F.coalesce("_patch", F.expr("array()").cast("array<struct<_pos:int,_rank:int>>")))
        keys.append("_patch")

    groups = cut_lineage(rows.groupBy(*keys)
                         .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("_id", "_row")).alias("_keep"))
                         .where("_n > 1"))
    alone = F.col("_n").isNull()
    return rows.join(groups, keys, "left").select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep._row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows that :func:`exact_dedup` drops."""
    kept = (exact_dedup(docs, id_col, text_col).where("kept")
            .select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")))
    keyed = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_key_id"), F.sha2(normalise(F.col(text_col)), 256).alias("_key_sha"))
    matched = keyed.join(kept, F.col("_key_id").eqNullSafe(F.col("_id")) & (F.col("_key_sha") == F.col("_sha")))
    # Rows that repeat id and text all match; the window reuses the join's order.
    first = F.row_number().over(Window.partitionBy("_key_id", "_key_sha").orderBy(F.lit(1)))
    return matched.withColumn("_first", first).where("_first = 1").select("_doc.*")
