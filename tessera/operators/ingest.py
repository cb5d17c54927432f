"""Ingest: content ids, first-wins de-duplication, store anti-join, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import content_uuid


def with_content_id(df: DataFrame, avoid_dups: bool = True, *, text_col: str = "text",
                    id_col: str = "id") -> DataFrame:
    """Name-based UUID of the text when de-duplicating, else a random UUID."""
    return df.withColumn(id_col, content_uuid(text_col) if avoid_dups else F.expr("uuid()"))


def dedup_first(df: DataFrame, order_cols: list[str], *, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Keep the first row per id by ``order_cols``; return (kept, duplicates).

    ``min_by`` is a partial aggregate: each map task collapses its copies
    before the shuffle, so an id that holds a third of all rows costs one row
    per task, not a third of the data in one task.
    """
    payload = [c for c in df.columns if c != id_col]
    order = F.struct(*[F.col(c) for c in order_cols])
    kept = (df.groupBy(id_col)
            .agg(F.min_by(F.struct(*[F.col(c) for c in payload]), order).alias("_r"))
            .select(id_col, "_r.*"))
    key = [id_col] + order_cols
    dups = df.join(kept.select(*key), key, "left_anti")
    return kept, dups


def drop_existing(df: DataFrame, existing_ids: DataFrame | None, *, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(new rows, rows whose id is already stored)."""
    if existing_ids is None:
        return df, df.limit(0)
    ids = existing_ids.select(F.col(id_col)).distinct()
    return df.join(ids, id_col, "left_anti"), df.join(ids, id_col, "left_semi")
