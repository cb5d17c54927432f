"""Small planning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Round-robin an input that has fewer splits than the cluster has cores.

    A small file is often a single parquet row group, i.e. one task, which
    leaves every other core idle during text-heavy work.  Planning tells the
    number of splits, so nothing runs for the decision; a large input has many
    splits and is left as it is."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * per_core) if df.rdd.getNumPartitions() < cores else df


def own_hash(df: DataFrame, skip: tuple[str, ...] = ()) -> F.Column:
    """Hash of a row's own values, to order rows that are equal in all that matters; rows
    that are equal in it are interchangeable."""
    cols = []
    for f in df.schema.fields:
        if f.name not in skip:
            c = F.col("`" + f.name.replace("`", "``") + "`")
            cols.append(F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c)
    return F.xxhash64(*cols) if cols else F.lit(0)


def _place(keys: list[str], bucket: F.Column) -> F.Column:
    """Key and bucket as one struct, in which a null equals a null: rows with null keys or in the
    bucket of null are rows like others."""
    return F.struct(F.struct(*[F.col(k) for k in keys]).alias("key"), bucket.alias("bucket"))


def ranked(df: DataFrame, keys: list[str], order_cols: list[str], bucket: F.Column,
           out_col: str = "rn") -> DataFrame:
    """``row_number()`` over ``keys`` ordered by ``order_cols`` without putting
    a whole key into one task.

    ``bucket`` must be non-decreasing in the order (e.g. ``seq div 4096`` or
    the hour of ``ts``).  Rows are numbered within (key, bucket) and shifted
    by the number of rows in the key's earlier buckets, taken from a partial
    aggregate: a key holding a third of all rows is spread over its buckets.
    Every row is numbered: null keys are a key, nulls come first in the order, ties are broken by the
    rows' own values.
    """
    from pyspark.sql import Window

    b = df.withColumn("_place", _place(keys, bucket))
    counts = b.groupBy("_place").agg(F.count(F.lit(1)).alias("_n"))
    w_b = (Window.partitionBy("_place.key").orderBy("_place.bucket")
           .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_place", F.coalesce(F.sum("_n").over(w_b), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_place").orderBy(*order_cols, own_hash(df))
    local = b.withColumn("_rn", F.row_number().over(w))
    return (local.join(offsets, "_place")
            .withColumn(out_col, (F.col("_off") + F.col("_rn")).cast("int"))
            .drop("_place", "_off", "_rn"))


def previous_value(df: DataFrame, keys: list[str], order_cols: list[str], value_col: str,
                   bucket: F.Column, out_col: str) -> DataFrame:
    """``lag(value_col)`` over ``keys`` ordered by ``order_cols`` without putting
    a whole key into one task: ``lag`` within (key, bucket); the first row of
    a bucket takes the last value of the key's previous non-empty bucket
    (a partial ``max_by`` aggregate, then a window over buckets only).  Null keys are a key,
    nulls come first in the order; no row is lost."""
    from pyspark.sql import Window

    b = df.withColumn("_place", _place(keys, bucket))
    w = Window.partitionBy("_place").orderBy(*order_cols)
    local = (b.withColumn("_lag", F.lag(value_col).over(w))
             .withColumn("_first", F.row_number().over(w) == 1))
    last = b.groupBy("_place").agg(
        F.max_by(value_col, F.struct(*[F.col(c) for c in order_cols])).alias("_last"))
    w_b = Window.partitionBy("_place.key").orderBy("_place.bucket")
    carry = last.select("_place", F.lag("_last").over(w_b).alias("_carry"))
    return (local.join(carry, "_place")
            .withColumn(out_col, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
            .drop("_place", "_lag", "_first", "_carry"))


def max_by_key(df: DataFrame, keys: list[str], value_col: str, bucket_col: str, out_col: str) -> DataFrame:
    """``max(value_col)`` over ``keys`` for every row without putting a whole key
    into one task: the maxima of (key, bucket) (a partial aggregate), then a
    window over buckets only, which meets the rows by (key, bucket).  Null keys are a key; no row is lost."""
    from pyspark.sql import Window

    b = df.withColumn("_place", _place(keys, F.col(bucket_col)))
    most = b.groupBy("_place").agg(F.max(value_col).alias("_most"))
    most = most.select("_place", F.max("_most").over(Window.partitionBy("_place.key")).alias(out_col))
    return b.join(most, "_place").drop("_place")
