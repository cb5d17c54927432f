"""Vector store as a partitioned parquet dataset.

Layout: ``<path>/store=<name>/namespace=<ns>/part-*.parquet`` with columns
``id, embedding ARRAY<FLOAT>, text, metadata MAP<STRING,STRING>`` and, where
written, ``lsh_codes``.  A row's identity is store, namespace and id.  Collections / namespaces are partition
columns, so selecting one is partition pruning; appends never rewrite
existing files.  A bucketed store has a further level ``bucket=<two digits of the id's MD5>`` and
membership filters beside it (:mod:`tessera.sources.id_filters`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage, ensure_checkpoint_dir
from tessera.sources.id_filters import admit, bucket_of, filters_path, note_ids

DEFAULT_NAMESPACE = "__default__"
DEFAULT_STORE = "Default"

STORE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("lsh_codes", T.ArrayType(T.IntegerType())),
    T.StructField("store", T.StringType()),
    T.StructField("namespace", T.StringType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{name}-{uuid.uuid4().hex}"


def store_name(name: str | None) -> str:
    """Blank store / class name -> ``Default``; otherwise trimmed."""
    n = (name or "").strip()
    return n or DEFAULT_STORE


def namespace_name(ns: str | None) -> str:
    """NULL / empty / ``__default__`` all mean the default namespace.  Parquet
    cannot tell '' from NULL in a partition path, so the literal is stored."""
    n = (ns or "").strip()
    return n or DEFAULT_NAMESPACE


def store_append(df: DataFrame, path: str, store: str | None = None,
                 namespace: str | None = None, *, namespace_col: str | None = None,
                 id_buckets: bool = False, noted: bool = False) -> None:
    """Append rows (``id, embedding, text, metadata``, if present ``lsh_codes``) to a store.

    ``namespace_col`` takes each row's namespace from a column, so one write
    (one pass over the input) fills several namespace partitions.  ``id_buckets``
    makes a new store a bucketed one, which it then is for all appends; its rows are
    dealt by bucket, and their ids told to the filters first (unless ``noted`` says that they have been)."""
    spark = df.sparkSession
    bucketed = uses_buckets(spark, path, id_buckets)
    if namespace_col is not None:
        ns = F.coalesce(F.nullif(F.trim(F.col(namespace_col)), F.lit("")), F.lit(DEFAULT_NAMESPACE))
        df = df.withColumn("namespace", ns)
        if namespace_col != "namespace":
            df = df.drop(namespace_col)
    else:
        df = df.withColumn("namespace", F.lit(namespace_name(namespace)))
    rows = (df.withColumn("store", F.lit(store_name(store)))
            .select(*[c for c in STORE_SCHEMA.names if c in df.columns or c == "store"]))
    if bucketed and not noted:
        rows = cut_lineage(rows)
        note_ids(rows.select("id", "store", "namespace"), path)
    _write_rows(rows, path, bucketed, "append")


def _write_rows(rows: DataFrame, path: str, bucketed: bool, mode: str) -> None:
    """Partitions of a bucketed store are written by few tasks each: Spark splits and joins them by size."""
    levels = ["store", "namespace"]
    if bucketed:
        rows = rows.withColumn("bucket", bucket_of(F.col("id"))).hint("rebalance", "namespace", "bucket")
        levels.append("bucket")
    # A dictionary of the vectors' numbers would soon be given up, after it was filled for each file.
    (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .option("parquet.enable.dictionary#embedding.list.element", "false").partitionBy(*levels).parquet(path))


def uses_buckets(spark: SparkSession, path: str, wanted: bool = False) -> bool:
    """Whether the store is bucketed, or will be as ``wanted``.  A store that began without buckets can't get them."""
    has = path_exists(spark, filters_path(path))
    if wanted and not has and path_exists(spark, path):
        raise ValueError("a store is bucketed from its first append on, or not at all")
    return has or wanted


def store_scan(spark: SparkSession, path: str, store: str | None = None,
               namespace: str | None = None, buckets: list[str] | None = None) -> DataFrame:
    """Read a store (:data:`STORE_SCHEMA`), or only some ``buckets`` of a bucketed one; the store / namespace predicates prune
    partitions.  The schema is given, so namespaces stay text (``7`` and ``007`` are
    two) and columns don't depend on which file is looked at first."""
    df = spark.read.schema(T.StructType([*STORE_SCHEMA.fields, T.StructField("bucket", T.StringType())])).parquet(path)
    if buckets is not None:
        df = df.where(F.col("bucket").isin(buckets))
    if store is not None:
        df = df.where(F.col("store") == store_name(store))
    if namespace is not None:
        df = df.where(F.col("namespace") == namespace_name(namespace))
    return df.select(*STORE_SCHEMA.names)


def compact_store(spark: SparkSession, path: str) -> int:
    """Leaves one row per identity (store, namespace, id) where a replayed or concurrent append has left several;
    returns the number of rows that went.  Only partitions with such rows are rewritten: first
    to the shared scratch folder, then in place of the old ones, so after a failure it is run again.  Of rows that
    differ, the first by its own values stays."""
    from pyspark.sql import Window

    from tessera.operators.util import own_hash

    rows = store_scan(spark, path)
    counts = rows.groupBy("store", "namespace", "id").agg(F.count(F.lit(1)).alias("_n"))
    bad = cut_lineage(counts.groupBy("store", "namespace").agg(F.sum(F.col("_n") - 1).alias("_more")).where("_more > 0"))
    more = bad.agg(F.sum("_more")).first()[0] or 0
    if more:
        one = Window.partitionBy("store", "namespace", "id").orderBy(own_hash(rows))
        kept = rows.join(bad.drop("_more"), ["store", "namespace"], "left_semi").withColumn("_copy", F.row_number().over(one)).where("_copy = 1").drop("_copy")
        kept = cut_lineage(kept.select(*rows.columns))
        _write_rows(kept, path, uses_buckets(spark, path), "overwrite")
    return more


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for
    any scheme the cluster is configured for)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def store_ids(spark: SparkSession, path: str | None, store: str | None = None,
              namespace: str | None = None) -> DataFrame | None:
    """Ids already in the store (``None`` when the store does not exist yet)."""
    if path is None or not path_exists(spark, path):
        return None
    return store_scan(spark, path, store, namespace).select("id")


def admit_ids(ids: DataFrame, path: str, store: str | None = None, namespace: str | None = None) -> DataFrame | None:
    """As :func:`store_ids`, of a bucketed store only the buckets that may hold one of ``ids`` (a written
    table with column ``id``); its filters learn the ids that they don't hold.  Rows with
    those ids may then be appended as ``noted``."""
    spark = ids.sparkSession
    known = path_exists(spark, filters_path(path))
    touched = admit(ids, path, store_name(store), namespace_name(namespace), known=known,
                    look_store=None if store is None else store_name(store),
                    look_namespace=None if namespace is None else namespace_name(namespace))
    if not path_exists(spark, path):
        return None
    return store_scan(spark, path, store, namespace, touched).select("id")


def save_snapshot(df: DataFrame, path: str) -> None:
    """Whole-store snapshot as JSON lines (one object per vector)."""
    df.write.mode("overwrite").json(path)


def load_snapshot(spark: SparkSession, path: str, schema: T.StructType = STORE_SCHEMA) -> DataFrame:
    """Load a snapshot with an explicit schema (never inferred)."""
    return spark.read.schema(schema).json(path)
