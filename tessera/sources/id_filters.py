"""Which ids a bucketed store may hold, told by Bloom filters beside it.

A bucketed store is partitioned by the first two digits of its ids' MD5, and
``<path>-filters`` holds one row of 32,768 bits (the size of Spark's bitmaps) for each
block of ids of an append.  An append makes as many blocks as its own ids
need, so filters stay as selective as they are at the start while the
store grows.  Filters are written before the rows that they tell of: after a failure
between the two they say "maybe" once too often, never "no" wrongly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

BITS = 8 * 4096
#: At most so many ids a block: with four bits an id one foreign id in 450 passes a block's test.
PER_BLOCK = 2000
_HASHES = 4

FILTER_SCHEMA = T.StructType([
    T.StructField("digits", T.IntegerType()), T.StructField("block", T.StringType()), T.StructField("bits", T.BinaryType()),
    T.StructField("part", T.IntegerType()), T.StructField("store", T.StringType()), T.StructField("namespace", T.StringType())])


def filters_path(path: str) -> str:
    return f"{path.rstrip('/')}-filters"


def bucket_of(id_: Column) -> Column:
    """Two hexadecimal digits; null ids share the bucket of the empty one."""
    return F.substring(F.md5(F.coalesce(id_, F.lit(""))), 1, 2)


def _positions(digest: Column) -> list[Column]:
    """Bits of an id in its block, from other digits than those that name bucket and block."""
    return [F.conv(F.substring(digest, 17 + 4 * k, 4), 16, 10).cast("int") % BITS for k in range(_HASHES)]


def digits_for(n: int) -> int:
    """Hexadecimal digits of the block's name, so that ``n`` ids have about ``PER_BLOCK`` a block or fewer."""
    digits = 0
    while n > PER_BLOCK * 16 ** digits:
        digits += 1
    return digits


def _blocks(ids: DataFrame, digits: int) -> DataFrame:
    """``store, namespace, digits, block, bits`` of rows ``id, store, namespace``."""
    digest = ids.select("store", "namespace", F.md5("id").alias("_h"))
    spots = digest.select("store", "namespace", F.substring("_h", 1, digits).alias("block"), F.explode(F.array(*_positions(F.col("_h")))).alias("_spot"))
    return (spots.groupBy("store", "namespace", "block").agg(F.bitmap_construct_agg("_spot").alias("bits"))
            .withColumn("digits", F.lit(digits)))


def _write(blocks: DataFrame, path: str, part: int) -> None:
    (blocks.select("digits", "block", "bits", F.lit(part).alias("part"), "store", "namespace")
     .write.mode("append").partitionBy("part", "store", "namespace").parquet(filters_path(path)))


def note_ids(ids: DataFrame, path: str) -> None:
    """Filters for ``ids`` (``id, store, namespace``; null ids have none).  ``ids`` is read twice:
    give a written table."""
    ids = ids.where(F.col("id").isNotNull())
    _write(_blocks(ids, digits_for(ids.count())), path, 0)


def filters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILTER_SCHEMA).parquet(filters_path(path))


def perhaps_stored(ids: DataFrame, path: str, store: str | None = None, namespace: str | None = None) -> DataFrame:
    """``id, store, namespace``: those of ``ids`` (column ``id``) that a filter of the store
    and namespace (None: any) may hold.  Every stored id is among them."""
    told = filters(ids.sparkSession, path)
    for name, value in (("store", store), ("namespace", namespace)):
        if value is not None:
            told = told.where(F.col(name) == value)
    sizes = [r.digits for r in told.select("digits").distinct().collect()]  # a handful: one for each power of 16
    asked = (ids.where(F.col("id").isNotNull()).select("id", F.md5("id").alias("_h"), F.explode(F.array(*[F.lit(d) for d in sizes]).cast("array<int>")).alias("digits"))
             .withColumn("block", F.expr("substring(_h, 1, digits)")))
    met = asked.join(told.drop("part"), ["digits", "block"])
    for spot in _positions(F.col("_h")):
        byte = F.conv(F.hex(F.substr("bits", (spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        met = met.where(byte.bitwiseAND(F.pow(F.lit(2), spot % 8).cast("int")) != 0)
    return met.select("id", "store", "namespace").distinct()


def admit(ids: DataFrame, path: str, store: str, namespace: str, *, look_store: str | None, look_namespace: str | None,
          known: bool) -> list[str]:
    """Buckets to open for ``ids`` (a written table with column ``id``): those of ids that the filters of
    ``look_store`` and ``look_namespace`` (None: any) may hold; at most 256.  Then the filters of
    ``store`` and ``namespace`` learn the ids they don't hold.  ``known``: there are filters."""
    new, touched = ids.select("id"), []
    if known:
        maybe = cut_lineage(perhaps_stored(ids, path, look_store, look_namespace))
        touched = [r.b for r in maybe.select(bucket_of(F.col("id")).alias("b")).distinct().collect()]
        own = maybe.where((F.col("store") == store) & (F.col("namespace") == namespace))
        new = cut_lineage(new.join(own.select("id"), "id", "left_anti"))
    note_ids(new.withColumn("store", F.lit(store)).withColumn("namespace", F.lit(namespace)), path)
    return sorted(touched)


def compact_filters(spark: SparkSession, path: str) -> int:
    """One set of filters, sized for all stored ids, in place of one for each append; returns its
    number of blocks.  The new set is complete before the old ones go, and reading both is
    right, so after a failure it is run again.  Not beside an append."""
    from tessera.sources.vector_store import store_scan

    old = sorted(r.part for r in filters(spark, path).select("part").distinct().collect())
    ids = cut_lineage(store_scan(spark, path).select("id", "store", "namespace").where("id IS NOT NULL").distinct())
    blocks = cut_lineage(_blocks(ids, digits_for(ids.count())))
    _write(blocks, path, max(old, default=0) + 1)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for part in old:
        folder = hadoop.Path(f"{filters_path(path)}/part={part}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return blocks.count()
