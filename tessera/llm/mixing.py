"""Mixing sources to target weights with hash-threshold histograms.

Every row has a 60-bit hash of its id.  A source's share is a threshold on
that hash: token sums by source and hash bucket tell the bucket in which the
budget ends, only that bucket is counted again with finer buckets, and after
the last round the threshold is exact.  Larger budgets give supersets
(nested thresholds); no rows are sorted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

BITS, STEP = 60, 12


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def id_hash(key: Column) -> Column:
    """The first 60 bits of the md5 of the id as text (null: of the empty text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def ordinal(keys: DataFrame, col: str) -> DataFrame:
    """``keys`` (distinct values in ``col``) with ``_rank`` from 0 in code point
    order, null last: ranges are numbered apart and shifted by the sizes of
    the ranges before, so no task holds all keys."""
    order = [F.col(col).isNull(), F.col(col)]
    ranges = cut_lineage(keys.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(before, F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (ranges.withColumn("_place", place).join(shifts, "_range")
            .withColumn("_rank", F.col("_shift") + F.col("_place") - 1).drop("_range", "_place", "_shift"))


def source_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: the sum of all sizes
    shared by weight, where no target exceeds ``most`` times its source and what is
    over goes to the others by weight, until none is above."""
    picks = F.array(*[F.lit(w) for w in weights])
    told = cut_lineage(ordinal(sources, "source").withColumn("w", F.element_at(picks, (F.col("_rank") % len(weights) + 1).cast("int"))))
    exact = "decimal(38,0)"
    total = told.agg(F.sum("source_size")).first()[0] or 0
    full, num, den = -1, total, None
    capped = F.lit(False)
    while True:  # a source once capped stays capped, so this ends
        x = told.agg(F.sum(F.when(capped, 1).otherwise(0)), F.sum(F.when(capped, F.col("source_size")).otherwise(0)),
                     F.sum(F.when(~capped, F.col("w")).otherwise(0))).first()
        if (x[0] or 0) == full:
            break
        full, num, den = x[0] or 0, total - most * (x[1] or 0), x[2] or 0
        if not den:
            break
        capped = (F.lit(num).cast(exact) * F.col("w")) > (F.col("source_size").cast(exact) * (most * den))
    if not total or not den:
        return told.withColumn("target", F.col("source_size").cast("double")).drop("_rank", "w")
    share = F.lit(float(num)) * F.col("w") / F.lit(float(den))
    return told.withColumn("target", F.when(capped, (F.col("source_size") * most).cast("double")).otherwise(share)).drop("_rank", "w")


def mix_thresholds(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """By source of ``rows`` (source, size, _h): ``source_size``, ``target``, ``base`` (times
    that all its rows are taken), ``rest`` (words still to take), ``prefix`` (the
    threshold), ``below`` (words under it) and ``last`` (words on it)."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")
    zero = F.lit(0).cast("long")
    told = cut_lineage(source_targets(sources, weights, most).withColumn("base", base)
                       .withColumn("rest", F.greatest(F.col("target") - F.col("base") * F.col("source_size"), F.lit(0.0)))
                       .withColumns({"prefix": zero, "below": zero, "last": zero}))
    for shift in range(BITS - STEP, -1, -STEP):
        bounds = told.select(F.col("source").alias("_s"), "prefix", "below", "rest")
        inside = (rows.join(bounds, F.col("source").eqNullSafe(F.col("_s")))
                  .where(F.shiftright("_h", shift + STEP) == F.col("prefix")))
        sums = (inside.groupBy("source", F.shiftright("_h", shift).alias("_b"))
                .agg(F.sum("size").alias("_n"), F.max("below").alias("_below"), F.max("rest").alias("_rest")))
        upto = F.sum("_n").over(Window.partitionBy("source").orderBy("_b"))  # at most 2 ** STEP rows a source
        ends = (sums.withColumn("_upto", F.col("_below") + upto).where(F.col("_upto") >= F.col("_rest"))
                .groupBy("source").agg(F.min(F.struct("_b", "_upto", "_n")).alias("_e"))
                .select(F.col("source").alias("_s"), F.col("_e._b").alias("_b"), F.col("_e._n").alias("_n"),
                        (F.col("_e._upto") - F.col("_e._n")).alias("_under")))
        told = cut_lineage(told.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "source_size", "target", "base", "rest", F.coalesce("_b", F.lit(0)).alias("prefix"),
            F.coalesce("_under", F.lit(0)).alias("below"), F.coalesce("_n", F.lit(0)).alias("last")))
    return told


def _with_copies(rows: DataFrame, told: DataFrame, source: Column, h: Column) -> DataFrame:
    """``rows`` with ``_t`` (its source's threshold row) and ``_copies``.  The
    thresholds are a written table with one row a source, which Spark
    broadcasts when its size allows and joins by shuffle otherwise."""
    bounds = told.select(F.col("source").alias("_s"), F.struct(*[c for c in told.columns if c != "source"]).alias("_t"))
    t = {c: F.col("_t").getField(c) for c in told.columns if c != "source"}
    on_edge = (h == t["prefix"]) & (t["last"] <= 2 * (t["rest"] - t["below"]))
    more = (t["source_size"] > 0) & (t["rest"] > 0) & ((h < t["prefix"]) | on_edge)
    return rows.join(bounds, source.eqNullSafe(F.col("_s"))).withColumn("_copies", t["base"] + more.cast("long"))


def _measured(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return cut_lineage(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                                   n_words(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("_h")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row per input row: ``id_col``, ``source``, ``size`` (words), ``source_size``,
    ``target``, ``copies`` (times the mix takes the row) and ``taken`` (words).

    Sources in code point order, null (a source of its own) last, take
    ``weights`` in turn.  All rows of a source are taken ``floor(target / source_size)``
    times, and those below its hash threshold once more; the rows on the
    threshold are taken if that leaves the sum nearer to the target.  Rows with
    equal ids have equal hashes and share their fate.  Rows without words count
    0; a source without words is taken once.  Only the three named columns are
    read."""
    rows = _measured(docs, id_col, source_col, text_col)
    mixed = _with_copies(rows, mix_thresholds(rows, weights, most), F.col("source"), F.col("_h"))
    return mixed.select(F.col("_id").alias(id_col), "source", "size", F.col("_t.source_size").alias("source_size"),
                        F.col("_t.target").alias("target"), F.col("_copies").alias("copies"),
                        (F.col("size") * F.col("_copies")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as the mix takes it.
    Texts are not shuffled: a row's hash and its source's threshold decide."""
    told = mix_thresholds(_measured(docs, id_col, source_col, text_col), weights, most)
    whole = docs.select(F.struct("*").alias("_doc"), F.col(source_col).alias("_source"), id_hash(F.col(id_col)).alias("_h"))
    mixed = _with_copies(whole, told, F.col("_source"), F.col("_h"))
    return mixed.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*")
