"""Bucketed stores: filters that never miss an id, and ingests that open only buckets they name."""

import pytest
from pyspark.sql import functions as F

from tessera.plans.knowledge import add_to_knowledge, add_to_store
from tessera.sources import id_filters as I
from tessera.sources.vector_store import (admit_ids, compact_store, scratch_path, store_append,
                                          store_scan, uses_buckets)

STORE = "id string, embedding array<float>, text string, metadata map<string,string>"


def rows(spark, ids):
    return spark.createDataFrame([(i, [1.0, 2.0], "t", None) for i in ids], STORE)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_digits_grow_with_the_ids():
    assert [I.digits_for(n) for n in (0, 1, 2000, 2001, 32000, 32001, 10**10)] == [0, 0, 0, 1, 1, 2, 6]


def test_no_stored_id_is_missed_and_few_others_pass(spark):
    path = scratch_path(spark, "filters")
    ids = spark.range(70000).select(F.concat(F.lit("id"), F.col("id")).alias("id"))
    own = ids.withColumn("store", F.lit("s")).withColumn("namespace", F.lit("n"))
    I.note_ids(own.where("id < 'id5'"), path)     # two digits
    I.note_ids(own.where("id >= 'id5' AND id < 'id51'"), path)  # 1,111 ids: none
    I.note_ids(spark.createDataFrame([(None, "s", "n")], "id string, store string, namespace string"), path)
    assert {r.digits for r in I.filters(spark, path).select("digits").distinct().collect()} == {0, 2}
    asked = ids.union(spark.createDataFrame([(None,), ("",)], "id string"))
    maybe = I.perhaps_stored(asked, path, "s", "n")
    held = ids.where("id < 'id51'")
    assert held.join(maybe, "id", "left_anti").count() == 0
    assert maybe.count() - held.count() < 0.01 * 70000
    assert I.perhaps_stored(asked, path, "s", "other").count() == 0 and I.perhaps_stored(asked, path).count() == maybe.count()


def test_an_ingest_opens_the_buckets_of_known_ids_only(spark):
    path = scratch_path(spark, "buckets")
    store_append(rows(spark, [f"i{k}" for k in range(3000)]), path, "kb", id_buckets=True)
    batch = spark.createDataFrame([("i7",), ("i7x",), ("i8x",)], "id string")
    found = admit_ids(batch, path, "kb")
    bucket = spark.range(1).select(I.bucket_of(F.lit("i7"))).first()[0]
    text = plan(found)
    assert f"(bucket#" in text and f" = {bucket})" in text and "PartitionFilters" in text
    got = {r.id for r in found.collect()}
    assert "i7" in got and len(got) < 60
    fresh = admit_ids(spark.createDataFrame([("never seen",)], "id string"), path, "kb")
    assert fresh.count() == 0
    assert I.perhaps_stored(spark.createDataFrame([("i7x",)], "id string"), path, "kb").count() == 1  # learnt


def test_replays_failures_and_namespaces(spark):
    path = scratch_path(spark, "buckets")
    docs = spark.createDataFrame([(k, f"text {k % 50}") for k in range(200)] + [(300, None)], "doc_id long, text string")
    how = dict(parse_docs=False, split=False, id_buckets=True)
    # Ids told to the filters by a run that stopped before it wrote its rows.
    I.note_ids(spark.createDataFrame([("lost",)], "id string").select("id", F.lit("kb").alias("store"), F.lit("__default__").alias("namespace")), path)
    assert add_to_knowledge(docs, path, "kb", None, **how) == {"written": 50, "duplicate": 150, "invalid": 1}
    assert add_to_knowledge(docs, path, "kb", None, **how) == {"written": 0, "duplicate": 200, "invalid": 1}
    I.note_ids(store_scan(spark, path).select(F.concat(F.lit("x"), "id").alias("id"), "store", "namespace"), path)
    more = spark.createDataFrame([(1, "text 1"), (2, "new")], "doc_id long, text string")
    assert add_to_knowledge(more, path, "kb", None, parse_docs=False, split=False) == {"written": 1, "duplicate": 1, "invalid": 0}
    assert add_to_knowledge(more, path, "kb", "other", **how) == {"written": 2, "duplicate": 0, "invalid": 0}
    assert store_scan(spark, path).columns == ["id", "embedding", "text", "metadata", "lsh_codes", "store", "namespace"]
    assert store_scan(spark, path).count() == 53 and store_scan(spark, path, "kb", "other").count() == 2


def test_vectors_given_and_rows_from_columns(spark):
    path = scratch_path(spark, "buckets")
    vectors = spark.createDataFrame([("a", [1.0], None), ("b", [2.0], None), ("a", [1.0], None)], "text string, embedding array<float>, metadata map<string,string>")
    assert add_to_store(vectors, path, "kb", id_buckets=True) == {"written": 2, "duplicate": 1, "invalid": 0}
    assert add_to_store(vectors, path, "kb") == {"written": 0, "duplicate": 3, "invalid": 0}
    store_append(rows(spark, ["p", "q", None]).withColumn("ns", F.lit("07")), path, "kb", namespace_col="ns")
    assert sorted(str(r.id) for r in store_scan(spark, path, "kb", "07").collect()) == ["None", "p", "q"]
    assert I.perhaps_stored(spark.createDataFrame([("p",)], "id string"), path, "kb", "07").count() == 1


def test_compaction_keeps_buckets_and_filters(spark):
    path = scratch_path(spark, "buckets")
    for _ in range(3):
        store_append(rows(spark, [f"i{k}" for k in range(100)]), path, "kb", id_buckets=True)
    assert I.filters(spark, path).count() == 3
    assert compact_store(spark, path) == 200 and store_scan(spark, path).count() == 100
    assert I.compact_filters(spark, path) == 1 == I.filters(spark, path).count()
    assert I.perhaps_stored(store_scan(spark, path), path, "kb").count() == 100
    store_append(rows(spark, ["late"]), path, "kb")
    assert store_scan(spark, path).where("id = 'late'").count() == 1 and I.compact_filters(spark, path) == 1


def test_stores_without_buckets_stay_so(spark):
    path = scratch_path(spark, "plain")
    store_append(rows(spark, ["a"]), path, "kb")
    assert not uses_buckets(spark, path)
    with pytest.raises(ValueError):
        store_append(rows(spark, ["b"]), path, "kb", id_buckets=True)
    empty = scratch_path(spark, "empty")
    store_append(rows(spark, []), empty, "kb", id_buckets=True)
    assert admit_ids(spark.createDataFrame([("a",)], "id string"), empty, "kb").count() == 0


@pytest.mark.parametrize("buckets", [False, True])
def test_empty_batches(spark, buckets):
    path = scratch_path(spark, "empty-batch")
    docs = spark.createDataFrame([], "doc_id long, text string")
    for _ in range(2):
        assert add_to_knowledge(docs, path, "kb", None, parse_docs=False, id_buckets=buckets) == {"written": 0, "duplicate": 0, "invalid": 0}
    vectors = spark.createDataFrame([], "text string, embedding array<float>, metadata map<string,string>")
    assert add_to_store(vectors, path, "kb") == {"written": 0, "duplicate": 0, "invalid": 0}


def test_a_bucketed_ingest_stages_no_text_of_rows_it_does_not_write(spark, tmp_path):
    from tessera.plans.knowledge import _append_written
    rows = spark.createDataFrame([("a", [1.0], "new", {"k": "1"}, "written", 2), ("b", None, "old", {"k": "2"}, "duplicate", 3), (None, None, "bad", None, "invalid", 1)],
                                 "id string, embedding array<float>, text string, metadata map<string,string>, status string, copies long")
    staged, counts = _append_written(rows, str(tmp_path / "s"), "kb", None, True)
    assert counts == {"written": 1, "duplicate": 4, "invalid": 1}
    assert sorted(str(r.text) for r in staged.select("text").collect()) == ["None", "None", "new"]
    assert [r.text for r in store_scan(spark, str(tmp_path / "s")).collect()] == ["new"]
