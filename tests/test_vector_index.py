"""The stored index: recall, shares, pruning, odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import vector_index as VI
from tests.conftest import SF_MID


def frame(spark, ids, vectors, name="id"):
    return spark.createDataFrame([(int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)], f"{name} long, embedding array<float>")


def brute(store, queries, k):
    """Ids of the exact top k by query."""
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    score = np.round((1 + unit(queries) @ unit(store).T) / 2, 6)
    return [set(np.lexsort((np.arange(len(store)), -s))[:k].tolist()) for s in score]


def test_recall_and_share_on_vectors_without_clusters(spark, tmp_path):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    rows = emb.orderBy("id").collect()
    VI.build_index(emb, str(tmp_path), dim=64, n_lists=16)
    got = VI.index_topk(spark, str(tmp_path), emb.withColumnRenamed("id", "query_id"), 5, n_probe=12).collect()
    want = brute(np.array([r.embedding for r in rows]), np.array([r.embedding for r in rows]), 5)
    place = {r.id: k for k, r in enumerate(rows)}
    hits = sum(place[r.id] in want[place[r.query_id]] for r in got)
    assert hits / (5 * len(rows)) >= 0.9
    assert sum(r.n_scored for r in got if r["rank"] == 1) < 0.15 * len(rows) ** 2
    assert all(r.id == r.query_id and r.score == 1.0 for r in got if r["rank"] == 1)


def clusters(n=4000, dim=32, many=40, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(many, dim))
    return centers[rng.integers(0, many, n)] + 0.25 * rng.normal(size=(n, dim))


def test_few_lists_suffice_where_vectors_form_clusters_and_others_are_pruned(spark, tmp_path):
    data = clusters()
    store = frame(spark, range(len(data)), data)
    VI.build_index(store, str(tmp_path), dim=32, n_lists=64, n_sub=16, n_codes=64)
    asked = list(range(0, 4000, 100))
    queries = frame(spark, asked, data[asked], "query_id")
    found = VI.index_topk(spark, str(tmp_path), queries, 10, n_probe=4, shortlist=40)
    want = brute(data, data[asked], 10)
    got = found.collect()
    assert sum(r.id in want[asked.index(r.query_id)] for r in got) / (10 * len(asked)) >= 0.9
    assert sum(r.n_scored for r in got if r["rank"] == 1) < 0.05 * len(asked) * len(data)
    one = VI.index_topk(spark, str(tmp_path), queries.limit(1), 10, n_probe=2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan and "Exchange hashpartitioning(id" not in plan
    assert one.count() == 10


def test_all_lists_and_all_rows_give_the_exact_search(spark, tmp_path):
    from tessera.operators.search import vector_topk
    data = clusters(600, 16, 5)
    data[100:110] = data[0]  # ties
    store, queries = frame(spark, range(600), data), frame(spark, range(50), data[:50], "query_id")
    VI.build_index(store, str(tmp_path), dim=16, n_lists=4, n_sub=4, n_codes=8, rounds=2)
    got = VI.index_topk(spark, str(tmp_path), queries, 7, n_probe=4, shortlist=10_000, min_score=0.7)
    want = vector_topk(store, queries, 7, 0.7)
    a, b = ({(r.query_id, r["rank"]): (r.score, r.id) for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys() and all(math.isclose(a[k][0], b[k][0], abs_tol=2e-6) for k in a)
    assert a[0, 1] == b[0, 1] == (1.0, 0) and a[0, 2][1] == 100


def test_rows_appended_later_are_found(spark, tmp_path):
    data = clusters(800, 16, 5)
    VI.build_index(frame(spark, range(400), data[:400]), str(tmp_path), dim=16, n_lists=8, n_sub=4)
    VI.append_index(frame(spark, range(400, 800), data[400:]), str(tmp_path), rows_per_file=10)
    assert VI.index_rows(spark, str(tmp_path)).count() == 800
    got = VI.index_topk(spark, str(tmp_path), frame(spark, [1, 2], data[[399, 799]], "query_id"), 1, n_probe=1, shortlist=200).collect()
    assert sorted((r.query_id, r.id, r.score) for r in got) == [(1, 399, 1.0), (2, 799, 1.0)]


def test_odd_vectors_match_nothing(spark, tmp_path):
    odd = [None, [0, 0, 0, 0], [1, 2, 3], [1, None, 2, 3], [float("nan"), 1, 1, 1], [float("inf"), 1, 1, 1]]
    good = [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 1], [1, 0, 0, 0]]
    store = frame(spark, range(10), odd + good)
    VI.build_index(store, str(tmp_path), dim=4, n_lists=3, n_sub=2, n_codes=4)
    got = VI.index_topk(spark, str(tmp_path), store.withColumnRenamed("id", "query_id"), 2, n_probe=3).collect()
    assert {r.query_id for r in got} == {6, 7, 8, 9} and {r.id for r in got} <= {6, 7, 8, 9}
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 9] == [(6, 1.0), (9, 1.0)]


def test_queries_in_several_blocks(spark, tmp_path, monkeypatch):
    data = clusters(300, 16, 5)
    store = frame(spark, range(300), data)
    VI.build_index(store, str(tmp_path), dim=16, n_lists=4, n_sub=4)
    queries = store.withColumnRenamed("id", "query_id")
    one = sorted(map(tuple, VI.index_topk(spark, str(tmp_path), queries, 3, n_probe=2).collect()))
    monkeypatch.setattr(VI, "BROADCAST_QUERY_BYTES", 100 * 16 * 8)
    assert sorted(map(tuple, VI.index_topk(spark, str(tmp_path), queries, 3, n_probe=2).collect())) == one


def test_sub_vectors_must_divide_the_width(spark, tmp_path):
    with pytest.raises(ValueError):
        VI.build_index(frame(spark, [1], [[1, 2, 3]]), str(tmp_path), dim=3, n_lists=1, n_sub=2)


def test_recall_holds_in_long_lists_and_near_copies_meet_themselves(spark, tmp_path):
    rng = np.random.default_rng(3)
    plain, near = rng.normal(size=(6000, 64)), rng.normal(size=(40, 64))[np.arange(2000) % 40] + 0.1 * rng.normal(size=(2000, 64))
    data = np.concatenate([plain, near])
    VI.build_index(frame(spark, range(8000), data), str(tmp_path), dim=64, n_lists=4)
    asked = list(range(0, 8000, 40))
    got = VI.index_topk(spark, str(tmp_path), frame(spark, asked, data[asked], "query_id"), 5, n_probe=4).collect()
    want = brute(data, data[asked], 5)
    assert all(r.id == r.query_id and r.score == 1.0 for r in got if r["rank"] == 1)
    assert sum(r.id in want[asked.index(r.query_id)] for r in got if r.query_id < 6000) / (5 * 150) >= 0.9
    assert sum(r.n_scored for r in got if r["rank"] == 1) < 0.02 * len(asked) * len(data)


def test_codes_are_scored_for_many_queries_in_one_product(monkeypatch):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    model = VI.Model(unit(rng.normal(size=(1, 8))), 0.3 * rng.normal(size=(4, 16, 2)))
    units, codes = unit(rng.normal(size=(300, 8))), rng.integers(0, 16, (1000, 4)).astype(np.uint8)
    decoded = model.decode(0, codes)
    assert np.allclose(decoded[7], model.centroids[0] + np.concatenate([model.words[s, codes[7, s]] for s in range(4)]))
    stored, ids = unit(decoded).astype(np.float32), np.arange(1000)
    place, found, score, n = VI.score_list(units, model, 0, codes, stored, ids, 3, 2, np.full(300, -1.0))
    assert n == 4  # two of each 512 rows or part of them
    nearest = np.argsort(((units[:, None] - decoded[None]) ** 2).sum(2), axis=1)[:, :4]
    assert all(set(found[place == q]) <= set(nearest[q]) or len(np.unique(codes[nearest[q]], axis=0)) < 4 for q in range(300))
    assert np.allclose(score, (1 + (units[place] * stored[found]).sum(1)) / 2, atol=1e-6)
    assert (np.bincount(place) == 3).all()
