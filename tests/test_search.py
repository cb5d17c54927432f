"""Exact search equals brute force, independent of partitioning; the LSH
search finds planted near neighbours."""

import numpy as np
import pytest

from tessera.operators.search import vector_topk, vector_topk_approx


def _frames(spark, store, queries, parts=4):
    s = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(store)],
                              "id long, embedding array<float>").repartition(parts)
    q = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(queries)],
                              "query_id long, embedding array<float>")
    return s, q


def _brute(store, queries, k, min_score):
    s = np.asarray(store, dtype=np.float32).astype(np.float64)
    q = np.asarray(queries, dtype=np.float32).astype(np.float64)
    cos = (q @ s.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(s, axis=1))
    score = np.round((1 + cos) / 2, 6)
    out = set()
    for i in range(len(q)):
        cand = sorted([(-score[i, j], j) for j in range(len(s)) if score[i, j] >= min_score])[:k]
        out |= {(i, j, rank + 1) for rank, (_, j) in enumerate(cand)}
    return out


@pytest.mark.parametrize("parts,blocks,strategy", [(1, None, None), (7, None, "broadcast"),
                                                    (7, None, "blocked"), (3, 5, "blocked")])
def test_exact_topk_equals_brute_force(spark, parts, blocks, strategy):
    rng = np.random.default_rng(3)
    store, queries = rng.standard_normal((300, 16)), rng.standard_normal((40, 16))
    store[7] = store[8]  # exact tie: broken by id
    s, q = _frames(spark, store, queries, parts)
    got = {(r.query_id, r.id, r.rank) for r in
           vector_topk(s, q, 4, 0.55, dim=16, store_blocks=blocks, query_blocks=blocks,
                       strategy=strategy).collect()}
    assert got == _brute(store, queries, 4, 0.55)


def test_min_score_applies_before_ranking(spark):
    rng = np.random.default_rng(5)
    store, queries = rng.standard_normal((50, 8)), rng.standard_normal((5, 8))
    s, q = _frames(spark, store, queries)
    rows = vector_topk(s, q, 50, 0.9, dim=8).collect()
    assert all(r.score >= 0.9 for r in rows)


def test_lsh_recall_on_planted_neighbours(spark):
    rng = np.random.default_rng(11)
    store = rng.standard_normal((2000, 32))
    picked = rng.choice(2000, 200, replace=False)
    queries = store[picked] + 0.05 * rng.standard_normal((200, 32))
    s, q = _frames(spark, store, queries)
    got = {r.query_id: r.id for r in vector_topk_approx(s, q, 1, 0.0, dim=32).collect()}
    recall = np.mean([got.get(i) == int(p) for i, p in enumerate(picked)])
    assert recall >= 0.9


def test_exact_plan_pairs_nothing_in_spark(spark):
    rng = np.random.default_rng(1)
    s, q = _frames(spark, rng.standard_normal((20, 4)), rng.standard_normal((3, 4)))
    for strategy, node in (("broadcast", "MapInPandas"), ("blocked", "FlatMapCoGroupsInPandas")):
        plan = vector_topk(s, q, 2, 0.0, dim=4, strategy=strategy)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert node in plan


def test_lsh_with_stored_codes_equals_on_the_fly(spark):
    from tessera.operators.search import lsh_codes
    from tessera.session import cut_lineage
    rng = np.random.default_rng(13)
    store, queries = rng.standard_normal((500, 16)), rng.standard_normal((30, 16))
    s, q = _frames(spark, store, queries)
    # the index column as it is stored at ingest (a written table)
    indexed = cut_lineage(s.withColumn("lsh_codes", lsh_codes("embedding", 16)))
    a = {tuple(r) for r in vector_topk_approx(s, q, 3, 0.0, dim=16).collect()}
    b = {tuple(r) for r in vector_topk_approx(indexed, q, 3, 0.0, dim=16, store_codes_col="lsh_codes").collect()}
    assert a == b and len(a) > 0
    plan = vector_topk_approx(indexed.select("id", "embedding", "lsh_codes"), q, 3, 0.0, dim=16,
                              store_codes_col="lsh_codes")._jdf.queryExecution().executedPlan().toString()
    # the store side reads its stored codes: the code UDF runs on query vectors only
    assert "codes(_v#" not in plan and "codes(_qv#" in plan


def test_rows_of_one_id_are_one_hit(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(40, 8))
    rows = [(i % 20, [float(x) for x in vectors[i % 20]]) for i in range(80)] + [(i, [float(x) for x in vectors[20 + i]]) for i in range(20)]
    queries = spark.createDataFrame([(k, [float(x) for x in vectors[k]]) for k in range(5)], "query_id long, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    score = np.round((1 + unit[:5] @ unit.T) / 2, 6)
    best = np.maximum(score[:, :20], score[:, 20:])  # id i has two vectors
    want = {(q, int(i), float(best[q, i])) for q in range(5) for i in np.lexsort((np.arange(20), -best[q]))[:6]}
    for parts in (1, 7):
        store = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(parts)
        for kw in ({}, {"strategy": "blocked", "store_blocks": 3, "query_blocks": 2}, {"floor_share": 1}):
            got = vector_topk(store, queries, 6, **kw).collect()
            assert {(r.query_id, r.id, r.score) for r in got} == want and len(got) == 30
            assert sorted(r["rank"] for r in got) == sorted(list(range(1, 7)) * 5)


def test_compaction_leaves_one_row_an_identity_and_other_partitions_alone(spark, tmp_path):
    import os

    from tessera.sources.vector_store import compact_store, store_append, store_scan
    schema = "id string, embedding array<float>, text string, metadata map<string,string>"
    rows = spark.createDataFrame([(f"i{k}", [1.0, float(k)], f"t{k}", {"k": str(k)}) for k in range(6)], schema)
    path = str(tmp_path / "s")
    for ns in ("a", "b", "a"):
        store_append(rows, path, "kb", ns)
    store_append(spark.createDataFrame([("i0", [2.0, 2.0], "other", None)], schema), path, "kb", "a")
    before = set(os.listdir(f"{path}/store=kb/namespace=b"))
    assert compact_store(spark, path) == 7 and compact_store(spark, path) == 0
    assert set(os.listdir(f"{path}/store=kb/namespace=b")) == before
    got = [(r.namespace, r.id) for r in store_scan(spark, path, "kb").collect()]
    assert sorted(got) == sorted((ns, f"i{k}") for ns in "ab" for k in range(6))


def test_scoring_holds_few_scores_at_once_whatever_the_block(spark):
    import tracemalloc

    from tessera.operators import search
    rng = np.random.default_rng(8)
    store, queries = rng.standard_normal((20000, 8)), rng.standard_normal((3000, 8))
    store[50] = 0.0  # no direction: matches nothing
    ids = rng.permutation(20000) // 2  # two rows an id
    unit = search._unit(queries.copy())
    tracemalloc.start()
    q, i, sc = search._local_topk(ids, store, np.arange(3000), unit, 5, 0.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # 3,000 x 20,000 scores are 480 MB
    with np.errstate(invalid="ignore", divide="ignore"):
        score = np.round((1 + (unit[:20] @ store.T) / np.linalg.norm(store, axis=1)) / 2, 6)
    best = np.full((20, 10000), -np.inf)
    for row in range(20000):
        best[:, ids[row]] = np.fmax(best[:, ids[row]], score[:, row])
    for at in range(20):
        want = np.lexsort((np.arange(10000), -best[at]))[:5]
        assert list(i[q == at]) == list(want) and list(sc[q == at]) == list(best[at][want])


def test_uneven_cells_are_not_joined_into_one_task(spark):
    rng = np.random.default_rng(9)
    s, q = _frames(spark, rng.standard_normal((400, 8)), rng.standard_normal((100, 8)))
    hits = vector_topk(s, q, 3, 0.0, dim=8, strategy="blocked", store_blocks=6, query_blocks=2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2 and "_qb#" in plan


def test_lsh_floor_changes_no_hit(spark):
    rng = np.random.default_rng(14)
    store = rng.standard_normal((600, 16))
    store[100:140] = store[7]  # ties, broken by id
    s, q = _frames(spark, store, store[:60])
    got = [{tuple(r) for r in vector_topk_approx(s, q, 5, 0.5, dim=16, n_tables=6, n_bits=3, block_rows=rows, floor_share=share).collect()}
           for rows, share in ((None, 10**9), (None, 1), (40, 4))]
    assert got[0] == got[1] == got[2] and len(got[0]) > 200


def test_places_are_those_of_flatnonzero():
    from tessera.operators.search import _places
    rng = np.random.default_rng(1)
    for shape, share in (((3, 5), 0.5), ((7, 9), 0.1), ((16, 8), 0.0), ((0, 4), 0.0), ((5, 13), 1.0)):
        mask = rng.random(shape) < share
        assert _places(mask).tolist() == np.flatnonzero(mask).tolist()


def test_scores_closer_than_float_products_tell_keep_their_order():
    from tessera.operators.search import _local_topk
    rng = np.random.default_rng(2)
    query = rng.normal(size=(1, 64))
    store = np.concatenate([query + 1e-3 * rng.normal(size=(300, 64)), rng.normal(size=(9000, 64))])
    store = store[rng.permutation(len(store))]
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    score = np.round((1 + unit(query) @ unit(store).T) / 2, 6)[0]
    want = np.lexsort((np.arange(len(store)), -score))[:7]
    q, i, s = _local_topk(np.arange(len(store)), store.copy(), np.array([0]), unit(query), 7, 0.0)
    assert i.tolist() == want.tolist() and s.tolist() == score[want].tolist()


def test_a_list_of_equal_codes_takes_no_more_than_its_shortlist():
    from tessera.operators.vector_index import _best
    level = np.zeros((3, 40), np.float32)
    level[1, 30] = 1
    assert _best(level, 4).tolist() == [[0, 1, 2, 3], [30, 0, 1, 2], [0, 1, 2, 3]]
    mixed = np.random.default_rng(3).normal(size=(5, 40)).astype(np.float32)
    assert all(set(a) == set(np.argsort(-b)[:4]) for a, b in zip(_best(mixed, 4).tolist(), mixed))
