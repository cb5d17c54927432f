import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from tessera.llm import simhash as S
from tessera.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints, distance=4):
    u = np.array(prints, np.uint64)
    label = np.arange(len(u))
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= distance
    while True:
        new = np.where(near, label[None, :], len(u)).min(1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints_equal_brute_force():
    texts = ["", " \t", "one", "A b C", "a b c d", "É é A b c d", "x y " * 900, " ".join(f"w{k}" for k in range(1500)), "a\nb\x0bc  d e f"]
    got = S.fingerprints([t.encode() for t in texts], 4)
    assert got.tolist() == [brute_print(t) for t in texts]
    assert S.fingerprints([], 4).tolist() == [] and S.fingerprints([b""], 4).tolist() == [0]


def test_every_word_is_within_three_bits_of_its_codeword():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 20_000)
    high, errors = S._syndromes()
    e = errors[high[words >> 11] ^ (words & 0x7FF)]
    assert np.bitwise_count(e).max() <= 3 and (high[(words ^ e) >> 11] == ((words ^ e) & 0x7FF)).all()
    assert len(set(errors.tolist())) == 2048


def test_all_within_four_bits_share_a_key():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 6000, dtype=np.int64).view(np.uint64) * np.uint64(2) + rng.integers(0, 2, 6000).astype(np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, 4 if k % 2 else int(rng.integers(0, 5)), replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)
    a, b = (set(zip(*(c.tolist() for c in S.link_keys(z)))) for z in (x, y))
    assert {r for r, _ in a & b} == set(range(len(x)))


def test_classes_of_dense_groups_equal_brute_force_on_both_paths(spark):
    rng = np.random.default_rng(2)
    centre, words = int(rng.integers(0, 1 << 62)), []
    for _ in range(700):
        v = centre
        for b in rng.choice(24, rng.integers(0, 10), replace=False):
            v ^= 1 << int(b) * 2
        words.append(v)
    far = rng.integers(0, 1 << 62, 200).tolist()
    u = np.unique(np.array(words + far, np.uint64))
    label = brute_classes(u)
    alone = np.bincount(label, minlength=len(u))[label] == 1
    want = {int(a): int(u[c]) for a, c, one in zip(u.view(np.int64), label, alone) if not one}
    df = spark.createDataFrame(pd.DataFrame({"_fp": u.view(np.int64)}))
    for large in (2048, 20):
        got = components(S.links(df, 4, large))
        assert {r.node: r.root for r in got.collect()} == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_large_groups_are_exact_at_all_distances(spark, distance):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    u = np.unique(np.array([centre ^ sum(1 << int(b) * 3 for b in rng.choice(20, rng.integers(0, 6), replace=False)) for _ in range(400)], np.uint64))
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= distance
    label = np.arange(len(u))
    while not (new := np.where(near, label[None, :], len(u)).min(1)).__eq__(label).all():
        label = new
    alone = np.bincount(label, minlength=len(u))[label] == 1
    want = {int(a): int(c) for a, c, one in zip(u.view(np.int64), label, alone) if not one}
    df = spark.createDataFrame(pd.DataFrame({"_fp": u.view(np.int64)}))
    for large in (2048, 20):
        got = {r.node: r.root for r in components(S.links(df, distance, large)).collect()}
        place = {int(v): k for k, v in enumerate(u.view(np.int64))}
        assert got.keys() == want.keys()
        assert len({(got[n], want[n]) for n in got}) == len(set(want.values())) == len(set(got.values()))
        assert all(got[n] == min(m for m in want if want[m] == want[n]) for n in got) and place


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (500, 500), (205, 201), (203, 205), (201, 205)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{100 + k: 100 for k in range(50)}, **{k: 201 for k in (201, 203, 205)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_documents(spark):
    base = [f"word{k}" for k in range(400)]
    near = [*base]
    near[200] = "other"
    data = [(5, " ".join(base)), (3, " ".join(base).upper()), (9, " ".join(near)), (4, None), (2, " \n"), (8, "something else entirely here"), (8, "something else entirely here"),
            (None, "something else ENTIRELY here"), (None, "quite alone in the world")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id long, text string, _id string, _fp int")
    got = S.near_duplicates(df).collect()
    prints = [brute_print(t) for _, t in data]
    label = brute_classes(prints)
    want = []
    for (i, t), p, c in zip(data, prints, label):
        ids = [data[j][0] for j in np.flatnonzero(label == c) if data[j][0] is not None]
        want.append((i, f"{p:016x}", min(ids, default=None)))
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == sorted(want, key=str)
    kept = S.drop_near_copies(df)
    assert kept.columns == df.columns
    alone = [9] if label[2] != label[0] else []
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 2, 8, None, *alone], key=str)
    flags = [r.kept for r in got if r.doc_id == 8]
    assert sorted(flags) == [False, True] and sum(r.kept for r in got) == kept.count()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(empty).collect() == [] and S.drop_near_copies(empty).collect() == []


def test_query_equals_brute_force(spark):
    from tessera.llm.queries import op2_simhash
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").toPandas()
    prints = [brute_print(t) for t in docs.text]
    label = brute_classes(prints)
    ids = docs.doc_id.to_numpy()
    want = {(int(i), f"{p:016x}", int(ids[label == c].min())) for i, p, c in zip(ids, prints, label)}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in op2_simhash(spark, SF_SMALL).collect()} == want
