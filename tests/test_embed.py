"""Histograms and model calls hold slices, whatever Spark's batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tessera.operators.embed import histograms


def test_histograms_of_a_batch_are_built_in_slices():
    rng = np.random.default_rng(2)
    lens = rng.integers(0, 400, 20000)
    lens[:3] = (0, 0, 600000)  # one text longer than a slice
    flat = rng.integers(0, 256, lens.sum()).astype(np.int32)
    mask = np.zeros(20000, bool)
    mask[1] = True
    buckets = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32)), pa.array(flat), mask=pa.array(mask))
    tracemalloc.start()
    got = histograms(buckets, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # the counts of all at once are 41 MB, the tokens' cells 37 MB, each several times
    assert len(got) == 20000 and got.null_count == (lens == 0).sum()
    ends = np.cumsum(lens)
    for k in (0, 1, 2, 3, 1023, 1024, 1025, 9999, 19999):
        counts = np.bincount(flat[ends[k] - lens[k]:ends[k]], minlength=256)
        want = None if lens[k] == 0 else (counts / np.linalg.norm(counts)).astype(np.float32).tolist()
        assert got[k].as_py() == want


def test_a_model_gets_few_texts_at_once_and_rows_keep_their_other_columns(spark):
    from tessera.operators.embed import MODEL_ROWS, model_embed

    def factory():
        return lambda texts: np.array([[len(texts), len(t)] for t in texts], dtype=np.float32)

    df = spark.range(3000).coalesce(1).selectExpr("id", "IF(id % 5 = 0, NULL, repeat('x', CAST(id % 7 AS int))) AS text", "map('k', string(id)) AS meta",
                                                  "struct(timestamp_seconds(id) AS at, id / 3 AS third) AS s")
    got = model_embed(df, factory, 2).collect()
    assert [r.id for r in got] == list(range(3000))
    assert all((r.embedding is None) == (r.id % 5 == 0) and r.meta == {"k": str(r.id)} for r in got)
    assert all(r.embedding[0] <= MODEL_ROWS and r.embedding[1] == r.id % 7 for r in got if r.embedding)
    assert [r.s for r in got] == [r.s for r in df.collect()]


def test_tokens_are_numbered_once_a_slice_and_as_by_the_native_expression(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tessera.operators import embed
    rng = np.random.default_rng(4)
    texts = [None, "", " .,! ", "Eins,zwei;DREI", "ÄÖ ß İ Σας 😀 x2²", "a b c", *[" ".join(f"W{n}" for n in rng.integers(0, 90, k)) for k in range(300)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    rows = df.select("id", F.regexp_replace(F.lower("text"), embed.TOKEN_SPLIT, " ").alias("words"), embed.token_buckets("text", 64).alias("buckets")).orderBy("id").collect()
    calls, plain = [], embed.md5
    monkeypatch.setattr(embed, "md5", lambda t: calls.append(t) or plain(t))
    words = pa.array([r.words for r in rows], pa.string())
    assert embed.numbered(words, 64).to_pylist() == [r.buckets for r in rows]
    assert len(calls) < 120  # of 45,000 tokens
    monkeypatch.setattr(embed, "SLICE_BYTES", 100)
    assert embed.numbered(words.slice(2), 64).to_pylist() == [r.buckets for r in rows[2:]]
    assert embed.numbered(words.slice(0, 0), 64).to_pylist() == []
    plan = embed.hash_embed(df, 64)._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan
