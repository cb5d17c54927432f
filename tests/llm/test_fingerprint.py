import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import fingerprint as P


def brute_sketch(text, k=128, n=5):
    h = [int(hashlib.md5(w.encode()).hexdigest()[:12], 16) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    runs = [h[i:i + n] for i in range(len(h) - n + 1)] if len(h) >= n else [h] if h else []
    return sorted({sum(x * 3 ** j for j, x in enumerate(r)) % 2 ** 48 for r in runs})[:k]


def brute_near(a, b, k=128):
    top = min([x[k - 1] for x in (a, b) if len(x) >= k], default=2 ** 48)
    a, b = {x for x in a if x <= top}, {x for x in b if x <= top}
    return len(a & b) / len(a | b) if a | b else 1.0


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "a", "über", "日本", "x" * 9]) + str(rng.randrange(200)) for _ in range(n))


TEXTS = [None, "", " \n\t", "one", "one two three four", "a b c d e", "é " * 500, prose(1, 100), prose(2, 900) + " \U0001F600", prose(3, 30_000), prose(1, 100), "x" * 100_000]


@pytest.mark.parametrize("shingle", [1, 2, 5, 9])
def test_sketch_equals_brute_force_also_over_pieces(spark, shingle, monkeypatch):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "i int, t string")
    whole = df.select("i", P.sketch(F.col("t"), 64, shingle).alias("s")).collect()
    monkeypatch.setattr(P, "PIECE", 7)
    pieces = df.where("i not in (9, 11)").select("i", P.sketch(F.col("t"), 64, shingle).alias("s")).collect()
    for r in whole + pieces:
        assert list(r.s) == brute_sketch(TEXTS[r.i], 64, shingle), r.i


def check(spark, rows, got, next_of):
    for (i, text), r in zip(rows, got):
        text, nxt = text or "", next_of[i] or ""
        m = len(text) // 4
        edited = text[:len(text) - m] + nxt[:m]
        a, b, c = (brute_sketch(x) for x in (text, edited, nxt))
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{x:012x}" for x in a) and r.edited_fingerprint == "".join(f"{x:012x}" for x in b)
        assert r.near_edited == pytest.approx(brute_near(a, b)) and r.near_next == pytest.approx(brute_near(a, c))


@pytest.mark.parametrize("per_bucket", [1, 3, 256])
def test_fingerprints_equal_brute_force_over_buckets(spark, monkeypatch, per_bucket):
    rng = random.Random(5)
    ids = rng.sample(range(-50, 10**12), 40) + [10**15, -10**15]
    rows = sorted((i, rng.choice(TEXTS[:9])) for i in ids)
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string").withColumn("_next", F.lit(1)).withColumn("_sketch", F.lit("x"))
    near = P.neighbours
    monkeypatch.setattr(P, "neighbours", lambda *a: near(*a, rows_per_bucket=per_bucket))
    got = sorted(P.fingerprints(df).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(rows)
    check(spark, rows, got, {i: t for (i, _), (_, t) in zip(rows, rows[1:] + rows[:1])})


def test_nulls_repeats_and_small_tables(spark):
    def run(rows):
        return P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert run([]) == []
    (one,) = run([(4, "a b c d e f g h")])
    assert one.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest() and one.near_next == 1.0
    got = run([(None, "null id"), (7, "same text here"), (7, "same text here"), (7, None), (9, ""), (9, "")])
    assert len(got) == 6 and len({r.fingerprint for r in got if r.doc_id == 9}) == 1
    assert {r.near_next for r in got if r.doc_id == 7 and r.n_chars == 14} <= {0.0, 1.0}


def test_parts_merge_to_the_whole(spark):
    words = prose(8, 4000).split()
    parts = [("a", " ".join(words[k:k + 104])) for k in range(0, 4000, 100)] + [("b", "just one"), (None, "no key"), ("c", "")]
    df = spark.createDataFrame(parts, "doc string, part string").withColumn("sketch", P.sketch(F.col("part")))
    got = {r.doc: list(r.sketch) for r in P.merge_parts(df, ["doc"]).collect()}
    assert got == {"a": brute_sketch(" ".join(words)), "b": brute_sketch("just one"), None: brute_sketch("no key"), "c": []}
    two = df.where("doc = 'a'").limit(2).collect()
    both = spark.range(1).select(P.merge(F.array(*map(F.lit, two[0].sketch)), F.array(*map(F.lit, two[1].sketch)))).first()[0]
    assert list(both) == sorted(set(two[0].sketch) | set(two[1].sketch))[:128]


def test_estimates_are_near_the_truth(spark):
    words = prose(11, 6000).split()
    a, b = words[:4000], words[2000:]
    grams = [{tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (a, b)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string").select(P.sketch(F.col("a"), 512).alias("a"), P.sketch(F.col("b"), 512).alias("b"))
    r = df.select(P.resemblance(F.col("a"), F.col("b"), 512), P.containment(F.col("a"), F.col("b"), 512), P.distinct_shingles(F.col("a"), 512)).first()
    assert r[0] == pytest.approx(len(grams[0] & grams[1]) / len(grams[0] | grams[1]), abs=0.08)
    assert r[1] == pytest.approx(len(grams[0] & grams[1]) / len(grams[0]), abs=0.08)
    assert r[2] == pytest.approx(len(grams[0]), rel=0.15)


def test_plan_is_native_and_shuffles_texts_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = P.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
