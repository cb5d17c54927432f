"""Skew-safe window helpers equal plain windows, whatever the bucketing."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.util import max_by_key, previous_value, ranked


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(7)
    n = 3000
    # one hot key holding a third of the rows, gaps between seq values
    keys = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c", "d"], n))
    seq = rng.choice(20000, n, replace=False)
    kind = rng.integers(0, 2, n)
    rows = [(str(k), int(s), int(t)) for k, s, t in zip(keys, seq, kind)]
    return spark.createDataFrame(rows, "k string, seq long, kind int")


@pytest.mark.parametrize("width", [1, 7, 500, 100000])
def test_ranked_equals_row_number(spark, events, width):
    got = ranked(events, ["k"], ["seq"], F.floor(F.col("seq") / width), "rn")
    want = events.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("seq")))
    assert {tuple(r) for r in got.select("k", "seq", "rn").collect()} == \
           {tuple(r) for r in want.select("k", "seq", "rn").collect()}


@pytest.mark.parametrize("width", [1, 7, 500, 100000])
def test_previous_value_equals_lag(spark, events, width):
    got = previous_value(events, ["k"], ["seq", "kind"], "kind", F.floor(F.col("seq") / width), "prev")
    want = events.withColumn("prev", F.lag("kind").over(Window.partitionBy("k").orderBy("seq", "kind")))
    assert {tuple(r) for r in got.select("k", "seq", "prev").collect()} == \
           {tuple(r) for r in want.select("k", "seq", "prev").collect()}


def test_rows_with_null_keys_and_orders_are_kept(spark):
    rows = [("s", 1, "a"), ("s", None, "b"), ("s", None, "c"), (None, 5, "d"), (None, None, "e"), ("s", 9000, "f"), (None, 9000, "g"), ("s", 1, "a")]
    df = spark.createDataFrame(rows, "k string, seq long, v string").withColumn("m", F.create_map(F.lit("x"), "v"))
    bucket = F.floor(F.col("seq") / 4096).cast("bigint")
    got = sorted((r.k or "", r.rn, r.seq) for r in ranked(df, ["k"], ["seq"], bucket).collect())
    assert got == [("", 1, None), ("", 2, 5), ("", 3, 9000), ("s", 1, None), ("s", 2, None), ("s", 3, 1), ("s", 4, 1), ("s", 5, 9000)]
    assert previous_value(df, ["k"], ["seq", "v"], "v", bucket, "before").count() == 8
    most = {(r.k, r.v): r.most for r in max_by_key(df.withColumn("b", bucket), ["k"], "v", "b", "most").collect()}
    assert most[None, "e"] == "g" and most["s", "c"] == "f" and len(most) == 7


def test_ties_and_null_sessions_in_windows_and_system_messages(spark):
    from tessera.operators import memory as M
    rows = [("s", 1, "SYSTEM", "x"), ("s", 1, "SYSTEM", "y"), ("s", 1, "SYSTEM", "y"), ("s", 2, "USER", "a"), ("s", 2, "USER", "b"), (None, 4, "SYSTEM", "own"), (None, 5, "USER", "c"),
            ("t", 7, "USER", "d"), ("t", None, None, "e")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "session_id string, seq long, type string, text string").repartition(parts, "text")
        fixed = sorted((r.session_id or "", r.seq or 0, r.type or "", r.text) for r in M.fix_system_message(df).collect())
        systems = [r for r in fixed if r[2] == "SYSTEM"]
        assert [r[0] for r in systems] == ["", "s", "t"] and systems[0][3] == "own" and systems[2][1] == 6 and len(fixed) == 8
        windows = sorted((r.session_id or "", r.pos, r.text) for r in M.last_n(df, 1).collect())
        assert [(s, p) for s, p, _ in windows] == [("", 0), ("s", 0), ("t", 0)]
        if parts == 1:
            first = (systems, windows)
    assert first == (systems, windows)


def test_calls_without_session_or_time_match_nothing_and_stay(spark):
    import datetime as dt
    from tessera.operators import tools as TL
    t = dt.datetime(2024, 1, 1)
    calls = spark.createDataFrame([("s", "k", t, 1), (None, "k", t, 2), ("s", None, t, 3), ("s", "k", None, 4)], "session_id string, request_id string, ts timestamp, seq long")
    results = spark.createDataFrame([(s, k, at, "r", q) for q, (s, k, at) in enumerate([("s", "k", t), (None, "k", t), ("s", None, t), ("s", "k", None)])],
                                    "session_id string, request_id string, ts timestamp, result string, seq long")
    for timeout in (10, None):
        got = {r.seq: r.matched for r in TL.match_results(calls, results, timeout).collect()}
        assert got == {1: True, 2: False, 3: False, 4: False}
