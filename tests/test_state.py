"""Streams with list state, map state, timers and expiry."""

import datetime as dt
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tessera.plans.q_stream import _rocksdb
from tessera.sources.vector_store import scratch_path
from tessera.streaming.runner import file_stream, run_available_now
from tessera.streaming.sessions import expiring_window, latest_windows, running_window, stored_windows
from tessera.streaming.summaries import summarizing_memory
from tessera.streaming.tool_calls import OpenCalls, match_as_they_come

T0 = dt.datetime(2024, 1, 1)
EVENTS = "kind string, session_id string, request_id string, ts timestamp, seq long, result string"
MESSAGES = "session_id string, seq long, type string, text string"


def put(spark, folder, schema, k, rows):
    """One file, the k-th to be read."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    for f in os.listdir(folder):
        if f.endswith(".parquet") and not f.startswith("_") and os.path.getmtime(f"{folder}/{f}") > time.time() - 1000:
            os.utime(f"{folder}/{f}", (time.time() - 5000 + 10 * k,) * 2)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def run_calls(spark, folder, batches):
    for k, rows in enumerate(batches):
        put(spark, folder, EVENTS, k, rows)
    stream = file_stream(spark, folder, spark.createDataFrame([], EVENTS).schema, 1)
    out = {}

    def keep(df, batch_id):
        out[batch_id] = df.collect()
    with _rocksdb(spark):
        found = match_as_they_come(stream.where("kind = 'call'"), stream.where("kind = 'result'"), 10, 5)
        run_available_now(found, name="t-calls", foreach_batch=keep, checkpoint=scratch_path(spark, "t-calls"))
    return {b: sorted((r.kind, r.session_id or "", r.request_id or "", r.seq, r.matched, r.result) for r in rows) for b, rows in out.items() if rows}


def call(s, q, t, n):
    return ("call", s, q, None if t is None else at(t), n, None)


def result(s, q, t, n, text):
    return ("result", s, q, at(t), n, text)


def test_calls_are_answered_as_soon_as_they_can_be(spark, tmp_path):
    failed = "Tool execution failed"
    got = run_calls(spark, str(tmp_path / "e"), [
        [call("a", "x", 0, 1), call("a", "y", 0, 2), call("b", "x", 1, 3), result("a", "x", 3, 10, "one"), result("a", "x", 2, 11, "first"), result("a", "y", 1, 12, " ")],
        [result("a", "y", 9, 13, "in time"), result("b", "x", 12, 14, "too late"), call(None, "x", 2, 4), call("c", None, 2, 5)],
        [call("z", "z", 1000, 99)]])
    assert got[0] == [("call", "a", "x", 1, True, "first")]  # before any watermark
    assert got[1] == [("call", "", "x", 4, False, failed), ("call", "a", "y", 2, True, "in time"), ("call", "c", "", 5, False, failed)]
    rest = sorted(sum((v for k, v in got.items() if k > 1), []))
    assert [r for r in rest if r[0] == "call" and r[3] != 99] == [("call", "b", "x", 3, False, failed)]
    assert [(r[1], r[5]) for r in rest if r[0] == "late"] == [("a", "one"), ("b", "too late")]


def test_a_call_comes_out_as_soon_as_the_watermark_passes_its_time_out(spark, tmp_path):
    got = run_calls(spark, str(tmp_path / "e"), [[call("a", "x", 0.2, 1)], [call("z", "z", 15.8, 99)]])  # due at 10.2, watermark 10.8
    assert sum(got.values(), []) == [("call", "a", "x", 1, False, "Tool execution failed")]


class Handle:
    """A state handle that counts what is asked of it."""

    def __init__(self):
        self.value, self.timers, self.asked = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.asked += 1
        return self.value is not None

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked, self.value = self.asked + 1, value

    def clear(self):
        self.update(None)

    def registerTimer(self, at):
        self.asked += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.asked += 1
        self.timers.remove(at)


def test_many_calls_take_few_state_requests_and_one_timer():
    n, handle, calls = 500, Handle(), OpenCalls(10)
    calls.init(handle)

    def rows(ids, at, is_call):
        return pd.DataFrame({"session_id": "s", "request_id": [f"r{k}" for k in ids], "at": at, "no_time": False, "seq": ids, "has_seq": True,
                             "result": None if is_call else "done", "is_call": is_call, "known": True})

    def drain(frames):
        return sorted((r.kind, r.seq, r.matched) for f in frames for r in f.itertuples())
    times = [1_000_000 * k for k in range(n)]
    assert drain(calls.handleInputRows((0,), iter([rows(range(n), times, True)]), None)) == []
    assert handle.asked <= 4 and handle.timers == {10_001}
    answered = drain(calls.handleInputRows((0,), iter([rows(range(0, n, 2), times[::2], False)]), None))
    assert answered == [("call", k, True) for k in range(0, n, 2)] and handle.asked <= 8 and len(handle.timers) == 1
    (due,) = handle.timers
    late = drain(calls.handleExpiredTimer((0,), TimerValues(0, 2_000_000), ExpiredTimerInfo(due)))
    assert late == [("call", k, False) for k in range(1, n, 2)] and handle.asked <= 12 and handle.value is None


def test_the_first_result_in_time_answers_and_nulls_come_first():
    handle, calls = Handle(), OpenCalls(10)
    calls.init(handle)
    big = 2**60 + 1
    data = [("s", "x", 5, 1, True, None, True), ("s", "x", 0, big, True, None, True), ("s", "y", 0, 3, True, None, True), ("t", "x", 0, 0, False, None, True),
            ("s", "x", 5, 8, True, "b", False), ("s", "x", 5, 0, False, "a", False), ("s", "y", 10_000_001, 9, True, "c", False), ("t", "x", 10_000_000, big, True, "d", False)]
    rows = pd.DataFrame(data, columns=["session_id", "request_id", "at", "seq", "has_seq", "result", "is_call"]).assign(no_time=False, known=True)
    (found,) = calls.handleInputRows((0,), iter([rows.iloc[:3], rows.iloc[3:]]), None)
    assert sorted((r.session_id, -1 if r.seq is pd.NA else r.seq, r.result, r.result_seq is pd.NA) for r in found.itertuples()) == [
        ("s", 1, "a", True), ("s", big, "a", True), ("t", -1, "d", False)]
    assert big in found["result_seq"].dropna().tolist()


def test_windows_with_null_seq_ties_and_expiry(spark, tmp_path):
    rows = [("s", 2, "USER", "b"), ("s", None, "AI", "n"), (None, 1, "USER", "x"), ("s", 2**60 + 1, "AI", "big")], [("s", 2, "USER", "a"), ("t", None, None, None), ("s", 3, "AI", "c")]
    for k, r in enumerate(rows):
        put(spark, str(tmp_path / "m"), MESSAGES, k, r)
    schema = spark.createDataFrame([], MESSAGES).schema
    want = [("", 1, "x", 0), ("s", 2, "b", 0), ("s", 3, "c", 1), ("s", 2**60 + 1, "big", 2), ("t", None, None, 0)]
    out = run_available_now(running_window(file_stream(spark, str(tmp_path / "m"), schema, 1), 3), name="t-w")
    newest = [r for r in spark.read.parquet(out).collect()]
    last = {}
    for r in newest:
        last[r.session_id] = max(last.get(r.session_id, 0), r.version)
    assert sorted(((r.session_id or "", r.seq, r.text, r.pos) for r in newest if r.version == last[r.session_id]), key=str) == sorted(want, key=str)
    assert latest_windows(spark.read.parquet(out)).where("session_id = 's'").count() == 3
    checkpoint = scratch_path(spark, "t-w")
    with _rocksdb(spark):
        run_available_now(expiring_window(file_stream(spark, str(tmp_path / "m"), schema, 1), 3), name="t-w2", checkpoint=checkpoint, empty_batches=False)
        held = stored_windows(spark, checkpoint).collect()  # without a run: as after a restart
    assert sorted(((r.session_id or "", r.seq, r.text) for r in held), key=str) == sorted((w[:3] for w in want), key=str)


def test_state_is_bounded_and_expires(spark, tmp_path):
    schema, checkpoint = spark.createDataFrame([], MESSAGES).schema, scratch_path(spark, "t-ttl")
    folder, sink = str(tmp_path / "m"), scratch_path(spark, "t-ttl")
    with _rocksdb(spark):
        put(spark, folder, MESSAGES, 0, [("old", k, "USER", "x") for k in range(500)])
        run_available_now(expiring_window(file_stream(spark, folder, schema), 4, ttl_seconds=20), sink, name="t-ttl", checkpoint=checkpoint, empty_batches=False)
        assert stored_windows(spark, checkpoint).count() == 4
        time.sleep(21)
        put(spark, folder, MESSAGES, 1, [("new", k, "USER", "x") for k in range(500)])
        out = run_available_now(expiring_window(file_stream(spark, folder, schema), 4, ttl_seconds=20), sink, name="t-ttl", checkpoint=checkpoint, empty_batches=False)
        assert {r.session_id for r in stored_windows(spark, checkpoint).collect()} == {"new"}
    assert spark.read.parquet(out).agg(F.max("version")).first()[0] == 500


def test_summaries_are_returned_after_a_restart_without_new_rows(spark, tmp_path):
    put(spark, str(tmp_path / "m"), MESSAGES, 0, [("s", k, "USER", f"m{k}") for k in range(7)] + [("t", 1, "USER", "x")])
    schema, checkpoint, path = spark.createDataFrame([], MESSAGES).schema, scratch_path(spark, "t-s"), scratch_path(spark, "t-s")

    def run():
        stream = file_stream(spark, str(tmp_path / "m"), schema, 1)
        return sorted(map(tuple, summarizing_memory(stream, path, 4, lambda: lambda prompts: ["<summary>s</summary>"] * len(prompts), checkpoint=checkpoint).collect()))
    first = run()
    assert len(first) >= 3 and run() == first
    put(spark, str(tmp_path / "m"), MESSAGES, 1, [("t", 2, "USER", "y")])
    assert len(run()) == len(first) + 1


@pytest.mark.parametrize("batches", [1, 3])
def test_summaries_of_an_empty_stream(spark, tmp_path, batches):
    put(spark, str(tmp_path / "m"), MESSAGES, 0, [])
    stream = file_stream(spark, str(tmp_path / "m"), spark.createDataFrame([], MESSAGES).schema, batches)
    assert summarizing_memory(stream, scratch_path(spark, "t-e"), 4, lambda: lambda prompts: prompts).collect() == []
