"""Answers of models kept in a memo table: what is asked, and what is not asked again."""

import os
import time
import uuid
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.operators.embed import model_embedder
from tessera.operators.infer import complete
from tessera.operators.memo import Memo, answers, persistent
from tessera.plans.knowledge import add_to_knowledge
from tessera.sources.vector_store import scratch_path, store_scan


def recording(folder, answer):
    """A factory whose model notes every text that it is asked in a file of ``folder``."""
    def factory():
        def fn(texts):
            for t in texts:
                with open(f"{folder}/{uuid.uuid4().hex}", "w", encoding="utf-8") as f:
                    f.write(t)
            return [answer(t) for t in texts]
        return fn
    return factory


def asked(folder):
    return Counter(open(f"{folder}/{f}", encoding="utf-8").read() for f in os.listdir(folder))


def folder_of(tmp_path, name):
    (tmp_path / name).mkdir()
    return str(tmp_path / name)


def memo_at(spark, **kw):
    return Memo(scratch_path(spark, "memo"), **({"model": "m", "delay": 0.0} | kw))


def test_a_prompt_is_asked_once_and_rows_stay(spark, tmp_path):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "long " * 20000)] + [(9, "hot")] * 500
    df = spark.createDataFrame(rows, "id long, prompt string").selectExpr("*", "'x' AS answer", "1 AS _memo_key")
    log, memo = folder_of(tmp_path, "one"), memo_at(spark, calls_per_task=2)
    got = complete(df, recording(log, str.upper), code_col="code", memo=memo)
    assert got.columns == ["id", "prompt", "_memo_key", "answer", "code"]
    assert Counter((r.id, r.prompt, r.answer) for r in got.collect()) == Counter((i, p, p and p.upper() if p is not None else None) for i, p in rows)
    assert [r.id for r in got.where("code IS NOT NULL").collect()] == [3]
    assert asked(log) == Counter({"a": 1, "": 1, "long " * 20000: 1, "hot": 1})
    more = spark.createDataFrame([(1, "b"), (2, "hot")], "id long, prompt string")
    log = folder_of(tmp_path, "two")
    assert {r.prompt: r.answer for r in complete(more, recording(log, str.upper), memo=memo).collect()} == {"b": "B", "hot": "HOT"}
    assert asked(log) == Counter({"b": 1})


def test_models_do_not_share_answers(spark, tmp_path):
    df = spark.createDataFrame([(1, "Ab")], "id long, prompt string")
    memo = memo_at(spark, model="model/1 = a")
    other = Memo(memo.path, "model/2")
    assert complete(df, recording(folder_of(tmp_path, "x"), str.upper), memo=memo).first().answer == "AB"
    assert complete(df, recording(folder_of(tmp_path, "y"), str.lower), memo=other).first().answer == "ab"
    assert answers(spark, memo, T.StringType()).count() == answers(spark, other, T.StringType()).count() == 1


def test_a_stopped_job_is_taken_up_where_it_stopped(spark, tmp_path):
    def dies(text):
        if text == "p7":
            time.sleep(4)
            raise SystemExit("the executor is lost")
        return text + "!"

    df = spark.createDataFrame([(k, f"p{k}") for k in range(40)], "id long, prompt string")
    memo, first, second = memo_at(spark, calls_per_task=1), folder_of(tmp_path, "first"), folder_of(tmp_path, "second")
    with pytest.raises(Exception):
        complete(df, recording(first, dies), memo=memo)
    kept = answers(spark, memo, T.StringType()).count()
    assert 0 < kept < 40
    got = complete(df, recording(second, lambda t: t + "!"), memo=memo).collect()
    assert {r.id: r.answer for r in got} == {k: f"p{k}!" for k in range(40)}
    assert sum(asked(second).values()) == 40 - kept and asked(second)["p7"] == 1


def test_failures_are_tried_again_then_left_open(spark, tmp_path):
    def never(text):
        if text == "bad":
            raise RuntimeError("no")
        return text

    df = spark.createDataFrame([(1, "bad"), (2, "good")], "id long, prompt string")
    memo, log = memo_at(spark, attempts=3), folder_of(tmp_path, "log")
    got = {r.id: (r.answer, r.code) for r in complete(df, recording(log, never), code_col="code", memo=memo).collect()}
    assert got == {1: (None, "701174"), 2: ("good", None)}
    assert asked(log)["bad"] >= 3 and answers(spark, memo, T.StringType()).count() == 1
    assert complete(df.where("id = 1"), recording(log, str), memo=memo).first().answer == "bad"


def test_attempts_ask_only_what_is_open():
    calls = []

    def ask(texts):
        calls.append(list(texts))
        return [None if len(calls) < 3 and t == "b" else t for t in texts]

    assert persistent(ask, ["a", "b", "c"], 5, 0.0) == ["a", "b", "c"]
    assert calls == [["a", "b", "c"], ["b"], ["b"]] and persistent(ask, [], 2, 0.0) == []


def test_vectors_are_kept_between_stores(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k % 5}") for k in range(20)], "doc_id long, text string")
    memo, log = memo_at(spark), folder_of(tmp_path, "log")
    embedder = model_embedder(recording(log, lambda t: np.array([len(t), ord(t[-1]), 1.0])), 3, memo)
    paths = [scratch_path(spark, "memo-kb") for _ in range(2)]
    for path in paths:
        assert add_to_knowledge(docs, path, "kb", None, parse_docs=False, split=False, dim=3, embedder=embedder)["written"] == 5
    stored = [sorted((r.text, r.embedding) for r in store_scan(spark, p, "kb").collect()) for p in paths]
    assert stored[0] == stored[1] and stored[0][3] == ("text 3", [6.0, 51.0, 1.0])
    assert asked(log) == Counter({f"text {k}": 1 for k in range(5)})


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id long, prompt string")
    assert complete(df, recording(folder_of(tmp_path, "log"), str), memo=memo_at(spark)).collect() == []
