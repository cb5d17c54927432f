"""Ingest idempotence, quarantine, memory operators and streaming = batch."""

import pytest
from pyspark.sql import functions as F

from tessera import errors as E
from tessera.operators import memory as M
from tessera.operators import tools as TL
from tessera.plans.knowledge import add_to_knowledge
from tessera.sources.vector_store import scratch_path, store_scan
from tests.conftest import SF_SMALL


def _arrive_later(folder: str, seconds: int = 60) -> None:
    """Order test stream files explicitly: the file source takes files oldest
    first, so move the modification time of ``folder``'s files forward
    (test scratch folders are local)."""
    import os
    import time
    local = folder.replace("file:", "")
    t = time.time() + seconds
    for root, _, files in os.walk(local):
        for f in files:
            os.utime(os.path.join(root, f), (t, t))


def test_ingest_twice_equals_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    path = scratch_path(spark, "t-store")
    first = add_to_knowledge(docs, path, "kb", None, parse_docs=False)
    n1 = store_scan(spark, path, "kb").count()
    second = add_to_knowledge(docs, path, "kb", None, parse_docs=False)
    assert store_scan(spark, path, "kb").count() == n1 == first["written"]
    assert second["written"] == 0 and second["duplicate"] > 0


def test_all_invalid_raises(spark):
    df = spark.createDataFrame([(1, "rtf-to-text", "x")], "doc_id long, type string, payload string")
    with pytest.raises(E.TesseraError):
        add_to_knowledge(df, scratch_path(spark, "t-bad"), "kb")


def _msgs(spark, rows):
    return spark.createDataFrame(
        rows, "session_id string, seq long, type string, text string, "
              "tool_requests array<struct<id:string,name:string,arguments:string>>, tool_result_id string")


def test_sanitize_tool_messages(spark):
    req = lambda *ids: [(i, "t", "{}") for i in ids]
    rows = [("s", 1, "USER", "hi", None, None),
            ("s", 2, "TOOL", "orphan", None, "x"),          # no request before -> dropped
            ("s", 3, "AI", None, req("a", "b"), None),     # b never answered -> dropped
            ("s", 4, "TOOL", "ra", None, "a"),             # answers a -> kept
            ("s", 5, "AI", None, req("c"), None),          # answered -> kept
            ("s", 6, "TOOL", "rc", None, "c"),
            ("s", 7, "TOOL", "rc2", None, "c")]            # repeated result -> dropped
    kept = {r.seq for r in M.sanitize_tool_messages(_msgs(spark, rows)).collect()}
    assert kept == {1, 4, 5, 6}
    strict = {r.seq for r in M.sanitize_tool_messages(_msgs(spark, rows), strict=True).collect()}
    assert strict == {1, 5, 6}


def test_sanitize_keeps_every_row_of_a_seq(spark):
    req = lambda *ids: [(i, "t", "{}") for i in ids]
    rows = [("s", 1, "AI", "one", req("a"), None),
            ("s", 1, "AI", "two", req("a"), None),         # the same seq, another text
            ("s", 1, "AI", "two", req("a"), None),         # delivered again
            ("s", 1, "AI", "open", req("b"), None),        # the same seq, never answered -> dropped
            ("s", 2, "TOOL", "ra", None, "a"), ("s", 2, "TOOL", "ra", None, "a"),
            ("s", 2, "TOOL", "orphan", None, "x"),         # the same seq, no request -> dropped
            ("s", 3, "TOOL", "late", None, "a"),           # already answered -> dropped
            (None, None, "AI", "n", req(None, "c"), None), (None, None, "AI", "n", req(None, "c"), None),
            (None, 1, "TOOL", "rn", None, None), (None, 2, "TOOL", "rc", None, "c")]
    want = ["n", "n", "one", "ra", "ra", "rc", "rn", "two", "two"]
    for strict in (False, True):
        got = M.sanitize_tool_messages(_msgs(spark, rows), strict=strict)
        assert sorted(r.text for r in got.collect()) == want


def test_sanitize_splits_a_busy_id(spark, monkeypatch):
    import random
    random.seed(5)
    rows, open_, want = [], False, set()
    for seq in random.sample(range(2000), 400):
        rows.append(("s", seq, *random.choice([("AI", None, [("a", "t", "{}")], None), ("TOOL", "r", None, "a")])))
    for r in sorted(rows, key=lambda r: r[1]):
        if r[2] == "AI" or open_:
            want.add(r[1])
        open_ = r[2] == "AI"
    for width in (1, 7, 300, 4096):
        monkeypatch.setattr(M, "SEQ_BUCKET", width)
        assert {r.seq for r in M.sanitize_tool_messages(_msgs(spark, rows)).collect()} == want
    monkeypatch.undo()
    wide = spark.range(40_000).selectExpr("'s' AS session_id", "id AS seq", "if(id % 2 = 0, 'AI', 'TOOL') AS type", "'x' AS text",
        "if(id % 2 = 0, array(named_struct('id', 'a', 'name', 't', 'arguments', '{}')), NULL) AS tool_requests", "if(id % 2 = 1, 'a', NULL) AS tool_result_id")
    out = M.sanitize_tool_messages(wide)
    assert out.count() == 40_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("text" not in x for x in windows)  # windows see events, not messages
    assert all("_place" in x or "_last" in x or "_most" in x for x in windows)  # by seq range, or over ranges


def test_long_transcripts_come_in_bounded_ordered_parts(spark):
    rows = [("long", k, "AI" if k % 2 else "USER", f"text {k}", None, None) for k in range(300)]
    rows += [("long", 300, "AI", None, None, None), ("long", 301, "SYSTEM", "s", None, None),
             ("short", 5, "USER", None, None, None), (None, None, "USER", "a", None, None), (None, 2000, "AI", "b", None, None)]
    line = lambda r: ("User: " if r[2] == "USER" else "Assistant: ") + (r[3] or "") + "\n"
    whole = "".join(map(line, rows[:300]))
    msgs = _msgs(spark, rows)
    chunks = sorted((r.chunk, r.text, r.n_lines) for r in M.transcript_chunks(msgs, width=10).where("session_id = 'long'").collect())
    assert [c[0] for c in chunks] == list(range(30)) and {c[2] for c in chunks} == {10}
    assert "".join(c[1] for c in chunks) == whole
    out = M.transcript(msgs, width=10, max_bytes=500).collect()
    parts = sorted((r.part, r.transcript, r.n_lines) for r in out if r.session_id == "long")
    assert len(parts) > 5 and parts[0][0] == 0 and "".join(p[1] for p in parts) == whole and sum(p[2] for p in parts) == 300
    assert max(len(p[1]) for p in parts) <= 500 + max(len(c[1]) for c in chunks)
    assert {(r.session_id, r.part, r.transcript, r.n_lines) for r in out if r.session_id != "long"} == {
        ("short", 0, "User: \n", 1), (None, 0, "User: a\nAssistant: b\n", 2)}
    one = [r for r in M.transcript(msgs).collect() if r.session_id == "long"]
    assert [(r.part, r.transcript, r.n_lines) for r in one] == [(0, whole, 300)]
    memory = M.rebuild_with_summary(msgs.where("type = 'SYSTEM'"), M.transcript(msgs, width=10, max_bytes=500).withColumnRenamed("transcript", "summary"))
    got = sorted((r.seq, r.type, r.text) for r in memory.collect() if r.session_id == "long")
    assert got[0] == (0, "SYSTEM", "s") and {g[1] for g in got[1:]} == {"USER"}
    assert [g[0] for g in got[1:]] == [p[0] + 1 for p in parts] and "".join(g[2] for g in got[1:]) == M.SUMMARY_PREFIX + whole


def test_system_message_fix(spark):
    rows = [("a", 1, "SYSTEM", "s1", None, None), ("a", 2, "USER", "u", None, None),
            ("a", 3, "SYSTEM", "s2", None, None), ("b", 5, "USER", "u", None, None)]
    out = sorted((r.session_id, r.seq, r.text) for r in M.fix_system_message(_msgs(spark, rows)).collect())
    assert out == [("a", 1, "s1"), ("a", 2, "u"), ("b", 4, "You are a helpful assistant."), ("b", 5, "u")]


def test_tool_matching_timeout_and_blank(spark):
    calls = spark.createDataFrame(
        [("s", "r1", "t", "{}", 1), ("s", "r2", "t", "{}", 2), ("s", "r3", "t", "{}", 3)],
        "session_id string, request_id string, name string, arguments string, sec int"
    ).withColumn("ts", F.timestamp_seconds("sec")).withColumn("seq", F.col("sec").cast("long")).drop("sec")
    results = spark.createDataFrame(
        [("s", "r1", "ok", 5, 10), ("s", "r2", " ", 3, 11), ("s", "r2", "late", 20, 12), ("s", "r3", "b", 13, 13)],
        "session_id string, request_id string, result string, sec int, seq long"
    ).withColumn("ts", F.timestamp_seconds("sec")).drop("sec")
    got = {r.request_id: r.result for r in TL.match_results(calls, results, 10).collect()}
    assert got == {"r1": "ok", "r2": TL.TOOL_EXECUTION_FAILED, "r3": "b"}


def test_cap_calls(spark):
    df = (spark.range(101).select(F.lit("s").alias("session_id"), F.col("id").alias("seq"),
                                  F.timestamp_seconds("id").alias("ts"), F.lit(True).alias("known")))
    codes = [r.error_code for r in TL.cap_calls(df).orderBy("seq").collect()]
    assert codes[:100] == [None] * 100 and codes[100] == E.TOO_MANY_TOOL_CALLS


def test_stream_window_multi_batch_equals_batch(spark):
    from tessera.plans.fixtures import messages
    from tessera.streaming.runner import run_available_now
    from tessera.streaming.sessions import latest_windows, running_window
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    src = scratch_path(spark, "t-conv")
    # turns arrive in three files, later turns first: order of arrival must not matter
    for part, cond in enumerate(["turn >= 4", "turn between 2 and 3", "turn < 2"]):
        conv.where(cond).write.parquet(f"{src}/p{part}")
    stream = (spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    out = run_available_now(running_window(messages(spark, SF_SMALL, stream), 3), name="t-win")
    got = {(r.session_id, r.seq, r.pos) for r in latest_windows(spark.read.parquet(out)).collect()}
    want = {(r.session_id, r.seq, r.pos) for r in M.last_n(messages(spark, SF_SMALL), 3).collect()}
    assert got == want


def _reference_fold(messages, limit, complete):
    """One message after another, as the definition says."""
    from tessera.functions.text import summary_of
    from tessera.operators.memory import SUMMARY_PREFIX
    from tessera.operators.summaries import prompt_for
    memory = []
    for m in messages:
        if len(memory) >= limit and len(memory) > 2:
            head = memory[:1] if memory[0][1] == "SYSTEM" else []
            try:
                answer = complete([prompt_for(memory)])[0]
            except RuntimeError:
                answer = None
            if answer is None:
                memory = head + memory[len(head) + 1:]
            else:
                memory = head + [(memory[-1][0], "USER", SUMMARY_PREFIX + summary_of(answer))]
        memory = memory + [m]
        if len(memory) > limit:
            del memory[1 if memory[0][1] == "SYSTEM" and len(memory) > 1 else 0]
    return memory


@pytest.mark.parametrize("limit", [2, 3, 5])
def test_summaries_equal_the_sequential_fold_and_lose_nothing(spark, monkeypatch, limit):
    from tessera.operators import summaries as S
    from tessera.plans.standin import extractive_answer_factory, failing_answer_factory
    sessions = {f"s{k}": [(i, "SYSTEM" if i == 0 and k % 2 else "USER" if i % 2 else "AI", f"text {k}.{i}. more") for i in range(k)] for k in range(14)}
    sessions["s3"][1] = (1, "AI", None)
    calls = []

    def counted(prompts):
        calls.append(len(prompts))
        return extractive_answer_factory()(prompts)

    got = S.fold({}, sessions, limit, counted)
    assert got == {s: _reference_fold(m, limit, extractive_answer_factory()) for s, m in sessions.items()}
    if limit > 2:
        assert max(calls) > 5 and len(calls) <= 13  # all sessions that are due share a call
    got = S.fold({}, sessions, limit, failing_answer_factory())
    assert got == {s: _reference_fold(m, limit, failing_answer_factory()) for s, m in sessions.items()}
    rows = [(s, *m) for s, ms in sessions.items() for m in ms]
    df = spark.createDataFrame(rows, "session_id string, seq long, type string, text string")
    first = S.continue_memories(df.where("seq < 4"), limit, extractive_answer_factory)
    both = S.continue_memories(df.where("seq >= 4"), limit, extractive_answer_factory, first).collect()
    want = {(s, *m, k) for s, ms in sessions.items() for k, m in enumerate(_reference_fold(ms, limit, extractive_answer_factory()))}
    assert {tuple(r) for r in both} == want


def test_every_message_reaches_a_summary_or_the_memory():
    from tessera.operators.summaries import fold
    seen = []

    def keeps_all(prompts):
        seen.extend(prompts)
        return [f"<summary>{p.split(chr(10) + chr(10), 1)[1]}</summary>" for p in prompts]

    messages = [(i, "USER", f"<t{i}>") for i in range(1, 30)]
    memory = fold({}, {"s": messages}, 6, keeps_all)["s"]
    text = " ".join(m[2] for m in memory)
    assert all(f"<t{i}>" in text for i in range(1, 30))


def test_stream_summaries_equal_the_batch_and_survive_a_replay(spark):
    from tessera.operators.summaries import continue_memories
    from tessera.plans.fixtures import messages
    from tessera.plans.standin import extractive_answer_factory
    from tessera.streaming.summaries import summarizing_memory
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    src = scratch_path(spark, "t-sum")
    for part, cond in enumerate(["turn < 2", "turn between 2 and 3", "turn >= 4"]):
        conv.where(cond).write.parquet(f"{src}/p{part}")
        _arrive_later(f"{src}/p{part}")
    stream = (spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    for every in (32, 2):
        got = summarizing_memory(messages(spark, SF_SMALL, stream), scratch_path(spark, "t-mem-out"), 4,
                                 extractive_answer_factory, compact_every=every)
        want = continue_memories(messages(spark, SF_SMALL), 4, extractive_answer_factory)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_memory_append_stamps_write_time(spark):
    from tessera.plans.fixtures import messages
    from tessera.sources import memory_store as MS
    path = scratch_path(spark, "t-mem")
    MS.append_messages(messages(spark, SF_SMALL), path, stamp=True)
    back = MS.read_messages(spark, path)
    assert back.where(F.col("ts").isNull()).count() == 0
    assert back.count() == messages(spark, SF_SMALL).count()
    assert back.select("bucket").distinct().count() > 1


def test_late_result_after_watermark_is_ignored(spark):
    """T5: a result that arrives after its call timed out (the call was
    already emitted unmatched when the watermark passed) is dropped.

    One single-file folder per micro-batch: the call; the sentinels that
    advance both watermarks; an unrelated event, whose batch evicts the
    timed-out call; then the late result.  State is evicted at the end of
    a batch, so a result arriving in the evicting batch itself would still
    join: that is why the third batch is there."""
    import datetime as dt

    from tessera.plans.fixtures import tool_calls, tool_results
    from tessera.streaming.runner import run_available_now
    from tessera.streaming.tool_calls import stream_match
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    far = t0 + dt.timedelta(days=2)
    src = scratch_path(spark, "t-late")
    batches = [[(1, t0, 7, "click", 1.0, '{"k": 3}')],
               [(2, far, 99, "click", 1.0, '{"k": 1}'), (3, far, 99, "purchase", 50.0, '{"k": 2}')],
               [(5, far, 98, "view", 1.0, '{"k": 9}')],
               [(4, t0 + dt.timedelta(seconds=5), 7, "purchase", 50.0, '{"k": 3}')]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/p{i}")
        _arrive_later(f"{src}/p{i}", 60 * (i + 1))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    out = run_available_now(stream_match(tool_calls(spark, "", stream), tool_results(spark, "", stream), 10, 60),
                            name="t-late")
    rows = {(r.session_id, r.result_seq) for r in spark.read.parquet(out).collect()}
    assert ("7", None) in rows and ("7", 4) not in rows


def test_model_embed_hook_keeps_rows_and_order(spark):
    import numpy as np

    from tessera.operators.embed import model_embed

    def factory():
        def fn(texts):
            return np.array([[len(t), t.count(" "), 1.0] for t in texts], dtype=np.float32)
        return fn
    df = spark.createDataFrame([(i, "a b " * i) for i in range(50)], "id int, text string").repartition(3)
    out = {r.id: list(r.embedding) for r in model_embed(df, factory, 3).collect()}
    assert out == {i: [float(len("a b " * i)), float(("a b " * i).count(" ")), 1.0] for i in range(50)}


def test_stored_sessions_are_read_and_deleted_by_bucket(spark):
    from tessera.plans.fixtures import messages
    from tessera.sources import memory_store as MS
    path = scratch_path(spark, "t-del")
    msgs = messages(spark, SF_SMALL)
    MS.append_messages(msgs.where("seq < 2"), path, buckets=16)
    MS.append_messages(msgs.where("seq >= 2"), path, buckets=99)  # the table keeps its 16
    some = msgs.select("session_id").distinct().orderBy("session_id").limit(3)
    rows = MS.read_sessions(spark, path, some)
    assert {(r.session_id, r.seq) for r in rows.collect()} == {(r.session_id, r.seq) for r in msgs.join(some, "session_id", "left_semi").collect()}
    scan = [x for x in rows._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in x]
    assert any("PartitionFilters: [" in x and "bucket" in x.split("PartitionFilters: ")[1].split("]")[0] for x in scan)
    files = set(MS.read_messages(spark, path).inputFiles())
    touched = MS.delete_stored_sessions(spark, path, some)
    assert MS.delete_stored_sessions(spark, path, some) == touched  # again: nothing more goes
    left = MS.read_messages(spark, path)
    assert {(r.session_id, r.seq) for r in left.collect()} == {(r.session_id, r.seq) for r in msgs.join(some, "session_id", "left_anti").collect()}
    other = {f for f in files if not any(f"bucket={b}/" in f for b in touched)}
    assert other <= set(left.inputFiles())
    everyone = msgs.select("session_id").distinct()
    MS.delete_stored_sessions(spark, path, everyone)
    assert MS.read_messages(spark, path).count() == 0


def test_split_quarantine(spark):
    from tessera.errors import split_quarantine
    df = spark.createDataFrame([(1, None), (2, "701143")], "id int, error_code string")
    good, bad = split_quarantine(df)
    assert [r.id for r in good.collect()] == [1]
    assert [(r.id, r.error_message) for r in bad.collect()] == [(2, "AI:ERROR_UNSUPPORTED_PARSER_TYPE")]


def test_second_ingest_embeds_nothing_and_metadata_is_kept(spark):
    import numpy as np

    from tessera.operators.embed import model_embedder
    from tessera.plans.knowledge import get_from_knowledge, match_list
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def fn(texts):
            calls.add(len(texts))
            return np.array([[len(t), t.count("e"), 1.0] for t in texts], dtype=np.float32)
        return fn
    embedder = model_embedder(factory, 3)
    docs = (spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
            .select("doc_id", "text", F.create_map(F.lit("lang"), F.col("lang"), F.lit("index"), F.lit("user")).alias("meta")))
    path = scratch_path(spark, "t-model")
    args = dict(dim=3, embedder=embedder, metadata_col="meta", parse_docs=False, split=False)
    first = add_to_knowledge(docs, path, "kb", None, **args)
    assert calls.value == first["written"] > 0
    again = add_to_knowledge(docs, path, "kb", None, **args)
    assert calls.value == first["written"] and again["written"] == 0 and again["duplicate"] == 40
    rows = store_scan(spark, path, "kb")
    assert {r.metadata["index"] for r in rows.collect()} == {"0"}
    q = spark.createDataFrame([(1, "some question"), (2, None)], "query_id int, text string")
    hits = get_from_knowledge(rows, q, 3, 0.0, dim=3, embedder=embedder, store_filter='metadataKey("lang").isEqualTo("fr")')
    got = hits.collect()
    assert {r.metadata["lang"] for r in got} == {"fr"} and {r.query_id for r in got} == {1}
    m = match_list(hits).first().matches
    assert [x.score for x in m] == sorted((x.score for x in m), reverse=True)
    assert set(m[0].asDict()) == {"score", "embeddingId", "embedding", "embedded"} and set(m[0].embedded.asDict()) == {"text", "metadata"}


def test_same_text_in_two_namespaces_is_two_hits(spark):
    from tessera.operators.embed import hash_embed
    from tessera.plans.knowledge import get_from_knowledge
    from tessera.sources.vector_store import store_append
    path = scratch_path(spark, "t-ns")
    row = hash_embed(spark.createDataFrame([("x", "alpha beta")], "id string, text string"), 256).withColumn("metadata", F.expr("map('k', 'v')"))
    for ns in ("a", "b"):
        store_append(row, path, "s", ns)
    q = spark.createDataFrame([(1, "alpha beta")], "query_id int, text string")
    hits = get_from_knowledge(store_scan(spark, path), q, 5, 0.5).collect()
    assert sorted((r["rank"], r.namespace) for r in hits) == [(1, "a"), (2, "b")]


def test_bad_batches_go_to_quarantine_and_the_stream_goes_on(spark):
    from tessera.streaming.ingest import ingest_stream
    src, path, bad = (scratch_path(spark, f"t-poison-{x}") for x in ("in", "store", "bad"))
    for part, rows in enumerate([[(1, "  "), (2, None)], [(3, "good words"), (4, "")]]):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{src}/p{part}")
        _arrive_later(f"{src}/p{part}")
    stream = (spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    counts = ingest_stream(stream, path, "kb", parse_docs=False, split=False, quarantine_path=bad)
    assert counts["written"] == 1 and counts["invalid"] == 3 and counts["batches"] == 2
    rows = spark.read.parquet(bad).collect()
    assert sorted(int(r.metadata["doc_id"]) for r in rows) == [1, 2, 4] and all(r.error_code for r in rows)


def test_flows_take_the_embedders_width(spark):
    import numpy as np

    from tessera.operators.embed import model_embedder
    from tessera.plans.chat import chat
    from tessera.plans.knowledge import get_from_knowledge, rag_chat

    def factory():
        return lambda texts: np.array([[t.count(c) for c in "abc"] for t in texts], dtype=np.float32)

    known = model_embedder(factory, 3)
    bare = lambda df, **cols: known(df, **cols)  # noqa: E731 - tells no width
    texts = [("1", "aaab"), ("2", "bbbc"), ("3", "ccca")]
    store = known(spark.createDataFrame(texts, "id string, text string")).withColumn("metadata", F.create_map().cast("map<string,string>"))
    wide = spark.createDataFrame([("4", "stray", [1.0] * 5)], "id string, text string, embedding array<float>")
    store = store.unionByName(wide.withColumn("metadata", F.create_map().cast("map<string,string>")))  # another width
    q = spark.createDataFrame([(1, "aab"), (2, "cca")], "query_id int, text string")
    want = {(1, "1"), (2, "3")}
    requests = q.selectExpr("query_id AS request_id", "'s' AS session_id", "text AS prompt", "cast(NULL AS string) AS attachments")

    def models(replies):
        return lambda: lambda asked: [replies(a) for a in asked]
    said = models(lambda r: {"content": r["parts"][-1]["text"], "input_tokens": 1, "output_tokens": 1, "finish_reason": "STOP"})
    for embedder in (known, bare):
        assert {(r.query_id, r.id) for r in get_from_knowledge(store, q, 1, 0.5, embedder=embedder).collect()} == want
        rag = rag_chat(q.withColumnRenamed("text", "question"), store, models(lambda p: p), k=1, min_score=0.5, embedder=embedder).collect()
        assert {(r.query_id, r.n_matches, r.answer.split("Knowledge:")[1].strip()) for r in rag} == {(1, 1, "aaab"), (2, 1, "ccca")}
        responses, _ = chat(requests, _msgs(spark, [("s", 1, "USER", "hi", None, None)]), said, store=store, k=1, min_score=0.5, embedder=embedder)
        assert {(r.request_id, r.n_matches, r.response.content.split("Knowledge:")[1].strip()) for r in responses.collect()} == {(1, 1, "aaab"), (2, 1, "ccca")}
    vectors = known(q).select("query_id", "embedding")
    assert {(r.query_id, r.id) for r in get_from_knowledge(store, vectors, 1, 0.5, embed=False).collect()} == want


def test_streams_hold_rows_without_order_or_user(spark, tmp_path):
    import datetime as dt

    from tessera.plans import q_stream
    from tessera.streaming.runner import run_available_now
    docs = [(None, "no id"), *[(k, f"text {k}") for k in range(9)]]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stream = q_stream._stream(spark, str(tmp_path), "documents", "doc_id", "text")
    assert sorted(r.text for r in spark.read.parquet(run_available_now(stream, name="t-null-order")).collect()) == sorted(t for _, t in docs)

    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    events = [(-3, at(1), -1, "click", 1.0, '{"k": 0}'), (-2, at(2), -1, "purchase", 50.0, '{"k": 0}'),
              (1, at(3), None, "click", 1.0, '{"k": 2}'), (2, at(4), 7, "click", 1.0, '{"k": 3}')]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    got = {(r.session_id, r.seq) for r in q_stream.q_stream_tool_results(spark, str(tmp_path)).collect()}
    assert got == {("-1", -3), (None, 1), ("7", 2)}


def test_one_failing_prompt_does_not_take_the_others_answers(spark):
    from tessera.operators.infer import complete

    def factory():
        def fn(prompts):
            if "bad" in prompts:
                raise RuntimeError("no")
            return [p.upper() for p in prompts]
        return fn
    df = spark.createDataFrame([("a",), ("bad",), ("b",)], "prompt string").coalesce(1)
    got = {r.prompt: (r.answer, r.error_code) for r in complete(df, factory, code_col="error_code").collect()}
    assert got == {"a": ("A", None), "b": ("B", None), "bad": (None, "701174")}


def test_scratch_folder_is_an_error_on_a_cluster_without_a_shared_one():
    from tessera.session import ensure_checkpoint_dir

    class Fake:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Fake.conf

            @staticmethod
            def getCheckpointDir():
                return None
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Fake)


def test_stream_ingest_replay_is_idempotent(spark):
    """Replaying the same files (e.g. after a lost checkpoint) writes
    nothing twice: content ids already stored are skipped."""
    from tessera.streaming.ingest import ingest_stream
    from tessera.streaming.runner import file_stream
    path = scratch_path(spark, "t-stream-store")
    src = f"{SF_SMALL}/documents.parquet"
    schema = spark.read.parquet(src).schema
    first = ingest_stream(file_stream(spark, src, schema).select("doc_id", "text"), path, "kb",
                          parse_docs=False, split=False)
    n = store_scan(spark, path, "kb").count()
    again = ingest_stream(file_stream(spark, src, schema).select("doc_id", "text"), path, "kb",
                          parse_docs=False, split=False)
    assert store_scan(spark, path, "kb").count() == n == first["written"]
    assert again["written"] == 0


def test_scratch_tables_are_removed_on_request(spark):
    from tessera import session as S
    from tessera.sources.vector_store import path_exists
    before, S._SCRATCH[:] = list(S._SCRATCH), []
    df = S.cut_lineage(spark.range(5))
    (path,) = S._SCRATCH
    assert df.count() == 5 and path_exists(spark, path)
    assert S.clear_scratch(spark) == 1 and not path_exists(spark, path) and not S._SCRATCH
    S._SCRATCH[:] = before
