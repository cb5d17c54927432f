"""Physical-plan checks for the scale claims: partial top-N before the
shuffle, no Python in native operators, filters and columns pushed into
the parquet scan."""

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import memory as M
from tessera.plans import fixtures as FX
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_last_n_uses_partial_window_group_limit(spark):
    plan = _plan(M.last_n(FX.messages(spark, SF_SMALL), 4))
    assert "WindowGroupLimit" in plan


def test_html_and_memory_operators_stay_in_the_jvm(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for df in (pages.select(X.html_to_text("html")), pages.select(X.html_to_markdown("html")),
               M.transcript(M.last_n(FX.messages(spark, SF_SMALL), 4)),
               M.sanitize_tool_messages(FX.agent_log(spark, SF_SMALL))):
        plan = _plan(df)
        assert "Python" not in plan and "ArrowEval" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df = docs.where(F.col("lang") == "fr").select("doc_id", X.content_uuid("text").alias("id"))
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan


def test_dedup_is_a_partial_aggregate(spark):
    from tessera.plans.knowledge import dedup_segments, prepare_segments
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    plan = _plan(dedup_segments(prepare_segments(docs, parse_docs=False, split=False)))
    assert plan.count("SortAggregate") + plan.count("HashAggregate") + plan.count("ObjectHashAggregate") >= 2


def test_single_query_search_is_take_ordered(spark):
    from tessera.operators.search import search_one
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    plan = _plan(search_one(emb, [0.1] * 64, 5))
    assert "TakeOrderedAndProject" in plan


def test_results_do_not_depend_on_shuffle_partitions(spark):
    import __spark_entry__ as se
    from tests.oracle import digest
    names = ["memory_window", "ingest_summary", "tool_results_join", "memory_sanitize", "transcript"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = {}
        for n in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            for name in names:
                df = se.queries()[name](spark, SF_SMALL)
                h, _ = digest(df.columns, [tuple(r) for r in df.collect()])
                seen.setdefault(name, set()).add(h)
        assert all(len(v) == 1 for v in seen.values()), seen
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_retrieval_join_back_never_shuffles_the_store(spark):
    import __spark_entry__ as se
    plan = _plan(se.queries()["get_from_knowledge"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_page_is_stripped_once(spark):
    from tessera.operators.parse import parse
    plan = _plan(parse(FX.typed_docs(spark, SF_SMALL)).select("doc_id", "text"))
    assert plan.count(r"(?is)\A") == 4  # what is before the body, and after it, in both parts of the union


def test_a_content_id_takes_one_md5(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert _plan(docs.select(F.when(F.length("text") > 0, X.content_uuid("text")).alias("id"))).count("md5(") == 1
