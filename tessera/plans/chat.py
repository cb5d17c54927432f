"""Chat with memory and knowledge over a table of requests."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import errors as E
from tessera.functions.prompt import response_struct, system_prompt, user_message_parts
from tessera.functions.text import session_default
from tessera.operators.infer import coerce_output, isolate
from tessera.operators.memory import last_n
from tessera.plans.knowledge import get_from_knowledge, rag_context

#: Gets requests ``{"system": str, "messages": [{"type", "text"}], "parts": [{"kind",
#: "text", "mime"}]}`` and gives for each ``{"content", "input_tokens",
#: "output_tokens", "finish_reason"}``.
ChatFn = Callable[[list[dict]], list[dict | None]]

KNOWLEDGE = "\n\nKnowledge:\n"
#: Requests given to a model at once.
CHAT_ROWS = 256
_REPLY = {"content": T.StringType(), "input_tokens": T.LongType(), "output_tokens": T.LongType(), "finish_reason": T.StringType()}


def chat_complete(df: DataFrame, fn_factory: Callable[[], ChatFn], *, request_col: str = "request") -> DataFrame:
    """``df`` with the reply's fields; all null where the model failed for the row."""
    schema = T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in _REPLY.items()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = fn_factory()
        for pdf in (batch.iloc[at:at + CHAT_ROWS].copy() for batch in batches for at in range(0, len(batch), CHAT_ROWS)):
            replies = [r or {} for r in isolate(fn, [json.loads(x) for x in pdf[request_col]])]
            for name in _REPLY:
                pdf[name] = pd.Series([r.get(name) for r in replies], dtype="Int64" if "tokens" in name else object, index=pdf.index)
            yield pdf

    return df.mapInPandas(run, schema)


def chat(requests: DataFrame, messages: DataFrame, fn_factory: Callable[[], ChatFn], *, max_history: int = 20,
         role: str = "", instructions: str = "", output_type: str = "string", store: DataFrame | None = None,
         k: int = 5, min_score: float = 0.75, store_filter=None, embedder=None,
         dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Answers ``requests`` (request_id, session_id, prompt, attachments JSON) with the
    last ``max_history`` messages of their sessions, the system prompt, and the texts
    that ``store`` holds near the prompt (``embedder`` and ``dim`` as in ``get_from_knowledge``).

    Returns the responses (``request_id, session_id, n_history, n_matches, response``,
    typed views, ``error_code``) and the turns to append to ``messages``: the user's
    and, where the model answered, the model's; a failed request (701174) adds
    none.  All requests of a call see the messages as given; several of one
    session are appended in the order of request_id."""
    asked = requests.select("request_id", session_default("session_id").alias("session_id"), "prompt", "attachments")
    own = messages.join(asked.select("session_id").distinct(), "session_id", "left_semi")
    window = last_n(own, max_history)
    history = (window.groupBy("session_id")
               .agg(F.array_sort(F.collect_list(F.struct("pos", "type", "text"))).alias("_h"))
               .select("session_id", F.transform("_h", lambda m: F.struct(m["type"].alias("type"), m["text"].alias("text"))).alias("history")))
    ends = own.groupBy("session_id").agg(F.max("seq").alias("_end"))
    if store is not None:
        hits = get_from_knowledge(store, asked.select(F.col("request_id").alias("query_id"), F.col("prompt").alias("text")),
                                  k, min_score, store_filter=store_filter, embedder=embedder, dim=dim)
        asked = rag_context(asked.withColumnRenamed("request_id", "query_id"), hits).withColumnRenamed("query_id", "request_id")
    else:
        asked = asked.withColumns({"context": F.lit(""), "n_matches": F.lit(0)})
    parts = user_message_parts("prompt", "attachments")
    known = F.when(F.length("context") > 0, F.array(F.struct(F.lit("TEXT").alias("kind"), F.concat(F.lit(KNOWLEDGE), "context").alias("text"),
                                                            F.lit(None).cast("string").alias("mime"))))
    empty = F.array().cast("array<struct<type:string,text:string>>")
    ready = (asked.join(history, "session_id", "left").withColumn("history", F.coalesce("history", empty))
             .withColumn("request", F.to_json(F.struct(
                 system_prompt(F.lit(role), F.lit(instructions)).alias("system"), F.col("history").alias("messages"),
                 F.concat(parts, F.coalesce(known, F.array().cast("array<struct<kind:string,text:string,mime:string>>"))).alias("parts")))))
    from tessera.session import cut_lineage
    # Written, as responses and turns both follow from one call of the model.
    answered = cut_lineage(chat_complete(ready.select("request_id", "session_id", "prompt", F.size("history").alias("n_history"), "n_matches", "request"), fn_factory))
    typed = coerce_output("content", "_type")
    failed = F.col("content").isNull()
    responses = answered.withColumn("_type", F.lit(output_type)).select(
        "request_id", "session_id", "n_history", "n_matches",
        F.when(~failed, response_struct("content", "input_tokens", "output_tokens", F.col("finish_reason"))).alias("response"),
        *[c.alias(n) for n, c in typed.items() if n != "error_code"],
        F.when(failed, F.lit(E.CHAT_COMPLETION)).otherwise(typed["error_code"]).alias("error_code"))
    turn = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("USER").alias("type"), F.col("prompt").alias("text")),
                             F.struct(F.lit(1).alias("turn"), F.lit("AI").alias("type"), F.col("content").alias("text"))))
    from pyspark.sql import Window
    order = Window.partitionBy("session_id").orderBy("request_id", "turn")
    turns = (answered.where(~failed).select("request_id", "session_id", turn.alias("_t")).select("request_id", "session_id", "_t.*")
             .join(ends, "session_id", "left")
             .select("session_id", (F.coalesce("_end", F.lit(-1)) + F.row_number().over(order)).cast("bigint").alias("seq"), "type", "text",
                     F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>").alias("tool_requests"),
                     F.lit(None).cast("string").alias("tool_result_id")))
    return responses, turns
