"""A memo table of model calls.

Answers are rows ``key, value`` by model, the key being a hash of model and
text.  A text is asked once, however many rows hold it, and never again once its
answer is stored.  Every task commits the answers it has when it ends, not
when the job ends, so a lost executor or a stopped job costs only the calls
of the tasks that were running."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage
from tessera.sources.vector_store import path_exists

#: More tasks than this are not made: then a task has more calls.
MOST_TASKS = 20_000


@dataclass(frozen=True)
class Memo:
    """Where answers are kept (a folder that driver and executors share), under
    which name of the model and its settings, and how a model is asked: texts a task,
    attempts a text, and seconds before the second attempt (doubled for each later one)."""
    path: str
    model: str
    calls_per_task: int = 256
    attempts: int = 3
    delay: float = 1.0


def memo_key(model: str, text: Column) -> Column:
    return F.sha2(F.concat(F.lit(model), F.lit("\u0001"), text), 256)


def answers(spark: SparkSession, memo: Memo, value_type: T.DataType) -> DataFrame:
    """``key, value`` of the memo's model; a key that two runs asked at one time may be there twice."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", value_type), T.StructField("model", T.StringType())])
    if not path_exists(spark, memo.path):
        return spark.createDataFrame([], schema).select("key", "value")
    return spark.read.schema(schema).parquet(memo.path).where(F.col("model") == memo.model).select("key", "value")


def persistent(ask: Callable[[list], list], inputs: list, attempts: int, delay: float) -> list:
    """``ask`` (one output per input, None for a failure), asked again for its failures,
    ``attempts`` times in all, with growing pauses."""
    out, open_ = [None] * len(inputs), list(range(len(inputs)))
    for attempt in range(attempts):
        if attempt and open_:
            time.sleep(delay * 2 ** (attempt - 1))
        for k, value in zip(open_, ask([inputs[k] for k in open_]) if open_ else []):
            out[k] = value
        open_ = [k for k in open_ if out[k] is None]
    return out


def ask_once(df: DataFrame, memo: Memo, ask_factory: Callable[[], Callable[[list[str]], list]], value_type: T.DataType, *,
             text_col: str, out_col: str) -> DataFrame:
    """``df`` with ``out_col``: the model's answer to ``text_col``, from the memo or, where it
    has none, from ``ask_factory()`` (made once a task; gives one output per
    text, None for a failure).

    Failures are asked again ``memo.attempts`` times, then give null and are not stored, so the
    next run tries them anew.  Null texts give null without a call; repeated rows
    stay and share one call; an empty table asks nothing.  A column named
    ``out_col`` is replaced.  Runs at once: the calls are made before this returns."""
    spark, key = df.sparkSession, "_memo_key"
    while key in df.columns:
        key += "_"
    keyed = cut_lineage(df.drop(out_col).withColumn(key, memo_key(memo.model, F.col(text_col))))
    wanted = keyed.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.first(text_col).alias("text"))
    missing = cut_lineage(wanted.join(answers(spark, memo, value_type).select("key"), "key", "left_anti"))
    n = missing.count()
    if n:
        schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", value_type)])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ask = None
            for pdf in batches:
                if len(pdf):
                    ask = ask or ask_factory()
                    values = persistent(ask, pdf["text"].tolist(), memo.attempts, memo.delay)
                    yield pd.DataFrame({"key": pdf["key"], "value": pd.Series(values, index=pdf.index, dtype=object)})

        tasks = min(-(-n // memo.calls_per_task), MOST_TASKS)
        asked = missing.repartition(tasks, "key").mapInPandas(run, schema).where(F.col("value").isNotNull())
        # The second version of the committer makes a task's files final when the task ends.
        (asked.withColumn("model", F.lit(memo.model)).write.mode("append").partitionBy("model")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(memo.path))
    found = (answers(spark, memo, value_type).join(wanted.select("key"), "key", "left_semi")
             .groupBy(F.col("key").alias(key)).agg(F.min("value").alias(out_col)))
    return keyed.join(found, key, "left").drop(key)
