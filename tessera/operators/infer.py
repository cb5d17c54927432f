"""Batch inference hook: run a user-supplied completion function over a
table of prompts in Arrow batches.  The function factory runs once per
partition (load clients / models there); the model itself is not part of
this engine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import errors as E
from tessera.operators.memo import Memo, ask_once

CompleteFn = Callable[[list[str]], list[str | None]]


def isolate(fn: Callable[[list], list], inputs: list) -> list:
    """One output per input from one call of a model.  If the call fails, each
    input is tried alone, and only those that fail again give None."""
    if not inputs:
        return []
    try:
        out = list(fn(inputs))
    except Exception:  # noqa: BLE001 - whatever a model raises
        if len(inputs) == 1:
            return [None]
        return [x for p in inputs for x in isolate(fn, [p])]
    if len(out) != len(inputs):
        raise ValueError("a model must return one output per input")
    return out


def complete(df: DataFrame, fn_factory: Callable[[], CompleteFn], *, prompt_col: str = "prompt",
             out_col: str = "answer", code_col: str | None = None, memo: Memo | None = None) -> DataFrame:
    """Add ``out_col`` (STRING, NULL when the model failed for that row) and, if
    named, ``code_col`` (701174 for those rows).  With ``memo`` a prompt is asked once and its
    answer kept for later runs; null prompts are then not asked and count as failed."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = fn_factory()
        for pdf in batches:
            pdf[out_col] = isolate(fn, pdf[prompt_col].tolist())
            yield pdf

    def ask_factory():
        fn = fn_factory()
        return lambda prompts: isolate(fn, prompts)
    if memo is not None:
        out = ask_once(df, memo, ask_factory, T.StringType(), text_col=prompt_col, out_col=out_col)
    else:
        out = df.mapInPandas(run, schema)
    if code_col is not None:
        out = out.withColumn(code_col, F.when(F.col(out_col).isNull(), F.lit(E.CHAT_COMPLETION)))
    return out


# The output types a chat call can be coerced to.
OUTPUT_TYPES = ("string", "integer", "float", "boolean")


def coerce_output(text_col: str, type_col: str) -> dict[str, F.Column]:
    """Typed views of a model answer: integer (strict digits), float,
    boolean (``true`` ignoring case, anything else false), string; an
    unknown type name -> 701173."""
    t = F.trim(F.col(text_col))
    ty = F.lower(F.col(type_col))
    is_int = t.rlike(r"^[+-]?[0-9]+$")
    as_int = F.when((ty == "integer") & is_int, t.try_cast("int"))
    as_float = F.when(ty == "float", t.try_cast("float"))
    as_bool = F.when(ty == "boolean", F.lower(t) == "true")
    as_str = F.when(ty == "string", F.col(text_col))
    code = (F.when(~ty.isin(*OUTPUT_TYPES) | ty.isNull(), F.lit(E.INVALID_OUTPUT_TYPE))
            .when((ty == "integer") & as_int.isNull(), F.lit(E.INVALID_OUTPUT_TYPE))
            .when((ty == "float") & as_float.isNull(), F.lit(E.INVALID_OUTPUT_TYPE)))
    return {"int_value": as_int, "float_value": as_float, "bool_value": as_bool,
            "str_value": as_str, "error_code": code}
