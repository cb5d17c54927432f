"""Prompt templates with ``${...}`` placeholders compiled once on the driver
to a native ``concat`` of literals and column references.

Placeholders: ``${path}`` and ``${exists(path) ? path : "text"}`` where
``path`` is ``col``, ``col.field``, ``col[0].field`` ...  A missing column is
an error (701181) unless guarded by ``exists``; NULL values render as ''.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import errors as E

_PLACEHOLDER = re.compile(r"\$\{([^{}]*)\}")
_COND = re.compile(r'^\s*exists\(\s*([^()]+?)\s*\)\s*\?\s*([^:]+?)\s*:\s*"([^"]*)"\s*$')
_SEG = re.compile(r"([A-Za-z_][A-Za-z0-9_]*)((?:\[\d+\])*)")


def _resolve(schema: T.StructType, path: str) -> Column | None:
    cur_type: T.DataType = schema
    col: Column | None = None
    for part in path.strip().split("."):
        m = _SEG.fullmatch(part.strip())
        if not m:
            raise E.TesseraError(E.PROMPT_ERROR, f"bad path {path!r}")
        name, idx = m.group(1), m.group(2)
        if not isinstance(cur_type, T.StructType) or name not in cur_type.names:
            return None
        cur_type = cur_type[name].dataType
        col = F.col(name) if col is None else col[name]
        for i in re.findall(r"\[(\d+)\]", idx):
            if not isinstance(cur_type, T.ArrayType):
                return None
            cur_type = cur_type.elementType
            col = col[int(i)]
    return col


def render(schema: T.StructType, template: str) -> Column:
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        body = m.group(1)
        cond = _COND.match(body)
        if cond:
            guarded, used, default = cond.group(1), cond.group(2), cond.group(3)
            c = _resolve(schema, guarded) if guarded.strip() == used.strip() else None
            parts.append(F.coalesce(c.cast("string"), F.lit(default)) if c is not None else F.lit(default))
        else:
            c = _resolve(schema, body)
            if c is None:
                raise E.TesseraError(E.PROMPT_ERROR, f"unknown placeholder {body!r}")
            parts.append(F.coalesce(c.cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def render_prompts(df: DataFrame, template: str, out_col: str = "prompt") -> DataFrame:
    return df.withColumn(out_col, render(df.schema, template))


DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."


def system_prompt(role, instructions) -> Column:
    """``# Role`` / ``## Instructions`` sections; both blank -> default text."""
    r = F.col(role) if isinstance(role, str) else role
    i = F.col(instructions) if isinstance(instructions, str) else instructions
    r_ok = F.coalesce(F.length(r) > 0, F.lit(False))
    i_ok = F.coalesce(F.length(i) > 0, F.lit(False))
    body = F.concat(F.when(r_ok, F.concat(F.lit("# Role\n"), r, F.lit("\n\n"))).otherwise(F.lit("")),
                    F.when(i_ok, F.concat(F.lit("## Instructions\n"), i)).otherwise(F.lit("")))
    return F.when(r_ok | i_ok, body).otherwise(F.lit(DEFAULT_SYSTEM_PROMPT))


ATTACHMENT = "struct<type:string,content:string>"
PART = "struct<kind:string,text:string,mime:string>"


def attachment_parts(attachments) -> Column:
    """JSON attachment object or array -> content parts: ``text/*`` -> TEXT
    (content kept as is), ``image/*`` -> IMAGE with its MIME type; entries
    without a type and all other types are dropped."""
    a = F.col(attachments) if isinstance(attachments, str) else attachments
    is_arr = F.ltrim(a).startswith("[")
    arr = F.when(is_arr, F.from_json(a, f"array<{ATTACHMENT}>")).otherwise(
        F.array(F.from_json(a, ATTACHMENT)))
    arr = F.filter(F.coalesce(arr, F.array().cast(f"array<{ATTACHMENT}>")),
                   lambda x: x.isNotNull() & x["type"].isNotNull())
    parts = F.transform(arr, lambda x: F.when(
        F.lower(x["type"]).startswith("text/"),
        F.struct(F.lit("TEXT").alias("kind"), x["content"].alias("text"), F.lit(None).cast("string").alias("mime")))
        .when(F.lower(x["type"]).startswith("image/"),
              F.struct(F.lit("IMAGE").alias("kind"), x["content"].alias("text"), x["type"].alias("mime"))))
    return F.filter(parts, lambda p: p.isNotNull())


def user_message_parts(prompt, attachments) -> Column:
    """Prompt (when non-empty) as the first TEXT part, then attachment parts."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    head = F.when(F.coalesce(F.length(p) > 0, F.lit(False)), F.array(F.struct(
        F.lit("TEXT").alias("kind"), p.alias("text"), F.lit(None).cast("string").alias("mime")))
    ).otherwise(F.array().cast(f"array<{PART}>"))
    return F.concat(head, attachment_parts(attachments))


def response_struct(content, input_tokens, output_tokens, finish_reason="STOP",
                    tool_executions=None) -> Column:
    """Chat response in its fixed field order; usage defaults to 0."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    i = F.coalesce(c(input_tokens).cast("bigint"), F.lit(0).cast("bigint"))
    o = F.coalesce(c(output_tokens).cast("bigint"), F.lit(0).cast("bigint"))
    te = (tool_executions if tool_executions is not None else
          F.array().cast("array<struct<request:struct<id:string,name:string,arguments:string>,result:string>>"))
    fr = F.lit(finish_reason) if isinstance(finish_reason, str) else finish_reason
    return F.struct(c(content).alias("content"),
                    F.struct(i.alias("inputTokenCount"), o.alias("outputTokenCount"),
                             (i + o).alias("totalTokenCount")).alias("tokenUsage"),
                    fr.alias("finishReason"), te.alias("toolExecutions"))
