"""Document parsing: route by declared type, then text / HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import errors as E
from tessera.functions.text import html_to_text

# Declared type names (case-insensitive) and their parser kind.
PARSER_TYPES = {
    "markdown-to-text": "TEXT",
    "html-to-text": "HTML_TO_TEXT",
    "pdf-to-text": "PDF",
    "doc-to-text": "OFFICE",
    "docx-to-text": "OFFICE",
    "ppt-to-text": "OFFICE",
    "pptx-to-text": "OFFICE",
    "xls-to-text": "OFFICE",
    "xlsx-to-text": "OFFICE",
}


def parser_kind(type_col) -> F.Column:
    t = F.lower(F.col(type_col) if isinstance(type_col, str) else type_col)
    m = F.create_map(*[x for kv in PARSER_TYPES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[t]


def route(df: DataFrame, type_col: str = "type") -> DataFrame:
    """Add ``parser``; unknown types get ``error_code`` 701143."""
    return (df.withColumn("parser", parser_kind(type_col))
            .withColumn("error_code", F.when(F.col("parser").isNull(),
                                             F.lit(E.UNSUPPORTED_PARSER_TYPE))))


def parse(df: DataFrame, type_col: str = "type", payload_col: str = "payload") -> DataFrame:
    """Add ``text`` and ``error_code``.

    TEXT passes the payload through unchanged (markdown is not stripped);
    HTML keeps the visible body text (without body tags all but the head is body); binary
    formats have no parser in this engine and are quarantined with 701142.
    """
    r = route(df, type_col)
    p = F.col(payload_col)
    text = (F.when(F.col("parser") == "TEXT", p)
            .when(F.col("parser") == "HTML_TO_TEXT", html_to_text(p)))
    code = (F.when(F.col("parser").isNull(), F.lit(E.UNSUPPORTED_PARSER_TYPE))
            .when(p.isNull(), F.lit(E.PARSE_ERROR))
            .when(F.col("parser").isin("PDF", "OFFICE"), F.lit("701142")))
    return r.withColumn("text", text).withColumn("error_code", code)
