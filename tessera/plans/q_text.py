"""Registered queries: document scan, parsing, HTML, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.parse import parse, route
from tessera.plans import sqlgen as G
from tessera.plans.fixtures import TYPED_DOCS_SQL, typed_docs
from tessera.operators.util import spread
from tessera.plans.registry import register
from tessera.sources.tables import table

_ROUTE_SQL = """
CASE lower(type) WHEN 'markdown-to-text' THEN 'TEXT' WHEN 'html-to-text' THEN 'HTML_TO_TEXT'
  WHEN 'pdf-to-text' THEN 'PDF'
  WHEN 'doc-to-text' THEN 'OFFICE' WHEN 'docx-to-text' THEN 'OFFICE' WHEN 'ppt-to-text' THEN 'OFFICE'
  WHEN 'pptx-to-text' THEN 'OFFICE' WHEN 'xls-to-text' THEN 'OFFICE' WHEN 'xlsx-to-text' THEN 'OFFICE'
END"""


@register("scan_documents", f"""
WITH {TYPED_DOCS_SQL}
SELECT origin, doc_id, type, length(payload)::BIGINT AS n_chars FROM typed_docs
""")
def q_scan_documents(spark, sf_dir):
    """Text and HTML payloads read in bulk as one typed document table."""
    return typed_docs(spark, sf_dir).select("origin", "doc_id", "type",
                                            F.length("payload").cast("bigint").alias("n_chars"))


@register("parse_route", f"""
WITH {TYPED_DOCS_SQL}, r AS (SELECT origin, doc_id, {_ROUTE_SQL} AS parser FROM typed_docs)
SELECT origin, doc_id, parser, CASE WHEN parser IS NULL THEN '701143' END AS error_code FROM r
""")
def q_parse_route(spark, sf_dir):
    """Route by case-insensitive type name; unknown -> 701143."""
    return route(typed_docs(spark, sf_dir)).select("origin", "doc_id", "parser", "error_code")


@register("parse_text", f"""
WITH {TYPED_DOCS_SQL}
SELECT origin, doc_id, payload AS text FROM typed_docs WHERE {_ROUTE_SQL} = 'TEXT'
""")
def q_parse_text(spark, sf_dir):
    """Markdown / plain text passes through unchanged."""
    p = parse(typed_docs(spark, sf_dir))
    return p.where(F.col("error_code").isNull() & (F.col("parser") == "TEXT")).select(
        "origin", "doc_id", "text")


@register("parse_documents", f"""
WITH {TYPED_DOCS_SQL}, r AS (SELECT *, {_ROUTE_SQL} AS parser FROM typed_docs)
SELECT origin, doc_id,
  CASE WHEN parser = 'TEXT' THEN payload
       WHEN parser = 'HTML_TO_TEXT' THEN {G.html_text('payload')} END AS text,
  CASE WHEN parser IS NULL THEN '701143' WHEN payload IS NULL THEN '701141'
       WHEN parser IN ('PDF', 'OFFICE') THEN '701142' END AS error_code
FROM r
""")
def q_parse_documents(spark, sf_dir):
    """Full parse with quarantine codes for every typed document."""
    return parse(typed_docs(spark, sf_dir)).select("origin", "doc_id", "text", "error_code")


@register("html_to_text", f"""
SELECT page_id, {G.html_text('html')} AS text FROM pages
""")
def q_html_to_text(spark, sf_dir):
    """Visible body text of every page, native regex chain."""
    pages = spread(table(spark, sf_dir, "pages"))
    return pages.select("page_id", X.html_to_text("html").alias("text"))


@register("html_to_markdown", f"""
SELECT page_id, {G.html_markdown('html')} AS markdown FROM pages
""")
def q_html_to_markdown(spark, sf_dir):
    """Markdown rendering of every page."""
    pages = spread(table(spark, sf_dir, "pages"))
    return pages.select("page_id", X.html_to_markdown("html").alias("markdown"))


@register("content_uuid", f"""
SELECT doc_id, {G.uuid3('text')} AS id FROM documents
""")
def q_content_uuid(spark, sf_dir):
    """Name-based UUID (MD5, v3) of each document text."""
    return table(spark, sf_dir, "documents").select("doc_id", X.content_uuid("text").alias("id"))
