"""Error codes and the quarantine convention.

Operators never fail a whole job for one bad row: they tag the row with an
``error_code`` (NULL when fine) and ``split_quarantine`` divides the frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error codes and messages of the original connector.
ERRORS = {
    "701111": "AI:ERROR_INVALID_INPUT_FOR_EMBEDDING_INGESTION",
    "701112": "AI:ERROR_EMBEDDING_INJECTION",
    "701121": "AI:ERROR_INVALID_INPUT_FOR_EMBEDDING_RETRIEVAL",
    "701141": "AI:ERROR_PARSE",
    "701142": "AI:ERROR_UNSUPPORTED_PARSER_INPUT",
    "701143": "AI:ERROR_UNSUPPORTED_PARSER_TYPE",
    "701144": "AI:ERROR_HTML_TO_TEXT",
    "701151": "AI:ERROR_INVALID_SPLITTING_STRATEGY",
    "701152": "AI:ERROR_FAILED_TO_SPLIT",
    "701161": "AI:ERROR_EMBEDDING_GENERATION",
    "701162": "AI:ERROR_INVALID_INPUT_FOR_EMBEDDING_GENERATION",
    "701171": "AI:ERROR_INVALID_INPUT_FOR_CHAT_KNOWLEDGE",
    "701172": "AI:ERROR_INVALID_INPUT_FOR_CHAT_MEMORY",
    "701173": "AI:ERROR_INVALID_OUTPUT_TYPE",
    "701174": "AI:ERROR_CHAT_COMPLETION",
    "701181": "AI:ERROR_PARSE_PROMPT",
    "701191": "AI:ERROR_EXCEEDED_SEQUENTIAL_TOOL_EXECUTIONS",
    "701192": "AI:ERROR_INVALID_TOOL_CONFIGURATION",
}

INVALID_INGEST = "701111"
INVALID_RETRIEVAL = "701121"
PARSE_ERROR = "701141"
UNSUPPORTED_PARSER_TYPE = "701143"
INVALID_STRATEGY = "701151"
FAILED_TO_SPLIT = "701152"
EMBEDDING_GENERATION = "701161"
INVALID_EMBED_INPUT = "701162"
INVALID_KNOWLEDGE = "701171"
INVALID_MEMORY = "701172"
INVALID_OUTPUT_TYPE = "701173"
CHAT_COMPLETION = "701174"
PROMPT_ERROR = "701181"
TOO_MANY_TOOL_CALLS = "701191"
INVALID_TOOL_CONFIG = "701192"


class TesseraError(ValueError):
    """Raised on the driver for invalid parameters (before any job runs)."""

    def __init__(self, code: str, detail: str = ""):
        self.code = code
        super().__init__(f"{code} {ERRORS.get(code, '')}: {detail}".strip())


def error_message(code_col: Column) -> Column:
    m = F.create_map(*[x for kv in ERRORS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[code_col]


def split_quarantine(df: DataFrame, code_col: str = "error_code") -> tuple[DataFrame, DataFrame]:
    """(good rows without the code column, bad rows with code and message)."""
    good = df.where(F.col(code_col).isNull()).drop(code_col)
    bad = (df.where(F.col(code_col).isNotNull())
           .withColumn("error_message", error_message(F.col(code_col))))
    return good, bad
