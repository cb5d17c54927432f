"""A stream of questions answered against a static store, one
micro-batch at a time (a rank window cannot run on a stream directly)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.plans.knowledge import get_from_knowledge
from tessera.streaming.runner import run_available_now


def answer_stream(questions_stream: DataFrame, store: DataFrame, out_path: str, **search) -> str:
    def batch(df: DataFrame, batch_id: int) -> None:
        # One folder per batch id, overwritten on retry: a replayed batch
        # after a failure replaces its own output instead of duplicating it.
        hits = get_from_knowledge(store, df, **search)
        hits.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    run_available_now(questions_stream, name="questions", foreach_batch=batch)
    return out_path
