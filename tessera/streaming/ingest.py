"""Continuous knowledge ingest.  Each micro-batch runs the batch
``add_to_knowledge``; content ids already in the store are skipped, so a
re-delivered batch (after a failure) writes nothing twice.  Rows that can't be
ingested go to a quarantine table of their batch, and the stream goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.plans.knowledge import add_to_knowledge
from tessera.streaming.runner import run_available_now


def ingest_stream(docs_stream: DataFrame, store_path: str, store: str | None = None,
                  namespace: str | None = None, *, quarantine_path: str | None = None, **opts) -> dict[str, int]:
    """Drain ``docs_stream`` into the store; returns the summed counts.  Bad rows are
    written to ``quarantine_path`` (default: beside the store), one folder a batch."""
    total = {"batches": 0, "written": 0, "duplicate": 0, "invalid": 0}
    quarantine = quarantine_path or f"{store_path.rstrip('/')}-quarantine"

    def batch(df: DataFrame, batch_id: int) -> None:
        counts = add_to_knowledge(df, store_path, store, namespace, strict=False,
                                  quarantine_path=f"{quarantine}/batch_id={batch_id}", quarantine_mode="overwrite", **opts)
        total["batches"] += 1
        for name, n in counts.items():
            total[name] += n

    run_available_now(docs_stream, name="ingest", foreach_batch=batch)
    return total
