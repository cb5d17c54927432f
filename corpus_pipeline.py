"""From raw documents to training tokens, one stage at a time.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept; its result is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, mixing, queries, simhash, toxicity
from tessera.session import cut_lineage
from tessera.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject (score under 0.5)."""
    net = queries.toxicity_model(docs, table(spark, sf_dir, "labels"))
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    scored = toxicity.score(docs, net, out_col=name)
    return scored.where(F.col(name) < 0.5).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for the case of A-Z, the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by close fingerprints, the one with the smallest id."""
    return simhash.drop_near_copies(docs, shingle=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of ids and of the text decoded again."""
    return queries.bpe_digests(docs.select("doc_id", "text"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies), ("mixing", mix), ("bpe", encode)]

#: SQL can't express a trained network or the merge rounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
