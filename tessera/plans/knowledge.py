"""Knowledge-base flows: ``add_to_knowledge``, ``get_from_knowledge``, the
retrieval context, and chat with knowledge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import errors as E
from tessera.operators.embed import Embedder, hashing_embedder
from tessera.operators.ingest import with_content_id
from tessera.operators.parse import parse
from tessera.operators.search import vector_topk
from tessera.operators.split import DEFAULT_MAX_CHARS, DEFAULT_OVERLAP, split_documents
from tessera.operators.util import own_hash
from tessera.operators.validate import embedding_error, segment_error
from tessera.session import cut_lineage
from tessera.sources.vector_store import admit_ids, store_append, store_ids, uses_buckets

DEFAULT_DIM = 256


def prepare_segments(docs: DataFrame, *, parse_docs: bool = True, split: bool = True,
                     strategy: str = "Recursive", max_chars: int = DEFAULT_MAX_CHARS,
                     overlap: int = DEFAULT_OVERLAP, avoid_dups: bool = True,
                     key_cols: tuple[str, ...] = ("doc_id",),
                     carried: tuple[str, ...] | None = None) -> DataFrame:
    """parse -> split -> validate -> content id, one lazy pass (no branch
    re-reads the input).

    Input: ``key_cols`` (and ``carried`` columns, ``key_cols`` among them) + ``type``/``payload`` (when parsing) or ``text``.
    Output: ``key_cols, index, id, text, error_code``; a document that fails
    to parse or split yields one row with its code.
    """
    if parse_docs:
        df = parse(docs).select(*(carried or key_cols), "text", "error_code")
    else:
        df = docs.select(*(carried or key_cols), "text", F.lit(None).cast("string").alias("error_code"))
    if split:
        # posexplode_outer keeps failed documents as one row (NULL index).
        segs = split_documents(df.withColumnRenamed("error_code", "_parse_code"),
                               strategy, max_chars, overlap)
        segs = segs.withColumn("error_code", F.coalesce("_parse_code", "error_code")).drop("_parse_code")
    else:
        segs = df.withColumn("index", F.when(F.col("error_code").isNull(), F.lit(0)))
    segs = segs.withColumn("error_code", F.coalesce("error_code", segment_error("text")))
    segs = with_content_id(segs, avoid_dups)
    return segs.withColumn("id", F.when(F.col("error_code").isNull(), F.col("id")))


def dedup_segments(segs: DataFrame, *, key_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per content id (first by ``key_cols, index`` wins) with the
    number of ``copies``; invalid rows pass through one by one.

    A single partial aggregate: every map task collapses its copies before
    the shuffle, so an id holding a third of all rows stays cheap.
    """
    order = F.struct(*[F.col(c) for c in key_cols], F.col("index"))
    payload = F.struct(*[F.col(c) for c in segs.columns])
    own_key = F.to_json(F.struct(*[F.col(c) for c in key_cols], F.col("index")))
    group = F.when(F.col("error_code").isNull(), F.concat(F.lit("id:"), F.col("id"))).otherwise(
        F.concat(F.lit("bad:"), own_key, F.lit(":"), F.col("error_code")))
    return (segs.withColumn("_g", group).groupBy("_g")
            .agg(F.min_by(payload, order).alias("_r"), F.count(F.lit(1)).alias("copies"))
            .select("_r.*", "copies"))


def classify_ingest(unique: DataFrame, existing_ids: DataFrame | None, dim: int | None = DEFAULT_DIM,
                    embedder: Embedder | None = None) -> DataFrame:
    """Tag the unique segments, ``stored`` (id already in the store) first, and
    embed those that are neither stored nor invalid: ``status`` written /
    duplicate / invalid, ``copies``.  The embedder sees each new text once and no
    other; a good text for which it has no vector has code 701161."""
    if existing_ids is not None:
        # The store's ids are reduced to the batch's before they meet it again.
        hits = (existing_ids.select("id").join(unique.select("id"), "id", "left_semi")
                .distinct().withColumn("stored", F.lit(True)))
        tagged = unique.join(hits, "id", "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    else:
        tagged = unique.withColumn("stored", F.lit(False))
    new = F.col("error_code").isNull() & ~F.col("stored")
    emb = (embedder or hashing_embedder(dim or DEFAULT_DIM))(tagged.withColumn("_new_text", F.when(new, F.col("text"))), text_col="_new_text").drop("_new_text")
    failed = F.when(new & F.col("embedding").isNull(), F.lit(E.EMBEDDING_GENERATION))
    emb = emb.withColumn("error_code", F.coalesce("error_code", failed, F.when(~F.col("stored"), embedding_error("text", "embedding", dim))))
    return emb.withColumn("status", F.when(F.col("error_code").isNotNull(), F.lit("invalid"))
                          .when(F.col("stored"), F.lit("duplicate")).otherwise(F.lit("written")))


def _status_counts() -> list:
    """Count expressions over classified rows (a row stands for ``copies``)."""
    inv = F.col("status") == "invalid"
    return [F.sum(F.when(F.col("status") == "written", 1).otherwise(0)).alias("written"),
            F.sum(F.when(inv, F.col("copies")).otherwise(0)).alias("invalid"),
            F.sum(F.when(inv, 0).when(F.col("status") == "duplicate", F.col("copies"))
                  .otherwise(F.col("copies") - 1)).alias("duplicate")]


def ingest_summary(classified: DataFrame) -> DataFrame:
    """Counts per status plus the success flag (any row written or already
    present); one aggregate over the classified rows."""
    totals = classified.agg(*_status_counts())
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).cast("bigint").alias("n"))
                               for s in ("written", "duplicate", "invalid")]))
    return (totals.select(rows.alias("r")).select("r.*").where(F.col("n") > 0)
            .withColumn("success", F.col("status").isin("written", "duplicate")))


def knowledge_rows(docs: DataFrame, existing_ids: DataFrame | Callable[[DataFrame], DataFrame | None] | None = None, *, dim: int | None = DEFAULT_DIM,
                   key_cols: tuple[str, ...] = ("doc_id",), metadata_col: str | None = None,
                   embedder: Embedder | None = None, staged: bool = False, **opts) -> DataFrame:
    """Classified rows (``status``, ``copies``) with store columns ``id, embedding,
    text, metadata``: the map in ``metadata_col``, if any, with index and key columns
    added (which win).  ``staged`` writes the unique segments to the shared
    scratch folder before they are compared with the store, so that they are
    parsed and split once; ``existing_ids`` may then be a function of their ids."""
    carried = (*key_cols, *([metadata_col] if metadata_col else []))
    segs = prepare_segments(docs, key_cols=key_cols, carried=carried, **opts)
    unique = dedup_segments(segs, key_cols=key_cols)
    if staged:
        unique = cut_lineage(unique)
    if callable(existing_ids):
        existing_ids = existing_ids(unique.where(F.col("error_code").isNull()).select("id"))
    classified = classify_ingest(unique, existing_ids, dim, embedder)
    own = F.create_map(F.lit("index"), F.col("index").cast("string"),
                       *[x for k in key_cols for x in (F.lit(k), F.col(k).cast("string"))])
    if metadata_col is None:
        return classified.withColumn("metadata", own)
    taken = ["index", *key_cols]
    user = F.map_filter(F.coalesce(F.col(metadata_col), F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*taken))
    return classified.withColumn("metadata", F.map_concat(user, own))


def _append_written(rows: DataFrame, path: str, store: str | None, namespace: str | None, bucketed: bool, *,
                    staged: bool = False, extra: dict[str, Column] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Append the ``written`` ones of classified rows, with ``extra`` columns; also ``rows`` to read
    further and the counts per status.  With ``staged`` the rows are first written to the shared scratch folder
    (so that the embedder runs once) and counted there, else they are observed during the
    append.  A bucketed store needs the former: its rows are shuffled, and Spark drops
    what it observed before a shuffle that turned out empty."""
    from pyspark.sql import Observation

    def append(found: DataFrame) -> None:
        written = found.where(F.col("status") == "written").select("id", "embedding", "text", "metadata")
        store_append(written.withColumns(extra or {}), path, store, namespace, id_buckets=bucketed, noted=bucketed)

    if staged or bucketed:
        if not staged:  # nobody reads the other rows further: their texts aren't written
            new = F.col("status") == "written"
            kept = {c: F.when(new, F.col(c)) for c in ("id", "embedding", "text", "metadata", *(extra or {})) if c in rows.columns}
            rows = rows.select(*[c.alias(n) for n, c in kept.items()], "status", "copies")
        rows = cut_lineage(rows)
        append(rows)
        counts = rows.agg(*_status_counts()).first().asDict()
    else:
        obs = Observation("ingest")
        append(rows.observe(obs, *_status_counts()))
        counts = obs.get
    return rows, {k: int(v or 0) for k, v in counts.items()}


def add_to_knowledge(docs: DataFrame, store_path: str, store: str | None = None,
                     namespace: str | None = None, *, dim: int | None = DEFAULT_DIM,
                     key_cols: tuple[str, ...] = ("doc_id",), metadata_col: str | None = None,
                     embedder: Embedder | None = None, quarantine_path: str | None = None,
                     quarantine_mode: str = "append", strict: bool = True, id_buckets: bool = False, **opts) -> dict[str, int]:
    """parse -> split -> validate -> dedup -> look the ids up in the store -> embed
    the new ones -> append; the status counts are observed during the write.

    With ``quarantine_path`` invalid rows are written there with their codes.  A store that begins
    with ``id_buckets`` has membership filters, and later ingests open only buckets whose filters say maybe.
    Returns ``{"written", "duplicate", "invalid"}``.  Raises (``strict``) when rows were
    given and none could be written or were already present.
    """
    spark = docs.sparkSession
    bucketed = uses_buckets(spark, store_path, id_buckets)
    if bucketed:
        def existing(ids):
            return admit_ids(ids, store_path, store, namespace)
    else:
        existing = store_ids(spark, store_path, store, namespace)
    rows = knowledge_rows(docs, existing, dim=dim, key_cols=key_cols, metadata_col=metadata_col, embedder=embedder,
                          staged=existing is not None or quarantine_path is not None, **opts)
    rows, counts = _append_written(rows, store_path, store, namespace, bucketed, staged=quarantine_path is not None)
    if quarantine_path is not None and counts["invalid"]:
        (rows.where(F.col("status") == "invalid").select("id", "text", "metadata", "copies", "error_code")
         .withColumn("error_message", E.error_message(F.col("error_code"))).write.mode(quarantine_mode).parquet(quarantine_path))
    if strict and sum(counts.values()) > 0 and counts["written"] == 0 and counts["duplicate"] == 0:
        raise E.TesseraError(E.INVALID_INGEST, "no row could be ingested")
    return counts


def embed_queries(queries: DataFrame, dim: int | None = DEFAULT_DIM, *, text_col: str = "text",
                  embedder: Embedder | None = None) -> DataFrame:
    return (embedder or hashing_embedder(dim or DEFAULT_DIM))(queries, text_col=text_col)


def _identity(store: DataFrame) -> Column:
    """A row's identity in one text, in the order of ids: content ids are unique
    in a namespace of a store only."""
    parts = [F.col("id"), *[F.col(c) for c in ("store", "namespace") if c in store.columns]]
    return F.concat_ws("\u0001", *[F.coalesce(p, F.lit("")) for p in parts])


def get_from_knowledge(store: DataFrame, queries: DataFrame, k: int = 5, min_score: float = 0.75, *,
                       store_filter=None, dim: int | None = None, query_id_col: str = "query_id",
                       query_text_col: str = "text", embed: bool = True, embedder: Embedder | None = None,
                       store_blocks: int | None = None, query_blocks: int | None = None) -> DataFrame:
    """Top-k store rows per query text (or per query vector when ``embed=False``):
    ``query_id, rank, score, id, embedding, text, metadata`` (and ``store``,
    ``namespace`` where the store has them).  A store that holds an identity (store, namespace, id) twice gives it as one
    hit.  ``store_filter``: a Column, or text of the
    filter language over ``metadata``.  ``dim`` is by default the embedder's width, or
    where it tells none, as with vectors given, the query vectors' own."""
    from tessera.functions.filters import compile_filter

    s = store
    if store_filter is not None:
        s = s.where(compile_filter(store_filter) if isinstance(store_filter, str) else store_filter)
    s = s.withColumn("_key", _identity(store))
    if embed and dim is None:
        dim = getattr(embedder, "dim", None) if embedder else DEFAULT_DIM
    q = embed_queries(queries, dim, text_col=query_text_col, embedder=embedder) if embed else queries
    if dim is None:
        q = cut_lineage(q.select(query_id_col, "embedding"))  # the embedder runs once
        dim = q.agg(F.max(F.size("embedding"))).first()[0]
    hits = vector_topk(s.select(F.col("_key").alias("id"), "embedding"), q.select(query_id_col, "embedding"), k, min_score,
                       query_id_col=query_id_col, dim=dim, store_blocks=store_blocks, query_blocks=query_blocks)
    # The hits (k a query) meet the store again for its other columns.  Written,
    # their true size is known when Spark chooses the join.
    hits = cut_lineage(hits.withColumnRenamed("id", "_key"))
    where = [c for c in ("store", "namespace") if c in store.columns]
    found = s.join(hits, "_key").select(query_id_col, "rank", "score", "id", "embedding", "text", "metadata", *where)
    # Rows that repeat an identity (a replayed or concurrent append) are one hit: the first by its own values.
    one = Window.partitionBy(query_id_col, "rank").orderBy(own_hash(found))
    return found.withColumn("_copy", F.row_number().over(one)).where(F.col("_copy") == 1).drop("_copy")


def match_list(hits: DataFrame, query_id_col: str = "query_id") -> DataFrame:
    """``query_id, matches``: the hits by rank as array of (score, embeddingId,
    embedding, embedded (text, metadata)), at most k a query."""
    one = F.struct("rank", F.struct(F.col("score"), F.col("id").alias("embeddingId"), "embedding",
                                    F.struct("text", "metadata").alias("embedded")).alias("m"))
    return (hits.withColumn("_one", one).groupBy(query_id_col).agg(F.collect_list("_one").alias("_all"))
            .select(query_id_col, F.transform(F.array_sort("_all", lambda a, b: a["rank"] - b["rank"]), lambda x: x["m"]).alias("matches")))


def rag_context(questions: DataFrame, matches: DataFrame, *, query_id_col: str = "query_id",
                separator: str = "\n\n") -> DataFrame:
    """Attach the retrieved texts (by rank) to each question; questions with
    no match get an empty context.  The per-question group is bounded by k."""
    ctx = (matches.groupBy(query_id_col)
           .agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("_m"))
           .select(query_id_col, F.array_join(F.transform("_m", lambda m: m["text"]), separator)
                   .alias("context"), F.size("_m").alias("n_matches")))
    return (questions.join(ctx, query_id_col, "left")
            .withColumn("context", F.coalesce("context", F.lit("")))
            .withColumn("n_matches", F.coalesce("n_matches", F.lit(0))))


RAG_TEMPLATE = ("Answer the question using the knowledge below.\n\n"
                "Question: ${question}\n\nKnowledge:\n${exists(context) ? context : \"\"}")


def rag_chat(questions: DataFrame, store: DataFrame, complete_fn_factory, *, k: int = 5,
             min_score: float = 0.75, output_type: str = "string", query_id_col: str = "query_id",
             template: str = RAG_TEMPLATE, dim: int | None = None,
             embedder: Embedder | None = None, store_filter=None, memo=None) -> DataFrame:
    """render -> embed -> search -> attach knowledge -> complete -> coerce.

    ``questions``: ``query_id, question``.  Returns ``query_id, prompt,
    answer, n_matches`` + the typed views of the answer and ``error_code`` (701174 where the
    model failed, before all others).  ``memo`` (:class:`tessera.operators.memo.Memo`) keeps the
    answers, so that a prompt is asked once.
    """
    from tessera.functions.prompt import render_prompts
    from tessera.operators.infer import coerce_output, complete

    q = questions.withColumnRenamed("question", "text")
    hits = get_from_knowledge(store, q.select(query_id_col, "text"), k, min_score, dim=dim, embedder=embedder,
                              store_filter=store_filter, query_id_col=query_id_col)
    with_ctx = rag_context(q.withColumnRenamed("text", "question"), hits, query_id_col=query_id_col)
    prompts = render_prompts(with_ctx, template)
    answered = complete(prompts.select(query_id_col, "prompt", "n_matches"), complete_fn_factory, code_col="_failed", memo=memo)
    typed = coerce_output("answer", "_out_type")
    answered = answered.withColumn("_out_type", F.lit(output_type))
    return answered.select(query_id_col, "prompt", "answer", "n_matches", *[c.alias(n) for n, c in typed.items() if n != "error_code"],
                           F.coalesce("_failed", typed["error_code"]).alias("error_code"))


def add_to_store(embeddings: DataFrame, store_path: str, store: str | None = None,
                 namespace: str | None = None, *, dim: int | None = None, avoid_dups: bool = True,
                 order_cols: tuple[str, ...] = (), lsh: dict | None = None, id_buckets: bool = False) -> dict[str, int]:
    """Append pre-computed vectors (``text, embedding, metadata``) to a store.

    Rows with empty text / vector (or the wrong ``dim``) are invalid (701111);
    with ``avoid_dups`` the id is the content UUID of the text, the first copy
    (by ``order_cols``, then text) wins and ids already stored are skipped.
    ``lsh`` (keyword arguments of ``lsh_codes``) also writes the LSH codes as
    an ``lsh_codes`` index column for ``vector_topk_approx``; ``id_buckets``: as in :func:`add_to_knowledge`.
    Counts are observed during the write; returns ``{"written",
    "duplicate", "invalid"}``.
    """
    spark = embeddings.sparkSession
    df = (embeddings.withColumn("error_code", embedding_error("text", "embedding", dim))
          .transform(lambda d: with_content_id(d, avoid_dups)))
    order = F.struct(*[F.col(c) for c in order_cols], F.col("text"))
    payload = F.struct(*[F.col(c) for c in df.columns])
    group = F.when(F.col("error_code").isNull(), F.concat(F.lit("id:"), F.col("id"))).otherwise(
        F.concat(F.lit("bad:"), F.xxhash64(*[F.col(c) for c in df.columns if c != "metadata"]).cast("string")))
    unique = (df.withColumn("_g", group).groupBy("_g")
              .agg(F.min_by(payload, order).alias("_r"), F.count(F.lit(1)).alias("copies"))
              .select("_r.*", "copies"))
    bucketed = uses_buckets(spark, store_path, id_buckets)
    if bucketed:
        unique = cut_lineage(unique)
        existing = admit_ids(unique.where(F.col("error_code").isNull()).select("id"), store_path, store, namespace)
    else:
        existing = store_ids(spark, store_path, store, namespace)
    if existing is not None:
        hits = existing.select("id").distinct().withColumn("stored", F.lit(True))
        unique = unique.join(hits, "id", "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    else:
        unique = unique.withColumn("stored", F.lit(False))
    classified = unique.withColumn("status", F.when(F.col("error_code").isNotNull(), F.lit("invalid"))
                                   .when(F.col("stored"), F.lit("duplicate")).otherwise(F.lit("written")))
    extra = {}
    if lsh is not None:
        # LSH index column, e.g. {"dim": 64, "n_tables": 8, "n_bits": 6, "seed": 17}
        from tessera.operators.search import lsh_codes
        extra["lsh_codes"] = lsh_codes("embedding", **lsh)
    _, counts = _append_written(classified, store_path, store, namespace, bucketed, extra=extra)
    if sum(counts.values()) > 0 and counts["written"] == 0 and counts["duplicate"] == 0:
        raise E.TesseraError(E.INVALID_INGEST, "no row could be stored")
    return counts
