"""How quality filters interact: an audit kept up by a stream.

All files arrive as micro-batches of one available-now query.  Four filters
look at a text alone; the fifth fails a text that a smaller id has too, which
a later file may still change.  So the state keeps, for every text, its least
id so far with the counts of the rows that hold it: a smaller id retracts the
mask these were counted under and adds the one they have now.  What leaves
the stream are changes to counters of (part, mask, labels); their sums give
the figures of all orders of the filters without another look at a text."""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.llm.words import Words, slices
from tessera.session import cut_lineage
from tessera.sources.vector_store import scratch_path
from tessera.streaming.runner import file_stream, run_available_now

FILTERS = "ABCDE"
#: Bits of a row's code: filters A to D are 1, 2, 4, 8.
COPY, GOOD, TOXIC = 16, 32, 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_UPPER, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL[list(b"#$%&*|")] = True
_ROW = "bucket long, key string, id long, part string, code int, n long"


def text_mask(col: pa.Array) -> np.ndarray:
    """Filters A to D of every text of a column as bits 1, 2, 4, 8: under 200 words; under half
    of the words distinct; over 2 % capitals; holds a symbol."""
    w = Words(col)
    words, h, rows = np.diff(w.offsets), w.hashes(), w.rows()
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    distinct = np.bincount(rows[fresh], minlength=len(col))
    chars = w.per_row((w.data & 0xC0) != 0x80)
    capitals, symbols = w.per_row(_UPPER[w.data]), w.per_row(_SYMBOL[w.data])
    return (words < 200) * 1 + (100 * distinct < 50 * words) * 2 + (100 * capitals > 2 * chars) * 4 + (symbols > 0) * 8


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``key`` (SHA-256 of the text), ``id, part, code`` (filters A to D) of every row, batch or stream;
    null texts and parts are empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", F.sha2("text", 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                mask = pa.array(text_mask(part.column("text")).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("id"), part.column("part"), mask], names=["key", "id", "part", "code"])

    return rows.select("key", "id", "part", "text").mapInArrow(run, "key string, id long, part string, code int")


def meet(least: int | None, held: Counter, id: int, rows: Counter, change) -> tuple[int, Counter]:
    """A text's least id and the (part, code) counts of its rows, after rows with ``id`` came.
    ``change(part, code, n)`` gets what this does to the counters, retractions too; rows of
    the least id are counted without the copy bit, as several rows of one id aren't smaller than each other."""
    if least is None or id < least:
        for (part, code), n in held.items():
            change(part, code, -n)
            change(part, code | COPY, n)
        least, held = id, Counter()
    for (part, code), n in rows.items():
        change(part, code if id == least else code | COPY, n)
    if id == least:
        held = held + rows
    return least, held


def _fold_task(batches: Iterator[pa.RecordBatch], state_keys: int, most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Of a task's rows of one text, those with the least id go on to the text's state; all others have a
    smaller id in this very task and are counted as copies for good (key null).  So a text
    that a third of all rows hold sends one row a task.  Null ids are compared with none."""
    def rows():
        out = [(int(key[:16], 16) % state_keys, key, least, part, code, n) for key, (least, held) in texts.items() for (part, code), n in held.items()]
        out += [(k % state_keys, None, None, part, code, n) for k, ((part, code), n) in enumerate(sums.items()) if n]
        texts.clear()
        sums.clear()
        columns = list(zip(*out)) if out else [()] * 6
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "key", "id", "part", "code", "n"])

    texts: dict[str, tuple[int, Counter]] = {}
    sums: Counter = Counter()

    def change(part: str, code: int, n: int) -> None:
        sums[part, code] += n

    for batch in batches:
        for key, id, part, code in zip(*[batch.column(c).to_pylist() for c in ("key", "id", "part", "code")]):
            if id is None:
                change(part, code, 1)
                continue
            if key not in texts:
                texts[key] = (id, Counter({(part, code): 1}))
                continue
            least, held = texts[key]
            if id > least:
                change(part, code | COPY, 1)
            elif id == least:
                held[part, code] += 1
            else:
                for (p, c), n in held.items():
                    change(p, c | COPY, n)
                texts[key] = (id, Counter({(part, code): 1}))
        if len(texts) >= most:
            yield rows()
    yield rows()


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The texts of one state key: each one's least id and the counts of the rows that hold it."""
    changes: Counter = Counter()

    def change(part: str, code: int, n: int) -> None:
        changes[part, code] += n

    new: dict = {}
    for pdf in batches:
        for text, id, part, code, n in zip(*[pdf[c].tolist() for c in ("key", "id", "part", "code", "n")]):
            if text is None:
                change(part, int(code), int(n))
            else:
                new.setdefault(text, {}).setdefault(int(id), Counter())[part, int(code)] += int(n)
    if new:
        texts = json.loads(state.get[0]) if state.exists else {}
        changed = False
        for text, by_id in new.items():
            least, rows = texts.get(text, (None, []))
            held = Counter({(p, c): n for p, c, n in rows})
            for id in sorted(by_id):
                if least is None or id <= least:
                    changed = True
                least, held = meet(least, held, id, by_id[id], change)
            texts[text] = (least, [[p, c, n] for (p, c), n in held.items()])
        if changed:
            state.update((json.dumps(texts),))
    out = [(p, c, n) for (p, c), n in changes.items() if n]
    if out:
        part, code, n = zip(*out)
        yield pd.DataFrame({"part": part, "code": np.array(code, np.int32), "n": np.array(n, np.int64)})


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: Counter = Counter()
    for batch in batches:
        for part, code, n in zip(*[batch.column(c).to_pylist() for c in ("part", "code", "n")]):
            sums[part, code] += n
    out = [(p, c, n) for (p, c), n in sums.items() if n]
    columns = list(zip(*out)) if out else [()] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64()))], names=["part", "code", "n"])


def counter_changes(stream: DataFrame, labels: DataFrame, state_keys: int, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Changes (``part, code, n``) to the counters that every micro-batch of ``stream`` brings.  ``labels`` has
    ``doc_id, quality, toxic``; an id with several rows has a label if one of them says 1.

    The texts' state is kept under ``state_keys`` keys (digests modulo that number), some hundred texts each: a key
    costs a task over a millisecond, a text some microseconds.  The number is fixed for a checkpoint's life."""
    bits = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
            .agg((F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))).alias("_bits")).where("_bits > 0"))
    rows = measured(stream, id_col, text_col, part_col).join(cut_lineage(bits), "id", "left")
    rows = rows.select("key", "id", "part", (F.col("code") + F.coalesce("_bits", F.lit(0))).cast("int").alias("code"))
    return (rows.mapInArrow(lambda batches: _fold_task(batches, state_keys), _ROW).groupBy("bucket")
            .applyInPandasWithState(_step, "part string, code int, n long", "texts string", "append", GroupStateTimeout.NoTimeout)
            .mapInArrow(_sum_task, "part string, code int, n long"))


def interactions(counters: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Figures of all orders from counters (``part, code, n``): a part's counters are at most 4 times two to the
    number of filters, which bounds its row; each set of earlier filters is reckoned once and then read by its orders."""
    cases: defaultdict = defaultdict(list)
    bit = {f: 1 << k for k, f in enumerate(filters)}
    orders = ["".join(p) for p in permutations(filters)]
    for order in orders:
        for k, f in enumerate(order):
            cases[sum(bit[x] for x in order[:k]), bit[f]].append({"filter_order": order, "step": k + 1})
    table = json.dumps([{"before": b, "own": o, "orders": x} for (b, o), x in sorted(cases.items())])
    kind = "array<struct<before:int,own:int,orders:array<struct<filter_order:string,step:int>>>>"
    all_bits = (1 << len(filters)) - 1
    rows = counters.groupBy("part", "code").agg(F.sum("n").alias("n"))
    rows = rows.groupBy("part").agg(F.collect_list(F.struct("code", F.col("code").bitwiseAND(F.lit(all_bits)).alias("mask"), "n")).alias("c"))
    rows = rows.select("part", "c", F.inline(F.from_json(F.lit(table), kind)))

    def total(holds, value=lambda x: x["n"]):
        return F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + F.when(holds(x), value(x)).otherwise(F.lit(0).cast("long")))

    def fails(x):
        return x["mask"].bitwiseAND(F.col("own")) != 0

    def gone(x):
        return x["mask"].bitwiseAND(F.col("before")) != 0

    def labelled(x, label):
        return x["code"].bitwiseAND(F.lit(label)) != 0

    rows = rows.select(
        "part", F.inline("orders"), "c", "before", "own").select(
        "part", "filter_order", "step",
        total(lambda x: ~fails(x) & ~gone(x)).alias("kept"), total(lambda x: fails(x) & ~gone(x)).alias("removed"),
        total(lambda x: fails(x) & gone(x)).alias("redundant"), total(lambda x: x["mask"] == F.col("own")).alias("unique_fails"),
        total(lambda x: fails(x) & ~gone(x) & labelled(x, GOOD)).alias("good_lost"), total(lambda x: fails(x) & ~gone(x) & labelled(x, TOXIC)).alias("toxic_lost"),
        total(fails, lambda x: F.call_function("div", x["n"] * len(orders), F.bit_count(x["mask"]))).alias("shapley"))
    return rows


def audit_path(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
               micro_batches: int = 4, provider: str | None = None, checkpoint: str | None = None, sink: str | None = None,
               state_keys: int | None = None) -> DataFrame:
    """Interaction of filters A to E over all Parquet files at ``path``, taken as about ``micro_batches`` micro-batches
    of files: one row per part, order of the filters and step, zeros included.

    Null texts and parts are empty.  A row with a null id is never a copy and makes none; rows that share the least id of a text
    aren't copies of each other.  Every row counts, repeated ones too.  Other columns are not read.
    A folder without rows gives an empty result.

    Only 64 hexadecimal digits of a text are shuffled.  The stream's checkpoint and sink lie in the shared checkpoint folder:
    a run that stopped goes on from its last micro-batch with the same ``checkpoint``, ``sink`` and ``state_keys``, and then reads new files only.
    ``provider`` names the state store (:data:`ROCKSDB` where the texts' digests don't fit the executors' memory); else the session's is used.
    Without a checkpoint of the caller's, ``state_keys`` is one for 128 rows (counted in the files' footers)."""
    batch = spark.read.parquet(path)
    if state_keys is None:
        if checkpoint is not None:
            raise ValueError("a checkpoint that outlives this call needs a fixed state_keys")
        state_keys = max(64, batch.count() // 128)
    files = len(batch.inputFiles())
    stream = file_stream(spark, path, batch.schema, max_files_per_trigger=max(1, -(-files // micro_batches)))
    changes = counter_changes(stream, labels, state_keys, id_col, text_col, part_col)
    setting = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(setting)
    spark.conf.set(setting, provider or old)
    try:
        sink = run_available_now(changes, sink or scratch_path(spark, "filter-audit-out"), name="filter-audit", checkpoint=checkpoint)
    finally:
        spark.conf.set(setting, old)
    return interactions(spark.read.schema("part string, code int, n long").parquet(sink))
