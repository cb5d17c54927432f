"""Running session window.  Per session the state holds at most the
last ``n`` messages (bounded state), merged by ``seq`` so late or
out-of-order turns give the same window as the batch ``last_n``."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WINDOW_SCHEMA = "session_id string, seq bigint, type string, text string, pos int, version bigint"
STATE_SCHEMA = "window string, seen bigint"


def _messages(pdf: pd.DataFrame) -> list[list]:
    """Rows as [seq, type, text]; a null stays a null, and whole numbers don't pass through floats."""
    return [[None if pd.isna(s) else int(s), None if pd.isna(t) else t, None if pd.isna(x) else x] for s, t, x in zip(pdf["seq"], pdf["type"], pdf["text"])]


def _order(message) -> tuple:
    """Oldest first: null seqs, then by seq; ties by type and text."""
    seq, kind, text = message
    return seq is not None, seq or 0, kind or "", text or ""


def _as_text(messages: DataFrame) -> DataFrame:
    """``seq`` as text on its way to Python, where a null would make floats of whole columns."""
    return messages.select("session_id", F.col("seq").cast("string").alias("seq"), "type", "text")


def _window_rows(session_id, rows: list, seen: int) -> pd.DataFrame:
    return pd.DataFrame({"session_id": pd.Series([session_id] * len(rows), dtype=object), "seq": pd.Series([r[0] for r in rows], dtype="Int64"),
                         "type": pd.Series([r[1] for r in rows], dtype=object), "text": pd.Series([r[2] for r in rows], dtype=object),
                         "pos": pd.Series(range(len(rows)), dtype="int32"), "version": pd.Series([seen] * len(rows), dtype="int64")})


def running_window(messages_stream: DataFrame, n: int) -> DataFrame:
    """Emits, per micro-batch and touched session, the current last-``n``
    window with ``version`` = messages seen so far.  Messages without seq are the oldest, rows without a session are one."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (session_id,) = key
        if state.exists:
            window_json, seen = state.get
            rows = json.loads(window_json)
        else:
            rows, seen = [], 0
        for pdf in batches:
            seen += len(pdf)
            rows = sorted(rows + _messages(pdf), key=_order)[-n:]
        state.update((json.dumps(rows), seen))
        yield _window_rows(session_id, rows, seen)

    return (_as_text(messages_stream)
            .groupBy("session_id")
            .applyInPandasWithState(step, WINDOW_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.NoTimeout))


class LastMessages(StatefulProcessor):
    """A session's last ``n`` messages as list state and their number so far; both expire ``ttl_ms`` after their last change."""

    def __init__(self, n: int, ttl_ms: int | None):
        self.n, self.ttl_ms = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", "seq bigint, type string, text string", self.ttl_ms)
        self.seen = handle.getValueState("seen", "n bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        last = [list(r) for r in self.last.get()] if self.last.exists() else []
        seen = self.seen.get()[0] if self.seen.exists() else 0
        for pdf in rows:
            seen += len(pdf)
            last = sorted(last + _messages(pdf), key=_order)[-self.n:]
        self.last.put([tuple(r) for r in last])
        self.seen.update((seen,))
        yield _window_rows(key[0], last, seen)

    def close(self) -> None:
        pass


def expiring_window(messages_stream: DataFrame, n: int, ttl_seconds: int | None = 30 * 86400) -> DataFrame:
    """As :func:`running_window`, with list state in the state store: only what changes is written, at most ``n``
    messages a session are held, and sessions without messages for ``ttl_seconds`` of processing time are dropped.
    Needs the RocksDB state store and, to end by itself, ``run_available_now(..., empty_batches=False)``."""
    ttl = None if ttl_seconds is None else ttl_seconds * 1000
    return _as_text(messages_stream).groupBy("session_id").transformWithStateInPandas(
        LastMessages(n, ttl), WINDOW_SCHEMA, "Append", "None" if ttl is None else "ProcessingTime")


def stored_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``session_id, seq, type, text`` of all windows that a stopped stream of :func:`expiring_window` holds, read
    from its checkpoint, without running it.  Expired ones are left out."""
    rows = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    if "ttlExpirationMs" in rows.schema["list_element"].dataType.names:
        alive = F.col("list_element.ttlExpirationMs") > F.unix_millis(F.current_timestamp())
        return rows.where(alive).select("key.session_id", "list_element.value.*")
    return rows.select("key.session_id", "list_element.*")


def latest_windows(emitted: DataFrame) -> DataFrame:
    """Keep the newest emitted window of each session (batch read of the sink)."""
    newest = emitted.groupBy("session_id").agg(F.max("version").alias("version"))
    return emitted.join(newest, ["session_id", "version"], "left_semi")
