"""T4/T5: tool-call results collected as they stream in.

A stream-stream left outer join on (session, request id) with the interval
condition ``call.ts <= result.ts <= call.ts + timeout`` and watermarks on
both sides, then one row per call: the earliest non-blank result, or the
text for a failed execution.  A call's row is emitted once the watermark passes
its time-out; results arriving after that are dropped as late (the original
ignores results after completion).  ``match_as_they_come`` keeps the open calls as
state with event-time timers instead, and answers a call as soon as it can.  A state key stands for
some hundred (session, request id) pairs: a call of the state store and a frame a pair cost
milliseconds each, so pairs are read, matched and written together."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.functions.text import is_blank
from tessera.operators.tools import TOOL_EXECUTION_FAILED


def stream_match(calls: DataFrame, results: DataFrame, timeout_seconds: int,
                 delay_seconds: int) -> DataFrame:
    """``session_id, request_id, seq, ts, result_seq, matched, result``, as the batch
    ``match_results`` gives them."""
    c = calls.withWatermark("ts", f"{delay_seconds} seconds").alias("c")
    r = results.where(~is_blank("result")).withWatermark("ts", f"{delay_seconds} seconds").alias("r")
    cond = ((F.col("c.session_id") == F.col("r.session_id")) & (F.col("c.request_id") == F.col("r.request_id"))
            & (F.col("r.ts") >= F.col("c.ts"))
            & (F.col("r.ts") <= F.col("c.ts") + F.expr(f"INTERVAL {timeout_seconds} SECONDS")))
    pairs = c.join(r, cond, "leftOuter").select(
        F.col("c.session_id").alias("session_id"), F.col("c.request_id").alias("request_id"),
        F.col("c.seq").alias("seq"), F.col("c.ts").alias("ts"),
        F.when(F.col("r.seq").isNotNull(), F.struct(F.col("r.ts").alias("at"), F.col("r.seq").alias("seq"),
                                                    F.col("r.result").alias("result"))).alias("found"))
    first = pairs.groupBy("session_id", "request_id", "seq", "ts").agg(F.min("found").alias("found"))
    return first.select("session_id", "request_id", "seq", "ts", F.col("found.seq").alias("result_seq"),
                        F.col("found").isNotNull().alias("matched"),
                        F.coalesce("found.result", F.lit(TOOL_EXECUTION_FAILED)).alias("result"))


CALL_SCHEMA = "session_id string, request_id string, seq bigint, ts timestamp, result_seq bigint, matched boolean, result string, kind string"


#: Columns of the rows that a state key holds: open calls, and results until the watermark passes them.
HELD = ("session_id", "request_id", "at", "seq", "has_seq", "result", "is_call", "answered")


class OpenCalls(StatefulProcessor):
    """The open calls and recent results of the (session, request id) pairs of a key.

    A call is answered the moment its result is there; a timer answers it when the
    watermark passes its time-out.  A result is held until the watermark passes it, as a
    call that comes later in the stream may precede it in time; one that answered nothing by
    then is told as ``late``.  A key has one timer, for what is due first, so it is called once a micro-batch at most."""

    def __init__(self, timeout_seconds: int):
        self.timeout = timeout_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "held string, timer bigint")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True)
        held, timer = self.read()
        known = new["known"].to_numpy(bool)
        new["answered"] = False
        both = {c: np.concatenate([held[c], new[c].to_numpy(held[c].dtype)[known]]) for c in HELD}
        order, following = self.match(both)
        both = {c: v[order] for c, v in both.items()}
        answered = both["is_call"] & (following < len(order))
        both["answered"][following[answered]] = True
        self.write({c: v[~answered] for c, v in both.items()}, timer)
        found = following[answered]
        yield self.frame({c: v[answered] for c, v in both.items()}, "call", both["seq"][found], both["has_seq"][found], both["result"][found])
        odd = new[~known]  # calls without session, request id or time
        if len(odd):
            yield self.frame({c: odd[c].to_numpy() for c in HELD}, "call", no_time=odd["no_time"].to_numpy(bool))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held, timer = self.read()
        gone = held["at"] + np.where(held["is_call"], self.timeout, 0) < passed
        self.write({c: v[~gone] for c, v in held.items()}, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)
        for rows, kind in ((gone & held["is_call"], "call"), (gone & ~held["is_call"] & ~held["answered"], "late")):
            if rows.any():
                yield self.frame({c: v[rows] for c, v in held.items()}, kind)

    def match(self, rows: dict) -> tuple[np.ndarray, np.ndarray]:
        """An order of the rows, and by it the place of the result that answers each (or their number): the
        first of the same pair from its time to its time-out, of several at once the one of the least seq (nulls first)."""
        numbers: dict = {}
        pair = np.fromiter((numbers.setdefault(x, len(numbers)) for x in zip(rows["session_id"], rows["request_id"])), np.int64, len(rows["at"]))
        order = np.lexsort((rows["seq"], rows["has_seq"], ~rows["is_call"], rows["at"], pair))
        pair, at, n = pair[order], rows["at"][order], len(order)
        following = np.minimum.accumulate(np.where(rows["is_call"][order], n, np.arange(n))[::-1])[::-1]
        there = np.minimum(following, n - 1)
        return order, np.where((following < n) & (pair[there] == pair) & (at[there] - at <= self.timeout), following, n)

    def read(self) -> tuple[dict, int | None]:
        state = self.open.get() if self.open.exists() else None
        columns, timer = (json.loads(state[0]), state[1]) if state else ([[]] * len(HELD), None)
        kinds = (object, object, np.int64, np.int64, bool, object, bool, bool)
        return {c: np.array(v, kind) for c, v, kind in zip(HELD, columns, kinds)}, timer

    def write(self, held: dict, timer: int | None) -> None:
        """Keeps the rows and a timer for what is due first of them; an earlier ``timer`` stays."""
        if not len(held["at"]):
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.open.clear()
            return
        due = int((held["at"] + np.where(held["is_call"], self.timeout, 0)).min()) // 1000 + 1  # the first millisecond after it
        if timer is None or due < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            timer = due
        self.open.update((json.dumps([held[c].tolist() for c in HELD]), timer))

    @staticmethod
    def frame(rows: dict, kind: str, result_seq=None, has_result_seq=None, result=None, no_time=None) -> pd.DataFrame:
        """:data:`CALL_SCHEMA` of calls with their results, of unanswered calls or of late results."""
        n = len(rows["at"])
        ts = rows["at"].astype(np.int64).astype("datetime64[us]")
        if no_time is not None:
            ts[no_time] = np.datetime64("NaT")
        if result is None:
            result = rows["result"] if kind == "late" else np.full(n, TOOL_EXECUTION_FAILED, object)
            result_seq, has_result_seq, matched = np.zeros(n, np.int64), np.zeros(n, bool), False
        else:
            matched = True
        number = lambda v, has: pd.arrays.IntegerArray(np.asarray(v, np.int64), ~np.asarray(has, bool))
        return pd.DataFrame({"session_id": np.asarray(rows["session_id"], object), "request_id": np.asarray(rows["request_id"], object),
                             "seq": number(rows["seq"], rows["has_seq"]), "ts": pd.DatetimeIndex(ts).tz_localize("UTC"),
                             "result_seq": number(result_seq, has_result_seq), "matched": np.full(n, matched), "result": result, "kind": np.full(n, kind, object)})

    def close(self) -> None:
        pass


def match_as_they_come(calls: DataFrame, results: DataFrame, timeout_seconds: int, delay_seconds: int, keys: int = 1024) -> DataFrame:
    """:data:`CALL_SCHEMA`: a row a call as in ``stream_match``, but in the micro-batch in which its result is in, and
    only the unanswered ones when the watermark has passed their time-out; no pairs of calls and results
    are built.  The first result to come completes a call: an earlier one that arrives later doesn't change it.
    Rows of kind ``late`` are results that answered no call.  Calls without session, request id or time are
    answered at once, unmatched.  Needs the RocksDB state store.

    Pairs of session and request id are dealt to ``keys`` state keys by their hash.  A micro-batch reads and writes
    all that is open of the keys that it meets, so ``keys`` should be about the number of open calls by some hundred; it
    stays the same as long as the checkpoint is used."""
    known = F.col("session_id").isNotNull() & F.col("request_id").isNotNull() & F.col("ts").isNotNull()

    def side(df: DataFrame, is_call: bool) -> DataFrame:
        spread = F.when(known, F.xxhash64("session_id", "request_id")).otherwise(F.xxhash64("ts", "seq"))
        seq = F.col("seq").cast("bigint")  # nulls would make floats of whole columns
        return df.select(F.pmod(spread, F.lit(keys)).alias("key"), "session_id", "request_id", "ts",
                         F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(0)).alias("at"), F.col("ts").isNull().alias("no_time"),
                         F.coalesce(seq, F.lit(0)).alias("seq"), seq.isNotNull().alias("has_seq"),
                         (F.lit(None).cast("string") if is_call else F.col("result")).alias("result"), F.lit(is_call).alias("is_call"), known.alias("known"))
    both = side(calls, True).unionByName(side(results.where(~is_blank("result") & known), False)).withWatermark("ts", f"{delay_seconds} seconds")
    return both.groupBy("key").transformWithStateInPandas(OpenCalls(timeout_seconds), CALL_SCHEMA, "Append", "EventTime")
