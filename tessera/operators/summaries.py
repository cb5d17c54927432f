"""Conversation memories that are summarised when they are full.

A memory takes one message after another.  When the next message finds
``limit`` (and over two) messages held, the model summarises all of them but a
leading system message; system message and summary are what is left, and
then the message is added.  Where the model fails, the message is added and
the oldest message after a system message goes.

Sessions are folded side by side: in every round each of them goes on until it
needs a summary, and the model gets all those prompts in one call."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import summary_of
from tessera.operators.infer import CompleteFn, isolate
from tessera.operators.memory import SUMMARY_PREFIX, SUMMARY_PROMPT

Message = tuple[int, str, str | None]  # seq, type, text
#: Characters and rows of messages held before the sessions read so far are folded.
HELD_CHARS, HELD_ROWS = 8 << 20, 50_000

MEMORY_SCHEMA = "session_id string, seq bigint, type string, text string, pos int"


def prompt_for(memory: list[Message]) -> str:
    """The request for a summary of all but a leading system message."""
    body = memory[1:] if memory[0][1] == "SYSTEM" else memory
    lines = [f"User: {text or ''}\n" if kind == "USER" else f"Assistant: {text}\n"
             for _, kind, text in body if kind == "USER" or (kind == "AI" and text is not None)]
    return SUMMARY_PROMPT + "".join(lines)


def fold(memories: dict, new: dict, limit: int, complete: CompleteFn) -> dict:
    """Memories by session after the ``new`` messages of each (both: lists of messages)."""
    memories = {s: list(memories.get(s, ())) for s in {**memories, **new}}
    waiting = {s: list(reversed(m)) for s, m in new.items() if m}
    while waiting:
        due = []
        for session in list(waiting):
            memory, rest = memories[session], waiting[session]
            while rest and not (len(memory) >= limit and len(memory) > 2):
                memory.append(rest.pop())
                if len(memory) > limit > 0 and len(memory) > 1:
                    del memory[1 if memory[0][1] == "SYSTEM" else 0]
            if rest:
                due.append(session)
            else:
                del waiting[session]
        if not due:
            break
        for session, answer in zip(due, isolate(complete, [prompt_for(memories[s]) for s in due])):
            memory = memories[session]
            if answer is None:
                memory.append(waiting[session].pop())
                del memory[1 if memory[0][1] == "SYSTEM" else 0]
                continue
            head = memory[:1] if memory[0][1] == "SYSTEM" else []
            memories[session] = [*head, (memory[-1][0], "USER", SUMMARY_PREFIX + summary_of(answer)), waiting[session].pop()]
            if not waiting[session]:
                del waiting[session]
        for session in [s for s in due if s in waiting and not waiting[s]]:
            del waiting[session]
    return memories


def continue_memories(messages: DataFrame, limit: int, complete_fn_factory: Callable[[], CompleteFn],
                      memory: DataFrame | None = None) -> DataFrame:
    """Memories (:data:`MEMORY_SCHEMA`) of all sessions of ``messages`` (session_id,
    seq, type, text) and of ``memory``, an earlier result of this function.

    One shuffle by session; a task streams its sessions in order and folds what
    it has read whenever that reaches a bound, so neither a long session nor many
    short ones have to fit in memory.  ``seq`` decides the order of messages."""
    new = messages.select(F.col("session_id").cast("string").alias("session_id"), F.lit(1).alias("_new"), F.col("seq").cast("bigint").alias("_place"),
                          F.col("seq").cast("bigint").alias("seq"), "type", "text")
    rows = new
    if memory is not None:
        rows = new.unionByName(memory.select("session_id", F.lit(0).alias("_new"), F.col("pos").cast("bigint").alias("_place"), "seq", "type", "text"))
    ordered = rows.repartition("session_id").sortWithinPartitions("session_id", "_new", "_place", "type", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        complete = complete_fn_factory()
        start: dict = {}
        fresh: dict = {}
        held = n = 0
        session = None

        def emit(done: dict) -> pa.RecordBatch:
            rows = [(s, *message, k) for s, memory in done.items() for k, message in enumerate(memory)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["session_id", "seq", "type", "text", "pos"])

        for batch in batches:
            for session, is_new, seq, kind, text in zip(*(batch.column(c).to_pylist() for c in ("session_id", "_new", "seq", "type", "text"))):
                (fresh if is_new else start).setdefault(session, []).append((seq, kind, text))
                held += len(text or "")
                n += 1
            if held > HELD_CHARS or n > HELD_ROWS:
                done = fold(start, fresh, limit, complete)
                start, fresh, held, n = {session: done.pop(session)}, {}, 0, 0  # the last session may go on
                yield emit(done)
        if start or fresh:
            yield emit(fold(start, fresh, limit, complete))

    return ordered.mapInArrow(run, MEMORY_SCHEMA)
