"""Chat formatting with offset-aligned loss masks.

Turns are rendered between control strings, the whole rendering is encoded
once with character offsets, and the sorted spans of the texts to learn are
intersected with the sorted token spans by binary search."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"
TURN_BLOCK = 1024
SEGMENT_CHARS = 1 << 20
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    """No ``<|`` is left: each ``<``, backslashes, ``|`` gets one more backslash."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted text, and the (start, end) of each text to learn in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def align(spans: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the tokens that meet a span, and the parts of the spans that
    masked tokens cover, joined where they touch within a span.  Both inputs
    are (start, end) rows in order."""
    first = np.searchsorted(tokens[:, 1], spans[:, 0], "right")
    after = np.maximum(np.searchsorted(tokens[:, 0], spans[:, 1], "left"), first)
    size = after - first
    span = np.repeat(np.arange(len(spans)), size)  # a row for each span and token that meet
    token = np.arange(len(span)) - np.repeat(np.cumsum(size) - size, size) + first[span]
    begin, end = np.maximum(tokens[token, 0], spans[span, 0]), np.minimum(tokens[token, 1], spans[span, 1])
    real = begin < end
    span, token, begin, end = span[real], token[real], begin[real], end[real]
    mask = np.zeros(len(tokens), bool)
    mask[token] = True
    if not len(span):
        return mask, np.zeros((0, 2), np.int64)
    end = np.maximum.accumulate(end)
    fresh = np.ones(len(span), bool)
    fresh[1:] = (span[1:] != span[:-1]) | (begin[1:] > end[:-1])
    head = np.flatnonzero(fresh)
    return mask, np.stack([begin[head], end[np.append(head[1:], len(span)) - 1]], 1)


def _tokenizer(source: str):
    from tokenizers import AddedToken, Tokenizer, processors
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_str(source)
    tok.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (START, SEP, END)])
    tok.post_processor = processors.ByteLevel(trim_offsets=False)  # spans cover the spaces as well
    tok.no_truncation()
    tok.no_padding()
    return tok


def format_conversations(turns: DataFrame, path: str) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as rows ``conv_id, block, segment,
    n_turns, formatted, ids, mask, spans``: a conversation is its segments in the
    order of block and segment; ``ids`` are little-endian unsigned 32-bit
    integers, ``mask`` has one byte a token, ``spans`` holds start, end, start, ...
    of the text under the mask, in characters of ``formatted``.

    Turns go by turn (null first), ties by role, then text.  Null roles and texts
    are empty, a null conv_id is a conversation of its own.  Other columns are
    not read.  Segments end between turns, where control strings keep tokens
    apart, so their encodings in a row are the encoding of the whole; short
    conversations are one segment, and a conversation of any length is
    rendered by many tasks (``TURN_BLOCK`` turns each) in bounded memory."""
    with open(path, encoding="utf-8") as f:
        shared = turns.sparkSession.sparkContext.broadcast(f.read())
    ordered = turns.select("conv_id", F.floor(F.col("turn") / TURN_BLOCK).cast("long").alias("block"), "turn",
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    conv_type = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(shared.value)
        waiting: list[tuple] = []  # rendered segments

        def encoded() -> pa.RecordBatch:
            rows = {n: [] for n in ("conv_id", "block", "segment", "n_turns", "formatted", "ids", "mask", "spans")}
            for (conv, block, segment, n, text, spans), enc in zip(waiting, tok.encode_batch([w[4] for w in waiting], add_special_tokens=False)):
                mask, parts = align(spans, np.array(enc.offsets, np.int64).reshape(-1, 2))
                for name, x in zip(rows, (conv, block, segment, n, text, np.array(enc.ids, "<u4").tobytes(), mask.astype(np.uint8).tobytes(), parts.ravel())):
                    rows[name].append(x)
            waiting.clear()
            types = (conv_arrow, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows.values(), types)], names=list(rows))

        key, segment, held, chars, total, conv_arrow = None, 0, [], 0, 0, None
        for batch in batches:
            conv_arrow = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "role", "text")]
            for conv, block, role, text in zip(*columns):
                if held and ((conv, block) != key or chars > SEGMENT_CHARS):
                    waiting.append((*key, segment, len(held), *render(held)))
                    total, segment = total + chars, segment + 1
                    held, chars = [], 0
                    if total > SEGMENT_CHARS:
                        yield encoded()
                        total = 0
                if (conv, block) != key:
                    key, segment = (conv, block), 0
                held.append((role, text))
                chars += len(role) + len(text)
        if held:
            waiting.append((*key, segment, len(held), *render(held)))
        if waiting:
            yield encoded()

    return ordered.mapInArrow(run, f"conv_id {conv_type}, block long, segment long, n_turns long, formatted string, "
                                   "ids binary, mask binary, spans array<long>")


def digests(formatted: DataFrame) -> DataFrame:
    """By conversation, read back from :func:`format_conversations`: ``conv_id,
    n_turns, turns_sha256`` (role, \\n, text, \\n of every turn), ``loss_chars,
    loss_sha256`` (text under the mask, unescaped) and ``formatted_chars``."""
    ordered = (formatted.select("conv_id", "block", "segment", "formatted", "spans")
               .repartition("conv_id").sortWithinPartitions("conv_id", "block", "segment"))
    conv_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        state = None  # conv_id, turns, hash, loss characters, hash, formatted characters

        def row(s) -> list:
            return [s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]]

        for batch in batches:
            conv_arrow, done = batch.schema.field("conv_id").type, []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(spans[::2], spans[1::2]):
                    learned = unescape(text[a:b])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if done:
                yield _table(done, names, conv_arrow)
        if state is not None:
            yield _table([row(state)], names, conv_arrow)

    return ordered.mapInArrow(run, f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")


def _table(rows: list[list], names: tuple[str, ...], conv_type: pa.DataType) -> pa.RecordBatch:
    types = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))
