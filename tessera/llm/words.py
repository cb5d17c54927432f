"""Words of Arrow text columns as flat numpy arrays.

A word is a maximal run of bytes other than space and \\t..\\r
(``[^\\x20\\x09-\\x0D]+``); UTF-8 never uses those bytes inside a character,
so working on bytes gives the same words as working on characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_SEED = np.uint64(0x9E3779B97F4A7C15)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` holding about ``max_bytes`` of text each (always
    whole rows), so that temporary arrays are bounded by the larger of
    ``max_bytes`` and one text."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // max_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)`` of a text column; row i is data[offsets[i]:offsets[i+1]].
    Null rows are empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (multilinear with one fixed odd multiplier
    per position, so collisions have a chance of about 2**-57 a pair)."""
    out = np.zeros(len(starts), np.uint64)
    lens = ends - starts
    full = np.flatnonzero(lens > 0)
    if len(full):
        s, n = starts[full], lens[full]
        first = np.cumsum(n) - n
        pos = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        value = data[pos + np.repeat(s, n)].astype(np.uint64)
        value += np.uint64(1)
        table = mix((np.arange(n.max(), dtype=np.uint64) + np.uint64(1)) * _SEED) | np.uint64(1)
        value *= table[pos]
        out[full] = np.add.reduceat(value, first)
    return mix(out + lens.astype(np.uint64) * _SEED)


def add_columns(df: DataFrame, text_col: str, fields: list[T.StructField], make) -> DataFrame:
    """``df`` with the columns ``fields``, which replace any of those names.  ``make()``
    runs once a task and gives a function from a text column (rows of about
    ``slices`` size) to the arrays of the new columns.

    Columns are numbered on their way through Python, as their names may hold
    anything, dots too."""
    new = {f.name.lower() for f in fields}
    names = [c for c in df.columns if c.lower() not in new]
    if text_col not in names:
        raise ValueError(f"no column {text_col!r} besides the new ones")
    kept = df.select(*["`" + c.replace("`", "``") + "`" for c in names]).toDF(*[f"c{k}" for k in range(len(names))])
    text = f"c{names.index(text_col)}"
    made = [T.StructField(f"n{k}", f.dataType) for k, f in enumerate(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, *of(part.column(text))], names=[*part.schema.names, *[f.name for f in made]])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *made])).toDF(*names, *[f.name for f in fields])


class Words:
    """Words of all rows of a text column: ``starts`` and ``ends`` are byte
    positions in ``data``, row i holds words ``offsets[i]:offsets[i + 1]``."""

    def __init__(self, col: pa.Array):
        self.data, self.text_offsets = text_bytes(col)
        self.inside = _NOT_SPACE[self.data]
        begin, end = self.inside.copy(), self.inside.copy()
        begin[1:] &= ~self.inside[:-1]
        end[:-1] &= ~self.inside[1:]
        edges = self.text_offsets[(self.text_offsets > 0) & (self.text_offsets < len(self.data))]
        begin[edges] = self.inside[edges]
        end[edges - 1] = self.inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.offsets = np.searchsorted(self.starts, self.text_offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def hashes(self) -> np.ndarray:
        return span_hash(self.data, self.starts, self.ends)

    def per_row(self, flags: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
        """Sum of ``flags`` (one for each byte, or for each word with ``offsets``)
        by row."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        at = self.text_offsets if offsets is None else offsets
        return total[at[1:]] - total[at[:-1]]
