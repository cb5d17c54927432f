"""Substring de-duplication with compressed FM-indexes of shards.

All windows of ``window`` words that are equal share their minimizer, the least
hash of the ``GRAM``-word groups inside; so a document is cut into segments,
runs of windows with the minimizer in one place, and segments of one
minimizer go to one shard.
Segments whose minimizer is nowhere else are done; equal segments travel
once, with their number.  A shard builds an FM-index (suffix array, wavelet matrix
over the Burrows-Wheeler transform) of its segments and streams them against
it: backward search gives matching statistics, and the intervals in which
at least ``window`` words occur elsewhere are reported."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.words import Words, mix, slices
from tessera.session import cut_lineage

GRAM = 7
#: A minimizer with more distinct segments is settled by counting its windows, so
#: that no shard holds more of one minimizer.
HOT_SEGMENTS = 1_000
SHARD_WORDS = 500_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


class SpanSums:
    """Hashes of spans of a sequence of word hashes that don't depend on where
    the span lies."""

    def __init__(self, h: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(len(h), _BASE), dtype=np.uint64)])
        self.back = _powers(len(h) + 1, pow(_BASE, -1, 1 << 64))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64))


def _sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (the first, of equal ones) of each ``width`` neighbours."""
    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(x[a] <= x[b], a, b)

    out, have = np.arange(len(x)), 1
    while 2 * have <= width:
        out = least(out[:-have], out[have:])
        have *= 2
    return least(out[:len(out) - (width - have)], out[width - have:]) if width > have else out


def segments(h: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(row, start, n, minimizer, span hash) of the segments of rows of words: n
    windows from word ``start`` of the row on whose minimizer stands in one
    place, so at most ``window - GRAM + 1``.  Equal windows are never in one segment."""
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    span = SpanSums(h)
    at = np.arange(len(h) - GRAM + 1)
    grams = mix(span(at, at + GRAM))
    least = _sliding_argmin(grams, window - GRAM + 1)
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), np.maximum(counts - window + 1, 0))
    if not len(row):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    first = np.cumsum(np.maximum(counts - window + 1, 0)) - np.maximum(counts - window + 1, 0)
    start = np.arange(len(row)) - first[row]
    place = least[start + offsets[row]]
    head = np.flatnonzero(np.diff(place, prepend=-1))  # places of different rows differ
    n = np.diff(head, append=len(row))
    a = start[head] + offsets[row[head]]
    return row[head], start[head], n, grams[place[head]], span(a, a + n + window - 1)


class FmIndex:
    """FM-index of sequences of symbols 0 .. size - 1, each closed by a separator of
    its own.  The transform is kept as a wavelet matrix: one bit a level for each
    symbol, with counts of ones every 64 bits."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, size: int):
        """``ends``: where each sequence ends in ``symbols`` (its separator follows)."""
        n = len(symbols) + len(ends)
        close = ends + np.arange(len(ends))
        text = np.zeros(n, np.int64)
        is_word = np.ones(n, bool)
        is_word[close] = False
        text[is_word] = symbols + len(ends)
        text[close] = np.arange(len(ends))
        order = self._suffixes(text)
        bwt = text[order - 1]
        sym = np.maximum(bwt - len(ends) + 1, 0)  # all separators are symbol 0
        self.n, self.size = n, size
        counts = np.bincount(sym, minlength=size + 1)
        self.before = np.cumsum(counts) - counts  # rows that begin with a smaller symbol
        self.levels = max(1, int(size).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        base = np.zeros(size + 1, np.int64)
        values = np.arange(size + 1)
        for level in range(self.levels - 1, -1, -1):
            bit = (sym >> level) & 1
            packed = np.packbits(np.append(bit, np.zeros(-n % 64 + 64, np.int64)).astype(np.uint8), bitorder="little").view("<u8")
            self.bits.append(packed)
            upto = np.cumsum(np.bitwise_count(packed), dtype=np.int64)
            self.ones.append(np.concatenate([np.zeros(1, np.int64), upto[:-1]]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            base = self._down(len(self.bits) - 1, base, (values >> level) & 1)
            sym = np.concatenate([sym[bit == 0], sym[bit == 1]])
        self.base = base

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling; separators differ, so the longest sequence
        bounds the rounds."""
        rank, h = text, 1
        while True:
            key = rank * (len(text) + int(text.max()) + 2)
            key[:-h] += rank[h:] + 1
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            if rank[order[-1]] == len(text) - 1:
                return order
            h *= 2

    def _down(self, level: int, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        ones = self.ones[level][word] + np.bitwise_count(self.bits[level][word] & low)
        return np.where(bit == 1, self.zeros[level] + ones, at - ones)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: rows that begin with ``symbol`` and then what the rows
        lo .. hi - 1 begin with."""
        c = symbol + 1
        both, cc = np.concatenate([lo, hi]), np.concatenate([c, c])
        for level in range(self.levels):
            both = self._down(level, both, (cc >> (self.levels - 1 - level)) & 1)
        both += (self.before - self.base)[cc]
        return both[:len(lo)], both[len(lo):]

    def repeats(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, a, b) of the intervals of the queries ``symbols[starts:ends]``, given
        by distance from the start, with at least ``window`` symbols that occur
        twice or more: from right to left, a match grows while two rows are left;
        then the search begins anew at the next end that can give something new."""
        found = []
        q = np.flatnonzero(ends - starts >= window)
        end, at = ends[q].copy(), ends[q].copy()
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), self.n)
        while len(q):
            more = at > starts[q]
            lo2, hi2 = self.extend(symbols[np.maximum(at - 1, 0)], lo, hi)
            grow = more & (hi2 - lo2 >= 2)
            stop = np.flatnonzero(~grow)
            at, lo, hi = np.where(grow, at - 1, at), np.where(grow, lo2, lo), np.where(grow, hi2, hi)
            if len(stop):
                hit = stop[end[stop] - at[stop] >= window]
                found.append((q[hit], at[hit] - starts[q[hit]], end[hit] - starts[q[hit]]))
                after = np.where(end[stop] - at[stop] >= window, at[stop] + window - 1, end[stop] - 1)
                # A match that reaches the start leaves no window further left.
                after = np.where(at[stop] <= starts[q[stop]], starts[q[stop]], after)
                end[stop] = at[stop] = after
                lo[stop], hi[stop] = 0, self.n
                live = end - starts[q] >= window
                q, end, at, lo, hi = q[live], end[live], at[live], lo[live], hi[live]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))


def _key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.xxhash64(id_col).alias("_a"), F.xxhash64(text_col).alias("_b"),
                       F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))


_PLACE = "_a long, _b long, _start int, _n int, _m long, _s long"


def _cut(keyed: DataFrame, window: int) -> DataFrame:
    """Segments of all rows, without their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                w = Words(part.column("_text"))
                row, start, n, m, s = segments(w.hashes(), w.offsets, window)
                a, b = part.column("_a").to_numpy(), part.column("_b").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[row]), pa.array(b[row]), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(m.view(np.int64)), pa.array(s.view(np.int64))], names=["_a", "_b", "_start", "_n", "_m", "_s"])

    return keyed.select("_a", "_b", "_text").mapInArrow(run, _PLACE)


def _whole(keyed: DataFrame) -> DataFrame:
    """``_id, _a, _b, n_words`` and the digest of all words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                words = [(x or b"").split() for x in part.column("_text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("_id", "_a", "_b")), pa.array([len(x) for x in words], pa.int64()),
                     pa.array([hashlib.sha256(b" ".join(x)).hexdigest() for x in words], pa.string())],
                    names=["_id", "_a", "_b", "n_words", "_all"])

    long = [T.StructField(c, T.LongType()) for c in ("_a", "_b", "n_words")]
    return keyed.mapInArrow(run, T.StructType([keyed.schema["_id"], *long, T.StructField("_all", T.StringType())]))


def _pack(keyed: DataFrame) -> DataFrame:
    """Texts compressed, as they are about to be shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(3)
        for batch in batches:
            for part in slices(batch, "_text"):
                packed = [z.compress(x or b"") for x in part.column("_text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_a"), part.column("_b"), pa.array(packed, pa.binary())], names=["_a", "_b", "_z"])

    return keyed.select("_a", "_b", "_text").mapInArrow(run, "_a long, _b long, _z binary")


def _words_of(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], dict]]:
    z = zstandard.ZstdDecompressor()
    for packed, spans in zip(batch.column("_z"), batch.column("_spans")):
        yield z.decompress(packed.as_py()).split(), spans.as_py()


def _fetch(joined: DataFrame, window: int) -> DataFrame:
    """The words of the segments in ``_spans`` of packed texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, s, once, hot, words, held = [], [], [], [], [], 0
            names = ["_m", "_s", "_c", "_hot", "_words"]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            for text, spans in _words_of(batch):
                for x in spans:
                    part = b" ".join(text[x["_start"]:x["_start"] + x["_n"] + window - 1])
                    for column, value in zip((m, s, once, hot, words), (x["_m"], x["_s"], x["_c"], x["_hot"], part)):
                        column.append(value)
                    held += len(part)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((m, s, once, hot, words), kinds)], names=names)
                    m, s, once, hot, words, held = [], [], [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((m, s, once, hot, words), kinds)], names=names)

    return joined.mapInArrow(run, "_m long, _s long, _c long, _hot boolean, _words binary")


_HIT = "_m long, _s long, _from int, _to int"


def _search(shards: DataFrame, window: int) -> DataFrame:
    """Intervals (in words from its start) of each segment that occurs once whose
    windows occur elsewhere, by FM-index.  ``shards`` is in order of ``_m``; an index
    holds whole minimizers and about SHARD_WORDS words."""
    def look(m: np.ndarray, s: np.ndarray, c: np.ndarray, words: pa.Array) -> pa.RecordBatch:
        w = Words(words)
        names, symbols = np.unique(w.hashes(), return_inverse=True)
        index = FmIndex(symbols, w.offsets[1:], len(names))
        query = np.flatnonzero(c == 1)
        q, a, b = index.repeats(symbols, w.offsets[query], w.offsets[query + 1], window)
        return pa.RecordBatch.from_arrays([pa.array(m[query[q]]), pa.array(s[query[q]]), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                          names=["_m", "_s", "_from", "_to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("_words").nbytes // 6
            if size > SHARD_WORDS:
                table = pa.Table.from_batches(held).combine_chunks()
                m = table.column("_m").to_numpy()
                cut = int(np.searchsorted(m, m[-1]))  # the last minimizer may go on
                if cut:
                    yield look(m[:cut], table.column("_s").to_numpy()[:cut], table.column("_c").to_numpy()[:cut], _one(table.column("_words").slice(0, cut)))
                held = table.slice(cut).to_batches()
                size = sum(x.column("_words").nbytes for x in held) // 6
        if sum(x.num_rows for x in held):
            table = pa.Table.from_batches(held)
            yield look(*(table.column(x).to_numpy() for x in ("_m", "_s", "_c")), _one(table.column("_words")))

    return shards.mapInArrow(run, _HIT)


def _one(column: pa.ChunkedArray) -> pa.Array:
    """The column as one text array (the words are UTF-8)."""
    whole = column.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.chunk(0) if whole.num_chunks == 1 else pa.concat_arrays(whole.chunks)
    return whole.cast(pa.large_binary()).cast(pa.large_string())


def _count_windows(hot: DataFrame, window: int) -> DataFrame:
    """The same for segments of very frequent minimizers: each window's hash is
    counted, with partial sums before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_words", 1 << 18):
                w = Words(_one(pa.chunked_array([part.column("_words")])))
                span = SpanSums(w.hashes())
                size = np.maximum(np.diff(w.offsets) - window + 1, 0)
                row = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                at = place + w.offsets[row]
                m, s, c = (part.column(x).to_numpy()[row] for x in ("_m", "_s", "_c"))
                yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(s), pa.array(place.astype(np.int32)), pa.array(span(at, at + window).view(np.int64)), pa.array(c)],
                                                 names=["_m", "_s", "_from", "_w", "_c"])

    windows = cut_lineage(hot.mapInArrow(run, "_m long, _s long, _from int, _w long, _c long"))
    often = cut_lineage(windows.groupBy("_m", "_w").agg(F.sum("_c").alias("_sum")).where("_sum > 1").select("_m", "_w"))
    return windows.join(often, ["_m", "_w"]).select("_m", "_s", "_from", (F.col("_from") + window).cast("int").alias("_to"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   hot_segments: int = HOT_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Two tables: packed texts (``_a, _b`` key, ``_z``) of the rows that hold words
    covered by a window that starts elsewhere too, and ``_a, _b, _from, _to``,
    intervals of such words."""
    keyed = _key(docs, id_col, text_col)
    places = _cut(keyed, window)
    shared = cut_lineage(places.groupBy("_m").count().where("count > 1").select("_m"))
    places = cut_lineage(places.join(shared, "_m"))
    distinct = cut_lineage(places.groupBy("_m", "_s").agg(F.count(F.lit(1)).alias("_c"), F.min(F.struct("_a", "_b", "_start", "_n")).alias("_r")))
    sizes = cut_lineage(distinct.groupBy("_m").agg(F.count(F.lit(1)).alias("_d")).where("_d > 1").select("_m", (F.col("_d") > hot_segments).alias("_hot")))
    open_ = distinct.join(sizes, "_m").select("_r.*", "_m", "_s", "_c", "_hot")
    spans = cut_lineage(open_.groupBy("_a", "_b").agg(F.collect_list(F.struct("_start", "_n", "_m", "_s", "_c", "_hot")).alias("_spans")))
    words = cut_lineage(_fetch(_pack(keyed).join(spans, ["_a", "_b"]), window))
    shards = words.where("NOT _hot").drop("_hot").repartition("_m").sortWithinPartitions("_m")
    hits = _search(shards, window).unionByName(_count_windows(words.where("_hot").drop("_hot"), window))
    twice = distinct.where("_c > 1").select("_m", "_s", F.lit(0).alias("_from"), (F.col("_r._n") + window - 1).cast("int").alias("_to"))
    hits = cut_lineage(hits.unionByName(twice))
    found = cut_lineage(places.join(hits, ["_m", "_s"]).select("_a", "_b", (F.col("_start") + F.col("_from")).alias("_from"), (F.col("_start") + F.col("_to")).alias("_to")))
    touched = _pack(keyed).join(found.select("_a", "_b").distinct(), ["_a", "_b"])
    return touched, found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``n_removed`` (words covered by a
    window of ``window`` words that starts anywhere else, also in the same row)
    and ``kept_sha256`` (the other words, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+`` as they are; windows are judged on the input.
    Null texts have no words; texts shorter than the window keep all; repeated
    rows repeat each other.  Only the two named columns are read; an empty table
    gives an empty result."""
    touched, found = repeated_spans(docs, id_col, text_col, window, hot_segments)
    spans = found.groupBy("_a", "_b").agg(F.collect_set(F.struct("_from", "_to")).alias("_spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, digest = [], []
            for words, spans in _words_of(batch):
                change = np.zeros(len(words) + 1, np.int64)
                for x in spans:
                    change[x["_from"]] += 1
                    change[x["_to"]] -= 1
                kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                gone.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join([words[k] for k in kept])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("_a"), batch.column("_b"), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                                             names=["_a", "_b", "n_removed", "_left"])

    cut = touched.join(spans, ["_a", "_b"]).mapInArrow(run, "_a long, _b long, n_removed long, _left string").dropDuplicates(["_a", "_b"])
    return _whole(_key(docs, id_col, text_col)).join(cut, ["_a", "_b"], "left").select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_left", "_all").alias("kept_sha256"))
