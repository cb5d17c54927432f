"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits.  The
binary Golay code puts every 23-bit word within 3 bits of exactly one codeword.
The codeword indices of a segment and of all segments one bit away are its
keys ``S2``: two segments within 2 bits share one, that of a word between
them.  Those of its keys up to its own codeword's index are ``S1``: two segments
within 1 bit share the smaller of their two codewords.

With 4 differing bits in all, by pigeonhole either every segment differs in at
most two bits and two of them in at most one (keys ``S1 S1 S2`` in some order), or
one segment is equal, and of the two others the first differs in at most two
bits (``= S2``) or the second in at most one (``= S1``).  So all links share
a key of about 34 bits; candidates that share one are verified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.components import components
from tessera.llm.words import slices
from tessera.session import cut_lineage

SEED = 42
SEGMENTS = (22, 21, 21)
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SMALL_RUN, LARGE_RUN = 16, 2048
#: Keys that a fingerprint has on average, at most, and keys dealt to one task.
KEYS_A_PRINT, KEYS_A_TASK = 116, 4_000_000


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """SimHash of each text: A-Z lower-cased, words between ASCII white space,
    ``shingle`` words joined by a space (fewer words: all of them; none: 0)."""
    hashes, counts = [], []
    for text in texts:
        words = b" ".join(text.lower().split())
        if not words:
            counts.append(0)
            continue
        gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
        starts = [0, *(gaps + 1).tolist()]
        ends = [*gaps.tolist(), len(words)][min(shingle, len(starts)) - 1:]
        hashes += [xxhash.xxh64_intdigest(words[a:b], SEED) for a, b in zip(starts, ends)]
        counts.append(len(ends))
    n = np.array(counts, np.int64)
    out = np.zeros(len(n), np.uint64)
    if not hashes:
        return out
    h = np.array(hashes, np.uint64)
    full = np.flatnonzero(n)
    # Blocks of up to 255 shingles of one text: bit sums fit the bytes of a word.
    blocks = -(-n[full] // 255)
    first = np.cumsum(n[full]) - n[full]
    block_first = np.cumsum(blocks) - blocks
    start = np.repeat(first, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(block_first, blocks))
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(0x0101010101010101), start)
        sums = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), block_first, axis=0)
        most = (2 * sums > n[full, None]).astype(np.uint64)
        for lane in range(8):
            out[full] |= most[:, lane] << np.uint64(8 * lane + bit)
    return out


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``_id, _text_hash, _fp`` (signed 64-bit) of every row; null texts are empty."""
    kept = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("_text_hash"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = [x or b"" for x in part.column("_text").cast(pa.binary()).to_pylist()]
                fp = fingerprints(texts, shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_text_hash"), pa.array(fp)], names=["_id", "_text_hash", "_fp"])

    return kept.mapInArrow(run, T.StructType([kept.schema["_id"], kept.schema["_text_hash"], T.StructField("_fp", T.LongType())]))


@lru_cache
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each 12 high bits, and the error that each remainder tells."""
    def remainder(x: int) -> int:
        for k in range(22, 10, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - 11)
        return x

    errors = np.zeros(1 << 11, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[remainder(e)] = e
    return np.array([remainder(x << 11) for x in range(1 << 12)], np.int64), errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within 3 bits of each 23-bit word."""
    high, errors = _syndromes()
    return (words ^ errors[high[words >> 11] ^ (words & 0x7FF)]) >> 11


def segment_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys S2 of each segment (rows padded with -1), and which are in S1."""
    own = codeword_index(words)
    near = np.sort(np.stack([own, *[codeword_index(words ^ (1 << b)) for b in range(bits)]], 1), 1)
    fresh = np.ones(near.shape, bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    width = fresh.sum(1).max(initial=1)
    place = np.cumsum(fresh, 1) - 1
    keys = np.full((len(words), width), -1, np.int64)
    row, col = np.nonzero(fresh)
    keys[row, place[row, col]] = near[row, col]
    return keys, (keys >= 0) & (keys <= own[:, None])


def link_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints: those within 4 bits share one."""
    parts, at = [], 0
    for bits in SEGMENTS:
        parts.append(((fp >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64))
        at += bits
    (k1, s1), (k2, s2), (k3, s3) = [segment_keys(p, b) for p, b in zip(parts, SEGMENTS)]
    rows, keys = [], []
    a, b, c = k1[:, :, None, None], k2[:, None, :, None], k3[:, None, None, :]
    few = s1[:, :, None, None].astype(np.int8) + s2[:, None, :, None] + s3[:, None, None, :]
    hit = (a >= 0) & (b >= 0) & (c >= 0) & (few >= 2)
    rows.append(np.nonzero(hit)[0])
    keys.append(np.broadcast_to(a << 24 | b << 12 | c, hit.shape)[hit])
    both, tag = ((k1, s1), (k2, s2), (k3, s3)), 1
    for i in range(3):
        (kj, _), (kk, sk) = [both[j] for j in range(3) if j != i]
        for k, use in ((kj, kj >= 0), (kk, sk)):
            row, col = np.nonzero(use)
            rows.append(row)
            keys.append(tag << 40 | parts[i][row] << 12 | k[row, col])
            tag += 1
    return np.concatenate(rows), np.concatenate(keys)


def midpoints(fp: np.ndarray, distance: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """All words within half of ``distance`` (rounded up) of each fingerprint (rows), and which are within half rounded
    down: two fingerprints are within ``distance`` where a word is near to one and
    within the larger half of the other."""
    one = [1 << b for b in range(64)]
    by_bits = [[0], one, [x | y for x, y in combinations(one, 2)]]
    masks = [m for bits in by_bits[:(distance + 1) // 2 + 1] for m in bits]
    near = np.arange(len(masks)) < sum(map(len, by_bits[:distance // 2 + 1]))
    return fp[:, None] ^ np.array(masks, np.uint64)[None, :], near


def _runs(batches: Iterator[pa.RecordBatch], large: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, fp) arrays of rows in order of key; a run of equal keys is not cut
    unless it is longer than ``large``."""
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for batch in batches:
        key, fp = (np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("_key", "_fp")))
        if not len(key):
            continue
        cut = np.searchsorted(key, key[-1])  # the last run may go on
        if len(key) - cut > 2 * large + 2:
            cut = len(key) - large - 1  # either part is a long run
        yield key[:cut], fp[:cut]
        held = key[cut:], fp[cut:]
    yield held


def _verified(key: np.ndarray, fp: np.ndarray, distance: int, large: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Links (a, b, False) among fingerprints of equal keys: the verified pairs of
    short runs, a spanning forest of longer ones.  Runs above ``large`` come as
    (fingerprints, fingerprints, True), to be linked by midpoints."""
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if len(key) else np.zeros(0, np.int64)
    size = np.diff(first, append=len(key))
    long = np.repeat(size > SMALL_RUN, size)
    u = fp.view(np.uint64)
    for d in range(1, min(SMALL_RUN, size.max(initial=1))):
        at = np.flatnonzero((key[d:] == key[:-d]) & ~long[d:])
        at = at[np.bitwise_count(u[at] ^ u[at + d]) <= distance]
        yield fp[at], fp[at + d], False
    for s, n in zip(first[size > SMALL_RUN], size[size > SMALL_RUN]):
        run = u[s:s + n]
        if n > large:
            yield fp[s:s + n], fp[s:s + n], True
            continue
        left = np.arange(n)
        while len(left):
            root, left = left[0], left[1:]
            reach, tree = np.array([root]), []
            while len(reach) and len(left):
                near = np.zeros(len(left), bool)
                for block in np.array_split(reach, -(-len(reach) // 64)):
                    near |= (np.bitwise_count(run[left][:, None] ^ run[block][None, :]) <= distance).any(1)
                reach, left = left[near], left[~near]
                tree.append(reach)
            if tree:
                members = s + np.concatenate(tree)
                yield fp[members], np.full(len(members), fp[s + root]), False


def links(prints: DataFrame, distance: int = 4, large_run: int = LARGE_RUN) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``_fp``) whose connected
    components are those of all pairs within ``distance`` (4 or less) bits."""
    if not 0 <= distance <= 4:
        raise ValueError("the keys are made for 4 or fewer differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("_fp").to_numpy()
            for at in range(0, len(fp), 2048):
                part = fp[at:at + 2048]
                row, key = link_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["_key", "_fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp in _runs(batches, large_run):
            for a, b, large in _verified(key, fp, distance, large_run):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), large))], names=["a", "b", "large"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("a").to_numpy()
            for at in range(0, len(fp), 64):
                part = fp[at:at + 64]
                mid, near = midpoints(part.view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays([pa.array(mid.view(np.int64).ravel()), pa.array(np.repeat(part, mid.shape[1])), pa.array(np.tile(near, len(part)))], names=["_key", "_fp", "near"])

    pair = "_key long, _fp long"
    distinct = prints.select("_fp").distinct()
    # Fingerprints are 8 bytes and their keys over a hundred times as much, so tasks are counted by keys.
    tasks = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), prints.count() * KEYS_A_PRINT // KEYS_A_TASK)
    # Dealt by another value than the distinct fingerprints are, else Spark takes the second shuffle for the first.
    ordered = distinct.repartition(tasks, F.xxhash64("_fp")).mapInArrow(keyed, pair).repartition(tasks, "_key").sortWithinPartitions("_key", "_fp")
    found = cut_lineage(ordered.mapInArrow(verify, "a long, b long, large boolean").distinct())
    near = found.where("NOT large").select("a", "b")
    large = found.where("large").select("a").distinct()
    if large.isEmpty():
        return near
    mids = large.mapInArrow(spread, f"{pair}, near boolean")
    least = cut_lineage(mids.groupBy("_key").agg(F.min(F.when(F.col("near"), F.col("_fp"))).alias("b"), F.count(F.lit(1)).alias("_n"))
                        .where("_n > 1 AND b IS NOT NULL").drop("_n"))
    return near.unionByName(mids.join(least, "_key").where("_fp != b").select(F.col("_fp").alias("a"), "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable over links of ``distance`` or fewer bits)
    and ``kept``: one row of a component, that of the smallest id; of several such rows the one with the smallest
    text hash, of rows that repeat id and text one.

    Null, empty and wordless texts have fingerprint 0 and link to each other like any
    others.  Null ids count as above all others.  Only the two named columns are read; an empty table gives an empty
    result."""
    rows = cut_lineage(fingerprint(docs, id_col, text_col, shingle).withColumn("_row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_text_hash").alias("h"), F.col("_row").alias("row"))).alias("_first")
    prints = cut_lineage(rows.groupBy("_fp").agg(first, F.count(F.lit(1)).alias("_n")))
    roots = cut_lineage(components(links(prints, distance)))
    joined = prints.join(roots.withColumnRenamed("node", "_fp"), "_fp").select("root", "_fp", "_first")
    best = cut_lineage(joined.groupBy("root").agg(F.min("_first").alias("_first")))
    linked = roots.join(best, "root").select(F.col("node").alias("_fp"), "_first")
    shared = prints.where("_n > 1").join(linked.select("_fp"), "_fp", "left_anti").select("_fp", "_first")
    classes = cut_lineage(linked.unionByName(shared))
    alone = F.col("_first").isNull()
    return rows.join(classes, "_fp", "left").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.when(alone, F.col("_id")).otherwise(F.col("_first.id")).alias("component_id"),
        (alone | (F.col("_row") == F.col("_first.row"))).alias("kept"),
        F.col("_text_hash").alias("text_hash"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) that :func:`near_duplicates` keeps, one of each component.  Only
    documents with rows that repeat id and text pass a window, cut to one row a task before its shuffle; the texts of
    others aren't shuffled for it."""
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    key = [F.col(id_col).alias("_id"), F.col("text_hash").alias("_h")]
    keys = cut_lineage(found.select(*key, "kept").groupBy("_id", "_h").agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_n")).where("_kept").drop("_kept"))
    mine = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    whole = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_key"), mine.alias("_mine"))

    def those(which: DataFrame) -> DataFrame:
        return whole.join(which, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mine") == F.col("_h")), "left_semi")
    again = those(keys.where("_n > 1")).withColumn("_copy", F.row_number().over(Window.partitionBy("_key", "_mine").orderBy(F.lit(0)))).where("_copy = 1")
    return those(keys.where("_n = 1")).select("_doc.*").unionByName(again.select("_doc.*"))
