"""How far the sources of a language stand apart in their words.

Terms are counted once over all whole texts.  The terms that a language keeps
form a term-major index: one row a term, with the sources that hold it.  All
pairs of sources are compared by sparse rows (Gustavson): a source walks its
terms through the index and adds into one dense array over its peers, so
pairs of postings are never rows.  What terms that one or both sources lack
add (their counts are zero, their probabilities aren't) is corrected from
histograms of equal probabilities, without touching those terms.  All
arithmetic is on integers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

SCALE = 1_000_000_000
#: Bytes to lower-cased term bytes; all else parts terms.  A character beyond
#: ASCII consists of bytes beyond 0x7F, so bytes give the same terms as characters.
_TERM_BYTES = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_PIECE = 1 << 20


def terms_of(text: bytes) -> Counter:
    """Terms of a UTF-8 text and how often each occurs, read a megabyte at a time."""
    text = text.translate(_TERM_BYTES)
    found, at = Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + _PIECE) if at + _PIECE < len(text) else -1
        end = len(text) if end < 0 else end
        found.update(text[at:end].split())
        at = end
    return found


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                held: int = 300_000) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term, and
    a row with a null term for every group.  A task adds up its documents and
    passes its sums on whenever they are ``held`` or more, so few rows are shuffled."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))],
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            for (lang, source), (n, seen, rows) in sums.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * (len(terms) + 1)), pa.array([source] * (len(terms) + 1)),
                    pa.array([*terms, None], pa.binary()).cast(pa.string()),
                    pa.array([*n.values(), 0], pa.int64()), pa.array([*[seen[t] for t in terms], rows[0]], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            sums.clear()

        sums: dict = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*[batch.column(k).to_pylist() for k in range(2)], batch.column(2)):
                n, seen, rows = sums.setdefault((lang, source), (Counter(), Counter(), [0]))
                size -= len(n)
                found = terms_of(text.as_py())
                n.update(found)
                seen.update(found.keys())
                rows[0] += 1
                size += len(n)
                if size >= held:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exact for any long; 1 where nothing is kept."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(kept > 0, F.call_function("div", whole, (total + kept).cast("decimal(20,0)")) + 1).otherwise(F.lit(1)).cast("long")


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def scatter(offsets: np.ndarray, source: np.ndarray, p: np.ndarray, zero: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sparse row accumulation over a block of terms of one language: term t holds the
    postings ``offsets[t]:offsets[t + 1]`` (``source``, its share ``p`` and its share ``zero`` of
    a term it lacks).  For each source, the peers it meets and the sum over shared terms of
    f(p, q) - f(p, zero q) - f(zero p, q) + f(zero p, zero q)."""
    term = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.argsort(source, kind="stable")
    cuts = np.flatnonzero(np.diff(source[order])) + 1
    dense = np.zeros(int(source.max()) + 1 if len(source) else 0, np.int64)
    for own in np.split(order, cuts) if len(order) else []:
        first, many = offsets[term[own]], np.diff(offsets)[term[own]]
        start = np.cumsum(many) - many
        at = np.arange(start[-1] + many[-1]) - np.repeat(start - first, many)
        me, mine, zq, q = np.repeat(p[own], many), zero[own[0]], zero[at], p[at]
        np.add.at(dense, source[at], _f(me, q) - _f(me, zq) - _f(mine, q) + _f(mine, zq))
        met = np.unique(source[at])
        yield int(source[own[0]]), met, dense[met]
        dense[met] = 0


def _shared_terms(index: DataFrame, postings: int = 1 << 18) -> DataFrame:
    """``lang, s, peer, value``: what shared terms add, of blocks of about ``postings`` postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            table = pa.Table.from_batches(waiting)
            waiting.clear()
            langs = table.column("lang").combine_chunks().dictionary_encode()
            number = langs.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                lists = table.filter(pa.array(number == k)).column("postings").combine_chunks()
                offsets = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
                fields = [x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten()]
                for s, met, value in scatter(offsets, *fields):
                    other = met != s
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * int(other.sum()), pa.string()), pa.array(np.full(int(other.sum()), s, np.int64)),
                                                      pa.array(met[other].astype(np.int64)), pa.array(value[other])], names=["lang", "s", "peer", "value"])

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += len(batch.column("postings").flatten())
            if size >= postings:
                yield from flush()
                size = 0
        if waiting:
            yield from flush()

    return index.select("lang", "postings").mapInArrow(run, "lang string, s long, peer long, value long")


def _lacking_terms(groups: DataFrame, index: DataFrame, block: int = 4096) -> DataFrame:
    """``lang, s, peer, value``: the sum as if no term were shared, from each source's histogram
    of shares (at most about the root of twice its words, as counts are distinct) against
    dense blocks of peers."""
    own = index.select("lang", F.explode("postings").alias("_x")).groupBy("lang", F.col("_x.s").alias("s"), F.col("_x.p").alias("p")).agg(F.count(F.lit(1)).alias("m"))
    own = own.groupBy("lang", "s").agg(F.collect_list(F.struct("p", "m")).alias("shares"))
    peers = groups.groupBy("lang", F.expr("s div " + str(block)).alias("_block")).agg(F.collect_list(F.struct(F.col("s").alias("peer"), F.col("zero").alias("peer_zero"))).alias("peers"))
    rows = groups.select("lang", "s", "zero", "kept").join(own, ["lang", "s"], "left").join(peers.drop("_block"), "lang")
    rows = rows.withColumn("shares", F.coalesce("shares", F.expr("cast(array() as array<struct<p:bigint,m:bigint>>)")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            for k in range(batch.num_rows):
                lang, s, zero, kept = (column[c][k].as_py() for c in ("lang", "s", "zero", "kept"))
                p, m = (x.to_numpy(zero_copy_only=False) for x in column["shares"][k].values.flatten())
                peer, peer_zero = (x.to_numpy(zero_copy_only=False) for x in column["peers"][k].values.flatten())
                ours = np.full(len(peer), kept, np.int64) * _f(np.int64(zero), peer_zero) if kept else np.zeros(len(peer), np.int64)
                theirs = np.zeros(len(peer), np.int64)
                both, back = _f(np.int64(zero), peer_zero), _f(peer_zero, np.int64(zero))
                for a in range(0, len(p), 256):
                    share, many = p[a:a + 256, None], m[a:a + 256, None]
                    ours += (many * (_f(share, peer_zero) - both)).sum(0)
                    theirs += (many * (_f(peer_zero[None, :], share) - back)).sum(0)
                other = peer != s
                n = int(other.sum())
                me = pa.array(np.full(n, s, np.int64))
                for x, y, v in ((me, pa.array(peer[other]), ours), (pa.array(peer[other]), me, theirs)):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), x, y, pa.array(v[other])], names=["lang", "s", "peer", "value"])

    return rows.select("lang", "s", "zero", "kept", "shares", "peers").mapInArrow(run, "lang string, s long, peer long, value long")


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    A language keeps the terms in at least ``least_docs`` of its rows.  Every group (language and
    source) and every language gives each kept term the share p = 1 + floor(10^9 (count + 1) / (N + V)),
    and two shares differ by f = floor((p - q)^2 / q).  Part ``pair``: for each other source of the
    language, f summed over all V terms.  Part ``term``: the ``top_terms`` terms that the group has and
    uses more than its language does, with their f.  Ranks go by falling value, then item by its bytes.

    Nulls in the three columns are empty texts; every row is a document, repeated rows too; groups
    without terms have pairs (0 where V is 0) and no terms; ties in value are ordered by item.  Other
    columns are not read, so their names cannot clash.  An empty table gives an empty result."""
    counts = cut_lineage(term_counts(docs, text_col, lang_col, source_col))
    words = counts.where(F.col("term").isNotNull())
    terms = cut_lineage(words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs"))
                        .where(F.col("_docs") >= least_docs).drop("_docs"))
    kept = words.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = (counts.where(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["total", "kept", "lang_total"])
              .withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
              .withColumn("zero", _share(F.lit(0), F.col("total"), F.col("kept"))))
    groups = cut_lineage(groups)

    posting = kept.join(groups, ["lang", "source"]).select(
        "lang", "term", _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
        F.struct("s", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "zero").alias("posting"))
    index = cut_lineage(posting.groupBy("lang", "term", "q").agg(F.collect_list("posting").alias("postings")))

    pairs = (_shared_terms(index).unionByName(_lacking_terms(groups, index)).groupBy("lang", "s", "peer")
             .agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")))
    names = groups.select("lang", "s", "source")
    pairs = (pairs.join(names, ["lang", "s"]).join(names.select("lang", F.col("s").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by))

    own = index.select("lang", F.col("term").alias("item"), "q", F.explode("postings").alias("_x")).where(F.col("_x.p") > F.col("q"))
    own = own.select("lang", F.col("_x.s").alias("s"), "item", _gap(F.col("_x.p"), F.col("q")).alias("value"))
    top = Window.partitionBy("lang", "s").orderBy(F.col("value").desc(), "item")
    own = own.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= top_terms)
    own = own.join(names, ["lang", "s"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(own)
