"""Document splitting into size-bounded, optionally overlapping segments.

Everything runs as native higher-order functions over one document's arrays
(no Python, no shuffle):

1. *Descent*: a piece longer than ``max_chars`` is split at the next, finer
   level (paragraph -> line -> sentence -> word -> hard cut), level within level, so
   that a piece that fits is not looked at again.  Each piece keeps the joiner that
   separated it from its predecessor.
2. *Packing*: one ``aggregate`` fold over the pieces carries the open segment
   and the closed ones and greedily fills segments left to right.
3. *Overlap*: segment ``i > 0`` is prefixed by the longest run of whole
   trailing sentences of segment ``i-1`` that fits ``overlap`` and keeps the
   total within ``max_chars``; otherwise by nothing.

Sizes are characters.  Segments are indexed from 0 per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import errors as E
from tessera.functions.text import _once, jtrim

# Split levels (regex, joiner) and the strategies using them.
LEVELS = {
    "paragraph": (r"\n\s*\n", "\n\n"),
    "line": (r"\n", "\n"),
    "sentence": (r"(?<=[.!?])\s+", " "),
    "word": (r"\s+", " "),
}
STRATEGIES = {
    "Recursive": ("paragraph", "line", "sentence", "word"),
    "ByParagraph": ("paragraph", "sentence", "word"),
    "BySentence": ("sentence", "word"),
}
DEFAULT_MAX_CHARS = 1000
DEFAULT_OVERLAP = 200

# Java tries a look-behind at every character, but this one only at blanks; it finds the same.
_FASTER = {LEVELS["sentence"][0]: r"\s(?<=[.!?]\s)\s*+"}
_BLANKS = " \t\n\x0b\f\r"


def _split(text: Column, regex: str) -> Column:
    return F.split(text, _FASTER.get(regex, regex))


def _trim(t: Column) -> Column:
    """As :func:`jtrim`, by its pattern only where that one's ``$`` has more than one meaning: before a last
    line separator."""
    odd = t.endswith("\u0085") | t.endswith("\u2028") | t.endswith("\u2029")
    return F.when(odd, jtrim(t)).otherwise(F.btrim(t, F.lit(_BLANKS)))


def _piece(t: Column, j: Column) -> Column:
    return F.struct(t.alias("t"), j.alias("j"))


def _descend(t: Column, j: Column, levels: tuple[str, ...], max_chars: int) -> Column:
    """The pieces of ``t``, whose own joiner is ``j``; a blank piece is empty."""
    if levels:
        regex, joiner = LEVELS[levels[0]]
        finer = F.flatten(F.transform(_split(_trim(t), regex), lambda s, i: _descend(
            s, F.when(i == 0, j).otherwise(F.lit(joiner)), levels[1:], max_chars)))
    else:
        n = F.floor((F.length(t) - 1) / max_chars).cast("int")
        finer = F.transform(F.sequence(F.lit(0), n), lambda i: _piece(
            _trim(F.substring(t, i * max_chars + 1, max_chars)), F.when(i == 0, j).otherwise(F.lit(""))))
    return F.when(F.length(t) <= max_chars, F.array(_piece(_trim(t), j))).otherwise(finer)


def _pack(pieces: Column, max_chars: int) -> Column:
    """Greedy packing -> array<string>; empty pieces are passed over."""
    zero = F.struct(F.lit(0).alias("n"), F.lit("").alias("open"), F.expr("cast(array() as array<string>)").alias("closed"))

    def closed(acc):
        return F.when(acc["n"] > 0, F.array_append(acc["closed"], acc["open"])).otherwise(acc["closed"])

    def step(acc, x):
        n = acc["n"] + F.length(x["j"]) + F.length(x["t"])
        grown = F.struct(n.alias("n"), F.concat(acc["open"], x["j"], x["t"]).alias("open"), acc["closed"].alias("closed"))
        fresh = F.struct(F.length(x["t"]).alias("n"), x["t"].alias("open"), closed(acc).alias("closed"))
        return F.when(x["t"] == "", acc).when((acc["n"] > 0) & (n <= max_chars), grown).otherwise(fresh)

    return F.aggregate(pieces, zero, step, closed)


def _with_overlap(segs: Column, overlap: int, max_chars: int) -> Column:
    if overlap <= 0:
        return segs
    # Pair each segment with its predecessor up front: a lambda that reads the
    # whole array by index would re-evaluate the array once per element.
    prevs = F.slice(F.concat(F.array(F.lit(None).cast("string")), segs), 1, F.size(segs))

    def one(z):
        cur, prev = z["cur"], z["prev"]
        limit = F.least(F.lit(overlap), F.lit(max_chars - 1) - F.length(cur))

        def fit(acc, s):
            tot = acc["tot"] + F.length(s) + F.when(acc["tot"] > 0, 1).otherwise(0)
            return F.struct(tot.alias("tot"), (acc["n"] + F.when(tot <= limit, 1).otherwise(0)).alias("n"))

        def prefixed(text, unless):
            def use(sents):
                run = F.aggregate(sents, F.struct(F.lit(0).alias("tot"), F.lit(0).alias("n")), fit)

                def joined(r):
                    found = F.concat(F.array_join(F.reverse(F.slice(sents, 1, r["n"])), " "), F.lit(" "), cur)
                    return unless(r, F.when(r["n"] > 0, found).otherwise(cur))
                return _once(run, joined)
            return _once(F.reverse(_split(text, LEVELS["sentence"][0])), use)

        # The last characters of the predecessor show what fits, unless they hold so many
        # blanks that one more sentence might.
        tail = F.ltrim(F.substring(prev, -(limit + 2), limit + 2), F.lit(_BLANKS))
        vague = lambda r: (r["tot"] <= limit) & (F.length(prev) > limit + 2)
        out = prefixed(tail, lambda r, found: F.when(vague(r), prefixed(prev, lambda _, all_: all_)).otherwise(found))
        return F.when(prev.isNull() | (limit <= 0), cur).otherwise(out)
    zipped = F.arrays_zip(segs.alias("cur"), prevs.alias("prev"))
    return F.transform(zipped, one)


def _check(strategy: str, max_chars: int, overlap: int) -> None:
    if strategy not in STRATEGIES:
        raise E.TesseraError(E.INVALID_STRATEGY, strategy)
    if max_chars <= 0 or overlap < 0 or overlap >= max_chars:
        raise E.TesseraError(E.FAILED_TO_SPLIT, f"need 0 <= overlap < max ({overlap}, {max_chars})")


def with_segments(df: DataFrame, text_col: str, strategy: str = "Recursive",
                  max_chars: int = DEFAULT_MAX_CHARS, overlap: int = DEFAULT_OVERLAP,
                  out_col: str = "_segs") -> DataFrame:
    """Add ``out_col``: array<string> of the segment texts of each document.

    Each intermediate array is its own projection so it is evaluated once per
    document (an expression referenced inside a lambda would otherwise be
    re-evaluated per element).
    """
    _check(strategy, max_chars, overlap)
    pieces = _descend(F.col(text_col), F.lit(""), STRATEGIES[strategy], max_chars)
    staged = df.withColumn("_pieces", pieces).withColumn("_plain", _pack(F.col("_pieces"), max_chars))
    return staged.withColumn(out_col, _with_overlap(F.col("_plain"), overlap, max_chars)).drop("_pieces", "_plain")


def split_documents(df: DataFrame, strategy: str = "Recursive",
                    max_chars: int = DEFAULT_MAX_CHARS, overlap: int = DEFAULT_OVERLAP, *,
                    text_col: str = "text") -> DataFrame:
    """One row per segment: all input columns but ``text`` + ``index``, ``text``,
    ``error_code``.

    One pass: ``posexplode_outer`` keeps documents without any non-blank
    segment as a single row with NULL index/text and ``error_code`` 701152.
    """
    keep = [c for c in df.columns if c != text_col]
    staged = with_segments(df, text_col, strategy, max_chars, overlap).select(*keep, "_segs")
    out = staged.select(*keep, F.posexplode_outer("_segs").alias("index", "text"))
    return out.withColumn("error_code", F.when(F.col("index").isNull(), F.lit(E.FAILED_TO_SPLIT)))


def window_expr(text, max_chars: int = DEFAULT_MAX_CHARS, overlap: int = DEFAULT_OVERLAP) -> Column:
    """Fixed character windows of ``max_chars`` advancing by ``max - overlap``."""
    if max_chars <= 0 or overlap < 0 or overlap >= max_chars:
        raise E.TesseraError(E.FAILED_TO_SPLIT, "need 0 <= overlap < max")
    t = F.col(text) if isinstance(text, str) else text
    stride = max_chars - overlap
    n = F.floor(F.greatest(F.length(t) - overlap - 1, F.lit(0)) / stride).cast("int")
    return F.transform(F.sequence(F.lit(0), n),
                       lambda i: F.substring(t, i * stride + 1, max_chars))


def split_window(df: DataFrame, max_chars: int = DEFAULT_MAX_CHARS, overlap: int = DEFAULT_OVERLAP,
                 *, text_col: str = "text") -> DataFrame:
    keep = [c for c in df.columns if c != text_col]
    return df.where(F.length(text_col) > 0).select(
        *keep, F.posexplode(window_expr(text_col, max_chars, overlap)).alias("index", "text"))
