"""Document fingerprints: the k least hashes of a text's word shingles.

Such a bottom-k sketch is a uniform sample of the distinct shingles.  The
sketch of a whole is the k least of the sketches of its parts, so long texts
are read piece by piece and parts on different machines are merged; two
sketches estimate resemblance, containment and the number of distinct
shingles.  All of it is built-in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BITS = 48
_MASK = (1 << BITS) - 1
PIECE = 1 << 15


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def word_hash(word: Column) -> Column:
    """The first 48 bits of the word's MD5, as a number."""
    return F.conv(F.substring(F.md5(word.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _weigh(words: list[Column]) -> Column:
    """Hash of word hashes in order: powers of 3 as weights, modulo 2^48."""
    total = words[0]
    for k, w in enumerate(words[1:], 1):
        total = total + w * F.lit(3 ** k)
    return total.bitwiseAND(F.lit(_MASK))


def _least(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = 128, shingle: int = 5) -> Column:
    """Array of the ``k`` least distinct hashes of the text's ``shingle``-word shingles, ascending.

    A text of fewer words has one shingle, all its words; a text without words and null have
    none (an empty array).  The text is read by pieces of some 32,000 characters that end with a word;
    their sketches are merged and the last words carried over, so the size of a text
    bounds no array of words or hashes."""
    if not 1 <= shingle <= 9:
        raise ValueError("shingles of 1 to 9 words; longer ones overflow the weights")
    none = F.expr("cast(array() as array<bigint>)")
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s).{{1,{PIECE}}}+{WORD[:-1]}*+"), F.lit(0))

    def step(state: Column, piece: Column) -> Column:
        words = F.transform(F.regexp_extract_all(piece, F.lit(WORD), F.lit(0)), word_hash)

        def join(h: Column) -> Column:
            starts = F.slice(h, 1, F.greatest(F.size(h) - (shingle - 1), F.lit(0)))
            new = F.transform(starts, lambda x, i: _weigh([x, *[F.get(h, i + j) for j in range(1, shingle)]]))
            rest = F.slice(h, F.greatest(F.size(h) - (shingle - 2), F.lit(1)), shingle - 1) if shingle > 1 else none
            return F.struct(_least(F.concat(state["least"], new), k).alias("least"), rest.alias("rest"))
        return _bind(F.concat(state["rest"], words), join)

    def end(state: Column) -> Column:
        few = F.aggregate(state["rest"], F.struct(F.lit(0).cast("long").alias("sum"), F.lit(1).cast("long").alias("w")),
                          lambda a, x: F.struct((a["sum"] + x * a["w"]).alias("sum"), (a["w"] * 3).alias("w")), lambda a: a["sum"].bitwiseAND(F.lit(_MASK)))
        return F.when((F.size(state["least"]) == 0) & (F.size(state["rest"]) > 0), F.array(few)).otherwise(state["least"])

    return F.aggregate(pieces, F.struct(none.alias("least"), none.alias("rest")), step, end)


def merge(a: Column, b: Column, k: int = 128) -> Column:
    """Sketch of two parts together, from their sketches (null: empty)."""
    none = F.expr("cast(array() as array<bigint>)")
    return _least(F.concat(F.coalesce(a, none), F.coalesce(b, none)), k)


def merge_parts(parts: DataFrame, key_cols: list[str], sketch_col: str = "sketch", k: int = 128) -> DataFrame:
    """``key_cols`` and the sketch of all rows of a key.  Only a task's least ``k`` hashes of a key are
    shuffled (limits before windows), so a key may hold any share of the rows."""
    keys = [F.col(c).alias(f"_k{j}") for j, c in enumerate(key_cols)]
    names = [f"_k{j}" for j in range(len(key_cols))]
    all_keys = parts.select(*keys).distinct()
    hashes = parts.select(*keys, F.explode(sketch_col).alias("_h")).distinct()
    place = F.row_number().over(Window.partitionBy(*names).orderBy("_h"))
    least = hashes.withColumn("_place", place).where(F.col("_place") <= k).groupBy(*names).agg(F.sort_array(F.collect_list("_h")).alias("_sketch"))
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return (all_keys.alias("a").join(least.alias("b"), on, "left")
            .select(*[F.col(f"a.{n}").alias(c) for n, c in zip(names, key_cols)],
                    F.coalesce("b._sketch", F.expr("cast(array() as array<bigint>)")).alias(sketch_col)))


def _shared(a: Column, b: Column, k: int, use) -> Column:
    """``use(a, b)`` on the hashes up to the lower of both sketches' ends: a full sketch knows
    all its text's hashes up to its last one, a shorter sketch knows all."""
    def end(x: Column) -> Column:
        return F.when(F.size(x) >= k, F.element_at(x, k)).otherwise(F.lit(_MASK))

    def cut(x: Column) -> Column:
        top = F.least(end(x["a"]), end(x["b"]))
        return _bind(top, lambda t: F.struct(F.filter(x["a"], lambda h: h <= t).alias("a"), F.filter(x["b"], lambda h: h <= t).alias("b")))
    return _bind(F.struct(a.alias("a"), b.alias("b")), lambda x: _bind(cut(x), lambda y: use(y["a"], y["b"])))


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of all distinct shingles of two texts that both have; exact where neither has
    ``k`` or more.  Two texts without shingles resemble each other fully."""
    def share(x: Column, y: Column) -> Column:
        union = F.size(F.array_union(x, y))
        return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / union)
    return _shared(a, b, k, share)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of the first text's distinct shingles that the second has (none: 1)."""
    return _shared(a, b, k, lambda x, y: F.when(F.size(x) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(x)))


def distinct_shingles(a: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / ((F.element_at(a, k) + 1) / float(1 << BITS)))


def fingerprint(a: Column) -> Column:
    """A sketch as text: 12 hexadecimal digits a hash, ascending (no shingles: empty)."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), BITS // 4, "0"))), "")


def _bounds(ids: DataFrame, rows_per_bucket: int, most_buckets: int) -> tuple[list[int], int | None]:
    """Ids that begin a bucket, ascending, and the least id in order (None where some id is null or no row is).
    They come from a sample of at most eight ids a bucket; it decides where buckets
    are cut and nothing else."""
    n, known, first = ids.agg(F.count(F.lit(1)), F.count("_id"), F.min("_id")).first()
    want = min(most_buckets, known // rows_per_bucket)
    if want == 0:
        return [], first if n == known else None
    rate = min(1.0, 8 * want / known)
    sample = ids.where(F.col("_id").isNotNull() & (F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < F.lit(rate * (1 << 20))))
    cuts = sample.agg(F.percentile_approx("_id", [(j + 0.5) / want for j in range(want)], 10 * want)).first()[0]
    return sorted(set(cuts or [])), first if n == known else None


def _bucket(value: Column, bounds: Column, n: int) -> Column:
    """How many of the ascending ``bounds`` are at or below ``value`` (null: 0), by bisection."""
    steps = [1 << j for j in range(n.bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda low, step: F.when((low + step <= n) & (F.get(bounds, low + step - 1) <= value), low + step).otherwise(low))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 256, most_buckets: int = 1 << 16) -> DataFrame:
    """``_id, _text, _bucket, _ghost`` and the order ``_wrap, _id, _tie, _text`` in which every row is followed, in its
    own bucket, by the row with the next id, and the last by the first.

    Buckets are ranges of ids that begin at ids of the table; the rows that begin a bucket are sent to
    the bucket before, too, as ghosts.  So one shuffle of the texts gives every row its
    neighbour, without sorting the whole table or a second look at bucket ends.  Null
    ids come first; rows of one id follow each other by a hash of their texts."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    bounds, first = _bounds(rows.select("_id"), rows_per_bucket, most_buckets)
    n = len(bounds)
    where = F.lit(0)
    ghosts = [F.when(F.col("_id").eqNullSafe(F.lit(first).cast(rows.schema["_id"].dataType)), F.struct(F.lit(n).alias("_bucket"), F.lit(True).alias("_ghost"), F.lit(1).alias("_wrap")))]
    if n:
        cuts = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        where = _bucket(F.col("_id"), cuts, n)
        ghosts.append(F.when(F.get(cuts, F.col("_b") - 1) == F.col("_id"), F.struct((F.col("_b") - 1).alias("_bucket"), F.lit(True).alias("_ghost"), F.lit(0).alias("_wrap"))))
    here = F.struct(F.col("_b").alias("_bucket"), F.lit(False).alias("_ghost"), F.lit(0).alias("_wrap"))
    rows = rows.withColumn("_b", where)
    return rows.select("_id", "_text", F.inline(F.array_compact(F.array(here, *ghosts)))).withColumn("_tie", F.xxhash64("_text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 128, shingle: int = 5) -> DataFrame:
    """One row per input row: ``id_col``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``, ``contained_next`` (share of its shingles that the next document has) and ``n_shingles``.

    The edited text has the last quarter (rounded down) of its characters replaced by the first as many, or
    all, of the next document's; the next one is that of the next larger id, after the last the
    first.  Null texts are empty; null ids come before all others; rows that share an id follow each other
    by a hash of their texts, so equal rows get the same result in some order.
    A table of one row is its own next.  Other columns are not read.  An empty table gives an empty result."""
    rows = neighbours(docs, id_col, text_col)
    order = Window.partitionBy("_bucket").orderBy("_wrap", F.col("_id").asc_nulls_first(), "_tie", "_text")
    rows = rows.withColumn("_next", F.lead("_text").over(order))
    # Same partitions and order: the second window needs no shuffle and no sort.
    rows = rows.withColumn("_sketch", sketch(F.col("_text"), k, shingle)).withColumn("_next_sketch", F.lead("_sketch").over(order)).where(~F.col("_ghost"))
    cut = F.length("_text") - F.expr("length(_text) div 4")
    rows = rows.select("_id", "_sketch", "_next_sketch", F.length("_text").cast("long").alias("n_chars"),
                       F.concat(F.substring("_text", F.lit(1), cut.cast("int")), F.substring("_next", F.lit(1), F.expr("cast(length(_text) div 4 as int)"))).alias("_edited"))
    rows = rows.withColumn("_edited_sketch", sketch(F.col("_edited"), k, shingle))
    return rows.select(F.col("_id").alias(id_col), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), fingerprint(F.col("_sketch")).alias("fingerprint"),
                       fingerprint(F.col("_edited_sketch")).alias("edited_fingerprint"), resemblance(F.col("_sketch"), F.col("_edited_sketch"), k).alias("near_edited"),
                       resemblance(F.col("_sketch"), F.col("_next_sketch"), k).alias("near_next"), containment(F.col("_sketch"), F.col("_next_sketch"), k).alias("contained_next"),
                       distinct_shingles(F.col("_sketch"), k).alias("n_shingles"))
