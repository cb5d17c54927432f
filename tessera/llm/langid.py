"""Language identification: multinomial naive Bayes over hashed character
n-grams.  Counts are summed over all training rows; the matrix of log
probabilities (languages x buckets) is broadcast, and slices of texts are scored as
sparse rows of bucket numbers against it, all texts of a slice at once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.words import add_columns, mix, slices

BUCKETS = 1 << 15
ORDERS = (2, 3)
MOST_LANGUAGES = 256
#: Bytes of text whose n-grams are made at once, and log-probabilities gathered at once.
SLICE, CELLS = 1 << 17, 1 << 18

_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For each code point, whether it is a letter (made once a worker)."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(texts: list[str | None], orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the n-grams of all texts, and the text's number of each, ascending.  A text is
    lower-cased, every run of other characters than letters is one space, with a space at
    either end; n-grams of spaces alone don't occur, so texts without a letter (and nulls) have none."""
    codes = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) + 2 for c in codes], np.int64)
    row = np.repeat(np.arange(len(codes)), sizes)
    padded = np.zeros(len(row), np.uint64)
    if codes:
        flat = np.concatenate(codes)
        inside = np.ones(len(row), bool)
        ends = np.cumsum(sizes)
        inside[ends - 1] = inside[ends - sizes] = False
        padded[inside] = np.where(is_letter()[flat], flat, 0)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0) | (row[1:] != row[:-1])
    padded, row = padded[keep], row[keep]
    grams, rows, key = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], padded
    for n in range(2, max(orders) + 1):
        if len(padded) < n:
            break
        key = (key[:len(padded) - n + 1] << np.uint64(21)) | padded[n - 1:]
        if n in orders:
            whole = row[n - 1:] == row[:len(row) - n + 1]  # within one text
            grams.append((mix(key[whole] + np.uint64(n)) % np.uint64(buckets)).astype(np.int32))
            rows.append(row[n - 1:][whole])
    grams, rows = np.concatenate(grams), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return grams[order], rows[order]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # in code point order
    prior: np.ndarray
    logp: np.ndarray  # bucket, language

    def score(self, grams: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For ``n`` texts the number of the likeliest language (ties: the first; -1: no n-gram) and its
        posterior.  Log-probabilities of many texts' n-grams are gathered at once and added up by text."""
        total = np.repeat(self.prior[None], n, axis=0)
        step = max(1024, CELLS // max(1, len(self.prior)))
        for a in range(0, len(grams), step):
            mine = rows[a:a + step]
            first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            total[mine[first]] += np.add.reduceat(self.logp[grams[a:a + step]], first, axis=0)
        best = total.argmax(1)
        posterior = 1 / np.exp(total - total[np.arange(n), best][:, None]).sum(1)
        none = np.bincount(rows, minlength=n) == 0
        return np.where(none, -1, best), np.where(none, 0.0, posterior)


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """Learns from all rows with text and language.  The driver gets one count for
    each language and bucket, at most ``MOST_LANGUAGES`` times ``buckets`` (more
    languages are an error, as such a column doesn't hold languages)."""
    rows = train.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"))
    languages = rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has over {MOST_LANGUAGES} values")
    names = tuple(r[0] for r in languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = defaultdict(lambda: np.zeros(buckets, np.int64))
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                grams, rows = ngrams(part.column("_text").to_pylist(), buckets=buckets)
                langs = part.column("lang").dictionary_encode()
                mine = langs.indices.to_numpy(zero_copy_only=False)[rows]
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    sums[lang] += np.bincount(grams[mine == k], minlength=buckets)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((buckets, len(names)))
    if len(sums):
        place = {x: k for k, x in enumerate(names)}
        counts[sums["bucket"].to_numpy(), sums["lang"].map(place).to_numpy()] = sums["n"].to_numpy()
    total = counts.sum(0)
    docs = np.array([r[1] for r in languages], float)
    return Model(names, np.log(docs / max(docs.sum(), 1)), np.log((counts + 0.5) / (total + 0.5 * buckets)))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior, 0 to 1), from the text
    alone.  Null texts, texts without a letter, and all texts if nothing was
    learned: ``und`` and 0.  Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        names = pa.array([*model.languages, "und"], pa.string())

        def of(col: pa.Array) -> list[pa.Array]:
            if not model.languages:
                return [pa.array(["und"] * len(col), pa.string()), pa.array([0.0] * len(col))]
            found, scores = [], []
            for part in slices(pa.RecordBatch.from_arrays([col], names=["t"]), "t", SLICE):
                best, score = model.score(*ngrams(part.column(0).to_pylist()), len(part))
                found.append(np.where(best < 0, len(model.languages), best))
                scores.append(score)
            return [names.take(pa.array(np.concatenate([np.zeros(0, np.int64), *found]))), pa.array(np.concatenate([np.zeros(0), *scores]))]
        return of

    return add_columns(docs, text_col, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make)
