"""Quality rules as weak supervision.

Text statistics are measured in Arrow batches; rules vote good, bad or
abstain on them; expectation-maximisation over the counts of vote patterns
estimates from the rules' agreement how often each votes bad on bad and on good
documents, and a document's posterior probability of being good decides
instead of all-must-pass: a rule that often stands alone counts for little."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.words import Words, mix, slices, span_hash

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim", "n_upper", "n_stops",
         "n_distinct", "n_symbol_words", "n_upper_words")


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _EXCLAIM, _UPPER, _STOP = _flags(b"#*$%&|<>"), _flags(b"!"), _flags(bytes(range(65, 91))), _flags(b".!?")
_LOWER = _flags(bytes(range(97, 123)))
_NEWLINE = 10


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once; is it not the first such."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    often, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    often[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return often, later


def _with_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return mix(keys ^ mix(rows.astype(np.uint64) + np.uint64(1)))


def measure(col: pa.Array) -> list[np.ndarray]:
    """:data:`STATS` of every text of a column."""
    w = Words(col)
    n = len(col)
    data, off = w.data, w.text_offsets
    n_words = np.diff(w.offsets)
    head = (data & 0xC0) != 0x80  # first bytes of characters
    # Lines: split at \n inside each text; a line counts if it holds a word.
    cut = np.flatnonzero(data == _NEWLINE)
    starts = np.union1d(off[:-1], cut + 1)
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = np.where((ends > starts) & (data[np.maximum(ends - 1, 0)] == _NEWLINE), ends - 1, ends) if len(starts) else ends
    holds = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[holds], ends[holds]
    line_off = np.searchsorted(starts, off)
    line_rows = np.repeat(np.arange(n), np.diff(line_off))
    _, dup = _repeats(_with_row(span_hash(data, starts, ends), line_rows))
    # Three-word windows that occur twice or more in their text.
    h, rows = w.hashes(), w.rows()
    covered = np.zeros(len(h), bool)
    if len(h) >= 3:
        three = mix(mix(h[:-2]) + h[1:-1]) + h[2:]
        inside = rows[2:] == rows[:-2]
        at = np.flatnonzero(inside)
        often, _ = _repeats(_with_row(three[at], rows[at]))
        hit = at[often]
        for k in range(3):
            covered[hit + k] = True
    stops = _STOP[data[w.ends - 1]] if len(w) else np.zeros(0, bool)
    _, again = _repeats(_with_row(h, rows))

    def held(chars):  # how many of the characters each word holds
        total = np.concatenate([[0], np.cumsum(chars[data], dtype=np.int64)])
        return total[w.ends] - total[w.starts]
    shouted = (held(_UPPER) >= 2) & (held(_LOWER) == 0)
    return [n_words, w.per_row(head & w.inside), w.per_row(_SYMBOL[data]), w.per_row(dup, line_off),
            w.per_row(covered, w.offsets), np.diff(line_off), w.per_row(_EXCLAIM[data]), w.per_row(_UPPER[data]),
            w.per_row(stops, w.offsets), w.per_row(~again, w.offsets), w.per_row(held(_SYMBOL) > 0, w.offsets), w.per_row(shouted, w.offsets)]


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and :data:`STATS` (long), one row per input row; null and empty
    texts have zeros.  Other columns are not read."""
    kept = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                stats = [pa.array(x.astype(np.int64)) for x in measure(part.column("_text"))]
                yield pa.RecordBatch.from_arrays([part.column(id_col), *stats], names=[id_col, *STATS])

    return kept.mapInArrow(run, T.StructType([kept.schema[id_col], *[T.StructField(s, T.LongType()) for s in STATS]]))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``applies`` does, else abstains; it knows one ``kind`` of junk."""
    name: str
    kind: str
    bad: str
    applies: str = "n_words > 0"

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN NOT ({self.applies}) THEN 2 WHEN {self.bad} THEN 0 ELSE 1 END")


#: Every kind of junk is looked for by two rules or more, each by a statistic of its own,
#: so that a rule's accuracy shows in its agreement with others.
RULES = (
    Rule("symbols", "symbols", "n_symbols > 0.1 * n_words"),
    Rule("symbol_words", "symbols", "n_symbol_words > 0.2 * n_words"),
    Rule("symbol_chars", "symbols", "n_symbols > 0.05 * word_chars"),
    Rule("shouting", "shouting", "n_exclaim > 0.2 * n_words"),
    Rule("exclaimed", "shouting", "n_exclaim > 0.5 * n_stops", "n_stops >= 5"),
    Rule("capitals", "shouting", "n_upper > 0.4 * word_chars"),
    Rule("capital_words", "shouting", "n_upper_words > 0.5 * n_words"),
    Rule("lines", "repeats", "n_dup_lines > 0.3 * n_lines", "n_lines >= 4"),
    Rule("windows", "repeats", "n_repeat_words > 0.3 * n_words", "n_words >= 20"),
    Rule("distinct", "repeats", "n_distinct < 0.3 * n_words", "n_words >= 50"),
    Rule("word_length", "form", "word_chars NOT BETWEEN 3.5 * n_words AND 9 * n_words"),
    Rule("sentences", "form", "n_stops * 30 < n_words", "n_words >= 30"),
)


@dataclass(frozen=True)
class Model:
    """``shares`` of good documents and of each kind of bad ones; by rule its kind's place among ``shares``, and the
    probability of a bad vote on documents of that kind (``hit``) and on all others (``slip``),
    where the rule doesn't abstain."""
    shares: np.ndarray
    kinds: np.ndarray
    hit: np.ndarray
    slip: np.ndarray

    def odds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of each kind to good: without a vote, and what a bad and a good vote of a rule add to its kind's."""
        return np.log(self.shares[1:] / self.shares[0]), np.log(self.hit / self.slip), np.log((1 - self.hit) / (1 - self.slip))

    def classes(self, patterns: np.ndarray) -> np.ndarray:
        """Posterior of good and of each kind, by vote pattern."""
        start, bad, good = self.odds()
        mine = np.eye(len(self.shares))[self.kinds][:, 1:]  # rule, kind
        odds = start + ((patterns == 0) * bad) @ mine + ((patterns == 1) * good) @ mine
        like = np.exp(np.column_stack([np.zeros(len(patterns)), odds]))
        return like / like.sum(1, keepdims=True)

    def good(self, patterns: np.ndarray) -> np.ndarray:
        return self.classes(patterns)[:, 0]

    def accuracy(self) -> np.ndarray:
        """P(the document is bad | the rule votes bad), by rule."""
        own, bad = self.shares[self.kinds], 1 - self.shares[0]
        right = own * self.hit + (bad - own) * self.slip
        return right / (right + self.shares[0] * self.slip)


def fit(patterns: np.ndarray, counts: np.ndarray, kinds: list[str] | None = None, rounds: int = 500, tolerance: float = 1e-9) -> Model:
    """EM on distinct vote patterns (rows; 0 bad, 1 good, 2 abstain) with their ``counts``.  ``kinds`` names the kind
    of junk that each rule knows (default: all the same).  A document is good or of one kind; rules of other
    kinds treat it as they treat good ones, so a small kind isn't drowned by a large one.

    It starts from agreement: two bad votes of a kind or more are probably right, a lone one
    is probably not.  The prior is fixed and small whatever the number of
    documents: half a document a class, two for each rule on its kind and, on others,
    one bad vote in twenty.  So what a rule's votes are worth comes from the data.  One thing is set: a
    rule sees half of its kind at least, else a kind without votes could take the place of the good ones."""
    n_rules = patterns.shape[1]
    names = list(dict.fromkeys(kinds or ["bad"]))
    kind = np.array([names.index(k) + 1 for k in kinds or ["bad"] * n_rules], int)
    bad, voted = (patterns == 0).astype(float), (patterns != 2).astype(float)
    many = np.column_stack([bad[:, kind == c + 1].sum(1) for c in range(len(names))]) if len(patterns) else np.zeros((0, len(names)))
    first = np.column_stack([np.ones(len(patterns)), np.select([many >= 2, many == 1], [9, 0.25], 0.01)])
    belongs = first / first.sum(1, keepdims=True)
    model = None
    for _ in range(rounds):
        weight = belongs * counts[:, None]
        own = weight[:, kind]  # pattern, rule
        rest = weight.sum(1, keepdims=True) - own
        shares = weight.sum(0) + 0.5
        hit = np.maximum(((own * bad).sum(0) + 1) / ((own * voted).sum(0) + 2), 0.5)
        model = Model(shares / shares.sum(), kind, hit, ((rest * bad).sum(0) + 1) / ((rest * voted).sum(0) + 20))
        new = model.classes(patterns)
        if not len(new) or np.abs(new - belongs).max() < tolerance:
            break
        belongs = new
    return model


def judge(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``stats`` with ``quality``, the posterior probability of being good.

    The vote patterns that reach the driver are at most 3 ** len(rules), and in practice
    some hundreds; their counts come from all rows, by partial aggregation."""
    votes = [r.vote() for r in rules]
    rows = stats.select(*[v.alias(f"v{k}") for k, v in enumerate(votes)]).groupBy(*[f"v{k}" for k in range(len(rules))]).count().collect()
    model = fit(np.array([r[:-1] for r in rows], int).reshape(-1, len(rules)), np.array([r[-1] for r in rows], float), [r.kind for r in rules])
    start, bad, good = model.odds()
    against = F.lit(0.0)  # odds of all kinds of bad to good
    for c, odds in enumerate(start):
        odds = F.lit(float(odds))
        for k in np.flatnonzero(model.kinds == c + 1):
            odds = odds + F.when(votes[k] == 0, F.lit(float(bad[k]))).when(votes[k] == 1, F.lit(float(good[k]))).otherwise(F.lit(0.0))
        against = against + F.exp(odds)
    return stats.withColumn("quality", 1 / (1 + against))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``id_col``, :data:`STATS`, ``base_failed`` (under 50 words, or over half of the
    words in repeated 3-word windows), ``quality`` and ``kept`` (not
    base_failed and ``quality >= least``), one row per input row.  Texts are read
    twice, for the patterns and for the verdicts.

    Null and empty texts have zeros, no votes and fail the base rules; a null id stays null; repeated rows
    are judged alike, and rows of one vote pattern have one posterior; a posterior of just ``least`` is kept.
    Other columns are not read.  An empty table gives an empty result."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (judge(text_stats(docs, id_col, text_col)).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)))
