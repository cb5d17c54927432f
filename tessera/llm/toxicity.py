"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the embedding of its hash and the sum of the embeddings of
its hashed character n-grams.  The network reads windows of words; every
window of a text, overlapping by half, is scored, and the highest window logit,
calibrated, is the text's score.  Training is numpy on a bounded sample of
labelled rows; scoring runs in Arrow batches on the executors."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.words import add_columns, mix

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 16, 8, 8
ORDERS = (3, 4, 5)
CACHE_WORDS = 60_000
BLOCK = 16_384
#: The training sample: so many rows of each label at most, none above so many bytes.
MOST_TOXIC, MOST_CLEAN, MOST_BYTES = 1500, 3000, 20_000
_EDGE = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def featurise(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word, and the character n-gram buckets of all words
    in a row with each word's number of them.  ASCII case and punctuation at the
    edges of a word don't count; n-grams are of bytes, with marked word ends."""
    bare = [b"\x02" + (w.strip(_EDGE) or w).lower() + b"\x03" for w in words]
    size = np.fromiter(map(len, bare), np.int64, len(bare))
    data = np.frombuffer(b"".join(bare), np.uint8).astype(np.uint64)
    first = np.cumsum(size) - size
    whole = np.add.reduceat(data * mix(np.arange(len(data), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64) + np.uint64(1)), first) if len(data) else np.zeros(0, np.uint64)
    word_of = np.repeat(np.arange(len(bare)), size)
    key, grams, owners = data, [], []
    for n in range(2, max(ORDERS) + 1):
        if len(data) < n:
            break
        key = (key[:len(data) - n + 1] << np.uint64(8)) | data[n - 1:]
        if n in ORDERS:
            inside = word_of[n - 1:] == word_of[:len(data) - n + 1]
            grams.append((mix(key[inside] ^ np.uint64(n << 56)) % np.uint64(CHAR_BUCKETS)).astype(np.int32))
            owners.append(word_of[:len(data) - n + 1][inside])
    grams, owners = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (grams, owners))
    order = np.argsort(owners, kind="stable")
    return (mix(whole) % np.uint64(WORD_BUCKETS)).astype(np.int32), grams[order], np.bincount(owners, minlength=len(bare))


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of ``n`` words: every STRIDE words, the last one ending
    with the text; one short window if there are fewer words than WINDOW."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _sum_by(values: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by key 0 .. n - 1."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.flatnonzero(np.diff(ordered, prepend=-1))
        out[ordered[first]] = np.add.reduceat(values[order], first)
    return out


@dataclass
class Net:
    """Parameters by name; arrays with a leading 2 are forward and backward."""
    p: dict[str, np.ndarray]
    scale: float = 1.0  # calibration of the highest window logit
    shift: float = 0.0

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Net:
        d = WORD_DIM + CHAR_DIM
        def normal(*shape, by):
            return rng.normal(0, by, shape).astype(np.float32)
        return cls({"word": normal(WORD_BUCKETS, WORD_DIM, by=0.05), "char": normal(CHAR_BUCKETS, CHAR_DIM, by=0.05),
                    "wx": normal(2, d, 3 * HIDDEN, by=d ** -0.5), "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32),
                    "u": normal(2, HIDDEN, 3 * HIDDEN, by=HIDDEN ** -0.5),
                    "wa": normal(2 * HIDDEN, ATTENTION, by=0.3), "ba": np.zeros(ATTENTION, np.float32), "va": normal(ATTENTION, by=0.3),
                    "out": normal(2 * HIDDEN, by=0.3), "c": np.zeros(1, np.float32)})

    def inputs(self, words: np.ndarray, grams: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Input vector of each word."""
        chars = np.zeros((len(words), CHAR_DIM), np.float32)
        full = np.flatnonzero(size)
        if len(full):
            chars[full] = np.add.reduceat(self.p["char"][grams], (np.cumsum(size) - size)[full])
        return np.concatenate([self.p["word"][words], chars], 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Both directions' gate inputs of each input vector: [word, 2 * 3 * HIDDEN]."""
        return (x @ self.p["wx"] + self.p["bx"]).transpose(1, 0, 2).reshape(len(x), -1)

    def forward(self, xp: np.ndarray, at: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Logits of windows ``at`` (rows of ``xp``; [window, place]); ``mask`` is 0 at
        places beyond a short window's end.  With ``keep`` also what training needs."""
        b, w = at.shape
        # Time goes first and backward time runs against the places.
        x = xp[at.T].reshape(w, b, 2, 3 * HIDDEN)
        x = np.stack([x[:, :, 0], x[::-1, :, 1]], 1)
        m = None if mask is None else np.stack([mask.T, mask.T[::-1]], 1)[..., None].astype(np.float32)
        h, states, saved = np.zeros((2, b, HIDDEN), np.float32), np.empty((w, 2, b, HIDDEN), np.float32), []
        for t in range(w):
            g = h @ self.p["u"]
            gates = _sigmoid(x[t, ..., :2 * HIDDEN] + g[..., :2 * HIDDEN])
            z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
            n = np.tanh(x[t, ..., 2 * HIDDEN:] + r * g[..., 2 * HIDDEN:])
            after = n + z * (h - n)
            if m is not None:
                after *= m[t]
            if keep:
                saved.append((h, z, r, n, g[..., 2 * HIDDEN:]))
            states[t] = h = after
        both = np.concatenate([states[:, 0], states[::-1, 1]], 2)  # place, window, 2 * HIDDEN
        a = np.tanh(both @ self.p["wa"] + self.p["ba"])
        s = a @ self.p["va"]
        if mask is not None:
            s = np.where(mask.T > 0, s, -1e9)
        e = np.exp(s - s.max(0))
        alpha = e / e.sum(0)
        pooled = np.einsum("wb,wbh->bh", alpha, both)
        logit = pooled @ self.p["out"] + self.p["c"][0]
        return (logit, (m, saved, both, a, alpha, pooled)) if keep else logit

    def gradients(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted logistic loss, and that of the input vectors ``x``."""
        p, h_dim = self.p, HIDDEN
        logit, (m, saved, both, a, alpha, pooled) = self.forward(self.project(x), at, mask, keep=True)
        d = (weight * (_sigmoid(logit) - y)).astype(np.float32)
        g = {"out": pooled.T @ d, "c": d.sum(keepdims=True)}
        d_pool = d[:, None] * p["out"]
        d_alpha = np.einsum("wbh,bh->wb", both, d_pool)
        d_both = alpha[..., None] * d_pool
        ds = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        g["va"] = np.einsum("wba,wb->a", a, ds)
        da = ds[..., None] * p["va"] * (1 - a * a)
        g["wa"] = np.einsum("wbh,wba->ha", both, da)
        g["ba"] = da.sum((0, 1))
        d_both = d_both + da @ p["wa"].T
        w = len(both)
        d_states = np.stack([d_both[..., :h_dim], d_both[::-1, :, h_dim:]], 1)
        dx = np.empty((w, 2, at.shape[0], 3 * h_dim), np.float32)
        g["u"] = np.zeros_like(p["u"])
        carry = np.zeros_like(saved[0][0])
        for t in range(w - 1, -1, -1):
            h, z, r, n, gn = saved[t]
            dh = (d_states[t] + carry) * m[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            dg = np.concatenate([dz, dr, dn * r], 2)
            g["u"] += h.transpose(0, 2, 1) @ dg
            carry = dh * z + dg @ p["u"].transpose(0, 2, 1)
            dx[t] = np.concatenate([dz, dr, dn], 2)
        places = np.stack([dx[:, 0], dx[::-1, 1]], 2).reshape(-1, 6 * h_dim)
        by_word = _sum_by(places, at.T.ravel(), len(x)).reshape(-1, 2, 3 * h_dim).transpose(1, 0, 2)
        g["wx"] = x.T @ by_word
        g["bx"] = by_word.sum(1, keepdims=True)
        return g, (by_word @ p["wx"].transpose(0, 2, 1)).sum(0)


@dataclass
class Sample:
    """Windows of the training texts over their distinct words (word 0 is none)."""
    texts: list[bytes]
    label: np.ndarray
    at: np.ndarray = field(init=False)  # window, place
    mask: np.ndarray = field(init=False)
    text_of: np.ndarray = field(init=False)

    def __post_init__(self):
        known: dict[bytes, int] = {b"": 0}
        at, mask, text_of = [], [], []
        place = np.arange(WINDOW)
        for k, text in enumerate(self.texts):
            ids = np.array([known.setdefault(w, len(known)) for w in text.split()], np.int32)
            start = window_starts(len(ids))
            spread = start[:, None] + place
            inside = spread < len(ids)
            at.append(np.where(inside, ids[np.minimum(spread, len(ids) - 1)], 0).astype(np.int32) if len(ids) else np.zeros((0, WINDOW), np.int32))
            mask.append(inside)
            text_of.append(np.full(len(start), k))
        self.at, self.mask, self.text_of = (np.concatenate(x) if x else np.zeros(shape, kind) for x, shape, kind in (
            (at, (0, WINDOW), np.int32), (mask, (0, WINDOW), bool), (text_of, 0, np.int64)))
        words = list(known)
        del known
        parts = [featurise(words[k:k + BLOCK]) for k in range(0, len(words), BLOCK)]
        self.word, self.grams, self.size = (np.concatenate(x) for x in zip(*parts))
        self.gram_start = np.cumsum(self.size) - self.size

    def take(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of some of the words."""
        size = self.size[words]
        first = np.cumsum(size) - size
        return self.word[words], self.grams[np.arange(size.sum()) + np.repeat(self.gram_start[words] - first, size)], size

    def suspicion(self) -> np.ndarray:
        """How much more often the most telling n-gram of each window is in toxic
        texts than in clean ones (log odds over texts): where learning starts."""
        inside, outside = np.zeros(CHAR_BUCKETS, np.int64), np.zeros(CHAR_BUCKETS, np.int64)
        ends = np.searchsorted(self.text_of, np.arange(len(self.texts)), "right")
        for text, (a, b) in enumerate(zip([0, *ends], ends)):
            grams = np.unique(self.take(np.unique(self.at[a:b]))[1])
            (inside if self.label[text] == 1 else outside)[grams] += 1
        n1, n0 = max(1, (self.label == 1).sum()), max(1, (self.label == 0).sum())
        # Shrunk towards none, so that rare n-grams of one text don't lead.
        odds = np.log((inside / n1 + 3 / (n1 + n0)) / (outside / n0 + 3 / (n1 + n0)))
        best = np.zeros(len(self.word), np.float32)
        full = np.flatnonzero(self.size)
        best[full] = np.maximum.reduceat(odds.astype(np.float32)[self.grams], self.gram_start[full])
        return np.where(self.mask, best[self.at], np.float32(-np.inf)).max(1)


def _train(sample: Sample, seed: int = 7, rounds: int = 3, steps: int = 70, batch: int = 256) -> Net:
    """Rounds of Adam; between them the windows that carry a toxic text's label
    and the clean windows that look worst are chosen anew by the network."""
    rng = np.random.default_rng(seed)
    net = Net.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    toxic = sample.label[sample.text_of] == 1
    score = sample.suspicion()
    step = 0
    for turn in range(rounds):
        limit = np.quantile(score[~toxic], 0.999) if turn == 0 else 0.0
        top = np.full(len(sample.texts), -np.inf)
        np.maximum.at(top, sample.text_of, score)
        positive = np.flatnonzero(toxic & ((score > limit) | (score >= top[sample.text_of])))
        negative = np.flatnonzero(~toxic)
        hard = negative[np.argsort(-score[negative], kind="stable")[:max(64, len(positive) // 2)]]
        for k in range(steps):
            step += 1
            half = batch // 2
            pick = np.concatenate([rng.choice(positive, half), rng.choice(negative, batch - half - half // 2), rng.choice(hard, half // 2)])
            words, at = np.unique(sample.at[pick], return_inverse=True)
            features = sample.take(words)
            grads, dx = net.gradients(net.inputs(*features), at.reshape(len(pick), WINDOW), sample.mask[pick],
                                      toxic[pick].astype(np.float32), np.full(len(pick), 1 / len(pick), np.float32))
            rate = 0.01 * (1 - 0.9 * (turn * steps + k) / (rounds * steps))
            rows = {"word": (features[0], dx[:, :WORD_DIM]), "char": (features[1], np.repeat(dx[:, WORD_DIM:], features[2], 0))}
            for name, value in net.p.items():
                if name in rows:  # only the embeddings of the batch move
                    keys, inverse = np.unique(rows[name][0], return_inverse=True)
                    grad, at_rows = _sum_by(rows[name][1], inverse, len(keys)), keys
                else:
                    grad, at_rows = grads[name], ...
                first[name][at_rows] = m1 = 0.9 * first[name][at_rows] + 0.1 * grad
                second[name][at_rows] = m2 = 0.99 * second[name][at_rows] + 0.01 * grad * grad
                value[at_rows] -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-6)
        score = _window_logits(net, sample)
    return net


def _window_logits(net: Net, sample: Sample) -> np.ndarray:
    out = np.empty(len(sample.at), np.float32)
    for a in range(0, len(sample.at), 2048):
        part = slice(a, a + 2048)
        words, at = np.unique(sample.at[part], return_inverse=True)
        out[part] = net.forward(net.project(net.inputs(*sample.take(words))), at.reshape(-1, WINDOW), sample.mask[part])
    return out


def _calibrate(net: Net, sample: Sample, toxic_share: float) -> None:
    """Logistic regression of the labels on the highest window logit, by Newton
    steps, weighted to the labels' true shares."""
    top = np.full(len(sample.texts), -np.inf)
    np.maximum.at(top, sample.text_of, _window_logits(net, sample))
    use = np.isfinite(top)
    x, y = np.stack([top[use], np.ones(use.sum())], 1), (sample.label[use] == 1).astype(float)
    weight = np.where(y == 1, toxic_share / max(1, y.sum()), (1 - toxic_share) / max(1, len(y) - y.sum()))
    coef = np.array([1.0, 0.0])
    for _ in range(50):
        q = _sigmoid(x @ coef)
        grad = x.T @ (weight * (q - y)) + 1e-4 * (coef - [1.0, 0.0])
        hess = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        coef -= move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-8:
            break
    net.scale, net.shift = max(float(coef[0]), 1e-3), float(coef[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, most_bytes: int = MOST_BYTES) -> Net | None:
    """Trains on a bounded sample of the rows of ``docs`` that ``labels`` marks 1 or 0:
    at most ``most_toxic`` and ``most_clean`` texts with words and of at most
    ``most_bytes`` bytes, those of the smallest id hashes.  None if either label is missing."""
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    texts = docs.where((F.octet_length(text_col) > 0) & (F.octet_length(text_col) <= most_bytes)).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counts = dict(marked.groupBy("_label").count().collect())
    if not counts.get(1) or not counts.get(0):
        return None
    # Twice the wanted ids, as some have no text in docs or a long one.
    order = (F.xxhash64("_id"), F.col("_id"))
    wanted = [marked.where(F.col("_label") == y).orderBy(*order).limit(2 * n) for y, n in ((1, most_toxic), (0, most_clean))]
    found = texts.join(F.broadcast(wanted[0].unionByName(wanted[1])), "_id")  # at most 2 * (most_toxic + most_clean) ids
    rows = [r for y, n in ((1, most_toxic), (0, most_clean))
            for r in found.where(F.col("_label") == y).orderBy(*order, F.xxhash64("_text")).limit(n).select("_text", "_label").collect()]
    sample = Sample([r[0].encode() for r in rows], np.array([r[1] for r in rows], np.int64))
    present = set(sample.label[sample.text_of].tolist())
    if present != {0, 1}:
        return None
    net = _train(sample)
    _calibrate(net, sample, counts[1] / (counts[1] + counts[0]))
    return net


class Scorer:
    """Scores texts; keeps the gate inputs of the words that it has seen."""

    def __init__(self, net: Net):
        self.net, self.known = net, {}
        self.xp = np.zeros((0, 6 * HIDDEN), np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        split = [t.split() for t in texts]
        flat = list(chain.from_iterable(split))
        out = np.zeros(len(texts))
        if not flat:
            return out
        if len(self.known) > CACHE_WORDS:
            self.known, self.xp = {}, self.xp[:0]
        fresh = [w for w in dict.fromkeys(flat) if w not in self.known]
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.xp = np.concatenate([self.xp, *(self.net.project(self.net.inputs(*featurise(fresh[k:k + BLOCK]))) for k in range(0, len(fresh), BLOCK))])
        ids = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        size = np.fromiter(map(len, split), np.int64, len(split))
        first = np.cumsum(size) - size
        top = np.full(len(texts), -np.inf, np.float32)
        long = np.flatnonzero(size > WINDOW)
        if len(long):
            starts = [window_starts(n) for n in size[long]]
            text = np.repeat(long, [len(s) for s in starts])
            at = np.concatenate(starts) + first[text]
            for a in range(0, len(at), 1024):
                part = slice(a, a + 1024)
                np.maximum.at(top, text[part], self.net.forward(self.xp, ids[at[part, None] + np.arange(WINDOW)], None))
        short = np.flatnonzero((size > 0) & (size <= WINDOW))
        for a in range(0, len(short), 1024):
            part = short[a:a + 1024]
            place = np.arange(size[part].max())
            mask = (place < size[part, None]).astype(np.float32)
            top[part] = self.net.forward(self.xp, ids[np.minimum(first[part, None] + place, len(ids) - 1)], mask)
        some = size > 0
        out[some] = 1 / (1 + np.exp(-np.clip(self.net.scale * top[some].astype(float) + self.net.shift, -700, 700)))
        return out


def score(docs: DataFrame, net: Net | None, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col`` (0 to 1, higher: likelier toxic), from the whole text
    alone.  Null, empty and wordless texts, and all texts without a network, get
    0.  A column of that name is replaced; all rows and other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = Scorer(shared.value) if shared.value is not None else None

        def of(col: pa.Array) -> list[pa.Array]:
            texts = [x or b"" for x in col.cast(pa.binary()).to_pylist()]
            return [pa.array(scorer.score(texts) if scorer else np.zeros(len(texts)))]
        return of

    return add_columns(docs, text_col, [T.StructField(out_col, T.DoubleType())], make)
