"""Byte-pair encoding and decoding in batched numpy merge rounds.

Reads a ``tokenizers`` JSON file of the kind *NFC, white space folded, lower
case; split by a pattern; byte level; BPE with word ends*.  The symbols of all
new words of a batch lie in one flat array; each round looks every adjacent
pair up by binary search among the sorted pair keys and merges, in every word
at once, the pair of lowest rank."""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.words import add_columns

CACHE_WORDS = 100_000


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte at byte level: printable
    ones stand for themselves, the others for U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def vocabulary(source: str) -> np.ndarray:
    """Token of each id (None: no such id)."""
    spec = json.loads(source)
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = np.full(max(ids.values(), default=-1) + 1, None, object)
    tokens[list(ids.values())] = list(ids)
    return tokens


def decode_ids(tokens: np.ndarray, ids: np.ndarray) -> str:
    """Tokens joined by spaces, as without a decoder; ids without a token are left out."""
    return " ".join(t for t in tokens[ids[ids < len(tokens)]].tolist() if t is not None)


class Bpe:
    """The tokenizer in ``source`` (the JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, steps = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        kinds = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if (steps, kinds, model["type"]) != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE") or spec["decoder"] or any(
                t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("not a tokenizer of the kind that this module reads")
        end, vocab = model["end_of_word_suffix"] or "", model["vocab"]
        # White_Space, as in the library's pattern engine; \s here has four more characters.
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.final = np.array([vocab[c + end] for c in names], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {a + b: r for r, (a, b) in enumerate(pairs)}
        if len(made) != len(pairs) or any(made.get(x, -1) >= r for r, p in enumerate(pairs) for x in p):
            raise ValueError("merges aren't in the order in which they make their parts")
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known = {w: k for k, w in enumerate(self.special)}
        self.ids = np.array(list(self.special.values()), np.int64)
        self.size = np.ones(len(self.special), np.int64)

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens in it come out whole."""
        if self.special_pattern and self.special_pattern.search(text):
            return [p for k, part in enumerate(self.special_pattern.split(text)) for p in ([part] if k % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        # lower() makes a word-final sigma of its own; the library lowers each character alone.
        return self.pattern.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each word."""
        raw = [w.encode() for w in words]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[data]
        last = np.flatnonzero(np.diff(word, append=-1))
        sym[last] = self.final[data[last]]
        done_word, done_sym = [], []
        none = len(self.keys)
        while len(sym):
            key = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            rank = np.full(len(sym), none)
            rank[:-1] = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.rank[at], none)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(word)))
            over = lowest == none
            if over.any():
                done_word.append(word[over])
                done_sym.append(sym[over])
                sym, word, rank, lowest = sym[~over], word[~over], rank[~over], lowest[~over]
                if not len(sym):
                    break
            hit = rank == lowest
            # Of hits that share a symbol (aaa), every other one counts, from the left.
            place = np.arange(len(hit))
            hit &= (place - np.maximum.accumulate(np.where(hit, -1, place))) % 2 == 1
            keep = np.ones(len(sym), bool)
            keep[1:] = ~hit[:-1]
            sym = np.where(hit, self.result[np.minimum(lowest, none - 1)], sym)[keep]
            word = word[keep]
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and the offsets of each text's ids."""
        parts = [self.pieces(t) for t in texts]
        flat = list(chain.from_iterable(parts))
        if len(self.known) > CACHE_WORDS:
            self._forget()
        fresh = [w for w in dict.fromkeys(flat) if w not in self.known]
        if fresh:
            ids, size = self.merge(fresh)
            self.known.update(zip(fresh, range(len(self.size), len(self.size) + len(fresh))))
            self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
        start = np.cumsum(self.size) - self.size
        index = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        n = self.size[index]
        first = np.cumsum(n) - n
        out = self.ids[np.arange(n.sum()) + np.repeat(start[index] - first, n)].astype("<u4")
        words_upto = np.cumsum([0, *map(len, parts)])
        return out, np.concatenate([[0], np.cumsum(n)])[words_upto]


_LOADED: dict[tuple, object] = {}


def _load(kind, shared):
    """``kind`` of the broadcast file, made once in a Python worker, also over several tasks."""
    key = (kind.__name__, hash(shared.value))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = kind(shared.value)
    return _LOADED[key]


def _share(df: DataFrame, path: str):
    """The tokenizer file (a few MB, fixed by its vocabulary), read on the driver."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``: the text's ids as little-endian unsigned 32-bit
    integers (binary).  Null texts count as empty and have no ids.  A column
    of that name is replaced; all other columns and all rows stay."""
    shared = _share(df, path)

    def make():
        bpe = _load(Bpe, shared)

        def of(col: pa.Array) -> list[pa.Array]:
            ids, off = bpe.encode([t or "" for t in col.to_pylist()])
            return [pa.array([ids[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], pa.binary())]
        return of

    return add_columns(df, text_col, [T.StructField(ids_col, T.BinaryType())], make)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the text of the ids in ``ids_col`` (binary as made by
    :func:`encode`; null: empty text)."""
    shared = _share(df, path)

    def make():
        tokens = _load(vocabulary, shared)
        return lambda col: [pa.array([decode_ids(tokens, np.frombuffer(x or b"", "<u4")) for x in col.to_pylist()], pa.string())]

    return add_columns(df, ids_col, [T.StructField(out_col, T.StringType())], make)
