import random
import re
from collections import Counter, defaultdict

import numpy as np

from tessera.llm import divergence as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    for lang, source, text in rows:
        found = [t.translate(LOW) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        shares = {g[1]: share(counts[g]) for g in groups if g[0] == lang}
        all_of = share(whole)
        for s, p in shares.items():
            pair = [(o, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)) for o, q in shares.items() if o != s]
            term = [(t, (p[t] - all_of[t]) ** 2 // all_of[t]) for t in kept if counts[lang, s][t] and p[t] > all_of[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


def rows_of(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, posting long")
    return sorted(tuple(r) for r in D.source_divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def test_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)] + ["Über", "DÉJÀ", "日本", "\U0001F600"]
    rows = []
    for k in range(240):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", "s4"])
        low = {"s1": 0, "s2": 10, "s3": 30, "s4": 50}[source]
        rows.append((rng.choice(["en", "de"]), source, " ".join(rng.choice(words[low:]) + rng.choice(["", ",", "9", "-"]) for _ in range(rng.randrange(1, 40)))))
    rows += [rows[0]] * 5 + [("en", "silent", None), ("en", "silent", "1 2 3 ..."), ("fr", "a", "only here"), ("fr", None, ""), (None, None, "null null"), (None, "x", "NULL null"),
             (None, "x", "null"), ("", "y", "Null"), ("en", "é", "alone " * 30_000)]
    assert rows_of(spark, rows) == brute(rows)
    assert rows_of(spark, rows, top_terms=2) == brute(rows, 2)


def test_empty_table(spark):
    assert D.source_divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_tasks_pass_sums_on_when_they_hold_many(spark):
    df = spark.createDataFrame([("en", "s", " ".join(f"t{chr(97 + k % 26)}{chr(97 + j)}" for j in range(20))) for k in range(100)], "lang string, source string, text string")
    few, many = (sorted(map(str, D.term_counts(df.coalesce(1), held=h).collect())) for h in (7, 300_000))
    assert few == many and len(many) == 26 * 20 + 1


def test_long_texts_are_read_by_pieces(monkeypatch):
    text = " ".join(f"word{'abcdefghij'[k % 10]} Éa" for k in range(5000)).encode()
    whole = D.terms_of(text)
    monkeypatch.setattr(D, "_PIECE", 37)
    assert D.terms_of(text) == whole and whole["Éa".encode()] == 5000


def test_scatter_adds_shared_terms_only():
    offsets = np.array([0, 2, 3, 6])
    source, p, zero = np.array([0, 2, 1, 0, 1, 2]), np.array([50, 40, 9, 70, 60, 10]), np.array([3, 5, 4, 3, 4, 5])
    got = {(s, int(h)): int(v) for s, met, value in D.scatter(offsets, source, p, zero) for h, v in zip(met, value)}
    want = defaultdict(int)
    for a, b in ((0, 2), (2, 3), (3, 6)):
        for i in range(a, b):
            for j in range(a, b):
                f = lambda x, y: (x - y) ** 2 // y
                x, y, zx, zy = (int(v) for v in (p[i], p[j], zero[i], zero[j]))
                want[int(source[i]), int(source[j])] += f(x, y) - f(x, zy) - f(zx, y) + f(zx, zy)
    assert got == dict(want)
