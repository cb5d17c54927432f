import hashlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import substring as S


def brute(rows, window):
    docs = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[k:k + window]) for w in docs for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, docs):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = True
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_index_counts_and_intervals_equal_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(40):
        parts = [rng.integers(0, 3, rng.integers(1, 40)) for _ in range(15)]
        parts[3] = parts[2][1:].copy() if len(parts[2]) > 1 else parts[3]
        symbols = np.concatenate(parts)
        ends = np.cumsum([len(x) for x in parts])
        starts = ends - [len(x) for x in parts]
        index = S.FmIndex(symbols, ends, 3)
        for n in (1, 2, 5):
            pattern = rng.integers(0, 3, n)
            lo, hi = np.zeros(1, np.int64), np.full(1, index.n)
            for c in pattern[::-1]:
                lo, hi = index.extend(np.array([c]), lo, hi)
            want = sum(tuple(x[k:k + n]) == tuple(pattern) for x in parts for k in range(len(x) - n + 1))
            assert hi[0] - lo[0] == want
        window = 4 + trial % 4
        count = Counter(tuple(x[k:k + window]) for x in parts for k in range(len(x) - window + 1))
        got = [np.zeros(len(x), bool) for x in parts]
        for q, a, b in zip(*index.repeats(symbols, starts, ends, window)):
            got[q][a:b] = True
        for x, g in zip(parts, got):
            want = np.zeros(len(x), bool)
            for k in range(len(x) - window + 1):
                if count[tuple(x[k:k + window])] > 1:
                    want[k:k + window] = True
            assert (want == g).all()


def test_equal_windows_share_a_minimizer_and_not_a_segment():
    rng = np.random.default_rng(1)
    h = S.mix(rng.integers(0, 4, 3000).astype(np.uint64))
    offsets = np.array([0, 0, 700, 734, 768, 3000])
    row, start, n, m, s = S.segments(h, offsets, 12)
    seen = {}
    for k in range(len(row)):
        assert 1 <= n[k] <= 12 - S.GRAM + 1
        for j in range(start[k], start[k] + n[k]):
            a = offsets[row[k]] + j
            seen.setdefault(h[a:a + 12].tobytes(), []).append((m[k], k))
    assert sum(map(len, seen.values())) == sum(max(0, int(x) - 11) for x in np.diff(offsets))
    for x in seen.values():
        assert len({a for a, _ in x}) == 1 and len({b for _, b in x}) == len(x)


@pytest.mark.parametrize("hot", [20_000, 0])
def test_documents_equal_brute_force(spark, hot):
    rng = np.random.default_rng(3)
    def words(n):
        return [f"w{k}" for k in rng.integers(0, 400, n)]
    passage, other = words(60), words(36)
    rows = [(k, " ".join(words(rng.integers(0, 60)) + passage + words(rng.integers(0, 60)))) for k in range(60)]
    rows += [(100, " ".join(other)), (101, "\n".join(words(5) + other + words(9))), (102, " ".join(other[:34])), (103, None), (104, ""), (105, "a " * 300), (106, "b c d " * 90),
             (107, " ".join(other + ["x"] + other)), (108, " ".join(words(3000))), (None, rows[0][1]), (0, rows[0][1]), (109, " ".join(words(40)).upper())]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, _a string, _n int")
    got = S.remove_repeats(df, window=35, hot_segments=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 35)


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force(spark):
    from tessera.llm.queries import op9_substring_dedup
    from tests.conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op9_substring_dedup(spark, SF_SMALL).collect()), key=str) == brute(rows, 35)
