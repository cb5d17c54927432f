"""The native splitter equals a plain-Python reading of the same contract,
and its output has the promised properties."""

import re

import pytest

from tessera import errors as E
from tessera.operators.split import LEVELS, STRATEGIES, split_documents, split_window
from tests.conftest import SF_SMALL

FL = re.ASCII


def _jtrim(t):
    return re.sub(r"^\s+|\s+$", "", t, flags=FL)


def py_split(text, strategy, mx, ov):
    pieces = [(text, "")]
    for level in STRATEGIES[strategy]:
        rx, joiner = LEVELS[level]
        out = []
        for t, j in pieces:
            if len(t) <= mx:
                out.append((t, j))
            else:
                for i, s in enumerate(re.split(rx, _jtrim(t), flags=FL)):
                    out.append((s, j if i == 0 else joiner))
        pieces = out
    out = []
    for t, j in pieces:
        if len(t) <= mx:
            out.append((t, j))
        else:
            for i in range(0, (len(t) - 1) // mx + 1):
                out.append((t[i * mx:(i + 1) * mx], j if i == 0 else ""))
    pieces = [(_jtrim(t), j) for t, j in out]
    pieces = [(t, j) for t, j in pieces if len(t) > 0]
    segs, cur = [], None
    for t, j in pieces:
        if cur is not None and cur[1] + len(j) + len(t) <= mx:
            cur = (cur[0] + [(t, j)], cur[1] + len(j) + len(t))
        else:
            if cur is not None:
                segs.append(cur[0])
            cur = ([(t, j)], len(t))
    if cur is not None:
        segs.append(cur[0])
    plain = ["".join(t if k == 0 else j + t for k, (t, j) in enumerate(s)) for s in segs]
    if ov <= 0:
        return plain
    res = []
    for i, cur in enumerate(plain):
        if i == 0:
            res.append(cur)
            continue
        sents = list(reversed(re.split(LEVELS["sentence"][0], plain[i - 1], flags=FL)))
        limit = min(ov, mx - 1 - len(cur))
        tot, c = 0, 0
        for s in sents:
            tot = tot + len(s) + (1 if tot > 0 else 0)
            if tot <= limit:
                c += 1
            else:
                break
        res.append(" ".join(reversed(sents[:c])) + " " + cur if c > 0 else cur)
    return res


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("strategy", sorted(STRATEGIES))
@pytest.mark.parametrize("mx,ov", [(1000, 200), (300, 0), (120, 60)])
def test_split_equals_reference(spark, docs, strategy, mx, ov):
    got = {}
    for r in split_documents(docs, strategy, mx, ov).collect():
        got.setdefault(r.doc_id, []).append((r["index"], r.text))
    for d in docs.collect():
        want = py_split(d.text, strategy, mx, ov)
        have = [t for _, t in sorted(got.get(d.doc_id, []))]
        assert have == want, (d.doc_id, strategy)


def test_split_properties(spark, docs):
    rows = split_documents(docs, "Recursive", 400, 0).collect()
    by_doc = {}
    for r in rows:
        assert r.error_code is None
        assert len(r.text) <= 400
        by_doc.setdefault(r.doc_id, []).append(r)
    texts = {d.doc_id: d.text for d in docs.collect()}
    for doc_id, segs in by_doc.items():
        idx = sorted(s["index"] for s in segs)
        assert idx == list(range(len(idx)))
        # without overlap every word survives, in order
        words = " ".join(s.text for s in sorted(segs, key=lambda s: s["index"])).split()
        assert "".join(words) == "".join(texts[doc_id].split())


def test_split_blank_and_errors(spark):
    df = spark.createDataFrame([(1, "   \n  "), (2, "One. Two."), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in split_documents(df, "BySentence", 5, 0).collect() if r.doc_id != 2}
    assert rows[1].error_code == E.FAILED_TO_SPLIT and rows[3].error_code == E.FAILED_TO_SPLIT
    with pytest.raises(E.TesseraError):
        split_documents(df, "bysentence")
    with pytest.raises(E.TesseraError):
        split_documents(df, "Recursive", 100, 100)


def test_split_window(spark):
    df = spark.createDataFrame([(1, "abcdefghij")], "doc_id long, text string")
    got = [r.text for r in split_window(df, 4, 1).orderBy("index").collect()]
    assert got == ["abcd", "defg", "ghij"]


def test_split_plan_has_no_python(spark, docs):
    plan = split_documents(docs, "Recursive")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


ODD = ["  \n\n ", "One.  " * 400, ("Short one. " + " " * 300 + "Next! ") * 60, "x" * 2500 + ". " + "y" * 10 + "\n \n" + "z " * 900,
       "A b.\x0b\f\r\n\t\n" * 300 + "\u2028", ("Wort für Wort? " * 9 + "\u2028\n\n  \u2028") * 40, "\u0085 a. \u2029" * 500, "é😀. " * 1500,
       ". " * 1300, "a. b. c.d! " * 300, ("q" * 195 + ". ") * 30, ("r" * 198 + ".   ") * 30, ("s" * 900 + ".\n" + "t" * 70 + ".    u. v.\n") * 9]


@pytest.mark.parametrize("mx,ov", [(1000, 200), (300, 250), (12, 5), (1, 0)])
def test_odd_texts_split_alike(spark, mx, ov):
    def jtrim(t):  # Java's $ also stands before a last line separator
        last = t[-1:] if t[-1:] in ("\u0085", "\u2028", "\u2029") else ""
        return t[:len(t) - len(last)].strip(" \t\n\x0b\f\r") + last
    plain, globals()["_jtrim"] = _jtrim, jtrim
    try:
        for strategy in STRATEGIES:
            df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
            got = {k: [] for k in range(len(ODD))}
            for r in split_documents(df, strategy, mx, ov).where("index is not null").collect():
                got[r.doc_id].append((r["index"], r.text))
            for k, text in enumerate(ODD):
                assert [t for _, t in sorted(got[k])] == py_split(text, strategy, mx, ov), (strategy, k)
    finally:
        globals()["_jtrim"] = plain


def test_each_fold_of_the_splitter_is_named_once(spark, docs):
    plan = split_documents(docs, "Recursive")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("aggregate(") == 3  # packing; overlap by the last characters, or by all
