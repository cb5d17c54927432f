import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import quality as Q

PROSE = "The cat sat on a mat near the door. It was warm there, and nobody minded. " * 1
TEXTS = ["", None, " \n", "a", "x\ny\nx\n\n x", "\n\n", "a b c a b c", "a b c\n\na b c a", "\u2028é ü\x0b\x85z", "one  two\tthree\r\n" * 3, "# $$ <|> !\n# $$ <|> !",
         " ".join(f"w{k}" for k in range(5000)), "end\n", "x\n" * 2000, "w" * 100_000]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), len(lines),
            text.count("!"), sum("A" <= c <= "Z" for c in text), sum(w[-1] in ".!?" for w in words), len(set(words)),
            sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words), sum(len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w) for w in words))


def test_statistics_equal_brute_force():
    got = Q.measure(pa.array(TEXTS))
    for k, text in enumerate(TEXTS):
        assert tuple(int(x[k]) for x in got) == brute(text), repr(text)[:60]


def counted(votes):
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    return patterns, counts.astype(float), inverse.ravel()


def test_a_noisy_rule_gets_a_low_accuracy_and_does_not_decide():
    """Three good rules and one that votes bad at random on 30 % of 20,000 texts, 5 % of them junk."""
    rng = np.random.default_rng(0)
    junk = np.arange(20_000) < 1000
    hit, slip = np.array([0.9, 0.85, 0.8, 0.3]), np.array([0.01, 0.02, 0.01, 0.3])
    votes = np.where(rng.random((20_000, 4)) < np.where(junk[:, None], hit, slip), 0, 1)
    patterns, counts, inverse = counted(votes)
    model = Q.fit(patterns, counts)
    accuracy = model.accuracy()
    assert accuracy[3] < 0.1 and (accuracy[:3] > 0.6).all()
    assert np.abs(model.hit - hit)[:3].max() < 0.05 and np.abs(model.slip - slip).max() < 0.02 and abs(model.shares[1] - 0.05) < 0.01
    kept = model.good(patterns)[inverse] >= 0.5
    assert kept[~junk].mean() > 0.98 and kept[junk].mean() < 0.05
    lone = ~junk & ((votes == 0).sum(1) == 1) & (votes[:, 3] == 0)
    assert lone.sum() > 4000 and kept[lone].all()
    all_must_pass = (votes != 0).all(1)
    assert all_must_pass[~junk].mean() < 0.7 and (kept != all_must_pass).mean() > 0.2


def test_kinds_of_junk_that_two_rules_know_each():
    rng = np.random.default_rng(1)
    slip, kinds = [0.004, 0.03, 0.002, 0.05, 0.1, 0.01], [(0, 1), (2, 3), (4, 5)]
    rows, junk = [np.where(rng.random((9000, 6)) < slip, 0, 1)], [np.zeros(9000, bool)]
    for kind, n in zip(kinds, (500, 200, 100)):
        rate = np.array(slip)
        rate[list(kind)] = 0.95
        rows.append(np.where(rng.random((n, 6)) < rate, 0, 1))
        junk.append(np.ones(n, bool))
    votes, junk = np.concatenate(rows), np.concatenate(junk)
    votes[rng.random(votes.shape) < 0.1] = 2  # abstains anywhere
    patterns, counts, inverse = counted(votes)
    model = Q.fit(patterns, counts, list("aabbcc"))
    kept = model.good(patterns)[inverse] >= 0.5
    assert kept[~junk].mean() > 0.98 and kept[junk].mean() < 0.3  # of a tenth of the junk one of its two rules abstains
    assert kept[9000:9500].mean() < 0.2 and kept[9500:9700].mean() < 0.35
    lone = ~junk & ((votes == 0).sum(1) == 1)
    assert 0.9 < kept[lone].mean() < 1 and model.accuracy()[4] < 0.3 < 0.7 < model.accuracy()[0]


def test_prior_is_small_and_fixed():
    model = Q.fit(np.zeros((0, 3), int), np.zeros(0))
    assert (model.shares == 0.5).all() and (model.hit == 0.5).all() and (model.slip == 0.05).all()
    one, many = (Q.fit(np.array([[0, 0, 1], [1, 1, 1], [1, 1, 0]]), n * np.array([5.0, 90.0, 40.0])) for n in (1, 1000))
    assert many.accuracy()[2] < one.accuracy()[2] < 0.3 and many.slip[2] > 0.3


def test_clean_documents_stay_and_junk_goes(spark):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in "ba ne ti so lu".split() for b in "mor tan vel ".split(" ")]
    def prose():
        return " ".join(" ".join(rng.choice(words, 9)).capitalize() + "." for _ in range(25))
    data = [(k, prose()) for k in range(300)] + [(1000 + k, prose().replace(" ", "$$$ ")) for k in range(20)] + [(2000 + k, prose().upper().replace(" ", "!! ")) for k in range(20)]
    data += [(3000, None), (3001, ""), (3002, "short"), (None, prose())]
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, t in data], "doc_id long, text string, quality double, n_words string")
    got = {r.doc_id: r for r in Q.quality(df).collect()}
    assert len(got) == len(data)
    assert all(got[k].kept for k in [*range(300), None])
    assert not any(got[k].kept for k in [*range(1000, 1020), *range(2000, 2020), 3000, 3001, 3002])
    assert got[3000].base_failed and not got[1000].base_failed and 0 <= got[1000].quality < 0.5


def test_empty_table(spark):
    assert Q.quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_tables_keep_clean_documents_and_some_with_a_lone_bad_vote(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    votes = sum((r.vote() == 0).cast("int") for r in Q.RULES)
    rows = Q.quality(docs).withColumn("bad", votes).where(~F.col("base_failed")).join(labels.withColumnRenamed("quality", "label"), "doc_id", "left").collect()
    assert all(r.kept for r in rows if r.label == 1) and not any(r.kept for r in rows if r.label == 0)
    assert any(r.bad for r in rows if r.kept)
