import numpy as np
import pytest

from tessera.llm import langid as L

EN = "the house is on the hill and the water is cold "
DE = "das Haus steht auf dem Hügel und das Wasser ist kalt "


def grams(text):
    return L.ngrams([text])[0]


def test_ngrams_skip_other_characters_and_case():
    assert (grams("Ab, cd!") == grams("ab cd")).all() and (grams("--a--") == grams("A")).all()
    assert not len(grams("")) and not len(grams(None)) and not len(grams("12 !?")) and len(grams("日"))
    # " a ": two bigrams and one trigram
    assert len(grams("a")) == 3 and len(grams("ab")) == 3 + 2


def test_texts_of_a_slice_do_not_mix():
    texts = [EN, "", None, DE, "a", "--", "  b  ", "日本 x", EN * 50]
    got, rows = L.ngrams(texts)
    assert (np.diff(rows) >= 0).all()
    for k, t in enumerate(texts):
        assert sorted(got[rows == k]) == sorted(grams(t)), t
    rng = np.random.default_rng(0)
    model = L.Model(("a", "b", "c"), np.log([0.2, 0.3, 0.5]), rng.normal(size=(L.BUCKETS, 3)) - 8)
    best, score = model.score(got, rows, len(texts))
    for k, t in enumerate(texts):
        if not len(grams(t)):
            assert (best[k], score[k]) == (-1, 0)
            continue
        total = model.prior + sum(model.logp[g] for g in grams(t))  # one n-gram after the other
        assert best[k] == total.argmax() and score[k] == pytest.approx(np.exp(total.max() - np.logaddexp.reduce(total)))


def test_scores_equal_naive_bayes_by_hand(spark):
    train = spark.createDataFrame([(EN, "en"), (DE, "de"), (EN + EN, "en"), (None, "fr"), (DE, None)], "text string, lang string")
    model = L.fit(train)
    assert model.languages == ("de", "en")
    counts = {k: np.zeros(L.BUCKETS) for k in ("en", "de")}
    for text, lang in ((EN, "en"), (DE, "de"), (EN + EN, "en")):
        counts[lang] += np.bincount(grams(text), minlength=L.BUCKETS)
    logs = {k: np.log((c + 0.5) / (c.sum() + 0.5 * L.BUCKETS)) for k, c in counts.items()}
    text = "on the Wasser"
    total = np.array([np.log(1 / 3) + logs["de"][grams(text)].sum(), np.log(2 / 3) + logs["en"][grams(text)].sum()])
    post = np.exp(total - total.max())
    lang, score = model.score(*L.ngrams([text]), 1)
    assert lang[0] == total.argmax() and score[0] == pytest.approx((post / post.sum()).max())


def test_und_nulls_ties_and_clashing_columns(spark):
    train = spark.createDataFrame([(EN, "en"), (DE, "de")], "text string, lang string")
    docs = spark.createDataFrame([(1, EN, 0.1), (1, EN, 0.1), (2, None, None), (3, "", None), (4, "123 ...", None), (5, DE * 20_000, None), (None, DE, None)],
                                 "doc_id long, text string, score double")
    out = L.predict(docs, L.fit(train))
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    got = [(r.doc_id, r.lang_pred) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de"), (None, "de")], key=str)
    assert all(0 <= r.score <= 1 for r in out.collect())
    same = L.Model(("a", "b"), np.log([0.5, 0.5]), np.zeros((L.BUCKETS, 2)))
    best, score = same.score(*L.ngrams(["tie"]), 1)
    assert (best[0], score[0]) == (0, 0.5)


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(1, EN)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string, lang string")
    model = L.fit(none)
    assert [(r.lang_pred, r.score) for r in L.predict(docs, model).collect()] == [("und", 0.0)]
    assert L.predict(docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    from tessera.llm.queries import op3_langid
    from tests.conftest import SF_MID
    out = op3_langid(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = out.where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
