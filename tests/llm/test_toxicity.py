import numpy as np
import pytest

from tessera.llm import toxicity as X

GOOD = "ba ne ti so lu mor tan vel kir dos".split()


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for k in range(n):
        words = [f"{rng.choice(GOOD)}{rng.choice(GOOD)}" for _ in range(rng.integers(5, 200))]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.integers(len(words))] = f"zwurk{rng.choice(GOOD)}"
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def net():
    texts, labels = corpus(600)
    sample = X.Sample([t.encode() for t in texts], labels)
    net = X._train(sample, rounds=2, steps=60, batch=128)
    X._calibrate(net, sample, 0.25)
    return net


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = X.Net.fresh(rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(0, 0.5, (7, X.WORD_DIM + X.CHAR_DIM))
    at = rng.integers(0, 7, (5, 6))
    mask = (np.arange(6) < np.array([6, 6, 3, 1, 5])[:, None]).astype(np.float64)
    y, weight = np.array([1, 0, 1, 0, 1.0]), np.array([0.2, 0.3, 0.1, 0.2, 0.2])

    def loss():
        z = net.forward(net.project(x), at, mask)
        return float((weight * (np.logaddexp(0, z) - y * z)).sum())

    grads, dx = net.gradients(x, at, mask, y, weight)
    for name, array in [*((k, net.p[k]) for k in grads), ("x", x)]:
        g = dx if name == "x" else grads[name]
        for k in rng.integers(0, array.size, 6):
            old = array.flat[k]
            array.flat[k] = old + 1e-2
            up = loss()
            array.flat[k] = old - 1e-2
            down = loss()
            array.flat[k] = old
            assert (up - down) / 2e-2 == pytest.approx(float(np.asarray(g).reshape(array.shape).flat[k]), abs=2e-4), name


def test_windows_cover_all_words_and_overlap():
    for n in range(1, 200):
        s = X.window_starts(n)
        covered = {k for a in s for k in range(a, min(n, a + X.WINDOW))}
        assert covered == set(range(n)) and (np.diff(s) <= X.STRIDE).all() and s[-1] == max(0, n - X.WINDOW)
    assert len(X.window_starts(0)) == 0


def test_held_out_texts_with_unseen_endings(net):
    texts, labels = corpus(400, seed=9)
    got = X.Scorer(net).score([t.encode() for t in texts])
    assert ((got >= 0.5) == (labels == 1)).mean() > 0.98


def test_scores_do_not_depend_on_batches_and_see_the_end_of_long_texts(net):
    texts, _ = corpus(60, seed=4)
    clean = " ".join(["morti"] * 30_000)
    texts += ["", " \n", "zwurkne", clean, clean + " zwurkmor"]
    all_at_once = X.Scorer(net).score([t.encode() for t in texts])
    one = X.Scorer(net)
    assert np.allclose(all_at_once, [one.score([t.encode()])[0] for t in texts], atol=1e-5)
    assert all_at_once[-5] == all_at_once[-4] == 0 and all_at_once[-2] < 0.5 <= all_at_once[-1]
    assert ((0 <= all_at_once) & (all_at_once <= 1)).all()


def test_rows_nulls_repeats_and_missing_labels(spark, net):
    docs = spark.createDataFrame([(1, "zwurkne soba", 7), (1, "zwurkne soba", 7), (2, None, 7), (None, "soba", 7)], "doc_id long, text string, score int")
    out = X.score(docs, net)
    assert out.columns == ["doc_id", "text", "score"] and out.count() == 4
    assert [r.score for r in out.where("doc_id = 2").collect()] == [0.0]
    assert {r.score for r in X.score(docs, None).collect()} == {0.0}
    assert X.score(docs.limit(0), net).collect() == []
    none = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    assert X.fit(docs, none) is None and X.fit(docs, none.limit(0)) is None
    no_text = spark.createDataFrame([(2, 1), (1, 0)], "doc_id long, toxic int")
    assert X.fit(docs, no_text) is None


def test_held_out_accuracy(spark):
    from tessera.llm.queries import op10_toxicity
    sf = "/root/testdata/sf0.1"
    out = op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(out) > 500 and (out.predicted == out.toxic).mean() > 0.95


def plain_score(net, text):
    """The score of one text, word by word and window by window, as the formulas say."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    h = X.HIDDEN
    words = text.split()
    if not words:
        return 0.0
    vectors = []
    for w in words:
        bucket, grams, _ = X.featurise([w])
        vectors.append(np.concatenate([p["word"][bucket[0]], sum(p["char"][g] for g in grams)]))

    def run(seq, d):
        state, out = np.zeros(h), []
        for x in seq:
            gate, back = x @ p["wx"][d] + p["bx"][d, 0], state @ p["u"][d]
            z, r = (1 / (1 + np.exp(-(gate[a:a + h] + back[a:a + h]))) for a in (0, h))
            new = np.tanh(gate[2 * h:] + r * back[2 * h:])
            state = z * state + (1 - z) * new
            out.append(state)
        return out
    n = len(words)
    starts = [0] if n <= X.WINDOW else sorted({*range(0, n - X.WINDOW, X.STRIDE), n - X.WINDOW})
    logits = []
    for s in starts:
        window = vectors[s:s + X.WINDOW]
        both = [np.concatenate(x) for x in zip(run(window, 0), run(window[::-1], 1)[::-1])]
        weight = np.exp([np.tanh(b @ p["wa"] + p["ba"]) @ p["va"] for b in both])
        logits.append(sum(a * b for a, b in zip(weight / weight.sum(), both)) @ p["out"] + p["c"][0])
    return 1 / (1 + np.exp(-(net.scale * max(logits) + net.shift)))


def test_scores_equal_plain_loops(net):
    texts, _ = corpus(40, 3)
    texts = [t.encode() for t in [*texts, "", " \n", "one", "A, b! é", " ".join(texts)]]
    got = X.Scorer(net).score(texts)
    assert np.abs(got - [plain_score(net, t) for t in texts]).max() < 1e-3
    again = X.Scorer(net)
    assert np.abs(np.concatenate([again.score([t]) for t in texts]) - got).max() < 1e-5
