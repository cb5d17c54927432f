import pytest

from tessera.llm import mixing as M


def rows(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, source string, prefix int, _t string, base string")


def doc(i, n, source):
    return (i, " ".join(["w"] * n), source, 1, "x", "y")


def test_targets_caps_and_nested_shares(spark):
    data = [doc(i, 10 + i % 7, "big") for i in range(600)] + [doc(1000 + i, 10, "mid") for i in range(90)] + [doc(2000 + i, 5, "tiny") for i in range(8)]
    data += [(3000, None, None, 1, "x", "y"), (3001, "a b c", None, 1, "x", "y"), (3002, " ", "void", 1, "x", "y")]
    got = M.mix_sources(rows(spark, data)).collect()
    assert len(got) == len(data)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    total = sum(r.size for r in got)
    targets = {s: x[0].target for s, x in by.items()}
    assert sum(targets.values()) == pytest.approx(total)
    for s, x in by.items():
        assert targets[s] <= 3 * x[0].source_size
        assert abs(sum(r.taken for r in x) - targets[s]) <= max(r.size for r in x) / 2 + 1e-6
    sizes = {s: x[0].source_size for s, x in by.items()}
    weight = dict(zip(["big", "mid", "tiny", "void", None], [5, 2, 1, 5, 2]))
    capped = set()
    while True:  # share by weight until none is above three times its source
        unit = (total - sum(3 * sizes[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        over = {s for s, w in weight.items() if s not in capped and unit * w > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    assert "tiny" in capped and "big" not in capped
    assert targets == pytest.approx({s: 3 * sizes[s] if s in capped else unit * w for s, w in weight.items()})
    again = M.mix_sources(rows(spark, data[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_documents_come_as_often_as_taken_with_all_columns(spark):
    data = [doc(i, 20, "a") for i in range(50)] + [doc(100 + i, 2, "b") for i in range(10)] + [doc(7, 20, "a")]
    df = rows(spark, data)
    copies = {}
    for r in M.mix_sources(df).collect():
        copies.setdefault(r.doc_id, []).append(r.copies)
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {i: sum(c) for i, c in copies.items() if sum(c)}
    assert len(set(copies[7])) == 1  # rows with one id share their fate


def test_all_sources_equal_null_or_empty(spark):
    assert M.mix_sources(rows(spark, [])).collect() == []
    got = M.mix_sources(rows(spark, [(1, None, None, 1, "x", "y"), (2, "", None, 1, "x", "y")])).collect()
    assert [(r.size, r.target, r.taken, r.copies) for r in got] == [(0, 0.0, 0, 1)] * 2
    got = M.mix_sources(rows(spark, [doc(i, 1000 if i == 0 else 1, "one") for i in range(9)])).collect()
    assert {r.copies for r in got} == {1}  # a single source is its own target


def test_ordinal_orders_by_code_point_with_null_last(spark):
    names = ["é", "z", "Z", "a", "", "日", "\U0001F600", "\uFFFD", None]
    df = spark.createDataFrame([(n,) for n in names], "source string")
    got = sorted((r._rank, r.source) for r in M.ordinal(df, "source").collect())
    assert [s for _, s in got] == sorted(names[:-1]) + [None] and [k for k, _ in got] == list(range(9))
