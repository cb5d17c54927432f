import os
import random
import re
import time
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import interaction as I
from tessera.sources.vector_store import scratch_path

SCHEMA = "doc_id long, text string, source string, part string, code int"
LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
    return out + ("D" if re.search(r"[#$%&*|]", text) else "")


def brute(rows, labels):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = {r[0] for r in labels if r[1] == 1}, {r[0] for r in labels if r[2] == 1}
    docs = [(source or "", fails(text or "") + ("E" if i is not None and i > least[text or ""] else ""), i in good and i is not None, i in toxic and i is not None)
            for i, text, source in rows]
    out = {}
    for order in map("".join, permutations("ABCDE")):
        sums = defaultdict(Counter)
        for part, bad, g, t in docs:
            first = min((order.index(f) for f in bad), default=5)
            for k, f in enumerate(order):
                sums[part, k]["kept"] += first > k
                if f in bad:
                    sums[part, k].update({"removed": first == k, "redundant": first < k, "unique_fails": bad == f, "good_lost": first == k and g, "toxic_lost": first == k and t})
        for (part, k), c in sums.items():
            out[part, order, k + 1] = c
    shapley = Counter()
    for (part, order, step), c in out.items():
        shapley[part, order[step - 1]] += c["removed"]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return sorted((*key, *[int(c[n]) for n in names], shapley[key[0], key[1][key[2] - 1]]) for key, c in out.items())


def write(folder, k, rows):
    pq.write_table(pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "source": pa.array([r[2] for r in rows], pa.string()),
                             "part": pa.array(["x"] * len(rows)), "code": pa.array([7] * len(rows), pa.int32())}), f"{folder}/f{k:03}.parquet")
    os.utime(f"{folder}/f{k:03}.parquet", (time.time() - 1000 + k,) * 2)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


LONG = " ".join(f"w{k}" for k in range(400))
TEXTS = [None, "", "short", "short", LONG, LONG.upper(), "a " * 300, LONG + " #", "Über É " * 150, "hot", "hot", "hot"]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force_when_smaller_ids_come_later(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(TEXTS), rng.choice(["s1", "s1", "s2", None, ""])) for i in range(60)]
    rows += [(7, "short", "s1"), (7, "short", "s2"), (None, "short", "s1"), (None, LONG, "s2"), (-5, "hot", "only"), (3, "\U0001F600#", "s2")]
    rows.sort(key=lambda r: -(r[0] or 0)) if seed == 0 else rng.shuffle(rows)
    for k in range(6):
        write(tmp_path, k, rows[k * 11:(k + 1) * 11])
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1), (7, None, 1)]
    got = I.audit_path(spark, str(tmp_path), spark.createDataFrame(labels, LABELS), micro_batches=6, state_keys=[3, 64][seed], provider=[None, I.ROCKSDB][seed])
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert collected(got) == brute(rows, labels)


def test_stopped_stream_goes_on_and_retracts(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    rows = [(9, "same", "a"), (8, "same", "b"), (5, "other", "a"), (1, "same", "a")]
    checkpoint, sink = scratch_path(spark, "t"), scratch_path(spark, "t")
    write(tmp_path, 0, rows[:2])
    first = I.audit_path(spark, str(tmp_path), labels, checkpoint=checkpoint, sink=sink, state_keys=8)
    assert collected(first) == brute(rows[:2], [])
    write(tmp_path, 1, rows[2:])
    again = I.audit_path(spark, str(tmp_path), labels, checkpoint=checkpoint, sink=sink, state_keys=8)
    assert collected(again) == brute(rows, [(1, 1, 0)])
    with pytest.raises(ValueError):
        I.audit_path(spark, str(tmp_path), labels, checkpoint=checkpoint)
    changes = spark.read.parquet(sink)
    assert changes.where("n < 0").agg({"n": "sum"}).first()[0] == -1  # (8, same) was counted as no copy


def test_empty_table(spark, tmp_path):
    write(tmp_path, 0, [])
    assert I.audit_path(spark, str(tmp_path), spark.createDataFrame([], LABELS)).collect() == []


def test_a_task_sends_one_row_of_a_hot_text():
    batch = pa.RecordBatch.from_pylist([{"key": "0a" * 8, "id": 100 - k % 50, "part": "p", "code": 0} for k in range(5000)])
    (out,) = I._fold_task(iter([batch]), 16)
    rows = out.to_pylist()
    assert {(r["bucket"], r["key"], r["id"], r["code"], r["n"]) for r in rows} == {(10, "0a" * 8, 51, 0, 100), (0, None, None, I.COPY, 4900)}


def test_masks_equal_brute_force():
    texts = [*TEXTS, "x " * 199, "x " * 200, LONG[:1200], "A" + "b" * 49, "A" + "b" * 48, "é" * 49 + "A", "|", " w " * 250]
    got = I.text_mask(pa.array(texts))
    assert ["".join(f for k, f in enumerate("ABCD") if m >> k & 1) for m in got] == [fails(t or "") for t in texts]
