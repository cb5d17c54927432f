import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup as X

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "Ein Satz über Öl. " * 3000
ROWS = [(1, "Abc. Déjà vu."), (2, "aBC. Déjà vu."), (3, "abc. DÉJÀ vu."), (4, None), (5, ""), (6, LONG), (7, LONG.upper()),
        (8, LONG.replace("E", "e")), (9, "x\ny"), (9, "x\ny"), (None, "x\nY"), (10, LONG + "!"), (11, "a" * 10000), (12, "A" * 10000), (13, "a" * 9999)]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOW)].append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOW)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("identify", [X.chunk_id, lambda c: F.crc32(c.cast("binary")) % 3])
def test_groups_equal_brute_force_also_when_identifiers_clash(spark, identify):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("_row", F.lit(1)).withColumn("keep_id", F.lit("x"))
    got = X.exact_dedup(df, identify=identify).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(ROWS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})


def test_chunks_join_to_the_text_and_meet_again_after_an_insertion(spark):
    rng = random.Random(1)
    text = "".join(f"Sentence {k} has {'so ' * rng.randrange(30)}many words. " for k in range(400))
    df = spark.createDataFrame([(text,), ("Something new. " + text,), (LONG,)], "text string")
    rows = [r.c for r in df.select(X.chunks(F.col("text"), 64, 512).alias("c")).collect()]
    assert ["".join(c) for c in rows] == [text, "Something new. " + text, LONG]
    assert len(set(rows[0]) & set(rows[1])) >= len(rows[0]) - 20


def test_kept_documents_have_all_columns_and_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(i, t, "s", i) for i, t in ROWS], "doc_id long, text string, _sha string, _first long")
    kept = X.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 7, 8, 9, 10, 12, 13]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert X.exact_dedup(df).collect() == [] and X.drop_exact_copies(df).collect() == []
