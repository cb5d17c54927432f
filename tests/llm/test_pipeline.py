import corpus_pipeline
from tessera.llm import bpe, mixing, queries
from tests.conftest import SF_SMALL


def test_stages_follow_each_other(spark):
    """Each stage's result is what its rule says of its input, by brute force."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.cut_lineage(stage(spark, before, SF_SMALL))
        kept[name] = docs.count()
        if name != "bpe":
            assert docs.columns == spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
            assert docs.exceptAll(before).count() == 0 or name == "mixing"
        if name == "exact_dedup":
            low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            best = {}
            for r in before.collect():
                key = (r.text or "").translate(low)
                best[key] = max(best.get(key, -1), r.doc_id)
            assert sorted(best.values()) == sorted(r.doc_id for r in docs.collect())
        if name == "simhash":
            from tests.llm.test_simhash import brute_classes, brute_print
            rows = before.select("doc_id", "text").collect()
            label = brute_classes([brute_print(r.text) for r in rows])
            first = {}
            for r, c in zip(rows, label):
                first[c] = min(first.get(c, r.doc_id), r.doc_id)
            assert sorted(first.values()) == sorted(r.doc_id for r in docs.collect())
        if name == "mixing":
            want = {r.doc_id: r.copies for r in mixing.mix_sources(before).collect() if r.copies}
            got = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert got == want
        if name == "bpe":
            assert kept["mixing"] == kept["bpe"]
            assert docs.exceptAll(queries.bpe_digests(before.select("doc_id", "text"))).count() == 0
    assert kept["toxicity"] >= kept["exact_dedup"] >= kept["simhash"] > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "bpe"] and bpe


def test_oracles_match(spark):
    from tests.oracle import digest, duck
    con = duck(SF_SMALL)
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, SF_SMALL)
        rel = con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0], name


ODD = "doc_id long, text string, lang string, source string, n_chars long, _toxicity int, _doc string, _key string, _h string, _s int, `a.b` int"


def test_stages_take_nulls_repeats_long_texts_and_any_extra_columns(spark):
    def row(i, text, source="s"):
        return (i, text, None, source, None, 1, "x", "y", "z", 2, 3)
    long = "A long text. " * 60_000
    data = [row(1, None), row(2, ""), row(3, " \n"), row(None, "null id here"), row(4, "same words again"), row(4, "same words again"),
            row(5, "SAME words again"), row(6, long, None), row(7, long + "more", None), row(8, None, None), row(9, "\u0000   é 🎉")]
    docs = spark.createDataFrame(data, ODD)
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.cut_lineage(stage(spark, docs, SF_SMALL))
        if name != "bpe":
            assert after.columns == docs.columns, name
            assert after.count() > 0
        if name == "toxicity":
            assert after.count() == len(data)
        if name == "exact_dedup":
            assert sorted(str(r.doc_id) for r in after.collect()) == sorted(map(str, [8, 3, None, 5, 6, 7, 9]))
        if name == "bpe":
            assert after.count() == docs.count()
        docs = after if name != "bpe" else docs


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], ODD)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0, name


def test_other_operators_take_odd_rows(spark):
    from tessera.llm import langid, quality, substring, url_filter
    data = [(1, None, None), (1, None, None), (2, "", "x"), (None, "w " * 100_000, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id long, text string, lang string, _text int, _m int")
    assert quality.quality(docs).count() == 4
    assert langid.predict(docs, langid.fit(docs)).count() == 4
    assert substring.remove_repeats(docs).count() == 4
    pages = spark.createDataFrame([(None, None, 1), (1, "http://a.com/", 2), (1, "http://a.com/", 2)], "page_id long, url string, _url int")
    assert url_filter.filter_urls(pages, list(queries.SITE_RULES)).count() == 3
