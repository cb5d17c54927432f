import re

from pyspark.sql import functions as F

from tessera.llm import url_filter as U
from tessera.llm.queries import SITE_RULES


def verdicts(spark, urls, rules):
    df = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: r for r in U.filter_urls(df, rules).collect()}


def test_longest_site_rule_wins_and_hosts_are_whole_labels(spark):
    urls = ["http://Example.com/en/x", "https://www.example.com/en/x?y", "https://a.www.example.com/en/", "http://notexample.com/en/",
            "http://x.net/es/1", "http://x.net/ES/1", "http://x.net/fr", "https://com", "https://com/", None, "", "no scheme.com/en/",
            "http://h?x://net/es/", "x://net/es/#://com/", "http://example.com/en/x", "http://example.com/en/x"]
    got = verdicts(spark, urls, list(SITE_RULES))
    assert len(got) == len(urls)
    want = ["example.com/en/", "www.example.com/en/", "www.example.com/en/", "com/", "net/es/", None, None, None, "com/",
            None, None, None, None, "net/es/", "example.com/en/", "example.com/en/"]
    assert [got[k].rule for k in range(len(urls))] == want
    assert [got[k].verdict for k in (0, 1, 4, 5, 9)] == ["block", "allow", "block", "allow", "allow"]
    assert (got[0].host, got[0].path) == ("example.com", "/en/x") and (got[9].host, got[9].path) == ("", "")
    assert (got[12].host, got[12].path) == ("h", "") and (got[6].host, got[6].path) == ("x.net", "/fr")


def test_patterns_need_their_token_but_wildcards_do_not_hide_matches(spark):
    rules = [U.Rule("ads", "||ads-track.", "block"), U.Rule("any", "spam*farm", "block"), U.Rule("ok", "/good/", "allow"), U.Rule("end", "/x^", "block")]
    urls = ["http://ads-track.com/", "http://a.ads-track.com", "http://bads-track.com/", "http://q.org/spamXXfarm", "http://q.org/good/",
            "http://q.org/x", "http://q.org/x/", "http://q.org/xy"]
    got = verdicts(spark, urls, rules)
    assert [got[k].pattern for k in range(8)] == ["ads", "ads", None, "any", "ok", "end", "end", None]
    told = spark.createDataFrame([("spam*farm",), ("||a.b/cd",), ("/x^y-*",), ("ab/cd/",), ("||a.a.",)], "p string").select(U.rule_tokens(F.col("p")).alias("t"))
    assert [r.t for r in told.collect()] == [[""], ["a", "b"], ["x", "y"], ["cd"], ["a"]]


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = ["http://example.com/en/"] * 3 + ["http://other.com/en/"] * 2 + ["http://example.org/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    tokens = df.selectExpr("url", "explode(split(url, '[^a-z0-9]+')) AS token")
    index = U.rule_index(U.rule_table(spark, [U.site_rule("example.com/en/", "block"), U.site_rule("never.com/", "allow")]), tokens)
    assert {(r.name, r.token) for r in index.collect()} == {("example.com/en/", "example"), ("never.com/", "never")}


def test_empty_table(spark):
    assert verdicts(spark, [], list(SITE_RULES)) == {}


def test_tables_of_rules_from_the_pages_own_paths(spark):
    """A rule for every third page's host and path, as a table: what fits equals trying every rule on every URL."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    target = F.concat(U.host_of(F.col("url")), U.path_of(F.col("url")))
    name = F.concat(F.lit("||"), F.regexp_replace(target, r"[0-9](?=[0-9]*$)", "*"), F.lit("^"))
    rules = pages.where("page_id % 3 = 0").select(name.alias("name"), name.alias("pattern"), F.lit("block").alias("action"), F.lit(False).alias("site")).distinct()
    rules = rules.unionByName(spark.createDataFrame([("none", None, "block", None), ("($x[", "($x[", "block", None)], "name string, pattern string, action string, site boolean"))
    got = {r.page_id: r.pattern for r in U.filter_urls(pages, rules).collect()}
    plain = sorted((r.name, re.compile(U.Rule(r.name, r.pattern, "block").regex())) for r in rules.collect() if r.pattern)
    want = {r.page_id: next((n for n, x in plain if x.search(r.target)), None) for r in pages.select("page_id", target.alias("target")).collect()}
    assert got == want and sum(v is not None for v in got.values()) > len(got) / 3 > 5


def test_names_of_spam_sites_and_queries(spark):
    urls = ["http://m.casino-win.example.org/en/1", "http://free-bets.example.net/", "https://adult-x.example.org/a", "http://carefree-bets.example.org/",
            "http://x.org/free-bets.html", "http://x.org/a?ref=sponsor&b#c", "http://x.org/ref=sponsor&"]
    rules = [*U.BLOCK_PATTERNS, *U.name_rules()]
    assert len(rules) > 1500
    got = verdicts(spark, urls, rules)
    assert [got[k].verdict for k in range(7)] == ["block"] * 3 + ["allow"] * 4
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    asked = {r.page_id: r.verdict for r in U.filter_urls(df, [U.Rule("s", "?ref=sponsor&", "block")], with_query=True).collect()}
    assert [k for k, v in asked.items() if v == "block"] == [5]
