"""URL filtering with pattern rules indexed by their rarest literal token.

A rule is written like ``||example.com/en/``: literal text, ``*`` for any run
of characters, ``^`` for a separator or the end, and a leading ``||`` for the
start of the host or of one of its labels.  A URL's tokens fetch the rules
filed under one of them, and only those rules' regular expressions run."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; with ``site`` the rule is a host/path rule: the
    longest of those that fit decides, before any other pattern."""
    name: str
    pattern: str
    action: str
    site: bool = False

    def regex(self) -> str:
        body = self.pattern.removeprefix("||")
        out = "".join({"*": ".*", "^": "(?:[^0-9A-Za-z_.%-]|$)"}.get(c, re.escape(c)) for c in body)
        return (r"^(?:[^/]*\.)?" if self.pattern.startswith("||") else "") + out

    def literal(self) -> str:
        """The longest run without wildcards: every matching URL holds it."""
        return max(re.split(r"[*^]", self.pattern.removeprefix("||")), key=len)


def site_rule(site: str, action: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts
    with the rule's path."""
    return Rule(site, "||" + site, action, True)


#: Words that make up the names of advertising and spam sites, subjects and companions.
SUBJECTS = ("ads", "adult", "bets", "betting", "bitcoin", "bonus", "casino", "click", "coupon", "crypto", "dating", "diet", "escort", "forex",
            "gambling", "jackpot", "loans", "lottery", "pills", "poker", "porn", "promo", "replica", "slots", "spam", "traffic", "viagra", "xxx")
COMPANIONS = ("best", "buy", "cash", "cheap", "city", "club", "deal", "easy", "farm", "fast", "free", "girls", "hot", "king", "live", "lucky", "mania",
              "mega", "money", "now", "online", "palace", "shop", "store", "super", "track", "tracker", "vip", "win", "world", "x", "zone")


def name_rules(subjects: tuple[str, ...] = SUBJECTS, companions: tuple[str, ...] = COMPANIONS) -> list[Rule]:
    """Block rules for host labels ``subject-companion`` and ``companion-subject``."""
    names = [n for a in subjects for b in companions for n in (f"||{a}-{b}.", f"||{b}-{a}.")]
    return [Rule(n, n, "block") for n in names]


#: Other sites and paths of advertising, and labels of any length about casinos.
BLOCK_PATTERNS = tuple(Rule(p, p, "block") for p in (
    "||casino-*.", "||*-casino.", "||doubleclick.", "/wp-login.", "/adserver/", "/banner-ads/"))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """``name, pattern, action, site``, as a stored list of rules has them."""
    return spark.createDataFrame([(r.name, r.pattern, r.action, r.site) for r in rules], "name string, pattern string, action string, site boolean")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` or for null."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    """From ``?`` up to ``#`` or the end; empty where there is none or no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.concat(F.split(F.lower(target), "[^a-z0-9]+"), F.array(F.lit(""))))


def _regex(pattern: Column) -> Column:
    """A rule's pattern as a regular expression (:meth:`Rule.regex`)."""
    body = F.regexp_replace(F.regexp_replace(pattern, r"^\|\|", ""), r"([\\.+?$|(){}\[\]])", r"\\$1")
    body = F.replace(F.replace(body, F.lit("^"), F.lit("(?:[^0-9A-Za-z_.%-]|$)")), F.lit("*"), F.lit(".*"))
    return F.concat(F.when(F.startswith(pattern, F.lit("||")), F.lit(r"^(?:[^/]*\.)?")).otherwise(F.lit("")), body)


def rule_tokens(pattern: Column) -> Column:
    """Literal tokens that any matching URL holds as whole tokens: runs of
    letters and digits with a literal separator, ``^`` or ``||`` on either
    side.  Without any it is the empty token: the rule is tried on every URL."""
    anchored = F.startswith(pattern, F.lit("||"))
    body = F.concat(F.when(anchored, F.lit("|")).otherwise(F.lit("*")), F.lower(F.regexp_replace(pattern, r"^\|\|", "")))
    found = F.array_distinct(F.regexp_extract_all(body, F.lit(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def rule_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``token, name, regex, action, site``: every rule of a table (:func:`rule_table`) once, under the token
    of its own that the fewest of the URLs (``tokens``: one row for each URL and
    token) hold; ties go to the first token in order.  Rules of one name and pattern are
    one; those without a pattern fit nothing."""
    rules = rules.where("pattern IS NOT NULL").dropDuplicates(["name", "pattern", "action", "site"])
    told = rules.select("name", "pattern", "action", F.coalesce("site", F.lit(False)).alias("site"), F.explode(rule_tokens(F.col("pattern"))).alias("token"))
    seen = tokens.join(told.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = F.row_number().over(Window.partitionBy("name", "pattern", "action", "site").orderBy(F.coalesce("count", F.lit(0)), "token"))
    return (told.join(seen, "token", "left").withColumn("_place", rarest).where("_place = 1")
            .select("token", "name", _regex(F.col("pattern")).alias("regex"), "action", "site"))


def filter_urls(pages: DataFrame, rules: list[Rule] | DataFrame, url_col: str = "url", default: str = "allow",
                with_query: bool = False) -> DataFrame:
    """``pages``, judged by a list or a table of rules (:func:`rule_table`; of any size), with ``host``, ``path``, ``rule`` (the deciding host/path rule or
    null), ``pattern`` (the deciding other pattern or null) and ``verdict``.

    Of the fitting host/path rules the longest decides (ties: first in code
    point order); without one, a fitting block pattern blocks, then a fitting
    allow pattern allows, else ``default`` holds.  Null urls and urls without ``://``
    have empty host and path and get ``default`` unless a rule fits the empty
    text.  Rules are matched against host and path, ``with_query`` also against what follows up to ``#``.  Columns of those five names in ``pages`` are replaced; repeated
    urls are judged once and every row keeps its place in the result."""
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col), F.lit(""))
    targets = (pages.select(url.alias("_url")).distinct()
               .select("_url", F.concat(host_of(F.col("_url")), path_of(F.col("_url")),
                                        query_of(F.col("_url")) if with_query else F.lit("")).alias("_target")))
    tokens = targets.select("_url", "_target", F.explode(_tokens(F.col("_target"))).alias("token"))
    if not isinstance(rules, DataFrame):
        rules = rule_table(spark, rules)
    index = cut_lineage(rule_index(rules, tokens))  # a row a rule
    order = F.struct(F.col("site"), F.when(F.col("site"), F.length("name")).otherwise(F.lit(0)).alias("size"),
                     (F.col("action") == "block").alias("block"))
    best = F.struct(order.alias("o"), F.col("name"), F.col("action"))
    fits = tokens.join(index, "token").where(F.regexp_like("_target", F.col("regex")))
    # Largest order first, then the first name: max over the order, min over names of that order.
    judged = (fits.groupBy("_url", order.alias("_o")).agg(F.min(best).alias("_b"))
              .groupBy("_url").agg(F.max_by("_b", "_o").alias("_b")))
    named = cut_lineage(judged.select("_url", F.col("_b.name").alias("_name"), F.col("_b.action").alias("_action"),
                                      F.col("_b.o.site").alias("_site")))
    old = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "pattern", "verdict")]
    return (pages.select(F.struct(*[f"`{c}`" for c in old]).alias("_page"), url.alias("_url")).join(named.hint("merge"), "_url", "left")
            .select(*[F.col("_page").getField(c).alias(c) for c in old],
                    host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
                    F.when(F.col("_site"), F.col("_name")).alias("rule"),
                    F.when(~F.col("_site"), F.col("_name")).alias("pattern"),
                    F.coalesce("_action", F.lit(default)).alias("verdict")))
