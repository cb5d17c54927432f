"""Scalar functions: ids, filters, summaries, prompts, HTML."""

import hashlib
import time
import uuid

import pytest

from tessera import errors as E
from tessera.functions import text as X
from tessera.functions.filters import FilterSyntaxError, compile_filter
from tessera.functions.prompt import render, system_prompt


def _java_name_uuid(s: str) -> str:
    b = bytearray(hashlib.md5(s.encode("utf-8")).digest())
    b[6] = (b[6] & 0x0F) | 0x30
    b[8] = (b[8] & 0x3F) | 0x80
    return str(uuid.UUID(bytes=bytes(b)))


def test_content_uuid_is_name_based_md5(spark):
    texts = ["", "hello", "héllo wörld ✓", "a" * 5000, "line\nbreak"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.u for r in df.select(X.content_uuid("t").alias("u")).collect()]
    assert got == [_java_name_uuid(t) for t in texts]


@pytest.fixture(scope="module")
def meta(spark):
    rows = [(1, {"lang": "en", "n": "10", "q": "1"}), (2, {"lang": "fr", "n": "200"}),
            (3, {"lang": "en", "n": "9", "q": "0"}), (4, {})]
    return spark.createDataFrame(rows, "id int, metadata map<string,string>")


@pytest.mark.parametrize("text,ids", [
    ('metadataKey("lang").isEqualTo("en")', {1, 3}),
    ('metadataKey("lang").isNotEqualTo("en")', {2, 4}),
    ('metadataKey("n").isGreaterThan(9)', {1, 2}),          # numeric, not "10" < "9"
    ('metadataKey("n").isLessThanOrEqualTo("10")', {1, 3}),
    ('metadataKey("lang").isIn("fr", "de")', {2}),
    ('metadataKey("q").isNotIn("0")', {1, 2, 4}),
    ('and(metadataKey("lang").isEqualTo("en"), metadataKey("q").isEqualTo(1), metadataKey("n").isLessThan(20))', {1}),
    ('or(metadataKey("lang").isEqualTo("fr"), not(metadataKey("q").isEqualTo("0")))', {1, 2, 4}),
    ('not(metadataKey("q").isEqualTo("1"))', {2, 3, 4}),
    ('metadataKey("lang").isIn("a,b", "(x)")', set()),       # quotes protect , and ()
    ("", {1, 2, 3, 4}),
])
def test_filters(spark, meta, text, ids):
    assert {r.id for r in meta.where(compile_filter(text)).collect()} == ids


@pytest.mark.parametrize("bad", ['not(metadataKey("a").isEqualTo(1), metadataKey("b").isEqualTo(2))',
                                 'and(metadataKey("a").isEqualTo(1))', 'metadataKey("a").isLike(1)',
                                 'metadataKey("a").isEqualTo(1', 'xor(a, b)'])
def test_filter_errors_are_raised_before_any_job(bad):
    with pytest.raises(FilterSyntaxError):
        compile_filter(bad)


def test_summary_extract(spark):
    rows = [("<analysis>x</analysis><summary>\n  keep me \n</summary><summary>no</summary>",),
            ("  plain  ",), ("",), (None,), ("<summary>\n\n</summary>",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.s for r in df.select(X.summary_extract("t").alias("s")).collect()]
    assert got[:4] == ["keep me", "plain", "", ""]


def test_tool_args_repair(spark):
    df = spark.createDataFrame([('{"a": "1", "b": [1, 2,],}',)], "a string")
    m = df.select(X.tool_args_map("a").alias("m")).collect()[0].m
    assert m == {"a": "1", "b": "[1,2]"}


def test_prompt_template(spark):
    df = spark.createDataFrame([("q?", ["a", "b"], None)], "question string, docs array<string>, extra string")
    out = df.select(render(df.schema, 'Q: ${question} D: ${docs[1]} E: ${exists(extra) ? extra : "none"}'
                           ' M: ${exists(missing) ? missing : "-"}').alias("p")).collect()[0].p
    assert out == "Q: q? D: b E: none M: -"
    with pytest.raises(E.TesseraError):
        render(df.schema, "${missing}")


def test_system_prompt(spark):
    df = spark.createDataFrame([("R", "I"), ("", None), (None, "I")], "r string, i string")
    got = [r.p for r in df.select(system_prompt("r", "i").alias("p")).collect()]
    assert got == ["# Role\nR\n\n## Instructions\nI", "You are a helpful assistant.", "## Instructions\nI"]


def test_html_to_text(spark):
    html = ('<html><head><title>T</title><style>p{}</style></head><body class="x"><!-- c -->'
            '<script>var a="<p>";</script><p>Hello <b>wor</b>ld &amp; &quot;you&quot;</p><div>next</div>'
            '</body></html>')
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(X.html_to_text("h").alias("t")).collect()[0].t == 'Hello world & "you" next'


def test_html_to_markdown(spark):
    html = ('<html><body><h1>Title</h1><p>Some <b>bold</b> and <em>it</em> with '
            '<a href="/x">a link</a>.</p><ul><li>one</li><li>two</li></ul>line<br>break</body></html>')
    df = spark.createDataFrame([(html,)], "h string")
    md = df.select(X.html_to_markdown("h").alias("m")).collect()[0].m
    assert md == "# Title\n\nSome **bold** and *it* with [a link](/x).\n\n- one\n- two\nline\nbreak"


def test_attachment_and_user_message_parts(spark):
    from tessera.functions.prompt import attachment_parts, user_message_parts
    rows = [("hi", '{"type": "text/plain", "content": "doc"}'),
            ("", '[{"type": "IMAGE/png", "content": "b64"}, {"content": "no type"}, '
                 '{"type": "application/zip", "content": "z"}]'),
            ("only prompt", None)]
    df = spark.createDataFrame(rows, "p string, a string")
    att = [[tuple(x) for x in r.parts] for r in df.select(attachment_parts("a").alias("parts")).collect()]
    assert att == [[("TEXT", "doc", None)], [("IMAGE", "b64", "IMAGE/png")], []]
    msg = [[tuple(x) for x in r.parts] for r in df.select(user_message_parts("p", "a").alias("parts")).collect()]
    assert msg[0] == [("TEXT", "hi", None), ("TEXT", "doc", None)]
    assert msg[1] == [("IMAGE", "b64", "IMAGE/png")]      # empty prompt adds no part
    assert msg[2] == [("TEXT", "only prompt", None)]


def test_coerce_output(spark):
    from tessera.operators.infer import coerce_output
    rows = [(" 42 ", "integer"), ("4.2", "integer"), ("4.5", "Float"), (" TRUE ", "boolean"),
            ("yes", "boolean"), ("text", "string"), ("{}", "json")]
    df = spark.createDataFrame(rows, "a string, t string")
    cols = coerce_output("a", "t")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in cols.items()]).collect()]
    assert got[0][0] == 42 and got[0][4] is None
    assert got[1][0] is None and got[1][4] == "701173"          # not an integer
    assert abs(got[2][1] - 4.5) < 1e-6
    assert got[3][2] is True and got[4][2] is False             # only "true" is true
    assert got[5][3] == "text" and got[6][4] == "701173"         # unknown output type


HTML_CASES = [
    ("<p>Hello</p>", "Hello"),
    ("plain &amp; simple", "plain & simple"),
    ("<html><head><title>T</title></head><p>No body tag</p>", "No body tag"),
    ("<header>kept</header> text", "kept text"),
    ("<body>it&#8217;s &mdash; caf&eacute; &#x27;x&#X27; &hellip;</body>", "it’s — café 'x' …"),
    ("<body>&amp;lt; &amp;#65; &unknown; a&b &; &#0;</body>", "&lt; &#65; &unknown; a&b &; �"),
    ('<body><a title="x > y" href=\'a>b\'>link</a> <b data-x="1>2">bold</b></body>', "link bold"),
    ("<body>a&nbsp;&nbsp;b<br>c<script>var x = '<p>';</script></body>", "a b c"),
    ("<BODY class=x>&#128512;&NotEqualTilde;</BODY> after", "😀≂̸"),
    ("<body></body>", ""),
    (None, None),
    ("<body>&#0000000065;&#x0000000042;&#99999999999;&#xFFFFFFFFFF;</body>", "AB\ufffd\ufffd"),
    ("a < b and <3 </ c", "a < b and <3"),
    ("x<b ", "x"),
    ("one<!-- two > <p>three", "one"),
    ("<p>a</p><script>if (x</p>) '</scripts>'", "a"),
    ('<!-- <body> --><body>real <img alt=it\'s src="a>b">end</body>', "real end"),
    ("<script>'<body>'</script><body>x<SCRIPT type=a>y</SCRIPT >z", "x z"),
]

MARKDOWN_CASES = [
    ("<ul><li>a<ul><li>b</li><li>c<ol><li>x</li><li>y</li></ol></li></ul></li><li>d</li></ul>", "- a\n  - b\n  - c\n    1. x\n    2. y\n\n- d"),
    ("<ol><li>one</li><li>two <b>bold</b></li></ol>end", "1. one\n2. two **bold**\nend"),
    ("<pre>  a\n   b &lt; c\n\n\n\td</pre> after", "```\n  a\n   b < c\n\n\n\td\n```\nafter"),
    ('<a title="x > y" href="/p?a>b">link</a> 1 &lt; 2 <b data-x="1>2">bold</b>', "[link](/p?a>b) 1 < 2 **bold**"),
    ("<a href='q'>single</a> <a name=x>anchor</a>", "[single](q) anchor"),
    ("<p><b>never closed<br>x", "never closed\nx"),
    ("<b>a</strong> <i>b</em> c</i>", "**a** *b* c"),
    ("<h2>Two</h2>text<h3>open", "## Two\n\ntext open"),
    ("</ul></pre></a></b>loose ends", "loose ends"),
    ("", ""),
    (None, None),
]

# Parts of pages that never end, or are very long: (page, text, Markdown); None where only the time counts.
LARGE_PAGES = [
    ("<p>x</p><img src=data:" + "a" * 5_000_000, "x", "x"),
    ("<p>x</p><img src='" + "a>" * 2_500_000 + "'>" + "<p>y</p>" * 50_000, "x " + "y " * 49_999 + "y", "x\n\n" + "y\n\n" * 49_999 + "y"),
    ("x<b " + "c" * 1_000_000, "x", "x"),
    ("<a " + "k=v " * 20_000 + ">z", "z", "z"),
    *[(part * 100_000, None, None) for part in ("<b ", "<a '", "<!--", "<script>", "<", "<title><", '<a href="', "</body", "&#", "&lt", "<!- ")],
    ("<ul><li>" * 2000 + "deep", None, None),
]


def test_html_to_text_expected_by_hand(spark):
    from tessera.functions.text import html_to_text
    df = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(HTML_CASES)], "k int, html string")
    got = {r.k: r.t for r in df.select("k", html_to_text("html").alias("t")).collect()}
    assert got == {k: t for k, (_, t) in enumerate(HTML_CASES)}


def test_html_to_markdown_expected_by_hand(spark):
    df = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(MARKDOWN_CASES)], "k int, html string")
    got = {r.k: r.t for r in df.select("k", X.html_to_markdown("html").alias("t")).collect()}
    assert got == {k: t for k, (_, t) in enumerate(MARKDOWN_CASES)}


def test_lists_go_on_over_blocks_of_the_fold(spark, monkeypatch):
    page = "<ol>" + "".join(f"<li>item <b>{k}</b><ul><li>sub</li></ul></li>" for k in range(90)) + "</ol>"
    df = spark.createDataFrame([(page,)], "html string")
    whole = df.select(X.html_to_markdown("html")).first()[0]
    monkeypatch.setattr(X, "_STEP", 7)
    assert df.select(X.html_to_markdown("html")).first()[0] == whole
    assert whole.startswith("1. item **0**\n  - sub\n\n2. item **1**") and "90. item **89**" in whole


@pytest.mark.parametrize("case", range(len(LARGE_PAGES)))
def test_large_and_broken_pages_take_linear_time(spark, case):
    page, text, markdown = LARGE_PAGES[case]
    df = spark.createDataFrame([(page,)], "html string")
    began = time.time()
    got = df.select(X.html_to_text("html").alias("t"), X.html_to_markdown("html").alias("m")).first()
    assert time.time() - began < 30
    assert text is None or (got.t, got.m) == (text, markdown)


def test_filter_equality_is_of_texts_and_order_of_exact_numbers(spark):
    from tessera.functions.filters import compile_filter
    values = ["9007199254740992", "9007199254740993", "1", "1.0", "1_000", "nan", "inf", "-2.5", "10", "abc", None]
    df = spark.createDataFrame([(v,) for v in values], "v string").selectExpr("v", "map('k', v) AS metadata")

    def hits(op, value):
        return [r.v for r in df.where(compile_filter(f'metadataKey("k").{op}("{value}")')).collect()]
    assert hits("isEqualTo", "9007199254740993") == ["9007199254740993"]
    assert hits("isEqualTo", "1") == ["1"] == hits("isIn", "1")
    assert "1.0" in hits("isNotEqualTo", "1") and None in hits("isNotEqualTo", "1")
    assert hits("isGreaterThan", "9007199254740992") == ["9007199254740993", "nan", "inf", "abc"]
    assert set(hits("isLessThanOrEqualTo", "1.00")) == {"1", "1.0", "-2.5"}


def test_plain_numbers_of_any_length_are_in_order(spark):
    from decimal import Decimal
    texts = ["0", "-0", "+0.0", "1", "01", "1.0", "1.5", "1.45", "-1", "-1.5", "-1.45", "-10", "10", "9", "-9", "1" + "0" * 24, "-1" + "0" * 24, "9" * 40, "0." + "0" * 30 + "1",
             "-0." + "0" * 30 + "1", "123456789012345678901234567890.5", "123456789012345678901234567890.49"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").selectExpr("v", "map('k', v) AS metadata")
    for lit in texts:
        for op, holds in (("isGreaterThan", lambda a, b: a > b), ("isLessThan", lambda a, b: a < b), ("isGreaterThanOrEqualTo", lambda a, b: a >= b), ("isLessThanOrEqualTo", lambda a, b: a <= b)):
            got = {r.v for r in df.where(compile_filter(f'metadataKey("k").{op}("{lit}")')).collect()}
            assert got == {t for t in texts if holds(Decimal(t), Decimal(lit))}, (op, lit)
