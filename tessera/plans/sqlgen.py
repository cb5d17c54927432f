"""Small helpers for writing the DuckDB oracle text."""

from __future__ import annotations

# What the fixture's pages hold, stated apart from the code under test.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]
INLINE_TAGS = "b|i|em|strong|a|span|u|code|small|sub|sup"
BLOCK_TAGS = "ul|ol|div|article|section|nav|header|footer|table|tr|blockquote|pre"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def entities(expr: str) -> str:
    for ent, ch in ENTITIES:
        expr = f"replace({expr}, {q(ent)}, {q(ch)})"
    return expr


def body(expr: str) -> str:
    e = rx(expr, r"(?is)^.*?<body[^>]*>", "")
    e = rx(e, r"(?is)</body>.*$", "")
    e = rx(e, r"(?s)<!--.*?-->", " ")
    e = rx(e, r"(?is)<head(\s[^>]*)?>.*?</head>", " ")
    e = rx(e, r"(?is)<title[^>]*>.*?</title>", " ")
    e = rx(e, r"(?is)<script[^>]*>.*?</script>", " ")
    return rx(e, r"(?is)<style[^>]*>.*?</style>", " ")


def html_text(expr: str) -> str:
    e = body(expr)
    e = rx(e, r"(?i)</?(" + INLINE_TAGS + r")(\s[^>]*)?/?>", "")
    e = rx(e, r"<[^>]*>", " ")
    e = entities(e)
    e = rx(e, r"\s+", " ")
    return f"trim({e})"


def html_markdown(expr: str) -> str:
    e = body(expr)
    for n in range(1, 7):
        e = rx(e, rf"(?is)<h{n}[^>]*>(.*?)</h{n}>", "\n\n" + "#" * n + " \\1\n\n")
    e = rx(e, r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', "[\\2](\\1)")
    e = rx(e, r"(?is)<(b|strong)(\s[^>]*)?>(.*?)</(b|strong)>", "**\\3**")
    e = rx(e, r"(?is)<(i|em)(\s[^>]*)?>(.*?)</(i|em)>", "*\\3*")
    e = rx(e, r"(?i)<br\s*/?>", "\n")
    e = rx(e, r"(?i)<li(\s[^>]*)?>", "\n- ")
    e = rx(e, r"(?i)</?p(\s[^>]*)?>", "\n\n")
    e = rx(e, r"(?i)</(" + BLOCK_TAGS + r")\s*>", "\n")
    e = rx(e, r"<[^>]*>", " ")
    e = entities(e)
    e = rx(e, r"[ \t\r\f]+", " ")
    e = rx(e, r" ?\n ?", "\n")
    e = rx(e, r"\n\n\n+", "\n\n")
    return jtrim(e)


def jtrim(expr: str) -> str:
    return rx(expr, r"^\s+|\s+$", "")


def uuid3(expr: str) -> str:
    h = f"md5({expr})"
    return (f"substr({h},1,8)||'-'||substr({h},9,4)||'-3'||substr({h},14,3)||'-'||"
            f"substr('89ab', (('0x'||substr({h},17,1))::INTEGER % 4) + 1, 1)||substr({h},18,3)||'-'||"
            f"substr({h},21,12)")


# -- splitter oracle ---------------------------------------------------------
# The same contract as tessera.operators.split, written for DuckDB: RE2 has
# no look-behind, so the sentence split marks "[.!?] + whitespace" with
# chr(1) and splits on the mark.

def _split_level(expr: str, level: str) -> str:
    if level == "paragraph":
        return f"regexp_split_to_array({expr}, {q(chr(10) + r'\s*' + chr(10))})"
    if level == "line":
        return f"string_split({expr}, chr(10))"
    if level == "sentence":
        return f"string_split(regexp_replace({expr}, {q(r'([.!?])\s+')}, '\\1' || chr(1), 'g'), chr(1))"
    return f"regexp_split_to_array({expr}, {q(r'\s+')})"


def split_sql(strategy: str, mx: int, ov: int, source: str = "documents") -> str:
    from tessera.operators.split import LEVELS, STRATEGIES

    ctes = [f"l0 AS (SELECT doc_id, [{{'t': text, 'j': ''}}] AS p FROM {source})"]
    prev = "l0"
    for n, level in enumerate(STRATEGIES[strategy], start=1):
        joiner = LEVELS[level][1]
        sub = _split_level(jtrim("x.t"), level)
        body = (f"flatten(list_transform(p, lambda x: CASE WHEN length(x.t) <= {mx} THEN [x] ELSE "
                f"list_transform({sub}, lambda s, i: {{'t': s, 'j': CASE WHEN i = 1 THEN x.j ELSE {q(joiner)} END}}) END))")
        ctes.append(f"l{n} AS (SELECT doc_id, {body} AS p FROM {prev})")
        prev = f"l{n}"
    cut = (f"flatten(list_transform(p, lambda x: CASE WHEN length(x.t) <= {mx} THEN [x] ELSE "
           f"list_transform(range(0, (length(x.t) - 1) // {mx} + 1), lambda i: "
           f"{{'t': substr(x.t, i * {mx} + 1, {mx}), 'j': CASE WHEN i = 0 THEN x.j ELSE '' END}}) END))")
    ctes.append(f"cut AS (SELECT doc_id, list_filter(list_transform({cut}, lambda x: {{'t': {jtrim('x.t')}, 'j': x.j}}),"
                f" lambda x: length(x.t) > 0) AS p FROM {prev})")
    step = (f"CASE WHEN acc.n > 0 AND acc.cur + x.jl + x.len <= {mx} "
            f"THEN {{'cur': acc.cur + x.jl + x.len, 'start': acc.start, 'n': acc.n + 1, 'closed': acc.closed}} "
            f"ELSE {{'cur': x.len, 'start': x.i, 'n': 1, 'closed': CASE WHEN acc.n > 0 THEN "
            f"list_append(acc.closed, {{'start': acc.start, 'n': acc.n}}) ELSE acc.closed END}} END")
    ctes.append(
        "packed AS (SELECT doc_id, p, list_reduce(list_transform(p, lambda x, i: "
        "{'len': length(x.t), 'jl': length(x.j), 'i': i - 1}), lambda acc, x: " + step +
        ", {'cur': 0, 'start': -1, 'n': 0, 'closed': []::STRUCT(start BIGINT, n BIGINT)[]}) AS st FROM cut)")
    ctes.append("bounds AS (SELECT doc_id, p, CASE WHEN st.n > 0 THEN list_append(st.closed, {'start': st.start, 'n': st.n}) "
                "ELSE st.closed END AS b FROM packed)")
    ctes.append("segs AS (SELECT doc_id, list_transform(b, lambda y: array_to_string(list_transform("
                "p[y.start + 1 : y.start + y.n], lambda x, k: CASE WHEN k = 1 THEN x.t ELSE x.j || x.t END), '')) AS s "
                "FROM bounds)")
    ctes.append("rows AS (SELECT doc_id, s[k] AS cur, CASE WHEN k > 1 THEN s[k - 1] END AS prev, (k - 1)::INTEGER AS idx "
                "FROM segs, unnest(range(1, len(s) + 1)) AS u(k))")
    if ov > 0:
        ctes.append("ov AS (SELECT *, list_reverse(" + _split_level("prev", "sentence") + ") AS sents, "
                    f"least({ov}, {mx} - 1 - length(cur)) AS lim FROM rows)")
        ctes.append("ov2 AS (SELECT *, CASE WHEN prev IS NULL THEN 0 ELSE len(list_filter(range(1, len(sents) + 1), "
                    "lambda m: list_sum(list_transform(sents[1:m], lambda s: length(s))) + m - 1 <= lim)) END AS c FROM ov)")
        final = ("SELECT doc_id, idx AS index, CASE WHEN c > 0 THEN array_to_string(list_reverse(sents[1:c]), ' ') "
                 "|| ' ' || cur ELSE cur END AS text FROM ov2")
    else:
        final = "SELECT doc_id, idx AS index, cur AS text FROM rows"
    return ("WITH " + ",\n".join(ctes) + f",\nout AS ({final})\n"
            "SELECT doc_id, index, text, NULL::VARCHAR AS error_code FROM out\n"
            f"UNION ALL SELECT doc_id, NULL::INTEGER, NULL::VARCHAR, '701152' FROM {source} "
            "WHERE doc_id NOT IN (SELECT doc_id FROM out)")


def extractive_answer(expr: str) -> str:
    """SQL twin of ``plans.standin.extractive_answer_factory``."""
    paras = (f"list_filter(list_transform(regexp_split_to_array({expr}, {q(chr(10) + r'\s*' + chr(10))}), "
             f"lambda x: {jtrim('x')}), lambda x: length(x) > 0)")
    last = f"coalesce(({paras})[-1], '')"
    first = f"string_split(regexp_replace({last}, {q(r'([.!?])\s+')}, '\\1' || chr(1), 'g'), chr(1))[1]"
    return (f"'<analysis>extractive</analysis>' || chr(10) || '<summary>' || chr(10) || {first} "
            f"|| chr(10) || '</summary>'")


def summary_of(expr: str) -> str:
    pat = q(r"(?s)<summary>\s*(.+?)\s*</summary>")
    return (f"CASE WHEN {expr} IS NULL OR length({expr}) = 0 THEN '' "
            f"WHEN regexp_matches({expr}, {pat}) THEN regexp_extract({expr}, {pat}, 1) ELSE {jtrim(expr)} END")
