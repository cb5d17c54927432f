"""String expressions (all native: regexp_replace / md5 / concat ...).

Patterns avoid look-arounds and back-references so that they mean the same
in Java regex and in RE2, which keeps the SQL oracle honest.
"""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def jtrim(x) -> Column:
    """Trim all leading/trailing whitespace (not only blanks)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


# A character reference: by decimal or hexadecimal number, or by name.
_REFERENCE = r"&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]{1,31});"


# The usual references, for texts that hold no others; the ampersand's comes
# last, so that nothing is decoded twice.
_COMMON = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _entity_names() -> Column:
    """The HTML5 names (the standard library's table) with a closing semicolon,
    filed under their first letters, as a look-up walks through a map."""
    filed: dict[str, dict[str, str]] = {}
    for name, character in html5.items():
        if name.endswith(";"):
            filed.setdefault(name[0], {})[name[:-1]] = character
    return F.from_json(F.lit(json.dumps(filed)), "map<string,map<string,string>>")  # folded to a constant


def _character(code: Column) -> Column:
    """The character of a code point; that of an invalid one is U+FFFD."""
    bad = code.isNull() | (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(code).cast("bigint")), 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Every character reference replaced once, from left to right, so that what a
    decoded text says is not decoded again; unknown names stay.  A no-break
    space becomes a space."""
    names = _entity_names()

    def one(x: Column) -> Column:
        body = F.substring(x, 2, F.length(x) - 2)
        digits = F.regexp_replace(body, "^#[xX]?0*", "")  # any more than eight are no character's
        number = F.when(F.length(digits) <= 8, F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)).try_cast("bigint")
        return F.when(body.startswith("#"), _character(number)).otherwise(F.coalesce(names[F.substring(body, 1, 1)][body], x))

    few = c
    for name, character in _COMMON:
        few = F.replace(few, F.lit(name), F.lit(character))
    others = c.rlike("&(?!" + "|".join(n[1:] for n, _ in _COMMON) + ")[A-Za-z#]")
    parts = F.regexp_extract_all(c, F.lit("(?s)" + _REFERENCE + "|[^&]+|&"), F.lit(0))
    whole = F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^" + _REFERENCE + "$"), one(x)).otherwise(x)), "")
    return (F.when(~c.contains("&"), c).when(~others, few)
            .otherwise(F.replace(whole, F.lit("\u00a0"), F.lit(" "))))


# Inline elements whose tags vanish without a separating space.
INLINE_TAGS = "b|i|em|strong|a|span|u|code|small|sub|sup"
# Block elements whose end starts a new line in Markdown.
BLOCK_TAGS = "ul|ol|div|article|section|nav|header|footer|table|tr|blockquote|pre"


# Parts of a page.  Every quantifier over a choice is possessive and every part ends at its
# end mark or at the end of the page, so each pattern reads a page once, from
# left to right, without going back and without a stack of its own.
_INSIDE = r"(?:[^>=\"']++|=\s*+(?:\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))?+|[\"'])*+(?:>|\z)"
_COMMENT = r"<!--(?:[^-]++|-(?!->))*+(?:-->|\z)"
_TAG = r"</?+[A-Za-z]" + _INSIDE
_DECLARATION = r"<[!?/](?:[^>]*+)(?:>|\z)"


def _raw(name: str) -> str:
    """An element whose content is no markup, or isn't shown: to its own end tag."""
    return rf"<{name}(?=[\s/>]){_INSIDE}(?:[^<]++|<(?!/{name}[\s/>]))*+(?:</{name}{_INSIDE}|\z)"


_HIDDEN = "|".join([_COMMENT, *[_raw(n) for n in ("script", "style", "title", "head")]])
_MARKUP = f"(?:{_HIDDEN}|{_TAG}|{_DECLARATION})"


def _body(html: Column) -> Column:
    """What is between the body tags; a text without them is all body but for its head."""
    def until(tag: str) -> str:
        return rf"(?is)\A((?:[^<]++|{_HIDDEN}|(?!{tag}[\s/>])(?:{_TAG}|{_DECLARATION})|<(?![A-Za-z!?/]))*+){tag}(?=[\s/>])"
    c = F.regexp_replace(html, until("<body") + _INSIDE, "")
    return F.regexp_replace(c, until("</body") + r".*+", "$1")


def html_to_text(html) -> Column:
    """Visible text of the body: inline tags vanish, other tags become a space,
    entities are decoded, whitespace collapses, result is trimmed.  Quoted attribute values may hold
    ">"; a tag, comment or script that never ends takes the rest of the page."""
    c = _body(_c(html))
    c = F.regexp_replace(c, rf"(?is)</?+(?:{INLINE_TAGS})(?=[\s/>]){_INSIDE}|({_MARKUP})", "$1")
    # Spark evaluates what several branches name once a branch, so the text is given a name of its own.
    c = _once(F.regexp_replace(c, "(?is)" + _MARKUP, " "), decode_entities)
    c = F.regexp_replace(c, r"\s+", " ")
    return F.trim(c)


# Blanks, newlines and tabs that Markdown must keep, until all others are collapsed: three
# code points that are no characters.
_KEPT = [(" ", "\ufdd0"), ("\n", "\ufdd1"), ("\t", "\ufdd2")]
_STEP = 128  # tokens of a block of the fold


def _tokens(body: Column) -> Column:
    """The page as ``name`` (lower case; null for text), ``end`` (is an end tag) and ``text`` (with references
    decoded, or the tag itself)."""
    parts = F.regexp_extract_all(body, F.lit(rf"(?is){_MARKUP}|[^<]++|<"), F.lit(0))

    def token(t: Column) -> Column:
        markup = t.rlike(r"^<[A-Za-z!?/]")
        name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
        return F.struct(F.when(markup, name).alias("name"), t.startswith("</").alias("end"), F.when(markup, t).otherwise(decode_entities(t)).alias("text"))
    return F.transform(parts, token)


def _one_of(x: Column, names: str) -> Column:
    return F.coalesce(x["name"].isin(names.split("|")), F.lit(False))


# Elements that Markdown marks on both sides, so only where their end is there.
_PAIRED = {"strong": "b|strong", "em": "i|em", "a": "a", **{f"h{n}": f"h{n}" for n in range(1, 7)}}


def _last_ends(tokens: Column) -> Column:
    """Position of the last end tag of each paired kind (-1: none)."""
    start = F.struct(*[F.lit(-1).alias(k) for k in _PAIRED], F.lit(0).alias("at"))
    return F.aggregate(tokens, start, lambda s, x: F.struct(
        *[F.when(x["end"] & _one_of(x, names), s["at"]).otherwise(s[k]).alias(k) for k, names in _PAIRED.items()], (s["at"] + 1).alias("at")))


def _state() -> Column:
    none = F.expr("cast(array() as array<int>)")
    return F.struct(F.lit(0).alias("at"), F.lit(False).alias("strong"), F.lit(False).alias("em"), F.lit(None).cast("string").alias("link"),
                    none.alias("lists"), F.lit(0).alias("pre"))


def _href(x: Column) -> Column:
    found = F.regexp_extract(x["text"], r"(?i)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", 0)
    return F.when(found != "", F.regexp_replace(found, r"(?s)^[^=]*=\s*.|.$", ""))


def _next(s: Column, x: Column, ends: Column) -> Column:
    """State after a token: its position, open marks, the open link's target, open lists (items so far, -1
    where they have no numbers) and open ``pre`` elements."""
    def mark(kind):
        mine = _one_of(x, _PAIRED[kind])
        return F.when(mine & x["end"], F.lit(False)).when(mine, s[kind] | (s["at"] < ends[kind])).otherwise(s[kind]).alias(kind)
    lists, is_list, n = s["lists"], _one_of(x, "ul|ol"), F.size(s["lists"])
    item = _one_of(x, "li") & ~x["end"] & (n > 0) & (F.element_at(F.concat(F.array(F.lit(-1)), lists), -1) >= 0)
    stack = (F.when(is_list & x["end"], F.slice(lists, 1, F.greatest(n - 1, F.lit(0))))
             .when(is_list, F.concat(lists, F.array(F.when(x["name"] == "ol", 0).otherwise(-1))))
             .when(item, F.concat(F.slice(lists, 1, n - 1), F.array(F.element_at(lists, -1) + 1))).otherwise(lists))
    link = (F.when(_one_of(x, "a") & x["end"], F.lit(None).cast("string"))
            .when(_one_of(x, "a") & s["link"].isNull() & (s["at"] < ends["a"]), _href(x)).otherwise(s["link"]))
    pre = F.when(_one_of(x, "pre"), F.greatest(s["pre"] + F.when(x["end"], -1).otherwise(1), F.lit(0))).otherwise(s["pre"])
    return F.struct((s["at"] + 1).alias("at"), mark("strong"), mark("em"), link.alias("link"), stack.alias("lists"), pre.alias("pre"))


def _written(s: Column, x: Column, t: Column, ends: Column) -> Column:
    """What a token gives, from the state before (``s``) and after it (``t``)."""
    kept = x["text"]
    for plain, stand_in in _KEPT:
        kept = F.replace(kept, F.lit(plain), F.lit(stand_in))
    indent = F.repeat(F.lit(_KEPT[0][1]), 2 * F.greatest(F.size(t["lists"]) - 1, F.lit(0)))
    count = F.element_at(F.concat(F.array(F.lit(-1)), t["lists"]), -1)
    bullet = F.when(count > 0, F.concat(count.cast("string"), F.lit(". "))).otherwise(F.lit("- "))
    out = F.when(x["name"].isNull(), F.when(s["pre"] > 0, kept).otherwise(x["text"]))
    for n in range(1, 7):
        heading = _one_of(x, f"h{n}")
        out = out.when(heading & x["end"], F.lit("\n\n")).when(heading & (s["at"] < ends[f"h{n}"]), F.lit("\n\n" + "#" * n + " "))
    for kind, sign in (("strong", "**"), ("em", "*")):
        out = out.when(_one_of(x, _PAIRED[kind]), F.when(s[kind] != t[kind], F.lit(sign)).otherwise(F.lit(" ")))
    return (out.when(_one_of(x, "a"), F.when(s["link"].isNull() & t["link"].isNotNull(), F.lit("["))
                     .when(s["link"].isNotNull() & t["link"].isNull(), F.concat(F.lit("]("), s["link"], F.lit(")"))).otherwise(F.lit(" ")))
            .when(_one_of(x, "br"), F.lit("\n"))
            .when(_one_of(x, "li") & ~x["end"], F.concat(F.lit("\n"), indent, bullet))
            .when(_one_of(x, "p"), F.lit("\n\n"))
            .when(_one_of(x, "pre"), F.when((s["pre"] == 0) & (t["pre"] == 1), F.lit("\n\n```" + _KEPT[1][1])).when((s["pre"] == 1) & (t["pre"] == 0), F.lit(_KEPT[1][1] + "```\n")).otherwise(F.lit("\n")))
            .when(x["end"] & _one_of(x, BLOCK_TAGS), F.lit("\n")).otherwise(F.lit(" ")))


def _once(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _markdown_pieces(body: Column) -> Column:
    """What all tokens give, joined.  The state at the begin of every block of tokens comes first, by a fold
    that writes nothing; then each block is folded with its output, so the work is
    linear and no long text is copied at every token."""
    def fold(tokens: Column) -> Column:
        return _once(F.struct(tokens.alias("t"), _last_ends(tokens).alias("e")), lambda both: blocks(both["t"], both["e"]))

    def blocks(tokens: Column, ends: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(_STEP))

        def advance(acc: Column, k: Column) -> Column:
            after = F.aggregate(F.slice(tokens, k, _STEP), acc["now"], lambda s, x: _next(s, x, ends))
            return F.struct(after.alias("now"), F.concat(acc["all"], F.array(acc["now"])).alias("all"))
        empty = F.array_remove(F.array(_state()), _state())
        states = F.aggregate(starts, F.struct(_state().alias("now"), empty.alias("all")), advance, lambda acc: acc["all"])

        def write(start: Column, state: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                return _once(_next(acc["s"], x, ends), lambda t: F.struct(t.alias("s"), F.concat(acc["out"], F.array(_written(acc["s"], x, t, ends))).alias("out")))
            first = F.struct(state.alias("s"), F.expr("cast(array() as array<string>)").alias("out"))
            return F.aggregate(F.slice(tokens, start, _STEP), first, step, lambda acc: F.array_join(acc["out"], ""))
        return F.array_join(F.zip_with(starts, states, write), "")
    return _once(_tokens(body), fold)


def html_to_markdown(html) -> Column:
    """Markdown rendering of the body: h1-h6, p, br, li (nested lists are indented, those of ``ol`` numbered), a,
    b/strong, i/em, pre.  A mark that is never closed is left out."""
    c = _markdown_pieces(_body(_c(html)))
    c = F.regexp_replace(c, r"[ \t\r\f]+", " ")
    c = F.regexp_replace(c, r" ?\n ?", "\n")
    c = F.regexp_replace(c, r"\n\n\n+", "\n\n")
    c = jtrim(c)
    for plain, stand_in in _KEPT:
        c = F.replace(c, F.lit(stand_in), F.lit(plain))
    return F.when(_c(html).isNotNull(), c)


def content_uuid(text) -> Column:
    """Name-based (MD5, version 3) UUID of the UTF-8 text."""
    def grouped(h: Column) -> Column:
        variant = F.substring(F.lit("89ab"),
                              (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, 1)
        return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"),
                        F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3),
                        F.lit("-"), F.substring(h, 21, 12))
    return _once(F.md5(F.encode(_c(text), "UTF-8")), grouped)


# The pattern of a summary in a model's answer, and that of a
# comma to drop from JSON arguments.
SUMMARY = r"(?s)<summary>\s*(.+?)\s*</summary>"
TRAILING_COMMA = r",(\s*[}\]])"


def summary_extract(text) -> Column:
    """First ``<summary>`` body (trimmed); no tag -> whole trimmed text; NULL -> ''."""
    t = _c(text)
    return (F.when(t.isNull() | (F.length(t) == 0), F.lit(""))
            .when(t.rlike(SUMMARY), F.regexp_extract(t, SUMMARY, 1))
            .otherwise(jtrim(t)))


def summary_of(answer: str | None) -> str:
    """The same for one text, inside a task."""
    found = re.search(SUMMARY, answer or "", re.ASCII)
    return found[1] if found else (answer or "").strip(" \t\n\r\f\v")


def repair_json_args(args) -> Column:
    """Drop a trailing comma before ``}`` or ``]``."""
    return F.regexp_replace(_c(args), TRAILING_COMMA, "$1")


def tool_args_map(args) -> Column:
    return F.from_json(repair_json_args(args), "map<string,string>")


def normalize_tool_name(name) -> Column:
    return F.regexp_replace(_c(name), r"\s", "_")


def is_blank(x) -> Column:
    return F.coalesce(jtrim(_c(x)) == "", F.lit(True))


def session_default(session) -> Column:
    """Blank or NULL session id -> ``default``."""
    s = _c(session)
    return F.when(F.length(F.coalesce(s, F.lit(""))) == 0, F.lit("default")).otherwise(s)


def word_count(text) -> Column:
    """Number of blank-separated words of a trimmed text (0 for empty)."""
    t = F.trim(_c(text))
    return F.when(F.coalesce(F.length(t), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.size(F.split(t, " ")))


def flatten_metadata(metadata, prefix: str = "meta_") -> Column:
    """The map with prefixed keys and '' for NULL values."""
    return F.transform_values(F.transform_keys(_c(metadata), lambda k, v: F.concat(F.lit(prefix), k)),
                              lambda k, v: F.coalesce(v, F.lit("")))
