"""Metadata filter language compiled to a Spark Column on the driver.

Grammar (n-ary ``and`` / ``or``; quotes protect commas and parentheses)::

    filter  := logic | compare
    logic   := ("and" | "or") "(" filter ("," filter)+ ")" | "not" "(" filter ")"
    compare := 'metadataKey("' key '")' "." op "(" value ("," value)* ")"

Two-valued logic: a comparison on a missing key is false, except
``isNotEqualTo`` / ``isNotIn`` which are true; so ``not`` is exact.  Equality is
that of texts.  Order comparisons are numeric, by exact decimals, when both
sides are plain numbers (digits with an optional sign and fraction), else
textual.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

OPS = ("isEqualTo", "isNotEqualTo", "isGreaterThan", "isGreaterThanOrEqualTo", "isLessThan",
       "isLessThanOrEqualTo", "isIn", "isNotIn")

_TOKEN = re.compile(r'\s*(?:(?P<str>"(?:[^"\\]|\\.)*")|(?P<punct>[(),.])|(?P<word>[^\s(),."]+))')


class FilterSyntaxError(ValueError):
    pass


def _tokens(text: str) -> list[tuple[str, str]]:
    pos, out = 0, []
    text = text.strip()
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m or m.end() == pos:
            raise FilterSyntaxError(f"unexpected input at {pos}: {text[pos:pos + 20]!r}")
        pos = m.end()
        kind = m.lastgroup
        val = m.group(kind)
        if kind == "str":
            val = re.sub(r"\\(.)", r"\1", val[1:-1])
        out.append((kind, val))
    return out


class _Parser:
    def __init__(self, toks, map_col: Column):
        self.toks, self.i, self.m = toks, 0, map_col

    def peek(self):
        return self.toks[self.i] if self.i < len(self.toks) else (None, None)

    def take(self, kind=None, val=None):
        k, v = self.peek()
        if k is None or (kind and k != kind) or (val is not None and v != val):
            raise FilterSyntaxError(f"expected {val or kind}, got {v!r}")
        self.i += 1
        return v

    def filter(self) -> Column:
        k, v = self.peek()
        if k == "word" and v in ("and", "or", "not"):
            self.take()
            self.take("punct", "(")
            args = [self.filter()]
            while self.peek() == ("punct", ","):
                self.take()
                args.append(self.filter())
            self.take("punct", ")")
            if v == "not":
                if len(args) != 1:
                    raise FilterSyntaxError("not() takes exactly one operand")
                return ~args[0]
            if len(args) < 2:
                raise FilterSyntaxError(f"{v}() needs at least two operands")
            out = args[0]
            for a in args[1:]:
                out = (out & a) if v == "and" else (out | a)
            return out
        if k == "word" and v == "metadataKey":
            self.take()
            self.take("punct", "(")
            key = self.take("str")
            self.take("punct", ")")
            self.take("punct", ".")
            op = self.take("word")
            if op not in OPS:
                raise FilterSyntaxError(f"unknown comparison {op}")
            self.take("punct", "(")
            vals = [self.value()]
            while self.peek() == ("punct", ","):
                self.take()
                vals.append(self.value())
            self.take("punct", ")")
            if op not in ("isIn", "isNotIn") and len(vals) != 1:
                raise FilterSyntaxError(f"{op} takes one value")
            return compare(self.m[key], op, vals)
        raise FilterSyntaxError(f"unexpected {v!r}")

    def value(self) -> str:
        k, v = self.peek()
        if k in ("str", "word"):
            self.take()
            return v
        raise FilterSyntaxError(f"expected a value, got {v!r}")


_PLAIN = r"^[+-]?[0-9]+([.][0-9]+)?$"


def _number(text: Column) -> Column:
    """A key in the order of plain numbers of any length: sign, digits before the point, those
    digits, digits after it.  Negative numbers have their digits turned about (9 for 0), and an end mark above all digits."""
    whole = F.regexp_replace(F.regexp_extract(text, r"^[+-]?([0-9]*)", 1), "^0+", "")
    part = F.regexp_replace(F.regexp_extract(text, r"[.]([0-9]*)", 1), "0+$", "")
    minus = text.startswith("-")
    zero = (whole == "") & (part == "")
    turned = [F.translate(x, "0123456789", "9876543210") for x in (whole, part)]
    return F.struct(F.when(zero, 0).when(minus, -1).otherwise(1).alias("sign"), F.when(minus, -F.length(whole)).otherwise(F.length(whole)).alias("digits"),
                    F.when(minus, turned[0]).otherwise(whole).alias("whole"), F.when(minus & ~zero, F.concat(turned[1], F.lit("~"))).otherwise(part).alias("part"))


def compare(v: Column, op: str, vals: list[str]) -> Column:
    if op in ("isIn", "isNotIn"):
        hit = v.isin(*vals)
        return F.coalesce(hit, F.lit(False)) if op == "isIn" else F.coalesce(~hit, F.lit(True))
    lit = vals[0]
    if op in ("isEqualTo", "isNotEqualTo"):
        same = F.coalesce(v == F.lit(lit), F.lit(False))
        return same if op == "isEqualTo" else ~same

    def apply(a, b):
        return {"isGreaterThan": a > b, "isGreaterThanOrEqualTo": a >= b, "isLessThan": a < b, "isLessThanOrEqualTo": a <= b}[op]

    order = apply(v, F.lit(lit))
    if re.search(_PLAIN, lit):
        order = F.when(v.rlike(_PLAIN), apply(_number(v), _number(F.lit(lit)))).otherwise(order)
    return F.coalesce(order, F.lit(False))


def compile_filter(text: str | None, map_col: Column | str = "metadata") -> Column:
    """Compile filter text; empty / NULL text means no filter."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    if text is None or not text.strip():
        return F.lit(True)
    p = _Parser(_tokens(text), m)
    out = p.filter()
    if p.i != len(p.toks):
        raise FilterSyntaxError(f"trailing input after position {p.i}")
    return out
