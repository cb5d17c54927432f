"""Vector expressions as native (JVM) higher-order functions.

PySpark ships no vector functions, so dot products are ``zip_with`` +
``aggregate`` over ARRAY<FLOAT>, always accumulated in DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Inner product of two equally long arrays, in DOUBLE."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def l2_norm(a) -> Column:
    sq = F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def normalize(a, as_float: bool = True) -> Column:
    """Unit-normalise; NULL for a zero or empty vector (callers quarantine it)."""
    n = l2_norm(a)
    t = "float" if as_float else "double"
    return F.when(n > 0, F.transform(_c(a), lambda x: (x.cast("double") / n).cast(t)))


def cosine(a, b) -> Column:
    """NULL where a vector is zero, also in ANSI mode."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def relevance(cos: Column) -> Column:
    """Cosine mapped to [0, 1]: (1 + cos) / 2."""
    return (F.lit(1.0) + cos) / F.lit(2.0)
