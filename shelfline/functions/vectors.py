"""Vector column expressions: dot products and cosine with higher-order
functions (JVM side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.functions.columns import col_


def as_doubles(v) -> Column:
    return F.transform(col_(v), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    """Sum of element products, accumulated in DOUBLE."""
    prods = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """cos(a, b); null when either norm is 0.  Pass precomputed norms to
    avoid recomputing them per pair."""
    na = norm_a if norm_a is not None else norm(a)
    nb = norm_b if norm_b is not None else norm(b)
    den = na * nb
    return dot(a, b) / F.when(den != 0, den)
