"""Scalar column expressions (C-series), all built-in and codegen-friendly.

Money is carried as DECIMAL(18,2) and discounts as DECIMAL(4,2) so sums are
exact and independent of partitioning; ratios are divided as DOUBLE, pinned
to DECIMAL(18,9) and then rounded half-up, which gives the same digits in any
engine.  Outputs leave as DOUBLE taken from the rounded decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
DISC = T.DecimalType(4, 2)
RATIO = T.DecimalType(18, 9)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return col_(c).cast(MONEY)


def discount(c) -> Column:
    return col_(c).cast(DISC)


def as_double(c) -> Column:
    return col_(c).cast(T.DoubleType())


def rounded_dec(c, scale: int) -> Column:
    """Half-up rounding through DECIMAL(18,9), kept as DECIMAL (exact sums)."""
    return F.round(col_(c).cast(RATIO), scale)


def rounded(c, scale: int) -> Column:
    """Half-up rounding through DECIMAL(18,9), returned as DOUBLE."""
    return rounded_dec(c, scale).cast(T.DoubleType())


def money_out(c, scale: int = 2) -> Column:
    """A DECIMAL money value rounded half-up and returned as DOUBLE."""
    return F.round(col_(c), scale).cast(T.DoubleType())


def safe_ratio(num, den, scale: int) -> Column:
    """round(num / NULLIF(den, 0), scale); null when den is 0 or null."""
    d = as_double(den)
    return rounded(as_double(num) / F.when(d != 0, d), scale)


def week_ending(d) -> Column:
    """Saturday that ends the week containing date ``d`` (Sunday..Saturday)."""
    return F.next_day(F.date_sub(col_(d), 1), "Sat")


def month_start(d) -> Column:
    return F.trunc(col_(d), "month")


# Fixed value: the characters Python's str.split() treats as whitespace,
# spelled with \x{..} escapes so Java regex and RE2 read the class the same way.
WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def collapse_ws(c) -> Column:
    """C14: ``" ".join(s.split())`` — trim and collapse whitespace runs."""
    return F.trim(F.regexp_replace(col_(c), WS_CLASS + "+", " "))


# Anything but letters, marks and digits of any script separates terms.
TERM_SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"


def _term_line(c) -> Column:
    return F.lower(F.trim(F.regexp_replace(col_(c), TERM_SEPARATORS, " ")))


def terms_text(c) -> Column:
    """Text reduced to lower-case terms separated by one space, with a space
    on each side, so containment is word-aligned."""
    return F.concat(F.lit(" "), _term_line(c), F.lit(" "))


def terms(c) -> Column:
    """Array of the lower-case terms of a text, in any script (may hold '')."""
    return F.split(_term_line(c), " ")
