"""Accounting-style numbers held as text.

Each rule is one chain of replacements over the text, so that plans stay small when many columns
are cleansed at once.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltline.functions.text import strip

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\z"
INTEGRAL = r"^([+-]?[0-9]+)(\.0*)?\z"


def loosen(c: Column) -> Column:
    """Drop NBSP, tabs, spaces, commas and dollar signs; brackets mean negative."""
    return F.regexp_replace(F.translate(strip(c), "\u00a0\t ,$", ""), r"(?s)^\((.+)\)\z", "-$1")


def numeric_text(c: Column) -> Column:
    """The castable token, or NULL when the text is not a plain number."""
    return F.nullif(F.regexp_extract(loosen(c), NUMBER, 0), F.lit(""))


def integer_like(c: Column) -> Column:
    """Digits, or digits followed by a dot and at least one zero."""
    return F.coalesce(loosen(c).rlike(r"^[+-]?[0-9]+(\.0+)?\z"), F.lit(False))


def rate_like(c: Column) -> Column:
    """A number with more than two digits after the dot."""
    return F.coalesce(loosen(c).rlike(r"^[+-]?[0-9]*\.[0-9]{3,}\z"), F.lit(False))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """NULL for anything but a plain number, exponents and NaN included."""
    return numeric_text(c).try_cast(f"decimal({precision},{scale})")


def to_integer(c: Column, spark_type: str) -> Column:
    """Integral values only: ``2.000`` is 2, ``2.5`` and overflow are NULL."""
    whole = F.nullif(F.regexp_extract(loosen(c), INTEGRAL, 1), F.lit(""))
    return whole.try_cast("decimal(38,0)").try_cast(spark_type)


# Rewrites towards canonical digits: no plus sign, a digit before the dot, no needless zeros.
_PLAIN = [(r"^\+", ""), (r"^(-?)\.", "$10."), (r"^(-?)0+(?=[0-9])", "$1"), (r"(\.[0-9]*[1-9])0+\z", "$1"), (r"\.0*\z", "")]


def _rewritten(token: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        token = F.regexp_replace(token, pattern, replacement)
    return F.nullif(token, F.lit(""))


def strict_integer_text(c: Column) -> Column:
    """Canonical integer text, NULL when not integral."""
    token = F.regexp_extract(loosen(c), r"^[+-]?([0-9]+(\.0*)?|\.0+)\z", 0)
    return _rewritten(token, [*_PLAIN, (r"^-0\z", "0")])


def strict_decimal_text(c: Column, scale: int) -> Column:
    """Plain decimal text cut (not rounded) to ``scale`` digits and padded if a fraction remains."""
    if scale == 0:
        return strict_integer_text(c)
    token = F.regexp_extract(loosen(c), NUMBER, 0)
    padded = (r"(\.[0-9]+)\z", "$1" + "0" * scale)
    cut = (rf"(\.[0-9]{{{scale}}})[0-9]+\z", "$1")
    return _rewritten(token, [*_PLAIN, padded, cut])
