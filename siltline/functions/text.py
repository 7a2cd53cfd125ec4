"""Text expressions: trimming, scrubbing, truncation, small parsers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltline import fixed


def strip(c: Column) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Raw-layer rule: strip all whitespace, empty becomes NULL."""
    return F.nullif(strip(c), F.lit(""))


def spaces_to_null(c: Column) -> Column:
    """Typed-layer rule: trim spaces only, empty becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def scrub(c: Column) -> Column:
    """CR, LF and the field mark become spaces so that a stored row stays on one line."""
    return F.translate(c, "\r\n" + fixed.FIELD_MARK, "   ")


def shorten(c: Column, limit: int = fixed.TEXT_LIMIT) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit - 3)), F.lit("..."))).otherwise(c)


def has_control_characters(c: Column) -> Column:
    return c.rlike(fixed.CONTROL_PATTERN)


def boolean_word(c: Column) -> Column:
    word = F.lower(strip(c))
    return (
        F.when(word.isin(fixed.TRUE_WORDS), F.lit(True))
        .when(word.isin(fixed.FALSE_WORDS), F.lit(False))
    )


def identifier(c: Column) -> Column:
    """``9558.0000`` becomes ``9558``: a leading digit and only zeros after the first dot."""
    return F.regexp_replace(spaces_to_null(c), r"^([0-9][^.]*)\.0*\z", "$1")


def varchar_for_length(c: Column) -> Column:
    """Narrowest text bucket that holds values of this length."""
    small, medium, large, widest = fixed.VARCHAR_STEPS
    return (
        F.when(c.isNull() | (c <= small), F.lit(f"VARCHAR({small})"))
        .when(c <= medium, F.lit(f"VARCHAR({medium})"))
        .when(c <= large, F.lit(f"VARCHAR({large})"))
        .otherwise(F.lit(f"VARCHAR({widest})"))
    )
