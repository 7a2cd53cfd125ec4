"""Typed values from text: the cast used by the staged layer and the strict text form."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from siltline.functions import dates, numbers, text

INTEGER_TYPES = {"TINYINT": "smallint", "SMALLINT": "smallint", "INT": "int", "BIGINT": "bigint"}


@dataclass(frozen=True)
class SqlType:
    """A declared type such as ``DECIMAL(17, 4)`` split into its name and arguments."""

    name: str
    args: tuple[int, ...] = ()

    @classmethod
    def parse(cls, declared: str) -> "SqlType":
        head, _, tail = declared.strip().upper().partition("(")
        return cls(head.strip(), tuple(int(n) for n in re.findall(r"[0-9]+", tail)))

    @property
    def is_text(self) -> bool:
        return self.name.startswith(("VARCHAR", "NVARCHAR", "CHAR", "NCHAR"))

    @property
    def is_date(self) -> bool:
        return self.name.startswith(("DATE", "SMALLDATETIME"))

    @property
    def is_integer(self) -> bool:
        return self.name in INTEGER_TYPES

    @property
    def is_decimal(self) -> bool:
        return self.name in ("DECIMAL", "NUMERIC", "MONEY")

    @property
    def is_numeric(self) -> bool:
        return self.is_integer or self.is_decimal

    @property
    def precision_scale(self) -> tuple[int, int]:
        if self.name == "MONEY":
            return 19, 4
        precision = self.args[0] if self.args else 18
        return precision, self.args[1] if len(self.args) > 1 else 0

    @property
    def length(self) -> int | None:
        return self.args[0] if self.is_text and self.args else None

    @property
    def spark(self) -> str:
        """Spark type that stores it."""
        if self.is_integer:
            return INTEGER_TYPES[self.name]
        if self.is_decimal:
            return "decimal({},{})".format(*self.precision_scale)
        if self.name == "DATE":
            return "date"
        if self.name == "DATETIMEOFFSET":
            return "timestamp"
        if self.is_date:
            return "timestamp_ntz"
        if self.name == "BIT":
            return "boolean"
        return "binary" if "BINARY" in self.name else "string"


def try_typed(c: Column, declared: str, null_dates: list[str] | None = None) -> Column:
    """The typed value, or NULL where the text does not fit the type."""
    kind = SqlType.parse(declared)
    if kind.name == "DATE":
        return dates.to_date(c, null_dates)
    if kind.name == "DATETIMEOFFSET":
        return text.spaces_to_null(c).try_cast("timestamp")
    if kind.is_date:
        return dates.to_timestamp(c, null_dates)
    if kind.name == "TINYINT":
        value = numbers.to_integer(c, "smallint")
        return F.when(value.between(0, 255), value)
    if kind.is_integer:
        return numbers.to_integer(c, kind.spark)
    if kind.is_decimal:
        return numbers.to_decimal(c, *kind.precision_scale)
    if kind.name == "BIT":
        return text.boolean_word(c)
    if kind.name == "UNIQUEIDENTIFIER":
        value = text.spaces_to_null(c)
        return F.when(value.rlike(r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"), value)
    return text.spaces_to_null(c)


def typed(
    c: Column,
    declared: str,
    identifier: bool = False,
    blank_policy: str = "default",
    null_dates: list[str] | None = None,
) -> Column:
    """Staged-layer value.

    Dates keep NULL. With ``blank_policy='default'`` numbers that do not parse become 0 and
    missing text becomes ``''``; with ``'null'`` both stay NULL.
    """
    kind = SqlType.parse(declared)
    if kind.is_text:
        value = text.identifier(c) if identifier else text.spaces_to_null(c)
        if blank_policy == "default":
            value = F.coalesce(value, F.lit(""))
        return F.left(value, F.lit(kind.length)) if kind.length else value
    value = try_typed(c, declared, null_dates)
    if kind.is_numeric and blank_policy == "default":
        return F.coalesce(value, F.lit(0).cast(kind.spark))
    return value


def is_lossy(c: Column, declared: str, null_dates: list[str] | None = None) -> Column:
    """True where non-blank text has no value in the declared type (sentinel dates are no loss)."""
    kind = SqlType.parse(declared)
    filled = text.spaces_to_null(c).isNotNull()
    if kind.is_text:
        cut = F.length(text.spaces_to_null(c)) > kind.length if kind.length else F.lit(False)
        return F.coalesce(cut, F.lit(False))
    return filled & try_typed(c, declared, [] if kind.is_date else null_dates).isNull()


def strict_text(c: Column, declared: str) -> tuple[Column, Column]:
    """(canonical text, is invalid): blanks are '', values that break the type are flagged and NULL."""
    kind = SqlType.parse(declared)
    value = text.strip(c)
    if kind.name == "BIT":
        word = text.boolean_word(c)
        out = F.when(word, F.lit("1")).when(~word, F.lit("0"))
    elif kind.is_integer:
        out = numbers.strict_integer_text(c)
    elif kind.name == "DECIMAL" and len(kind.args) > 1:
        out = numbers.strict_decimal_text(c, kind.args[1])
    else:
        out = text.scrub(value)
    # Blank text has no reading in any of the types, so the reading is asked for first, once.
    blank = text.is_blank(c)
    return F.coalesce(out, F.when(blank, F.lit(""))), out.isNull() & ~blank
