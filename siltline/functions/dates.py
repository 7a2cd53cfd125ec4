"""Dates held as text: which spellings count as dates, and their values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltline import fixed
from siltline.functions.text import strip

# Spellings accepted as evidence of a date column.
ISO_SHAPE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?\z"
MONTH_NAME_SHAPE = (
    r"(?i)^([0-9]{2}-[A-Z]{3}-)([0-9]{2})(\s+[0-9]{2}\.[0-9]{2}\.[0-9]{2}\.[0-9]{1,9}\s+(AM|PM))?\z"
)
_HOUR_24 = r"([01]?[0-9]|2[0-3])"
_HOUR_12 = r"(0?[1-9]|1[0-2])"
_MINUTE = r"[0-5]?[0-9]"
_SECOND = r"([0-5]?[0-9]|6[01])"
LOOSE_ISO = rf"^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})([T ]\s*{_HOUR_24}:{_MINUTE}(:{_SECOND})?)?\z"
SLASHED = (
    rf"(?i)^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})"
    rf"(\s+({_HOUR_24}:{_MINUTE}(:{_SECOND})?|{_HOUR_12}:{_MINUTE}(:{_SECOND})?\s+(AM|PM)))?\z"
)
# Spellings accepted by the value-based inference only.
_ZONE = r"(Z|[+-][0-9]{2}(:?[0-9]{2}(:?[0-9]{2}(\.[0-9]+)?)?)?)?"
_ISO_TIME = r"([01][0-9]|2[0-3])(:?[0-5][0-9](:?[0-5][0-9]([.,][0-9]+)?)?)?"
FULL_ISO = rf"^([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}})(.{_ISO_TIME}{_ZONE})?\z"
PACKED_ISO = rf"^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})(.{_ISO_TIME}{_ZONE})?\z"
WITH_ZONE = rf"^[0-9]{{4}}-?[0-9]{{2}}-?[0-9]{{2}}.{_ISO_TIME}(Z|[+-][0-9]{{2}}(:?[0-9]{{2}}(:?[0-9]{{2}}(\.[0-9]+)?)?)?)\z"
# A time part that is all zeros (or 12 AM) is midnight.
MIDNIGHT = r"(?i)^[0-9/-]+([T ]\s*|.)?(0?0(:?00?)?(:?00?)?([.,]0+)?|12:00?(:00?)?\s+AM)?(Z|[+-][0-9:.]+)?\z"
CLOCK = (
    rf"(?i)^({_HOUR_24}:{_MINUTE}(:{_SECOND}(\.[0-9]{{1,6}})?)?|{_HOUR_12}:{_MINUTE}(:{_SECOND})?\s+(AM|PM))\z"
)


# A two-digit year from the pivot on.
_LAST_CENTURY = MONTH_NAME_SHAPE.replace("([0-9]{2})(\\s", f"([{fixed.CENTURY_PIVOT // 10}-9][0-9])(\\s")
_PACKED_DAY = r"^([0-9]{4})([0-9]{2})([0-9]{2})\z"


def _rewritten(c: Column, *rules: tuple[str, str]) -> Column:
    """Apply whole-text rewrites one after the other; a rule that does not match changes nothing."""
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _parsed(day: Column) -> Column:
    """Date of a ``yyyy-M-d`` or ``dd-MMM-yyyy`` text; other texts are not even tried, which is cheaper
    than letting them fail."""
    shaped = F.regexp_extract(day, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{2}-[A-Za-z]{3}-[0-9]{4})\z", 0)
    return F.try_to_date(F.nullif(shaped, F.lit("")), "[yyyy-M-d][dd-MMM-yyyy]")


def date_like(c: Column) -> Column:
    """Shape test used on minimum and maximum values."""
    text = strip(c)
    day = _rewritten(text, (r"^[0-9]{2}-[A-Za-z]{3}-[0-9]{4}\z", ""), (SLASHED, "$3-$1-$2"), (LOOSE_ISO, "$1-$2-$3"))
    return F.coalesce(text.rlike(f"{ISO_SHAPE}|{MONTH_NAME_SHAPE}") | _parsed(day).isNotNull(), F.lit(False))


def _day_text(text: Column) -> Column:
    """``yyyy-M-d`` or ``dd-MMM-yyyy`` for every accepted spelling; others stay as they are."""
    return _rewritten(
        text,
        (ISO_SHAPE, "$1"),
        (SLASHED, "$3-$1-$2"),
        (_PACKED_DAY, "$1-$2-$3"),
        (_LAST_CENTURY, "$119$2"),
        (MONTH_NAME_SHAPE, "$120$2"),
    )


def to_date(c: Column, null_dates: list[str] | None = None) -> Column:
    """Date value of trimmed text; unknown spellings and sentinel dates are NULL."""
    value = _parsed(_day_text(F.trim(c)))
    banned = [F.lit(text[:10]).cast("date") for text in (fixed.NULL_DATES if null_dates is None else null_dates)]
    for day in banned:
        value = F.nullif(value, day)
    return value


def to_timestamp(c: Column, null_dates: list[str] | None = None) -> Column:
    """Zone-free timestamp of trimmed text, same spellings and sentinels as :func:`to_date`."""
    text = F.trim(c)
    day = to_date(c, null_dates)
    # The time of day as H:mm:ss with an optional fraction or half-day mark; nine digits at most.
    clock = F.upper(
        _rewritten(
            text,
            (ISO_SHAPE.replace("([ T]", "[ T]?("), "$2"),
            (r"(?i)^.*\s([0-9]{2})\.([0-9]{2})\.([0-9]{2})\.([0-9]{1,6})[0-9]*\s+([AP]M)\z", "$1:$2:$3.$4 $5"),
            (SLASHED, "$5"),
        )
    )
    whole = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.trim(clock))
    shapes = ("H:m[:s][.SSSSSSSSS][.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]", "h:m[:s][.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S] a")
    timed = F.coalesce(
        F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.trim(clock)).try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(whole, F.lit(f"yyyy-MM-dd {shape}")).cast("timestamp_ntz") for shape in shapes],
    )
    return F.when(day.isNotNull(), F.coalesce(timed, F.when(~text.contains(":") & ~text.rlike(r"\s"), day.cast("timestamp_ntz"))))


def calendar_day(bare: Column) -> Column:
    """Inference view of a stripped text: its day when it is a date or datetime in any accepted
    spelling. Cheap tests tell texts apart, so that each meets the patterns of one spelling only."""
    dashed = F.when(bare.rlike(f"{FULL_ISO}|{LOOSE_ISO}"), F.regexp_extract(bare, "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", 0))
    slashed = F.when(bare.rlike(SLASHED), F.regexp_replace(bare, SLASHED, "$3-$1-$2"))
    packed = F.when(
        bare.rlike(PACKED_ISO), F.concat_ws("-", *[F.substring(bare, at, size) for at, size in ((1, 4), (5, 2), (7, 2))])
    )
    day = F.when(
        F.length(bare) >= 8,
        F.when(F.substring(bare, 5, 1) == "-", dashed).when(F.substring(bare, 2, 2).contains("/"), slashed).otherwise(packed),
    )
    # A month or day that no calendar has is told before it is read: failing is dear.
    possible = r"^[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])\z"
    return F.when(day.rlike(possible), day.try_cast("date"))


def clock_like(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(CLOCK), F.lit(False))
