"""Expressions over column, table and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltline import fixed
from siltline.functions.text import strip


def words(name: Column) -> Column:
    """Upper-case words of a name, split at camel-case humps and punctuation."""
    humps = F.regexp_replace(name, r"(?<=[A-Z])(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])", "_")
    return F.filter(F.split(F.upper(humps), r"[^A-Z0-9]+"), lambda word: word != "")


def has_word(name_words: Column, options: list[str]) -> Column:
    return F.arrays_overlap(name_words, F.array(*[F.lit(option) for option in options]))


def is_identifier(name: Column) -> Column:
    upper = F.upper(name)
    found = has_word(words(name), fixed.IDENTIFIER_WORDS)
    for fragment in fixed.IDENTIFIER_FRAGMENTS:
        found = found | upper.contains(fragment)
    return found


def semantics(name: Column) -> Column:
    """What a column name promises: identifier, date, rate, amount, quantity or generic."""
    upper, parts = F.upper(name), words(name)
    exact = F.regexp_replace(upper, "[^A-Z0-9]+", "")
    kind = None
    for spelled, value in fixed.SEMANTIC_OVERRIDES.items():
        kind = (F if kind is None else kind).when(exact == spelled, F.lit(value))
    for options, value in (
        (fixed.DATE_WORDS, "date"),
        (fixed.RATE_WORDS, "rate"),
        (fixed.DECIMALS_WORDS, "quantity"),
        (fixed.AMOUNT_WORDS, "amount"),
        (fixed.QUANTITY_WORDS, "quantity"),
        (fixed.IDENTIFIER_WORDS, "identifier"),
    ):
        kind = kind.when(has_word(parts, options), F.lit(value))
    return (
        kind.when(upper.rlike("DATE|DT$"), F.lit("date"))
        .when(upper.rlike("RATE|PERCENT|_R$"), F.lit("rate"))
        .when(upper.rlike("AMOUNT|TOTAL|_AMT$"), F.lit("amount"))
        .when(upper.rlike("COUNT$|_QTY$"), F.lit("quantity"))
        .otherwise(F.lit("generic"))
    )


def sanitize(name: Column) -> Column:
    """A table-safe name: letters, digits and single underscores, never starting with a digit."""
    parted = F.translate(F.regexp_replace(strip(name), fixed.DOT_BETWEEN_LETTERS, "_"), ".", "")
    bare = F.btrim(F.regexp_replace(parted, fixed.NOT_NAME_CHARACTERS, "_"), F.lit("_"))
    safe = (
        F.when(bare == "", F.lit("Column"))
        .when(bare.rlike("^[0-9]"), F.concat(F.lit("Column_"), bare))
        .otherwise(bare)
    )
    return F.left(safe, F.lit(fixed.NAME_LIMIT))


def ordinal_name(position: Column) -> Column:
    """``Column_001`` and so on; longer numbers keep all their digits."""
    digits = position.cast("string")
    return F.concat(F.lit("Column_"), F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits))


def base_name(name: Column, position: Column) -> Column:
    return F.when(strip(name) == "", ordinal_name(position)).otherwise(sanitize(name))


def is_generated(name: Column) -> Column:
    return name.rlike(r"^Column_[0-9]+\z")


def trim_header(header: Column) -> Column:
    """Strip every name and cut after the last named one; an all-blank header is kept whole."""
    names = F.transform(header, strip)
    last = F.array_max(F.transform(names, lambda name, at: F.when(name != "", at + 1).otherwise(0)))
    return F.when(last > 0, F.slice(names, F.lit(1), last)).otherwise(names)


def header_hash(header: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the compact JSON array of stripped names."""
    return F.left(F.sha2(F.to_json(F.transform(header, strip)), 256), F.lit(16))


def plain_table_name(table: Column) -> Column:
    """Drop one trailing numeric part of ``schema.object_1`` unless the part before it is numeric too."""
    numbered = table.rlike(r"_[0-9]+\z") & ~table.rlike(r"(^[^.]*\.|_)[0-9]+_[0-9]+\z")
    return F.when(numbered, F.regexp_replace(table, r"_[0-9]+\z", "")).otherwise(table)


def entity_from_file(file_name: Column, prefix: str | None = None, suffix: str | None = None) -> Column:
    """Entity part of ``ENTITY_MMDDYYYY_MMDDYYYY[_n].csv``, else the file stem; optional patterns cut."""
    dated = F.regexp_extract(file_name, r"(?i)^(.+?)_[0-9]{8}_[0-9]{8}(_[0-9]+)?\.csv\z", 1)
    return strip(_cut(F.when(dated != "", dated).otherwise(file_stem(file_name)), prefix, suffix))


def entity_key(file_name: Column, prefix: str | None = None, suffix: str | None = None) -> Column:
    """Upper-case underscored entity from the file stem; NULL when nothing is left."""
    entity = strip(file_stem(file_name))
    for pattern in (prefix, suffix):
        if pattern:
            entity = strip(F.regexp_replace(entity, f"(?i){pattern}", ""))
    key = F.btrim(F.regexp_replace(entity, "[^A-Za-z0-9]+", "_"), F.lit("_"))
    return F.nullif(F.upper(key), F.lit(""))


def file_stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"(?<=.)\.[^.]*\z", "")


def _cut(name: Column, prefix: str | None, suffix: str | None) -> Column:
    for pattern in (prefix, suffix):
        if pattern:
            name = F.regexp_replace(name, f"(?i){pattern}", "")
    return name


def similarity_form(name: Column) -> Column:
    """Lower-case name with the usual abbreviations applied, letters and digits only."""
    text = F.lower(name)
    for long_form, short_form in fixed.SIMILARITY_WORDS:
        text = F.replace(text, F.lit(long_form), F.lit(short_form))
    return F.regexp_replace(text, "[^a-z0-9]+", "")
