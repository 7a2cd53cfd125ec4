"""Column profiles, recommended types, value-based inference and data-quality issues."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltline import fixed
from siltline.functions import dates, names, numbers, text
from siltline.operators.folding import unsorted

PROFILE = (
    "struct<ordinal_position:int,column_name:string,minimum_non_null_value:string,"
    "maximum_non_null_value:string,max_string_length:int,blank_row_count:bigint,"
    "non_null_row_count:bigint>"
)


def _measures(prefix: str, source: str, controls: bool) -> list[Column]:
    value = text.blank_to_null(F.col(f"`{source}`"))
    measures = [
        unsorted(F.min(value)).alias(f"{prefix}_min"),
        unsorted(F.max(value)).alias(f"{prefix}_max"),
        F.max(F.length(value)).alias(f"{prefix}_len"),
        F.count_if(value.isNull()).alias(f"{prefix}_blank"),
        F.count(value).alias(f"{prefix}_filled"),
    ]
    if controls:
        measures.append(F.coalesce(F.max(text.has_control_characters(value)), F.lit(False)).alias(f"{prefix}_ctl"))
    return measures


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    by: str | None = None,
    controls: bool = False,
) -> DataFrame:
    """One row per column (and per ``by`` value): extremes, longest length, blank and filled counts.

    All columns are measured in one pass as one wide aggregate, then turned into rows; only one
    partial row per task (and group) is shuffled. Extremes compare as text.
    """
    columns = [c for c in (columns or df.columns) if c != by]
    wide = [m for i, c in enumerate(columns) for m in _measures(f"c{i}", c, controls)]
    grouped = df.groupBy(by).agg(*wide) if by else df.agg(*wide)
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal_position"),
                F.lit(c).alias("column_name"),
                F.col(f"c{i}_min").alias("minimum_non_null_value"),
                F.col(f"c{i}_max").alias("maximum_non_null_value"),
                F.col(f"c{i}_len").alias("max_string_length"),
                F.col(f"c{i}_blank").alias("blank_row_count"),
                F.col(f"c{i}_filled").alias("non_null_row_count"),
                *([F.col(f"c{i}_ctl").alias("contains_control_characters")] if controls else []),
            )
            for i, c in enumerate(columns)
        ]
    )
    keys = [F.col(by)] if by else []
    return with_nullability(grouped.select(*keys, F.inline(rows)))


def with_nullability(profiled: DataFrame) -> DataFrame:
    blank = F.col("blank_row_count") > 0
    return (
        profiled.withColumn("nullable_flag", blank.cast("int"))
        .withColumn("nullability", F.when(blank, F.lit("NULL")).otherwise(F.lit("NOT NULL")))
        .withColumn("defined_sql_type", F.lit(fixed.RAW_TEXT_TYPE))
    )


def merge_profiles(by_file: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Fold per-file profiles into one per column: counts add up, extremes and lengths widen."""
    merged = by_file.groupBy(*keys, "column_name").agg(
        F.min("ordinal_position").alias("ordinal_position"),
        unsorted(F.min("minimum_non_null_value")).alias("minimum_non_null_value"),
        unsorted(F.max("maximum_non_null_value")).alias("maximum_non_null_value"),
        F.max("max_string_length").alias("max_string_length"),
        F.sum("blank_row_count").alias("blank_row_count"),
        F.sum("non_null_row_count").alias("non_null_row_count"),
    )
    return with_nullability(merged)


def value_kind(c: Column) -> Column:
    """NULL for blanks, else ``date``, ``numeric`` or ``text``."""
    return (
        F.when(text.is_blank(c), F.lit(None).cast("string"))
        .when(dates.date_like(c), F.lit("date"))
        .when(numbers.numeric_text(c).isNotNull(), F.lit("numeric"))
        .otherwise(F.lit("text"))
    )


def recommend(profiled: DataFrame) -> DataFrame:
    """Add the name's meaning, the extremes' mismatch flag and the recommended type."""
    low, high = (
        text.shorten(F.col(c)) for c in ("minimum_non_null_value", "maximum_non_null_value")
    )
    wide = (
        profiled.withColumn("semantic_kind", names.semantics(F.col("column_name")))
        .withColumn("_low", value_kind(low))
        .withColumn("_high", value_kind(high))
        .withColumn(
            "min_max_value_type_mismatch_flag",
            F.coalesce((F.col("_low") != F.col("_high")).cast("int"), F.lit(0)),
        )
    )
    kind, varchar = F.col("semantic_kind"), text.varchar_for_length(F.col("max_string_length"))

    def both(what: str) -> Column:
        return (F.col("_low") == what) & (F.col("_high") == what)

    mismatch = F.col("min_max_value_type_mismatch_flag") == 1
    dated = kind.isin("identifier", "date", "generic") & both("date")
    rates = (kind == "rate") & (numbers.rate_like(low) | numbers.rate_like(high))
    counts = (kind == "quantity") & numbers.integer_like(low) & numbers.integer_like(high)
    recommended = (
        F.when(dated, F.lit("DATE"))
        .when(mismatch, varchar)
        .when((kind == "amount") & both("numeric"), F.lit("MONEY"))
        .when(rates, F.lit(fixed.FRACTION_TYPE))
        .when(counts, F.lit("INT"))
        .when((kind == "quantity") & both("numeric"), F.lit(fixed.FRACTION_TYPE))
        .otherwise(varchar)
    )
    return wide.withColumn("recommended_sql_type", recommended).drop("_low", "_high")


# --- inference from values ---------------------------------------------------------------

# Candidate types in bit order of the per-value match mask.
CANDIDATES = list(fixed.TYPE_PRIORITY)


def _match_mask(bare: Column, number: Column, day: Column, mantissa: Column) -> Column:
    """Which candidate types a stripped text matches, as bits in the order of ``CANDIDATES``.

    ``number``, ``day`` and ``mantissa`` are its integer, calendar and decimal readings, NULL when it has none.
    """
    # Cheap tests come first, and costly ones stand in branches: Spark evaluates a term that occurs twice
    # ahead of both unless it is in a branch.
    known = day.isNotNull()
    zoned = F.when(known, bare.rlike(dates.WITH_ZONE))
    tests = {
        "BIT": (F.length(bare) <= 5) & F.lower(bare).isin(fixed.TRUE_WORDS + fixed.FALSE_WORDS),
        "UNIQUEIDENTIFIER": (F.length(bare) >= 32) & F.regexp_replace(bare, r"urn:|uuid:|^[{}]+|[{}]+\z|-", "").rlike(r"^[0-9A-Fa-f]{32}\z"),
        "TIME": bare.contains(":") & bare.rlike(dates.CLOCK),
        "DATETIMEOFFSET": zoned,
        "DATE": F.when(known, bare.rlike(dates.MIDNIGHT)),
        "DATETIME2": ~zoned,
        "TINYINT": number.between(0, 255),
        "SMALLINT": number.between(-(2**15), 2**15 - 1),
        "INT": number.between(-(2**31), 2**31 - 1),
        "BIGINT": number.isNotNull(),
        "DECIMAL": mantissa.isNotNull(),
    }
    bits = [F.when(tests[name], 1 << bit).otherwise(0) for bit, name in enumerate(CANDIDATES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


_COUNTS = ["non_null_row_count", "blank_row_count", *[f"b{bit}" for bit in range(len(CANDIDATES))]]
DECIMAL_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,6})?\z"


def _integer(bare: Column) -> Column:
    """The integer of 64 bits at most that a text spells; underscores may group digits."""
    return F.when(bare.rlike(r"^[+-]?[0-9]+(_[0-9]+)*\z"), F.replace(bare, F.lit("_"), F.lit("")).try_cast("bigint"))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Best type per column by share of matching non-blank values, text below 80 percent.

    Columns are turned into (column, value) rows, so that one set of tests serves any number of
    columns; each task folds them into one row of counters per column before the shuffle.
    """
    columns = list(columns or df.columns)
    cells = F.array(
        *[F.struct(F.lit(i).alias("at"), F.col(f"`{c}`").cast("string").alias("raw")) for i, c in enumerate(columns)]
    )
    # Readings are projected step by step, so that each is computed once per value.
    bare = df.select(F.inline(cells)).select("at", text.blank_to_null(F.col("raw")).alias("bare"))
    # No reading begins with anything else.
    numeral = F.substring("bare", 1, 1).isin(*"0123456789+-.")
    scientific = F.lower("bare").contains("e")
    exponent = F.when(scientific, F.regexp_extract("bare", r"[eE]([+-]?[0-9]+)\z", 1).try_cast("int"))
    mantissa = F.when(scientific, F.regexp_replace("bare", r"^[+-]|[eE].*\z", "")).otherwise(F.ltrim("bare", F.lit("+-")))
    read = bare.select(
        "*",
        F.when(numeral, _integer(F.col("bare"))).alias("number"),
        F.when(numeral, dates.calendar_day(F.col("bare"))).alias("day"),
        F.when(numeral & F.col("bare").rlike(DECIMAL_SHAPE), mantissa).alias("mantissa"),
        F.when(numeral, F.coalesce(exponent, F.lit(0))).alias("exponent"),
    )
    point = F.instr("mantissa", ".")
    fraction = F.when(point > 0, F.length("mantissa") - point).otherwise(F.length("mantissa") * 0)
    tested = read.select(
        "at",
        F.when(F.col("bare").isNotNull(), _match_mask(F.col("bare"), F.col("number"), F.col("day"), F.col("mantissa"))).alias("mask"),
        F.length("bare").alias("size"),
        F.ltrim(F.replace("mantissa", F.lit("."), F.lit("")), F.lit("0")).alias("digits"),
        (fraction - F.col("exponent")).alias("shift"),
    )
    kept = tested.withColumn("kept", F.length(F.rtrim("digits", F.lit("0"))))
    scale = F.when(F.col("kept") == 0, F.lit(0)).when(
        F.col("kept") > 0, F.greatest(F.col("shift") - F.length("digits") + F.col("kept"), F.lit(0))
    )
    sized = kept.select("at", "mask", "size", "kept", scale.alias("scale"))
    counted = sized.groupBy("at").agg(
        F.count("mask").alias("non_null_row_count"),
        F.count(F.when(F.col("mask").isNull(), 1)).alias("blank_row_count"),
        F.max("size").alias("max_string_length"),
        F.max(F.greatest("kept", F.col("scale") + 1)).alias("p"),
        F.max("scale").alias("s"),
        *[F.count(F.when(F.col("mask").bitwiseAND(1 << bit) != 0, 1)).alias(f"b{bit}") for bit in range(len(CANDIDATES))],
    )
    ranked = F.array(
        *[
            F.struct(
                F.col(f"b{bit}").alias("matched"), F.lit(fixed.TYPE_PRIORITY[kind]).alias("priority"), F.lit(kind).alias("kind")
            )
            for bit, kind in enumerate(CANDIDATES)
        ]
    )
    # Every column has a row even when the frame has none.
    catalog = df.sparkSession.createDataFrame(list(enumerate(columns)), "at int, column_name string")
    best_of = catalog.join(counted, "at", "left").na.fill(0, _COUNTS).withColumn("best", F.array_max(ranked))
    filled, varchar = F.col("non_null_row_count"), text.varchar_for_length(F.col("max_string_length"))
    precision = F.least(F.greatest(F.coalesce("p", F.lit(1)), F.lit(1)), F.lit(38))
    scale = F.least(F.coalesce("s", F.lit(0)), precision)
    decimal = F.when((scale == 0) & (precision <= 18), F.lit("DECIMAL(18,0)")).otherwise(
        F.format_string("DECIMAL(%d,%d)", precision, scale)
    )
    share = F.when(filled > 0, F.col("best.matched") / filled * 100.0).otherwise(F.lit(0.0))
    sure = (filled > 0) & (share >= fixed.CONFIDENCE_THRESHOLD)
    best = F.when(F.col("best.kind") == "DECIMAL", decimal).otherwise(F.col("best.kind"))
    blank = F.col("blank_row_count") > 0
    return best_of.select(
        "column_name",
        F.when(sure, best).otherwise(varchar).alias("inferred_sql_type"),
        F.round(share, 2).alias("confidence_pct"),
        F.when(filled > 0, F.col("best.matched")).otherwise(F.lit(0)).alias("matched_value_count"),
        "non_null_row_count",
        "blank_row_count",
        "max_string_length",
        blank.cast("int").alias("nullable_flag"),
        F.when(blank, F.lit("NULL")).otherwise(F.lit("NOT NULL")).alias("nullability"),
        F.when(filled == 0, F.lit("all values blank"))
        .when(sure, F.lit("high_confidence_match"))
        .otherwise(F.lit("fallback_to_varchar_low_confidence"))
        .alias("inference_reason"),
    )


# --- data quality ------------------------------------------------------------------------


def column_issues(profiled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Issue rows from a profile taken with ``controls=True``."""
    name = F.when(
        F.col("column_name") == "", F.concat(F.lit("column_"), F.col("ordinal_position"))
    ).otherwise(F.col("column_name"))
    seen = F.col("non_null_row_count") + F.col("blank_row_count")
    ratio = F.col("blank_row_count") / F.nullif(seen, F.lit(0))
    percent = F.format_string("%.1f", ratio * 100)
    quoted = F.concat(F.lit("Column '"), name, F.lit("' "))

    def issue(kind: str, present: Column, message: Column, blank: Column | None = None, longest: Column | None = None) -> Column:
        return F.when(
            present,
            F.struct(
                F.lit(kind).alias("issue_type"),
                F.lit("warning").alias("severity"),
                F.concat(quoted, message).alias("message"),
                (F.lit(None) if blank is None else blank).cast("double").alias("blank_ratio"),
                (F.lit(None) if longest is None else longest).cast("int").alias("max_string_length"),
            ),
        )

    length = F.col("max_string_length")
    issues = F.array_compact(
        F.array(
            issue(
                "high_blank_ratio", ratio >= fixed.BLANK_RATIO_LIMIT,
                F.concat(F.lit(fixed.MESSAGE_BLANK[0]), percent, F.lit(fixed.MESSAGE_BLANK[1])), blank=F.round(ratio, 4),
            ),
            issue(
                "oversized_text", length > fixed.LONG_TEXT_LIMIT,
                F.lit(fixed.MESSAGE_LONG), longest=length,
            ),
            issue(
                "control_characters", F.col("contains_control_characters"),
                F.lit(fixed.MESSAGE_CONTROL),
            ),
        )
    )
    return profiled.select(
        *keys, name.alias("column_name"), F.inline(issues)
    )


def file_issues(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Issue rows per file from ``empty_headers``, ``duplicate_headers`` (arrays) and the two counts."""

    def issue(kind: str, count: Column, message: str, samples: Column | None = None) -> Column:
        shown = F.slice(samples, 1, fixed.ISSUE_SAMPLE) if samples is not None else F.lit(None).cast("array<string>")
        return F.when(
            count > 0,
            F.struct(
                F.lit(kind).alias("issue_type"),
                F.lit("warning").alias("severity"),
                F.concat(count.cast("string"), F.lit(message)).alias("message"),
                shown.alias("sample_headers"),
            ),
        )

    issues = F.array_compact(
        F.array(
            issue("empty_headers", F.size("empty_headers"), fixed.MESSAGE_EMPTY_HEADERS, F.col("empty_headers")),
            issue("duplicate_headers", F.size("duplicate_headers"), fixed.MESSAGE_DUPLICATE_HEADERS, F.col("duplicate_headers")),
            issue("malformed_rows", F.col("malformed_row_count"), fixed.MESSAGE_MALFORMED),
            issue("duplicate_data_rows", F.col("duplicate_data_row_count"), fixed.MESSAGE_DUPLICATE_ROWS),
        )
    )
    return files.select(*keys, F.inline(issues))


def file_status(files: DataFrame, issues: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ok / warning / empty_file with the sorted distinct reasons; ``issues`` may mix file and column issues."""
    reasons = issues.groupBy(*keys).agg(F.array_sort(F.collect_set("issue_type")).alias("status_reasons"))
    joined = files.join(reasons, list(keys), "left").withColumn(
        "status_reasons", F.coalesce("status_reasons", F.array().cast("array<string>"))
    )
    return joined.withColumn(
        "status",
        F.when(F.col("is_empty"), F.lit("empty_file"))
        .when(F.size("status_reasons") > 0, F.lit("warning"))
        .otherwise(F.lit("ok")),
    )
