"""Columns that only some variants have: samples, rename candidates and review rows."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from siltline import fixed
from siltline.functions import names, text
from siltline.operators import variants
from siltline.operators.records import first_rows

# Order in which letters are looked at when similar names are searched: rare ones first.
RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate0123456789"


def column_samples(
    table: DataFrame, columns: list[str], order: list[str], limit: int = 5, keys: tuple[str, ...] = ()
) -> DataFrame:
    """First non-blank values of every column as ``variant|file|value || ...``, all in one pass.

    Each task keeps ``limit`` values per column before anything is shuffled.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    )
    values = table.select(*keys, *[c for c in order if c not in keys], F.inline(cells)).where(
        text.spaces_to_null(F.col("value")).isNotNull()
    )
    kept = first_rows(values, [*keys, "column_name"], order, limit)
    file = F.regexp_extract(fixed.SOURCE_FILE, r"([^/\\]*)\z", 1)
    shown = F.concat_ws("|", fixed.VARIANT, file, F.left("value", F.lit(fixed.TEXT_LIMIT)))
    return (
        kept.withColumn("shown", shown)
        .groupBy(*keys, "column_name")
        .agg(F.array_sort(F.collect_list(F.struct("sample_no", "shown"))).alias("samples"))
        .select(
            *keys, "column_name",
            F.array_join(F.transform("samples", lambda item: item["shown"]), " || ").alias("sample_values"),
        )
    )


@F.pandas_udf(BooleanType())
def _matches(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two normalised names, in the given order."""
    floor = fixed.SIMILARITY_FLOOR
    return pd.Series(
        [SequenceMatcher(None, a, b).ratio() >= floor for a, b in zip(left, right)], dtype="bool"
    )


def similar_pairs(columns: DataFrame, keys: tuple[str, ...] = ("entity_name",)) -> DataFrame:
    """Pairs ``left_column < right_column`` of one entity whose normalised names look alike:
    one contains the other, or their matching-blocks ratio is at least 0.72.

    Candidates come from equi-joins, never from all pairs. Containment: every substring of a name
    is looked up among the names. Ratio: two names can only reach it when they share enough letters,
    and then they share one among the first letters of each in a fixed order, so only those first
    letters are joined on. Both filters keep every true pair.
    """
    distinct = columns.select(*keys, "column_name").distinct()
    named = distinct.withColumn("form", names.similarity_form(F.col("column_name"))).where("form <> ''")
    keys = list(keys)

    # Names fold to far fewer forms; forms are compared, then names put back.
    forms = named.select(*keys, "form").distinct()
    size = F.length("form")
    starts = F.sequence(F.lit(1), size)
    pieces = F.array_distinct(
        F.flatten(
            F.transform(
                starts,
                lambda at: F.transform(
                    F.sequence(F.lit(1), size - at + 1), lambda length: F.substring(F.col("form"), at, length)
                ),
            )
        )
    )
    contained = (
        forms.select(*keys, F.col("form").alias("outer_form"), F.explode(pieces).alias("form"))
        .join(forms, [*keys, "form"])
        .select(*keys, F.col("form").alias("a"), F.col("outer_form").alias("b"))
    )

    # Letters are numbered by occurrence, so that shared tokens count shared letters.
    letters = F.split("form", "")
    tokens = F.array_sort(
        F.transform(
            letters,
            lambda letter, at: F.struct(
                F.instr(F.lit(RARE_FIRST), letter).alias("rank"),
                F.size(F.filter(F.slice(letters, F.lit(1), at + 1), lambda other: other == letter)).alias("seen"),
            ),
        )
    )
    # ratio = 2M/(a+b) >= 0.72 and M <= min(a, b) give M >= 0.5625a for either name; a prefix of
    # a - ceil(0.5625a) + 1 tokens must then meet the other's prefix. The share is rounded down a
    # little so that rounding never loses a pair.
    share = fixed.SIMILARITY_FLOOR / (2 - fixed.SIMILARITY_FLOOR) - 1e-9
    prefix = size - F.ceil(size * share).cast("int") + 1
    probed = forms.withColumn("tokens", tokens).select(
        *keys, "form", "tokens", F.explode(F.slice("tokens", F.lit(1), prefix)).alias("token")
    )
    # A form's tokens are distinct, so shared tokens bound the matching letters from above: pairs below
    # the bound are dropped before any text is compared.
    needed = (fixed.SIMILARITY_FLOOR - 1e-9) / 2 * (F.length("l.form") + F.length("r.form"))
    near = (
        probed.alias("l")
        .join(probed.alias("r"), [*keys, "token"])
        .where(
            (F.col("l.form") < F.col("r.form"))
            & (F.least(F.length("l.form"), F.length("r.form")) >= needed)
            & (F.size(F.array_intersect("l.tokens", "r.tokens")) >= needed)
        )
        .select(*keys, F.col("l.form").alias("a"), F.col("r.form").alias("b"))
    )
    alike = near.distinct()
    inside = contained.where("a <> b")
    pairs = (
        _ordered_both_ways(alike, keys).where(~F.col("a").contains(F.col("b")) & ~F.col("b").contains(F.col("a"))).where(_matches("a", "b"))
        .unionByName(_ordered_both_ways(inside, keys))
        .unionByName(forms.select(*keys, F.col("form").alias("a"), F.col("form").alias("b")))
        .distinct()
    )
    left = named.select(*keys, F.col("column_name").alias("left_column"), F.col("form").alias("a"))
    right = named.select(*keys, F.col("column_name").alias("right_column"), F.col("form").alias("b"))
    return (
        pairs.join(left, [*keys, "a"])
        .join(right, [*keys, "b"])
        .where("left_column < right_column")
        .select(*keys, "left_column", "right_column")
    )


def _ordered_both_ways(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """The ratio depends on the order of the two forms, and either may belong to the smaller name."""
    return pairs.unionByName(pairs.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))


def rename_candidates(columns: DataFrame) -> DataFrame:
    """Look-alike variant-only columns of one entity that never occur in the same variant."""
    only = variants.column_presence(columns).where("presence = 'variant_only'").where(
        ~names.is_generated(F.col("column_name"))
    )
    places = only.groupBy("entity_name", "column_name").agg(
        F.array_sort(F.collect_set("pipeline_name")).alias("present")
    )
    left = places.select("entity_name", F.col("column_name").alias("left_column"), F.col("present").alias("left_present"))
    right = places.select("entity_name", F.col("column_name").alias("right_column"), F.col("present").alias("right_present"))
    return (
        similar_pairs(only)
        .join(left, ["entity_name", "left_column"])
        .join(right, ["entity_name", "right_column"])
        .where(~F.arrays_overlap("left_present", "right_present"))
    )


def _catalog(columns: DataFrame) -> DataFrame:
    """Per entity and column: where it occurs, how many values it has and its trace."""
    item = F.struct("pipeline_name", "table_name", "ordinal_position")
    return (
        columns.groupBy("entity_name", "column_name")
        .agg(
            F.array_sort(F.collect_set(item)).alias("places"),
            F.sum(F.coalesce("non_null_row_count", F.lit(0))).alias("non_null_row_count"),
        )
        .withColumn("present", F.transform("places", lambda place: place["pipeline_name"]))
        .withColumn(
            "source_trace",
            F.array_join(
                F.transform(
                    "places",
                    lambda place: F.concat(
                        place["pipeline_name"], F.lit("|"), place["table_name"], F.lit("|ordinal="), place["ordinal_position"]
                    ),
                ),
                "; ",
            ),
        )
    )


def anomaly_rows(columns: DataFrame, samples: DataFrame, hrm_columns: DataFrame) -> DataFrame:
    """Review rows for variant-only columns and possible renames, limited to harmonised columns.

    ``samples`` has ``entity_name, column_name, sample_values``; ``hrm_columns`` has
    ``entity_name, column_name``.
    """
    all_variants = columns.groupBy("entity_name").agg(
        F.array_sort(F.collect_set("pipeline_name")).alias("all_variants")
    )
    known = columns.join(hrm_columns.select("entity_name", "column_name").distinct(), ["entity_name", "column_name"], "left_semi")
    only = variants.column_presence(columns).where("presence = 'variant_only'").select("entity_name", "column_name").distinct()
    catalog = (
        _catalog(known)
        .join(samples, ["entity_name", "column_name"], "left")
        .withColumn("sample_values", F.coalesce("sample_values", F.lit("")))
    )
    generated = names.is_generated(F.col("column_name"))
    single = catalog.join(only, ["entity_name", "column_name"], "left_semi").join(all_variants, "entity_name")
    single_rows = single.select(
        "entity_name",
        F.when(generated, F.lit("unnamed_source_column_with_values"))
        .otherwise(F.lit("named_variant_only_column"))
        .alias("anomaly_type"),
        F.col("column_name").alias("hrm_column_name"),
        F.lit("").alias("candidate_column_name"),
        F.array_join("present", ";").alias("present_in_variants"),
        F.array_join(F.array_except("all_variants", "present"), ";").alias("missing_from_variants"),
        F.col("non_null_row_count").cast("string").alias("non_null_row_count"),
        "sample_values",
        "source_trace",
        F.when(
            generated,
            F.lit(fixed.ADVICE_UNNAMED),
        )
        .otherwise(F.lit(fixed.ADVICE_NAMED))
        .alias("recommended_review_action"),
    )

    def side(name: str) -> DataFrame:
        fields = ["present", "non_null_row_count", "sample_values", "source_trace"]
        return catalog.select(
            "entity_name", F.col("column_name").alias(f"{name}_column"), *[F.col(f).alias(f"{name}_{f}") for f in fields]
        )

    def pair(separator: str, value: str) -> Column:
        def one(name: str) -> Column:
            field = F.col(f"{name}_{value}")
            return F.concat(F.col(f"{name}_column"), F.lit(separator), F.array_join(field, ";") if value == "present" else field.cast("string"))

        return F.concat(one("left"), F.lit(" | "), one("right"))

    renames = rename_candidates(columns).select("entity_name", "left_column", "right_column")
    rename_rows = (
        renames.join(side("left"), ["entity_name", "left_column"])
        .join(side("right"), ["entity_name", "right_column"])
        .select(
            "entity_name",
            F.lit("possible_rename_pair").alias("anomaly_type"),
            F.col("left_column").alias("hrm_column_name"),
            F.col("right_column").alias("candidate_column_name"),
            pair(":", "present").alias("present_in_variants"),
            F.lit("").alias("missing_from_variants"),
            pair(":", "non_null_row_count").alias("non_null_row_count"),
            pair(" => ", "sample_values").alias("sample_values"),
            pair(": ", "source_trace").alias("source_trace"),
            F.lit(fixed.ADVICE_RENAME).alias("recommended_review_action"),
        )
    )
    return (
        single_rows.unionByName(rename_rows)
        .withColumn("review_decision", F.lit(""))
        .withColumn("review_notes", F.lit(""))
    )
