"""Variants of one entity, united by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltline import fixed
from siltline.functions import dates, names, text
from siltline.operators.folding import unsorted


def harmonised_name(name: Column) -> Column:
    return F.when(name.isin(fixed.HARMONISED_METADATA), name).otherwise(names.sanitize(name))


def column_plan(profiles: DataFrame) -> DataFrame:
    """One row per output column from the variants' profiles
    (``variant, ordinal_position, column_name``, extremes and ``non_null_row_count``).

    Columns come in first-seen order; nameless columns without any value are left out; a name with
    DATE in it becomes DATE when an extreme is an ISO date or there is no value at all.
    """
    low, high = F.col("minimum_non_null_value"), F.col("maximum_non_null_value")
    evidence = F.coalesce(F.nullif(low, F.lit("")), F.nullif(high, F.lit(""))).isNotNull()
    iso = F.coalesce(text.strip(low).rlike(fixed.ISO_EVIDENCE), F.lit(False)) | F.coalesce(
        text.strip(high).rlike(fixed.ISO_EVIDENCE), F.lit(False)
    )
    grouped = (
        profiles.withColumn("out_name", harmonised_name(F.col("column_name")))
        .groupBy("out_name")
        .agg(
            unsorted(F.min(F.struct("variant", "ordinal_position"))).alias("first_seen"),
            F.sum("non_null_row_count").alias("non_null_row_count"),
            F.bool_or(evidence).alias("has_evidence"),
            F.bool_or(iso).alias("has_iso"),
        )
    )
    dated = F.upper("out_name").contains("DATE") & (~F.col("has_evidence") | F.col("has_iso"))
    empty_filler = F.col("out_name").rlike(r"^Column_\d{3}\z") & (F.col("non_null_row_count") == 0)
    return grouped.where(~empty_filler).select(
        "out_name",
        "first_seen",
        "non_null_row_count",
        F.when(dated, F.lit("DATE")).otherwise(F.lit(fixed.RAW_TEXT_TYPE)).alias("sql_type"),
    )


def source_map(profiles: DataFrame) -> dict[str, dict[str, str]]:
    """variant -> output name -> source column; one row per column of the catalog."""
    mapped: dict[str, dict[str, str]] = {}
    for row in profiles.select(
        "variant", "column_name", harmonised_name(F.col("column_name")).alias("out_name")
    ).collect():
        names_of = mapped.setdefault(row.variant, {})
        if row.out_name in names_of:
            raise ValueError(
                f"{row.variant}: columns {names_of[row.out_name]!r} and {row.column_name!r} both become {row.out_name!r}"
            )
        names_of[row.out_name] = row.column_name
    return mapped


def harmonise(
    variants: dict[str, DataFrame], profiles: DataFrame, null_dates: list[str] | None = None
) -> DataFrame:
    """Union of the variants over the planned columns, keeping every row, with provenance columns.

    ``variants`` maps a variant name to its raw table, whose ``SourceTable`` name is
    ``raw.<variant>`` unless the frame carries one.
    """
    plan = [(row.out_name, row.sql_type) for row in column_plan(profiles).orderBy("first_seen").collect()]
    if not plan:
        raise ValueError("no profiled columns found")
    if any(name.lower() == fixed.AUTO_ID.lower() for name, _ in plan):
        raise ValueError(f"a source column conflicts with the reserved {fixed.AUTO_ID}")
    sources = source_map(profiles)

    def shaped(variant: str, raw: DataFrame) -> DataFrame:
        chosen = []
        for name, sql_type in plan:
            source = sources.get(variant, {}).get(name)
            kind = "date" if sql_type == "DATE" else "string"
            if source is None:
                value = F.lit(None).cast(kind)
            elif sql_type == "DATE":
                value = dates.to_date(F.col(f"`{source}`").cast("string"), null_dates)
            else:
                value = F.left(text.spaces_to_null(F.col(f"`{source}`").cast("string")), F.lit(fixed.TEXT_LIMIT))
            chosen.append(value.alias(name))
        table = F.col(fixed.VARIANT_TABLE) if fixed.VARIANT_TABLE in raw.columns else F.lit(f"raw.{variant}")
        return raw.select(
            *chosen,
            F.lit(variant).alias(fixed.VARIANT),
            table.alias(fixed.VARIANT_TABLE),
            *[name for name in fixed.RAW_METADATA if name in raw.columns],
        )

    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [shaped(variant, variants[variant]) for variant in sorted(variants)],
    )
