"""Header variants per entity and the comparison of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from siltline import fixed
from siltline.operators.folding import unsorted


def variants(headers: DataFrame) -> DataFrame:
    """One row per (entity, header hash) from described headers: files counted, first file kept."""
    return headers.groupBy("entity_name", "header_hash").agg(
        F.count("*").alias("file_count"),
        unsorted(F.min("file_name")).alias("first_file"),
        F.max("column_count").alias("column_count"),
        F.max("blank_header_count").alias("blank_header_count"),
        unsorted(F.max("duplicate_headers")).alias("duplicate_headers"),
        unsorted(F.max("canonical_columns")).alias("canonical_columns"),
    )


def entity_summary(headers: DataFrame) -> DataFrame:
    """Shape drift per entity and what to do about it.

    Files are first folded into variants, so an entity with very many files costs no more than one
    with few.
    """
    shapes = variants(headers)
    counted = shapes.groupBy("entity_name").agg(
        F.sum("file_count").alias("file_count"),
        F.count("*").alias("variant_count"),
        F.min("column_count").alias("min_column_count"),
        F.max("column_count").alias("max_column_count"),
        F.sum(F.col("blank_header_count") * F.col("file_count")).alias("total_blank_header_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("duplicate_headers")))).alias("duplicate_headers"),
    )
    united = (
        shapes.select("entity_name", "first_file", F.posexplode("canonical_columns").alias("at", "column_name"))
        .groupBy("entity_name", "column_name")
        .agg(unsorted(F.min(F.struct("first_file", "at"))).alias("first_seen"))
        .groupBy("entity_name")
        .agg(F.array_sort(F.collect_list(F.struct("first_seen", "column_name"))).alias("seen"))
        .select(
            "entity_name",
            F.size("seen").alias("canonical_union_column_count"),
            F.transform("seen", lambda item: item["column_name"]).alias("canonical_union_columns"),
        )
    )
    drift = F.col("min_column_count") != F.col("max_column_count")
    clean = (
        (F.col("variant_count") == 1)
        & (F.col("total_blank_header_count") == 0)
        & (F.size("duplicate_headers") == 0)
    )
    return (
        counted.join(united, "entity_name")
        .withColumn("has_column_count_drift", drift)
        .withColumn(
            "recommendation",
            F.when(clean, F.lit(fixed.SINGLE_SHAPE))
            .when(~drift, F.lit(fixed.SINGLE_SHAPE_CLEANUP))
            .otherwise(F.lit(fixed.SHAPES_DIFFER)),
        )
    )


def numbered_variants(headers: DataFrame) -> DataFrame:
    """(entity, hash) -> ``ENTITY_V01`` and so on, in hash order within the entity."""
    distinct = variants(headers)
    number = F.row_number().over(Window.partitionBy("entity_name").orderBy("header_hash"))
    padded = F.when(number < 10, F.concat(F.lit("0"), number)).otherwise(number.cast("string"))
    return distinct.withColumn("pipeline_name", F.concat("entity_name", F.lit("_V"), padded))


def variant_files(headers: DataFrame) -> DataFrame:
    """Every file with the pipeline it belongs to."""
    keys = ["entity_name", "header_hash"]
    return headers.join(numbered_variants(headers).select(*keys, "pipeline_name"), keys)


def ordinal_conflicts(columns: DataFrame) -> DataFrame:
    """Positions that carry more than one name across an entity's variants."""
    return (
        columns.groupBy("entity_name", "ordinal_position")
        .agg(F.array_sort(F.collect_set("column_name")).alias("column_names"))
        .where(F.size("column_names") > 1)
    )


def column_presence(columns: DataFrame) -> DataFrame:
    """The columns of all variants with their presence (common or variant_only) and fill rate.

    ``columns`` is the column catalog: ``entity_name, pipeline_name, column_name`` and counts.
    """
    totals = columns.groupBy("entity_name").agg(F.countDistinct("pipeline_name").alias("variant_count"))
    spread = columns.groupBy("entity_name", "column_name").agg(
        F.countDistinct("pipeline_name").alias("present_in")
    )
    filled, blank = (F.coalesce(F.col(c), F.lit(0)) for c in ("non_null_row_count", "blank_row_count"))
    common = F.col("present_in") == F.col("variant_count")
    return (
        columns.join(spread, ["entity_name", "column_name"])
        .join(totals, "entity_name")
        .withColumn("presence", F.when(common, F.lit("common")).otherwise(F.lit("variant_only")))
        .withColumn("fill_rate", F.round(filled / F.nullif(filled + blank, F.lit(0)), 6))
    )


def entity_report(columns: DataFrame) -> DataFrame:
    """Per entity: variants, rows, common and united columns, and the next step."""
    spread = (
        column_presence(columns)
        .groupBy("entity_name", "column_name")
        .agg(unsorted(F.max("presence")).alias("presence"))
        .groupBy("entity_name")
        .agg(
            F.count_if(F.col("presence") == "common").alias("common_column_count"),
            F.count("*").alias("union_column_count"),
        )
    )
    rows = (
        columns.groupBy("entity_name", "pipeline_name")
        .agg(F.max("row_count").alias("row_count"))
        .groupBy("entity_name")
        .agg(F.count("*").alias("variant_count"), F.sum("row_count").alias("total_row_count"))
    )
    conflicts = ordinal_conflicts(columns).groupBy("entity_name").agg(F.count("*").alias("ordinal_conflict_count"))
    conflicted = F.col("ordinal_conflict_count") > 0
    return (
        rows.join(spread, "entity_name")
        .join(conflicts, "entity_name", "left")
        .withColumn("ordinal_conflict_count", F.coalesce("ordinal_conflict_count", F.lit(0)))
        .withColumn(
            "recommendation",
            F.when(conflicted, F.lit(fixed.UNION_CONFLICTS))
            .when(F.col("common_column_count") == F.col("union_column_count"), F.lit(fixed.UNION_READY))
            .otherwise(F.lit(fixed.UNION_VARIANT_ONLY)),
        )
    )
