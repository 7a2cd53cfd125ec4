"""Malformed records together with the records around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_context(
    records: DataFrame,
    width: Column | int,
    context: int = 5,
    file: str = "source_file",
) -> DataFrame:
    """One group of rows per malformed record.

    ``records`` holds one row per physical record after the header: ``file``, dense ``record_no``,
    ``line_no`` (last line of the record), ``raw_text``, ``field_count`` (after trimming) and
    ``is_malformed``. A group has up to ``context`` records before the malformed one, itself, and
    later records no more than ``context`` lines away. Neighbours are found by an equi-join on
    (file, record_no): each malformed record asks for its few neighbours by number, so one large
    file spreads over all tasks.
    """
    if context < 0:
        raise ValueError("context must not be negative")
    wanted = (
        records.where("is_malformed")
        .select(
            F.col(file),
            F.col("record_no").alias("center_no"),
            F.col("line_no").alias("center_line"),
            F.explode(F.array(*[F.lit(step) for step in range(-context, context + 1)])).alias("step"),
        )
        .withColumn("record_no", F.col("center_no") + F.col("step"))
    )
    distance = F.col("line_no") - F.col("center_line")
    role = (
        F.when(F.col("step") < 0, F.lit("before"))
        .when(F.col("step") == 0, F.lit("malformed"))
        .otherwise(F.lit("after"))
    )
    expected = F.lit(width) if isinstance(width, int) else width
    return (
        wanted.join(records, [file, "record_no"])
        .where((F.col("step") <= 0) | (distance <= context))
        .select(
            F.col(file),
            F.concat(_stem(F.col(file)), F.lit(":row:"), F.col("center_line")).alias("malformed_group_id"),
            role.alias("row_role"),
            distance.alias("relative_offset"),
            F.col("is_malformed").cast("int").alias("is_malformed"),
            F.col("line_no").alias("physical_row_number"),
            expected.alias("expected_column_count"),
            F.col("field_count").alias("actual_column_count"),
            F.col("raw_text").alias("raw_line_text"),
        )
    )


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"^.*[/\\]", ""), r"(?<=.)\.[^.]*\z", "")
