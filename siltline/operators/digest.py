"""Digest of load-error text: which rows, which columns, which messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline import fixed
from siltline.functions import text
from siltline.operators.folding import unsorted


def parse_errors(lines: DataFrame, line: str = "line") -> DataFrame:
    """Row number, column name and number-free message of each non-blank error line."""
    body = text.strip(F.col(line))
    message = body
    for pattern, shown in fixed.ERROR_MASKS:
        message = F.regexp_replace(message, pattern, shown)
    return lines.where(body != "").select(
        "*",
        F.nullif(F.regexp_extract(body, fixed.ERROR_ROW, 1), F.lit("")).try_cast("bigint").alias("error_row"),
        F.nullif(F.regexp_extract(body, fixed.ERROR_COLUMN, 1), F.lit("")).alias("error_column"),
        message.alias("message"),
    )


def top_messages(parsed: DataFrame, order: str, limit: int = fixed.DIGEST_SAMPLE) -> DataFrame:
    """Most frequent messages; ties go to the one seen first."""
    counted = parsed.groupBy("message").agg(F.count("*").alias("line_count"), F.min(order).alias("first_at"))
    return counted.orderBy(F.desc("line_count"), "first_at").limit(limit)


def digest(parsed: DataFrame) -> DataFrame:
    """One row: error lines, distinct error rows (or lines when none is named), samples of both.

    Distinct values are folded before sampling, and samples are the first few of a sorted limit.
    """
    sample = fixed.DIGEST_SAMPLE

    def first(column: str) -> DataFrame:
        few = parsed.where(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1)).orderBy(column).limit(sample)
        return few.agg(F.array_join(F.array_sort(F.collect_list(column)).cast("array<string>"), ",").alias(f"sample_{column}s"))

    counts = parsed.agg(F.count("*").alias("error_line_count"), F.count_distinct("error_row").alias("rows"))
    facts = counts.unionByName(first("error_row"), allowMissingColumns=True).unionByName(
        first("error_column"), allowMissingColumns=True
    )
    one = facts.agg(*[unsorted(F.max(c)).alias(c) for c in facts.columns])
    return one.select(
        "error_line_count",
        F.when(F.col("rows") > 0, F.col("rows")).otherwise(F.col("error_line_count")).alias("error_row_count"),
        "sample_error_rows",
        "sample_error_columns",
    )
