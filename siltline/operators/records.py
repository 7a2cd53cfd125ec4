"""Record-level gates: a record is a row with ``fields array<string>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltline.functions.text import is_blank, strip


def row_is_blank(fields: Column) -> Column:
    return F.forall(fields, is_blank)


def drop_blank_rows(records: DataFrame, fields: str = "fields") -> DataFrame:
    return records.where(~row_is_blank(F.col(fields)))


def trim_extra_blanks(fields: Column, width: Column) -> Column:
    """Cut surplus trailing fields, but only when every surplus field is blank."""
    surplus = F.slice(fields, width + 1, F.greatest(F.size(fields) - width, F.lit(0)))
    return F.when(
        (F.size(fields) > width) & F.forall(surplus, is_blank), F.slice(fields, F.lit(1), width)
    ).otherwise(fields)


def mark_malformed(records: DataFrame, width: Column | int, fields: str = "fields") -> DataFrame:
    """Trim surplus blanks and flag records whose field count differs from the header's."""
    expected = F.lit(width) if isinstance(width, int) else width
    trimmed = trim_extra_blanks(F.col(fields), expected)
    return records.withColumn(fields, trimmed).withColumn("is_malformed", F.size(fields) != expected)


def gate_by_file(
    marked: DataFrame, file: str, allowed: int, files: DataFrame | None = None
) -> DataFrame:
    """Good and malformed counts per file with the two load gates.

    ``files`` lists files that must appear even without records, so that an empty file fails too.
    """
    counts = marked.groupBy(file).agg(
        F.count_if(~F.col("is_malformed")).alias("row_count"),
        F.count_if("is_malformed").alias("malformed_row_count"),
    )
    if files is not None:
        counts = files.select(file).join(counts, file, "left").na.fill(0)
    return counts.withColumn(
        "malformed_threshold_exceeded", F.col("malformed_row_count") > allowed
    ).withColumn("has_no_data", F.col("row_count") == 0)


def duplicate_rows(records: DataFrame, file: str, fields: str = "fields") -> DataFrame:
    """Per file, how many full rows repeat an earlier one, comparing stripped values.

    Rows are compared by the SHA-256 of their values: the shuffle carries digests, and copies
    are counted before it.
    """
    digest = F.sha2(F.to_json(F.transform(F.col(fields), strip)), 256)
    return (
        records.groupBy(file, digest.alias("digest"))
        .count()
        .groupBy(file)
        .agg(
            F.sum("count").alias("data_row_count"),
            F.sum(F.col("count") - 1).alias("duplicate_data_row_count"),
        )
    )


def first_rows(df: DataFrame, group: list[str], order: list, limit: int, rank: str = "sample_no") -> DataFrame:
    """First ``limit`` rows of each group; Spark keeps only that many per task before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)
