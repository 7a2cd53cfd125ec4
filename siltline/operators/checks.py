"""Row-count reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline import fixed


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts and whether they match."""
    tagged = source.select(F.lit(True).alias("is_source")).unionAll(target.select(F.lit(False).alias("is_source")))
    counted = tagged.agg(
        F.count_if("is_source").alias("source_row_count"), F.count_if(~F.col("is_source")).alias("target_row_count")
    )
    return counted.withColumn("is_match", F.col("source_row_count") == F.col("target_row_count"))


def counts_by_load(table: DataFrame) -> DataFrame:
    """Rows per load slice (load time and source file)."""
    return table.groupBy(*fixed.RAW_METADATA).agg(F.count("*").alias("row_count"))


def partial_loads(written: DataFrame, table: DataFrame) -> DataFrame:
    """Slices whose stored count differs from the written count (``row_count`` per slice)."""
    expected = written.withColumnRenamed("row_count", "written_count")
    return (
        expected.join(counts_by_load(table), fixed.RAW_METADATA, "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        .where("row_count <> written_count")
    )
