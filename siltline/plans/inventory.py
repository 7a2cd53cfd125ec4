"""Folder inventory: settings, shape and quality of every file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline import fixed
from siltline.functions import text
from siltline.operators import profile, records
from siltline.session import cut_lineage
from siltline.sources import delimited, files


def inventory(
    spark: SparkSession, folder: str, delimiter: str | None = None, sample_rows: int = 5, recursive: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(files, columns, issues, samples) of the ``.csv`` files of a folder.

    Files are read per delimiter; cells are counted by (file, position), folded per task before the
    shuffle, so one very large file is as good as many small ones.
    """
    listed = files.list_files(spark, folder, (".csv",), recursive)
    paths = [row[0] for row in listed.where("size_bytes > 0").select("source_file").collect()]
    if not paths:
        raise ValueError(f"no CSV files with content in {folder}")
    settings = cut_lineage(files.file_settings(spark, listed.where("size_bytes > 0"), delimiter))
    by_delimiter: dict[str, list[str]] = {}
    for row in settings.select("source_file", "delimiter").collect():
        by_delimiter.setdefault(row.delimiter, []).append(row.source_file)
    read = None
    for mark, group in by_delimiter.items():
        part = delimited.read_records(spark, group, mark)
        read = part if read is None else read.unionByName(part)

    width = settings.select("source_file", F.size("header").alias("width"))
    data = read.where("record_no > 1").join(width, "source_file")
    blank = records.row_is_blank(F.col("fields"))
    flagged = data.select(
        "source_file", "record_no", "fields", blank.alias("is_blank"),
        (~blank & (F.size("fields") != F.col("width"))).alias("is_malformed"),
    )
    good = flagged.where("not is_blank and not is_malformed")
    counts = flagged.groupBy("source_file").agg(
        F.count_if("is_blank").alias("blank_row_count"),
        F.count_if("is_malformed").alias("malformed_row_count"),
        F.count_if(~F.col("is_blank") & ~F.col("is_malformed")).alias("data_row_count"),
    )
    repeated = records.duplicate_rows(good, "source_file").select("source_file", "duplicate_data_row_count")

    header = F.transform("header", text.strip)
    named = F.filter(header, lambda name: name != "")
    shapes = settings.select(
        "*",
        F.size("header").alias("column_count"),
        F.filter(
            F.transform(header, lambda name, at: F.when(name == "", F.concat(F.lit("column_"), at + 1))),
            lambda name: name.isNotNull(),
        ).alias("empty_headers"),
        F.array_sort(
            F.filter(F.array_distinct(named), lambda name: F.size(F.filter(named, lambda other: other == name)) > 1)
        ).alias("duplicate_headers"),
    )
    zero = ["blank_row_count", "malformed_row_count", "data_row_count", "duplicate_data_row_count"]
    described = (
        listed.join(shapes, "source_file", "left")
        .join(counts, "source_file", "left")
        .join(repeated, "source_file", "left")
        .na.fill(0, zero)
        .withColumn("is_empty", F.col("size_bytes") == 0)
        .withColumn("table_name", F.regexp_replace("file_name", r"(?<=.)\.[^.]*\z", ""))
    )

    cells = good.select("source_file", F.posexplode("fields").alias("at", "raw")).select(
        "source_file", "at", text.blank_to_null(F.col("raw")).alias("value")
    )
    measured = cells.groupBy("source_file", "at").agg(
        F.max(F.length("value")).alias("max_string_length"),
        F.count_if(F.col("value").isNull()).alias("blank_row_count"),
        F.count("value").alias("non_null_row_count"),
        F.coalesce(F.bool_or(text.has_control_characters(F.col("value"))), F.lit(False)).alias("contains_control_characters"),
    )
    columns = (
        settings.select("source_file", F.posexplode(header).alias("at", "column_name"))
        .join(measured, ["source_file", "at"], "left")
        .na.fill(0, ["blank_row_count", "non_null_row_count"])
        .withColumn("ordinal_position", F.col("at") + 1)
        .withColumn("defined_sql_type", F.lit(fixed.RAW_TEXT_TYPE))
        .withColumn("confidence_pct", F.lit(100.0))
        .withColumn("nullable_flag", (F.col("blank_row_count") > 0).cast("int"))
        .withColumn("nullability", F.when(F.col("blank_row_count") > 0, F.lit("NULL")).otherwise(F.lit("NOT NULL")))
        .withColumn("inference_reason", F.lit("fixed_varchar_4000_policy"))
        .drop("at")
    )
    issues = profile.file_issues(described.where("not is_empty"), ["source_file"]).unionByName(
        profile.column_issues(columns, ["source_file"]), allowMissingColumns=True
    )
    samples = records.first_rows(good, ["source_file"], ["record_no"], sample_rows).select(
        "source_file", "sample_no", "fields"
    )
    return profile.file_status(described, issues, ["source_file"]), columns, issues, samples
