"""A configured export: several files of one shape, opened as records under a header."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltline import fixed
from siltline.functions import names
from siltline.operators import headers, records
from siltline.sources import delimited, files


@dataclass(frozen=True)
class ExportProfile:
    """The ``preload_profile`` part of a pipeline entry."""

    source_files: tuple[str, ...]
    column_mappings: dict[str, str] = field(default_factory=dict)
    delimiter: str = ","
    has_header: bool = True
    header_row_number: int = 1
    canonicalize_headers: bool = False
    max_malformed_rows: int = 0
    column_sql_types: dict[str, str] = field(default_factory=dict)
    date_null_sentinels: tuple[str, ...] = tuple(fixed.NULL_DATES)

    @classmethod
    def from_config(cls, profile: dict) -> "ExportProfile":
        known = {name: profile[name] for name in cls.__dataclass_fields__ if name in profile}
        known["source_files"] = tuple(files.resolve_paths(profile))
        if "date_null_sentinels" in known:
            known["date_null_sentinels"] = tuple(known["date_null_sentinels"])
        for target in dict(known.get("column_sql_types", {})):
            text_width(known["column_sql_types"][target])
        return cls(**known)


def text_width(declared: str) -> int | None:
    """Length limit of a raw column; only the two raw text types are allowed."""
    kind = declared.strip().upper()
    if kind not in fixed.RAW_TEXT_TYPES:
        raise ValueError(f"raw columns are VARCHAR(4000) or VARCHAR(MAX), not {declared!r}")
    return None if kind == "VARCHAR(MAX)" else fixed.TEXT_LIMIT


@dataclass(frozen=True)
class Export:
    """``records``: from the header record on, trimmed to the header's width and flagged
    ``is_header``, ``same_header``, ``is_blank`` and ``is_malformed``."""

    columns: list[str]
    records: DataFrame
    allowed_malformed: int = 0

    @property
    def width(self) -> int:
        return len(self.columns)

    @property
    def data(self) -> DataFrame:
        return self.records.where("not is_header")

    def good(self) -> DataFrame:
        return self.records.where("not is_header and not is_malformed and not is_blank")

    def value(self, name: str) -> Column:
        if name not in self.columns:
            raise ValueError(f"column {name!r} is not in the header {self.columns}")
        return F.get("fields", F.lit(self.columns.index(name)))


def header_columns(spark: SparkSession, header: list[str], has_header: bool, canonical: bool) -> list[str]:
    """Column names of a header record."""
    table = spark.createDataFrame([(header,)], "header array<string>")
    if not has_header:
        named = F.transform("header", lambda _, at: names.ordinal_name(at + 1))
        return list(table.select(named).first()[0])
    trimmed = table.select(names.trim_header(F.col("header")).alias("header"))
    if canonical:
        trimmed = trimmed.select(headers.canonical_names(F.col("header")).alias("header"))
    return list(trimmed.first()["header"])


def open_export(spark: SparkSession, profile: ExportProfile) -> Export:
    """Read all files of a profile. The first file's header names the columns; other files must
    carry the same header, which :func:`file_gates` checks."""
    paths = list(profile.source_files)
    for path in paths:
        if len(path) > fixed.MAX_PATH:
            raise ValueError(f"source file path exceeds {fixed.MAX_PATH} characters: {path}")
    number = profile.header_row_number
    header = files.read_header(spark, paths[0], profile.delimiter, number)
    columns = header_columns(spark, header, profile.has_header, profile.canonicalize_headers)
    read = delimited.read_records(spark, paths, profile.delimiter).where(F.col("record_no") >= number)
    heading = names.trim_header(F.col("fields"))
    if profile.canonicalize_headers:
        heading = headers.canonical_names(heading)
    is_header = (F.col("record_no") == number) if profile.has_header else F.lit(False)
    # The flag column is computed before the fields are cut to the header's width.
    flagged = read.withColumn("is_header", is_header).withColumn(
        "same_header",
        F.when(F.col("is_header"), heading == F.array(*[F.lit(name) for name in columns])),
    )
    marked = records.mark_malformed(flagged, len(columns)).withColumn(
        "is_blank", records.row_is_blank(F.col("fields"))
    )
    return Export(
        columns,
        marked.withColumn("is_malformed", F.col("is_malformed") & ~F.col("is_blank") & ~F.col("is_header")),
        profile.max_malformed_rows,
    )


def file_gates(export: Export, *measures: Column) -> DataFrame:
    """Good and malformed counts per file with the malformed, no-data and header gates, in one
    pass; a file that ends before its header record has no row. ``measures`` are computed alongside."""
    good = ~F.col("is_header") & ~F.col("is_blank") & ~F.col("is_malformed")
    return (
        export.records.groupBy("source_file")
        .agg(
            F.count_if(good).alias("row_count"),
            F.count_if("is_malformed").alias("malformed_row_count"),
            F.coalesce(F.bool_and("same_header"), F.lit(True)).alias("same_header"),
            *measures,
        )
        .withColumn("malformed_threshold_exceeded", F.col("malformed_row_count") > export.allowed_malformed)
        .withColumn("has_no_data", F.col("row_count") == 0)
    )
