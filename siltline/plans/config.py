"""Pipeline entries: what to read and which tables to fill."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline.functions import names
from siltline.operators import headers, variants
from siltline.session import cut_lineage
from siltline.sources import files
from siltline.sources.exports import ExportProfile


@dataclass(frozen=True)
class Pipeline:
    name: str
    source_table: str
    profile: ExportProfile | None = None
    staging_table: str | None = None
    target_table: str | None = None
    staging_sql_file: str | None = None
    target_sql_file: str | None = None
    source_entity: str | None = None
    schema_variant_key: str | None = None

    @classmethod
    def from_config(cls, name: str, entry: dict) -> "Pipeline":
        known = {k: entry[k] for k in cls.__dataclass_fields__ if k in entry}
        if "preload_profile" in entry:
            known["profile"] = ExportProfile.from_config(entry["preload_profile"])
        return cls(name=name, **known)


def described_files(
    spark: SparkSession,
    folder: str,
    extensions: tuple[str, ...] = (".csv",),
    delimiter: str = "auto",
    recursive: bool = False,
    prefix: str | None = None,
    suffix: str | None = None,
    entity=names.entity_key,
) -> DataFrame:
    """One row per file of a folder: entity, settings and described header. Written once.

    An empty file has no header and an entity may come out empty; both are refused.
    """
    listed = files.list_files(spark, folder, extensions, recursive)
    paths = [row[0] for row in listed.select("source_file").collect()]
    if not paths:
        raise ValueError(f"no files with {extensions} under {folder}")
    settings = files.file_settings(spark, paths, None if delimiter == "auto" else delimiter)
    headed = listed.join(settings, "source_file", "left")
    empty = headed.where(F.col("header").isNull() | (F.size("header") == 0)).limit(1).collect()
    if empty:
        raise ValueError(f"source file is empty: {empty[0]['source_file']}")
    described = headers.describe_headers(headed)
    named = cut_lineage(described.withColumn("entity_name", entity(F.col("file_name"), prefix, suffix)))
    if named.where(F.coalesce("entity_name", F.lit("")) == "").limit(1).collect():
        raise ValueError("a file name leaves no entity name")
    return named


def analyze_folder(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, variants, files) of a folder, ready for a report."""
    described = described_files(spark, folder, **options)
    return variants.entity_summary(described), variants.variants(described), described


def build_config(
    spark: SparkSession,
    folder: str,
    extensions: tuple[str, ...] = (".csv",),
    delimiter: str = ",",
    prefix: str | None = None,
    suffix: str | None = None,
    split_variants: bool = False,
    canonicalize_headers: bool = False,
    has_header: bool = True,
    recursive: bool = True,
    include_staging: bool = False,
) -> dict[str, dict]:
    """Pipeline entries for the files of a folder, one per entity or per header variant.

    The result is the configuration itself, so it is as long as the list of files.
    """
    described = described_files(spark, folder, extensions, delimiter, recursive, prefix, suffix, names.entity_from_file)
    if split_variants:
        placed = variants.variant_files(described)
    else:
        placed = described.withColumn("pipeline_name", F.col("entity_name"))
    if not has_header:
        columns = F.transform("header", lambda _, at: names.ordinal_name(at + 1))
    elif canonicalize_headers:
        columns = F.col("canonical_columns")
    else:
        columns = F.transform("header", lambda name: F.trim(name))
    rows = (
        placed.groupBy("pipeline_name", "entity_name", *(["header_hash"] if split_variants else []))
        .agg(
            F.array_sort(F.collect_list("source_file")).alias("source_files"),
            F.min_by(F.struct(columns.alias("columns"), "delimiter"), "source_file").alias("sample"),
        )
        .orderBy("pipeline_name")
        .collect()
    )
    config: dict[str, dict] = {}
    for row in rows:
        profile = {
            "source_files": list(row.source_files),
            "column_mappings": {name: name for name in row.sample.columns},
            "max_malformed_rows": 0,
            "has_header": has_header,
            "delimiter": row.sample.delimiter,
        }
        if canonicalize_headers and has_header:
            profile["canonicalize_headers"] = True
        entry: dict = {"source_table": f"raw.{row.pipeline_name}", "preload_profile": profile}
        if split_variants:
            entry |= {"source_entity": row.entity_name, "schema_variant_key": row.header_hash}
        if include_staging:
            entry["staging_table"] = "stg." + "".join(part.capitalize() for part in row.pipeline_name.split("_"))
        config[row.pipeline_name] = entry
    return config
