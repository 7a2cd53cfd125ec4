"""Headers as data: one row per file with ``header array<string>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltline.functions import names
from siltline.functions.text import strip


def canonical_columns(headers: DataFrame, keys: Sequence[str], header: str = "header") -> DataFrame:
    """One row per header position: unique table-safe names, repeats numbered ``_2``, ``_3``."""
    positions = headers.select(*keys, F.posexplode(header).alias("at", "name")).select(
        *keys,
        (F.col("at") + 1).alias("ordinal_position"),
        strip(F.col("name")).alias("source_name"),
        names.base_name(F.col("name"), F.col("at") + 1).alias("base"),
    )
    repeat = F.row_number().over(Window.partitionBy(*keys, "base").orderBy("ordinal_position"))
    return positions.withColumn("repeat", repeat).select(
        *keys,
        "ordinal_position",
        "source_name",
        F.when(F.col("repeat") == 1, F.col("base"))
        .otherwise(F.concat("base", F.lit("_"), F.col("repeat")))
        .alias("column_name"),
    )


def canonical_names(header: Column) -> Column:
    """The same names as one array, without a shuffle; for headers of ordinary width."""
    base = F.transform(header, lambda name, at: names.base_name(name, at + 1))

    def add(done: Column, name: Column) -> Column:
        repeat = F.size(F.filter(done, lambda earlier: earlier["base"] == name)) + 1
        unique = F.when(repeat == 1, name).otherwise(F.concat(name, F.lit("_"), repeat))
        return F.array_append(done, F.struct(name.alias("base"), unique.alias("name")))

    start = F.array().cast("array<struct<base:string,name:string>>")
    return F.transform(F.aggregate(base, start, add), lambda item: item["name"])


def duplicate_names(headers: DataFrame, keys: Sequence[str], header: str = "header") -> DataFrame:
    """Named columns that occur more than once in a header, with their counts."""
    return (
        headers.select(*keys, F.explode(F.transform(header, strip)).alias("column_name"))
        .where(F.col("column_name") != "")
        .groupBy(*keys, "column_name")
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def describe_headers(headers: DataFrame, header: str = "header") -> DataFrame:
    """Width, hash, blank and repeated names of each header, row by row."""
    stripped = F.transform(header, strip)
    named = F.filter(stripped, lambda name: name != "")
    repeated = F.array_sort(
        F.filter(
            F.array_distinct(named),
            lambda name: F.size(F.filter(named, lambda other: other == name)) > 1,
        )
    )
    return headers.select(
        "*",
        canonical_names(F.col(header)).alias("canonical_columns"),
        F.size(header).alias("column_count"),
        names.header_hash(F.col(header)).alias("header_hash"),
        F.size(F.filter(stripped, lambda name: name == "")).alias("blank_header_count"),
        repeated.alias("duplicate_headers"),
    )
