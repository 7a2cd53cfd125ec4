"""Latest-wins reads of the append-only profile history.

"Latest" is an aggregate (``max_by``), folded per task before the shuffle: a table or column with a
very long history costs one row per task, where a ranking window would bring it whole to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline import fixed
from siltline.functions import names
from siltline.operators.folding import unsorted


def prior_types(history: DataFrame, stage: str = "PRELOAD_CSV") -> DataFrame:
    """Latest defined type per (table, column)."""
    return (
        history.where(F.col("CountStage") == stage)
        .groupBy("TableName", "ColumnName")
        .agg(unsorted(F.max_by("DefinedSqlType", "AutoId")).alias("DefinedSqlType"))
    )


def carried_types(tables: DataFrame, history: DataFrame, stage: str = "PRELOAD_CSV") -> DataFrame:
    """Prior types for each table of ``tables`` (``TableName``); a table without any history of its
    own takes those of its name without the trailing number."""
    known = prior_types(history, stage)
    own = tables.select("TableName").distinct().join(known, "TableName")
    lacking = tables.select("TableName").distinct().join(known.select("TableName").distinct(), "TableName", "left_anti")
    plain = lacking.withColumn("plain", names.plain_table_name(F.col("TableName"))).where("plain <> TableName")
    borrowed = plain.join(known.withColumnRenamed("TableName", "plain"), "plain").drop("plain")
    return own.unionByName(borrowed)


def latest_profile(history: DataFrame, stage: str = "PRELOAD_CSV") -> DataFrame:
    """Latest row per (table, column) by capture time, then key."""
    values = [c for c in history.columns if c not in ("TableName", "ColumnName")]
    newest = F.max_by(F.struct(*values), F.struct("CapturedAt", "AutoId"))
    return (
        history.where(F.col("CountStage") == stage)
        .groupBy("TableName", "ColumnName")
        .agg(unsorted(newest).alias("row"))
        .select("TableName", "ColumnName", "row.*")
    )


def latest_run_rows(history: DataFrame, stage: str = "PRELOAD_CSV") -> DataFrame:
    """All rows of the most recent run of each table."""
    at_stage = history.where(F.col("CountStage") == stage)
    latest = at_stage.groupBy("TableName").agg(unsorted(F.max_by("RunID", "AutoId")).alias("RunID"))
    return at_stage.join(latest, ["TableName", "RunID"])


def entity_types(history: DataFrame, entity: str, stage: str = "PRELOAD_CSV") -> DataFrame:
    """Distinct latest types per column over an entity's variant tables (``raw.<entity>_V..``)."""
    prefix = f"raw.{entity}_V"
    newest = latest_profile(history.where(F.col("TableName").startswith(prefix)), stage)
    chosen = F.coalesce(
        F.nullif("RecommendedSqlType", F.lit("")), F.nullif("DefinedSqlType", F.lit("")), F.lit(fixed.RAW_TEXT_TYPE)
    )
    return newest.select("ColumnName", F.upper(chosen).alias("sql_type")).distinct()


def reconcile_types(types: DataFrame, key: str = "ColumnName") -> DataFrame:
    """One type per column from several: any typed variant beats text; dates beat money beats decimals
    beat integers; text takes the widest. Of several decimals the result holds all: the most digits
    before the point and the most behind it, the latter cut where both pass 38."""
    kind = F.col("sql_type")
    is_text = kind.rlike("^(N?VARCHAR|N?CHAR)")
    length = F.when(kind.contains("(MAX)"), fixed.TEXT_LIMIT).otherwise(
        F.coalesce(F.regexp_extract(kind, r"\((\d+)\)", 1).try_cast("int"), F.lit(0))
    )
    rank = (
        F.when(is_text, 0)
        .when(kind.rlike("^(DATE|SMALLDATETIME)"), 5)
        .when(kind == "MONEY", 4)
        .when(kind.rlike("^(DECIMAL|NUMERIC)"), 3)
        .when(kind.isin("INT", "BIGINT", "SMALLINT", "TINYINT"), 2)
        .otherwise(1)
    )
    digits = F.regexp_extract(kind, r"\((\d+)", 1).try_cast("int")
    scale = F.coalesce(F.regexp_extract(kind, r",\s*(\d+)", 1).try_cast("int"), F.lit(0))
    best = types.groupBy(key).agg(
        F.max(rank).alias("rank"),
        F.max(F.when(is_text, length)).alias("width"),
        F.max(F.when(rank == 3, F.coalesce(digits, F.lit(18)) - scale)).alias("whole"),
        F.max(F.when(rank == 3, scale)).alias("scale"),
        unsorted(F.min(F.when(rank == 1, kind))).alias("other"),
    )
    width = F.when((F.col("width") == 0) | (F.col("width") == fixed.TEXT_LIMIT), fixed.TEXT_LIMIT).otherwise(F.col("width"))
    behind = F.least(F.col("scale"), 38 - F.col("whole"))
    decimal = F.concat(F.lit("DECIMAL("), F.col("whole") + behind, F.lit(", "), behind, F.lit(")"))
    return best.select(
        key,
        F.when(F.col("rank") == 5, F.lit("DATE"))
        .when(F.col("rank") == 4, F.lit("MONEY"))
        .when(F.col("rank") == 3, decimal)
        .when(F.col("rank") == 2, F.lit("INT"))
        .when(F.col("rank") == 1, F.col("other"))
        .otherwise(F.concat(F.lit("VARCHAR("), width, F.lit(")")))
        .alias("sql_type"),
    )
