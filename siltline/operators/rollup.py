"""Run summaries from the audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltline import fixed
from siltline.operators.folding import unsorted
from siltline.operators.records import first_rows


def _lookup(mapping: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])[key]


def run_state(events: DataFrame) -> DataFrame:
    """Current state of each run from append-only run events: later events overlay earlier ones."""
    filled = [c for c in events.columns if c not in ("RunID", "EventId")]
    return events.groupBy("RunID").agg(
        *[unsorted(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("EventId")))).alias(c) for c in filled]
    )


def summarise_runs(runs: DataFrame, counts: DataFrame, loads: DataFrame) -> DataFrame:
    """One row per run and step plus a PIPELINE_TOTAL row per run, for all runs at once."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    keys = ["RunID", "step_name"]

    # The last count of a stage wins.
    counted = (
        counts.groupBy("RunID", F.col("CountStage").alias("step_name"))
        .agg(
            unsorted(
                F.max_by(
                    F.struct("TableName", "SourceFile", "ProperRowCount", "MalformedRowCount", "RepairedRowCount", "CapturedAt"),
                    F.struct("CapturedAt", "TableRowCountLogID"),
                )
            ).alias("c")
        )
    )

    staged = loads.withColumn("step_name", _lookup({**fixed.METHOD_STEP, fixed.RAW_METHOD: "RAW_LOAD"}, F.col("LoadMethod"))).where("step_name is not null")
    order = F.struct("StartedAt", "LoadExecutionLogID")
    status = (
        F.when(F.count_if(F.col("LoadStatus") == "FAILED") > 0, F.lit("FAILED"))
        .when(F.count_if(F.col("LoadStatus") == "SUCCESS") > 0, F.lit("SUCCESS"))
        .otherwise(F.coalesce(F.max_by(F.nullif("LoadStatus", F.lit("")), F.when(F.col("LoadStatus") != "", order)), F.lit("")))
    )
    loaded = staged.groupBy(*keys).agg(
        unsorted(status).alias("step_status"),
        F.sum(F.coalesce("DurationMs", F.lit(0))).alias("duration_ms"),
        F.min("StartedAt").alias("started_at"),
        F.max("FinishedAt").alias("finished_at"),
        F.array_join(F.array_sort(F.collect_set("LoadMethod")), ",").alias("load_methods"),
        F.sum(F.coalesce("ChunkRowCount", F.lit(0))).alias("chunk_rows"),
        unsorted(F.max_by(F.struct("TableName", "SourceFile"), order)).alias("last"),
    )
    # The first three notes of a step: only three rows per step and task are shuffled.
    noted = staged.where(F.coalesce("DetailMessage", F.lit("")) != "")
    notes = (
        first_rows(noted, keys, [F.col("StartedAt"), F.col("LoadExecutionLogID")], 3, "note_no")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("note_no", "DetailMessage"))).alias("items"))
        .select(*keys, F.array_join(F.transform("items", lambda item: item["DetailMessage"]), " | ").alias("notes"))
    )
    steps = (
        counted.join(loaded, keys, "full_outer")
        .join(notes, keys, "left")
        .select(
            *keys,
            "step_status",
            F.coalesce(F.nullif("c.TableName", F.lit("")), "last.TableName").alias("table_name"),
            F.coalesce(F.nullif("c.SourceFile", F.lit("")), "last.SourceFile").alias("source_name"),
            F.coalesce(F.nullif("c.ProperRowCount", F.lit(0)), "chunk_rows", "c.ProperRowCount").cast("bigint").alias("proper_row_count"),
            F.when(F.col("c").isNull(), 0).otherwise(F.col("c.MalformedRowCount")).cast("bigint").alias("malformed_row_count"),
            F.when(F.col("c").isNull(), 0).otherwise(F.col("c.RepairedRowCount")).cast("bigint").alias("repaired_row_count"),
            F.col("duration_ms").cast("bigint").alias("duration_ms"),
            text("started_at").alias("started_at"),
            text("finished_at").alias("finished_at"),
            text("c.CapturedAt").alias("captured_at"),
            "load_methods",
            F.when(F.col("load_methods").isNotNull(), F.coalesce("notes", F.lit(""))).alias("notes"),
        )
    )
    named = runs.select("RunID", F.col("PipelineName").alias("pipeline_name"), F.col("Status").alias("pipeline_status"))
    totals = runs.select(
        "RunID",
        F.lit("PIPELINE_TOTAL").alias("step_name"),
        F.col("Status").alias("step_status"),
        F.col("TargetTable").alias("table_name"),
        F.col("SourceTable").alias("source_name"),
        F.coalesce("TargetRowCount", "SourceRowCount").cast("bigint").alias("proper_row_count"),
        F.lit(0).cast("bigint").alias("malformed_row_count"),
        F.lit(0).cast("bigint").alias("repaired_row_count"),
        F.col("DurationMs").cast("bigint").alias("duration_ms"),
        text("StartTime").alias("started_at"),
        text("EndTime").alias("finished_at"),
        F.lit(None).cast("string").alias("captured_at"),
        F.lit(None).cast("string").alias("load_methods"),
        F.col("ErrorMessage").alias("notes"),
    )
    return (
        steps.unionByName(totals)
        .join(named, "RunID")
        .withColumn("step_order", F.coalesce(_lookup(fixed.STEP_ORDER, F.col("step_name")), F.lit(99)))
        .select(
            F.col("RunID").alias("run_id"), "pipeline_name", "pipeline_status", "step_name", "step_order", "step_status",
            "table_name", "source_name", "proper_row_count", "malformed_row_count", "repaired_row_count",
            "duration_ms", "started_at", "finished_at", "captured_at", "load_methods", "notes",
        )
    )


def summarise_day(runs: DataFrame, counts: DataFrame, loads: DataFrame, day: str) -> DataFrame:
    """The summary of the runs that started on ``day``; only their audit rows are read."""
    chosen = runs.where(F.to_date("StartTime") == F.lit(day).cast("date"))
    ids = chosen.select("RunID").distinct()
    return summarise_runs(
        chosen, counts.join(ids, "RunID", "left_semi"), loads.join(ids, "RunID", "left_semi")
    )
