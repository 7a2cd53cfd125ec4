"""Run one pipeline through the layers, with gates and audit rows."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline.operators import history, quarantine
from siltline.plans import layers
from siltline.plans.audit import Audit
from siltline.plans.config import Pipeline
from siltline.sources.exports import Export, open_export
from siltline.sources.files import source_label

MODES = ("full", "profile", "raw", "staging", "zen")


def run_pipeline(
    spark: SparkSession,
    pipeline: Pipeline,
    mode: str = "full",
    audit: Audit | None = None,
    sql_folder: str = "sql",
    type_authority: str = "recommended",
    blank_policy: str = "default",
    reset_audit: bool = True,
) -> str:
    """Run ``pipeline`` and return its run id.

    ``profile`` empties the audit trail and only profiles; ``raw`` profiles and loads raw without a
    run row; ``staging`` and ``zen`` start from the table before; ``full`` does everything
    configured. A failure is logged and raised.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    audit = audit or Audit(spark)
    if mode == "profile" and reset_audit:
        audit.reset()
    run = _Run(spark, pipeline, audit, uuid.uuid4().hex[:8], sql_folder, type_authority, blank_policy)
    if mode != "raw":
        audit.start_run(run.id, pipeline.name, pipeline.source_table, pipeline.target_table, run.started)
    try:
        status, error = run.go(mode)
    except Exception as failure:
        if mode != "raw":
            audit.end_run(run.id, run.started, datetime.now(), "FAILED", run.source_rows, run.target_rows, str(failure))
        raise
    if mode != "raw":
        audit.end_run(run.id, run.started, datetime.now(), status, run.source_rows, run.target_rows, error)
    return run.id


class _Run:
    def __init__(self, spark, pipeline: Pipeline, audit: Audit, run_id: str, sql_folder: str, type_authority: str, blank_policy: str):
        self.spark, self.pipeline, self.audit, self.id = spark, pipeline, audit, run_id
        self.sql_folder, self.type_authority, self.blank_policy = sql_folder, type_authority, blank_policy
        self.started = datetime.now()
        self.source_rows = self.target_rows = None

    def go(self, mode: str) -> tuple[str, str | None]:
        p = self.pipeline
        if mode == "staging" and not p.staging_table:
            raise ValueError(f"pipeline {p.name!r} has no staging_table")
        if mode == "zen" and not (p.staging_table and p.target_table):
            raise ValueError(f"pipeline {p.name!r} needs a staging_table and a target_table")
        if p.profile and mode in ("full", "profile", "raw"):
            export = open_export(self.spark, p.profile)
            exceeded = self.profile(export, enforce=mode != "profile")
            if mode == "profile":
                if exceeded:
                    return "PROFILED_WARN", "Malformed row threshold exceeded during profile-only run."
                return "PROFILED", None
            self.load_raw(export, backfill=mode != "raw")
        if mode == "raw":
            return "SUCCESS", None
        if mode != "zen":
            if p.staging_sql_file:
                self.sql_step(p.staging_sql_file, p.staging_table, p.source_table, "SQL_TO_STG")
            elif p.staging_table:
                self.stage()
            else:
                self.source_rows = self.spark.table(p.source_table).count()
                self.audit.count(self.id, p.name, p.source_table, "RAW_LOAD", self.source_rows)
                return "SUCCESS", None
            self.source_rows, self.target_rows = layers.reconciled(self.spark, p.source_table, p.staging_table)
            self.audit.count(self.id, p.name, p.staging_table, "STAGING_LOAD", self.target_rows, source=p.source_table)
        if mode == "staging":
            return "SUCCESS", None
        if p.staging_sql_file and p.target_sql_file and mode == "full":
            self.target_rows = self.sql_step(p.target_sql_file, p.target_table, p.staging_table, "SQL_TO_TARGET")
            self.audit.count(self.id, p.name, p.target_table, "TARGET_LOAD", self.target_rows, source=p.staging_table)
        elif p.target_table and (mode == "zen" or not p.staging_sql_file):
            self.append_zen()
        return "SUCCESS", None

    def logged(self, table: str, method: str, source: str, work, describe):
        """Do one load and log how it went; ``work`` returns the row count."""
        started = datetime.now()
        try:
            rows = work()
        except Exception as failure:
            self.audit.load(self.id, self.pipeline.name, table, method, "FAILED", 0, started, datetime.now(), source, str(failure))
            raise
        self.audit.load(self.id, self.pipeline.name, table, method, "SUCCESS", rows, started, datetime.now(), source, describe(rows))
        return rows

    def profile(self, export: Export, enforce: bool) -> bool:
        p = self.pipeline
        label, folder = source_label(p.profile.source_files)
        found: list[layers.ProfileResult] = []

        def work() -> int:
            found.append(layers.profile_export(export, p.profile, enforce))
            return found[0].row_count

        self.logged(
            p.source_table, "PRELOAD_PROFILE", label, work,
            lambda _: f"Profiled CSV with 0 repaired rows and {found[0].malformed_row_count} malformed rows.",
        )
        result = found[0]
        self.malformed = result.malformed_row_count
        self.audit.count(self.id, p.name, p.source_table, "PRELOAD_CSV", result.row_count, self.malformed, label, folder)
        self.audit.columns(result.columns, self.id, p.name, p.source_table, label, folder)
        return result.malformed_threshold_exceeded

    def load_raw(self, export: Export, backfill: bool) -> None:
        p = self.pipeline
        label, folder = source_label(p.profile.source_files)
        rows = self.logged(
            p.source_table, "SPARK", label,
            lambda: layers.load_raw(export, p.profile, p.source_table, self.started, backfill),
            lambda n: f"Loaded {n} rows.",
        )
        self.audit.count(self.id, p.name, p.source_table, "RAW_LOAD", rows, self.malformed, label, folder)

    def stage(self) -> None:
        p = self.pipeline
        raw = layers.layer_table(self.spark, p.source_table)
        rows = history.latest_run_rows(self.audit.table("ColumnProfileLog").where(F.col("TableName") == p.source_table))
        profiled = rows.select(
            F.col("OrdinalPosition").alias("ordinal_position"), F.col("ColumnName").alias("column_name"),
            F.col("RecommendedSqlType").alias("recommended_sql_type"), F.col("DefinedSqlType").alias("defined_sql_type"),
            F.col("Nullability").alias("nullability"),
        )
        if p.profile and p.profile.column_mappings:
            # Profiles name source columns; the raw table has the mapped ones.
            pairs = self.spark.createDataFrame(list(p.profile.column_mappings.items()), "column_name string, mapped string")
            profiled = profiled.join(F.broadcast(pairs), "column_name").drop("column_name").withColumnRenamed("mapped", "column_name")
        layout = layers.stage_columns(
            profiled if not profiled.isEmpty() else None, raw,
            p.profile.column_sql_types if p.profile else None, self.type_authority,
        )
        null_dates = list(p.profile.date_null_sentinels) if p.profile else None
        self.logged(
            p.staging_table, "RAW_TO_STG", p.source_table,
            lambda: layers.load_stage(self.spark, p.source_table, p.staging_table, layout, self.blank_policy, null_dates),
            lambda n: f"Rebuilt {p.staging_table} from {p.source_table}.",
        )

    def append_zen(self) -> None:
        p = self.pipeline
        rows = self.logged(
            p.target_table, "STG_TO_ZEN", p.staging_table,
            lambda: layers.append_zen(self.spark, p.staging_table, p.target_table),
            lambda n: f"Appended {n} rows from {p.staging_table} into {p.target_table}.",
        )
        self.source_rows = self.spark.table(p.staging_table).count()
        self.target_rows = self.spark.table(p.target_table).count()
        self.audit.count(self.id, p.name, p.target_table, "TARGET_LOAD", rows, source=p.staging_table)

    def sql_step(self, file: str, table: str, source: str, method: str) -> int:
        text = read_sql(self.spark, f"{self.sql_folder}/{file}")
        return self.logged(
            table, method, source,
            lambda: run_sql(self.spark, text, table),
            lambda n: f"Executed {file} into {table}.",
        )


def read_sql(spark: SparkSession, path: str) -> str:
    """The text of a SQL file; missing and empty files are errors."""
    text = spark.read.option("wholetext", True).text(path).first()
    if text is None or not text[0].strip():
        raise ValueError(f"SQL file is empty: {path}")
    return text[0].strip()


def run_sql(spark: SparkSession, text: str, table: str | None = None) -> int | DataFrame:
    """Run one statement. A query fills ``table`` and returns its row count, or is returned itself."""
    if not text or not text.strip():
        raise ValueError("SQL text is empty")
    result = spark.sql(text.strip().rstrip(";"))
    if table is None:
        return result
    if result.columns:
        layers.write_table(result, table)
    return spark.table(table).count()


def quarantine_export(export: Export, pipeline_name: str, context: int = 5) -> DataFrame:
    """Malformed records of an export with their neighbours, as report rows."""
    numbered = export.data.select(
        "source_file", "record_no", "line_no", "raw_text", F.size("fields").alias("field_count"), "is_malformed"
    )
    return quarantine.with_context(numbered, export.width, context).select(
        F.current_timestamp().alias("generated_at_utc"), F.lit(pipeline_name).alias("pipeline_name"), "*"
    )
