"""The audit trail: append-only Parquet tables in the ``audit`` database.

Rows are never updated. A run writes a start event and an end event; its state is read as the
latest value of each column.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline.functions import text
from siltline.operators import history, profile, rollup

TABLES = {
    "PipelineRunEvent": (
        "RunID string, EventId bigint, PipelineName string, StartTime timestamp, EndTime timestamp, DurationMs bigint, "
        "Status string, SourceTable string, TargetTable string, SourceRowCount bigint, TargetRowCount bigint, ErrorMessage string"
    ),
    "TableRowCountLog": (
        "TableRowCountLogID bigint, RunID string, PipelineName string, TableName string, SourceFile string, "
        "SourceFolderPath string, CountStage string, ProperRowCount bigint, MalformedRowCount bigint, "
        "RepairedRowCount bigint, CapturedAt timestamp"
    ),
    "ColumnProfileLog": (
        "RunID string, PipelineName string, TableName string, SourceFile string, SourceFolderPath string, CountStage string, "
        "OrdinalPosition int, ColumnName string, MinimumNonNullValue string, MaximumNonNullValue string, MaxStringLength int, "
        "BlankRowCount bigint, NonNullRowCount bigint, NullableFlag boolean, Nullability string, RecommendedSqlType string, "
        "DefinedSqlType string, MinMaxValueTypeMismatchFlag boolean, CapturedAt timestamp, AutoId bigint"
    ),
    "LoadExecutionLog": (
        "LoadExecutionLogID bigint, RunID string, PipelineName string, TableName string, SourceFile string, LoadMethod string, "
        "LoadStatus string, ChunkRowCount bigint, StartedAt timestamp, FinishedAt timestamp, DurationMs bigint, "
        "ServerName string, ExecutablePath string, ExitCode int, DetailMessage string, BcpErrorRowCount int, "
        "BcpErrorSummary string, StdOut string, StdErr string"
    ),
}


# Keys that one logged profile reserves.
MOST_COLUMNS = 100_000


class Audit:
    """Writer and reader of the four tables."""

    def __init__(self, spark: SparkSession, database: str = "audit"):
        self.spark, self.database = spark, database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, schema in TABLES.items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema}) USING parquet")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def reset(self) -> None:
        """Empty all four tables, as before a profile-only run."""
        for name in TABLES:
            self.spark.sql(f"TRUNCATE TABLE {self.database}.{name}")

    def _append(self, name: str, row: dict) -> None:
        frame = self.spark.createDataFrame([row], TABLES[name])
        frame.coalesce(1).write.mode("append").insertInto(f"{self.database}.{name}")

    _lock, _last = threading.Lock(), 0

    @classmethod
    def _id(cls, moment: datetime, rows: int = 1) -> int:
        """The first of ``rows`` keys of this process's own: they grow with time (nanoseconds since the epoch) and
        go on from the last one where several events share a moment, so rows of a run never tie."""
        with cls._lock:
            first = max(int(moment.timestamp() * 1_000_000) * 1000, Audit._last + 1)
            Audit._last = first + rows - 1
        return first

    def start_run(self, run_id: str, pipeline: str, source: str, target: str | None, at: datetime) -> None:
        self._append("PipelineRunEvent", {
            "RunID": run_id, "EventId": self._id(at), "PipelineName": pipeline, "StartTime": at,
            "Status": "RUNNING", "SourceTable": source, "TargetTable": target,
        })

    def end_run(self, run_id: str, started: datetime, at: datetime, status: str,
                source_rows: int | None = None, target_rows: int | None = None, error: str | None = None) -> None:
        self._append("PipelineRunEvent", {
            "RunID": run_id, "EventId": self._id(at), "EndTime": at, "Status": status,
            "DurationMs": int((at - started).total_seconds() * 1000),
            "SourceRowCount": source_rows, "TargetRowCount": target_rows, "ErrorMessage": error,
        })

    def count(self, run_id: str, pipeline: str, table: str, stage: str, rows: int, malformed: int = 0,
              source: str | None = None, folder: str | None = None, at: datetime | None = None) -> None:
        at = at or datetime.now()
        self._append("TableRowCountLog", {
            "TableRowCountLogID": self._id(at), "RunID": run_id, "PipelineName": pipeline, "TableName": table,
            "SourceFile": source, "SourceFolderPath": folder, "CountStage": stage, "ProperRowCount": rows,
            "MalformedRowCount": malformed, "RepairedRowCount": 0, "CapturedAt": at,
        })

    def load(self, run_id: str, pipeline: str, table: str, method: str, status: str, rows: int,
             started: datetime, finished: datetime, source: str | None = None, detail: str | None = None) -> None:
        self._append("LoadExecutionLog", {
            "LoadExecutionLogID": self._id(finished), "RunID": run_id, "PipelineName": pipeline, "TableName": table,
            "SourceFile": source, "LoadMethod": method, "LoadStatus": status, "ChunkRowCount": rows,
            "StartedAt": started, "FinishedAt": finished,
            "DurationMs": int((finished - started).total_seconds() * 1000), "DetailMessage": detail,
        })

    def columns(self, profiled: DataFrame, run_id: str, pipeline: str, table: str, source: str | None = None,
                folder: str | None = None, stage: str = "PRELOAD_CSV", at: datetime | None = None) -> None:
        """Log a profile with recommended types; defined types are carried over from earlier runs."""
        at = at or datetime.now()
        tables = self.spark.createDataFrame([(table,)], "TableName string")
        carried = history.carried_types(tables, self.table("ColumnProfileLog"), stage).select(
            F.col("ColumnName").alias("column_name"), F.col("DefinedSqlType").alias("carried")
        )
        rows = profile.recommend(profiled).join(F.broadcast(carried), "column_name", "left")
        values = {
            "RunID": F.lit(run_id), "PipelineName": F.lit(pipeline), "TableName": F.lit(table),
            "SourceFile": F.lit(source), "SourceFolderPath": F.lit(folder), "CountStage": F.lit(stage),
            "OrdinalPosition": F.col("ordinal_position"), "ColumnName": F.col("column_name"),
            "MinimumNonNullValue": text.shorten(F.col("minimum_non_null_value")),
            "MaximumNonNullValue": text.shorten(F.col("maximum_non_null_value")),
            "MaxStringLength": F.col("max_string_length"), "BlankRowCount": F.col("blank_row_count"),
            "NonNullRowCount": F.col("non_null_row_count"), "NullableFlag": F.col("nullable_flag").cast("boolean"),
            "Nullability": F.col("nullability"), "RecommendedSqlType": F.col("recommended_sql_type"),
            "DefinedSqlType": F.coalesce("carried", "defined_sql_type"),
            "MinMaxValueTypeMismatchFlag": F.col("min_max_value_type_mismatch_flag").cast("boolean"),
            "CapturedAt": F.lit(at).cast("timestamp"),
            "AutoId": F.lit(self._id(at, MOST_COLUMNS + 1)) + F.col("ordinal_position"),
        }
        logged = rows.select(*[value.alias(name) for name, value in values.items()])
        logged.coalesce(1).write.mode("append").insertInto(f"{self.database}.ColumnProfileLog")

    def runs(self) -> DataFrame:
        return rollup.run_state(self.table("PipelineRunEvent"))

    def summary(self, run_ids: list[str] | None = None) -> DataFrame:
        """Step summary of the named runs, or of all."""
        chosen = [self.runs(), self.table("TableRowCountLog"), self.table("LoadExecutionLog")]
        if run_ids is not None:
            chosen = [df.where(F.col("RunID").isin(run_ids)) for df in chosen]
        return rollup.summarise_runs(*chosen)

    def day_summary(self, day: str) -> DataFrame:
        return rollup.summarise_day(
            self.runs(), self.table("TableRowCountLog"), self.table("LoadExecutionLog"), day
        )
