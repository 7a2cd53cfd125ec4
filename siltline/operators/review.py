"""Schema review: drift between snapshots, decisions, approval and the approved schema.

Column catalogs have ``file_name, column_name, defined_sql_type, nullability, max_string_length``.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from siltline import fixed
from siltline.operators.folding import unsorted
from siltline.operators.records import first_rows

COMPARED = ["defined_sql_type", "nullability", "max_string_length"]


def schema_drift(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Every difference as a row: new and removed files, added, removed and changed columns.

    Changed columns have one row per changed attribute with both values as text.
    """
    keys = ["file_name", "column_name"]
    names_now, names_then = (df.select("file_name").distinct() for df in (current, prior))
    fresh = names_now.join(names_then, "file_name", "left_anti").select("file_name", F.lit("new_file").alias("change"))
    gone = names_then.join(names_now, "file_name", "left_anti").select("file_name", F.lit("removed_file").alias("change"))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(c).cast("string").alias(c) for c in COMPARED]).alias(name))

    shared = names_now.join(names_then, "file_name")
    matched = side(current, "now").join(side(prior, "then"), keys, "full_outer").join(shared, "file_name", "left_semi")

    def difference(change: str, condition, attribute: str | None = None):
        now, then = (F.col(f"{side}.{attribute}") if attribute else F.lit(None).cast("string") for side in ("now", "then"))
        return F.when(
            condition,
            F.struct(
                F.lit(change).alias("change"),
                F.lit(attribute).cast("string").alias("attribute"),
                now.alias("current_value"),
                then.alias("prior_value"),
            ),
        )

    both = F.col("now").isNotNull() & F.col("then").isNotNull()
    differences = F.array_compact(
        F.array(
            difference("added_column", F.col("then").isNull()),
            difference("removed_column", F.col("now").isNull()),
            *[
                difference("changed_column", both & ~F.col(f"now.{name}").eqNullSafe(F.col(f"then.{name}")), name)
                for name in COMPARED
            ],
        )
    )
    columns = matched.select(*keys, F.inline(differences))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [columns, fresh, gone])


def start_review(columns: DataFrame) -> DataFrame:
    """Fill in what a fresh review lacks: pending status, no override, empty notes."""
    defaults = {
        "review_status": F.lit("PENDING"),
        "override_sql_type": F.lit(None).cast("string"),
        "review_notes": F.lit(""),
        "approved_by": F.lit(None).cast("string"),
        "approved_at_utc": F.lit(None).cast("timestamp"),
        "file_review_notes": F.lit(""),
    }
    for name, value in defaults.items():
        if name not in columns.columns:
            columns = columns.withColumn(name, value)
        elif name in ("review_status", "review_notes"):
            columns = columns.withColumn(name, F.coalesce(name, value))
    return columns.withColumn("final_sql_type", _final_type())


def _final_type():
    return F.coalesce(F.nullif("override_sql_type", F.lit("")), F.col("defined_sql_type"))


def apply_decisions(
    columns: DataFrame, files: DataFrame | None = None, overrides: DataFrame | None = None, decided_at: datetime | None = None
) -> DataFrame:
    """Lay file decisions (``file_name, review_status, approved_by`` and, if there, ``review_notes``)
    and column decisions (``file_name, column_name, override_sql_type, review_notes``) over a review.

    A decision's row counts as given even when its value is blank, which clears an override. Approval
    sets ``approved_at_utc`` to ``decided_at`` (now, if not given); any other decision clears it.
    """
    reviewed = start_review(columns)
    if files is not None:
        _refuse_unknown(files, reviewed, ["file_name"])
        status = F.upper(F.trim("new_status"))
        wrong = files.where(~F.upper(F.trim("review_status")).isin(fixed.REVIEW_STATUSES)).limit(1).collect()
        if wrong:
            raise ValueError(f"invalid review status {wrong[0]['review_status']!r}")
        given = files.select(
            "file_name", F.col("review_status").alias("new_status"), F.col("approved_by").alias("new_approver"),
            (F.col("review_notes") if "review_notes" in files.columns else F.lit(None).cast("string")).alias("new_notes"),
        )
        moment = F.current_timestamp() if decided_at is None else F.lit(decided_at).cast("timestamp")
        reviewed = (
            reviewed.join(given, "file_name", "left")
            .withColumn("review_status", F.coalesce(status, "review_status"))
            .withColumn("approved_by", F.coalesce(F.nullif("new_approver", F.lit("")), "approved_by"))
            .withColumn("approved_at_utc", F.when(status == "APPROVED", moment).when(status.isNull(), F.col("approved_at_utc")))
            .withColumn("file_review_notes", F.coalesce("new_notes", "file_review_notes"))
            .drop("new_status", "new_approver", "new_notes")
        )
    if overrides is not None:
        _refuse_unknown(overrides, reviewed, ["file_name", "column_name"])
        given = overrides.select(
            "file_name", "column_name",
            F.nullif(F.trim("override_sql_type"), F.lit("")).alias("new_type"),
            F.col("review_notes").alias("new_notes"),
            F.lit(True).alias("given"),
        )
        reviewed = (
            reviewed.join(given, ["file_name", "column_name"], "left")
            .withColumn("override_sql_type", F.when(F.col("given"), F.col("new_type")).otherwise(F.col("override_sql_type")))
            .withColumn("review_notes", F.when(F.col("given"), F.coalesce("new_notes", F.lit(""))).otherwise(F.col("review_notes")))
            .drop("new_type", "new_notes", "given")
        )
    return reviewed.withColumn("final_sql_type", _final_type())


def _refuse_unknown(decisions: DataFrame, reviewed: DataFrame, keys: list[str]) -> None:
    unknown = decisions.join(reviewed.select(*keys).distinct(), keys, "left_anti").limit(1).collect()
    if unknown:
        raise ValueError("decision for unknown " + ", ".join(f"{k} {unknown[0][k]!r}" for k in keys))


def review_status(reviewed: DataFrame) -> DataFrame:
    """Files per status, overridden columns and whether everything is approved: one row."""
    per_file = reviewed.groupBy("file_name").agg(
        unsorted(F.max("review_status")).alias("review_status"),
        F.count_if(F.coalesce("override_sql_type", F.lit("")) != "").alias("overrides"),
    )
    return per_file.agg(
        F.count("*").alias("file_count"),
        *[
            F.count_if(F.col("review_status") == status).alias(f"{status.lower()}_count")
            for status in fixed.REVIEW_STATUSES
        ],
        F.coalesce(F.sum("overrides"), F.lit(0)).alias("override_column_count"),
        (F.count_if(F.col("review_status").isin("PENDING", "REJECTED")) == 0).alias("all_approved"),
    )


def blocking_files(reviewed: DataFrame) -> DataFrame:
    """Files that keep the review from being complete."""
    return reviewed.where(F.col("review_status").isin("PENDING", "REJECTED")).select("file_name", "review_status").distinct()


def approval_gate(reviewed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """What the gate decides, as a row per review (``keys``; one row without): files, the files that block it in order
    (the first ten), columns that may be used, which are none while a file blocks. An empty review is complete."""
    keys = keys or []
    blocks = F.col("review_status").isin("PENDING", "REJECTED")
    per_file = reviewed.groupBy(*keys, "file_name", "review_status").agg(F.count_if(F.col("review_status") == "APPROVED").alias("columns"))
    # A file counts once, and it blocks with any of its statuses; only names are folded, not rows.
    files = per_file.groupBy(*keys, "file_name").agg(
        F.count_if(blocks).alias("blocking"), F.sum("columns").alias("columns"),
        unsorted(F.max(F.when(blocks, F.concat("file_name", F.lit(" ("), "review_status", F.lit(")"))))).alias("shown"),
    )
    first = first_rows(files.where("blocking > 0"), keys, [F.col("file_name")], 10, "at")
    named = first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "shown"))), lambda f: f["shown"]), ", ").alias("blocking_files"))
    counts = files.groupBy(*keys).agg(
        F.count("*").alias("file_count"), F.count_if(F.col("blocking") > 0).alias("blocking_count"), F.coalesce(F.sum("columns"), F.lit(0)).alias("columns")
    )
    joined = counts.join(named, keys, "left") if keys else counts.join(F.broadcast(named), F.lit(True), "left")
    complete = F.col("blocking_count") == 0
    return joined.select(
        *keys, "file_count", "blocking_count", F.coalesce("blocking_files", F.lit("")).alias("blocking_files"),
        complete.alias("is_complete"), F.when(complete, F.col("columns")).otherwise(F.lit(0)).cast("bigint").alias("approved_column_count"),
    )


def approved_schema(reviewed: DataFrame) -> DataFrame:
    """The reviewed columns with their final types; refuses while a file is pending or rejected."""
    open_files = blocking_files(reviewed).orderBy("file_name").limit(10).collect()
    if open_files:
        listed = ", ".join(f"{row.file_name} ({row.review_status})" for row in open_files)
        raise ValueError(f"schema review is not fully approved: {listed}")
    return approved_columns(reviewed)


def approved_columns(reviewed: DataFrame) -> DataFrame:
    """The column rows of fully approved files, without the gate."""
    kept = [
        c for c in (
            "file_name", "table_name", "column_name", "defined_sql_type", "final_sql_type", "override_sql_type",
            "nullability", "nullable_flag", "confidence_pct", "review_notes", "approved_by", "approved_at_utc", "file_review_notes",
        ) if c in reviewed.columns
    ]
    return reviewed.where("review_status = 'APPROVED'").select(*kept)


def columns_to_review(
    reviewed: DataFrame, threshold: float = fixed.REVIEW_CONFIDENCE, limit: int = fixed.REVIEW_ROWS
) -> DataFrame:
    """The columns of each file that most need a look: overridden, then unsure ones, lowest first."""
    confidence = F.coalesce("confidence_pct", F.lit(0.0))
    order = Window.partitionBy("file_name").orderBy(
        (F.coalesce("override_sql_type", F.lit("")) == "").cast("int"),
        (confidence >= threshold).cast("int"),
        confidence,
        F.col("column_name"),
    )
    return reviewed.withColumn("review_rank", F.row_number().over(order)).where(F.col("review_rank") <= limit)
