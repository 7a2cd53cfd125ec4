"""The reviewed anomaly file as rows: what each line drops or renames, or why it is refused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siltline import fixed
from siltline.session import write_aside

FIELDS = ("entity_name", "anomaly_type", "hrm_column_name", "candidate_column_name", "review_decision")
DROPS, RENAMES, NOTES = "unnamed_source_column_with_values", "possible_rename_pair", "named_variant_only_column"


def parse_review(lines: DataFrame, key: str, fields: Sequence[str] = FIELDS, require_decision: bool = False) -> DataFrame:
    """One row per line of ``lines`` (``key``, and a CSV record of ``fields`` in ``line``).

    ``action`` is ``drop``, ``rename``, ``note`` (nothing to do), ``skip`` (not accepted, where decisions
    are required) or ``reject`` with a ``reason``. Null and blank lines, lines of another width and unknown
    types are rejected; so are renames of one column to several targets, and renames whose source or target
    is the other side of another one. Repeated lines get the same action. Entities compare in upper case.
    """
    bad, held = "__bad", "__read"
    schema = ", ".join(f"`{f}` string" for f in fields) + f", `{bad}` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "escape": '"'}
    read = lines.select(key, F.from_csv(F.coalesce("line", F.lit("")), schema, options).alias(held))

    def part(name: str):
        return F.nullif(F.trim(F.col(f"{held}.{name}")), F.lit("")) if name in fields else F.lit(None).cast("string")

    kind, source, target = F.col("anomaly_type"), F.col("column_name"), F.col("target_name")
    rows = read.select(
        key, F.col(f"{held}.{bad}").isNotNull().alias("misshapen"),
        F.upper(part("entity_name")).alias("entity_name"), part("anomaly_type").alias("anomaly_type"),
        part("hrm_column_name").alias("column_name"), part("candidate_column_name").alias("target_name"),
        F.coalesce(F.lower(part("review_decision")), F.lit("")).alias("decision"),
    )
    reason = (
        F.when(F.col("misshapen"), "another number of fields")
        .when(F.col("entity_name").isNull(), "no entity")
        .when(kind.isNull() | ~kind.isin(DROPS, RENAMES, NOTES), "unknown anomaly type")
        .when(source.isNull(), "no column")
        .when((kind == RENAMES) & target.isNull(), "no target")
        .when((kind == RENAMES) & (source == target), "renamed to itself")
    )
    skipped = ~F.col("decision").isin(*fixed.ACCEPTED_DECISIONS) if require_decision else F.lit(False)
    action = (
        F.when(reason.isNotNull(), "reject").when(skipped, "skip").when(kind == DROPS, "drop").when(kind == RENAMES, "rename").otherwise("note")
    )
    # Read twice below: written once, so that lines are parsed once.
    rows = write_aside(rows.withColumn("action", action).withColumn("reason", reason))
    # What the renames of an entity say about each column: how many targets it has, and whether it is one.
    renames = rows.where("action = 'rename'").select("entity_name", "column_name", "target_name")
    sides = F.array(
        F.struct(source.alias("side"), target.alias("to")),
        F.struct(target.alias("side"), F.lit(None).cast("string").alias("to")),
    )
    told = renames.distinct().select("entity_name", F.inline(sides)).groupBy("entity_name", "side").agg(
        F.count("to").alias("targets"), F.count_if(F.col("to").isNull()).alias("hits")
    )
    worse = told.where("targets > 1 OR (targets > 0 AND hits > 0)")
    on_source = worse.select(F.col("entity_name").alias("e1"), F.col("side").alias("s1"), "targets", "hits")
    on_target = worse.where("targets > 0 AND hits > 0").select(F.col("entity_name").alias("e2"), F.col("side").alias("s2"))
    met = rows.join(
        on_source, (F.col("action") == "rename") & (F.col("entity_name") == F.col("e1")) & (source == F.col("s1")), "left"
    ).join(on_target, (F.col("action") == "rename") & (F.col("entity_name") == F.col("e2")) & (target == F.col("s2")), "left")
    conflict = F.when(F.col("targets") > 1, "more than one target").when(
        (F.col("hits") > 0) | F.col("s2").isNotNull(), "source and target of renames"
    )
    return met.select(
        key, "entity_name", F.when(conflict.isNotNull(), "reject").otherwise(F.col("action")).alias("action"),
        "column_name", F.when(kind == RENAMES, target).alias("target_name"), F.coalesce("reason", conflict).alias("reason"),
    )
