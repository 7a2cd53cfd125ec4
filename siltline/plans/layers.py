"""Jobs between the layers: raw, hrm, stg and zen tables are Parquet tables in databases of those names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from siltline import fixed
from siltline.functions import names, text
from siltline.functions.typed import SqlType, is_lossy, typed
from siltline.operators import checks, constraints, harmonise, history, profile, surrogate
from siltline.operators.folding import unsorted
from siltline.session import cut_lineage
from siltline.sources.exports import Export, ExportProfile, file_gates, text_width


# While a table is replaced, its next content and its last one stand beside it under these names.
LOADING, REPLACED = "__loading", "__replaced"
# Metadata of a raw column: its declared SQL type, which the catalog keeps with the table.
DECLARED = "sql_type"


def _run(spark: SparkSession, statement: str) -> None:
    """Every change of the catalog goes through here, one statement at a time."""
    spark.sql(statement)


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a replacement of ``table`` that was stopped.

    If it has no content, the last one comes back, since the stopped load told nobody that it was done;
    with content, the last one is dropped. What was being loaded goes either way.
    """
    if not spark.catalog.databaseExists(table.split(".", 1)[0]):
        return
    if spark.catalog.tableExists(table + REPLACED):
        if spark.catalog.tableExists(table):
            _run(spark, f"DROP TABLE {table}{REPLACED}")
        else:
            _run(spark, f"ALTER TABLE {table}{REPLACED} RENAME TO {table}")
    if spark.catalog.tableExists(table + LOADING):
        _run(spark, f"DROP TABLE {table}{LOADING}")
    _discard_files(spark, table + LOADING)


def _discard_files(spark: SparkSession, table: str) -> None:
    """Remove the folder of a table that the catalog doesn't know: a failed write may leave files, and
    no table could be created over them."""
    database, name = table.split(".", 1)
    if spark.catalog.tableExists(table):
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(database).locationUri, name.lower())
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def layer_table(spark: SparkSession, table: str) -> DataFrame:
    """A layer table as the last completed load left it."""
    recover(spark, table)
    return spark.table(table)


def write_table(
    df: DataFrame, table: str, mode: str = "overwrite", partition_by: list[str] | None = None,
    verify: Callable[[DataFrame], None] | None = None, required: Sequence[str] = (),
) -> None:
    """Write a layer table, creating its database when missing. One load writes to a table at a time.

    An overwrite goes to a table beside it, which takes the name once it is whole, no ``required`` column
    holds a NULL (counted while the rows are written) and ``verify`` (given what is stored) has not raised;
    until then the old table stays as it was. The old table is set aside before the new one takes its
    name and dropped last, so wherever a load stops, ``layer_table`` and the next load find one of both whole.
    An append checks ``required`` in a pass of its own before it writes.
    """
    spark, database = df.sparkSession, table.split(".", 1)[0]
    _run(spark, f"CREATE DATABASE IF NOT EXISTS {database}")
    recover(spark, table)
    watch = constraints.Watch(required)
    rows = watch.over(df)
    if mode != "overwrite" and required:
        rows.write.format("noop").mode("overwrite").save()
        watch.check(table)
        rows = df
    writer = rows.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode != "overwrite":
        writer.saveAsTable(table)
        return
    try:
        writer.saveAsTable(table + LOADING)
        watch.check(table)
        if verify is not None:
            verify(spark.table(table + LOADING))
    except Exception:
        _run(spark, f"DROP TABLE IF EXISTS {table}{LOADING}")
        raise
    if spark.catalog.tableExists(table):
        _run(spark, f"ALTER TABLE {table} RENAME TO {table}{REPLACED}")
    _run(spark, f"ALTER TABLE {table}{LOADING} RENAME TO {table}")
    _run(spark, f"DROP TABLE IF EXISTS {table}{REPLACED}")


# --- profile ------------------------------------------------------------------------------


@dataclass(frozen=True)
class ProfileResult:
    columns: DataFrame
    row_count: int
    malformed_row_count: int
    malformed_threshold_exceeded: bool


def profile_export(export: Export, profile_config: ExportProfile, enforce: bool = True) -> ProfileResult:
    """Profile all files in one pass: per-file gates and column measures together, then merged.

    The per-file rows are written once, so that the files are not read again for the merge.
    """
    good = ~F.col("is_header") & ~F.col("is_blank") & ~F.col("is_malformed")
    measures = []
    for i in range(export.width):
        value = F.when(good, text.blank_to_null(F.get("fields", F.lit(i))))
        measures += [
            unsorted(F.min(value)).alias(f"c{i}_min"),
            unsorted(F.max(value)).alias(f"c{i}_max"),
            F.max(F.length(value)).alias(f"c{i}_len"),
            F.count_if(good & value.isNull()).alias(f"c{i}_blank"),
            F.count(value).alias(f"c{i}_filled"),
        ]
    by_file = cut_lineage(file_gates(export, *measures))
    row = by_file.agg(
        F.count("*").alias("files"),
        F.count_if("has_no_data").alias("without_data"),
        F.count_if(~F.col("same_header")).alias("other_header"),
        F.sum("row_count").alias("rows"),
        F.sum("malformed_row_count").alias("malformed"),
        F.bool_or("malformed_threshold_exceeded").alias("exceeded"),
        F.min(F.when(~F.col("same_header") | F.col("has_no_data"), F.col("source_file"))).alias("example"),
    ).first()
    if row.files < len(set(profile_config.source_files)):
        raise ValueError(f"only {row.files} of {len(profile_config.source_files)} files reach the header row")
    if row.other_header:
        raise ValueError(f"header drift in {row.other_header} files, for example {row.example}")
    if row.without_data:
        raise ValueError(f"{row.without_data} files have no data rows, for example {row.example}")
    if row.exceeded and enforce:
        raise ValueError(
            f"malformed row count {row.malformed} exceeds the allowed {profile_config.max_malformed_rows} in a file"
        )
    cells = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal_position"),
                F.lit(name).alias("column_name"),
                F.col(f"c{i}_min").alias("minimum_non_null_value"),
                F.col(f"c{i}_max").alias("maximum_non_null_value"),
                F.col(f"c{i}_len").alias("max_string_length"),
                F.col(f"c{i}_blank").alias("blank_row_count"),
                F.col(f"c{i}_filled").alias("non_null_row_count"),
            )
            for i, name in enumerate(export.columns)
        ]
    )
    merged = profile.merge_profiles(by_file.select("source_file", F.inline(cells)))
    return ProfileResult(merged, row.rows, row.malformed, bool(row.exceeded))


# --- raw ----------------------------------------------------------------------------------


def raw_rows(export: Export, profile_config: ExportProfile, loaded_at: datetime) -> DataFrame:
    """Mapped, scrubbed raw text with load time and source file; blanks are NULL."""
    targets = list(profile_config.column_mappings.values())
    chosen = []
    for source, target in profile_config.column_mappings.items():
        value = text.scrub(text.blank_to_null(export.value(source)))
        declared = profile_config.column_sql_types.get(target, fixed.RAW_TEXT_TYPE)
        width = text_width(declared)
        if width:
            too_long = F.raise_error(F.lit(f"value longer than {width} characters in column {target}"))
            value = F.when(F.length(value) > width, too_long.cast("string")).otherwise(value)
        chosen.append(value.alias(target, metadata={DECLARED: declared}))
    if len(set(targets)) != len(targets):
        raise ValueError("column_mappings name a target twice")
    return export.good().select(
        *chosen,
        F.lit(loaded_at.replace(microsecond=0)).cast("timestamp").alias(fixed.LOAD_DATE),
        F.col("source_file").alias(fixed.SOURCE_FILE),
    )


def load_raw(
    export: Export, profile_config: ExportProfile, table: str, loaded_at: datetime | None = None,
    backfill_metadata: bool = True,
) -> int:
    """Replace a raw table with the good rows of an export and check what was stored.

    Every file passes its gates (malformed rows, no data, header) before anything is written. An
    existing table must have the same columns in the same order. The rows are written beside the
    table, and it is replaced only if each load slice (load time and file) holds the rows its file has.
    """
    spark, when = export.records.sparkSession, loaded_at or datetime.now()
    rows = raw_rows(export, profile_config, when)
    recover(spark, table)
    if spark.catalog.tableExists(table):
        existing = spark.table(table)
        if backfill_metadata:
            existing = with_metadata(existing, when)
        if existing.columns != rows.columns:
            raise ValueError(f"schema drift: {table} has {existing.columns}, the export has {rows.columns}")
    gates = cut_lineage(file_gates(export))
    bad = gates.where("malformed_threshold_exceeded OR has_no_data OR NOT same_header").orderBy("source_file").limit(1).collect()
    if bad:
        file = bad[0]
        why = (
            f"{file.malformed_row_count} malformed rows, {export.allowed_malformed} are allowed"
            if file.malformed_threshold_exceeded else "another header" if not file.same_header else "no data rows"
        )
        raise ValueError(f"{file.source_file} is not loaded into {table}: {why}")
    total = gates.agg(F.count("*").alias("files"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")).first()
    if total.files < len(set(profile_config.source_files)) or not total.rows:
        raise ValueError(f"no data rows to load into {table} from {len(set(profile_config.source_files)) - total.files} files")

    def verify(stored: DataFrame) -> None:
        written = gates.select(
            F.lit(when.replace(microsecond=0)).cast("timestamp").alias(fixed.LOAD_DATE),
            F.col("source_file").alias(fixed.SOURCE_FILE), "row_count",
        )
        short = checks.partial_loads(written, stored).orderBy(fixed.SOURCE_FILE).limit(1).collect()
        if short:
            raise ValueError(
                f"{table}: {short[0][fixed.SOURCE_FILE]} has {short[0].written_count} rows but {short[0].row_count} are stored; "
                "the table is unchanged"
            )

    write_table(rows, table, verify=verify)
    return total.rows


def with_metadata(raw: DataFrame, now: datetime) -> DataFrame:
    """Add the metadata columns to a raw table that lacks them."""
    if fixed.LOAD_DATE not in raw.columns:
        raw = raw.withColumn(fixed.LOAD_DATE, F.lit(now.replace(microsecond=0)).cast("timestamp"))
    if fixed.SOURCE_FILE not in raw.columns:
        raw = raw.withColumn(fixed.SOURCE_FILE, F.lit(""))
    return raw


# --- stage --------------------------------------------------------------------------------


@dataclass(frozen=True)
class StageColumn:
    source: str
    name: str
    sql_type: str
    identifier: bool = False
    nullable: bool = False
    profiled: bool = False  # the profile decided whether it may be NULL


def stage_columns(
    profiled: DataFrame | None, raw: DataFrame, raw_types: dict[str, str] | None = None,
    type_authority: str = "recommended",
) -> list[StageColumn]:
    """The staged layout: one entry per column of the latest profile, or of the raw table without one.

    ``profiled`` has ``ordinal_position, column_name, recommended_sql_type, defined_sql_type``, and may have
    ``nullability`` (see ``constraints.may_be_null``). A raw VARCHAR(MAX) column stays so under a narrower
    profile; ``raw_types`` overrides what the raw table's columns were declared as. Only the column catalog
    is collected.
    """
    spark = raw.sparkSession
    declared = {f.name: f.metadata[DECLARED] for f in raw.schema.fields if f.metadata.get(DECLARED)}
    data = [c for c in raw.columns if c not in fixed.RAW_METADATA]
    if profiled is None:
        profiled = spark.createDataFrame(
            [(i + 1, c, None, fixed.RAW_TEXT_TYPE) for i, c in enumerate(data)],
            "ordinal_position int, column_name string, recommended_sql_type string, defined_sql_type string",
        )
    chosen = F.col("defined_sql_type")
    if type_authority == "recommended":
        chosen = F.coalesce(F.nullif("recommended_sql_type", F.lit("")), chosen)
    wide = [c for c, kind in {**declared, **(raw_types or {})}.items() if kind.strip().upper() in ("VARCHAR(MAX)", "NVARCHAR(MAX)")]
    kept_wide = F.col("column_name").isin(wide) & chosen.rlike("(?i)^(N?VARCHAR|N?CHAR)")
    rows = (
        profiled.select(
            "ordinal_position",
            "column_name",
            names.sanitize(F.col("column_name")).alias("name"),
            F.when(kept_wide, F.lit("VARCHAR(MAX)")).otherwise(chosen).alias("sql_type"),
            names.is_identifier(F.col("column_name")).alias("identifier"),
            (F.col("nullability") if "nullability" in profiled.columns else F.lit(None).cast("string")).alias("nullability"),
        )
        .orderBy(F.asc_nulls_last("ordinal_position"))
        .collect()
    )
    if not rows:
        raise ValueError("no column definitions found")
    layout, taken = [], {}
    for row in rows:
        if row.name.lower() == fixed.AUTO_ID.lower():
            raise ValueError(f"source column {row.column_name!r} conflicts with the reserved {fixed.AUTO_ID}")
        other = taken.setdefault(row.name.lower(), row.column_name)
        if other != row.column_name:
            raise ValueError(f"columns {other!r} and {row.column_name!r} both become {row.name!r}")
        layout.append(
            StageColumn(
                row.column_name, row.name, row.sql_type, row.identifier,
                constraints.may_be_null(row.sql_type, row.nullability), bool(row.nullability),
            )
        )
    return layout


def stage(
    raw: DataFrame, layout: list[StageColumn], blank_policy: str = "default", null_dates: list[str] | None = None
) -> DataFrame:
    """Renamed, typed and cleansed rows; a plain projection that keeps every row (and its key, if any)."""
    data = [
        typed(F.col(f"`{c.source}`"), c.sql_type, c.identifier, blank_policy, null_dates).alias(c.name)
        for c in layout
    ]
    return raw.select(*data, *[c for c in [*fixed.RAW_METADATA, fixed.AUTO_ID] if c in raw.columns])


def cast_loss(raw: DataFrame, layout: list[StageColumn], null_dates: list[str] | None = None) -> DataFrame:
    """Per staged column, how many filled values have no value in its type."""
    lossy = raw.agg(
        *[F.count_if(is_lossy(F.col(f"`{c.source}`"), c.sql_type, null_dates)).alias(f"c{i}") for i, c in enumerate(layout)]
    )
    cells = F.array(
        *[
            F.struct(F.lit(c.name).alias("column_name"), F.lit(c.sql_type).alias("sql_type"), F.col(f"c{i}").alias("lost_values"))
            for i, c in enumerate(layout)
        ]
    )
    return lossy.select(F.inline(cells))


def required_columns(layout: list[StageColumn], blank_policy: str = "default") -> list[str]:
    """The staged columns that must not be NULL. Where blanks stay NULL, only the profile can say so."""
    return [c.name for c in layout if not c.nullable and (blank_policy == "default" or c.profiled)]


def null_violations(staged: DataFrame, layout: list[StageColumn]) -> DataFrame:
    """Per staged column its rule, its NULLs, and whether they break the rule."""
    return constraints.null_counts(staged, [(c.name, c.sql_type, c.nullable) for c in layout])


def load_stage(
    spark: SparkSession, source: str, target: str, layout: list[StageColumn],
    blank_policy: str = "default", null_dates: list[str] | None = None,
) -> int:
    """Rebuild a staged table from a raw one; keys follow the raw table's file order.

    NULLs in columns that must have none leave the old table in place (``constraints.NullViolation``).
    """
    keyed = surrogate.key_by_position(layer_table(spark, source))
    write_table(stage(keyed, layout, blank_policy, null_dates), target, required=required_columns(layout, blank_policy))
    return spark.table(target).count()


# --- zen ----------------------------------------------------------------------------------


def append_zen(spark: SparkSession, source: str, target: str) -> int:
    """Append a staged table to a trusted one; its keys go on from the highest key in use.

    Staged keys that are 1 to n are moved by that; a table without keys, or with any others, is
    numbered by the place of its rows.
    """
    staged = layer_table(spark, source)
    recover(spark, target)
    data = [c for c in staged.columns if c.lower() != fixed.AUTO_ID.lower()]
    if not data:
        raise ValueError(f"no columns in {source}")
    if not spark.catalog.tableExists(target):
        start = 0
    else:
        present = spark.table(target).columns
        if not present or present[-1] != fixed.AUTO_ID:
            raise ValueError(f"{target} must have {fixed.AUTO_ID} as its last column")
        if set(present[:-1]) != set(data):
            raise ValueError(f"{target} has {present[:-1]}, {source} has {data}")
        data = present[:-1]
        start = surrogate.next_start(spark.table(target))
    rows = appended_rows(staged, data, start)
    seen = Observation()
    write_table(rows.observe(seen, F.count(F.lit(1)).alias("rows")), target, mode="append")
    return seen.get["rows"]


def appended_rows(staged: DataFrame, data: list[str], start: int) -> DataFrame:
    """``data`` of a staged Parquet table with keys ``start + 1 .. start + n``."""
    own = next((c for c in staged.columns if c.lower() == fixed.AUTO_ID.lower()), None)
    if own is not None:
        key = F.col(own)
        held = staged.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"), F.count_distinct(key).alias("keys")).first()
        if held.n == 0 or (held.low == 1 and held.high == held.n == held.keys):
            return staged.select(*data, (key + F.lit(start)).cast("bigint").alias(fixed.AUTO_ID))
    return surrogate.key_by_position(staged.select(*data), start=start)


# --- harmonised and reviewed --------------------------------------------------------------


def load_harmonised(spark: SparkSession, tables: dict[str, str], profiles: DataFrame, target: str) -> int:
    """Unite the raw variant tables (variant -> table) into one hrm table with keys."""
    frames = {variant: layer_table(spark, table).withColumn(fixed.VARIANT_TABLE, F.lit(table)) for variant, table in tables.items()}
    united = harmonise.harmonise(frames, profiles)
    # The union is written first; its files then give the keys.
    write_table(united, f"{target}_unkeyed")
    write_table(surrogate.key_by_position(spark.table(f"{target}_unkeyed")), target)
    spark.sql(f"DROP TABLE {target}_unkeyed")
    return spark.table(target).count()


@dataclass(frozen=True)
class ReviewDecisions:
    drop_columns: frozenset[str] = frozenset()
    rename_pairs: tuple[tuple[str, str], ...] = ()


def read_review(spark: SparkSession, path: str, require_decision: bool = False) -> dict[str, ReviewDecisions]:
    """Drops and rename pairs per entity from a reviewed anomaly CSV (a column catalog, collected)."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if require_decision:
        rows = rows.where(F.lower(F.trim("review_decision")).isin(*fixed.ACCEPTED_DECISIONS))
    grouped = rows.groupBy(F.upper("entity_name").alias("entity")).agg(
        F.array_sort(F.collect_set(F.when(F.col("anomaly_type") == "unnamed_source_column_with_values", F.col("hrm_column_name")))).alias("drops"),
        F.array_sort(
            F.collect_set(
                F.when(F.col("anomaly_type") == "possible_rename_pair", F.struct("hrm_column_name", "candidate_column_name"))
            )
        ).alias("renames"),
    )
    return {
        row.entity: ReviewDecisions(frozenset(row.drops), tuple((a, b) for a, b in row.renames)) for row in grouped.collect()
    }


def reviewed_columns(columns: list[str], decisions: ReviewDecisions) -> list[str]:
    """Columns left after drops and renames, in order. A renamed column must not be a target too."""
    sources = {source for source, _ in decisions.rename_pairs}
    if len(sources) < len(set(decisions.rename_pairs)):
        counted = [source for source, _ in set(decisions.rename_pairs)]
        raise ValueError(f"columns have more than one target: {sorted({s for s in counted if counted.count(s) > 1})}")
    chained = sources & {target for _, target in decisions.rename_pairs}
    if chained:
        raise ValueError(f"columns are both source and target of a rename: {sorted(chained)}")
    gone = sources | decisions.drop_columns | {fixed.AUTO_ID}
    return list(dict.fromkeys(c for c in columns if c not in gone))


def reviewed_stage(
    hrm: DataFrame, decisions: ReviewDecisions, types: DataFrame | None = None, null_dates: list[str] | None = None
) -> DataFrame:
    """Typed rows of a harmonised table with the reviewed drops and renames applied.

    ``types`` has candidate types per source column (``ColumnName, sql_type``); a target takes the
    reconciled type of itself and the columns folded into it. Date columns of hrm stay dates.
    """
    spark = hrm.sparkSession
    kept = reviewed_columns(hrm.columns, decisions)
    folded: dict[str, list[str]] = {}
    for source, target in decisions.rename_pairs:
        folded.setdefault(target, []).append(source)
    dated = {field.name for field in hrm.schema.fields if field.dataType.simpleString() == "date"}
    chosen: dict[str, str] = {}
    if types is not None:
        pairs = [(source, target) for target in kept for source in [target, *folded.get(target, [])]]
        catalog = spark.createDataFrame(pairs, "ColumnName string, target string")
        candidate = types.join(F.broadcast(catalog), "ColumnName").select(F.col("target").alias("ColumnName"), "sql_type")
        chosen = {row.ColumnName: row.sql_type for row in history.reconcile_types(candidate).collect()}
    identifiers = {
        row.name
        for row in spark.createDataFrame([(c,) for c in kept], "name string").where(names.is_identifier(F.col("name"))).collect()
    }
    out = []
    for name in kept:
        if name in fixed.HARMONISED_METADATA:
            out.append(F.col(name))
            continue
        sources = [name, *folded.get(name, [])]
        if name in dated:
            value = F.coalesce(*[F.col(f"`{c}`") if c in dated else typed(F.col(f"`{c}`"), "DATE", null_dates=null_dates) for c in sources])
        else:
            merged = F.coalesce(*[text.spaces_to_null(F.col(f"`{c}`").cast("string")) for c in sources])
            value = typed(merged, chosen.get(name, fixed.RAW_TEXT_TYPE), name in identifiers, null_dates=null_dates)
        out.append(value.alias(name))
    return hrm.select(*out, *[c for c in [fixed.AUTO_ID] if c in hrm.columns])


def load_reviewed(
    spark: SparkSession, source: str, target: str, decisions: ReviewDecisions, types: DataFrame | None = None,
    drop_source: bool = False,
) -> int:
    """Rebuild a staged table from a harmonised one, keeping its keys. Only dates may be NULL, load metadata never."""
    rows = reviewed_stage(layer_table(spark, source), decisions, types)
    dated = {field.name for field in rows.schema.fields if field.dataType.simpleString() in ("date", "timestamp", "timestamp_ntz")}
    write_table(rows, target, required=[c for c in rows.columns if c in fixed.HARMONISED_METADATA or c not in dated])
    rows = spark.table(target).count()
    if drop_source:
        spark.sql(f"DROP TABLE {source}")
    return rows


def reconciled(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """(source rows, target rows), refusing a difference."""
    row = checks.reconcile(layer_table(spark, source), layer_table(spark, target)).first()
    if not row.is_match:
        raise ValueError(f"{source} has {row.source_row_count} rows, {target} has {row.target_row_count}")
    return row.source_row_count, row.target_row_count
