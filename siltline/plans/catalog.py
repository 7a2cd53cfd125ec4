"""The registered queries: every operator over the given tables.

Messy text is derived from the tables with fixed rules (a format per key remainder, say), so every
row of a table takes part and the work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltline import fixed
from siltline.functions import dates, names, numbers, text
from siltline.functions.typed import strict_text
from siltline.operators import (
    anomalies, checks, digest, harmonise, headers, history, profile, quarantine, records, review, rollup, surrogate,
    tokens, variants,
)
from siltline.operators import review_file as review_file_rows
from siltline.plans import layers, pipeline, reports
from siltline.session import cut_lineage

LOADED_AT = datetime(2026, 1, 2, 3, 4, 5)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[SparkSession, str], DataFrame]):
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_remainder(key: Column, base: int, cases: dict[int, Column], other: Column) -> Column:
    chosen = None
    for remainder, value in cases.items():
        chosen = (F if chosen is None else chosen).when(key % base == remainder, value)
    return chosen.otherwise(other)


def money(c: str, digits: int = 2) -> Column:
    return F.col(c).cast(f"decimal(15,{digits})").cast("string")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as export text."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "double":
            out.append(money(field.name).alias(field.name))
        elif kind.startswith("timestamp"):
            out.append(F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name))
        else:
            out.append(F.col(field.name).cast("string").alias(field.name))
    return df.select(*out)


def messy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an export would spell them."""
    key, amount = F.col("o_orderkey"), money("o_totalprice")
    id_text = key.cast("string")
    return table(spark, folder, "orders").select(
        key.alias("key"),
        by_remainder(
            key, 5,
            {0: F.concat(id_text, F.lit(".0000")), 1: F.concat(F.lit("  "), id_text, F.lit(" ")),
             2: F.concat(id_text, F.lit(".")), 3: F.concat(id_text, F.lit(".50"))},
            id_text,
        ).alias("OrderID"),
        by_remainder(
            key, 8,
            {0: F.concat(F.lit("$("), amount, F.lit(")")), 1: F.concat(F.lit("$"), amount),
             2: F.concat(F.lit("\u00a0"), amount, F.lit("\t")), 3: F.lit(""), 4: F.lit("n/a"),
             5: F.concat(F.lit("("), amount, F.lit(")")), 6: F.format_number(F.col("o_totalprice").cast("decimal(15,2)"), 2)},
            amount,
        ).alias("OrderAmount"),
        by_remainder(
            key, 7,
            {0: F.date_format("o_orderdate", "M/d/yyyy"), 1: F.upper(F.date_format("o_orderdate", "dd-MMM-yy")),
             2: F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), 3: F.lit("1900-01-01"), 4: F.lit("unknown"),
             5: F.lit(" ")},
            F.date_format("o_orderdate", "yyyy-MM-dd"),
        ).alias("OrderDate"),
        by_remainder(key, 4, {0: F.lit("   "), 1: F.col("o_orderpriority")}, F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))).alias("Priority.Note"),
        by_remainder(key, 3, {0: F.lit("12.00"), 1: F.lit("7")}, F.lit("3.5")).alias("LINE QTY"),
        F.lit(LOADED_AT).cast("timestamp").alias(fixed.LOAD_DATE),
        F.concat(F.lit("/in/orders_"), "o_orderstatus", F.lit(".csv")).alias(fixed.SOURCE_FILE),
    )


# --- profiles and types -------------------------------------------------------------------


@query
def profile_lineitem(spark, folder):
    return profile.profile(as_text(table(spark, folder, "lineitem")))


@query
def profile_customer(spark, folder):
    return profile.profile(as_text(table(spark, folder, "customer")))


@query
def profile_merge_by_flag(spark, folder):
    by_file = profile.profile(as_text(table(spark, folder, "lineitem")), by="l_returnflag")
    return profile.merge_profiles(by_file)


def described_lineitem(spark, folder) -> DataFrame:
    """Line items under names that promise something."""
    number, ship = F.col("l_linenumber"), F.col("l_shipdate")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("LineItemID"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit(".000000")).alias("PaidVendor"),
        money("l_quantity").alias("ORDER_QTY"),
        money("l_tax", 4).alias("NumberOfDecimals"),
        money("l_extendedprice").alias("ExtendedAmount"),
        money("l_discount", 4).alias("DiscountRate"),
        money("l_tax").alias("TAX_PCT"),
        F.date_format(ship, "yyyy-MM-dd HH:mm:ss").alias("ShipDate"),
        F.upper(F.date_format(ship, "dd-MMM-yy")).alias("CLEARED_DT"),
        F.date_format(ship, "M/d/yyyy").alias("Posted"),
        F.when(number % 2 == 0, F.date_format(ship, "yyyy-MM-dd")).otherwise(money("l_extendedprice")).alias("Mixed_Total"),
        F.col("l_returnflag").alias("ReturnFlag"),
        F.col("l_linenumber").cast("string").alias("CashLedgerTransaction"),
        money("l_extendedprice").alias("CreditReceived"),
        F.concat(F.lit("("), money("l_extendedprice"), F.lit(")")).alias("ChargeBack_AMT"),
        F.lit(" ").alias("Unused"),
    )


@query
def recommend_types(spark, folder):
    kept = [
        "ordinal_position", "column_name", "minimum_non_null_value", "maximum_non_null_value", "max_string_length",
        "semantic_kind", "min_max_value_type_mismatch_flag", "recommended_sql_type",
    ]
    return profile.recommend(profile.profile(described_lineitem(spark, folder))).select(*kept)


def typed_events(spark, folder) -> DataFrame:
    key = F.col("event_id")
    digest_text = F.md5(key.cast("string"))
    parts = [F.substring(digest_text, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return table(spark, folder, "events").select(
        key.cast("string").alias("event_key"),
        F.when(key % 2 == 0, F.lit("Y")).otherwise(F.lit(" no ")).alias("flag"),
        F.concat_ws("-", *parts).alias("token"),
        F.date_format("ts", "HH:mm:ss").alias("clock"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("zoned"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "yyyyMMdd").alias("packed_day"),
        F.date_format("ts", "M/d/yyyy H:mm").alias("stamp"),
        (key % 200 + 2).cast("string").alias("tiny"),
        (key % 200 - 100).cast("string").alias("small"),
        (key * 1000003 + 3000000000).cast("string").alias("big"),
        F.col("value").cast("decimal(15,3)").cast("string").alias("amount"),
        F.when(key % 4 == 0, F.lit("x")).otherwise(key.cast("string")).alias("mostly"),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("sparse"),
        F.lit(" ").alias("nothing"),
        F.col("props").alias("props"),
    )


@query
def infer_types(spark, folder):
    return profile.infer_types(typed_events(spark, folder))


def documents_export(spark, folder) -> DataFrame:
    key = F.col("doc_id")
    return table(spark, folder, "documents").select(
        F.when(key % 97 == 0, F.concat("text", F.lit("\x07"))).otherwise(F.col("text")).alias("text"),
        "lang",
        F.when(key % 3 == 0, F.col("source")).otherwise(F.lit("")).alias("note"),
        F.lit("").alias("empty"),
        F.col("n_chars").cast("string").alias("n_chars"),
    )


@query
def dq_issues(spark, folder):
    return profile.column_issues(profile.profile(documents_export(spark, folder), controls=True))


@query
def value_kinds(spark, folder):
    messy = messy_orders(spark, folder)
    columns = ["OrderID", "OrderAmount", "OrderDate", "Priority.Note", "LINE QTY"]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in columns])
    value = F.col("value")
    return (
        messy.select(F.inline(cells))
        .groupBy("column_name", profile.value_kind(value).alias("kind"))
        .agg(
            F.count("*").alias("value_count"),
            F.count_if(numbers.integer_like(value)).alias("integer_like"),
            F.count_if(numbers.rate_like(value)).alias("rate_like"),
            F.count_if(text.boolean_word(value).isNotNull()).alias("boolean_like"),
        )
    )


# --- rows ---------------------------------------------------------------------------------


def text_records(spark, folder) -> DataFrame:
    """Lines of all documents as comma-separated records; some carry surplus blank fields."""
    line = F.when(F.col("doc_id") % 5 == 0, F.concat("line", F.lit(", ,"))).otherwise(F.col("line"))
    return (
        table(spark, folder, "documents")
        .select("doc_id", F.col("source").alias("source_file"), F.explode(F.split("text", "\n")).alias("line"))
        .select("source_file", F.split(line, ",").alias("fields"))
    )


@query
def blank_filter(spark, folder):
    kept = records.drop_blank_rows(text_records(spark, folder))
    return kept.groupBy("source_file").agg(
        F.count("*").alias("row_count"), F.sum(F.size("fields")).alias("field_count")
    )


@query
def malformed_split(spark, folder):
    marked = records.mark_malformed(records.drop_blank_rows(text_records(spark, folder)), 2)
    return marked.groupBy("source_file", "is_malformed", F.size("fields").alias("field_count")).agg(
        F.count("*").alias("row_count")
    )


@query
def malformed_gate(spark, folder):
    marked = records.mark_malformed(records.drop_blank_rows(text_records(spark, folder)), 1)
    return records.gate_by_file(marked, "source_file", 100)


@query
def duplicate_rows(spark, folder):
    rows = table(spark, folder, "documents").select("source", F.array(F.trim("text"), "lang").alias("fields"))
    return records.duplicate_rows(rows, "source")


@query
def quarantine_context(spark, folder):
    key = F.col("event_id")
    bad = (key % 211 == 0) | (key % 212 == 0)
    rows = table(spark, folder, "events").select(
        F.lit("/in/events.csv").alias("source_file"),
        (key + 1).alias("record_no"),
        (key + 1 + F.floor(key / 3)).alias("line_no"),
        F.concat_ws(",", key, "user_id", "event_type", money("value")).alias("raw_text"),
        F.when(bad, 3).otherwise(4).alias("field_count"),
        bad.alias("is_malformed"),
    )
    return quarantine.with_context(rows, 4, context=2)


@query
def sample_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_custkey")
    return records.first_rows(orders, ["o_orderstatus"], ["o_orderkey"], 5)


# --- values -------------------------------------------------------------------------------


@query
def clean_money(spark, folder):
    amount = F.col("OrderAmount")
    return messy_orders(spark, folder).select(
        "key", numbers.numeric_text(amount).alias("amount_text"), numbers.to_decimal(amount, 19, 4).alias("amount")
    )


@query
def clean_identifier(spark, folder):
    return messy_orders(spark, folder).select("key", text.identifier(F.col("OrderID")).alias("order_id"))


@query
def clean_date(spark, folder):
    value = F.col("OrderDate")
    return messy_orders(spark, folder).select(
        "key", dates.date_like(value).alias("is_date_like"), dates.to_date(value).alias("order_date")
    )


@query
def clean_text(spark, folder):
    raw = F.concat(F.lit("\u00a0\u3000"), "text", F.lit("\r\n\x1f"))
    body = text.blank_to_null(raw)
    return table(spark, folder, "documents").select(
        "doc_id",
        F.length(body).alias("stripped_length"),
        F.md5(text.scrub(raw)).alias("scrubbed_md5"),
        F.length(text.shorten(body)).alias("short_length"),
        F.right(text.shorten(body), F.lit(3)).alias("short_end"),
        text.varchar_for_length(F.length(body)).alias("text_type"),
        text.has_control_characters(raw).alias("has_control"),
    )


STAGE_TYPES = {
    "OrderID": "VARCHAR(100)", "OrderAmount": "MONEY", "OrderDate": "DATE", "Priority.Note": "VARCHAR(5)", "LINE QTY": "INT",
}


def stage_layout(messy: DataFrame) -> list[layers.StageColumn]:
    spark = messy.sparkSession
    catalog = spark.createDataFrame(
        [(i + 1, name, kind, fixed.RAW_TEXT_TYPE) for i, (name, kind) in enumerate(STAGE_TYPES.items())],
        "ordinal_position int, column_name string, recommended_sql_type string, defined_sql_type string",
    )
    return layers.stage_columns(catalog, messy.drop("key"))


@query
def stage_orders(spark, folder):
    messy = messy_orders(spark, folder)
    return layers.stage(messy, stage_layout(messy))


@query
def stage_orders_wide(spark, folder):
    """A note declared VARCHAR(MAX) in raw stays whole although the profile says VARCHAR(5)."""
    messy = messy_orders(spark, folder)
    wide = {"Priority.Note": "VARCHAR(MAX)"}
    declared = messy.select(*[F.col(f"`{c}`").alias(c, metadata={layers.DECLARED: wide.get(c, "")}) for c in messy.columns])
    return layers.stage(declared, stage_layout(declared))


@query
def stage_orders_nulls(spark, folder):
    messy = messy_orders(spark, folder)
    return layers.stage(messy, stage_layout(messy), blank_policy="null", null_dates=["1900-01-01", "1998-01-01 00:00:00.000"])


@query
def cast_loss(spark, folder):
    messy = messy_orders(spark, folder)
    return layers.cast_loss(messy, stage_layout(messy))


@query
def stage_nullability(spark, folder):
    """The NULL rules of a profiled layout with their violations: flags that are no BIT break one."""
    flag = by_remainder(F.col("key"), 3, {0: F.lit("Y"), 1: F.lit(" no ")}, F.lit("maybe"))
    code = by_remainder(F.col("key"), 2, {0: F.lit("")}, F.lit("6F9619FF-8B86-D011-B42D-00C04FC964FF"))
    messy = messy_orders(spark, folder).withColumns({"IsOpen": flag, "Handle": code}).drop("key")
    chosen = {**STAGE_TYPES, "IsOpen": "BIT", "Handle": "UNIQUEIDENTIFIER"}
    kinds = F.create_map(*[F.lit(part) for pair in chosen.items() for part in pair])
    profiled = profile.profile(messy, list(chosen)).withColumn("recommended_sql_type", kinds[F.col("column_name")])
    layout = layers.stage_columns(profiled, messy)
    return layers.null_violations(layers.stage(messy, layout), layout)


@query
def stage_customer(spark, folder):
    raw = as_text(table(spark, folder, "customer"))
    kept = profile.recommend(profile.profile(raw)).select(
        "ordinal_position", "column_name", "recommended_sql_type", "defined_sql_type"
    )
    return layers.stage(raw, layers.stage_columns(kept, raw))


def strict_lines(spark, folder) -> tuple[DataFrame, list[tuple[str, str]]]:
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    rows = table(spark, folder, "lineitem").select(
        F.when(key % 3 == 0, F.lit("Y")).when(key % 3 == 1, F.lit(" false")).otherwise(F.lit("maybe")).alias("flag"),
        F.when(number % 2 == 0, money("l_quantity")).otherwise(money("l_tax")).alias("qty"),
        F.concat(F.lit("$("), F.format_number(F.col("l_extendedprice").cast("decimal(15,4)"), 4), F.lit(")")).alias("price"),
        F.concat(F.lit(" a\nb\x1f"), F.col("l_returnflag"), F.lit(" ")).alias("note"),
    )
    return rows, [("flag", "BIT"), ("qty", "INT"), ("price", "DECIMAL(18,2)"), ("note", "VARCHAR(255)")]


@query
def strict_typed_text(spark, folder):
    rows, columns = strict_lines(spark, folder)
    out = []
    for name, declared in columns:
        value, invalid = strict_text(F.col(name), declared)
        out += [value.alias(name), invalid.alias(f"{name}_invalid")]
    return rows.select(*out)


@query
def delimited_export(spark, folder):
    rows, columns = strict_lines(spark, folder)
    return reports.bulk_lines(rows, columns, "2026-01-02 03:04:05", "/in/lineitem.csv", strict=False)


# --- names and headers --------------------------------------------------------------------


@query
def sanitize_names(spark, folder):
    part = table(spark, folder, "part").select(
        F.concat_ws("", F.col("p_size").cast("string"), F.lit(" "), "p_name", F.lit("."), "p_type", F.lit(". "), "p_brand", F.lit(".")).alias("name")
    )
    found = part.unionByName(table(spark, folder, "pages").select(F.col("url").alias("name")))
    return found.select("name", names.sanitize(F.col("name")).alias("safe_name"))


NAME_ENDS = ["Date", "Qty", "_AMT", "Rate", "ID", "Total", "LineCount", "Vendor", "_DT", "Code", "", "Decimals", "SUPPLIERName"]


@query
def name_semantics(spark, folder):
    end = F.get(F.array(*[F.lit(e) for e in NAME_ENDS]), F.col("p_size") % len(NAME_ENDS))
    name = F.concat(F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), end)
    return table(spark, folder, "part").select("p_partkey", name.alias("column_name")).select(
        "*",
        names.semantics(F.col("column_name")).alias("semantic_kind"),
        names.is_identifier(F.col("column_name")).alias("is_identifier"),
    )


def part_headers(spark, folder) -> DataFrame:
    part = table(spark, folder, "part")
    size = F.col("p_size").cast("string")
    header = F.array(F.col("p_name"), F.lit(""), F.col("p_type"), F.initcap("p_name"), F.col("p_name"), F.lit("  "), size, F.col("p_brand"), size, F.lit(" "))
    return part.select("p_partkey", header.alias("header"))


@query
def canonical_headers(spark, folder):
    return headers.canonical_columns(part_headers(spark, folder), ["p_partkey"])


@query
def duplicate_headers(spark, folder):
    return headers.duplicate_names(part_headers(spark, folder), ["p_partkey"])


@query
def header_hash(spark, folder):
    trimmed = part_headers(spark, folder).withColumn("header", names.trim_header(F.col("header")))
    return headers.describe_headers(trimmed).select(
        "p_partkey", "column_count", "header_hash", "blank_header_count",
        F.array_join("duplicate_headers", ";").alias("duplicate_headers"),
        F.array_join("canonical_columns", ";").alias("canonical_columns"),
    )


@query
def entity_from_filename(spark, folder):
    key = F.col("c_custkey")
    segment = F.upper("c_mktsegment")
    file = by_remainder(
        key, 4,
        {0: F.concat(segment, F.lit("_"), F.col("c_nationkey"), F.lit("_01012024_06302024_"), key, F.lit(".csv")),
         1: F.concat(segment, F.lit("_01012022_09302024.CSV")),
         2: F.concat(F.lit("2024 "), segment, F.lit(" Complete.csv"))},
        F.concat(F.lower("c_name"), F.lit(" v1.2.txt")),
    )
    prefix, suffix = r"^\d{4}\s+", r"\s+Complete$"
    return table(spark, folder, "customer").select("c_custkey", file.alias("file_name")).select(
        "*",
        names.entity_from_file(F.col("file_name"), prefix, suffix).alias("entity_name"),
        names.entity_key(F.col("file_name"), prefix, suffix).alias("entity_key"),
    )


@query
def strip_suffix(spark, folder):
    key = F.col("c_custkey")
    name = by_remainder(
        key, 4,
        {0: F.concat(F.lit("raw."), F.col("c_mktsegment"), F.lit("_"), key),
         1: F.concat(F.lit("raw."), F.col("c_nationkey"), F.lit("_"), key),
         2: F.concat(F.lit("raw."), F.col("c_mktsegment"), F.lit("_2024_"), key)},
        F.concat(F.lit("raw."), F.col("c_mktsegment")),
    )
    return table(spark, folder, "customer").select("c_custkey", name.alias("table_name")).select(
        "*", names.plain_table_name(F.col("table_name")).alias("plain_name")
    )


def customer_headers(spark, folder) -> DataFrame:
    """A file per customer whose header depends on the customer's nation."""
    nation = F.col("c_nationkey")
    def optional(condition, name):
        return F.when(condition, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    header = F.concat(
        F.array(F.lit("Doc. Date"), F.lit(" Amount ")),
        optional((nation % 3 == 0) & (F.col("c_mktsegment") != "BUILDING"), "Extra"),
        optional((nation % 5 == 0) & (F.col("c_mktsegment") != "BUILDING"), ""),
        optional((nation % 7 == 0) & (F.col("c_mktsegment") != "BUILDING"), "Amount"),
        optional(F.col("c_mktsegment") == "MACHINERY", "Vendor"),
    )
    files = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("entity_name"), F.concat("c_name", F.lit(".csv")).alias("file_name"), header.alias("header")
    )
    return headers.describe_headers(files)


@query
def variant_summary(spark, folder):
    summary = variants.entity_summary(customer_headers(spark, folder))
    return summary.withColumn("duplicate_headers", F.array_join("duplicate_headers", ";")).withColumn(
        "canonical_union_columns", F.array_join("canonical_union_columns", ";")
    )


@query
def variant_numbers(spark, folder):
    return variants.numbered_variants(customer_headers(spark, folder)).select(
        "entity_name", "header_hash", "pipeline_name", "file_count", "first_file", "column_count"
    )


# --- harmonise, compare, review -----------------------------------------------------------


def order_variants(spark, folder) -> dict[str, DataFrame]:
    """Orders as three variants of one export, one per status."""
    orders = table(spark, folder, "orders")
    key, amount = F.col("o_orderkey"), money("o_totalprice")
    order_id = F.concat(key.cast("string"), F.lit(".000")).alias("Order ID")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order.Date")
    priority = F.concat(F.lit(" "), "o_orderpriority").alias("Priority")
    filler = F.lit("").alias("Column_004")
    shapes = {
        "ORDERS_V01": ("F", [order_id, day, amount.alias("Amount_LC"), filler]),
        "ORDERS_V02": ("O", [order_id, day, amount.alias("Amount_in_LC"), filler, priority]),
        "ORDERS_V03": ("P", [order_id, priority, F.when(key % 10 == 0, F.lit("hold")).otherwise(F.lit(" ")).alias("Column_005"),
                             F.col("o_custkey").cast("string").alias("Supplier_Ref")]),
    }
    return {
        name: orders.where(F.col("o_orderstatus") == status).select(
            *columns,
            F.lit(LOADED_AT).cast("timestamp").alias(fixed.LOAD_DATE),
            F.concat(F.lit(f"/in/{name}_"), F.col("o_custkey") % 3, F.lit(".csv")).alias(fixed.SOURCE_FILE),
            key.alias("_key"),
        )
        for name, (status, columns) in shapes.items()
    }


def variant_columns(spark, folder) -> DataFrame:
    """The column catalog of those variants, as their profiles give it."""
    profiles = []
    for name, frame in order_variants(spark, folder).items():
        data = [c for c in frame.columns if c not in (*fixed.RAW_METADATA, "_key")]
        profiles.append(
            profile.profile(frame, data).select(
                F.lit("ORDERS").alias("entity_name"),
                F.lit(name).alias("pipeline_name"),
                F.lit(f"raw.{name}").alias("table_name"),
                (F.col("blank_row_count") + F.col("non_null_row_count")).alias("row_count"),
                "*",
            )
        )
    # A few rows that later steps read many times.
    return cut_lineage(profile.recommend(reduce(DataFrame.unionByName, profiles)))


def harmonised_orders(spark, folder, keyed: bool = False) -> DataFrame:
    frames = order_variants(spark, folder)
    catalog = variant_columns(spark, folder).withColumn("variant", F.col("pipeline_name"))
    if keyed:
        # The key is passed through as a column of its own.
        united = harmonise.harmonise(
            {name: frame.withColumnRenamed("_key", "Row_Key") for name, frame in frames.items()},
            catalog.unionByName(
                catalog.where("ordinal_position = 1").withColumn("column_name", F.lit("Row_Key")).withColumn("ordinal_position", F.lit(99))
            ),
        )
        return united.withColumn(fixed.AUTO_ID, F.col("Row_Key").cast("bigint")).drop("Row_Key")
    return harmonise.harmonise(frames, catalog)


@query
def harmonize_union(spark, folder):
    return harmonised_orders(spark, folder)


@query
def harmonize_plan(spark, folder):
    catalog = variant_columns(spark, folder).withColumn("variant", F.col("pipeline_name"))
    return harmonise.column_plan(catalog).select(
        "out_name", F.col("first_seen.variant").alias("first_variant"),
        F.col("first_seen.ordinal_position").alias("first_position"), "non_null_row_count", "sql_type",
    )


@query
def entity_columns(spark, folder):
    return variants.column_presence(variant_columns(spark, folder)).select(
        "entity_name", "pipeline_name", "table_name", "row_count", "ordinal_position", "column_name", "presence",
        "non_null_row_count", "blank_row_count", "fill_rate", "max_string_length", "minimum_non_null_value",
        "maximum_non_null_value", "recommended_sql_type", "defined_sql_type",
    )


@query
def entity_report(spark, folder):
    return variants.entity_report(variant_columns(spark, folder))


@query
def ordinal_conflicts(spark, folder):
    return variants.ordinal_conflicts(variant_columns(spark, folder)).withColumn(
        "column_names", F.array_join("column_names", ";")
    )


@query
def column_samples(spark, folder):
    hrm = harmonised_orders(spark, folder, keyed=True)
    data = [c for c in hrm.columns if c not in (*fixed.HARMONISED_METADATA, fixed.AUTO_ID)]
    return anomalies.column_samples(hrm, data, [fixed.VARIANT, fixed.SOURCE_FILE, fixed.AUTO_ID], 3)


@query
def anomaly_rows(spark, folder):
    hrm = harmonised_orders(spark, folder, keyed=True)
    data = [c for c in hrm.columns if c not in (*fixed.HARMONISED_METADATA, fixed.AUTO_ID)]
    samples = anomalies.column_samples(hrm, data, [fixed.VARIANT, fixed.SOURCE_FILE, fixed.AUTO_ID], 2)
    catalog = variant_columns(spark, folder).withColumn("column_name", harmonise.harmonised_name(F.col("column_name")))
    known = spark.createDataFrame([("ORDERS", c) for c in data], "entity_name string, column_name string")
    return anomalies.anomaly_rows(catalog, samples.withColumn("entity_name", F.lit("ORDERS")), known)


def part_columns(spark, folder) -> DataFrame:
    """A column catalog from the parts: brands as entities, types as variants, part names as columns."""
    ends = F.get(F.array(*[F.lit(e) for e in ("Quantity", "Qty", "Reference", "Ref")]), F.col("p_size") % 4)
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("entity_name"),
        F.concat_ws("_V", "p_brand", "p_type").alias("pipeline_name"),
        F.concat_ws("_", F.replace(F.initcap("p_name"), F.lit(" "), F.lit("_")), ends).alias("column_name"),
        F.lit(1).alias("non_null_row_count"), F.lit(0).alias("blank_row_count"),
    )


@query
def rename_candidates(spark, folder):
    return anomalies.rename_candidates(part_columns(spark, folder)).select(
        "entity_name", "left_column", "right_column",
        F.array_join("left_present", ";").alias("left_present"), F.array_join("right_present", ";").alias("right_present"),
    )


@query
def reviewed_stage(spark, folder):
    hrm = harmonised_orders(spark, folder)
    types = variant_columns(spark, folder).select(
        harmonise.harmonised_name(F.col("column_name")).alias("ColumnName"), F.col("recommended_sql_type").alias("sql_type")
    )
    decisions = layers.ReviewDecisions(frozenset(["Column_005"]), (("Amount_LC", "Amount_in_LC"),))
    return layers.reviewed_stage(hrm, decisions, types)


TYPE_CYCLE = [
    "VARCHAR(100)", "INT", "VARCHAR(255)", "DECIMAL(17, 4)", "MONEY", "DATE", "DECIMAL(10, 2)", "DECIMAL(38, 6)", "BIT", "VARCHAR(4000)", "DECIMAL(30, 9)",
]


@query
def reconciled_types(spark, folder):
    kind = F.get(F.array(*[F.lit(k) for k in TYPE_CYCLE]), F.col("p_size") % len(TYPE_CYCLE))
    few = F.length("p_name") % 4
    candidates = table(spark, folder, "part").select(
        F.concat_ws("/", "p_name", F.when(few == 0, F.col("p_size").cast("string"))).alias("ColumnName"), kind.alias("sql_type")
    )
    return history.reconcile_types(candidates)


# --- keys ---------------------------------------------------------------------------------


@query
def stage_autoid(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return surrogate.key_by_order(orders, ["o_orderdate", "o_orderkey"])


@query
def zen_append_autoid(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    first = surrogate.key_by_order(orders.where("o_orderstatus = 'F'"), ["o_orderkey"])
    later = surrogate.key_by_order(orders.where("o_orderstatus <> 'F'"), ["o_orderkey"], start=surrogate.next_start(first))
    return first.unionByName(later)


@query
def zen_appended_rows(spark, folder):
    """Keyed staged rows appended to a trusted table: their keys are moved behind the highest in use."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    trusted = surrogate.key_by_order(orders.where("o_orderstatus = 'F'"), ["o_orderkey"])
    staged = surrogate.key_by_order(orders.where("o_orderstatus <> 'F'"), ["o_orderkey"])
    return trusted.unionByName(layers.appended_rows(staged, orders.columns, surrogate.next_start(trusted)))


@query
def stage_position_key(spark, folder):
    return surrogate.key_summary(surrogate.key_by_position(table(spark, folder, "lineitem")))


# --- profile history ----------------------------------------------------------------------


def profile_history(spark, folder) -> DataFrame:
    """Profile log rows, one per event."""
    key, user = F.col("event_id"), F.col("user_id")
    return table(spark, folder, "events").select(
        F.concat(F.lit("run"), F.floor(key / 50)).alias("RunID"),
        F.concat(F.lit("raw."), F.upper("event_type"), F.lit("_V0"), user % 3 + 1).alias("TableName"),
        F.concat(F.lit("Col_"), user % 20).alias("ColumnName"),
        F.when(key % 10 == 9, F.lit("RAW_LOAD")).otherwise(F.lit("PRELOAD_CSV")).alias("CountStage"),
        (user % 20 + 1).cast("int").alias("OrdinalPosition"),
        by_remainder(key, 4, {0: F.lit(""), 1: F.lit("MONEY"), 2: F.lit("date")}, F.lit("VARCHAR(255)")).alias("RecommendedSqlType"),
        F.when(key % 3 == 0, F.lit("VARCHAR(100)")).otherwise(F.lit("VARCHAR(4000)")).alias("DefinedSqlType"),
        F.date_trunc("hour", "ts").alias("CapturedAt"),
        key.alias("AutoId"),
    )


@query
def prior_types(spark, folder):
    return history.prior_types(profile_history(spark, folder))


@query
def carried_types(spark, folder):
    log = profile_history(spark, folder)
    seen = log.select("TableName")
    numbered = seen.withColumn("TableName", F.concat("TableName", F.lit("_7")))
    return history.carried_types(seen.unionByName(numbered), log)


@query
def latest_profile(spark, folder):
    return history.latest_profile(profile_history(spark, folder))


@query
def latest_run(spark, folder):
    return history.latest_run_rows(profile_history(spark, folder))


@query
def entity_types(spark, folder):
    return history.entity_types(profile_history(spark, folder), "CLICK")


# --- review -------------------------------------------------------------------------------


def snapshot(spark, folder, early: bool) -> DataFrame:
    """Column catalog per priority ("file") of the orders before or from 1998 on."""
    orders = table(spark, folder, "orders")
    cutoff = F.lit("1998-01-01").cast("timestamp")
    chosen = orders.where(F.col("o_orderdate") < cutoff if early else F.col("o_orderdate") >= cutoff)
    file = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("3-MED" if early else "3-MEDIUM")).otherwise(F.col("o_orderpriority"))
    columns = [
        file.alias("file_name"),
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(F.col("o_custkey") % 4 != 0, money("o_totalprice")).alias("amount"),
        F.rpad("o_orderstatus", 90 if early else 101, "x").alias("status"),
        *([F.col("o_custkey").cast("string").alias("customer")] if not early else [F.lit("x").alias("legacy")]),
    ]
    catalog = profile.profile(chosen.select(*columns), by="file_name").withColumn(
        "defined_sql_type", text.varchar_for_length(F.col("max_string_length"))
    )
    return cut_lineage(catalog)


@query
def schema_drift(spark, folder):
    return review.schema_drift(snapshot(spark, folder, early=False), snapshot(spark, folder, early=True))


def reviewed(spark, folder) -> DataFrame:
    catalog = snapshot(spark, folder, early=False).withColumn(
        "confidence_pct", F.round(100.0 * F.col("non_null_row_count") / (F.col("non_null_row_count") + F.col("blank_row_count")), 2)
    )
    files = catalog.select("file_name").distinct()
    first = F.left("file_name", F.lit(1))
    status = F.when(first.isin("1", "2"), F.lit(" approved")).when(first == "3", F.lit("Rejected")).otherwise(F.lit("PENDING"))
    file_decisions = files.where(first != "5").select("file_name", status.alias("review_status"), F.lit("lead").alias("approved_by"))
    overrides = catalog.where((F.col("column_name") == "amount") & (first != "2")).select(
        "file_name", "column_name",
        F.when(first == "4", F.lit(" ")).otherwise(F.lit(" MONEY")).alias("override_sql_type"), F.lit("checked").alias("review_notes"),
    )
    return review.apply_decisions(catalog, file_decisions, overrides)


REVIEW_COLUMNS = ["file_name", "column_name", "defined_sql_type", "override_sql_type", "final_sql_type", "review_status", "review_notes", "approved_by"]


@query
def apply_overrides(spark, folder):
    return reviewed(spark, folder).select(*REVIEW_COLUMNS)


@query
def review_status(spark, folder):
    return review.review_status(reviewed(spark, folder))


@query
def approved_schema(spark, folder):
    return review.approved_columns(reviewed(spark, folder)).select(
        "file_name", "column_name", "defined_sql_type", "final_sql_type", "override_sql_type", "nullability", "confidence_pct"
    )


@query
def approved_schema_gated(spark, folder):
    """The approved schema through its gate, over a review in which every file is approved."""
    complete = reviewed(spark, folder).where("review_status = 'APPROVED'")
    return review.approved_schema(complete).select(
        "file_name", "column_name", "defined_sql_type", "final_sql_type", "override_sql_type", "nullability", "confidence_pct"
    )


@query
def approved_schema_complete(spark, folder):
    """The approved schema through its gate over all files, with who approved them, when, and their notes."""
    catalog = snapshot(spark, folder, early=False)
    first = F.left("file_name", F.lit(1))
    approved = catalog.select("file_name").distinct().select(
        "file_name", F.lit("Approved ").alias("review_status"), F.when(first != "1", F.lit("lead")).otherwise(F.lit("")).alias("approved_by"),
        F.concat(F.lit("checked "), first).alias("review_notes"),
    )
    decided = review.apply_decisions(catalog, approved, decided_at=LOADED_AT)
    return review.approved_schema(decided).select(
        "file_name", "column_name", "final_sql_type", "nullability", "approved_by", "approved_at_utc", "file_review_notes"
    )


@query
def approval_gate(spark, folder):
    """The gate over a review with open files and over the approved part of it."""
    review_of = reviewed(spark, folder)
    part = review_of.where("review_status = 'APPROVED'")
    both = review_of.withColumn("review", F.lit("all files")).unionByName(part.withColumn("review", F.lit("approved files")))
    return review.approval_gate(both, ["review"])


@query
def blocking_files(spark, folder):
    return review.blocking_files(reviewed(spark, folder))


@query
def review_top_columns(spark, folder):
    return review.columns_to_review(reviewed(spark, folder), limit=3).select(
        "file_name", "column_name", "confidence_pct", "review_rank"
    )


# --- invoices, counts, audit --------------------------------------------------------------


def payments(spark, folder) -> DataFrame:
    key, amount = F.col("o_orderkey"), money("o_totalprice")
    token = lambda value, number: F.concat(value, F.lit(" - Supplier Invoice: "), number)
    invoices = by_remainder(
        key, 9,
        {0: F.lit("   "), 1: F.lit("no invoice here"),
         2: token(F.concat(F.lit("$"), amount), F.concat(F.lit("SINV"), key))},
        F.concat(
            token(F.format_number(F.col("o_totalprice").cast("decimal(15,2)"), 2), F.concat(F.lit("SINV"), key)), F.lit("  "),
            token(F.concat(F.lit("("), amount, F.lit(")")), F.concat(F.lit("CR-"), F.col("o_custkey"))), F.lit(" and "),
            token(F.lit("-1.21"), F.concat(F.lit("X_"), key)), F.lit("."),
        ),
    )
    return table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Payment_Date"),
        F.col("o_orderstatus").alias("Payment_Status"),
        F.concat(F.lit("ACH-"), key).alias("Transaction_Number"),
        invoices.alias("Invoices_Paid"),
        F.col("o_totalprice").cast("decimal(19,4)").alias("Payment_Amount"),
        key.alias(fixed.AUTO_ID),
    )


@query
def invoice_bridge(spark, folder):
    return tokens.invoice_bridge(payments(spark, folder))


@query
def invoice_flat(spark, folder):
    paid = payments(spark, folder)
    return tokens.invoice_flat(tokens.invoice_bridge(paid), paid)


@query
def row_reconcile(spark, folder):
    messy = messy_orders(spark, folder)
    return checks.reconcile(messy, layers.stage(messy, stage_layout(messy)))


@query
def load_counts(spark, folder):
    return checks.counts_by_load(harmonised_orders(spark, folder))


@query
def partial_loads(spark, folder):
    hrm = harmonised_orders(spark, folder)
    written = checks.counts_by_load(hrm).withColumn(
        "row_count", F.col("row_count") + F.when(F.col(fixed.SOURCE_FILE).endswith("_1.csv"), 1).otherwise(0)
    )
    return checks.partial_loads(written, hrm)


def audit_rows(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run, count and load rows, one load or count per event and one run per user."""
    events = table(spark, folder, "events").withColumn("at", F.date_trunc("second", "ts"))
    key, run = F.col("event_id"), F.concat(F.lit("r"), F.col("user_id"))
    runs = events.groupBy(run.alias("RunID"), F.col("user_id")).agg(
        F.min("at").alias("StartTime"), F.max("at").alias("EndTime"), F.count("*").alias("SourceRowCount")
    )
    user = F.col("user_id")
    runs = runs.select(
        "RunID", F.concat(F.lit("Feed"), user % 7).alias("PipelineName"), "StartTime", "EndTime",
        (F.unix_timestamp("EndTime") - F.unix_timestamp("StartTime")).cast("bigint").alias("DurationMs"),
        F.when(user % 11 == 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("Status"),
        F.concat(F.lit("raw.Feed"), user % 7).alias("SourceTable"), F.concat(F.lit("zen.Feed"), user % 7).alias("TargetTable"),
        "SourceRowCount",
        F.when(user % 3 != 0, F.col("SourceRowCount") * 2).alias("TargetRowCount"),
        F.when(user % 11 == 0, F.lit("stopped")).alias("ErrorMessage"),
    )
    stages = F.array(*[F.lit(s) for s in ("PRELOAD_CSV", "RAW_LOAD", "STAGING_LOAD", "TARGET_LOAD")])
    counts = events.where(F.col("event_type").isin("view", "click")).select(
        key.alias("TableRowCountLogID"), run.alias("RunID"),
        F.concat(F.lit("raw.T"), key % 13).alias("TableName"), F.concat(F.lit("/in/f"), key % 17, F.lit(".csv")).alias("SourceFile"),
        F.get(stages, (key % 4).cast("int")).alias("CountStage"), (key % 5).alias("ProperRowCount"),
        (key % 3).alias("MalformedRowCount"), F.lit(0).cast("bigint").alias("RepairedRowCount"), F.col("at").alias("CapturedAt"),
    )
    methods = F.array(*[F.lit(m) for m in (*fixed.METHOD_STEP, "RAW_VARIANTS_TO_STG")])
    loads = events.where(~F.col("event_type").isin("view", "click")).select(
        key.alias("LoadExecutionLogID"), run.alias("RunID"), F.concat(F.lit("stg.T"), key % 13).alias("TableName"),
        F.concat(F.lit("raw.T"), key % 13).alias("SourceFile"),
        F.get(methods, (key % 8).cast("int")).alias("LoadMethod"),
        F.when(key % 50 == 0, F.lit("FAILED")).when(key % 6 == 0, F.lit("RUNNING")).otherwise(F.lit("SUCCESS")).alias("LoadStatus"),
        (key % 100).alias("ChunkRowCount"), F.col("at").alias("StartedAt"), (F.col("at") + F.expr("INTERVAL 5 SECONDS")).alias("FinishedAt"),
        (key % 1000).alias("DurationMs"), F.when(key % 4 != 0, F.concat(F.lit("note "), key)).alias("DetailMessage"),
    )
    return runs, counts, loads


@query
def run_summary(spark, folder):
    return rollup.summarise_runs(*audit_rows(spark, folder))


@query
def day_summary(spark, folder):
    return rollup.summarise_day(*audit_rows(spark, folder), "2024-01-02")


@query
def run_state(spark, folder):
    key = F.col("event_id")
    events = table(spark, folder, "events").select(
        F.concat(F.lit("r"), F.col("user_id")).alias("RunID"), key.alias("EventId"),
        F.when(key % 4 == 0, F.lit("RUNNING")).when(key % 4 == 1, F.lit("SUCCESS")).when(key % 4 == 2, F.lit("FAILED")).alias("Status"),
        F.when(key % 4 == 2, F.concat(F.lit("error "), key)).alias("ErrorMessage"),
        F.when(key % 4 == 1, key).alias("TargetRowCount"),
    )
    return rollup.run_state(events)


def error_lines(spark, folder) -> DataFrame:
    key = F.col("event_id")
    line = by_remainder(
        key, 6,
        {0: F.lit("  "), 1: F.concat(F.lit("#@ Row "), F.col("user_id"), F.lit(", Column amount: Invalid value "), key, F.lit(" @#")),
         2: F.concat(F.lit("row "), F.col("user_id"), F.lit(" column "), F.col("event_type"), F.lit(": too long, line "), key),
         3: F.concat(F.lit("Line "), key, F.lit(" ended early"))},
        F.concat(F.lit("Unexpected "), F.col("event_type"), F.lit(" after "), key, F.lit(" bytes")),
    )
    return table(spark, folder, "events").select(key.alias("line_no"), line.alias("line"))


@query
def error_messages(spark, folder):
    return digest.top_messages(digest.parse_errors(error_lines(spark, folder)), "line_no")


@query
def error_digest(spark, folder):
    return digest.digest(digest.parse_errors(error_lines(spark, folder)))


STEP_SQL = """
SELECT l_returnflag, l_linestatus,
       sum(CAST(l_quantity AS decimal(15,2))) AS sum_qty,
       sum(CAST(l_extendedprice AS decimal(15,2))) AS sum_base_price,
       count(*) AS count_order
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus;
"""


@query
def sql_step(spark, folder):
    table(spark, folder, "lineitem").createOrReplaceTempView("lineitem")
    return pipeline.run_sql(spark, STEP_SQL)


def review_lines(spark, folder) -> DataFrame:
    """Lines of a reviewed anomaly file, one per part: quoted names, lines of another width, renames that clash."""
    key, form = F.col("p_partkey"), F.col("p_partkey") % 7

    def field(value: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))

    kind = by_remainder(
        key, 7, {0: F.lit("unnamed_source_column_with_values"), 2: F.lit("named_variant_only_column"), 4: F.lit("something_else")},
        F.lit("possible_rename_pair"),
    )
    name = by_remainder(
        key, 7, {1: F.concat(F.lit("A,"), key), 6: F.concat(F.lit("Twice "), F.floor(key / 35))}, F.concat(F.lit('Col "'), F.col("p_name"), F.lit('"'))
    )
    following = F.when(key % 3 == 0, F.concat(F.lit("A,"), key + 7)).otherwise(F.concat(F.lit("T "), key))
    target = by_remainder(key, 7, {1: following, 5: F.lit(" "), 6: F.concat(F.lit("T "), key)}, F.lit(""))
    decision = F.when(key % 2 == 0, " Yes ").otherwise("")
    whole = F.concat_ws(",", F.lower("p_type"), kind, field(name), field(target), decision)
    line = F.when(form == 3, F.concat_ws(",", F.lower("p_type"), kind, field(name))).otherwise(whole)
    return table(spark, folder, "part").select(key, line.alias("line"))


@query
def review_file(spark, folder):
    return review_file_rows.parse_review(review_lines(spark, folder), "p_partkey")


@query
def review_file_decided(spark, folder):
    return review_file_rows.parse_review(review_lines(spark, folder), "p_partkey", require_decision=True)
