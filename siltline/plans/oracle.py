"""The registered queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

import string

from siltline import fixed

WS = fixed.WHITESPACE.replace("'", "''")
RAW = fixed.RAW_TEXT_TYPE
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\z"
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?\z"
MON = r"(?i)^[0-9]{2}-[A-Z]{3}-[0-9]{2}\z"
SLASH = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
LOADED = "TIMESTAMP '2026-01-02 03:04:05'"


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def filled(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def loosened(x: str) -> str:
    bare = f"translate({strip(x)}, '\u00a0\t ,$', '')"
    return f"regexp_replace({bare}, '^\\((.+)\\)$', '-\\1')"


def numeric(x: str) -> str:
    return f"CASE WHEN regexp_matches({loosened(x)}, '{NUMBER}') THEN {loosened(x)} END"


def matches(x: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({x}, '{pattern}'), false)"


def money(c: str, digits: int = 2) -> str:
    return f"cast(cast({c} AS decimal(15,{digits})) AS varchar)"


def commas(c: str, digits: int = 2) -> str:
    return f"format('{{:,.{digits}f}}', {c})"


def bucket(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR {x} <= 100 THEN 'VARCHAR(100)' WHEN {x} <= 255 THEN 'VARCHAR(255)' "
        f"WHEN {x} <= 1000 THEN 'VARCHAR(1000)' ELSE 'VARCHAR(4000)' END"
    )


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def nullability(blank: str = "blank_row_count") -> str:
    return (
        f"cast({blank} > 0 AS integer) AS nullable_flag, "
        f"CASE WHEN {blank} > 0 THEN 'NULL' ELSE 'NOT NULL' END AS nullability, '{RAW}' AS defined_sql_type"
    )


def profile_rows(source: str, columns: list[tuple[str, str]], keys: str = "", extra: str = "") -> str:
    """UNION ALL of one aggregate per column; ``columns`` are (name, text expression)."""
    parts = []
    for i, (name, expression) in enumerate(columns, start=1):
        value = filled(expression)
        head = f"{keys}, " if keys else ""
        group = f" GROUP BY {keys}" if keys else ""
        parts.append(
            f"SELECT {head}{i} AS ordinal_position, '{name}' AS column_name, min(v) AS minimum_non_null_value, "
            f"max(v) AS maximum_non_null_value, cast(max(length(v)) AS integer) AS max_string_length, "
            f"count(*) FILTER (v IS NULL) AS blank_row_count, count(v) AS non_null_row_count{extra} "
            f"FROM (SELECT *, {value} AS v FROM {source}){group}"
        )
    return " UNION ALL ".join(parts)


def profile(source: str, columns: list[tuple[str, str]]) -> str:
    return f"SELECT *, {nullability()} FROM ({profile_rows(source, columns)})"


LINEITEM = [
    ("l_orderkey", "cast(l_orderkey AS varchar)"), ("l_partkey", "cast(l_partkey AS varchar)"),
    ("l_suppkey", "cast(l_suppkey AS varchar)"), ("l_linenumber", "cast(l_linenumber AS varchar)"),
    ("l_quantity", money("l_quantity")), ("l_extendedprice", money("l_extendedprice")),
    ("l_discount", money("l_discount")), ("l_tax", money("l_tax")), ("l_returnflag", "l_returnflag"),
    ("l_linestatus", "l_linestatus"), ("l_shipdate", stamp("l_shipdate")),
]
CUSTOMER = [
    ("c_custkey", "cast(c_custkey AS varchar)"), ("c_name", "c_name"), ("c_nationkey", "cast(c_nationkey AS varchar)"),
    ("c_acctbal", money("c_acctbal")), ("c_mktsegment", "c_mktsegment"),
]
DESCRIBED = [
    ("LineItemID", "cast(l_orderkey AS varchar)"), ("PaidVendor", "cast(l_suppkey AS varchar) || '.000000'"),
    ("ORDER_QTY", money("l_quantity")), ("NumberOfDecimals", money("l_tax", 4)), ("ExtendedAmount", money("l_extendedprice")),
    ("DiscountRate", money("l_discount", 4)), ("TAX_PCT", money("l_tax")), ("ShipDate", stamp("l_shipdate")),
    ("CLEARED_DT", "upper(strftime(l_shipdate, '%d-%b-%y'))"), ("Posted", "strftime(l_shipdate, '%-m/%-d/%Y')"),
    ("Mixed_Total", f"CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE {money('l_extendedprice')} END"),
    ("ReturnFlag", "l_returnflag"), ("CashLedgerTransaction", "cast(l_linenumber AS varchar)"),
    ("CreditReceived", money("l_extendedprice")), ("ChargeBack_AMT", f"'(' || {money('l_extendedprice')} || ')'"), ("Unused", "' '"),
]


def listing(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def words(x: str) -> str:
    once = f"regexp_replace({x}, '([A-Z])([A-Z][a-z])', '\\1_\\2', 'g')"
    twice = f"regexp_replace({once}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
    return f"string_split(regexp_replace(upper({twice}), '[^A-Z0-9]+', '_', 'g'), '_')"


def semantics(x: str) -> str:
    exact = f"regexp_replace(upper({x}), '[^A-Z0-9]+', '', 'g')"
    cases = [f"WHEN {exact} = '{name}' THEN '{kind}'" for name, kind in fixed.SEMANTIC_OVERRIDES.items()]
    for values, kind in (
        (fixed.DATE_WORDS, "date"), (fixed.RATE_WORDS, "rate"), (fixed.DECIMALS_WORDS, "quantity"),
        (fixed.AMOUNT_WORDS, "amount"), (fixed.QUANTITY_WORDS, "quantity"), (fixed.IDENTIFIER_WORDS, "identifier"),
    ):
        cases.append(f"WHEN list_has_any({words(x)}, {listing(values)}) THEN '{kind}'")
    for pattern, kind in (("DATE|DT$", "date"), ("RATE|PERCENT|_R$", "rate"), ("AMOUNT|TOTAL|_AMT$", "amount"), ("COUNT$|_QTY$", "quantity")):
        cases.append(f"WHEN regexp_matches(upper({x}), '{pattern}') THEN '{kind}'")
    return "CASE " + " ".join(cases) + " ELSE 'generic' END"


def identifier_name(x: str) -> str:
    fragments = " OR ".join(f"contains(upper({x}), '{f}')" for f in fixed.IDENTIFIER_FRAGMENTS)
    return f"(list_has_any({words(x)}, {listing(fixed.IDENTIFIER_WORDS)}) OR {fragments})"


def date_like(x: str) -> str:
    v = strip(x)
    return f"({matches(v, ISO)} OR {matches(v, MON)} OR (regexp_matches({v}, '{SLASH}') AND try_strptime({v}, '%m/%d/%Y') IS NOT NULL))"


def kind(x: str) -> str:
    return (
        f"CASE WHEN coalesce({strip(x)}, '') = '' THEN NULL WHEN {date_like(x)} THEN 'date' "
        f"WHEN {matches(loosened(x), NUMBER)} THEN 'numeric' ELSE 'text' END"
    )


def integer_like(x: str) -> str:
    return matches(loosened(x), r"^[+-]?[0-9]+(\.0+)?\z")


def rate_like(x: str) -> str:
    return matches(loosened(x), r"^[+-]?[0-9]*\.[0-9]{3,}\z")


def recommended(source: str) -> str:
    """A profile with semantic kind, mismatch flag and recommended type."""
    low, high = "minimum_non_null_value", "maximum_non_null_value"
    varchar = bucket("max_string_length")
    return f"""
      SELECT * EXCLUDE (lo, hi), CASE
          WHEN semantic_kind = 'identifier' THEN CASE WHEN lo = 'date' AND hi = 'date' THEN 'DATE' ELSE {varchar} END
          WHEN min_max_value_type_mismatch_flag = 1 THEN {varchar}
          WHEN semantic_kind = 'date' THEN CASE WHEN lo = 'date' AND hi = 'date' THEN 'DATE' ELSE {varchar} END
          WHEN semantic_kind = 'amount' THEN CASE WHEN lo = 'numeric' AND hi = 'numeric' THEN 'MONEY' ELSE {varchar} END
          WHEN semantic_kind = 'rate' THEN CASE WHEN {rate_like(low)} OR {rate_like(high)} THEN 'DECIMAL(17, 4)' ELSE {varchar} END
          WHEN semantic_kind = 'quantity' AND {integer_like(low)} AND {integer_like(high)} THEN 'INT'
          WHEN semantic_kind = 'quantity' THEN CASE WHEN lo = 'numeric' AND hi = 'numeric' THEN 'DECIMAL(17, 4)' ELSE {varchar} END
          WHEN lo = 'date' AND hi = 'date' THEN 'DATE' ELSE {varchar} END AS recommended_sql_type
      FROM (SELECT *, coalesce(cast(lo <> hi AS integer), 0) AS min_max_value_type_mismatch_flag
            FROM (SELECT *, {semantics('column_name')} AS semantic_kind, {kind(low)} AS lo, {kind(high)} AS hi FROM ({source})))
    """


# --- messy orders ---------------------------------------------------------------------------

_AMOUNT = money("o_totalprice")
MESSY = f"""
  SELECT o_orderkey AS key,
    CASE o_orderkey % 5 WHEN 0 THEN o_orderkey || '.0000' WHEN 1 THEN '  ' || o_orderkey || ' ' WHEN 2 THEN o_orderkey || '.'
      WHEN 3 THEN o_orderkey || '.50' ELSE cast(o_orderkey AS varchar) END AS "OrderID",
    CASE o_orderkey % 8 WHEN 0 THEN '$(' || {_AMOUNT} || ')' WHEN 1 THEN '$' || {_AMOUNT} WHEN 2 THEN chr(160) || {_AMOUNT} || chr(9)
      WHEN 3 THEN '' WHEN 4 THEN 'n/a' WHEN 5 THEN '(' || {_AMOUNT} || ')' WHEN 6 THEN {commas('o_totalprice')} ELSE {_AMOUNT} END AS "OrderAmount",
    CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 1 THEN upper(strftime(o_orderdate, '%d-%b-%y'))
      WHEN 2 THEN {stamp('o_orderdate')} WHEN 3 THEN '1900-01-01' WHEN 4 THEN 'unknown' WHEN 5 THEN ' '
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "OrderDate",
    CASE o_orderkey % 4 WHEN 0 THEN '   ' WHEN 1 THEN o_orderpriority ELSE ' ' || o_orderpriority || '  ' END AS "Priority.Note",
    CASE o_orderkey % 3 WHEN 0 THEN '12.00' WHEN 1 THEN '7' ELSE '3.5' END AS "LINE QTY",
    {LOADED} AS "LoadDate", '/in/orders_' || o_orderstatus || '.csv' AS "SFileName"
  FROM orders
"""
_D = "trim(\"OrderDate\")"
DAY = (
    f"CASE WHEN regexp_matches({_D}, '{SLASH}') THEN cast(try_strptime({_D}, '%m/%d/%Y') AS date) "
    f"WHEN regexp_matches({_D}, '{MON}') THEN cast(try_strptime({_D}, '%d-%b-%y') AS date) "
    f"WHEN regexp_matches({_D}, '{ISO}') THEN cast({_D}[1:10] AS date) END"
)
IDENTIFIER = "regexp_replace(nullif(trim(\"OrderID\"), ''), '^([0-9][^.]*)\\.0*\\z', '\\1')"
AMOUNT = f"try_cast({numeric('\"OrderAmount\"')} AS decimal(19,4))"
QTY = "CASE WHEN regexp_matches(\"LINE QTY\", '^[+-]?[0-9]+(\\.0*)?\\z') THEN cast(split_part(\"LINE QTY\", '.', 1) AS integer) END"


WIDE_NOTE = """nullif(trim("Priority.Note"), '')"""


def staged(default: bool, day: str, note: str = 'left(nullif(trim("Priority.Note"), ' + "''" + '), 5)') -> str:
    wrap = (lambda x, d: f"coalesce({x}, {d})") if default else (lambda x, d: x)
    return f"""
      SELECT {wrap(IDENTIFIER, "''")} AS "OrderID", {wrap(AMOUNT, "cast(0 AS decimal(19,4))")} AS "OrderAmount", {day} AS "OrderDate",
        {wrap(note, "''")} AS "Priority_Note", {wrap(QTY, "0")} AS "LINE_QTY", "LoadDate", "SFileName"
      FROM ({MESSY})
    """


# --- variants of orders -----------------------------------------------------------------------

VARIANTS = {
    "ORDERS_V01": ("F", [("Order ID", "o_orderkey || '.000'"), ("Order.Date", "strftime(o_orderdate, '%Y-%m-%d')"),
                         ("Amount_LC", _AMOUNT), ("Column_004", "''")]),
    "ORDERS_V02": ("O", [("Order ID", "o_orderkey || '.000'"), ("Order.Date", "strftime(o_orderdate, '%Y-%m-%d')"),
                         ("Amount_in_LC", _AMOUNT), ("Column_004", "''"), ("Priority", "' ' || o_orderpriority")]),
    "ORDERS_V03": ("P", [("Order ID", "o_orderkey || '.000'"), ("Priority", "' ' || o_orderpriority"),
                         ("Column_005", "CASE WHEN o_orderkey % 10 = 0 THEN 'hold' ELSE ' ' END"),
                         ("Supplier_Ref", "cast(o_custkey AS varchar)")]),
}


def variant_profiles() -> str:
    parts = [
        f"SELECT 'ORDERS' AS entity_name, '{name}' AS pipeline_name, 'raw.{name}' AS table_name, "
        f"blank_row_count + non_null_row_count AS row_count, * FROM "
        f"({profile(f'(FROM orders WHERE o_orderstatus = ' + chr(39) + status + chr(39) + ')', columns)})"
        for name, (status, columns) in VARIANTS.items()
    ]
    return recommended(" UNION ALL ".join(parts))


PRESENCE = f"""
  WITH cols AS ({variant_profiles()})
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY column_name) = 3 THEN 'common' ELSE 'variant_only' END AS presence,
    round(non_null_row_count / nullif(non_null_row_count + blank_row_count, 0), 6) AS fill_rate FROM cols
"""


def harmonised() -> str:
    def cell(variant: str, source: str) -> str:
        expression = dict(VARIANTS[variant][1]).get(source)
        if source == "Order.Date":
            return f"cast({expression} AS date)" if expression else "cast(NULL AS date)"
        return f"left(nullif(trim({expression}), ''), 4000)" if expression else "cast(NULL AS varchar)"

    outs = [("Order ID", "Order_ID"), ("Order.Date", "Order_Date"), ("Amount_LC", "Amount_LC"), ("Amount_in_LC", "Amount_in_LC"),
            ("Priority", "Priority"), ("Column_005", "Column_005"), ("Supplier_Ref", "Supplier_Ref")]
    return " UNION ALL ".join(
        f"SELECT {', '.join(f'{cell(name, source)} AS {chr(34)}{out}{chr(34)}' for source, out in outs)}, '{name}' AS \"SourceVariant\", "
        f"'raw.{name}' AS \"SourceTable\", {LOADED} AS \"LoadDate\", '/in/{name}_' || (o_custkey % 3) || '.csv' AS \"SFileName\", "
        f"o_orderkey AS k FROM orders WHERE o_orderstatus = '{status}'"
        for name, (status, _) in VARIANTS.items()
    )


HRM_COLUMNS = ["Order_ID", "Order_Date", "Amount_LC", "Amount_in_LC", "Priority", "Column_005", "Supplier_Ref"]


def samples(limit: int) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, cast(\"{c}\" AS varchar) AS value, \"SourceVariant\" AS v, \"SFileName\" AS f, k FROM hrm"
        for c in HRM_COLUMNS
    )
    return f"""
      SELECT column_name, string_agg(v || '|' || regexp_extract(f, '([^/]*)$', 1) || '|' || value, ' || ' ORDER BY rn) AS sample_values
      FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY v, f, k) AS rn FROM ({cells}) WHERE trim(value) <> '')
      WHERE rn <= {limit} GROUP BY column_name
    """


SAFE = {"Order ID": "Order_ID", "Order.Date": "Order_Date"}


def anomaly() -> str:
    rename = "CASE column_name WHEN 'Order ID' THEN 'Order_ID' WHEN 'Order.Date' THEN 'Order_Date' ELSE column_name END"
    form = "lower(column_name)"
    for old, new in fixed.SIMILARITY_WORDS:
        form = f"replace({form}, '{old}', '{new}')"
    form = f"regexp_replace({form}, '[^a-z0-9]+', '', 'g')"
    return f"""
      WITH hrm AS ({harmonised()}), s AS ({samples(2)}),
      cols AS (SELECT * REPLACE ({rename} AS column_name) FROM ({variant_profiles()})),
      cat AS (
        SELECT column_name, string_agg(pipeline_name, ';' ORDER BY pipeline_name) AS present, list(pipeline_name) AS places,
          cast(sum(non_null_row_count) AS bigint) AS n,
          string_agg(pipeline_name || '|' || table_name || '|ordinal=' || ordinal_position, '; ' ORDER BY pipeline_name) AS trace,
          {form} AS form
        FROM cols WHERE column_name IN ({", ".join(f"'{c}'" for c in HRM_COLUMNS)}) GROUP BY column_name HAVING count(*) < 3),
      c AS (SELECT cat.*, coalesce(s.sample_values, '') AS sample_values FROM cat LEFT JOIN s USING (column_name)),
      missing AS (
        SELECT column_name, string_agg(v, ';' ORDER BY v) AS missing FROM cat, (VALUES ('ORDERS_V01'), ('ORDERS_V02'), ('ORDERS_V03')) t(v)
        WHERE NOT list_contains(places, v) GROUP BY column_name)
      SELECT 'ORDERS' AS entity_name,
        CASE WHEN regexp_matches(column_name, '^Column_[0-9]+$') THEN 'unnamed_source_column_with_values' ELSE 'named_variant_only_column' END AS anomaly_type,
        column_name AS hrm_column_name, '' AS candidate_column_name, present AS present_in_variants, missing AS missing_from_variants,
        cast(n AS varchar) AS non_null_row_count, sample_values, trace AS source_trace,
        CASE WHEN regexp_matches(column_name, '^Column_[0-9]+$')
          THEN 'Identify source meaning from sample values; rename or approve drop before stg.'
          ELSE 'Decide whether to keep as independent field or map/coalesce with a related field in stg.' END AS recommended_review_action,
        '' AS review_decision, '' AS review_notes
      FROM c JOIN missing USING (column_name)
      UNION ALL
      SELECT 'ORDERS', 'possible_rename_pair', l.column_name, r.column_name, l.column_name || ':' || l.present || ' | ' || r.column_name || ':' || r.present,
        '', l.column_name || ':' || l.n || ' | ' || r.column_name || ':' || r.n,
        l.column_name || ' => ' || l.sample_values || ' | ' || r.column_name || ' => ' || r.sample_values,
        l.column_name || ': ' || l.trace || ' | ' || r.column_name || ': ' || r.trace,
        'Decide whether these columns should coalesce into one stg field.', '', ''
      FROM c l JOIN c r ON l.column_name < r.column_name AND (contains(l.form, r.form) OR contains(r.form, l.form))
        AND NOT list_has_any(l.places, r.places)
        AND NOT regexp_matches(l.column_name, '^Column_[0-9]+$') AND NOT regexp_matches(r.column_name, '^Column_[0-9]+$')
    """


# --- names ------------------------------------------------------------------------------------


def sanitized(x: str) -> str:
    joined = strip(x)
    for _ in range(2):  # neighbouring words share a letter, hence twice
        joined = f"regexp_replace({joined}, '([A-Za-z])\\.\\s*([A-Za-z])', '\\1_\\2', 'g')"
    bare = f"trim(regexp_replace(replace({joined}, '.', ''), '[^A-Za-z0-9]+', '_', 'g'), '_')"
    return (
        f"left(CASE WHEN {bare} = '' THEN 'Column' WHEN regexp_matches({bare}, '^[0-9]') THEN 'Column_' || {bare} ELSE {bare} END, 120)"
    )


PART_HEADER = (
    "[p_name, '', p_type, list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' '), "
    "p_name, '  ', cast(p_size AS varchar), p_brand, cast(p_size AS varchar), ' ']"
)
PART_POSITIONS = f"""
  SELECT p_partkey, cast(i AS integer) AS ordinal_position, {strip('h[i]')} AS source_name,
    CASE WHEN {strip('h[i]')} = '' THEN 'Column_' || lpad(cast(i AS varchar), 3, '0') ELSE {sanitized('h[i]')} END AS base
  FROM (SELECT p_partkey, {PART_HEADER} AS h, unnest(range(1, 11)) AS i FROM part)
"""
CUSTOMER_HEADER = f"""
  SELECT c_mktsegment AS entity_name, c_name || '.csv' AS file_name,
    ['Doc. Date', 'Amount']
    || CASE WHEN c_nationkey % 3 = 0 AND c_mktsegment <> 'BUILDING' THEN ['Extra'] ELSE [] END
    || CASE WHEN c_nationkey % 5 = 0 AND c_mktsegment <> 'BUILDING' THEN [''] ELSE [] END
    || CASE WHEN c_nationkey % 7 = 0 AND c_mktsegment <> 'BUILDING' THEN ['Amount'] ELSE [] END
    || CASE WHEN c_mktsegment = 'MACHINERY' THEN ['Vendor'] ELSE [] END AS h
  FROM customer
"""


def json_hash(h: str) -> str:
    return f"left(sha256(cast(to_json({h}) AS varchar)), 16)"


# --- audit rows -------------------------------------------------------------------------------

HISTORY = """
  SELECT 'run' || (event_id // 50) AS "RunID", 'raw.' || upper(event_type) || '_V0' || (user_id % 3 + 1) AS "TableName",
    'Col_' || (user_id % 20) AS "ColumnName", CASE WHEN event_id % 10 = 9 THEN 'RAW_LOAD' ELSE 'PRELOAD_CSV' END AS "CountStage",
    cast(user_id % 20 + 1 AS integer) AS "OrdinalPosition",
    CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'MONEY' WHEN 2 THEN 'date' ELSE 'VARCHAR(255)' END AS "RecommendedSqlType",
    CASE WHEN event_id % 3 = 0 THEN 'VARCHAR(100)' ELSE 'VARCHAR(4000)' END AS "DefinedSqlType",
    cast(date_trunc('hour', ts) AS timestamp) AS "CapturedAt", event_id AS "AutoId"
  FROM events
"""
PRIOR = f"""
  SELECT "TableName", "ColumnName", "DefinedSqlType" FROM
    (SELECT *, row_number() OVER (PARTITION BY "TableName", "ColumnName" ORDER BY "AutoId" DESC) AS rn FROM ({HISTORY}) WHERE "CountStage" = 'PRELOAD_CSV')
  WHERE rn = 1
"""
LATEST = f"""
  SELECT * EXCLUDE (rn) FROM
    (SELECT *, row_number() OVER (PARTITION BY "TableName", "ColumnName" ORDER BY "CapturedAt" DESC, "AutoId" DESC) AS rn
     FROM ({HISTORY}) WHERE "CountStage" = 'PRELOAD_CSV')
  WHERE rn = 1
"""

AUDIT = """
  e AS (SELECT *, cast(date_trunc('second', ts) AS timestamp) AS moment, 'r' || user_id AS run FROM events),
  runs AS (
    SELECT run AS "RunID", 'Feed' || (user_id % 7) AS "PipelineName", min(moment) AS "StartTime", max(moment) AS "EndTime",
      cast(epoch(max(moment)) - epoch(min(moment)) AS bigint) AS "DurationMs",
      CASE WHEN user_id % 11 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS "Status", 'raw.Feed' || (user_id % 7) AS "SourceTable",
      'zen.Feed' || (user_id % 7) AS "TargetTable", count(*) AS "SourceRowCount",
      CASE WHEN user_id % 3 <> 0 THEN count(*) * 2 END AS "TargetRowCount", CASE WHEN user_id % 11 = 0 THEN 'stopped' END AS "ErrorMessage"
    FROM e GROUP BY run, user_id),
  counts AS (
    SELECT event_id AS id, run, 'raw.T' || (event_id % 13) AS t, '/in/f' || (event_id % 17) || '.csv' AS f,
      ['PRELOAD_CSV', 'RAW_LOAD', 'STAGING_LOAD', 'TARGET_LOAD'][event_id % 4 + 1] AS step,
      event_id % 5 AS proper, event_id % 3 AS bad, moment
    FROM e WHERE event_type IN ('view', 'click')),
  last_count AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, step ORDER BY moment DESC, id DESC) AS rn FROM counts) WHERE rn = 1),
  loads AS (
    SELECT event_id AS id, run, 'stg.T' || (event_id % 13) AS t, 'raw.T' || (event_id % 13) AS f,
      ['PRELOAD_PROFILE', 'BCP', 'PYODBC', 'RAW_TO_STG', 'SQL_TO_STG', 'STG_TO_ZEN', 'SQL_TO_TARGET', NULL][event_id % 8 + 1] AS method,
      ['PRELOAD_CSV', 'RAW_LOAD', 'RAW_LOAD', 'STAGING_LOAD', 'STAGING_LOAD', 'TARGET_LOAD', 'TARGET_LOAD', NULL][event_id % 8 + 1] AS step,
      CASE WHEN event_id % 50 = 0 THEN 'FAILED' WHEN event_id % 6 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
      event_id % 100 AS chunk, moment AS s, moment + INTERVAL 5 SECOND AS fin, event_id % 1000 AS ms,
      CASE WHEN event_id % 4 <> 0 THEN 'note ' || event_id END AS note
    FROM e WHERE event_type NOT IN ('view', 'click')),
  noted AS (SELECT *, row_number() OVER (PARTITION BY run, step ORDER BY s, id) AS rn FROM loads WHERE note IS NOT NULL AND step IS NOT NULL),
  load_steps AS (
    SELECT run, step,
      CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'SUCCESS') THEN 'SUCCESS' ELSE arg_max(status, (s, id)) END AS status,
      cast(sum(ms) AS bigint) AS ms, min(s) AS s, max(fin) AS fin, string_agg(DISTINCT method, ',' ORDER BY method) AS methods,
      cast(sum(chunk) AS bigint) AS chunk, arg_max(t, (s, id)) AS t, arg_max(f, (s, id)) AS f
    FROM loads WHERE step IS NOT NULL GROUP BY run, step),
  notes AS (SELECT run, step, string_agg(note, ' | ' ORDER BY rn) AS notes FROM noted WHERE rn <= 3 GROUP BY run, step),
  steps AS (
    SELECT coalesce(c.run, l.run) AS run, coalesce(c.step, l.step) AS step, l.status, coalesce(c.t, l.t) AS t, coalesce(c.f, l.f) AS f,
      coalesce(nullif(c.proper, 0), l.chunk, c.proper) AS proper, coalesce(c.bad, 0) AS bad, l.ms, l.s, l.fin, c.moment, l.methods,
      CASE WHEN l.run IS NOT NULL THEN coalesce(n.notes, '') END AS notes
    FROM last_count c FULL JOIN load_steps l ON c.run = l.run AND c.step = l.step
      LEFT JOIN notes n ON n.run = coalesce(c.run, l.run) AND n.step = coalesce(c.step, l.step))
"""


def summary(where: str) -> str:
    return f"""
      WITH {AUDIT}, picked AS (SELECT * FROM runs {where})
      SELECT r."RunID" AS run_id, r."PipelineName" AS pipeline_name, r."Status" AS pipeline_status, x.step AS step_name,
        CASE x.step WHEN 'PRELOAD_CSV' THEN 1 WHEN 'RAW_LOAD' THEN 2 WHEN 'STAGING_LOAD' THEN 3 WHEN 'TARGET_LOAD' THEN 4 ELSE 5 END AS step_order,
        x.status AS step_status, x.t AS table_name, x.f AS source_name, cast(x.proper AS bigint) AS proper_row_count,
        cast(x.bad AS bigint) AS malformed_row_count, cast(0 AS bigint) AS repaired_row_count, cast(x.ms AS bigint) AS duration_ms,
        {stamp('x.s')} AS started_at, {stamp('x.fin')} AS finished_at, {stamp('x.moment')} AS captured_at, x.methods AS load_methods, x.notes AS notes
      FROM picked r JOIN (
        SELECT * FROM steps UNION ALL
        SELECT "RunID", 'PIPELINE_TOTAL', "Status", "TargetTable", "SourceTable", coalesce("TargetRowCount", "SourceRowCount"), 0, "DurationMs",
          "StartTime", "EndTime", NULL, NULL, "ErrorMessage" FROM runs) x ON x.run = r."RunID"
    """


# --- review -----------------------------------------------------------------------------------


def snapshot(early: bool) -> str:
    where = "o_orderdate < TIMESTAMP '1998-01-01'" if early else "o_orderdate >= TIMESTAMP '1998-01-01'"
    medium = "3-MED" if early else "3-MEDIUM"
    source = (
        f"(SELECT *, CASE WHEN o_orderpriority = '3-MEDIUM' THEN '{medium}' ELSE o_orderpriority END AS file_name FROM orders WHERE {where})"
    )
    columns = [
        ("order_key", "cast(o_orderkey AS varchar)"), ("amount", f"CASE WHEN o_custkey % 4 <> 0 THEN {money('o_totalprice')} END"),
        ("status", f"rpad(o_orderstatus, {90 if early else 101}, 'x')"),
        ("legacy", "'x'") if early else ("customer", "cast(o_custkey AS varchar)"),
    ]
    rows = profile_rows(source, columns, keys="file_name")
    return (
        f"SELECT *, CASE WHEN blank_row_count > 0 THEN 'NULL' ELSE 'NOT NULL' END AS nullability, "
        f"{bucket('max_string_length')} AS defined_sql_type FROM ({rows})"
    )


REVIEWED = f"""
  SELECT *, coalesce(override_sql_type, defined_sql_type) AS final_sql_type FROM (
    SELECT *, round(100.0::double * non_null_row_count / (non_null_row_count + blank_row_count), 2) AS confidence_pct,
      CASE WHEN file_name[1] IN ('1', '2') THEN 'APPROVED' WHEN file_name[1] = '3' THEN 'REJECTED' ELSE 'PENDING' END AS review_status,
      CASE WHEN file_name[1] <> '5' THEN 'lead' END AS approved_by,
      CASE WHEN column_name = 'amount' AND file_name[1] NOT IN ('2', '4') THEN 'MONEY' END AS override_sql_type,
      CASE WHEN column_name = 'amount' AND file_name[1] <> '2' THEN 'checked' ELSE '' END AS review_notes
    FROM ({snapshot(False)}))
"""


def drift() -> str:
    changed = " UNION ALL ".join(
        f"SELECT n.file_name, n.column_name, 'changed_column', '{a}', cast(n.{a} AS varchar), cast(p.{a} AS varchar) "
        f"FROM n JOIN p USING (file_name, column_name) WHERE n.{a} IS DISTINCT FROM p.{a}"
        for a in ("defined_sql_type", "nullability", "max_string_length")
    )
    return f"""
      WITH n AS ({snapshot(False)}), p AS ({snapshot(True)}),
      shared AS (SELECT DISTINCT file_name FROM n SEMI JOIN p USING (file_name))
      SELECT file_name, column_name, 'added_column' AS change, cast(NULL AS varchar) AS attribute, cast(NULL AS varchar) AS current_value,
        cast(NULL AS varchar) AS prior_value
      FROM n SEMI JOIN shared USING (file_name) ANTI JOIN p USING (file_name, column_name)
      UNION ALL SELECT file_name, column_name, 'removed_column', NULL, NULL, NULL
      FROM p SEMI JOIN shared USING (file_name) ANTI JOIN n USING (file_name, column_name)
      UNION ALL {changed}
      UNION ALL SELECT DISTINCT file_name, NULL, 'new_file', NULL, NULL, NULL FROM n ANTI JOIN p USING (file_name)
      UNION ALL SELECT DISTINCT file_name, NULL, 'removed_file', NULL, NULL, NULL FROM p ANTI JOIN n USING (file_name)
    """


# --- records, invoices, errors ------------------------------------------------------------------

_RECORDS = """
  SELECT source AS source_file, string_split(CASE WHEN doc_id % 5 = 0 THEN line || ', ,' ELSE line END, ',') AS f
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
"""
KEPT = f"SELECT * FROM ({_RECORDS}) WHERE len(list_filter(f, lambda x: {strip('x')} <> '')) > 0"


def trimmed(width: int) -> str:
    return (
        f"SELECT source_file, CASE WHEN len(f) > {width} AND len(list_filter(f[{width + 1}:], lambda x: {strip('x')} <> '')) = 0 "
        f"THEN f[1:{width}] ELSE f END AS f FROM ({KEPT})"
    )


PAYMENTS = f"""
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS "Payment_Date", o_orderstatus AS "Payment_Status", 'ACH-' || o_orderkey AS "Transaction_Number",
    CASE o_orderkey % 9 WHEN 0 THEN '   ' WHEN 1 THEN 'no invoice here'
      WHEN 2 THEN '$' || {_AMOUNT} || ' - Supplier Invoice: SINV' || o_orderkey
      ELSE {commas('o_totalprice')} || ' - Supplier Invoice: SINV' || o_orderkey || '  (' || {_AMOUNT} || ') - Supplier Invoice: CR-' || o_custkey
        || ' and -1.21 - Supplier Invoice: X_' || o_orderkey || '.' END AS "Invoices_Paid",
    cast(o_totalprice AS decimal(19,4)) AS "Payment_Amount", o_orderkey AS "AutoId"
  FROM orders
"""
BRIDGE = f"""
  SELECT "AutoId" AS "PaymentDetailAutoId", "Transaction_Number", invoices[i] AS "Invoice_Number",
    cast({numeric('amounts[i]')} AS decimal(19,4)) AS "Invoice_Paid_Amount", cast(i AS integer) AS "Invoice_Paid_Ordinal",
    cast(n AS integer) AS "Source_Invoices_Paid_Length", '{fixed.INVOICE_PATTERN_NAME}' AS "ParsePattern"
  FROM (
    SELECT *, unnest(range(1, len(amounts) + 1)) AS i FROM (
      SELECT "AutoId", "Transaction_Number", length("Invoices_Paid") AS n, regexp_extract_all("Invoices_Paid", '{fixed.INVOICE_PATTERN}', 1) AS amounts,
        regexp_extract_all("Invoices_Paid", '{fixed.INVOICE_PATTERN}', 2) AS invoices
      FROM ({PAYMENTS}) WHERE trim("Invoices_Paid") <> ''))
"""

_ERRORS = """
  SELECT event_id AS line_no, CASE event_id % 6 WHEN 0 THEN '  '
    WHEN 1 THEN '#@ Row ' || user_id || ', Column amount: Invalid value ' || event_id || ' @#'
    WHEN 2 THEN 'row ' || user_id || ' column ' || event_type || ': too long, line ' || event_id
    WHEN 3 THEN 'Line ' || event_id || ' ended early'
    ELSE 'Unexpected ' || event_type || ' after ' || event_id || ' bytes' END AS line
  FROM events
"""
ERRORS = f"""
  SELECT line_no, try_cast(nullif(regexp_extract(line, '(?i)row\\s+(\\d+)', 1), '') AS bigint) AS error_row,
    nullif(regexp_extract(line, '(?i)column\\s+([^\\s,:;]+)', 1), '') AS error_column,
    regexp_replace(regexp_replace(regexp_replace(line, '(?i)\\brow\\s+\\d+\\b', 'row <n>', 'g'), '(?i)\\bline\\s+\\d+\\b', 'line <n>', 'g'), '\\b\\d+\\b', '<n>', 'g') AS message
  FROM (SELECT line_no, {strip('line')} AS line FROM ({_ERRORS})) WHERE line <> ''
"""

_PRICE = "cast(l_extendedprice AS decimal(15,4))"
STRICT = f"""
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN '1' WHEN l_orderkey % 3 = 1 THEN '0' END AS flag, l_orderkey % 3 = 2 AS flag_invalid,
    CASE WHEN q = trunc(q) THEN cast(cast(q AS bigint) AS varchar) END AS qty, q <> trunc(q) AS qty_invalid,
    '-' || CASE WHEN l_extendedprice = trunc(l_extendedprice) THEN cast(cast(l_extendedprice AS bigint) AS varchar)
      ELSE cast(cast(l_extendedprice AS decimal(15,2)) AS varchar) END AS price, false AS price_invalid,
    'a b ' || l_returnflag AS note, false AS note_invalid
  FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN cast(l_quantity AS decimal(15,2)) ELSE cast(l_tax AS decimal(15,2)) END AS q FROM lineitem)
"""


def inferred() -> str:
    """Shares of matching values per candidate type; patterns fit the spellings in the events export."""
    columns = {
        "event_key": "cast(event_id AS varchar)", "flag": "CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE ' no ' END",
        "token": "concat_ws('-', m[1:8], m[9:12], m[13:16], m[17:20], m[21:32])", "clock": "strftime(ts, '%H:%M:%S')",
        "zoned": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", "day": "strftime(ts, '%Y-%m-%d')", "packed_day": "strftime(ts, '%Y%m%d')",
        "stamp": "strftime(ts, '%-m/%-d/%Y %-H:%M')", "tiny": "cast(event_id % 200 + 2 AS varchar)",
        "small": "cast(event_id % 200 - 100 AS varchar)", "big": "cast(event_id * 1000003 + 3000000000 AS varchar)",
        "amount": "cast(cast(value AS decimal(15,3)) AS varchar)", "mostly": "CASE WHEN event_id % 4 = 0 THEN 'x' ELSE cast(event_id AS varchar) END",
        "sparse": "CASE WHEN event_id % 3 = 0 THEN '' ELSE cast(user_id AS varchar) END", "nothing": "' '", "props": "props",
    }
    number = "try_cast(CASE WHEN regexp_matches(v, '^[+-]?[0-9]+$') THEN v END AS hugeint)"
    day = (
        "coalesce(CASE WHEN regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9:]+Z?)?$') THEN try_strptime(v[1:10], '%Y-%m-%d') "
        "WHEN regexp_matches(v, '^[0-9]{8}$') THEN try_strptime(v, '%Y%m%d') "
        "WHEN regexp_matches(v, '^[0-9]+/[0-9]+/[0-9]{4} [0-9]+:[0-9]{2}$') THEN try_strptime(v, '%m/%d/%Y %H:%M') END)"
    )
    tests = {
        "BIT": "lower(v) IN ('1','true','t','yes','y','0','false','f','no','n')",
        "UNIQUEIDENTIFIER": "regexp_matches(replace(v, '-', ''), '^[0-9a-f]{32}$')",
        "TIME": "regexp_matches(v, '^[0-9]{2}:[0-9]{2}:[0-9]{2}$')",
        "DATETIMEOFFSET": "d IS NOT NULL AND v LIKE '%Z'",
        "DATE": "d IS NOT NULL AND (NOT contains(v, ':') OR regexp_matches(v, '[T ]0?0:00(:00)?Z?$'))",
        "DATETIME2": "d IS NOT NULL AND v NOT LIKE '%Z'",
        "TINYINT": "i BETWEEN 0 AND 255", "SMALLINT": "i BETWEEN -32768 AND 32767", "INT": "i BETWEEN -2147483648 AND 2147483647",
        "BIGINT": "i BETWEEN -9223372036854775808 AND 9223372036854775807",
        "DECIMAL": f"regexp_matches(v, '{NUMBER}')",
    }
    counts = ", ".join(f"count(*) FILTER ({test}) AS \"{name}\"" for name, test in tests.items())
    best = "list_max([" + ", ".join(
        f"{{'n': \"{name}\", 'p': {fixed.TYPE_PRIORITY[name]}, 'k': '{name}'}}" for name in tests
    ) + "])"
    digits = "ltrim(replace(ltrim(v, '+-'), '.', ''), '0')"
    scale = "greatest(length(regexp_extract(v, '\\.([0-9]*)$', 1)) - (length(" + digits + ") - length(rtrim(" + digits + ", '0'))), 0)"
    scale = f"CASE WHEN regexp_matches(v, '{NUMBER}') THEN CASE WHEN rtrim({digits}, '0') = '' THEN 0 ELSE {scale} END END"
    precision = f"CASE WHEN regexp_matches(v, '{NUMBER}') THEN greatest(length(rtrim({digits}, '0')), {scale} + 1, 1) END"
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {filled(expression)} AS v FROM (SELECT *, md5(cast(event_id AS varchar)) AS m FROM events)"
        for name, expression in columns.items()
    )
    return f"""
      WITH x AS (SELECT *, {number} AS i, {day} AS d FROM ({rows})),
      c AS (SELECT column_name, count(v) AS n, count(*) FILTER (v IS NULL) AS b, cast(max(length(v)) AS integer) AS len,
        coalesce(max({precision}), 1) AS p, coalesce(max({scale}), 0) AS s, {counts} FROM x GROUP BY column_name),
      g AS (SELECT *, {best} AS best FROM c),
      h AS (SELECT *, CASE WHEN n > 0 THEN best.n / n * 100.0 ELSE 0.0 END AS share FROM g)
      SELECT column_name,
        CASE WHEN n > 0 AND share >= 80 THEN CASE WHEN best.k <> 'DECIMAL' THEN best.k WHEN s = 0 AND p <= 18 THEN 'DECIMAL(18,0)'
          ELSE 'DECIMAL(' || p || ',' || s || ')' END ELSE {bucket('len')} END AS inferred_sql_type,
        round(cast(share AS double), 2) AS confidence_pct, CASE WHEN n > 0 THEN best.n ELSE 0 END AS matched_value_count, n AS non_null_row_count, b AS blank_row_count,
        len AS max_string_length, cast(b > 0 AS integer) AS nullable_flag, CASE WHEN b > 0 THEN 'NULL' ELSE 'NOT NULL' END AS nullability,
        CASE WHEN n = 0 THEN 'all values blank' WHEN share >= 80 THEN 'high_confidence_match' ELSE 'fallback_to_varchar_low_confidence' END AS inference_reason
      FROM h
    """


def quality() -> str:
    columns = [
        ("text", "CASE WHEN doc_id % 97 = 0 THEN text || chr(7) ELSE text END"), ("lang", "lang"),
        ("note", "CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END"), ("empty", "''"), ("n_chars", "cast(n_chars AS varchar)"),
    ]
    control = ", coalesce(bool_or(regexp_matches(v, '" + fixed.CONTROL_PATTERN + "')), false) AS ctl"
    rows = profile_rows("documents", columns, extra=control)
    ratio = "(blank_row_count / (blank_row_count + non_null_row_count))"
    head = "SELECT column_name, '{0}' AS issue_type, 'warning' AS severity, 'Column ''' || column_name || ''' ' || {1} AS message, {2} AS blank_ratio, {3} AS max_string_length FROM p WHERE {4}"
    none_ratio, none_length = "cast(NULL AS double)", "cast(NULL AS integer)"
    return f"WITH p AS ({rows}) " + " UNION ALL ".join(
        [
            head.format("high_blank_ratio", f"'is blank in ' || format('{{:.1f}}', {ratio} * 100) || '% of observed rows.'", f"round({ratio}, 4)", none_length, f"{ratio} >= 0.5"),
            head.format("oversized_text", "'has values longer than 255 characters.'", none_ratio, "max_string_length", "max_string_length > 255"),
            head.format("control_characters", "'contains control characters in sampled values.'", none_ratio, none_length, "ctl"),
        ]
    )


def kinds() -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, \"{c}\" AS value FROM m" for c in ("OrderID", "OrderAmount", "OrderDate", "Priority.Note", "LINE QTY")
    )
    truth = ", ".join(f"'{w}'" for w in fixed.TRUE_WORDS + fixed.FALSE_WORDS)
    return f"""
      WITH m AS ({MESSY})
      SELECT column_name, {kind('value')} AS kind, count(*) AS value_count, count(*) FILTER ({integer_like('value')}) AS integer_like,
        count(*) FILTER ({rate_like('value')}) AS rate_like, count(*) FILTER (lower({strip('value')}) IN ({truth})) AS boolean_like
      FROM ({cells}) GROUP BY ALL
    """


def name_kinds() -> str:
    from siltline.plans.catalog import NAME_ENDS

    ends = listing(NAME_ENDS)
    name = (
        "list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '') "
        f"|| {ends}[p_size % {len(NAME_ENDS)} + 1]"
    )
    return f"""
      SELECT p_partkey, column_name, {semantics('column_name')} AS semantic_kind, {identifier_name('column_name')} AS is_identifier
      FROM (SELECT p_partkey, {name} AS column_name FROM part)
    """


def reconciled() -> str:
    from siltline.plans.catalog import TYPE_CYCLE

    return f"""
      SELECT k AS "ColumnName", CASE WHEN bool_or(t = 'DATE') THEN 'DATE' WHEN bool_or(t = 'MONEY') THEN 'MONEY'
        WHEN bool_or(t LIKE 'DECIMAL%') THEN 'DECIMAL(' || (max(w) + least(max(s), 38 - max(w))) || ', ' || least(max(s), 38 - max(w)) || ')' WHEN bool_or(t = 'INT') THEN 'INT' WHEN bool_or(t = 'BIT') THEN 'BIT'
        ELSE 'VARCHAR(' || max(try_cast(regexp_extract(t, '([0-9]+)', 1) AS integer)) FILTER (t LIKE 'VARCHAR%') || ')' END AS sql_type
      FROM (SELECT *, CASE WHEN t LIKE 'DECIMAL%' THEN regexp_extract(t, ', ([0-9]+)', 1)::INT END AS s,
              CASE WHEN t LIKE 'DECIMAL%' THEN regexp_extract(t, '([0-9]+)', 1)::INT - regexp_extract(t, ', ([0-9]+)', 1)::INT END AS w
            FROM (SELECT p_name || CASE WHEN length(p_name) % 4 = 0 THEN '/' || p_size ELSE '' END AS k, {listing(TYPE_CYCLE)}[p_size % {len(TYPE_CYCLE)} + 1] AS t FROM part))
      GROUP BY k
    """


def renames() -> str:
    """Look-alike names: one in the other, or a matching-blocks ratio, found by cutting at longest matches."""
    form = "lower(c)"
    for old, new in fixed.SIMILARITY_WORDS:
        form = f"replace({form}, '{old}', '{new}')"
    form = f"regexp_replace({form}, '[^a-z0-9]+', '', 'g')"
    shared = " + ".join(f"least(length(a) - length(replace(a, '{x}', '')), length(b) - length(replace(b, '{x}', '')))" for x in string.ascii_lowercase + string.digits)
    return f"""
      WITH RECURSIVE pc AS (
        SELECT DISTINCT p_brand AS e, p_brand || '_V' || p_type AS pl,
          array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), '_')
            || '_' || ['Quantity', 'Qty', 'Reference', 'Ref'][p_size % 4 + 1] AS c FROM part),
      lone AS (
        SELECT e, c, list_sort(list(pl)) AS places, {form} AS form FROM pc GROUP BY e, c
        HAVING count(*) < (SELECT count(DISTINCT q.pl) FROM pc q WHERE q.e = pc.e)),
      pairs AS (
        SELECT l.e AS e, l.c AS lc, r.c AS rc, l.form AS a, r.form AS b, l.places AS lp, r.places AS rp
        FROM lone l JOIN lone r ON l.e = r.e AND l.c < r.c AND NOT list_has_any(l.places, r.places) AND l.form <> '' AND r.form <> ''),
      forms AS (
        SELECT a, b FROM (SELECT DISTINCT a, b FROM pairs) WHERE NOT contains(a, b) AND NOT contains(b, a)
          AND 2.0 * ({shared}) / (length(a) + length(b)) >= {fixed.SIMILARITY_FLOOR}),
      seg AS (
        SELECT a, b, 0 AS alo, length(a) AS ahi, 0 AS blo, length(b) AS bhi, NULL::INT AS k FROM forms
        UNION ALL
        SELECT a, b, p[1], p[2], p[3], p[4], k FROM (
          SELECT a, b, unnest([[alo, m.i, blo, m.j], [m.i - m.n, ahi, m.j - m.n, bhi]]) AS p, unnest([-m.n, NULL]) AS k FROM (
            SELECT a, b, alo, ahi, blo, bhi, min({{'n': -k, 'i': i, 'j': j}}) AS m FROM (
              SELECT a, b, alo, ahi, blo, bhi, i, j,
                list_max(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda n: substr(a, (i + 1)::INT, n::INT) = substr(b, (j + 1)::INT, n::INT))) AS k
              FROM seg, unnest(range(alo, ahi)) AS x(i), unnest(range(blo, bhi)) AS y(j)
              WHERE substr(a, (i + 1)::INT, 1) = substr(b, (j + 1)::INT, 1))
            GROUP BY a, b, alo, ahi, blo, bhi))),
      alike AS (SELECT a, b FROM seg GROUP BY a, b HAVING 2.0 * coalesce(sum(k), 0) / (length(a) + length(b)) >= {fixed.SIMILARITY_FLOOR})
      SELECT e AS entity_name, lc AS left_column, rc AS right_column, array_to_string(lp, ';') AS left_present, array_to_string(rp, ';') AS right_present
      FROM pairs WHERE contains(a, b) OR contains(b, a) OR EXISTS (SELECT 1 FROM alike WHERE alike.a = pairs.a AND alike.b = pairs.b)
    """


def statements() -> dict[str, str]:
    line_no = "(event_id + 1 + event_id // 3)"
    bad = "(event_id % 211 = 0 OR event_id % 212 = 0)"
    end_date = "CASE WHEN d <> DATE '1900-01-01' THEN d END"
    entity_file = (
        "CASE c_custkey % 4 WHEN 0 THEN upper(c_mktsegment) || '_' || c_nationkey || '_01012024_06302024_' || c_custkey || '.csv' "
        "WHEN 1 THEN upper(c_mktsegment) || '_01012022_09302024.CSV' WHEN 2 THEN '2024 ' || upper(c_mktsegment) || ' Complete.csv' "
        "ELSE lower(c_name) || ' v1.2.txt' END"
    )
    stem = "regexp_replace(file_name, '\\.[^.]*$', '')"
    cut = lambda x: f"regexp_replace(regexp_replace({x}, '^[0-9]{{4}}\\s+', ''), '(?i)\\s+Complete$', '')"
    dated = "regexp_extract(file_name, '(?i)^(.+?)_[0-9]{8}_[0-9]{8}(_[0-9]+)?\\.csv$', 1)"
    table_name = (
        "CASE c_custkey % 4 WHEN 0 THEN 'raw.' || c_mktsegment || '_' || c_custkey WHEN 1 THEN 'raw.' || c_nationkey || '_' || c_custkey "
        "WHEN 2 THEN 'raw.' || c_mktsegment || '_2024_' || c_custkey ELSE 'raw.' || c_mktsegment END"
    )
    raw_text = f"chr(160) || chr(12288) || text || chr(13) || chr(10) || chr(31)"
    body = f"nullif({strip(raw_text)}, '')"
    short = f"CASE WHEN length({body}) > 4000 THEN left({body}, 3997) || '...' ELSE {body} END"
    hrm = harmonised()
    sentinel = "CASE WHEN d NOT IN (DATE '1900-01-01', DATE '1998-01-01') THEN d END"
    return {
        "profile_lineitem": profile("lineitem", LINEITEM),
        "profile_customer": profile("customer", CUSTOMER),
        "profile_merge_by_flag": profile("lineitem", [c for c in LINEITEM if c[0] != "l_returnflag"]),
        "recommend_types": f"SELECT * EXCLUDE (blank_row_count, non_null_row_count) FROM ({recommended(profile_rows('lineitem', DESCRIBED))})",
        "infer_types": inferred(),
        "dq_issues": quality(),
        "value_kinds": kinds(),
        "blank_filter": f"SELECT source_file, count(*) AS row_count, cast(sum(len(f)) AS bigint) AS field_count FROM ({KEPT}) GROUP BY source_file",
        "malformed_split": f"SELECT source_file, len(f) <> 2 AS is_malformed, cast(len(f) AS integer) AS field_count, count(*) AS row_count FROM ({trimmed(2)}) GROUP BY ALL",
        "malformed_gate": f"""
          SELECT source_file, count(*) FILTER (len(f) = 1) AS row_count, count(*) FILTER (len(f) <> 1) AS malformed_row_count,
            count(*) FILTER (len(f) <> 1) > 100 AS malformed_threshold_exceeded, count(*) FILTER (len(f) = 1) = 0 AS has_no_data
          FROM ({trimmed(1)}) GROUP BY source_file""",
        "duplicate_rows": f"""
          SELECT source, cast(sum(n) AS bigint) AS data_row_count, cast(sum(n - 1) AS bigint) AS duplicate_data_row_count
          FROM (SELECT source, {strip('trim(text)')} AS t, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source""",
        "quarantine_context": f"""
          WITH r AS (SELECT event_id + 1 AS no, {line_no} AS line, {bad} AS bad,
              concat_ws(',', event_id, user_id, event_type, {money('value')}) AS raw FROM events)
          SELECT '/in/events.csv' AS source_file, 'events:row:' || m.line AS malformed_group_id,
            CASE WHEN r.no < m.no THEN 'before' WHEN r.no = m.no THEN 'malformed' ELSE 'after' END AS row_role, r.line - m.line AS relative_offset,
            cast(r.bad AS integer) AS is_malformed, r.line AS physical_row_number, 4 AS expected_column_count,
            CASE WHEN r.bad THEN 3 ELSE 4 END AS actual_column_count, r.raw AS raw_line_text
          FROM r m JOIN r ON m.bad AND r.no BETWEEN m.no - 2 AND m.no + 2 AND (r.no <= m.no OR r.line - m.line <= 2)""",
        "sample_rows": """
          SELECT * FROM (SELECT o_orderstatus, o_orderkey, o_custkey,
            cast(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS integer) AS sample_no FROM orders) WHERE sample_no <= 5""",
        "clean_money": f"SELECT key, {numeric('\"OrderAmount\"')} AS amount_text, {AMOUNT} AS amount FROM ({MESSY})",
        "clean_identifier": f"SELECT key, {IDENTIFIER} AS order_id FROM ({MESSY})",
        "clean_date": f"SELECT key, is_date_like, {end_date} AS order_date FROM (SELECT key, {date_like('\"OrderDate\"')} AS is_date_like, {DAY} AS d FROM ({MESSY}))",
        "clean_text": f"""
          SELECT doc_id, cast(length({body}) AS integer) AS stripped_length, md5(translate({raw_text}, chr(13) || chr(10) || chr(31), '   ')) AS scrubbed_md5,
            cast(length({short}) AS integer) AS short_length, right({short}, 3) AS short_end, {bucket(f'length({body})')} AS text_type,
            regexp_matches({raw_text}, '{fixed.CONTROL_PATTERN}') AS has_control FROM documents""",
        "stage_orders": f"SELECT * REPLACE ({end_date.replace('d ', '\"OrderDate\" ')} AS \"OrderDate\") FROM ({staged(True, DAY)})",
        "stage_orders_wide": f"SELECT * REPLACE ({end_date.replace('d ', '\"OrderDate\" ')} AS \"OrderDate\") FROM ({staged(True, DAY, WIDE_NOTE)})",
        "stage_orders_nulls": f"SELECT * REPLACE ({sentinel.replace('d ', '\"OrderDate\" ')} AS \"OrderDate\") FROM ({staged(False, DAY)})",
        "cast_loss": f"""
          WITH m AS ({MESSY})
          SELECT 'OrderID' AS column_name, 'VARCHAR(100)' AS sql_type, cast(0 AS bigint) AS lost_values
          UNION ALL SELECT 'OrderAmount', 'MONEY', count(*) FILTER (trim("OrderAmount") <> '' AND {AMOUNT} IS NULL) FROM m
          UNION ALL SELECT 'OrderDate', 'DATE', count(*) FILTER (trim("OrderDate") <> '' AND {DAY} IS NULL) FROM m
          UNION ALL SELECT 'Priority_Note', 'VARCHAR(5)', count(*) FILTER (length(trim("Priority.Note")) > 5) FROM m
          UNION ALL SELECT 'LINE_QTY', 'INT', count(*) FILTER ({QTY} IS NULL) FROM m""",
        "stage_nullability": f"""
          WITH m AS (SELECT *, CASE key % 3 WHEN 0 THEN 'Y' WHEN 1 THEN ' no ' ELSE 'maybe' END AS flag FROM ({MESSY})),
          s AS (SELECT * REPLACE ({end_date.replace('d ', '"OrderDate" ')} AS "OrderDate") FROM ({staged(True, DAY)})),
          c AS (
            SELECT 'OrderID' AS column_name, 'VARCHAR(100)' AS sql_type, count(*) FILTER ({filled('"OrderID"')} IS NULL) > 0 AS blank, 0 AS nulls FROM m
            UNION ALL SELECT 'OrderAmount', 'MONEY', count(*) FILTER ({filled('"OrderAmount"')} IS NULL) > 0, 0 FROM m
            UNION ALL SELECT 'OrderDate', 'DATE', true, (SELECT count(*) FILTER ("OrderDate" IS NULL) FROM s)
            UNION ALL SELECT 'Priority_Note', 'VARCHAR(5)', count(*) FILTER ({filled('"Priority.Note"')} IS NULL) > 0, 0 FROM m
            UNION ALL SELECT 'LINE_QTY', 'INT', count(*) FILTER ({filled('"LINE QTY"')} IS NULL) > 0, 0 FROM m
            UNION ALL SELECT 'IsOpen', 'BIT', false, count(*) FILTER (flag = 'maybe') FROM m
            UNION ALL SELECT 'Handle', 'UNIQUEIDENTIFIER', count(*) FILTER (key % 2 = 0) > 0, count(*) FILTER (key % 2 = 0) FROM m)
          SELECT column_name, sql_type, CASE WHEN blank THEN 'NULL' ELSE 'NOT NULL' END AS nullability,
            cast(nulls AS bigint) AS null_row_count, NOT blank AND nulls > 0 AS is_violated FROM c""",
        "stage_customer": f"SELECT {', '.join(f'left({expression}, 100) AS {name}' for name, expression in CUSTOMER)} FROM customer",
        "strict_typed_text": STRICT,
        "delimited_export": f"""
          SELECT coalesce(flag, '') || chr(31) || coalesce(qty, '') || chr(31) || price || chr(31) || note || chr(31) || '2026-01-02 03:04:05' || chr(31) || '/in/lineitem.csv' AS line,
            cast(flag_invalid AS integer) + cast(qty_invalid AS integer) AS invalid_values FROM ({STRICT})""",
        "sanitize_names": f"""
          SELECT name, {sanitized('name')} AS safe_name FROM (
            SELECT p_size || ' ' || p_name || '.' || p_type || '. ' || p_brand || '.' AS name FROM part UNION ALL SELECT url FROM pages)""",
        "name_semantics": name_kinds(),
        "canonical_headers": f"""
          SELECT p_partkey, ordinal_position, source_name, CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS column_name
          FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey, base ORDER BY ordinal_position) AS n FROM ({PART_POSITIONS}))""",
        "duplicate_headers": f"SELECT p_partkey, source_name AS column_name, count(*) AS occurrences FROM ({PART_POSITIONS}) WHERE source_name <> '' GROUP BY ALL HAVING count(*) > 1",
        "header_hash": f"""
          WITH pos AS (SELECT * FROM ({PART_POSITIONS}) WHERE ordinal_position <= 9),
          named AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, base ORDER BY ordinal_position) AS n FROM pos),
          dup AS (SELECT p_partkey, string_agg(source_name, ';' ORDER BY source_name) AS d FROM
            (SELECT p_partkey, source_name FROM pos WHERE source_name <> '' GROUP BY ALL HAVING count(*) > 1) GROUP BY p_partkey)
          SELECT p_partkey, cast(count(*) AS integer) AS column_count, {json_hash('list(source_name ORDER BY ordinal_position)')} AS header_hash,
            cast(count(*) FILTER (source_name = '') AS integer) AS blank_header_count, coalesce(any_value(d), '') AS duplicate_headers,
            string_agg(CASE WHEN n = 1 THEN base ELSE base || '_' || n END, ';' ORDER BY ordinal_position) AS canonical_columns
          FROM named LEFT JOIN dup USING (p_partkey) GROUP BY p_partkey""",
        "entity_from_filename": f"""
          SELECT c_custkey, file_name, {strip(cut(f"CASE WHEN {dated} <> '' THEN {dated} ELSE {stem} END"))} AS entity_name,
            upper(trim(regexp_replace({cut(stem)}, '[^A-Za-z0-9]+', '_', 'g'), '_')) AS entity_key
          FROM (SELECT c_custkey, {entity_file} AS file_name FROM customer)""",
        "strip_suffix": f"""
          SELECT c_custkey, table_name, CASE WHEN regexp_matches(table_name, '_[0-9]+$') AND NOT regexp_matches(table_name, '[._][0-9]+_[0-9]+$')
            THEN regexp_replace(table_name, '_[0-9]+$', '') ELSE table_name END AS plain_name
          FROM (SELECT c_custkey, {table_name} AS table_name FROM customer)""",
        "variant_summary": f"""
          WITH h AS ({CUSTOMER_HEADER}),
          f AS (SELECT *, {json_hash('h')} AS hash, len(h) AS w, len(list_filter(h, lambda x: x = '')) AS blanks FROM h),
          cells AS (SELECT entity_name, file_name, i, {strip('h[i]')} AS name, CASE WHEN h[i] = '' THEN 'Column_' || lpad(cast(i AS varchar), 3, '0')
              ELSE {sanitized('h[i]')} END AS base FROM (SELECT *, unnest(range(1, w + 1)) AS i FROM f)),
          canon AS (SELECT *, CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS col FROM
              (SELECT *, row_number() OVER (PARTITION BY entity_name, file_name, base ORDER BY i) AS n FROM cells)),
          firsts AS (SELECT entity_name, col, min((file_name, i)) AS seen FROM canon GROUP BY ALL),
          united AS (SELECT entity_name, cast(count(*) AS integer) AS canonical_union_column_count, string_agg(col, ';' ORDER BY seen) AS canonical_union_columns FROM firsts GROUP BY entity_name),
          dups AS (SELECT entity_name, string_agg(DISTINCT name, ';' ORDER BY name) AS d FROM
              (SELECT entity_name, file_name, name FROM cells WHERE name <> '' GROUP BY ALL HAVING count(*) > 1) GROUP BY entity_name),
          s AS (SELECT entity_name, count(*) AS file_count, count(DISTINCT hash) AS variant_count, cast(min(w) AS integer) AS min_column_count,
              cast(max(w) AS integer) AS max_column_count, cast(sum(blanks) AS bigint) AS total_blank_header_count FROM f GROUP BY entity_name)
          SELECT s.*, coalesce(d, '') AS duplicate_headers, canonical_union_column_count, canonical_union_columns,
            min_column_count <> max_column_count AS has_column_count_drift,
            CASE WHEN variant_count = 1 AND total_blank_header_count = 0 AND d IS NULL THEN 'single_shape_load'
              WHEN min_column_count = max_column_count THEN 'single_shape_with_header_cleanup' ELSE 'schema_variant_review_required' END AS recommendation
          FROM s JOIN united USING (entity_name) LEFT JOIN dups USING (entity_name)""",
        "variant_numbers": f"""
          SELECT *, entity_name || '_V' || lpad(cast(row_number() OVER (PARTITION BY entity_name ORDER BY header_hash) AS varchar), 2, '0') AS pipeline_name
          FROM (SELECT entity_name, {json_hash('h')} AS header_hash, count(*) AS file_count, min(file_name) AS first_file, cast(max(len(h)) AS integer) AS column_count
            FROM ({CUSTOMER_HEADER}) GROUP BY ALL)""",
        "harmonize_union": f"SELECT * EXCLUDE (k) FROM ({hrm})",
        "harmonize_plan": f"""
          SELECT out_name, first.v AS first_variant, first.o AS first_position, non_null_row_count,
            CASE WHEN out_name = 'Order_Date' THEN 'DATE' ELSE '{RAW}' END AS sql_type
          FROM (SELECT CASE column_name WHEN 'Order ID' THEN 'Order_ID' WHEN 'Order.Date' THEN 'Order_Date' ELSE column_name END AS out_name,
              min({{'v': pipeline_name, 'o': ordinal_position}}) AS first, cast(sum(non_null_row_count) AS bigint) AS non_null_row_count
            FROM ({variant_profiles()}) WHERE column_name <> 'Column_004' GROUP BY out_name)""",
        "entity_columns": f"SELECT * EXCLUDE (nullable_flag, nullability, semantic_kind, min_max_value_type_mismatch_flag) FROM ({PRESENCE})",
        "entity_report": f"""
          WITH p AS ({PRESENCE}),
          conflict AS (SELECT count(*) AS n FROM (SELECT ordinal_position FROM p GROUP BY ordinal_position HAVING count(DISTINCT column_name) > 1))
          SELECT 'ORDERS' AS entity_name, count(DISTINCT pipeline_name) AS variant_count,
            (SELECT cast(sum(r) AS bigint) FROM (SELECT max(row_count) AS r FROM p GROUP BY pipeline_name)) AS total_row_count,
            count(DISTINCT column_name) FILTER (presence = 'common') AS common_column_count, count(DISTINCT column_name) AS union_column_count,
            (SELECT n FROM conflict) AS ordinal_conflict_count,
            CASE WHEN (SELECT n FROM conflict) > 0 THEN 'review_ordinal_conflicts_before_union'
              WHEN count(DISTINCT column_name) FILTER (presence = 'common') = count(DISTINCT column_name) THEN 'auto_union_candidate'
              ELSE 'review_variant_only_columns_before_union' END AS recommendation
          FROM p""",
        "ordinal_conflicts": f"""
          SELECT entity_name, ordinal_position, string_agg(DISTINCT column_name, ';' ORDER BY column_name) AS column_names
          FROM ({variant_profiles()}) GROUP BY ALL HAVING count(DISTINCT column_name) > 1""",
        "column_samples": f"WITH hrm AS ({hrm}) {samples(3)}",
        "anomaly_rows": anomaly(),
        "reviewed_stage": f"""
          SELECT regexp_replace("Order_ID", '\\.0*$', '') AS "Order_ID", "Order_Date",
            coalesce(cast(coalesce("Amount_in_LC", "Amount_LC") AS decimal(19,4)), cast(0 AS decimal(19,4))) AS "Amount_in_LC",
            coalesce("Priority", '') AS "Priority", coalesce("Supplier_Ref", '') AS "Supplier_Ref", "SourceVariant", "SourceTable", "LoadDate", "SFileName"
          FROM ({hrm})""",
        "rename_candidates": renames(),
        "reconciled_types": reconciled(),
        "stage_autoid": "SELECT o_orderdate, o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS \"AutoId\" FROM orders",
        "zen_append_autoid": """
          SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderkey) AS "AutoId" FROM orders""",
        "zen_appended_rows": """
          SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderkey) AS "AutoId" FROM orders""",
        "stage_position_key": "SELECT count(*) AS row_count, count(*) AS distinct_keys, cast(1 AS bigint) AS first_key, count(*) AS last_key FROM lineitem",
        "prior_types": PRIOR,
        "carried_types": f"WITH p AS ({PRIOR}) SELECT * FROM p UNION ALL SELECT \"TableName\" || '_7', \"ColumnName\", \"DefinedSqlType\" FROM p",
        "latest_profile": LATEST,
        "latest_run": f"""
          WITH h AS (SELECT * FROM ({HISTORY}) WHERE "CountStage" = 'PRELOAD_CSV'),
          l AS (SELECT "TableName", arg_max("RunID", "AutoId") AS "RunID" FROM h GROUP BY "TableName")
          SELECT h.* FROM h JOIN l USING ("TableName", "RunID")""",
        "entity_types": f"""
          SELECT DISTINCT "ColumnName", upper(coalesce(nullif("RecommendedSqlType", ''), nullif("DefinedSqlType", ''), '{RAW}')) AS sql_type
          FROM ({LATEST}) WHERE starts_with("TableName", 'raw.CLICK_V')""",
        "schema_drift": drift(),
        "apply_overrides": f"""
          SELECT file_name, column_name, defined_sql_type, override_sql_type, final_sql_type, review_status, review_notes, approved_by FROM ({REVIEWED})""",
        "review_status": f"""
          SELECT count(*) AS file_count, count(*) FILTER (s = 'PENDING') AS pending_count, count(*) FILTER (s = 'APPROVED') AS approved_count,
            count(*) FILTER (s = 'REJECTED') AS rejected_count, cast(sum(o) AS bigint) AS override_column_count,
            count(*) FILTER (s IN ('PENDING', 'REJECTED')) = 0 AS all_approved
          FROM (SELECT file_name, max(review_status) AS s, count(override_sql_type) AS o FROM ({REVIEWED}) GROUP BY file_name)""",
        "approved_schema": f"""
          SELECT file_name, column_name, defined_sql_type, final_sql_type, override_sql_type, nullability, confidence_pct
          FROM ({REVIEWED}) WHERE review_status = 'APPROVED'""",
        "approved_schema_gated": f"""
          SELECT file_name, column_name, defined_sql_type, final_sql_type, override_sql_type, nullability, confidence_pct
          FROM ({REVIEWED}) WHERE review_status = 'APPROVED'""",
        "approved_schema_complete": f"""
          SELECT file_name, column_name, defined_sql_type AS final_sql_type, nullability, CASE WHEN file_name[1] <> '1' THEN 'lead' END AS approved_by,
            {LOADED} AS approved_at_utc, 'checked ' || file_name[1] AS file_review_notes FROM ({snapshot(False)})""",
        "approval_gate": f"""
          WITH r AS ({REVIEWED}),
          both_reviews AS (SELECT 'all files' AS review, * FROM r UNION ALL SELECT 'approved files', * FROM r WHERE review_status = 'APPROVED'),
          f AS (SELECT review, file_name, any_value(review_status) AS status, count(*) AS columns FROM both_reviews GROUP BY ALL),
          g AS (SELECT review, count(*) AS file_count, count(*) FILTER (status <> 'APPROVED') AS blocking_count,
            coalesce(string_agg(file_name || ' (' || status || ')', ', ' ORDER BY file_name) FILTER (status <> 'APPROVED'), '') AS blocking_files,
            sum(columns) AS columns FROM f GROUP BY review)
          SELECT review, file_count, blocking_count, blocking_files, blocking_count = 0 AS is_complete,
            cast(CASE WHEN blocking_count = 0 THEN columns ELSE 0 END AS bigint) AS approved_column_count FROM g""",
        "blocking_files": f"""
          SELECT DISTINCT file_name, review_status FROM ({REVIEWED}) WHERE review_status IN ('PENDING', 'REJECTED')""",
        "review_top_columns": f"""
          SELECT file_name, column_name, confidence_pct, cast(rn AS integer) AS review_rank FROM (
            SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY override_sql_type IS NULL, confidence_pct >= 95, confidence_pct, column_name) AS rn
            FROM ({REVIEWED})) WHERE rn <= 3""",
        "invoice_bridge": BRIDGE,
        "invoice_flat": f"""
          SELECT b."Invoice_Number", b."Invoice_Paid_Amount", p."Payment_Date", p."Payment_Status", p."Transaction_Number", p."Payment_Amount", p."AutoId"
          FROM ({BRIDGE}) b JOIN ({PAYMENTS}) p ON b."PaymentDetailAutoId" = p."AutoId\"""",
        "row_reconcile": "SELECT count(*) AS source_row_count, count(*) AS target_row_count, true AS is_match FROM orders",
        "load_counts": f"SELECT \"LoadDate\", \"SFileName\", count(*) AS row_count FROM ({hrm}) GROUP BY ALL",
        "partial_loads": f"""
          SELECT "LoadDate", "SFileName", count(*) + 1 AS written_count, count(*) AS row_count FROM ({hrm}) WHERE "SFileName" LIKE '%\\_1.csv' ESCAPE '\\' GROUP BY ALL""",
        "run_summary": summary(""),
        "day_summary": summary("WHERE cast(\"StartTime\" AS date) = DATE '2024-01-02'"),
        "run_state": """
          SELECT 'r' || user_id AS "RunID",
            arg_max(CASE event_id % 4 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'SUCCESS' ELSE 'FAILED' END, event_id) FILTER (event_id % 4 <> 3) AS "Status",
            arg_max('error ' || event_id, event_id) FILTER (event_id % 4 = 2) AS "ErrorMessage",
            arg_max(event_id, event_id) FILTER (event_id % 4 = 1) AS "TargetRowCount"
          FROM events GROUP BY user_id""",
        "error_messages": f"SELECT message, count(*) AS line_count, min(line_no) AS first_at FROM ({ERRORS}) GROUP BY message ORDER BY line_count DESC, first_at LIMIT 5",
        "error_digest": f"""
          WITH e AS ({ERRORS})
          SELECT count(*) AS error_line_count, CASE WHEN count(error_row) > 0 THEN count(DISTINCT error_row) ELSE count(*) END AS error_row_count,
            (SELECT string_agg(error_row, ',' ORDER BY error_row) FROM (SELECT DISTINCT error_row FROM e WHERE error_row IS NOT NULL ORDER BY 1 LIMIT 5)) AS sample_error_rows,
            (SELECT string_agg(error_column, ',' ORDER BY error_column) FROM (SELECT DISTINCT error_column FROM e WHERE error_column IS NOT NULL ORDER BY 1 LIMIT 5)) AS sample_error_columns
          FROM e""",
        "sql_step": """
          SELECT l_returnflag, l_linestatus, sum(cast(l_quantity AS decimal(15,2))) AS sum_qty,
            sum(cast(l_extendedprice AS decimal(15,2))) AS sum_base_price, count(*) AS count_order
          FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00' GROUP BY ALL""",
        "review_file": review_actions("true"),
        "review_file_decided": review_actions("p_partkey % 2 = 0"),
    }


def review_actions(accepted: str) -> str:
    """Actions of the review file from the values that its lines are made of."""
    return f"""
      WITH v AS (
        SELECT p_partkey, upper(p_type) AS entity_name, p_partkey % 7 AS form, {accepted} AS accepted,
          CASE p_partkey % 7 WHEN 1 THEN 'A,' || p_partkey WHEN 6 THEN 'Twice ' || (p_partkey // 35) ELSE 'Col "' || p_name || '"' END AS column_name,
          CASE p_partkey % 7 WHEN 1 THEN CASE WHEN p_partkey % 3 = 0 THEN 'A,' || (p_partkey + 7) ELSE 'T ' || p_partkey END
            WHEN 6 THEN 'T ' || p_partkey END AS target_name FROM part),
      r AS (SELECT DISTINCT entity_name, column_name, target_name FROM v WHERE form IN (1, 6) AND accepted),
      j AS (SELECT v.*, form IN (1, 6) AND accepted AS renamed,
        (SELECT count(*) FROM r WHERE r.entity_name = v.entity_name AND r.column_name = v.column_name) AS targets,
        EXISTS (SELECT 1 FROM r WHERE r.entity_name = v.entity_name AND r.target_name = v.column_name)
          OR EXISTS (SELECT 1 FROM r WHERE r.entity_name = v.entity_name AND r.column_name = v.target_name) AS chained FROM v),
      w AS (SELECT *, CASE form WHEN 3 THEN 'another number of fields' WHEN 4 THEN 'unknown anomaly type' WHEN 5 THEN 'no target' ELSE
        CASE WHEN renamed AND targets > 1 THEN 'more than one target' WHEN renamed AND chained THEN 'source and target of renames' END END AS reason FROM j)
      SELECT p_partkey, entity_name, CASE WHEN reason IS NOT NULL THEN 'reject' WHEN NOT accepted THEN 'skip'
        WHEN form = 0 THEN 'drop' WHEN form = 2 THEN 'note' ELSE 'rename' END AS action, column_name, target_name, reason FROM w"""
