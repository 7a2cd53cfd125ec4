"""Word lists, thresholds, patterns and labels that results depend on."""

# --- whitespace removed from both ends of raw text (Unicode whitespace plus the four
# --- information separators), as one explicit set so that every engine trims alike
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- name semantics: fixed word lists
DATE_WORDS = ["DATE", "DT", "DOB", "BIRTHDATE"]
RATE_WORDS = ["RATE", "PERCENT", "PCT", "PERCENTAGE", "RATIO", "DISC"]
DECIMALS_WORDS = ["DECIMAL", "DECIMALS"]
AMOUNT_WORDS = ["AMOUNT", "AMT", "TOTAL", "PRICE", "COST", "BALANCE", "CHARGE"]
QUANTITY_WORDS = [
    "QTY", "QUANTITY", "COUNT", "COUNTS", "DAYS", "DAY", "HOURS", "HOUR",
    "UNITS", "UNIT", "SEQ", "SEQUENCE", "LINE", "LINES",
]
IDENTIFIER_WORDS = [
    "ID", "CODE", "TYPE", "INVOICE", "ORDER", "BUYER", "VENDOR", "COMPANY", "PO",
    "ITEM", "LOCATION", "GROUP", "CLASS", "STATUS", "REF", "OBJ", "TAG", "NUMBER",
]
IDENTIFIER_FRAGMENTS = ["VENDOR", "SUPPLIER", "PAYVENDOR", "PAY_VENDOR"]
SEMANTIC_OVERRIDES = {
    "CASHLEDGERTRANSACTION": "quantity",
    "CREDITRECEIVED": "amount",
    "ORIGINALPURCHASEORDER": "identifier",
    "RETURNVALUE": "amount",
}

# --- types
RAW_TEXT_TYPE = "VARCHAR(4000)"
RAW_TEXT_TYPES = ["VARCHAR(4000)", "VARCHAR(MAX)"]
FRACTION_TYPE = "DECIMAL(17, 4)"
VARCHAR_STEPS = [100, 255, 1000, 4000]
CONFIDENCE_THRESHOLD = 80.0
TYPE_PRIORITY = {
    "BIT": 110, "UNIQUEIDENTIFIER": 90, "TIME": 85, "DATETIMEOFFSET": 80, "DATE": 75,
    "DATETIME2": 70, "TINYINT": 60, "SMALLINT": 50, "INT": 40, "BIGINT": 30, "DECIMAL": 20,
}
TRUE_WORDS = ["1", "true", "t", "yes", "y"]
FALSE_WORDS = ["0", "false", "f", "no", "n"]

# --- dates
NULL_DATES = ["1900-01-01"]
CENTURY_PIVOT = 50  # two-digit years from here on belong to the 1900s

# --- layer columns
LOAD_DATE = "LoadDate"
SOURCE_FILE = "SFileName"
AUTO_ID = "AutoId"
VARIANT = "SourceVariant"
VARIANT_TABLE = "SourceTable"
RAW_METADATA = [LOAD_DATE, SOURCE_FILE]
HARMONISED_METADATA = [VARIANT, VARIANT_TABLE, LOAD_DATE, SOURCE_FILE]

# --- files
DELIMITERS = [",", "|", "\t", ";"]
SAMPLE_BYTES = 16384
MAX_PATH = 255
NAME_LIMIT = 120
TEXT_LIMIT = 4000
FIELD_MARK = "\x1f"
ROW_END = "\r\n"

# --- data quality
BLANK_RATIO_LIMIT = 0.5
LONG_TEXT_LIMIT = 255
ISSUE_SAMPLE = 5
CONTROL_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"

# --- invoice text
INVOICE_PATTERN = (
    r"(\(?-?\$?\d[\d,]*(?:\.\d+)?\)?)\s+-\s+Supplier Invoice:\s+([A-Za-z0-9_-]+)"
)
INVOICE_PATTERN_NAME = "workday_supplier_invoice_amount_v1"

# --- rename similarity
SIMILARITY_FLOOR = 0.72
SIMILARITY_WORDS = [
    ("quantity", "qty"), ("discount", "disc"), ("reference", "ref"),
    ("created_by", "created"), ("amount_in_lc", "amount_lc"), ("exempt", "expt"),
    ("del_note", "dn"), ("delivery_note", "dn"),
]

# --- review
REVIEW_STATUSES = ["PENDING", "APPROVED", "REJECTED"]
REVIEW_CONFIDENCE = 95.0
REVIEW_ROWS = 25

# --- audit
STEP_ORDER = {
    "PRELOAD_CSV": 1, "RAW_LOAD": 2, "STAGING_LOAD": 3, "TARGET_LOAD": 4, "PIPELINE_TOTAL": 5,
}
METHOD_STEP = {
    "PRELOAD_PROFILE": "PRELOAD_CSV",
    "BCP": "RAW_LOAD",
    "PYODBC": "RAW_LOAD",
    "RAW_TO_STG": "STAGING_LOAD",
    "SQL_TO_STG": "STAGING_LOAD",
    "STG_TO_ZEN": "TARGET_LOAD",
    "SQL_TO_TARGET": "TARGET_LOAD",
}
RAW_METHOD = "SPARK"  # how this package's own raw loads are logged
DIGEST_SAMPLE = 5

# --- names
DOT_BETWEEN_LETTERS = r"(?<=[A-Za-z])\.\s*(?=[A-Za-z])"
NOT_NAME_CHARACTERS = "[^A-Za-z0-9]+"

# --- values that show a date column when variants are united
ISO_EVIDENCE = (
    r"^\d{4}-\d{2}-\d{2}([T ][0-2]\d:[0-5]\d:[0-5]\d(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})?)?\z"
)

# --- recommendations and advice texts
SINGLE_SHAPE = "single_shape_load"
SINGLE_SHAPE_CLEANUP = "single_shape_with_header_cleanup"
SHAPES_DIFFER = "schema_variant_review_required"
UNION_CONFLICTS = "review_ordinal_conflicts_before_union"
UNION_READY = "auto_union_candidate"
UNION_VARIANT_ONLY = "review_variant_only_columns_before_union"
ADVICE_UNNAMED = "Identify source meaning from sample values; rename or approve drop before stg."
ADVICE_NAMED = "Decide whether to keep as independent field or map/coalesce with a related field in stg."
ADVICE_RENAME = "Decide whether these columns should coalesce into one stg field."

# --- issue messages
MESSAGE_BLANK = ("is blank in ", "% of observed rows.")
MESSAGE_LONG = f"has values longer than {LONG_TEXT_LIMIT} characters."
MESSAGE_CONTROL = "contains control characters in sampled values."
MESSAGE_EMPTY_HEADERS = " empty header positions detected."
MESSAGE_DUPLICATE_HEADERS = " duplicate header names detected."
MESSAGE_MALFORMED = " malformed rows detected."
MESSAGE_DUPLICATE_ROWS = " duplicate data rows detected."

# --- load errors: what is masked, and where row and column stand
ERROR_MASKS = [(r"(?i)\brow\s+\d+\b", "row <n>"), (r"(?i)\bline\s+\d+\b", "line <n>"), (r"\b\d+\b", "<n>")]
ERROR_ROW = r"(?i)row\s+(\d+)"
ERROR_COLUMN = r"(?i)column\s+([^\s,:;]+)"

# Decisions in a reviewed anomaly file that accept a row.
ACCEPTED_DECISIONS = ("accept", "accepted", "approve", "approved", "yes", "y")
