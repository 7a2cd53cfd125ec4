"""Value cases: one table of texts per function."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltline import fixed
from siltline.functions import dates, names, numbers, text
from siltline.functions.typed import SqlType, is_lossy, strict_text, try_typed, typed
from siltline.operators import profile


def apply(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_numbers(spark):
    cases = {
        "(1,234.56)": "-1234.56", "$(1,234.56)": "-1234.56", "($1,234.56)": "-1234.56", "$0.00": "0.00", "12,345,678": "12345678",
        "Smith, John": None, "(see attached)": None, "PO-12345": None, "": None, None: None, " 7 \t": "7", ".5": ".5", "5.": "5.",
        "1e3": None, "-": None, "()": None, "+3": "+3", "NaN": None,
    }
    assert apply(spark, list(cases), numbers.numeric_text) == list(cases.values())


def test_integer_and_rate_shapes(spark):
    values = ["2.000", "2.", "2", "-3", "2.5", "1,000", "x", None, "0.0500", "1.25", ".125"]
    assert apply(spark, values, numbers.integer_like) == [True, False, True, True, False, True, False, False, False, False, False]
    assert apply(spark, values, numbers.rate_like) == [True, False, False, False, False, False, False, False, True, False, True]


def test_integers_accept_only_whole_values(spark):
    values = ["2.000000", "2.5", "1e3", "2147483648", "(5)", "", "300"]
    assert apply(spark, values, lambda c: numbers.to_integer(c, "int")) == [2, None, None, None, -5, None, 300]
    assert apply(spark, ["255", "256", "-1"], lambda c: try_typed(c, "TINYINT")) == [255, None, None]


def test_identifiers(spark):
    cases = {"9558.0000": "9558", "12A.": "12A", "1.0.0": "1.0.0", " 77.0 ": "77", "A12.00": "A12.00", "10.50": "10.50", "  ": None}
    assert apply(spark, list(cases), text.identifier) == list(cases.values())


def test_dates_count_as_evidence(spark):
    yes = [
        "2020-01-01 01:30:44.590000000", "01-APR-22", "31-OCT-23 12.58.20.000551000 PM", "2024-02-29", "2024-1-5", "1/2/2024",
        "12/31/2024 23:59", "1/2/2024 11:05:09 PM", "2024-01-05T10:00", "2024-13-45",  # shape alone decides ISO text
    ]
    no = ["2/30/2024", "13/01/2024", "20240105", "2024", "April 1", "1/2/24", "12:30", "1/2/2024 13:00 PM", "", None]
    assert apply(spark, yes, dates.date_like) == [True] * len(yes)
    assert apply(spark, no, dates.date_like) == [False] * len(no)


def test_date_values(spark):
    cases = {
        "2024-02-29": date(2024, 2, 29), "2024-02-30": None, "01-APR-22": date(2022, 4, 1), "15-jul-75": date(1975, 7, 15),
        "31-OCT-23 12.58.20.000551000 PM": date(2023, 10, 31), "1/2/2024 23:00": date(2024, 1, 2), "20240131": date(2024, 1, 31),
        "1900-01-01": None, " ": None, "2022": None, "2020-01-01 01:30:44.590000000": date(2020, 1, 1), "01-APR-49": date(2049, 4, 1),
    }
    assert apply(spark, list(cases), dates.to_date) == list(cases.values())
    assert apply(spark, ["1900-01-01", "1753-01-01"], lambda c: dates.to_date(c, ["1753-01-01 00:00:00.000"])) == [date(1900, 1, 1), None]


def test_timestamp_values(spark):
    cases = {
        "2024-02-29 10:11:12.5": datetime(2024, 2, 29, 10, 11, 12, 500000), "2024-02-29": datetime(2024, 2, 29),
        "1/2/2024 3:04 PM": datetime(2024, 1, 2, 15, 4), "12/31/2024 23:59:58": datetime(2024, 12, 31, 23, 59, 58),
        "31-OCT-23 12.58.20.000551000 PM": datetime(2023, 10, 31, 12, 58, 20, 551), "1900-01-01 00:00:00": None, "soon": None,
        "2024-02-29T10:11": datetime(2024, 2, 29, 10, 11), "2024-02-29 25:00": None,
    }
    assert apply(spark, list(cases), dates.to_timestamp) == list(cases.values())


def test_value_kinds(spark):
    values = ["01-APR-22", "12.5", "abc", " ", None, "2024-01-01"]
    assert apply(spark, values, profile.value_kind) == ["date", "numeric", "text", None, None, "date"]


def test_text_helpers(spark):
    assert apply(spark, ["  a 　", "\t\n", None, " b\x1f"], text.blank_to_null) == ["a", None, None, "b"]
    assert apply(spark, ["a\r\nb\x1fc"], text.scrub) == ["a  b c"]
    assert apply(spark, ["x" * 4001, "x" * 4000], lambda c: F.length(text.shorten(c))) == [4000, 4000]
    assert apply(spark, ["Y", " no ", "T", "0", "2", None], text.boolean_word) == [True, False, True, False, None, None]
    assert apply(spark, ["a\x07", "a\tb\n", "\x7f"], text.has_control_characters) == [True, False, True]


def test_typed_defaults_and_nulls(spark):
    values = [" 1,000 ", "", "n/a"]
    assert apply(spark, values, lambda c: typed(c, "MONEY")) == [Decimal("1000.0000"), Decimal("0.0000"), Decimal("0.0000")]
    assert apply(spark, values, lambda c: typed(c, "MONEY", blank_policy="null")) == [Decimal("1000.0000"), None, None]
    assert apply(spark, [" abcdef ", None], lambda c: typed(c, "VARCHAR(3)")) == ["abc", ""]
    assert apply(spark, ["95.000"], lambda c: typed(c, "VARCHAR(100)", identifier=True)) == ["95"]
    assert apply(spark, ["Y", "maybe"], lambda c: typed(c, "BIT")) == [True, None]
    assert apply(spark, values, lambda c: is_lossy(c, "INT")) == [False, False, True]
    assert apply(spark, ["1900-01-01", "never"], lambda c: is_lossy(c, "DATE")) == [False, True]


def test_type_names():
    assert SqlType.parse("DECIMAL(17, 4)").spark == "decimal(17,4)"
    assert SqlType.parse("money").spark == "decimal(19,4)"
    assert SqlType.parse("VARCHAR(MAX)").length is None
    assert SqlType.parse("TINYINT").spark == "smallint"
    assert [SqlType.parse(t).spark for t in ("DATE", "DATETIME2(7)", "DATETIMEOFFSET", "BIT", "TIME", "VARBINARY(8)")] == [
        "date", "timestamp_ntz", "timestamp", "boolean", "string", "binary",
    ]


@pytest.mark.parametrize(
    "declared, cases",
    [
        ("BIT", {"Y": "1", "n": "0", "x": "invalid", "": ""}),
        ("DECIMAL(18,0)", {"24.000": "24", "100.00": "100", "($1,234)": "-1234", "2.5": "invalid"}),
        ("DECIMAL(18,2)", {"$(1,234.56)": "-1234.56", "1.239": "1.23", "1.2": "1.20", "5.00": "5", ".5": "0.50", "0010": "10", "x": "invalid"}),
        ("INT", {"7.0": "7", "+007": "7", "-3": "-3", "7.1": "invalid", "0.0": "0"}),
        ("VARCHAR(10)", {" a\nb ": "a b", None: ""}),
    ],
)
def test_strict_text(spark, declared, cases):
    def both(c):
        value, invalid = strict_text(c, declared)
        return F.when(invalid, F.lit("invalid")).otherwise(value)

    assert apply(spark, list(cases), both) == list(cases.values())


def test_identifier_columns(spark):
    yes = ["Vendor", "PayVendor", "TransactionIDNumber", "PurchaseOrder", "Buyer", "supplierName", "PO-NUMBER", "item_code"]
    no = ["Description", "Amount", "LineQty"]
    assert apply(spark, yes + no, names.is_identifier) == [True] * len(yes) + [False] * len(no)


def test_name_meanings(spark):
    cases = {
        "DISTR_QTY": "quantity", "FLX_CREATE_DATE": "date", "LAST_UPDATE_DTTM": "date", "COMMENT_ID": "identifier", "PaidVendor": "identifier",
        "BaseCurrencyNumberOfDecimals": "quantity", "BasePaymentAmount": "amount", "NumberOfLines": "quantity", "CancelSequence": "quantity",
        "CashLedgerTransaction": "quantity", "OriginalPurchaseOrder": "identifier", "CreditReceived": "amount", "ReturnValue": "amount",
        "TAX_R": "rate", "ROWCOUNT": "quantity", "CorporateName": "rate", "Memo": "generic",
    }
    assert apply(spark, list(cases), names.semantics) == list(cases.values())


def test_sanitized_names(spark):
    cases = {
        "Doc. Date": "Doc_Date", "123 Code": "Column_123_Code", "Pur. Doc.": "Pur_Doc", "A.B": "A_B", ".Name": "Name", "Name.": "Name",
        "PO-NUMBER": "PO_NUMBER", "***": "Column", "a.b.c": "a_b_c", "x" * 130: "x" * 120, "Supplier's No": "Supplier_s_No",
    }
    assert apply(spark, list(cases), names.sanitize) == list(cases.values())


def test_entities_and_tables(spark):
    files = {
        "VOUCHER_LINE_01012024_06302024_1.csv": "VOUCHER_LINE", "PAYMENT_TBL_01012022_09302024.csv": "PAYMENT_TBL", "custom_name.csv": "custom_name",
        "2024 BSEG Complete.csv": "BSEG",
    }
    assert apply(spark, list(files), lambda c: names.entity_from_file(c, r"^\d{4}\s+", r"\s+Complete$")) == list(files.values())
    assert apply(spark, ["2023 vendor.csv", "a--b.txt"], lambda c: names.entity_key(c, r"^\d{4}\s+")) == ["VENDOR", "A_B"]
    tables = {"raw.VOUCHER_1": "raw.VOUCHER", "raw.A_1_2": "raw.A_1_2", "raw.1_2": "raw.1_2", "raw.PLAIN": "raw.PLAIN", "raw.X__7": "raw.X_"}
    assert apply(spark, list(tables), names.plain_table_name) == list(tables.values())


def test_similarity_form(spark):
    cases = {"Delivery_Note Quantity": "dnqty", "Created_By": "created", "Amount_in_LC": "amountlc", "Discount Reference": "discref"}
    assert apply(spark, list(cases), names.similarity_form) == list(cases.values())


def test_header_trim_and_hash(spark):
    frame = spark.createDataFrame([([" A ", "B", "", " "],), (["", ""],)], "h array<string>")
    assert [r[0] for r in frame.select(names.trim_header(F.col("h"))).collect()] == [["A", "B"], ["", ""]]
    import hashlib, json

    header = ["Größe", 'a"b', "x/y"]
    expected = hashlib.sha256(json.dumps(header, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:16]
    one = spark.createDataFrame([([" Größe", 'a"b', "x/y "],)], "h array<string>")
    assert one.select(names.header_hash(F.col("h"))).first()[0] == expected


def test_whitespace_is_what_str_strip_removes():
    assert set(fixed.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
