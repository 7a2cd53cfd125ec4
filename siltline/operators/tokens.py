"""Invoice tokens in payment text, one row per token."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline import fixed
from siltline.functions import numbers, text

DETAIL_COLUMNS = [
    "Payment_Date", "Payment_Status", "Transaction_Number", "Supplier", "Supplier_ID", "Payment_Type",
    "Payment_Amount", "Currency", fixed.LOAD_DATE, fixed.SOURCE_FILE, fixed.AUTO_ID,
]


def invoice_bridge(payments: DataFrame, source: str = "Invoices_Paid", keep: list[str] | None = None) -> DataFrame:
    """``amount - Supplier Invoice: number`` tokens with their place in the text and its length."""
    pattern = F.lit(fixed.INVOICE_PATTERN)
    tokens = F.arrays_zip(
        F.regexp_extract_all(source, pattern, F.lit(1)).alias("amount"),
        F.regexp_extract_all(source, pattern, F.lit(2)).alias("invoice"),
    )
    kept = [c for c in (keep or ["Transaction_Number", *fixed.RAW_METADATA]) if c in payments.columns]
    return (
        payments.where(text.spaces_to_null(F.col(source)).isNotNull())
        .select(fixed.AUTO_ID, *kept, F.length(source).alias("length"), F.posexplode(tokens).alias("at", "token"))
        .select(
            F.col(fixed.AUTO_ID).alias("PaymentDetailAutoId"),
            *[c for c in kept if c not in fixed.RAW_METADATA],
            F.col("token.invoice").alias("Invoice_Number"),
            numbers.to_decimal(F.col("token.amount"), 19, 4).alias("Invoice_Paid_Amount"),
            (F.col("at") + 1).alias("Invoice_Paid_Ordinal"),
            F.col("length").alias("Source_Invoices_Paid_Length"),
            F.lit(fixed.INVOICE_PATTERN_NAME).alias("ParsePattern"),
            *[c for c in kept if c in fixed.RAW_METADATA],
        )
    )


def invoice_flat(bridge: DataFrame, payments: DataFrame) -> DataFrame:
    """Bridge rows with the columns of their payment."""
    detail = payments.select(*[c for c in DETAIL_COLUMNS if c in payments.columns])
    return (
        bridge.select("PaymentDetailAutoId", "Invoice_Number", "Invoice_Paid_Amount")
        .join(detail, F.col("PaymentDetailAutoId") == detail[fixed.AUTO_ID])
        .drop("PaymentDetailAutoId")
    )
