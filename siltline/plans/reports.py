"""Report and bulk-text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline import fixed
from siltline.functions.typed import strict_text


def write_csv(report: DataFrame, path: str, one_file: bool = True) -> None:
    """A report as CSV with a header; reports of rows that grow with the data pass ``one_file=False``."""
    flat = report.select(
        *[
            F.array_join(F.col(f.name).cast("array<string>"), ";").alias(f.name)
            if f.dataType.typeName() == "array"
            else F.col(f.name)
            for f in report.schema.fields
        ]
    )
    (flat.coalesce(1) if one_file else flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def bulk_lines(
    rows: DataFrame, columns: list[tuple[str, str]], load_date: str | None = None, source_file: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """One text line per row: canonical values of ``(column, type)`` joined by the field mark.

    With ``strict`` a value that breaks its type stops the job; otherwise it is written empty and
    ``invalid_values`` counts such values per row.
    """
    if (load_date is None) != (source_file is None):
        raise ValueError("load_date and source_file go together")
    values, broken = [], F.lit(0)
    for name, declared in columns:
        value, invalid = strict_text(F.col(f"`{name}`").cast("string"), declared)
        if strict:
            message = F.concat(F.lit("value '"), F.col(f"`{name}`"), F.lit(f"' of {name} is not valid for {declared}"))
            value = F.when(invalid, F.raise_error(message).cast("string")).otherwise(value)
        else:
            value = F.coalesce(value, F.lit(""))
            broken = broken + invalid.cast("int")
        values.append(value)
    extra = [F.lit(load_date), F.lit(source_file)] if load_date is not None else []
    line = F.concat_ws(fixed.FIELD_MARK, *values, *extra).alias("line")
    return rows.select(line, *([] if strict else [broken.alias("invalid_values")]))


def write_bulk(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("overwrite").option("lineSep", fixed.ROW_END).text(path)
