"""NULL rules of staged columns as data: which columns may be NULL, and how many values break the rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from siltline.functions.typed import SqlType


def may_be_null(sql_type: str, profiled: str | None = None) -> bool:
    """Dates may, since text that is no date becomes NULL. Otherwise the profile decides (``NULL`` or
    ``NOT NULL``); without one, numbers and text may not, for which blanks have a value of the type."""
    kind = SqlType.parse(sql_type)
    if kind.is_date:
        return True
    if profiled:
        return profiled == "NULL"
    return not (kind.is_numeric or kind.is_text)


def _nulls(column: str) -> Column:
    return F.count_if(F.col(f"`{column}`").isNull())


def null_counts(df: DataFrame, rules: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """Per rule (column, type, nullable): ``column_name, sql_type, nullability, null_row_count, is_violated``.

    All columns are counted in one pass with one row per task; a column has a row even when ``df`` has none.
    """
    counted = df.agg(*[_nulls(name).alias(f"c{i}") for i, (name, _, _) in enumerate(rules)])
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(sql_type).alias("sql_type"),
                F.lit("NULL" if nullable else "NOT NULL").alias("nullability"),
                F.col(f"c{i}").alias("null_row_count"),
                (~F.lit(nullable) & (F.col(f"c{i}") > 0)).alias("is_violated"),
            )
            for i, (name, sql_type, nullable) in enumerate(rules)
        ]
    )
    return counted.select(F.inline(cells))


class NullViolation(ValueError):
    """Columns that must not be NULL hold NULLs; ``counts`` says how many."""

    def __init__(self, table: str, counts: dict[str, int]):
        self.counts = counts
        told = ", ".join(f"{name} ({n} rows)" for name, n in counts.items())
        super().__init__(f"{table}: NULL in columns that are NOT NULL: {told}; the table is unchanged")


@dataclass
class Watch:
    """Counts the NULLs of ``required`` columns while the rows are written, without a pass of its own."""

    required: Sequence[str]

    def __post_init__(self):
        self.seen = Observation()

    def over(self, df: DataFrame) -> DataFrame:
        counts = [_nulls(name).alias(f"c{i}") for i, name in enumerate(self.required)]
        return df.observe(self.seen, *counts) if counts else df

    def check(self, table: str) -> None:
        if not self.required:
            return
        found = self.seen.get
        broken = {name: found[f"c{i}"] for i, name in enumerate(self.required) if found[f"c{i}"]}
        if broken:
            raise NullViolation(table, broken)
