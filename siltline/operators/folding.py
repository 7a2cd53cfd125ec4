"""Aggregates whose groups stay in a hash map although they keep text or structs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def unsorted(value: Column) -> Column:
    """``value``, an aggregate, computed without sorting the rows by group first.

    Spark's fixed-width hash map can't hold the least or latest text of a group, so it sorts all rows
    of a task below such aggregates. Beside an aggregate that keeps objects it takes its object hash map
    instead; an always empty set is one. Tasks with more groups than
    ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` (see ``siltline.session``) sort after all,
    and what is merged behind the shuffle is folded already.
    """
    nothing = F.collect_set(F.lit(None).cast("tinyint"))
    return F.when(F.size(nothing) == 0, value)
