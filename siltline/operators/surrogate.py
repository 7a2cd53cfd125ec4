"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltline import fixed
from siltline.session import cut_lineage, write_aside

# Up to so many files or partitions their offsets are broadcast; more are joined by a shuffle.
BROADCAST_PIECES = 200_000


def key_by_position(table: DataFrame, out: str = fixed.AUTO_ID, start: int = 0) -> DataFrame:
    """``start + 1 .. start + n`` in file order of a Parquet table.

    A row's key is its place in its file plus the rows of the files before it, so nothing is
    shuffled or sorted; the row counts of the files are read in a first pass.
    """
    file, row = "_metadata.file_path", "_metadata.row_index"
    placed = table.select("*", F.col(file).alias("_piece"), F.col(row).alias("_row"))
    sizes = table.select(F.col(file).alias("_piece")).groupBy("_piece").count()
    return _numbered(placed, sizes, F.col("_row"), out, start)


def key_by_order(df: DataFrame, order: list[str], out: str = fixed.AUTO_ID, start: int = 0) -> DataFrame:
    """``start + 1 .. start + n`` in the order of ``order``, which should identify a row.

    Rows are range-partitioned, sorted and written as Parquet once; a row's key is its place in its
    partition plus the rows of the partitions before it.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    placed = write_aside(ranged).withColumn("_piece", F.shiftright("_place", 33))
    sizes = placed.groupBy("_piece").count()
    row = F.col("_place") - F.shiftleft("_piece", 33)
    return _numbered(placed, sizes, row, out, start).drop("_place")


def _numbered(placed: DataFrame, sizes: DataFrame, row: Column, out: str, start: int) -> DataFrame:
    # One row per file or partition, never per record: a single ordered window is enough.
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(
        sizes.select("_piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    # Joined by a shuffle, all rows of a file would meet in one task.
    few = offsets.count() <= BROADCAST_PIECES
    joined = placed.join(F.broadcast(offsets) if few else offsets, "_piece")
    key = (row + F.col("_before") + 1 + start).cast("bigint")
    return joined.withColumn(out, key).drop("_piece", "_before", "_row")


def key_summary(keyed: DataFrame, key: str = fixed.AUTO_ID) -> DataFrame:
    """One row: row_count, distinct_keys, first_key and last_key of any whole-number key.

    64 neighbouring keys are one group with a bit for each, so a task holds and sends a row per 64 keys
    where keys are dense, and one per key at most.
    """
    bit = F.expr(f"shiftleft(1L, cast(`{key}` & 63 AS int))")
    blocks = keyed.groupBy(F.shiftright(key, 6).alias("_block")).agg(
        F.count("*").alias("_rows"), F.bit_or(bit).alias("_seen"), F.min(key).alias("_first"), F.max(key).alias("_last")
    )
    return blocks.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.bit_count("_seen")), F.lit(0)).alias("distinct_keys"),
        F.min("_first").alias("first_key"), F.max("_last").alias("last_key"),
    )


def next_start(table: DataFrame, key: str = fixed.AUTO_ID) -> int:
    """Highest key in use, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
