"""K-d tree sharding: boxes of metadata are halved by weight until each holds one shard's bytes.

A box is cut along its widest dimension at the weighted median (at another quantile where its number
of shards is odd). The quantile is found by repeated histograms over all rows of all boxes at once:
each round counts bytes per box and bin and narrows every box's range to the bin of the cut, so what
reaches the driver is one row per box. Behind each coordinate stands a hash of the row, so equal
coordinates, however frequent, can be cut apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, fresh, quoted, table

BINS = 4096
TOLERANCE = 0.0005  # a cut may miss its quantile by this part of a shard
SIZE = "bigint"


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, plus eight for the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _unit(value: Column) -> Column:
    """A category's place in [0, 1), by its checksum; null has one of its own."""
    return F.crc32(F.coalesce(value.cast("string"), F.lit("\0"))) / F.lit(float(1 << 32))


def default_dimensions(docs: DataFrame) -> dict[str, Column]:
    """Source, language and text length (by its logarithm), each in [0, 1); absent columns are left out."""
    found = {c: _unit(quoted(c)) for c in ("source", "lang") if c in docs.columns}
    found["length"] = F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1) / 32
    return found


def _keys(dimensions: dict[str, Column], tie: Column) -> Column:
    """Each dimension as a 62-bit order key: the coordinate above, the row's hash below."""
    coordinates = [F.floor(F.coalesce(d, F.lit(0.0)) * (1 << 30)).cast("long") * (1 << 32) + tie for d in dimensions.values()]
    return F.array(*coordinates)


def _beside(rows: DataFrame, box: str, names: list[str], kinds: tuple[str, ...], values: list[tuple]) -> DataFrame:
    """``rows`` with the values of their box, null where it has none: constants if only one box has
    values, else a join with a table of fewer rows than there are shards."""
    if len(values) == 1:
        mine = quoted(box) == values[0][0]
        return rows.withColumns({n: F.when(mine, F.lit(v)).cast(k) for n, k, v in zip(names, kinds, values[0])})
    listed = rows.sparkSession.createDataFrame(values, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return rows.join(F.broadcast(listed), quoted(box) == quoted(names[0]), "left")


class KdTree:
    """Cuts by level: (first shard of the box, its shards, dimension, threshold)."""

    def __init__(self, spark: SparkSession, shards: int, dimensions: list[str]):
        self.spark, self.shards, self.dimensions = spark, shards, dimensions
        self.levels: list[list[tuple[int, int, int, int]]] = []

    def place(self, rows: DataFrame, keys: str, box: str) -> DataFrame:
        """``rows`` with the shard (or, while the tree grows, the box) of each row in column ``box``.

        The cuts of a level are fewer than the shards; that bounds what is broadcast.
        """
        placed = rows.withColumn(box, F.lit(0))
        for cuts in self.levels:
            names = [fresh(placed.columns, f"cut_{x}") for x in ("box", "shards", "dim", "at")]
            placed = _beside(placed, box, names, ("int", "int", "int", SIZE), cuts)
            shards, dim, threshold = map(quoted, names[1:])
            upper = F.coalesce(F.get(quoted(keys), dim) >= threshold, F.lit(False))
            moved = F.when(upper, quoted(box) + F.floor(shards / 2).cast("int")).otherwise(quoted(box))
            placed = placed.withColumn(box, moved).drop(*names)
        return placed


def grow_tree(rows: DataFrame, shards: int, dimensions: list[str]) -> KdTree:
    """``rows``: ``size`` and ``keys``, kept in a table since every round reads them."""
    tree = KdTree(rows.sparkSession, shards, dimensions)
    open_boxes = {0: shards} if shards > 1 else {}
    while open_boxes:
        placed = tree.place(rows, "keys", "box")
        open_rows = placed.where(F.col("box").isin(list(open_boxes))) if tree.levels else placed
        ends = [f(F.get("keys", i)).alias(f"{n}{i}") for i in range(len(dimensions)) for n, f in (("low", F.min), ("high", F.max))]
        extents = open_rows.groupBy("box").agg(F.sum("size").alias("bytes"), *ends).collect()
        state = {}
        for x in extents:
            dim = max(range(len(dimensions)), key=lambda i: ((x[f"high{i}"] >> 32) - (x[f"low{i}"] >> 32), -i))
            k = open_boxes[x["box"]]
            state[x["box"]] = {"dim": dim, "low": x[f"low{dim}"], "high": x[f"high{dim}"], "before": 0,
                               "target": x["bytes"] * (k // 2) / k, "slack": x["bytes"] / k * TOLERANCE}
        cuts = _search(open_rows, state)
        tree.levels.append([(b, open_boxes[b], state[b]["dim"], cut) for b, cut in cuts.items()])
        halves = {}
        for box in cuts:
            k = open_boxes[box]
            halves[box], halves[box + k // 2] = k // 2, k - k // 2
        open_boxes = {b: k for b, k in halves.items() if k > 1}
    return tree


def _search(rows: DataFrame, state: dict[int, dict]) -> dict[int, int]:
    """The key at which each box is cut, by rounds of histograms."""
    cuts, left = {}, dict(state)
    while left:
        ranges = [(b, s["dim"], s["low"], s["high"], -(-(s["high"] - s["low"] + 1) // BINS), float(s["target"] - s["before"])) for b, s in left.items()]
        beside = _beside(rows, "box", ["b", "dim", "low", "high", "width", "wanted"], ("int", "int", SIZE, SIZE, SIZE, "double"), ranges)
        key = F.get("keys", F.col("dim"))
        binned = (
            beside.where((key >= F.col("low")) & (key <= F.col("high")))
            .groupBy("b", "wanted", F.floor((key - F.col("low")) / F.col("width")).alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.min(key).alias("first"), F.max(key).alias("last"))
        )
        running = Window.partitionBy("b").orderBy("bin")
        summed = binned.withColumn("through", F.sum("bytes").over(running))
        crossing = summed.where((F.col("through") >= F.col("wanted")) & (F.col("through") - F.col("bytes") < F.col("wanted")))
        for x in crossing.select("b", "bytes", "first", "last", "through").collect():
            s = left[x["b"]]
            over, under = x["through"] - (s["target"] - s["before"]), (s["target"] - s["before"]) - (x["through"] - x["bytes"])
            if min(over, under) <= s["slack"] or x["first"] == x["last"]:
                # Cut behind or before the bin, whichever is nearer.
                cuts[x["b"]] = x["last"] + 1 if over <= under else x["first"]
                del left[x["b"]]
            else:
                s["before"] += x["through"] - x["bytes"]
                s["low"], s["high"] = x["first"], x["last"]
    return cuts


def shard_tree(
    docs: DataFrame, shards: int | None = 24, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None,
    keep: Workspace | None = None,
) -> tuple[KdTree, Column, DataFrame]:
    """The tree for ``docs``, the order keys it reads as an expression, and the kept metadata of all rows."""
    dimensions = default_dimensions(docs) if dimensions is None else dimensions
    taken = [F.coalesce(quoted(c).cast("string"), F.lit("\0")) for c in ("doc_id", "text") if c in docs.columns]
    keys = _keys(dimensions, F.xxhash64(*taken).bitwiseAND(F.lit((1 << 32) - 1)))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    keep = keep or Workspace(docs.sparkSession, "kd")
    rows = keep.keep(docs.select("doc_id", row_size(F.col("text")).alias("size"), crc.alias("text_crc32"), keys.alias("keys")), "metadata")
    if target_bytes is not None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    return grow_tree(rows, shards, list(dimensions)), keys, rows


def kd_shards(docs: DataFrame, shards: int | None = 24, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Shards differ by single rows and ``TOLERANCE`` at each cut. A null text weighs eight bytes, null
    categories share a place, rows equal in every column share a shard, an empty table gives no rows.
    Other columns are ignored. Slots count a shard's rows by doc_id, checksum and size.
    """
    keep = Workspace(docs.sparkSession, "kd")
    tree, _, rows = shard_tree(docs, shards, target_bytes, dimensions, keep)
    return with_slots(tree.place(rows, "keys", "shard").drop("keys"), keep)


def with_slots(placed: DataFrame, keep: Workspace) -> DataFrame:
    """``placed`` (doc_id, size, text_crc32, shard) with ``slot``: rows are sorted by range, so that no
    task's rows grow with a shard, and numbered from what the ranges before hold of their shard."""
    order = [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    # The number of ranges is the session's; ids count up within a range and hold its number above 33 bits.
    ranged = placed.repartitionByRange(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    numbered = keep.keep(ranged.withColumn("at", at).withColumn("range", F.shiftright("at", 33)), "slots")
    counts = numbered.groupBy("shard", "range").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row per shard and range: at most shards + ranges - 1 rows.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select(F.col("shard").alias("of_shard"), F.col("range").alias("of_range"), (before - F.col("first")).alias("base"))
    joined = numbered.join(F.broadcast(bases), (F.col("shard") == F.col("of_shard")) & (F.col("range") == F.col("of_range")))
    return joined.select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("base")).cast("long").alias("slot"))


def with_shard(docs: DataFrame, shards: int | None = 24, target_bytes: int | None = None) -> DataFrame:
    """``docs`` with its columns and a column ``shard``; texts are not shuffled."""
    tree, keys, _ = shard_tree(docs, shards, target_bytes)
    key, name = fresh(docs.columns, "order_keys"), fresh(docs.columns, "shard")
    return tree.place(docs.withColumn(key, keys), key, name).drop(key)


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return kd_shards(table(spark, folder, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
