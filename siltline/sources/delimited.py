"""Delimited text with quoted, possibly multi-line fields, read in splits.

Spark's text source cuts files into splits at line ends. A split may begin inside a quoted field,
which only the text before it can tell. Two passes settle that without reading any file in one task:

1. ``split_index``: each split reports, for both possible beginnings (at a record start, inside a
   quoted field), how it ends and how many records it closes, plus its line count and whether its
   bytes are valid UTF-8 or Windows-1252. Chaining those few numbers per split with windows gives
   every split its true beginning, its first line number, its first record number and the encoding
   of the whole file.
2. ``read_records``: each split is parsed from its true beginning. Records that cross a split
   boundary arrive as pieces and are joined by record number.

Both passes must see the same splits: the index is written to the checkpoint folder, and a split
without an index row, or with a different line count, stops the job.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from siltline.session import cut_lineage

# Up to this many splits (24 TiB at 128 MiB each) the index is sent to every executor, about
# 100 bytes a row; a larger index is joined by a shuffle.
BROADCAST_SPLITS = 200_000
_END = "\x00end of split\x00"
BOM = b"\xef\xbb\xbf"

INDEX_SCHEMA = (
    "source_file string, split_start bigint, line_count bigint, ends_open boolean, "
    "ends_open_if_open boolean, closed bigint, closed_if_open bigint, utf8 boolean, cp1252 boolean, bom boolean"
)
RECORD_SCHEMA = (
    "source_file string, split_start bigint, record_no bigint, line_no bigint, "
    "fields array<string>, raw_text string, is_piece boolean"
)
INDEX_NAMES = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
RECORD_NAMES = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
RECORD_COLUMNS = ["source_file", "record_no", "line_no", "fields", "raw_text"]
RECORD_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.bool_()]


def fix_splits(spark: SparkSession) -> None:
    """Cut files at multiples of ``spark.sql.files.maxPartitionBytes`` whatever the cluster's size is now.

    By default the cut also depends on the number of cores and on the total size of the files read.
    """
    spark.conf.set("spark.sql.files.minPartitionNum", "1")


def plain_path(path: Column) -> Column:
    """Local paths without their scheme; others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Undecoded lines with the file and split they come from, in file order within a task."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        plain_path(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))).alias("source_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("value").cast("binary").alias("line"),
    )


def split_index(lines: DataFrame, delimiter: str) -> DataFrame:
    """One row per split: where it begins, and how its file is encoded. Written once."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), chunk in _by_split(batches):
            yield _index_row(file, start, chunk, delimiter)

    measured = lines.mapInArrow(measure, INDEX_SCHEMA)
    before = Window.partitionBy("source_file").orderBy("split_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_file = Window.partitionBy("source_file")
    forgetful = F.col("ends_open") == F.col("ends_open_if_open")
    flips = F.when(~forgetful & F.col("ends_open"), 1).otherwise(0)
    # A split either fixes how it ends, keeps the beginning, or flips it. What counts is the last
    # fixed ending and the number of flips after it.
    opened = (
        measured.withColumn("flip_sum", F.sum(flips).over(upto))
        .withColumn(
            "anchor",
            F.last(F.when(forgetful, F.struct("ends_open", "flip_sum")), ignorenulls=True).over(before),
        )
        .withColumn("flips_before", F.coalesce(F.sum(flips).over(before), F.lit(0)))
        .withColumn(
            "starts_open",
            F.coalesce(F.col("anchor.ends_open").cast("int"), F.lit(0))
            != F.pmod(F.col("flips_before") - F.coalesce("anchor.flip_sum", F.lit(0)), F.lit(2)),
        )
    )
    closed = F.when(F.col("starts_open"), F.col("closed_if_open")).otherwise(F.col("closed"))
    placed = (
        opened.withColumn("first_line", F.coalesce(F.sum("line_count").over(before), F.lit(0)))
        .withColumn("ends_open", F.when(F.col("starts_open"), F.col("ends_open_if_open")).otherwise(F.col("ends_open")))
        .withColumn("first_record", F.coalesce(F.sum(closed).over(before), F.lit(0)))
        .withColumn(
            "encoding",
            F.when(F.min("utf8").over(per_file) & F.max("bom").over(per_file), F.lit("utf-8-sig"))
            .when(F.min("utf8").over(per_file), F.lit("utf-8"))
            .when(F.min("cp1252").over(per_file), F.lit("cp1252"))
            .otherwise(F.lit("latin-1")),
        )
        .select(
            "source_file", "split_start", "line_count", "starts_open", "ends_open", "first_line", "first_record",
            "encoding",
        )
    )
    return cut_lineage(placed)


def read_records(
    spark: SparkSession,
    paths: Sequence[str],
    delimiter: str = ",",
    index: DataFrame | None = None,
    broadcast_splits: int = BROADCAST_SPLITS,
) -> DataFrame:
    """All records of the files: ``source_file, record_no, line_no, fields, raw_text``.

    ``record_no`` counts records from 1 per file, blank ones included; ``line_no`` is the last
    line of the record; ``raw_text`` is the record written out again.
    """
    fix_splits(spark)
    lines = raw_lines(spark, paths)
    index = split_index(lines, delimiter) if index is None else index
    keys = ["source_file", "split_start"]
    facts = ["line_count", "starts_open", "first_line", "first_record", "encoding"]
    if index.count() <= broadcast_splits:
        placed = lines.join(F.broadcast(index), keys, "left")
    else:
        placed = (
            lines.withColumn("position", F.monotonically_increasing_id())
            .join(index.hint("merge"), keys, "left")
            .repartition(*keys)
            .sortWithinPartitions(*keys, "position")
        )
    whole = _parsed(placed.select(*keys, "line", *facts), delimiter).where("not is_piece").select(*RECORD_COLUMNS)
    cut = _cut_records(spark, paths, index, delimiter, broadcast_splits)
    return whole if cut is None else whole.unionByName(cut)


def _parsed(placed: DataFrame, delimiter: str) -> DataFrame:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), chunk in _by_split(batches):
            yield from _parse_split(file, start, chunk, delimiter)

    return placed.mapInArrow(parse, RECORD_SCHEMA)


def _cut_records(
    spark: SparkSession, paths: Sequence[str], index: DataFrame, delimiter: str, broadcast_splits: int
) -> DataFrame | None:
    """Records that cross a split boundary, put together from their pieces.

    Only splits on either side of such a boundary are parsed again, and only their files are read.
    """
    ordered = Window.partitionBy("source_file").orderBy("split_start")
    touched = (
        index.withColumn("goes_on", F.lead("starts_open").over(ordered))
        .withColumn("is_last", F.col("goes_on").isNull())
        .where(F.col("starts_open") | F.col("goes_on") | (F.col("is_last") & F.col("ends_open")))
        .drop("goes_on", "is_last", "ends_open")
    )
    # Paths of files given by the caller, so no more than the caller holds.
    touched_files = [row[0] for row in touched.select("source_file").distinct().collect()]
    if not touched_files:
        return None
    again = raw_lines(spark, touched_files)
    keys = ["source_file", "split_start"]
    if index.count() <= broadcast_splits:
        placed = again.join(F.broadcast(touched), keys)
    else:
        placed = (
            again.withColumn("position", F.monotonically_increasing_id())
            .join(touched.hint("merge"), keys)
            .repartition(*keys)
            .sortWithinPartitions(*keys, "position")
            .drop("position")
        )
    pieces = (
        _parsed(placed, delimiter)
        .where("is_piece")
        .groupBy("source_file", "record_no")
        .agg(
            F.max("line_no").alias("line_no"),
            F.array_sort(F.collect_list(F.struct("split_start", "raw_text"))).alias("pieces"),
        )
        .withColumn("raw_text", F.array_join(F.transform("pieces", lambda piece: piece["raw_text"]), ""))
    )

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, record_no, line_no, raw in zip(*(column.to_pylist() for column in batch.columns)):
                fields = next(_reader(io.StringIO(raw, newline=""), delimiter), [])
                rows.append((file, record_no, line_no, fields, _written(fields, delimiter)))
            if rows:
                yield _batch(rows, [RECORD_TYPES[RECORD_NAMES.index(name)] for name in RECORD_COLUMNS], RECORD_COLUMNS)

    return pieces.select("source_file", "record_no", "line_no", "raw_text").mapInArrow(
        join_up, "source_file string, record_no bigint, line_no bigint, fields array<string>, raw_text string"
    )


# --- per-split helpers, run in tasks -------------------------------------------------------


def _by_split(batches: Iterator[pa.RecordBatch]):
    """Group consecutive rows by split, without holding more than one batch."""
    state: dict = {"batch": None, "at": 0}

    def key_at():
        batch, at = state["batch"], state["at"]
        return batch.column("source_file")[at].as_py(), batch.column("split_start")[at].as_py()

    def advance() -> bool:
        while state["batch"] is None or state["at"] >= state["batch"].num_rows:
            state["batch"], state["at"] = next(batches, None), 0
            if state["batch"] is None:
                return False
        return True

    def slices(key):
        while advance() and key_at() == key:
            batch, at = state["batch"], state["at"]
            last = batch.num_rows - 1
            if (batch.column("source_file")[last].as_py(), batch.column("split_start")[last].as_py()) == key:
                end = batch.num_rows
            else:
                end = at
                while key_at() == key:
                    end += 1
                    state["at"] = end
            state["at"] = end
            yield batch.slice(at, end - at)

    while advance():
        key = key_at()
        chunk = slices(key)
        yield key, chunk
        for _ in chunk:
            pass


def _physical(raw: bytes, encoding: str) -> Iterator[str]:
    """A stored line as the lines a file iterator would give: a lone CR ends a line too."""
    text = raw.decode(encoding) + "\n"
    if "\r" not in text:
        yield text
        return
    for part in re.split(r"(?<=\r)(?!\n)", text):
        if part:
            yield part


def _reader(lines, delimiter: str):
    csv.field_size_limit(2**31 - 1)
    return csv.reader(lines, delimiter=delimiter)


def _written(fields: Sequence[str], delimiter: str) -> str:
    out = io.StringIO()
    csv.writer(out, delimiter=delimiter, lineterminator="").writerow(fields)
    return out.getvalue()


def _batch(rows, types, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=kind) for column, kind in zip(zip(*rows), types)], names=names
    )


class _Walk:
    """Reads records from lines, keeping the lines of the record being read."""

    def __init__(self, lines: Iterator[str], delimiter: str, opened: bool):
        self.lines, self.opened = lines, opened
        self.taken: list[str] = []
        self.count = 0
        self.finished = False
        self.reader = _reader(self._feed(), delimiter)

    def _feed(self) -> Iterator[str]:
        first = self.opened
        for line in self.lines:
            self.count += 1
            self.taken.append(line)
            yield '"' + line if first else line
            first = False
        self.finished = True
        yield ('"' if first else "") + _END + "\n"

    def records(self):
        """(fields, lines, is complete) until the end of the split."""
        for fields in self.reader:
            lines, self.taken = self.taken, []
            if self.finished:
                if fields != [_END]:
                    yield fields, lines, False
                return
            yield fields, lines, True


def _index_row(file: str, start: int, chunk: Iterator[pa.RecordBatch], delimiter: str) -> pa.RecordBatch:
    utf8 = cp1252 = True
    bom = False
    counted = 0
    walks = [_Lockstep(delimiter, opened) for opened in (False, True)]
    for piece in chunk:
        seen = piece.column("line").to_pylist()
        if start == 0 and counted == 0 and seen[0].startswith(BOM):
            bom = True
            seen[0] = seen[0][len(BOM):]
        whole = b"\n".join(seen)
        if not whole.isascii():
            utf8 = utf8 and _decodes(whole, "utf-8")
            cp1252 = cp1252 and _decodes(whole, "cp1252")
        lines = [part for raw in seen for part in _physical(raw, "latin-1")]
        counted += len(lines)
        for walk in walks:
            walk.feed(lines, quoted=b'"' in whole)
    row = (
        file, start, counted, walks[0].open, walks[1].open, walks[0].closed, walks[1].closed, utf8, cp1252, bom,
    )
    return _batch([row], INDEX_TYPES, INDEX_NAMES)


class _Lockstep:
    """Counts closed records over batches of lines, remembering only whether a field is open."""

    def __init__(self, delimiter: str, opened: bool):
        self.delimiter, self.open, self.closed = delimiter, opened, 0

    def feed(self, lines: list[str], quoted: bool) -> None:
        if not quoted:
            # Without a quote in sight every line is a record, or none is.
            self.closed += 0 if self.open else len(lines)
            return
        ended_open = False
        for _, _, complete in _Walk(iter(lines), self.delimiter, self.open).records():
            self.closed += complete
            ended_open = not complete
        self.open = ended_open


def _decodes(data: bytes, encoding: str) -> bool:
    try:
        data.decode(encoding)
        return True
    except UnicodeDecodeError:
        return False


def _parse_split(file: str, start: int, chunk: Iterator[pa.RecordBatch], delimiter: str) -> Iterator[pa.RecordBatch]:
    facts: dict = {}

    def lines() -> Iterator[str]:
        for piece in chunk:
            opening = not facts
            if opening:
                facts.update(piece.slice(0, 1).to_pylist()[0])
                if facts["first_record"] is None:
                    raise ValueError(f"split {start} of {file} is not in the index; read with fixed split settings")
            seen = piece.column("line").to_pylist()
            if opening and start == 0 and facts["encoding"] == "utf-8-sig":
                seen[0] = seen[0][len(BOM):]
            encoding = facts["encoding"].removesuffix("-sig")
            for raw in seen:
                yield from _physical(raw, encoding)

    source = lines()
    first = next(source)
    walk = _Walk(chain([first], source), delimiter, facts["starts_open"])
    record_no, line_no, at_head = facts["first_record"], facts["first_line"], facts["starts_open"]
    rows = []
    for fields, taken, complete in walk.records():
        record_no += 1
        line_no += len(taken)
        if at_head or not complete:
            rows.append((file, start, record_no, line_no, None, "".join(taken), True))
        else:
            rows.append((file, start, record_no, line_no, fields, _written(fields, delimiter), False))
        at_head = False
        if len(rows) >= 4096:
            yield _batch(rows, RECORD_TYPES, RECORD_NAMES)
            rows = []
    if walk.count != facts["line_count"]:
        raise ValueError(f"split {start} of {file} changed between the two passes")
    if rows:
        yield _batch(rows, RECORD_TYPES, RECORD_NAMES)
