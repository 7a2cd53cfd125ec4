"""Folders of exports: listing, per-file settings and headers."""

from __future__ import annotations

import codecs
import csv
import io
import os
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline import fixed
from siltline.sources.delimited import BOM, _by_split, _physical, _reader, plain_path, raw_lines

SETTINGS_SCHEMA = (
    "source_file string, encoding string, encoding_mode string, delimiter string, delimiter_mode string, "
    "has_header boolean, quotechar string, doublequote boolean, skipinitialspace boolean, header array<string>"
)


def list_files(
    spark: SparkSession, folder: str, extensions: Sequence[str] = (".csv",), recursive: bool = False
) -> DataFrame:
    """``source_file, file_name, size_bytes, last_modified`` of matching files; contents are not read.

    A scan leaves empty files out, so names come from the listing and sizes from the scan.
    """
    endings = [e.lower() if e.startswith(".") else f".{e.lower()}" for e in extensions]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    listed = spark.createDataFrame([(unquote(path),) for path in found.inputFiles()], "path string")
    sized = found.select(
        plain_path(F.col("path")).alias("source_file"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
    )
    return (
        listed.select(plain_path(F.col("path")).alias("source_file"))
        .join(sized, "source_file", "left")
        .na.fill(0, ["size_bytes"])
        .withColumn("file_name", F.regexp_extract("source_file", r"([^/]*)\z", 1))
        .where(F.lower(F.regexp_extract("file_name", r".(\.[^.]*)\z", 1)).isin(endings))
    )


def resolve_paths(profile: dict) -> list[str]:
    """The configured input paths in order."""
    if "source_files" in profile:
        return sorted(profile["source_files"])
    if "source_file" in profile:
        return [profile["source_file"]]
    raise ValueError("source_file or source_files is required")


def source_label(paths: Sequence[str]) -> tuple[str, str]:
    """(label, common folder) of a load; several files share one label."""
    folders = [path.rsplit("/", 1)[0] if "/" in path else "" for path in paths]
    common = os.path.commonpath(folders) if len(set(folders)) > 1 else folders[0]
    return (paths[0] if len(paths) == 1 else f"MULTI_FILE::{len(paths)} files::{common}"), common


def read_header(
    spark: SparkSession, path: str, delimiter: str = ",", row_number: int = 1
) -> list[str]:
    """Record ``row_number`` of one file; only its first lines are fetched."""
    if row_number < 1:
        raise ValueError("header_row_number must be at least 1")
    take = 4 * row_number + 60
    while True:
        head = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary")).limit(take).collect()
        raw = [bytes(row[0]) for row in head]
        text = _head_text(b"\n".join(raw) + b"\n")[0]
        records = _reader(io.StringIO(text, newline=""), delimiter)
        found = None
        for number, record in enumerate(records, start=1):
            if number == row_number:
                found = record
                break
        exhausted = len(head) < take
        # A record that ends with the fetched text may go on in the next lines.
        if found is not None and (exhausted or records.line_num < len(head)):
            return found
        if exhausted:
            raise ValueError(f"{path} has no record {row_number}")
        take *= 8


def file_settings(
    spark: SparkSession, paths: Sequence[str] | DataFrame, delimiter: str | None = None, sample_bytes: int = fixed.SAMPLE_BYTES
) -> DataFrame:
    """Encoding, delimiter, dialect and first record of every non-empty file.

    ``paths`` are files or folders, or a frame with ``source_file``, which then never passes the driver.
    The sample bounds what encoding and dialect are guessed from; the header is a whole record. Tasks
    read each file from its beginning, as far as the sample and the header go (``read_settings``). Stores
    that only Spark's readers can open are scanned instead.
    """
    if isinstance(paths, DataFrame):
        listed, probe = paths.select("source_file"), paths.select("source_file").limit(1).collect()
        if not probe:
            return spark.createDataFrame([], SETTINGS_SCHEMA)
        first = [row[0] for row in probe]
    else:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        root = "" if default.startswith("file:") else default.rstrip("/")
        first = [path if ":/" in path or not path.startswith("/") else root + path for path in paths]
        listed = spark.createDataFrame([(path,) for path in first], "source_file string")
    if not all(_opens(path) for path in first):
        return _scanned_settings(spark, [row[0] for row in listed.collect()] if isinstance(paths, DataFrame) else paths, delimiter, sample_bytes)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for name, store, place in _files_at(path):
                    with store.open_input_stream(place) as source:
                        found = read_settings(source, name, delimiter, sample_bytes)
                    if found is not None:
                        yield found

    tasks = 4 * spark.sparkContext.defaultParallelism
    return listed.repartition(tasks, "source_file").mapInArrow(describe, SETTINGS_SCHEMA)


def _store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), os.path.abspath(path))


def _opens(path: str) -> bool:
    """Whether tasks can open the store of ``path`` by themselves."""
    try:
        _store(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _files_at(path: str) -> Iterator[tuple[str, arrow_fs.FileSystem, str]]:
    """(source_file, store, place) of a file, or of the files of a folder that Spark would read."""
    store, place = _store(path)
    shown = place if isinstance(store, arrow_fs.LocalFileSystem) else path.rstrip("/")
    info = store.get_file_info(place)
    if info.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == arrow_fs.FileType.File:
        yield shown, store, place
        return
    for found in store.get_file_info(arrow_fs.FileSelector(place)):
        if found.type == arrow_fs.FileType.File and not found.base_name.startswith(("_", ".")):
            yield f"{shown.rstrip('/')}/{found.base_name}", store, found.path


def read_settings(source, file: str, delimiter: str | None, sample_bytes: int) -> pa.RecordBatch | None:
    """The settings row of a file from its first bytes, None if it is empty.

    Lines are taken until the sample is full, then twice as much until a line follows the header record;
    of a file of any size not much more than the sample, or twice the header, is read.
    """
    data, wanted, ended = bytearray(), sample_bytes, False
    while True:
        end = data.find(b"\n", wanted - 1)
        while end < 0 and not ended:
            more = source.read(max(wanted - len(data), sample_bytes))
            seen = max(wanted - 1, len(data))
            data += more
            ended, end = not more, data.find(b"\n", seen)
        if not data:
            return None
        head = bytes(data[:end + 1]) if end >= 0 else bytes(data).removesuffix(b"\n") + b"\n"
        row, complete = _settings_row(file, head, delimiter, sample_bytes)
        if complete or end < 0:
            return row
        wanted *= 2


def _scanned_settings(spark: SparkSession, paths: Sequence[str], delimiter: str | None, sample_bytes: int) -> DataFrame:
    """The same from a scan; only lines of first splits leave it."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, _), chunk in _by_split(batches):
            lines: list[bytes] = []
            size, wanted, found = 0, sample_bytes, None
            for raw in (line for piece in chunk for line in piece.column("line").to_pylist()):
                lines.append(raw)
                size += len(raw) + 1
                found = None
                if size >= wanted:
                    found, complete = _settings_row(file, b"\n".join(lines) + b"\n", delimiter, sample_bytes)
                    if complete:
                        break
                    wanted *= 2
            yield found or _settings_row(file, b"\n".join(lines) + b"\n", delimiter, sample_bytes)[0]

    return raw_lines(spark, paths).where("split_start = 0").mapInArrow(describe, SETTINGS_SCHEMA)


def _head_text(sample: bytes) -> tuple[str, str, str]:
    """(text, encoding, how it was chosen) of the first bytes; a character cut at the end is no error."""
    for encoding, mode in (
        ("utf-8-sig", "bom" if sample.startswith(BOM) else "strict_utf8"),
        ("cp1252", "fallback_candidate"),
    ):
        try:
            return codecs.getincrementaldecoder(encoding)().decode(sample), encoding, mode
        except UnicodeDecodeError:
            continue
    return sample.decode("latin-1"), "latin-1", "fallback_candidate"


def _settings_row(file: str, data: bytes, wanted: str | None, sample_bytes: int) -> tuple[pa.RecordBatch, bool]:
    """The row, and whether more lines follow the header record in ``data``."""
    text, encoding, mode = _head_text(data[:sample_bytes])
    sniffer, dialect, has_header = csv.Sniffer(), None, True
    try:
        dialect = sniffer.sniff(text, delimiters=wanted or "".join(fixed.DELIMITERS)) if text.strip() else None
    except csv.Error:
        pass
    if wanted:
        delimiter, how = wanted, "override"
    elif dialect is not None:
        delimiter, how = dialect.delimiter, "sniffed"
    else:
        first_line = next(io.StringIO(text, newline=""), "")
        delimiter = max(fixed.DELIMITERS, key=first_line.count) if text.strip() else ","
        how = "default"
    try:
        has_header = sniffer.has_header(text) if text.strip() else True
    except csv.Error:
        pass
    stored = data.removeprefix(BOM).removesuffix(b"\n").split(b"\n")
    try:
        lines = [part for raw in stored for part in _physical(raw, encoding.removesuffix("-sig"))]
    except UnicodeDecodeError:  # the sample was valid, what follows it is not
        lines = [part for raw in stored for part in _physical(raw, "latin-1")]
    records = _reader(lines, delimiter)
    header = next(records, [])
    complete = records.line_num < len(lines)
    row = (
        file, encoding, mode, delimiter, how, has_header,
        dialect.quotechar if dialect else '"',
        bool(dialect.doublequote) if dialect else True,
        bool(dialect.skipinitialspace) if dialect else False,
        header,
    )
    kinds = [pa.string()] * 5 + [pa.bool_(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
    names = [part.split()[0] for part in SETTINGS_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([value], type=kind) for value, kind in zip(row, kinds)], names=names), complete
