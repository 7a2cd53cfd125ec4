"""Token ids as flat unsigned integer files with 64-bit document offsets.

A folder holds, for each file number, ``part-N.bin`` (little-endian ids, the narrowest unsigned width
that holds the vocabulary) and ``part-N.idx`` (see ``write_index``). Files are cut by document order;
where a file begins in the whole corpus is the prefix sum over the files before it. Both kinds can be
memory-mapped. A task writes under a name of its own attempt and renames at the end, so a repeated
task replaces its file whole.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, table

MAGIC = b"SILTTOK1"
# White space other than blank and line feed; around it, pieces of a text can't be encoded apart.
OTHER_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
# Pieces begin at white space after a word, or at a comma or stop after letters: byte-level
# pre-tokenization has a boundary at all of these, so pieces encode alone as they do in the text.
PIECE = re.compile(r"[ \n]*[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^ \n,.])|[ \n]*[^ \n]+|[ \n]+")
# Such a piece is one unit of pre-tokenization, so the model can take it without splitting it again.
UNIT = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
CUT = re.compile(r"[A-Za-z](?=[ \n])")
CACHED = 300_000
LONG = 1_000_000


def _byte_char(byte: int) -> str:
    """The printable character that byte-level vocabularies use for a byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(byte) if byte in plain else chr(256 + byte - sum(p < byte for p in plain))


class PieceEncoder:
    """Encodes texts with a tokenizer, each distinct piece once while it stays cached."""

    def __init__(self, tokenizer_json: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = np.dtype(dtype)
        # What is met again moves from the older to the newer half, so frequent pieces stay.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        units = [c for c in map(chr, range(0x20, 0x180)) if UNIT.fullmatch(c) or c == " "]
        self.as_units = str.maketrans({c: "".join(_byte_char(b) for b in c.encode()) for c in units})

    def _learn(self, pieces: set[str]) -> None:
        """Cache ``pieces``, which are not in the newer half."""
        cache, older, tokenize = self.cache, self.older, self.tokenizer.model.tokenize
        for piece in pieces:
            known = older.get(piece)
            if known is None:
                if UNIT.fullmatch(piece):
                    found = [t.id for t in tokenize(piece.translate(self.as_units))]
                else:
                    found = self.tokenizer.encode(piece, add_special_tokens=False).ids
                known = np.array(found, dtype=self.dtype).tobytes()
            cache[piece] = known

    def encode(self, text: str) -> bytes:
        if any(c in text for c in OTHER_SPACES):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        out, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + LONG) if len(text) - at > LONG else None
            end = cut.end() if cut else len(text)
            pieces = PIECE.findall(text, at, end)
            if len(self.cache) > CACHED:
                self.older, self.cache = self.cache, {}
            # Most texts have a new piece; only new ones are looked at one by one.
            self._learn(set(pieces).difference(self.cache))
            out.append(b"".join(map(self.cache.__getitem__, pieces)))
            at = end
        return b"".join(out)


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_json: str, dtype: str) -> PieceEncoder:
    """One encoder per Python worker: the tasks that it runs share what it has learnt."""
    return PieceEncoder(tokenizer_json, dtype)


def _place(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _file_uri(folder: str) -> str:
    """``file:/x`` as ``file:///x``; other addresses as they are."""
    return re.sub(r"^file:/+", "file:///", folder)


def write_whole(folder: str, name: str, chunks: Iterable[bytes]) -> int:
    """Write a file under a name of this attempt, then give it its own name; returns its bytes."""
    store, root = _place(folder)
    store.create_dir(root, recursive=True)
    context = TaskContext.get()
    part = f"{root}/.{name}.{context.taskAttemptId() if context else os.getpid()}"
    size = 0
    with store.open_output_stream(part) as out:
        for chunk in chunks:
            size += out.write(chunk)
    store.move(part, f"{root}/{name}")
    return size


def mapped(folder: str, name: str, dtype: str, offset: int = 0) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is local, else read from the store."""
    store, root = _place(folder)
    path = f"{root}/{name}"
    size = store.get_file_info(path).size - offset
    if size <= 0:
        return np.empty(0, dtype=dtype)
    if isinstance(store, arrow_fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r", offset=offset)
    with store.open_input_file(path) as source:
        source.seek(offset)
        return np.frombuffer(source.read_buffer(size), dtype=dtype)


def write_index(folder: str, name: str, offsets: np.ndarray, ids: np.ndarray, known: np.ndarray, width: int) -> None:
    """Header (magic, width of an id in bytes, number of documents), then the documents' 64-bit
    offsets in the whole corpus with the end as the last, their ids, and which ids are not null."""
    head = MAGIC + np.array([width, len(ids)], dtype="<u8").tobytes()
    write_whole(folder, name, [head, offsets.astype("<u8").tobytes(), ids.astype("<i8").tobytes(), known.astype("<i8").tobytes()])


def read_index(folder: str, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    words = mapped(folder, name, "<u8")
    if words[:1].tobytes() != MAGIC:
        raise ValueError(f"{name} is no token index")
    width, n = int(words[1]), int(words[2])
    ids = words[4 + n:4 + 2 * n].view("<i8")
    return words[3:4 + n], ids, words[4 + 2 * n:4 + 3 * n] != 0, width


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, text_bytes_per_file: int = 32 << 20
) -> DataFrame:
    """Encode every whole text in ascending ``doc_id`` order and write the files to ``folder``.

    Each document ends with ``end_id``; a null or empty text is that id alone. Null ids come first;
    rows of one id stand together, in the order of a hash of their texts; an empty table writes no
    file. Other columns are ignored. Returns the manifest: file number, base (ids in the files
    before it), documents, ids.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as source:
        content = source.read()  # the vocabulary, of a size that does not depend on the corpus
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_str(content).get_vocab_size() <= 1 << 16 else "<u4"
    width = int(dtype[-1])
    folder = _file_uri(folder)
    shared = spark.sparkContext.broadcast(content)
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_files = -(-text_bytes // text_bytes_per_file) or 1

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        encoder = _encoder(shared.value, dtype)
        end = np.array([end_id], dtype=dtype).tobytes()
        lengths, ids, known = [], [], []

        def chunks() -> Iterator[bytes]:
            for batch in itertools.chain([first], batches):
                ids.extend(batch.column(0).fill_null(0).to_pylist())
                known.extend(batch.column(0).is_valid().to_pylist())
                for value in batch.column(1):
                    got = encoder.encode(value.as_py() or "") + end
                    lengths.append(len(got) // width)
                    yield got

        write_whole(folder, f"part-{number:06d}.bin", chunks())
        ends = np.concatenate([[0], np.cumsum(lengths)])
        write_index(folder, f"part-{number:06d}.local", ends, np.array(ids), np.array(known), width)
        yield pa.RecordBatch.from_pydict({"file": [number], "n_docs": [len(ids)], "n_tokens": [int(ends[-1])]})

    tie = F.xxhash64("text")
    ordered = (
        docs.select("doc_id", "text", tie.alias("tie"))
        .repartitionByRange(n_files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    # One row per file comes back; the files' number is what the prefix sum runs over.
    files = sorted(ordered.mapInArrow(encode, "file long, n_docs long, n_tokens long").collect())
    bases = [0, *itertools.accumulate(f.n_tokens for f in files)]
    manifest = [(f.file, base, f.n_docs, f.n_tokens) for f, base in zip(files, bases)]
    schema = "file long, base long, n_docs long, n_tokens long"

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                offsets, ids, known, _ = read_index(folder, f"part-{number:06d}.local")
                write_index(folder, f"part-{number:06d}.idx", offsets + np.uint64(base), ids, known, width)
            yield batch

    listed = spark.createDataFrame(manifest, schema)
    if manifest:
        listed.repartition(min(len(manifest), 2 * spark.sparkContext.defaultParallelism)).mapInArrow(finish, schema).count()
    return listed


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the written files: doc_id, start in the corpus, n_tokens, crc32 of the ids."""
    folder = _file_uri(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                offsets, ids, known, width = read_index(folder, f"part-{number:06d}.idx")
                tokens = mapped(folder, f"part-{number:06d}.bin", f"<u{width}")
                ends = (offsets - np.uint64(base)).astype(np.int64)
                for at in range(0, len(ids), 5000):
                    to = min(at + 5000, len(ids))
                    sums = [zlib.crc32(tokens[a:b].astype("<u4").data) for a, b in zip(ends[at:to], ends[at + 1:to + 1])]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids[at:to], mask=~known[at:to]),
                        "start": pa.array(offsets[at:to].astype(np.int64)),
                        "n_tokens": pa.array(np.diff(ends[at:to + 1])),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    })

    return manifest.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 2, "file").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op1_token_ids(spark: SparkSession, folder: str, tokenizer_path: str | None = None) -> DataFrame:
    """Offsets, lengths and checksums read back from the written token files."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    place = Workspace(spark, "tokens").path("files")
    manifest = write_token_files(table(spark, folder, "documents"), place, tokenizer_path)
    return read_token_files(manifest, place)
