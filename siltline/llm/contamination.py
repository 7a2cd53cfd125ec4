"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: a task turns its texts into segments, each with sorted terms
and, per term, the places where it stands, and the segments are stored as a table. A segment answers
a phrase by taking the places of the phrase's rarest term there, shifted to where the phrase would
begin, and intersecting them with the shifted lists of the other terms from rare to frequent. With
``slop`` each term may stand that many words from its own offset (proximity instead of exact match).

Phrases are stored in blocks of bounded size that tasks read one after the other; terms are 64-bit
hashes of words, and only terms that some item may hold (a bitmap of fixed size) are posted.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, table
from siltline.llm.neardup import word_hashes
from siltline.llm.tokens import _file_uri, _place, write_whole

WINDOW = 13
SLOTS = 1 << 22  # bits of the map of posted terms
BLOCK_BYTES = 1 << 20  # text of the items in one block of phrases
SEGMENT_WORDS = 1_500_000
PART_BYTES = 2 << 20  # text of the rows that are searched together where no index is stored
CANDIDATES = 2_000_000  # places looked at together; more are taken in turns

# Words: ASCII letters in lower case, digits, and everything beyond ASCII.
FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Terms:
    """Hashes of words, from the memory that the operators of a worker share; 0 for words that ``posted`` rules out."""

    def __init__(self, posted: np.ndarray | None = None):
        self.posted = posted

    def of(self, words: list[bytes]) -> np.ndarray:
        hashes = np.maximum(word_hashes().of(words), np.uint64(1))
        if self.posted is not None:
            slots = hashes & np.uint64(SLOTS - 1)
            hashes[self.posted[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1 == 0] = 0
        return hashes


class Segment:
    """Places of each term in some documents laid one behind the other, ``gap`` words apart."""

    def __init__(self, terms: np.ndarray, starts: np.ndarray, places: np.ndarray):
        self.terms, self.starts, self.places = terms, starts.astype(np.int64), places
        self.keys = (np.repeat(np.arange(len(terms), dtype=np.uint64), np.diff(self.starts)) << np.uint64(32)) | places

    @staticmethod
    def build(texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths + gap)])[:-1]
        hashes = np.concatenate(texts) if texts else np.empty(0, np.uint64)
        places = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(hashes))
        posted = hashes != 0
        hashes, places = hashes[posted], places[posted].astype(np.uint32)
        order = np.argsort(hashes, kind="stable")
        terms, counts = np.unique(hashes[order], return_counts=True)
        return terms, np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32), places[order]

    def find(self, phrases: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first places, rows of ``phrases``) of all matches; ``phrases`` has a term hash per column."""
        nothing = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(self.terms) or not len(phrases):
            return nothing
        at = np.minimum(np.searchsorted(self.terms, phrases), len(self.terms) - 1)
        rows = np.flatnonzero((self.terms[at] == phrases).all(axis=1))
        if not len(rows):
            return nothing
        at = at[rows]
        frequency = self.starts[at + 1] - self.starts[at]
        order = np.argsort(frequency, axis=1, kind="stable")
        rarest = at[np.arange(len(at)), order[:, 0]]
        counts = self.starts[rarest + 1] - self.starts[rarest]
        turns = np.cumsum(counts) // CANDIDATES
        found = [self._intersect(np.flatnonzero(turns == t), at, order, rarest, counts, slop) for t in np.unique(turns)]
        return np.concatenate([f[0] for f in found]), rows[np.concatenate([f[1] for f in found])]

    def _intersect(self, some, at, order, rarest, counts, slop):
        n = counts[some]
        which = np.repeat(some, n)
        listed = np.arange(n.sum()) + np.repeat(self.starts[rarest[some]] - (np.cumsum(n) - n), n)
        begin = self.places[listed].astype(np.int64) - order[which, 0]
        for j in range(1, order.shape[1]):
            if not len(which):
                break
            offset = order[which, j]
            term = at[which, offset].astype(np.int64) << 32
            low = np.maximum(begin + offset - slop, 0) + term
            next_place = np.minimum(np.searchsorted(self.keys, low.astype(np.uint64)), len(self.keys) - 1)
            key = self.keys[next_place].astype(np.int64)
            meets = (key >= low) & (key <= term + begin + offset + slop)
            which, begin = which[meets], begin[meets]
        return begin, which


def _windows(terms: np.ndarray, size: int) -> np.ndarray:
    """All windows of ``size`` words; the whole as one if there are fewer words."""
    if not len(terms):
        return np.empty((0, size), np.uint64)
    return np.lib.stride_tricks.sliding_window_view(terms, min(size, len(terms)))


def _pack(ids: list[str], texts: list[bytes | None], size: int) -> tuple[bytes, bytes]:
    """A block of phrases, and the bitmap of its terms."""
    terms, by_length = Terms(), {}
    posted = np.zeros(SLOTS >> 3, np.uint8)
    for i, text in enumerate(texts):
        hashes = terms.of(words_of(text))
        slots = hashes & np.uint64(SLOTS - 1)
        np.bitwise_or.at(posted, (slots >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8))
        for window in _windows(hashes, size):
            by_length.setdefault(len(window), {}).setdefault(window.tobytes(), set()).add(i)
    arrays = {"ids": np.frombuffer("\0".join(ids).encode(), np.uint8), "n": np.array([len(ids)])}
    for length, phrases in by_length.items():
        arrays[f"phrases{length}"] = np.frombuffer(b"".join(phrases), np.uint64).reshape(-1, length)
        arrays[f"ends{length}"] = np.cumsum([len(x) for x in phrases.values()])
        arrays[f"items{length}"] = np.array([i for x in phrases.values() for i in sorted(x)])
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue(), posted.tobytes()


@functools.lru_cache(maxsize=2)
def _block(folder: str, name: str) -> dict:
    store, root = _place(folder)
    with store.open_input_file(f"{root}/{name}") as source:
        held = dict(np.load(io.BytesIO(source.read())))
    held["ids"] = held["ids"].tobytes().decode().split("\0")
    return held


class Phrases:
    """The items' windows, stored in blocks in a folder that all executors share."""

    def __init__(self, items: DataFrame, folder: str, size: int = WINDOW, id_column: str = "item_id"):
        self.folder, self.size = _file_uri(folder), size
        spark = items.sparkSession
        texts = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text"))
        n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = n_bytes // BLOCK_BYTES + 1
        target = self.folder

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, bodies = [], []
            for batch in batches:
                ids += batch.column(0).to_pylist()
                bodies += batch.column(1).to_pylist()
            if ids:
                name = f"block-{TaskContext.get().partitionId()}.npz"
                packed, posted = _pack(ids, bodies, size)
                write_whole(target, name, [packed])
                yield pa.RecordBatch.from_pydict({"name": [name], "posted": [posted]})

        self.names, posted = [], np.zeros(SLOTS >> 3, np.uint8)
        parts = texts.repartition(blocks, F.xxhash64("id", "text")).mapInArrow(write, "name string, posted binary")
        for row in parts.toLocalIterator():  # one bitmap of fixed size at a time
            self.names.append(row["name"])
            posted |= np.frombuffer(row["posted"], np.uint8)
        self.posted = spark.sparkContext.broadcast(posted.tobytes())

    def blocks(self) -> Iterator[dict]:
        return (_block(self.folder, name) for name in self.names)


def build_index(docs: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """A row per segment: its documents' ids and lengths, and its terms with their places."""
    shared, gap = phrases.posted, phrases.size + 2 * slop + 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(np.frombuffer(shared.value, np.uint8))
        held, ids, known, size = [], [], [], 0

        def segment() -> pa.RecordBatch:
            found = Segment.build(held, gap)
            values = np.array(ids, np.int64), np.array(known, np.bool_), np.array([len(t) for t in held], np.uint32), *found
            return pa.RecordBatch.from_pydict({name: [v.tobytes()] for name, v in zip(FIELDS, values)})

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = terms.of(words_of(text.as_py()))
                held.append(hashes)
                ids.append(i or 0)
                known.append(i is not None)
                size += len(hashes)
                if size >= SEGMENT_WORDS:
                    yield segment()
                    held, ids, known, size = [], [], [], 0
        if held:
            yield segment()

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(build, ", ".join(f"{f} binary" for f in FIELDS))


FIELDS = ("ids", "known", "n_words", "terms", "starts", "places")


def _hits(segment: Segment, n_words: np.ndarray, phrases: Phrases, slop: int) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Words hit per document, and the items met in each document with any."""
    gap = phrases.size + 2 * slop + 1
    begins = np.concatenate([[0], np.cumsum(n_words + gap)])
    edges = np.zeros(begins[-1] + 2, np.int32)
    items: dict[int, set[str]] = {}
    for block in phrases.blocks():
        for name in [k for k in block if k.startswith("phrases")]:
            length = name.removeprefix("phrases")
            first, row = segment.find(block[name], slop)
            if not len(first):
                continue
            first = np.maximum(first, 0)
            np.add.at(edges, first, 1)
            np.add.at(edges, first + int(length), -1)
            ends = block[f"ends{length}"]
            doc = np.searchsorted(begins, first, side="right") - 1
            for d, r in np.unique(np.stack([doc, row], axis=1), axis=0):
                listed = block[f"items{length}"][ends[r - 1] if r else 0:ends[r]]
                items.setdefault(int(d), set()).update(block["ids"][i] for i in listed)
    covered = np.cumsum(edges)[:-1] > 0
    sums = np.concatenate([[0], np.cumsum(covered)])
    return sums[begins[:-1] + n_words] - sums[begins[:-1]], items


def search(index: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """Per indexed document: doc_id, n_words, n_hit and the sorted ids of the items that occur in it."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {f: batch.column(f)[i].as_buffer() for f in FIELDS}
                ids, known = np.frombuffer(raw["ids"], np.int64), np.frombuffer(raw["known"], np.bool_)
                n_words = np.frombuffer(raw["n_words"], np.uint32).astype(np.int64)
                segment = Segment(*(np.frombuffer(raw[f], t) for f, t in (("terms", np.uint64), ("starts", np.uint32), ("places", np.uint32))))
                n_hit, items = _hits(segment, n_words, phrases, slop)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, mask=~known), "n_words": pa.array(n_words), "n_hit": pa.array(n_hit),
                    "items": pa.array([sorted(items.get(d, ())) for d in range(len(ids))], pa.list_(pa.string())),
                })

    return index.mapInArrow(look, "doc_id long, n_words long, n_hit long, items array<string>")


CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"


def contamination(docs: DataFrame, items: DataFrame, slop: int = 0) -> DataFrame:
    """``search`` over a stored index of ``docs``.

    Null and empty texts have no words and no hits; every row of equal rows is reported; items without
    words match nothing, a null item id reads as ''; empty tables give no rows or no hits. Of extra
    columns none is read.
    """
    place = Workspace(docs.sparkSession, "contamination")
    phrases = Phrases(items, place.path("phrases"))
    index = place.keep(build_index(docs, phrases, slop), "index")
    return search(index, phrases, slop)


def parts_of(batch: pa.RecordBatch, at: int, n_bytes: int) -> Iterator[pa.RecordBatch]:
    """All rows of a batch, in order, in parts of whole rows with about ``n_bytes`` in column ``at``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // n_bytes)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(low), int(high - low))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text is not contaminated.

    Each task indexes its own rows and searches that segment, so rows need no join to their verdict.
    """
    phrases = Phrases(items, Workspace(docs.sparkSession, "contamination").path("phrases"))
    shared, gap = phrases.posted, phrases.size + 1
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(np.frombuffer(shared.value, np.uint8))
        for batch in batches:
            for part in parts_of(batch, at, PART_BYTES):
                texts = [terms.of(words_of(t.as_buffer().to_pybytes() if t.is_valid else None)) for t in part.column(at)]
                n_words = np.array([len(t) for t in texts], np.int64)
                n_hit, _ = _hits(Segment(*Segment.build(texts, gap)), n_words, phrases, 0)
                yield part.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= n_words))))

    return docs.mapInArrow(keep, docs.schema)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words, hit words and items by the 13-word rule."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), F.expr(CONTAMINATED).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS words FROM benchmark),
p AS (SELECT DISTINCT item, least(13, len(words)) AS n, array_to_string(words[q:q + least(13, len(words)) - 1], ' ') AS phrase
      FROM i, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS t(q) WHERE len(words) > 0),
g AS (SELECT r, q, n, array_to_string(words[q:q + n - 1], ' ') AS phrase
      FROM d, (SELECT DISTINCT n FROM p), unnest(range(1, len(words) - n + 2)) AS t(q)),
m AS (SELECT r, q, g.n AS n, item FROM g JOIN p ON g.n = p.n AND g.phrase = p.phrase),
h AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(q, q + n)) AS w FROM (SELECT DISTINCT r, q, n FROM m)) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)
"""
