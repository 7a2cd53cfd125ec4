"""Removal of passages that an earlier document holds, with FM-indexes over wavelet trees.

A window is 50 consecutive words. Each window names an anchor: the 12-word gram in it with the least
hash. Equal windows name equal anchors, so what two documents share meets in the shard of its anchors,
and anchors that only one document has are left out. A shard holds the distinct stretches of words
around its anchors; its FM-index (Burrows-Wheeler transform in a wavelet matrix of packed bits) is
searched backward with those stretches, one word at a time for all of them together: the interval of
the current match is extended to the left and, at 50 words, cut back to 49 by the LCP blocks. Where
the match is 50 words long its interval lists all documents with that window, and the smallest decides.

Stretches of an anchor beyond ``MOST`` are dealt to several indexes, and their windows' minima are
brought together by an aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, table
from siltline.llm.neardup import mixed, word_hashes

WINDOW, GRAM = 50, 12
MOST = 2048  # stretches of one anchor in one index
INDEX_WORDS = 400_000
CHUNK = 100_000  # grams whose minima are taken together; places fit 17 bits
LAST = (1 << 63) - 1  # the order of documents without an id: behind all others
FACTOR = 0x9E3779B97F4A7C15
POWERS = tuple(np.uint64(pow(FACTOR, n, 1 << 64)) for n in (1, 2, 4))


class WaveletMatrix:
    """Rank over integers, a packed bit vector per binary digit."""

    def __init__(self, codes: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.n, self.bits, self.before, self.zeros = len(codes), [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (codes >> level & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, bool)
            padded[:len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int32)[:-1]]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            codes = np.concatenate([codes[~bit], codes[bit]])
        self.starts = self._down(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _down(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            below = self.bits[k][word] & ((np.uint64(1) << bit) - np.uint64(1))
            ones = self.before[k][word] + np.bitwise_count(below)
            at = np.where(codes >> (self.levels - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each code stands before its position."""
        return self._down(codes, at) - self.starts[codes]


class FmIndex:
    """FM-index of some stretches of words (arrays of word hashes), each behind a separator of its own."""

    def __init__(self, stretches: list[np.ndarray], depth: int = WINDOW):
        self.depth, m = depth, len(stretches)
        self.lengths = np.array([len(s) for s in stretches], np.int64)
        self.words, found = np.unique(np.concatenate(stretches), return_inverse=True)
        ends = np.cumsum(self.lengths + 1) - 1
        n = int(ends[-1]) + 1
        symbols = np.empty(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        symbols[ends], symbols[inside] = np.arange(m), found + m
        self.first = ends - self.lengths
        order, same = self._suffixes(symbols, m + len(self.words))
        self.codes = np.maximum(symbols - m + 1, 0)  # separators share a code: no search steps over one
        self.tree = WaveletMatrix(self.codes[order - 1], len(self.words) + 1)
        self.less = m + np.concatenate([[0], np.bincount(found, minlength=len(self.words)).cumsum()[:-1]])
        self.owner = np.searchsorted(ends, order)
        self.blocks = {d: np.cumsum(~same[d]) - 1 for d in same}
        self.begins = {d: np.flatnonzero(~same[d]) for d in same}
        self.n = n

    def _suffixes(self, symbols: np.ndarray, alphabet: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """The suffix array by doubling, and which suffixes agree with the one before in depth and depth - 1 words."""
        n, size, rank, held = len(symbols), 1, symbols, None

        def ahead(values: np.ndarray, by: int) -> np.ndarray:
            out = np.full(n, -1, np.int64)
            out[:n - by] = values[by:]
            return out

        while True:
            key = rank * (max(alphabet, n) + 1) + ahead(rank, size) + 1 if size < n else rank
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank, size = new, size * 2
            if size <= self.depth - 1:
                held = size, rank
            if rank[order[-1]] == n - 1:
                break
        level, ranks = held if held is not None else (1, symbols)
        agree = {}
        for depth in (self.depth, self.depth - 1):
            tail = ahead(ranks, depth - level) if depth > level else ranks
            far = np.concatenate([[False], (ranks[order[1:]] == ranks[order[:-1]]) & (tail[order[1:]] == tail[order[:-1]])])
            agree[depth] = far & (tail[order] >= 0)
        return order, agree

    def smallest(self, documents: np.ndarray) -> list[np.ndarray]:
        """Per stretch and window start: the least of ``documents`` over the stretches with that window."""
        depth, out = self.depth, [np.full(max(0, n - self.depth + 1), LAST, np.int64) for n in self.lengths]
        least = np.minimum.reduceat(documents[self.owner], self.begins[depth])
        shorter, begins = self.blocks[depth - 1], np.append(self.begins[depth - 1], self.n)
        by_length = np.argsort(-self.lengths, kind="stable")
        lengths = self.lengths[by_length]
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        flat = np.full(int(lengths.sum()), LAST, np.int64)
        offsets = np.cumsum(lengths) - lengths
        for step in range(int(lengths[0])):
            live = int(np.searchsorted(-lengths, -step, side="left"))  # stretches of more than ``step`` words
            place = lengths[:live] - 1 - step
            code = self.codes[self.first[by_length[:live]] + place]
            both = self.tree.rank(np.concatenate([code, code]), np.concatenate([low[:live], high[:live]]))
            low[:live], high[:live] = self.less[code - 1] + both[:live], self.less[code - 1] + both[live:]
            if (low[:live] >= high[:live]).any():
                raise AssertionError("a stretch is missing from its own index")
            if step >= depth - 1:
                flat[offsets[:live] + place] = least[self.blocks[depth][low[:live]]]
                block = shorter[low[:live]]
                low[:live], high[:live] = begins[block], begins[block + 1]
        for i, stretch in enumerate(by_length):
            out[stretch] = flat[offsets[i]:offsets[i] + max(0, lengths[i] - depth + 1)]
        return out


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Where the least value of each ``span`` consecutive ones stands, the first of equals.

    Values count by their upper 47 bits, with their place below; minima from both ends of blocks of
    ``span`` meet in every window.
    """
    n = len(values) - span + 1
    placed = np.full(-(-len(values) // span) * span, np.iinfo(np.uint64).max)
    placed[:len(values)] = (values >> np.uint64(17) << np.uint64(17)) | np.arange(len(values), dtype=np.uint64)
    blocks = placed.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[span - 1:span - 1 + n]) & np.uint64((1 << 17) - 1)).astype(np.int64)


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """The polynomial of each ``GRAM`` consecutive words, put together from those of 2, 4 and 8 words."""
    two = words[:-1] * POWERS[0] + words[1:]
    four = two[:-2] * POWERS[1] + two[2:]
    eight = four[:-4] * POWERS[2] + four[4:]
    return eight[:-4] * POWERS[2] + four[8:]


def anchors_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) in the order of the text."""
    n = len(words) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = mixed(gram_hashes(words))
    span = WINDOW - GRAM + 1
    at = np.concatenate([a + _least(grams[a:a + CHUNK + span - 1], span) for a in range(0, n, CHUNK)])
    low = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return grams[at[low]].view(np.int64), low, np.append(low[1:], n) - 1


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        found = [anchors_of(hashes.of(_words(t.as_py()))) for t in batch.column(2)]
        which = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        if len(which):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which)), pa.array(np.concatenate([f[0] for f in found])),
                 pa.array(np.concatenate([f[1] for f in found]).astype(np.int32))],
                names=["doc_id", "text_hash", "anchor", "low"],
            )


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a shared anchor are finished; the others keep their text."""
    for batch in batches:
        done = ~np.array(batch.column(3).is_valid())
        words = [_words(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(batch.column(2).to_pylist(), pa.binary(), mask=done), batch.column(3),
             pa.array([len(w) for w in words], pa.int64()), pa.array([_digest(w) if d else None for w, d in zip(words, done)], pa.string())],
            names=["doc_id", "text_hash", "text", "lows", "n_words", "kept_sha256"],
        )


def _stretches(batches: Iterator[pa.RecordBatch], with_words: bool) -> Iterator[pa.RecordBatch]:
    """Per shared anchor of a text its stretch of words, or only the stretch's hash."""
    hashes = word_hashes()
    for batch in batches:
        for doc_id, text_hash, text, lows in zip(*(batch.column(i) for i in range(4))):
            words = _words(text.as_py())
            hashed = hashes.of(words)
            anchor, low, high = anchors_of(hashed)
            shared = np.flatnonzero(np.isin(low, np.array(lows.as_py())))
            ends = [(int(low[i]), int(high[i]) + WINDOW) for i in shared]
            columns = {
                "doc_id": pa.array([doc_id.as_py()] * len(ends), pa.int64()), "text_hash": pa.array([text_hash.as_py()] * len(ends), pa.int64()),
                "anchor": pa.array(anchor[shared]), "low": pa.array(low[shared].astype(np.int32)),
                "stretch": pa.array([xxhash.xxh3_64_intdigest(hashed[a:b].tobytes()) for a, b in ends], pa.uint64()).view(pa.int64()),
            }
            if with_words:
                columns["words"] = pa.array([b" ".join(words[a:b]) for a, b in ends], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index whole groups (anchor, salt) of the sorted rows and search each with its own stretches."""
    hashes = word_hashes()
    rows: list[tuple] = []
    size, last = 0, None

    def search() -> pa.RecordBatch:
        index = FmIndex([r[5] for r in rows])
        least = index.smallest(np.array([r[3] for r in rows], np.int64))
        windows = []
        for r in rows:
            if r[4]:  # dealt to several indexes: told apart by their windows' hashes
                w = np.lib.stride_tricks.sliding_window_view(r[5], WINDOW)
                windows.append([xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in w])
            else:
                windows.append(None)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([list(x) for x in least], pa.list_(pa.int64())),
             pa.array(windows, pa.list_(pa.int64()))],
            names=["anchor", "stretch", "firsts", "windows"],
        )

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if size >= INDEX_WORDS and row[:2] != last:
                yield search()
                rows, size = [], 0
            words = hashes.of(_words(row[5]))
            rows.append((*row[:5], words))
            size, last = size + len(words), row[:2]
    if rows:
        yield search()


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the words that a repeated window covers."""
    for batch in batches:
        removed, digests = [], []
        for text, found in zip(batch.column(1), batch.column(2)):
            words = _words(text.as_py())
            edges = np.zeros(len(words) + WINDOW + 1, np.int32)
            for low, mask in ((f["low"], f["mask"]) for f in found.as_py() or ()):
                starts = low + np.flatnonzero(np.array(mask, bool))
                edges[starts] += 1
                edges[starts + WINDOW] -= 1
            covered = np.cumsum(edges)[:len(words)] > 0
            removed.append(int(covered.sum()))
            digests.append(_digest([w for w, c in zip(words, covered) if not c]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _together(found: DataFrame) -> DataFrame:
    """``firsts`` of stretches that several indexes share, as the least over the indexes."""
    plain = found.where("windows IS NULL").select("anchor", "stretch", "firsts")
    parts = found.where("windows IS NOT NULL").select("anchor", "stretch", F.posexplode(F.arrays_zip("windows", "firsts")).alias("at", "w"))
    parts = parts.select("anchor", "stretch", "at", F.col("w.windows").alias("window"), F.col("w.firsts").alias("first"))
    least = parts.groupBy("anchor", "window").agg(F.min("first").alias("first"))
    merged = parts.drop("first").join(least, ["anchor", "window"]).groupBy("anchor", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("at", "first"))).alias("w")  # as long as a stretch
    )
    return plain.union(merged.select("anchor", "stretch", F.col("w.first")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    Null and empty texts have no words; rows of one id do not repeat each other, equal rows give equal
    results; a row without an id stands behind all with one and repeats nothing for other such rows.
    Other columns are ignored; no rows give none.
    """
    spark, place = docs.sparkSession, Workspace(docs.sparkSession, "substrings")
    order = F.coalesce("doc_id", F.lit(LAST)).alias("document")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    anchors = place.keep(rows.mapInArrow(_anchored, "doc_id long, text_hash long, anchor long, low int"), "anchors")
    shared = place.keep(anchors.groupBy("anchor").agg(F.min(order).alias("a"), F.max(order).alias("b")).where("a < b").select("anchor"), "shared")
    # A text's own anchors: no more than the text has words.
    lows = anchors.join(shared, "anchor").groupBy("doc_id", "text_hash").agg(F.collect_set("low").alias("lows"))
    lows = lows.select(F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"), "lows")
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    schema = "doc_id long, text_hash long, text binary, lows array<int>, n_words long, kept_sha256 string"
    seen = place.keep(rows.join(lows, same, "left").select("doc_id", "text_hash", "text", "lows").mapInArrow(_parted, schema), "seen")
    place.drop("anchors", "shared")
    some = seen.where("lows IS NOT NULL")

    source = some.select("doc_id", "text_hash", "text", "lows")
    kinds = "doc_id long, text_hash long, anchor long, low int, stretch long"
    bodies = source.mapInArrow(lambda b: _stretches(b, True), kinds + ", words binary")
    distinct = place.keep(
        bodies.groupBy("anchor", "stretch").agg(F.min(order).alias("document"), F.first("words").alias("words")), "stretches"
    )
    crowded = distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(f"n > {MOST}")
    dealt = distinct.join(crowded, "anchor", "left").select(
        "anchor", F.coalesce(F.pmod("stretch", F.ceil(F.col("n") / MOST)), F.lit(0)).cast("int").alias("salt"), "stretch", "document",
        F.col("n").isNotNull().alias("crowded"), "words",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = dealt.repartition(parts, "anchor", "salt").sortWithinPartitions("anchor", "salt")
    found = place.keep(
        placed.mapInArrow(_matched, "anchor long, stretch long, firsts array<long>, windows array<long>"), "found"
    )
    place.drop("stretches")
    firsts = _together(found)
    where = source.mapInArrow(lambda b: _stretches(b, False), kinds).distinct()
    masks = where.join(firsts, ["anchor", "stretch"]).select(
        "doc_id", "text_hash", "low", F.transform("firsts", lambda f: f < F.coalesce("doc_id", F.lit(LAST))).alias("mask")
    ).where(F.exists("mask", lambda m: m))
    by_text = masks.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("low", "mask")).alias("found"))
    by_text = by_text.select(F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"), "found")
    cut = some.join(by_text, same, "left").select("doc_id", "text", "found", "n_words")
    result = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    untouched = seen.where("lows IS NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return untouched.union(cut.mapInArrow(_finished, result))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"))
