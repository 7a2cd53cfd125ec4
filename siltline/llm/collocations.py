"""Frequent phrases whose words attract each other, found by fingerprints of n-grams.

Words lie in flat arrays. Prefix sums of their hashes times falling powers of an odd base, modulo
2^64, give the polynomial fingerprint of any n-gram as one difference times a rising power. Three
passes count words, then pairs of frequent words, then longer phrases all of whose pairs are frequent,
since no phrase is more frequent than its parts; what is frequent is passed on as a bitmap of fixed
size, which may let more through but never less.

What is shuffled is a row per fingerprint and chunk of text: its count, and the least and greatest of a
second fingerprint with the key of a document that holds it (32 bits of each in one number). In a chunk all occurrences are compared
word by word; between chunks, different second fingerprints betray a collision. Colliding ones are
counted again by their words. Only frequent phrases become text, out of the documents pointed to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, table

LONGEST = 5
CHUNK = 5 << 20  # bytes of text whose fingerprints are folded before the shuffle
SLOTS = 1 << 27  # bits of a bitmap: 16 MB, whatever the corpus
PARTS = 64  # in which each language's best are found before they are merged
BREAKS = b".,;:!?\n\x0b\x0c\r"
# Lower-cases A to Z and makes every break a full stop, which no word holds.
LETTERS = bytes(ord(".") if b in BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
LANG, LENGTH = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _folded() -> list[Column]:
    return [F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")]


def _best_first() -> list[Column]:
    return [F.desc("score"), F.desc("a"), F.asc("phrase")]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def _in(bitmap: bytes, prints: np.ndarray) -> np.ndarray:
    slots = prints & np.uint64(SLOTS - 1)
    return (np.frombuffer(bitmap, "<u8")[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


class Chunk:
    """Some texts' words behind one another, with a break (number 0) behind each text."""

    def __init__(self, keys: list[int], langs: list[str], texts: list[bytes], bits: int):
        numbers, parts = _Numbers({b".": 0}), []
        for text in texts:
            words = text.replace(b".", b" . ").split()
            parts += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), np.zeros(1, np.int64)]
        self.bits, self.langs = bits, langs
        self.code, self.words = np.concatenate(parts), list(numbers)
        self.doc = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in parts[::2]])
        self.keys = np.array(keys, np.int64)
        self.lang = np.array([xxhash.xxh64_intdigest(x.encode()) for x in langs], np.uint64)
        ends = np.flatnonzero(self.code == 0)
        self.room = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(self.code))  # words left in the piece
        self.sums, self.powers = [], []
        for seed, base in enumerate(BASES):
            hashes = np.array([0, *(xxhash.xxh64_intdigest(w, seed + 1) for w in self.words[1:])], np.uint64)[self.code]
            falling = np.cumprod(np.full(len(self.code), pow(base, -1, 1 << 64), np.uint64))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * falling)]))
            self.powers.append(np.cumprod(np.full(len(self.code), base, np.uint64)))

    def prints(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and second fingerprint (32 bits) of the n words from each of these places on."""
        both = []
        for sums, powers in zip(self.sums, self.powers):
            value = (sums[at + n] - sums[at]) * powers[at]
            both.append(_mixed(_mixed(value + LENGTH * np.uint64(n + 1)) + LANG * self.lang[self.doc[at]]))
        return both[0] >> np.uint64(64 - self.bits), (both[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def places(self, n: int, words: bytes | None, pairs: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Where n words begin that can be frequent by the bitmaps of words and of pairs, and for how many occurrences
        each place stands: one, or for the empty phrase all words of its text."""
        if n == 0:
            at = np.flatnonzero(np.diff(self.doc, prepend=-1))
            weights = np.add.reduceat((self.code > 0).astype(np.int64), at)
            return at[weights > 0], weights[weights > 0]
        good = self.room >= 1
        if words is not None and n > 1:
            one = np.flatnonzero(good)
            good[one] = _in(words, self.prints(one, 1)[0])
            good[:-1] &= good[1:]
            good &= self.room >= 2
        if pairs is not None and n > 2:
            two = np.flatnonzero(good)
            good[two] = _in(pairs, self.prints(two, 2)[0])
            pair = good.copy()
            for k in range(1, n - 1):
                good[:-k] &= pair[k:]
        at = np.flatnonzero(good & (self.room >= n))
        return at, np.ones(len(at), np.int64)

    def _unlike(self, at: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
        """Where the n words, or the languages, at two places differ."""
        out = self.lang[self.doc[at]] != self.lang[self.doc[first]]
        for k in range(n):
            out |= self.code[at + k] != self.code[first + k]
        return out

    def fold(self, at: np.ndarray, n: int, weights: np.ndarray) -> dict[str, np.ndarray]:
        """One entry per fingerprint: count, least and greatest second fingerprint with a document."""
        prints, checks = self.prints(at, n)
        order = np.argsort(prints, kind="stable")
        prints, checks, at = prints[order], checks[order], at[order]
        new = np.diff(prints, prepend=~prints[:1]) != 0
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        low, high = np.minimum.reduceat(checks, starts), np.maximum.reduceat(checks, starts)
        mixed = np.unique(group[self._unlike(at, at[starts][group], n)])
        same = mixed[low[mixed] == high[mixed]]  # both fingerprints collide
        low[same], high[same] = np.iinfo(np.int32).min, np.iinfo(np.int32).max
        doc = self.keys[self.doc[at[starts]]] & 0xFFFFFFFF
        low, high = ((x.astype(np.int64) << 32) | doc for x in (low, high))
        return {"fp": prints[starts].view(np.int64), "n": np.add.reduceat(weights[order], starts), "low": low, "high": high}

    def distinct(self, at: np.ndarray, n: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A place of each different phrase among these, and its count."""
        prints, checks = self.prints(at, n)
        order = np.lexsort((checks, prints))
        prints, checks, at, weights = prints[order], checks[order], at[order], weights[order]
        new = (np.diff(prints, prepend=~prints[:1]) != 0) | (np.diff(checks, prepend=~checks[:1]) != 0)
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        unlike = self._unlike(at, at[starts][group], n)
        counts = np.add.reduceat(np.where(unlike, 0, weights), starts)
        rest: dict[tuple, list[int]] = {}
        for place, weight in zip(at[unlike].tolist(), weights[unlike].tolist()):
            rest.setdefault((int(self.lang[self.doc[place]]), *self.code[place:place + n].tolist()), [place, 0])[1] += weight
        more = np.array(list(rest.values()), np.int64).reshape(-1, 2)
        return np.concatenate([at[starts], more[:, 0]]), np.concatenate([counts, more[:, 1]])

    def phrase(self, at: int, n: int) -> str:
        return b" ".join(map(self.words.__getitem__, self.code[at:at + n].tolist())).decode("utf-8", "replace")


def _chunks(batches: Iterator[pa.RecordBatch], bits: int, wanted: bytes | None = None) -> Iterator[Chunk]:
    """Chunks of (key, lang, text) rows; a long text is cut behind breaks, which no phrase crosses."""
    keys, langs, texts, held = [], [], [], 0
    for batch in batches:
        some = range(batch.num_rows)
        if wanted is not None and batch.num_rows:
            some = np.flatnonzero(_in(wanted, batch.column(0).to_numpy().view(np.uint64))).tolist()
        for i in some:
            text = batch.column(2)[i].as_py().translate(LETTERS)
            at = 0
            while at < len(text):
                stop = text.find(b".", at + CHUNK)
                end = stop + 1 if stop >= 0 else len(text)
                keys.append(batch.column(0)[i].as_py())
                langs.append(batch.column(1)[i].as_py())
                texts.append(text[at:end])
                held, at = held + end - at, end
                if held >= CHUNK:
                    yield Chunk(keys, langs, texts, bits)
                    keys, langs, texts, held = [], [], [], 0
    if texts:
        yield Chunk(keys, langs, texts, bits)


def _value(shared: Broadcast | None) -> bytes | None:
    return None if shared is None else shared.value


class Phrases:
    """One run over ``docs``; tables that are read twice are kept in the shared folder."""

    def __init__(self, docs: DataFrame, least: int, bits: int):
        self.spark, self.least, self.bits = docs.sparkSession, least, bits
        self.place = Workspace(self.spark, "phrases")
        lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
        self.docs = docs.select(F.xxhash64(lang, "text").alias("doc"), lang.alias("lang"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def _bitmap(self, hashes: DataFrame, column: Column) -> Broadcast:
        """A bit for each value; the driver gets SLOTS / 64 numbers at most."""
        slot = column.bitwiseAND(SLOTS - 1)
        bit = F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
        words = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
        bitmap = np.zeros(SLOTS // 64, np.int64)
        bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        return self.spark.sparkContext.broadcast(bitmap.tobytes())

    def _count(self, lengths: range, name: str, words: Broadcast | None = None, pairs: Broadcast | None = None) -> DataFrame:
        """The fingerprints of phrases of these lengths that occur ``least`` times."""
        bits = self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in _chunks(batches, bits):
                for n in lengths:
                    at, weights = chunk.places(n, _value(words), _value(pairs))
                    if len(at):
                        yield pa.RecordBatch.from_pydict(chunk.fold(at, n, weights))

        rows = self.docs.mapInArrow(run, "fp long, n long, low long, high long")
        return self.place.keep(rows.groupBy("fp").agg(*_folded()).where(F.col("n") >= self.least), name)

    def _texts(self, bitmap: Broadcast, words: Broadcast, pairs: Broadcast, documents: Broadcast | None) -> DataFrame:
        """(fp, check, lang, words, phrase, n), a row per phrase and chunk: in ``documents``, those whose fingerprint and
        document ``bitmap`` has; without, in all, those whose fingerprint it has."""
        bits = self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in _chunks(batches, bits, _value(documents)):
                for n in range(LONGEST + 1):
                    at, weights = chunk.places(n, words.value, pairs.value)
                    keys = chunk.prints(at, n)[0]
                    if documents is not None:
                        keys = keys ^ chunk.keys[chunk.doc[at]].view(np.uint64)
                    chosen = _in(bitmap.value, keys)
                    if not chosen.any():
                        continue
                    at, counts = chunk.distinct(at[chosen], n, weights[chosen])
                    prints, checks = chunk.prints(at, n)
                    yield pa.RecordBatch.from_pydict({
                        "fp": prints.view(np.int64), "check": checks, "lang": [chunk.langs[i] for i in chunk.doc[at].tolist()],
                        "words": np.full(len(at), n, np.int32), "phrase": [chunk.phrase(i, n) for i in at.tolist()], "n": counts,
                    })

        return self.docs.mapInArrow(run, "fp long, check int, lang string, words int, phrase string, n long")

    def frequent(self) -> DataFrame:
        """(lang, words, phrase, f) of all phrases that occur ``least`` times; the empty one has the number of all words."""
        ones = self._count(range(2), "ones")
        words = self._bitmap(ones, F.col("fp"))
        twos = self._count(range(2, 3), "twos", words)
        pairs = self._bitmap(twos, F.col("fp"))
        more = self._count(range(3, LONGEST + 1), "more", words, pairs)
        # Phrases of two passes that share a fingerprint are told apart by their words too.
        every = ones.union(twos).union(more).groupBy("fp").agg(*_folded(), F.count("*").alias("passes"))
        check, last, doc = F.shiftright("low", 32), F.shiftright("high", 32), F.col("low").bitwiseAND(0xFFFFFFFF)
        every = every.select("fp", "n", check.cast("int").alias("check"), doc.alias("doc"), ((check < last) | (F.col("passes") > 1)).alias("apart"))
        every = self.place.keep(every, "frequent")
        sure, apart = every.where("NOT apart"), every.where("apart")
        pointers, documents = self._bitmap(sure, F.col("fp").bitwiseXOR(F.col("doc"))), self._bitmap(sure, F.col("doc"))
        texts = self._texts(pointers, words, pairs, documents).drop("n").distinct()
        found = texts.join(sure.select("fp", "n", "check"), ["fp", "check"]).select("lang", "words", "phrase", F.col("n").alias("f"))
        if apart.limit(1).count():
            again = self._texts(self._bitmap(apart, F.col("fp")), words, pairs, None).join(apart.select("fp"), "fp", "left_semi")
            again = again.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
            found = found.union(again.where(F.col("f") >= self.least))
        found = self.place.keep(found, "phrases")
        self.place.drop("ones", "twos", "more", "frequent")
        return found


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, fingerprint_bits: int = 64) -> DataFrame:
    """The best ``top`` phrases of two to five words per lang: lang, rank, phrase, a, l, r, n, score.

    Words and pieces are those of the contract: A-Z in lower case, pieces end at ``. , ; : ! ?`` and line breaks,
    words at blanks and tabs. a is the phrase's count (``least`` or more), l and r those of its parts at the cut
    with the lowest score, n the number of all words, score floor(1000 a n / (l r)). A phrase that stands in a
    longer one as frequent as itself is left out. Ties go by a descending, then by the phrase's bytes.

    Null and empty texts have no words; a null lang is ``und``; repeated rows count again; ids are not
    read; other columns are ignored; an empty table gives no rows. Fewer ``fingerprint_bits`` only cost time.
    """
    phrases = Phrases(docs, least, fingerprint_bits).frequent()
    candidates = phrases.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))
    # A phrase's two parts without an end word are what it can hide; shorter ones it hides through these.
    word = F.split("phrase", " ", -1)
    inner = F.array(F.slice(word, 1, F.col("words") - 1), F.slice(word, 2, F.col("words") - 1))
    hidden = candidates.where("words >= 3").select("lang", F.explode(inner).alias("part"), "a")
    hidden = hidden.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = candidates.join(hidden, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a").drop("longer")

    cuts = kept.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(word, 1, F.col("k")), " ").alias("left"), F.array_join(F.slice(word, F.col("k") + 1, F.col("words")), " ").alias("right"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    scored = scored.withColumn("over", 1000 * big["a"] * big["n"]).withColumn("under", big["l"] * big["r"]).withColumn("score", F.expr("over div under"))
    order = F.col("score") * 8 + F.col("k")  # the lowest score, then the first cut
    best = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min_by("l", order).alias("l"), F.min_by("r", order).alias("r"), F.first("n").alias("n"), F.min("score").alias("score")
    )

    # Each part of a language sends on its best, so that no task sorts a whole language.
    place = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*_best_first()))
    some = best.withColumn("place", place).where(F.col("place") <= top).drop("place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*_best_first())).cast("long")
    return some.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best 2,000 phrases of each language, over all documents; odd rows are as in ``collocations``."""
    return collocations(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists
), f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (VALUES (1), (2), (3), (4), (5)) sizes(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size >= 2 AND f >= 100
), hidden AS (
  SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, size, w, a, part, unnest(range(1, size - part + 2)) AS i
    FROM candidates, (VALUES (2), (3), (4)) parts(part) WHERE part < size) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN hidden h ON c.lang = h.lang AND c.phrase = h.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < 100 * c.a
), cuts AS (
  SELECT lang, size, phrase, w, a, unnest(range(1, size)) AS k FROM kept
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.size = c.k AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.size = c.size - c.k AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best
)
SELECT * FROM ranked WHERE rank <= 2000
"""
