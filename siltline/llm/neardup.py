"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A sketch has 128 coordinates. In each round every shingle is hashed to a bin; a bin takes the smallest
hash of the first round that reaches it, and bins still empty after 128 rounds get a round of their
own, so every coordinate fills and agreement concentrates around the similarity. 32 bands of four
coordinates find a pair at similarity 0.8 except with probability 5e-8.

Equal sets are one class throughout. In a bucket, all classes first meet its least one, and each is
compared with the one that it meets in most of its buckets; then, in two turns and across components
only, they meet others, and each is compared with the one whose signature is nearest to its own.
Where a bucket then still holds different components, the pairs across them are looked at: all of
them in a small bucket, those found by an exact search over prefixes of rare shingles in a larger one.
Beyond the first pairs, only those that signatures rule out for certain are not compared.
All pairs are confirmed on the full shingle sets; pairs inside a component that is already joined are
left alone, since components need no more links.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, fresh, table

COORDINATES, BANDS = 128, 32
SMALL = 16  # members of a bucket that are all paired
TURNS = 2  # of pairing with a member chosen at random; the exact search follows anyhow
SIGNED = [f"s{i}" for i in range(8)]
LIKELY = 0.6  # of the coordinates agree, or a pair is not looked at first; later ones are judged by signatures and texts

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered while it stays among some hundred thousand."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 400_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


@functools.lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    """One memory of hashes per Python worker, for all tasks that it runs."""
    return WordHashes()


def shingle_set(text: bytes | None, hashes: WordHashes, width: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence as one where words are fewer."""
    words = hashes.of(text.translate(LOWER).split()) if text else np.empty(0, np.uint64)
    n = len(words)
    if n == 0:
        return words
    size = min(width, n)
    total = np.full(n - size + 1, size, np.uint64) * FACTORS[-1]
    for i in range(size):
        total = mixed(total + words[i:n - size + 1 + i] * FACTORS[i % 4])
    return np.unique(total)


def sketch(members: np.ndarray) -> np.ndarray:
    """The coordinates of a non-empty set, as 16-bit values."""
    t, n = COORDINATES, len(members)
    out, empty = np.zeros(t, np.uint16), np.ones(t, bool)
    at, step = 0, max(1, min(t, 2 * t // n))
    while at < t and empty.any():
        rounds = np.arange(at, min(at + step, t), dtype=np.uint64)
        h = mixed(members[None, :] ^ mixed(rounds * FACTORS[0] + FACTORS[1])[:, None])
        # Bin above, round below it, the hash below that: the first of a bin is what it takes.
        key = np.sort((((h >> np.uint64(57)) << np.uint64(57)) | (rounds[:, None] << np.uint64(49)) | ((h << np.uint64(7)) >> np.uint64(15))).ravel())
        bins = (key >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        new = first[empty[bins[first]]]
        out[bins[new]] = (mixed(key[new]) >> np.uint64(48)).astype(np.uint16)
        empty[bins[new]] = False
        at += step
    left = np.flatnonzero(empty)
    if len(left):
        rounds = (left + t).astype(np.uint64)
        least = mixed(members[None, :] ^ mixed(rounds * FACTORS[0] + FACTORS[1])[:, None]).min(axis=1)
        out[left] = (mixed(least ^ FACTORS[2]) >> np.uint64(48)).astype(np.uint16)
    return out


def signature(members: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the members that fall to it: two sets differ in as many members, at least, as
    their signatures do in bits."""
    parity = np.bincount((members >> np.uint64(13)).astype(np.int64) & 0x1FF, minlength=512).astype(np.uint8) & 1
    return np.packbits(parity).view("<i8")


def _unlike(a: str, b: str) -> Column:
    """In how many bits two signatures differ."""
    return functools.reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{s}_{a}").bitwiseXOR(F.col(f"{s}_{b}"))) for s in SIGNED))


def _may_link(a: str, b: str) -> Column:
    """False only where signatures show that two sets are less than 0.8 alike: more than a ninth of all members differ."""
    return 9 * _unlike(a, b) <= F.col(f"size_{a}") + F.col(f"size_{b}")


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        n, digests, bands, signed = [], [], [], []
        for text in batch.column(2):
            members = shingle_set(text.as_py(), hashes)
            n.append(len(members))
            digests.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
            bands.append(sketch(members).tobytes() if len(members) else None)
            signed.append(signature(members))
        parts = np.array(signed, np.int64).reshape(-1, len(SIGNED)).T
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.binary()), *map(pa.array, parts)],
            names=["doc_id", "text_hash", "n_shingles", "set_hash", "sketch", *SIGNED],
        )


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = shingle_set(x.as_py(), hashes), shingle_set(y.as_py(), hashes)
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= 80 * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, COORDINATES) for i in (2, 3))
            near = (x == y).sum(axis=1) >= LIKELY * COORDINATES
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shingle of each text: node, its set's size, the shingle."""
    hashes = word_hashes()
    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            members = shingle_set(text.as_py(), hashes)
            yield pa.RecordBatch.from_pydict({
                "node": np.full(len(members), node, np.int64), "size": np.full(len(members), len(members), np.int64),
                "shingle": members.view(np.int64),
            })


def _likeliest(met: DataFrame) -> DataFrame:
    """Of (node, center) rows, one per shared bucket, each node with the center that most of its rows name."""
    shared = met.groupBy("node", "center").agg(F.count("*").alias("shared"))
    rank = F.col("shared") * (1 << 20) - F.pmod(F.xxhash64("node", "center"), F.lit(1 << 19))
    return shared.groupBy("node").agg(F.max_by("center", rank).alias("a")).select("a", F.col("node").alias("b"))


class Groups:
    """One run of the search over ``docs``; every table it needs twice is kept in the shared folder."""

    def __init__(self, docs: DataFrame):
        self.place = Workspace(docs.sparkSession, "neardup")
        self.docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        raw = self.docs.select("doc_id", "text_hash", F.col("text").cast("binary"))
        schema = "doc_id long, text_hash long, n_shingles long, set_hash binary, sketch binary, " + ", ".join(f"{s} long" for s in SIGNED)
        self.rows = self.place.keep(raw.mapInArrow(_sketched, schema), "rows")
        first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
        classes = (
            self.rows.where("set_hash IS NOT NULL")
            .groupBy("set_hash")
            # Equal sets have one size, sketch and signature.
            .agg(F.min(first).alias("first"), F.first("n_shingles").alias("size"), *(F.first(c).alias(c) for c in ("sketch", *SIGNED)))
            .withColumn("node", F.monotonically_increasing_id())
        )
        self.classes = self.place.keep(classes, "classes")

    def _join(self, pairs: DataFrame, values: DataFrame, column: str, test: Callable) -> DataFrame:
        """The pairs that pass ``test`` on a column of both nodes."""
        a, b = (values.select(F.col("node").alias(n), F.col(column).alias(f"value_{n}")) for n in "ab")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "value_a", "value_b").mapInArrow(test, "a long, b long")

    def _components(self, links: DataFrame, name: str) -> DataFrame:
        """(node, root) of every linked node: the least node reachable, by neighbours' minima and jumps."""
        keep, turn = self.place.keep, 0
        both = keep(links.select("a", "b").union(links.select("b", "a")), f"{name}-links")
        labels = keep(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), f"{name}-0")
        while True:
            nearest = (
                both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near")).withColumnRenamed("a", "node")
            )
            moved = labels.join(nearest, "node").select("node", "root", F.least("root", "near").alias("next"))
            jumps = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
            turn += 1
            stepped = keep(
                moved.join(jumps, "next", "left").select("node", F.coalesce("beyond", "next").alias("root"), F.col("root").alias("was")), f"{name}-{turn}"
            )
            changed = stepped.where("root <> was").limit(1).count()
            self.place.drop(f"{name}-{turn - 1}")
            labels = stepped.select("node", "root")
            if not changed:
                return labels

    def components(self) -> DataFrame:
        """(node, root) of all classes that have a link."""
        keep, place = self.place.keep, self.place
        # Eight bytes of the sketch are one band: four coordinates.
        bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sketch"), i * 8 + 1, F.lit(8))))
        members = self.classes.select(F.explode(bands).alias("bucket"), "node")
        buckets = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("center")).where("n > 1")
        bucketed = keep(members.join(buckets, "bucket"), "members")
        # A text for each class in a bucket with others; repeated rows of one id and text count once.
        wanted = bucketed.select("node").distinct()
        owners = self.classes.join(wanted, "node").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
        one_text = self.docs.alias("d").join(owners.alias("o"), F.expr("d.doc_id <=> o.doc_id AND d.text_hash = o.text_hash"))
        texts = keep(one_text.select("node", F.col("text").cast("binary").alias("text")).dropDuplicates(["node"]), "texts")

        # First every bucket's members with its least. A class meets nearly the same few in all of its
        # buckets, so it is compared with one only, which it shares most buckets with.
        likely = self._join(_likeliest(bucketed.where("node <> center")), self.classes, "sketch", _alike)
        links = keep(self._join(likely, texts, "text", _confirmed), "links-first")
        labels = self._components(links, "first")

        # The same with other members in the middle, which buckets choose by orders of their own, for
        # what is still apart from them; a class is compared with the one whose signature is nearest to its own.
        signed = keep(bucketed.select("bucket", "node").join(self.classes.select("node", "size", *SIGNED), "node"), "signed")
        for turn in range(TURNS):
            rooted = signed.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
            drawn = F.col("node").bitwiseXOR(F.xxhash64("bucket", F.lit(turn)))
            middle = rooted.groupBy("bucket").agg(
                F.min("root").alias("low"), F.max("root").alias("high"),
                *(F.min_by(c, drawn).alias(f"{c}_a") for c in ("node", "root", "size", *SIGNED)),
            ).where("low < high")
            around = rooted.select("bucket", *(F.col(c).alias(f"{c}_b") for c in ("node", "root", "size", *SIGNED))).join(middle, "bucket")
            share = _unlike("a", "b") * (1 << 20) / (F.col("size_a") + F.col("size_b"))
            nearest = around.where("root_a <> root_b").where(_may_link("a", "b")).groupBy("node_b").agg(F.min_by("node_a", share).alias("a"))
            more = keep(self._join(nearest.select("a", F.col("node_b").alias("b")), texts, "text", _confirmed), f"links-turn-{turn}")
            if not more.limit(1).count():
                break
            links = keep(links.union(more), f"links-all-{turn}")
            labels = self._components(links, f"turn-{turn}")

        # Then, where a bucket still holds different components, what may join them.
        rooted = bucketed.join(labels, "node", "left").select("bucket", "n", "node", F.coalesce("root", "node").alias("root"))
        spread = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket")
        mixed_members = keep(rooted.join(spread, "bucket", "left_semi"), "mixed")
        few = mixed_members.where(f"n <= {SMALL}").join(self.classes.select("node", "size", *SIGNED), "node")
        a, b = (few.select("bucket", F.col("node").alias(n), *(F.col(c).alias(f"{c}_{n}") for c in ("root", "size", *SIGNED))) for n in "ab")
        paired = keep(a.join(b, "bucket").where("a < b AND root_a <> root_b").where(_may_link("a", "b")).select("a", "b").distinct(), "paired")
        late = self._join(paired, texts, "text", _confirmed)
        rest = self._rest(mixed_members.where(f"n > {SMALL}").select("node", "root").distinct(), texts)
        late = keep(late if rest is None else late.union(self._join(rest, texts, "text", _confirmed)), "links-3")
        if late.limit(1).count():
            labels = self._components(links.union(late), "round-3")
        place.drop("texts", "members", "signed", "mixed", "paired")
        return labels

    def _rest(self, nodes: DataFrame, texts: DataFrame) -> DataFrame | None:
        """Pairs across components among the members of large buckets, searched exactly.

        In any order of the shingles, sets of similarity 0.8 have their first common shingle among the
        first fifth (and one) of the larger set and the first ninth (and one) of the smaller, and no
        less of either behind it than their overlap needs. What signatures rule out is not compared. The order is by how many of these sets
        hold a shingle, so common ones come last.
        """
        nodes = self.place.keep(nodes, "apart")
        if not nodes.limit(1).count():
            return None
        every = self.place.keep(texts.join(nodes.select("node"), "node", "left_semi").mapInArrow(_prefixes, "node long, size long, shingle long"), "shingles")
        counted = every.join(every.groupBy("shingle").agg(F.count("*").alias("df")), "shingle")
        rarest = Window.partitionBy("node").orderBy("df", "shingle")
        kept = counted.withColumn("k", F.row_number().over(rarest)).where("5 * (k - 1) <= size").join(nodes.join(self.classes.select("node", *SIGNED), "node"), "node")
        # Sizes a quarter apart at most are in one class of sizes or in neighbouring ones.
        grade = F.floor(F.ln("size") / math.log(1.26))
        kept = self.place.keep(kept.select("shingle", "node", "root", "size", "k", grade.alias("grade"), *SIGNED), "prefixes")
        a, b = (kept.select("shingle", "grade", *[F.col(c).alias(f"{c}_{n}") for c in ("node", "root", "size", "k", *SIGNED)]) for n in "ab")
        smaller = b.where("9 * (k_b - 1) <= size_b").withColumn("grade", F.explode(F.array("grade", F.col("grade") + 1)))
        found = a.join(smaller, ["shingle", "grade"]).where(
            "root_a <> root_b AND size_a >= size_b AND 5 * size_b >= 4 * size_a AND 9 * (1 + least(size_a - k_a, size_b - k_b)) >= 4 * (size_a + size_b)"
        ).where(_may_link("a", "b"))
        ends = F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
        found = self.place.keep(found.select(*ends).distinct(), "rest")
        self.place.drop("shingles", "prefixes")
        return found

    def verdicts(self) -> DataFrame:
        """Per row: doc_id, text_hash, n_shingles, component_id and the first row of its component."""
        labels = self.components()
        rooted = self.classes.join(labels, "node", "left").select("set_hash", "first", F.coalesce("root", "node").alias("root"))
        heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
        by_set = rooted.join(heads, "root").select("set_hash", "head")
        own = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
        return self.rows.join(by_set, "set_hash", "left").select("doc_id", "text_hash", "n_shingles", F.coalesce("head", own).alias("head"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts without words have no shingles, are linked with nothing and are kept. Equal rows share a
    component and its verdict. A null id is no smallest id unless no other is in the component; then
    component_id is null and the null ids are kept. Other columns are ignored; no rows give none.
    """
    found = Groups(docs).verdicts()
    component = F.col("head.doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, of which one per component stays.

    Rows that agree in id and text are one; so are rows with null id and equal text.
    """
    found = Groups(docs).verdicts()
    mine = fresh(docs.columns, "text_hash")
    heads = found.where("doc_id <=> head.doc_id AND text_hash = head.text_hash").select(
        F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")
    ).distinct()
    rows = docs.withColumn(mine, F.xxhash64("text"))
    on = rows["doc_id"].eqNullSafe(heads["kept_id"]) & (rows[mine] == heads["kept_hash"])
    return rows.join(heads, on, "left_semi").dropDuplicates(["doc_id", mine]).drop(mine)


def op9_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
