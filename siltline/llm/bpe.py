"""BPE encoding and decoding with a public tokenizer's vocabulary, merged in batched numpy rounds.

The pieces of many texts that a worker has not met before lie as symbols in one flat array. A round
looks up every pair of neighbours by binary search over the sorted pair keys, takes the lowest rank of
each piece, merges its occurrences from left to right and drops the pieces that have no pair left.

A piece is what the tokenizer's own pattern matches. Below ``PLAIN`` that pattern runs as an ordinary
regular expression whose classes are read off the tokenizer code point by code point; pieces with
other characters, and normalization beyond ``SINGLE``, are asked of the tokenizer, so that its Unicode
tables decide and not Python's.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import table

SINGLE = 0x300  # below it a character is lower-cased alone and composes with nothing
PLAIN = 0x530  # below it the pattern's classes are tabulated
SLICE = 1_000_000  # characters that are normalized and matched at a time
FLUSH = 300_000  # pieces that are merged and returned at a time
REMEMBERED = 200_000  # distinct pieces of a worker, and as many runs with other characters
NEVER = np.int64(1) << np.int64(40)
# Fixed by byte-level vocabularies: bytes that stand for themselves; the others follow from 256 on.
SELF_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _byte_symbols() -> list[str]:
    others = iter(range(256, 512))
    own = set(SELF_BYTES)
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Symbols of bytes, sorted pair keys with ranks and results, and the tokens' strings."""

    def __init__(self, description: dict):
        model, steps = description["model"], description["normalizer"] or {}
        cut = description["pre_tokenizer"] or {}
        expected = {
            "a BPE model": model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
            "NFC, one blank for white space, lower case": [s["type"] for s in steps.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and (steps["normalizers"][1]["pattern"], steps["normalizers"][1]["content"]) == ({"Regex": r"\s+"}, " "),
            "a split by one pattern, then bytes": [(s["type"], s.get("behavior"), s.get("invert"), s.get("add_prefix_space"), s.get("use_regex")) for s in cut.get("pretokenizers", [])]
            == [("Split", "Removed", True, None, None), ("ByteLevel", None, None, False, False)],
            "no post-processor for plain texts and no decoder": not description.get("decoder") and not description.get("post_processor"),
            "added tokens that match the raw text as they stand": not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in description["added_tokens"]),
        }
        if missing := [k for k, holds in expected.items() if not holds]:
            raise ValueError(f"this encoder needs {'; '.join(missing)}")
        self.pattern = cut["pretokenizers"][0]["pattern"]["Regex"]
        self.added = {t["content"]: t["id"] for t in description["added_tokens"]}
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        ranks = np.arange(len(pairs), dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self.keys, self.ranks, self.made = pairs[order], ranks[order], made[order]
        # Where no symbol is used before it is made, all occurrences of a pair can be merged at once.
        made_last = np.full(max(max(vocab.values()), max(self.added.values(), default=0)) + 1, -1, np.int64)
        np.maximum.at(made_last, made, ranks)
        self.in_order = bool((np.maximum(made_last[pairs >> 32], made_last[pairs & 0xFFFFFFFF]) < ranks).all())
        names: list[str | None] = [None] * len(made_last)
        for name, i in [*vocab.items(), *self.added.items()]:
            names[i] = name
        self.names = pa.array(names, pa.large_string())

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged symbols of many non-empty pieces, one at least, that lie one behind the other, and
        their new lengths."""
        pieces, done = np.arange(len(lengths)), []
        while len(pieces):
            ends = np.cumsum(lengths)
            keys = np.empty(len(symbols), np.int64)
            keys[:-1] = (symbols[:-1] << 32) | symbols[1:]
            keys[ends - 1] = -1
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where(self.keys[at] == keys, self.ranks[at], NEVER)
            best = np.minimum.reduceat(rank, ends - lengths)
            more = best < NEVER
            stays = np.repeat(more, lengths)
            done.append((pieces[~more], symbols[~stays], lengths[~more]))
            chosen = np.flatnonzero(stays & (rank == np.repeat(best, lengths)))
            first = np.diff(chosen, prepend=-2) > 1
            if not self.in_order:
                owner = np.searchsorted(ends, chosen, "right")
                chosen = chosen[np.diff(owner, prepend=-1) > 0]
            else:
                # Of equal symbols in a row, every other pair.
                since = np.arange(len(chosen)) - np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
                chosen = chosen[since % 2 == 0]
            symbols[chosen] = self.made[at[chosen]]
            stays[chosen + 1] = False
            gone = np.bincount(np.searchsorted(ends, chosen, "right"), minlength=len(pieces))
            symbols, pieces, lengths = symbols[stays], pieces[more], (lengths - gone)[more]
        owner = np.concatenate([np.repeat(p, n) for p, _, n in done])
        merged = np.concatenate([s for _, s, _ in done])[np.argsort(owner, kind="stable")]
        return merged, np.bincount(owner)


class Pieces(dict):
    """A number for each piece; ``new`` lists those that have none of their symbols yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = found = len(self)
        self.new.append(piece)
        return found


class Encoder:
    """Cuts texts into pieces and looks up their ids, merging those it has not met together."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.vocabulary = Vocabulary(json.loads(tokenizer_json))
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(self.vocabulary.added, key=len, reverse=True))) + ")" if self.vocabulary.added else r"(?!)")
        self._tabulate()
        self.runs: dict[str, list[str]] = {}
        self._forget()

    def _tabulate(self) -> None:
        cut, low = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.normalizer.normalize_str
        kinds: dict[int, list[str]] = {}
        for c in map(chr, range(PLAIN)):
            # Between letters: one piece with a letter, four with digits, three with other signs, two around a blank.
            found = cut(f"a{c}{c}b")
            kinds.setdefault(len(found), []).append(re.escape(c))
        letters, digits, blanks = ("".join(kinds[k]) for k in (1, 4, 2))
        pattern = self.vocabulary.pattern.replace(r"\p{L}", letters).replace(r"\p{N}", digits).replace(r"\s", blanks)
        self.plain = re.compile(pattern)
        self.blank = re.compile(f"[{blanks}]")
        self.other = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")
        self.composed = re.compile(f"[^\\x00-{chr(SINGLE - 1)}]")
        # Characters whose lower case Python and the tokenizer see differently go the tokenizer's way too.
        unlike = "".join(re.escape(c) for c in map(chr, range(SINGLE)) if low(c) != c.lower() and not self.blank.match(c))
        if unlike:
            self.composed = re.compile(f"[^\\x00-{chr(SINGLE - 1)}]|[{unlike}]")

    def _forget(self) -> None:
        self.pieces, self.symbols = Pieces(), np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _cut_run(self, run: str) -> list[str]:
        found = self.runs.get(run)
        if found is None:
            if len(self.runs) > REMEMBERED:
                self.runs.clear()
            found = [run[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(run)]
            self.runs[run] = found
        return found

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The normalized pieces of a text without added tokens."""
        at = 0
        while at < len(text):
            stop = self.blank.search(text, at + SLICE) if len(text) - at > SLICE else None
            end = stop.start() if stop else len(text)
            some = text[at:end] if at or stop else text
            at = end
            if some.isascii() or not self.composed.search(some):
                some = some.lower()
            else:
                some = self.tokenizer.normalizer.normalize_str(some)
            if some.isascii() or not self.other.search(some):
                yield self.plain.findall(some)
            else:
                for run in self.blank.split(some):
                    yield self._cut_run(run) if self.other.search(run) else self.plain.findall(run)

    def codes(self, text: str) -> list[np.ndarray]:
        """Numbers of the pieces of a text, added tokens among them."""
        out = []
        for k, part in enumerate(self.added.split(text)):
            for found in [[part]] if k % 2 else self._cut(part):
                out.append(np.fromiter(map(self.pieces.__getitem__, found), np.int64, len(found)))
        return out

    def _learn(self) -> None:
        """Merge all new pieces together."""
        new, known, self.pieces.new = self.pieces.new, self.vocabulary, []
        if not new:
            return
        raw = [p.encode() for p in new]
        lengths = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(lengths)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = known.inner[flat]
        symbols[ends - 1] = known.last[flat[ends - 1]]
        symbols, lengths = known.merge(symbols, lengths)
        for i, piece in enumerate(new):
            if piece in known.added:  # the pattern never matches one of these as a whole
                starts = np.cumsum(lengths) - lengths
                symbols[starts[i]] = known.added[piece]
                keep = np.ones(len(symbols), bool)
                keep[starts[i] + 1:starts[i] + lengths[i]] = False
                symbols, lengths[i] = symbols[keep], 1
        self.symbols = np.concatenate([self.symbols, symbols.astype(np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def encode(self, coded: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and where each begins and the last ends."""
        self._learn()
        counts = [sum(map(len, c)) for c in coded]
        codes = np.concatenate([a for c in coded for a in c] or [np.empty(0, np.int64)])
        lengths = self.starts[codes + 1] - self.starts[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.symbols[np.repeat(self.starts[codes] - ends[:-1], lengths) + np.arange(ends[-1])]
        if len(self.pieces) > REMEMBERED:
            self._forget()
        return ids, ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_json: str) -> Encoder:
    """One per Python worker, so that its tasks share the pieces they have met."""
    return Encoder(tokenizer_json)


def _description(tokenizer_path: str) -> str:
    with open(tokenizer_path, encoding="utf-8") as source:
        content = source.read()  # the vocabulary, of a size that does not depend on the corpus
    Vocabulary(json.loads(content))
    return content


def encode_texts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per row of ``docs``: doc_id and ids (array of int), as the tokenizers library encodes the whole
    text without adding tokens; added tokens that stand in a text are met.

    Null and empty texts have no ids; null ids and repeated rows stay as they are; other columns are
    ignored; an empty table gives none. A tokenizer whose description the rounds can't follow is refused.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_description(tokenizer_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)

        def finish(doc_ids: pa.Array, coded: list[list[np.ndarray]]) -> pa.RecordBatch:
            ids, ends = encoder.encode(coded)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            return pa.RecordBatch.from_arrays([doc_ids, lists], names=["doc_id", "ids"])

        for batch in batches:
            begun, coded, held = 0, [], 0
            for i, text in enumerate(batch.column(1)):
                coded.append(encoder.codes(text.as_py() or ""))
                held += sum(map(len, coded[-1]))
                if held > FLUSH:
                    yield finish(batch.column(0)[begun:i + 1], coded)
                    begun, coded, held = i + 1, [], 0
            if coded:
                yield finish(batch.column(0)[begun:], coded)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per row of ``encoded``: doc_id, ids and decoded, the tokens' strings joined by blanks, as the
    library does for a description without a decoder.

    Null lists and lists without ids give an empty text; null and unknown ids are passed over.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(json.loads(_description(tokenizer_path))).names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        for whole in batches:
            # A few rows at a time; a text of any length is one value all the same.
            sizes = pc.fill_null(pc.list_value_length(whole.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            turns = np.cumsum(sizes) // FLUSH
            starts = np.flatnonzero(np.diff(turns, prepend=-1))
            for a, b in zip(starts, [*starts[1:], whole.num_rows]):
                batch = whole.slice(a, b - a)
                values = pc.list_flatten(batch.column(1))
                fits = np.asarray(pc.fill_null(pc.and_(pc.greater_equal(values, 0), pc.less(values, len(names))), False))
                tokens = names.take(values.filter(pa.array(fits)))
                real = np.asarray(tokens.is_valid())
                fits[np.flatnonzero(fits)[~real]] = False
                seen = np.concatenate([[0], np.cumsum(fits)])
                ends = seen[np.concatenate([[0], np.cumsum(sizes[a:b])])]
                lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tokens.filter(pa.array(real)))
                joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), joined], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded string")


def op11_bpe_codec(spark: SparkSession, folder: str, tokenizer_path: str | None = None) -> DataFrame:
    """Number and digest of the ids of every whole text, and digest of what they decode to.

    Nulls, empty texts and empty tables are as in ``encode_texts`` and ``decode_ids``.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    found = decode_ids(encode_texts(table(spark, folder, "documents"), tokenizer_path), tokenizer_path)
    numbers = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
