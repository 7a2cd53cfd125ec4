"""What the operators on text hold at once, and work they must not repeat."""

import numpy as np
import pyarrow as pa

from siltline.llm import contamination, mixing, substrings, tokens
from siltline.llm.common import Workspace


def test_rows_are_searched_in_parts_of_bounded_text():
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": ["a" * 5, None, "", "b" * 20, "c", None, "dd"]})
    parts = list(contamination.parts_of(batch, 1, 6))
    assert [p.num_rows for p in parts] == [3, 4]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert sum(p.num_rows for p in contamination.parts_of(batch.slice(2, 0), 1, 6)) == 0


def test_terms_share_the_memory_of_word_hashes():
    words = [b"one", b"two", b"one", b"three"]
    posted = np.zeros(contamination.SLOTS >> 3, np.uint8)
    plain = contamination.Terms().of(words)
    slot = int(plain[0]) & (contamination.SLOTS - 1)
    posted[slot >> 3] |= 1 << (slot & 7)
    assert contamination.Terms(posted).of(words).tolist() == [plain[0], 0, plain[0], 0]
    assert b"three" in contamination.word_hashes()
    assert len(contamination.Terms(posted).of([])) == 0


def test_gram_hashes_equal_the_polynomial():
    words = np.random.default_rng(1).integers(0, 1 << 64, 100, dtype=np.uint64)
    mask = (1 << 64) - 1
    for size in (substrings.GRAM, 100):
        expected = []
        for i in range(size - substrings.GRAM + 1):
            value = 0
            for w in words[i:i + substrings.GRAM].tolist():
                value = (value * substrings.FACTOR + w) & mask
            expected.append(value)
        assert substrings.gram_hashes(words[:size]).tolist() == expected


def test_only_new_pieces_are_learnt(monkeypatch):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        encoder = tokens.PieceEncoder(source.read(), "<u2")
    learnt, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces: (learnt.append(set(pieces)), learn(pieces)))
    monkeypatch.setattr(tokens, "CACHED", 3)
    whole = encoder.tokenizer
    for text in ("some words here", "some words there", "some words there again now", "some words here"):
        got = np.frombuffer(encoder.encode(text), "<u2").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids
    assert learnt[:2] == [{"some", " words", " here"}, {" there"}]


def test_a_raking_step_joins_its_sums_once(spark, monkeypatch):
    frame = spark.createDataFrame([("a", "en", "note", 9), ("a", None, "book", 4), ("b", "en", "book", 2)], "source string, lang string, topic string, tokens long")
    joins, keep = {}, Workspace.keep

    def counted(self, df, name):
        joins[name] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return keep(self, df, name)

    monkeypatch.setattr(Workspace, "keep", counted)
    assert mixing.rake(frame, Workspace(spark, "test"), sweeps=2).count() == 3
    # The driver holds threads for every join's exchanges: one join a margin for the goals, one a step.
    assert sum(joins.values()) == 3 + 2 * 3
    assert max(n for name, n in joins.items() if name != "cells-0") == 1
