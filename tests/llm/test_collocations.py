"""Phrase mining against a plain count of all phrases."""

import re
from collections import Counter

import compare
import numpy as np
import pytest
from test_llm import FOLDER, nothing, odd  # noqa: F401

from siltline.llm import collocations, queries
from siltline.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    return f, n


def mined(rows, least, top):
    f, n = counted(rows)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    hidden = set()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            hidden |= {(lang, w[i:i + k]) for i in range(len(w) - k + 1) if a >= f[lang, w[i:i + k]]}
    scored = {}
    for (lang, w), a in candidates.items():
        if (lang, w) not in hidden:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in scored.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    )


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, FOLDER, "documents")


@pytest.mark.parametrize("least, top, bits", [(4, 50, 64), (3, 10**6, 64), (12, 40, 13), (25, 10**6, 9)])
def test_phrases_equal_brute_force(spark, documents, least, top, bits):
    """With few bits nearly all fingerprints collide, so that they are counted again by their words."""
    expected = mined([(r.text, r.lang) for r in documents.select("text", "lang").collect()], least, top)
    got = collocations.collocations(documents, least, top, bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == expected
    assert expected


def test_phrases_of_odd_rows(spark, odd, nothing):  # noqa: F811
    rows = odd.select("text", "lang").collect() + [("a a a a, a a\tA", None), ("x. x\x0bx", ""), ("é\xa0b é\xa0b . \x00 \x00 \x00", "en")] * 3
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "text string, lang string")
    assert sorted(map(tuple, collocations.collocations(docs, 2, 10**6).collect())) == mined([(r[0], r[1]) for r in rows], 2, 10**6)
    assert collocations.collocations(nothing).collect() == []
    assert collocations.collocations(odd, least=10**9).collect() == []


def test_long_texts_are_cut_behind_breaks():
    import pyarrow as pa

    text = b"one two three. " * 50 + b"no break " * 30
    rows = pa.RecordBatch.from_pydict({"doc": [7], "lang": ["en"], "text": pa.array([text], pa.binary())})
    whole = list(collocations._chunks([rows], 64))
    old, collocations.CHUNK = collocations.CHUNK, 40
    try:
        cut = list(collocations._chunks([rows], 64))
    finally:
        collocations.CHUNK = old
    assert len(whole) == 1 and len(cut) > 10
    assert b" ".join(b" ".join(c.words[i] for i in c.code if i) for c in cut).split() == b" ".join(whole[0].words[i] for i in whole[0].code if i).split()


def test_fold_notices_different_words_behind_equal_fingerprints():
    chunk = collocations.Chunk([1, 2], ["en", "en"], [b"a b", b"c d"], 64)
    at, weights = chunk.places(1, None, None)
    same = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int32)
    chunk.prints = lambda at, n: (same[0][:len(at)], same[1][:len(at)])
    found = chunk.fold(at, 1, weights)
    assert len(found["fp"]) == 1 and found["low"][0] >> 32 < found["high"][0] >> 32 and found["n"][0] == 4
    places, counts = chunk.distinct(at, 1, weights)
    assert sorted(chunk.phrase(p, 1) for p in places[counts > 0]) == ["a", "b", "c", "d"]


def test_phrases_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op12_collocations"](spark, folder)
    assert compare.difference(got, compare.duck(folder), queries.SQL["op12_collocations"]) is None
