"""BPE encoding against the tokenizers library, and fill-in-the-middle against a plain rendering."""

import hashlib
import json
import random
import re

import compare
import numpy as np
import pyspark.sql.functions as F
import pytest
from test_llm import FOLDER, nothing, odd, pairs  # noqa: F401

from siltline.llm import bpe, infill, queries
from siltline.llm.common import table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def encoder(path):
    with open(path, encoding="utf-8") as source:
        return bpe.Encoder(source.read())


def encoded(encoder, texts):
    ids, ends = encoder.encode([encoder.codes(t) for t in texts])
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def test_codec_query_equals_library(spark, library):
    expected = []
    for doc_id, text in pairs(table(spark, FOLDER, "documents")):
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, queries.QUERIES["op11_bpe_codec"](spark, FOLDER).collect())) == sorted(expected)


def test_codec_of_odd_rows(spark, library, path, odd, nothing):  # noqa: F811
    found = bpe.decode_ids(bpe.encode_texts(odd, path), path)
    assert found.columns == ["doc_id", "ids", "decoded"]
    rows = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in pairs(odd)]
    expected = [(i, ids, library.decode(ids, skip_special_tokens=False)) for i, ids in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert bpe.decode_ids(bpe.encode_texts(nothing, path), path).collect() == []


def test_decoding_passes_over_unknown_ids(spark, path, library):
    rows = spark.createDataFrame([(1, [320, None, -1, 10**9, 49407]), (2, None), (3, []), (4, [320])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode_ids(rows, path).collect()}
    assert got == {1: library.decode([320, 49407], skip_special_tokens=False), 2: "", 3: "", 4: library.decode([320], skip_special_tokens=False)}


def test_every_character_is_cut_as_in_the_library(encoder, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f(points[k:k + 400]) for k in range(0, len(points), 400) for f in (" ".join, "a".join, lambda s: "".join(f"x{c}{c}Y {c}'S" for c in s))]
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_mixtures_and_long_pieces(encoder, library):
    rng = random.Random(11)
    parts = ["a", "b", "'s", "'S", "'LL", " ", "\t", "é", "é", "ΑΣ ", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "12", "٣", "中文", "\x1c", "\x85", "한", "!!", ".", "\n\n", "\U0001F600", "aaa", "the"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)]
    texts += ["a" * 5001, "".join(rng.choices("abcdefghij", k=20_000)), "ab" * 3001, "中" * 1000]
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_slices_and_forgetting_change_nothing(encoder, library, monkeypatch):
    text = "The quick (brown) fox's naïve café, 12 \U0001F600 <|endoftext|> jumps " * 300
    monkeypatch.setattr(bpe, "SLICE", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for some in (text, "x" * 50, " ", text[5:]):
        assert encoded(encoder, [some]) == [library.encode(some, add_special_tokens=False).ids]


def test_vocabulary_out_of_order_merges_leftmost_first(path):
    with open(path, encoding="utf-8") as source:
        description = json.load(source)
    description["model"]["merges"] = description["model"]["merges"][:3000][::-1]
    from tokenizers import Tokenizer

    turned = json.dumps(description)
    encoder, library = bpe.Encoder(turned), Tokenizer.from_str(turned)
    assert not encoder.vocabulary.in_order
    rng = random.Random(5)
    texts = ["".join(rng.choices("aeinorst", k=30)) for _ in range(300)] + ["interesting mathematics of the others"]
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_other_descriptions_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source, pytest.raises(ValueError, match="this encoder needs"):
        bpe.Vocabulary(json.load(source))


# ---- 13

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def rendered(doc_id, text, seed="42", rate=50, suffix_first=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    late = h[3] % 100 < suffix_first
    return doc_id, len(units), "spm" if late else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if late else f"<P>{p}<S>{s}<M>{m}"


def test_infill_of_odd_rows(spark, odd, nothing):  # noqa: F811
    texts = ["<S> in it", "<P", "<M", "< S>", "a<", "  lead", "trail \n", "\x1c\x1f\x85  one", "é ü\tñ", "x" * 9, "eight ch", "sixteen chars  !", "\x00 \x7f", "\U0001F600 \U0001F600"]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts * 8)], "doc_id long, text string")
    for rows in (odd.select("doc_id", "text"), more):
        made = infill.fill_in_middle(rows)
        assert sorted(map(tuple, made.collect()), key=repr) == sorted((rendered(*p) for p in pairs(rows)), key=repr)
        back = made.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("text"))
        assert sorted(pairs(back), key=repr) == sorted(((i, t or "") for i, t in pairs(rows)), key=repr)
    assert infill.fill_in_middle(odd).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert infill.fill_in_middle(nothing).collect() == []


def test_infill_with_other_rates(spark, monkeypatch):
    monkeypatch.setattr(infill, "CHUNK", 64)
    rows = table(spark, FOLDER, "documents").select("doc_id", "text")
    got = infill.fill_in_middle(rows, seed="s", rate=100, suffix_first=30)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((rendered(i, t, "s", 100, 30) for i, t in pairs(rows)), key=repr)


def test_unit_ends_of_every_byte_pair():
    blank = {0x20, *range(0x09, 0x0E)}
    flat = np.array([(a, b) for a in range(256) for b in range(256)], np.uint8).ravel()
    flat = np.concatenate([flat, np.full(8, 0x20, np.uint8)])
    marks = infill.unit_ends(flat.view("<u8")).view(np.uint8)
    expected = [0x80 if flat[i] not in blank and (i + 1 == len(flat) or flat[i + 1] in blank) else 0 for i in range(len(flat))]
    assert marks.tolist() == expected


def test_infill_query_equals_sql(spark):
    assert compare.difference(queries.QUERIES["op13_fill_in_middle"](spark, FOLDER), compare.duck(FOLDER), queries.SQL["op13_fill_in_middle"]) is None
