"""Fill-in-the-middle transformation with cuts between units, found by arithmetic on whole words of bytes.

A unit is a run of other characters with the ASCII white space before it, or white space at the end
of the text. Texts lie one behind the other as 64-bit words, each padded with blanks to a whole
number of them. Blanks are marked in the high bits of all eight bytes at once; a byte that is none and
has one behind it ends a unit. Counting the marks per word and their prefix sums lead to the word of
any unit's end, clearing marks inside it to its byte. Beyond ASCII every byte is above 0x7F, so ends
never fall into a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CHUNK = 8 << 20  # bytes of text that are marked at a time; a longer text is a chunk of its own


def _all(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


def unit_ends(words: np.ndarray) -> np.ndarray:
    """Per word the high bits of the bytes that end a unit; behind the last word a blank is assumed."""
    low = words & _all(0x7F)
    blank = ~((low ^ _all(0x20)) + _all(0x7F))
    control = (low + _all(0x80 - 0x09)) & ~(low + _all(0x80 - 0x0E))
    blank = (blank | control) & ~words & _all(0x80)
    behind = np.append(blank[1:], _all(0x80)) << np.uint64(56)
    return ~blank & ((blank >> np.uint64(8)) | behind) & _all(0x80)


class Units:
    """The units of texts; ``count`` has how many each has."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        padded = [t.ljust(len(t) // 8 * 8 + 8) for t in texts]
        self.begin = np.concatenate([[0], np.cumsum(sizes // 8 + 1)])
        self.ends = unit_ends(np.frombuffer(b"".join(padded), "<u8"))
        self.marks = np.bitwise_count(self.ends).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(self.marks)])
        self.marked = np.diff(self.before[self.begin])
        trailing = np.array([t[-1:].isspace() for t in texts], bool)  # the same six characters in bytes
        self.sizes, self.count = sizes, self.marked + trailing

    def offsets(self, texts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Where the given number of units ends in each of the given texts, in bytes."""
        inside = np.flatnonzero((units > 0) & (units <= self.marked[texts]))
        out = np.where(units > 0, self.sizes[texts], 0)
        rank = self.before[self.begin[texts[inside]]] + units[inside]
        word = np.searchsorted(self.before, rank, "left") - 1
        rank, bits = rank - self.before[word], self.ends[word]
        for passed in range(1, 8):
            bits = np.where(rank > passed, bits & (bits - np.uint64(1)), bits)
        byte = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
        out[inside] = (word - self.begin[texts[inside]]) * 8 + byte + 1
        return out


def fill_in_middle(docs: DataFrame, seed: str = "42", rate: int = 50, suffix_first: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars, output.

    The hash of ``seed``, a colon and the id decides everything, so repeated rows agree, and a null id counts as
    an empty one. Of 100 hashes ``rate`` are transformed, of these ``suffix_first`` of 100 with the suffix first
    (``spm``, else ``psm``). Null texts are as empty ones: plain, as are texts that hold a sentinel; plain ones
    have null lengths. Other columns are ignored; an empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def transform(ids: pa.Array, texts: list[bytes], draws: np.ndarray) -> pa.RecordBatch:
        units = Units(texts)
        n = units.count
        cuts = np.sort(draws[:2] % (n + 1), axis=0)
        moved = np.array([bool(t) and not (PREFIX in t or SUFFIX in t or MIDDLE in t) for t in texts], bool) & (draws[2] % 100 < rate)
        chosen = np.flatnonzero(moved)
        first, second = (units.offsets(chosen, c[chosen]).tolist() for c in cuts)
        outputs, forms = list(texts), ["plain"] * len(texts)
        lengths: list[list[int | None]] = [[None] * len(texts), [None] * len(texts)]
        for i, a, b, late in zip(chosen.tolist(), first, second, (draws[3][chosen] % 100 < suffix_first).tolist()):
            prefix, middle, suffix = texts[i][:a], texts[i][a:b], texts[i][b:]
            forms[i] = "spm" if late else "psm"
            halves = (SUFFIX, suffix, PREFIX, prefix) if late else (PREFIX, prefix, SUFFIX, suffix)
            outputs[i] = b"".join((*halves, MIDDLE, middle))
            lengths[0][i], lengths[1][i] = len(prefix.decode("utf-8", "replace")), len(middle.decode("utf-8", "replace"))
        columns = [ids, pa.array(n, pa.int64()), pa.array(forms), *(pa.array(x, pa.int64()) for x in lengths), pa.array(outputs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            draws = np.array([batch.column(i).to_numpy() for i in range(2, 6)])
            turns = np.cumsum([len(t) for t in texts]) // CHUNK
            starts = np.flatnonzero(np.diff(turns, prepend=-1)).tolist()
            for a, b in zip(starts, [*starts[1:], len(texts)]):
                yield transform(batch.column(0)[a:b], texts[a:b], draws[:, a:b])

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    found = docs.select("doc_id", F.col("text").cast("binary"), *draws).mapInArrow(run, schema)
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text from which ``output`` was made. Only plain texts hold sentinels of their own."""
    p, s, m = (F.position(F.lit(x.decode()), output) for x in (PREFIX, SUFFIX, MIDDLE))
    # Parts run from behind their own sentinel to the next one.
    prefix = output.substr(p + 3, F.when(form == "psm", s).otherwise(m) - p - 3)
    suffix = output.substr(s + 3, F.when(form == "psm", m).otherwise(p) - s - 3)
    middle = output.substr(m + 3, F.length(output))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Units, form, lengths and digests of all documents; odd rows are as in ``fill_in_middle``."""
    made = fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
    ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS h1, ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS h2,
    ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS h4
  FROM cut
), parts AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 50 THEN 'plain'
      WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(h1, h2)], '') AS prefix,
    array_to_string(units[least(h1, h2) + 1:greatest(h1, h2)], '') AS middle,
    array_to_string(units[greatest(h1, h2) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
