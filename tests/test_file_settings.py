"""Settings of files from their first bytes: the same as from a scan, and bounded reads."""

import io

import pytest
from pyspark.sql import functions as F

from siltline.sources import files

CONTENTS = {
    "plain.csv": b"A,B\n1,2\n",
    "no_end.csv": b"A;B\n1;2",
    "only_header.csv": b"A|B|C",
    "broken_lines.csv": b'"A\nfirst",B\r\n1,2\r\n',
    "bom.csv": b"\xef\xbb\xbfA\tB\n1\t2\n",
    "western.csv": "Größe,B\n1,é\n".encode("cp1252"),
    "long_header.csv": ",".join(f"column_{i:05d}" for i in range(3000)).encode() + b"\n" + b"1," * 2999 + b"1\n",
    "open_quote.csv": b'A,"B\n1,2\n3,4\n' * 400,
    "many.csv": b"A,B\n" + b"12345,67890\n" * 9000,
    "blank.csv": b"\n\n\n",
    "one_line.csv": b"x" * 40_000,
    "empty.csv": b"",
    "_hidden.csv": b"A,B\n1,2\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    home = tmp_path_factory.mktemp("settings")
    for name, content in CONTENTS.items():
        (home / name).write_bytes(content)
    return home


def rows(frame):
    """A scan is given no byte order mark, so only the reader of ranges can tell that there was one."""
    found = frame.withColumn("encoding_mode", F.when(F.col("source_file").endswith("/bom.csv"), "bom").otherwise(F.col("encoding_mode")))
    return sorted(map(repr, found.collect()))


def test_byte_order_mark_is_seen(spark, folder):
    assert files.file_settings(spark, [str(folder / "bom.csv")]).first().encoding_mode == "bom"


@pytest.mark.parametrize("delimiter", [None, ";"])
def test_settings_equal_those_of_a_scan(spark, folder, delimiter):
    expected = rows(files._scanned_settings(spark, [str(folder)], delimiter, 16384))
    assert len(expected) == len(CONTENTS) - 2
    assert rows(files.file_settings(spark, [str(folder)], delimiter)) == expected
    assert rows(files.file_settings(spark, [f"file:{folder}"], delimiter)) == expected
    listed = files.list_files(spark, str(folder))
    assert rows(files.file_settings(spark, listed.where("size_bytes > 0 AND NOT file_name LIKE '\\\\_%'"), delimiter)) == expected


class Counted(io.BytesIO):
    total = 0

    def read(self, n=-1):
        found = super().read(n)
        self.total += len(found)
        return found


@pytest.mark.parametrize("head", [b"A,B\n", b",".join(b"c%d" % i for i in range(30_000)) + b"\n", b'"' + b"line\n" * 20_000 + b'",B\n'])
def test_reads_are_bounded_by_sample_and_header(head):
    source = Counted(head + b"12345,67890\n" * 2_000_000)
    row = files.read_settings(source, "big.csv", ",", 16384)
    assert row.column("header")[0].as_py()[-1] in ("B", "c29999")
    assert source.total <= 16384 * 3 + 4 * len(head)


def test_missing_files_and_stores_of_other_kinds(spark, folder):
    with pytest.raises(Exception, match="FileNotFoundError|nothing_here"):
        files.file_settings(spark, [str(folder / "nothing_here.csv")]).collect()
    assert not files._opens("viewfs://store/in/a.csv") and files._opens("file:/a.csv") and files._opens("/a.csv")
    assert files.file_settings(spark, files.list_files(spark, str(folder)).limit(0)).collect() == []
