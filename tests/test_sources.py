"""Delimited files: splits, encodings, headers, settings, inventory and quarantine."""

import csv
import random

import pytest

from siltline.plans import config, inventory, layers, pipeline
from siltline.sources import delimited, files
from siltline.sources.exports import ExportProfile, open_export


@pytest.fixture
def small_splits(spark):
    """Cut files every 200 bytes and batches every 7 lines."""
    values = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    old = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def expected_records(path, encoding):
    with open(path, newline="", encoding=encoding) as source:
        reader = csv.reader(source)
        return [(number, reader.line_num, row) for number, row in enumerate(reader, 1)]


def write_random(path, encoding, eol, count, seed):
    rng = random.Random(seed)
    pieces = [
        "a", "bb", 'q"x', "line\nbreak", "cr\r\nlf", "é", "", "x,y", '"', "long" * 30 + "\n" + "t" * 450 + "\n\n\nend", "lone\rcr",
    ]
    with open(path, "w", encoding=encoding, newline="") as out:
        writer = csv.writer(out, lineterminator=eol)
        for _ in range(count):
            if rng.random() < 0.1:
                out.write(eol)
            else:
                writer.writerow([rng.choice(pieces) for _ in range(rng.randint(1, 4))])
        out.write('weird,ab"c,"d"e' + eol)
        if count % 2:
            out.write('open,"never closed' + eol + "more" + eol)


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_records_equal_a_sequential_read_for_any_split(spark, tmp_path, small_splits, broadcast):
    made = []
    for i, (encoding, eol, count) in enumerate(
        [("utf-8", "\n", 60), ("cp1252", "\r\n", 45), ("utf-8-sig", "\r\n", 30), ("latin-1", "\n", 81), ("utf-8", "\n", 1)]
    ):
        path = tmp_path / f"f {i}.csv"
        write_random(path, encoding, eol, count, seed=i)
        made.append((str(path), "cp1252" if encoding == "latin-1" else encoding))
    rows = delimited.read_records(spark, [p for p, _ in made], broadcast_splits=broadcast).collect()
    for path, encoding in made:
        got = sorted((r.record_no, r.line_no, list(r.fields)) for r in rows if r.source_file == path)
        assert got == expected_records(path, encoding), path


def test_undecodable_cp1252_falls_back_to_latin1(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes(b"a,b\n\x81,\xe9\n")
    rows = delimited.read_records(spark, [str(path)]).orderBy("record_no").collect()
    assert list(rows[1].fields) == ["\x81", "\xe9"]


def test_a_changed_file_is_noticed(spark, tmp_path):
    path = tmp_path / "grow.csv"
    path.write_text("a,b\n1,2\n")
    index = delimited.split_index(delimited.raw_lines(spark, [str(path)]), ",")
    path.write_text("a,b\n1,2\n3,4\n")
    with pytest.raises(Exception, match="changed between the two passes"):
        delimited.read_records(spark, [str(path)], index=index).collect()


def export(spark, path, **options):
    options.setdefault("column_mappings", {})
    return open_export(spark, ExportProfile(source_files=(str(path),), **options))


def test_header_after_a_preamble(spark, tmp_path):
    path = tmp_path / "tides.csv"
    path.write_text("Harbour survey,,\nas of,noon,\nmade by,pier 4,\nGauge,Read At,Depth m\nG7,2019-08-30,3.25\n")
    opened = export(spark, path, canonicalize_headers=True, header_row_number=4)
    assert opened.columns == ["Gauge", "Read_At", "Depth_m"]
    result = layers.profile_export(opened, ExportProfile((str(path),)))
    assert (result.row_count, result.malformed_row_count) == (1, 0)
    assert [r.column_name for r in result.columns.orderBy("ordinal_position").collect()] == opened.columns


def test_duplicate_and_blank_headers(spark, tmp_path):
    path = tmp_path / "twice.csv"
    path.write_text("Load,Pump,,Load,Load\n7,p,q,8,9\n")
    assert export(spark, path, canonicalize_headers=True).columns == ["Load", "Pump", "Column_003", "Load_2", "Load_3"]


def test_trailing_blanks_headerless_and_errors(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("A,B, ,\n1,2,,\n3,4,x\n\n , \n5\n")
    opened = export(spark, path)
    assert opened.columns == ["A", "B"]
    assert sorted(list(r.fields) for r in opened.good().collect()) == [["1", "2"]]
    assert opened.records.where("is_malformed").count() == 2
    bare = export(spark, path, has_header=False)
    assert bare.columns[:2] == ["Column_001", "Column_002"] and len(bare.columns) == 4
    with pytest.raises(ValueError, match="no record 99"):
        export(spark, path, header_row_number=99)
    with pytest.raises(ValueError, match="at least 1"):
        export(spark, path, header_row_number=0)
    with pytest.raises(ValueError, match="VARCHAR"):
        ExportProfile.from_config({"source_file": "x", "column_sql_types": {"A": "INT"}})
    with pytest.raises(ValueError, match="255"):
        export(spark, "/" + "x" * 300)


def test_gates(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n3\n")
    (tmp_path / "b.csv").write_text("A,B\n1,2\n")
    both = (str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    profile = ExportProfile(both)
    with pytest.raises(ValueError, match="exceeds the allowed 0"):
        layers.profile_export(open_export(spark, profile), profile)
    lenient = layers.profile_export(open_export(spark, profile), profile, enforce=False)
    assert (lenient.row_count, lenient.malformed_row_count, lenient.malformed_threshold_exceeded) == (2, 1, True)
    (tmp_path / "b.csv").write_text("B,A\n1,2\n")
    with pytest.raises(ValueError, match="header drift"):
        layers.profile_export(open_export(spark, profile), profile, enforce=False)
    (tmp_path / "b.csv").write_text("A,B\n")
    with pytest.raises(ValueError, match="no data rows"):
        layers.profile_export(open_export(spark, profile), profile, enforce=False)
    (tmp_path / "b.csv").write_text("")
    with pytest.raises(ValueError, match="only 1 of 2 files"):
        layers.profile_export(open_export(spark, profile), profile, enforce=False)


def test_header_lines_end_only_at_line_ends(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('a\x0cb,"c\nd",e\u2028f\n1,2,3\n', encoding="utf-8")
    assert files.read_header(spark, str(path)) == ["a\x0cb", "c\nd", "e\u2028f"]
    assert list(files.file_settings(spark, [str(path)], ",").first().header) == ["a\x0cb", "c\nd", "e\u2028f"]


def test_labels():
    assert files.resolve_paths({"source_files": ["/d/b.csv", "/d/a.csv"]}) == ["/d/a.csv", "/d/b.csv"]
    with pytest.raises(ValueError):
        files.resolve_paths({})
    assert files.source_label(["/data/sys/A/1.csv", "/data/sys/B/2.csv"]) == ("MULTI_FILE::2 files::/data/sys", "/data/sys")
    assert files.source_label(["/data/1.csv"]) == ("/data/1.csv", "/data")


def test_settings_and_listing(spark, tmp_path):
    (tmp_path / "pipe.csv").write_text("a|b|c\n" + "1|2|3\n" * 20)
    (tmp_path / "tab.TXT").write_text("a\tb\n" + "1\t2\n" * 20)
    (tmp_path / "latin.csv").write_bytes("n\xe4me;wert\n".encode("latin-1") * 5)
    (tmp_path / "cut.csv").write_text("é" * 9000 + ",b\n")
    found = {r.source_file.rsplit("/", 1)[1]: r for r in files.file_settings(spark, [str(tmp_path)]).collect()}
    assert {name: row.delimiter for name, row in found.items()} == {"pipe.csv": "|", "tab.TXT": "\t", "latin.csv": ";", "cut.csv": ","}
    assert found["latin.csv"].encoding == "cp1252" and found["cut.csv"].encoding == "utf-8-sig"
    assert list(found["latin.csv"].header) == ["n\xe4me", "wert"]
    assert sorted(r.file_name for r in files.list_files(spark, str(tmp_path), ("txt",)).collect()) == ["tab.TXT"]


def test_variant_config(spark, tmp_path):
    for week, head, row in ((31, "Seen. On,Ring,Ring,", "a,b,c,d"), (32, "Seen. On,Ring,Ring,", "e,f,g,h"), (33, "Seen. On,Ring,Ring,,Site", "i,j,k,l,m")):
        (tmp_path / f"wk{week}_GULLS.csv").write_text(f"{head}\n{row}\n")
    built = config.build_config(spark, str(tmp_path), prefix=r"^wk\d+_", split_variants=True, canonicalize_headers=True, include_staging=True)
    widths = {name: len(entry["preload_profile"]["column_mappings"]) for name, entry in built.items()}
    assert set(widths) == {"GULLS_V01", "GULLS_V02"} and sorted(widths.values()) == [4, 5]
    narrow = built[min(widths, key=widths.get)]
    assert list(narrow["preload_profile"]["column_mappings"]) == ["Seen_On", "Ring", "Ring_2", "Column_004"]
    assert len(narrow["preload_profile"]["source_files"]) == 2
    assert narrow["source_entity"] == "GULLS" and narrow["staging_table"].startswith("stg.GullsV0")


def test_config_groups_entities_across_folders(spark, tmp_path):
    for place in ("north shore", "south", "isle"):
        (tmp_path / place).mkdir()
        (tmp_path / place / "BUOYS_03052021_04052021.csv").write_text("BUOY,LIT\nB2,yes\n")
    (tmp_path / "isle" / "KEEPERS_03052021_04052021.csv").write_text("KEEPER,SHIFT\nIda,night\n")
    built = config.build_config(spark, str(tmp_path))
    assert {name: len(entry["preload_profile"]["source_files"]) for name, entry in built.items()} == {"BUOYS": 3, "KEEPERS": 1}
    assert built["BUOYS"]["source_table"] == "raw.BUOYS"


def test_folder_analysis(spark, tmp_path):
    (tmp_path / "2023 X.csv").write_text("A,B\n1,2\n")
    (tmp_path / "2024 X.csv").write_text("A,B,C\n1,2,3\n")
    entities, shapes, described = config.analyze_folder(spark, str(tmp_path), delimiter=",", prefix=r"^\d{4}\s+")
    row = entities.first()
    assert (row.entity_name, row.variant_count, row.recommendation) == ("X", 2, "schema_variant_review_required")
    assert list(row.canonical_union_columns) == ["A", "B", "C"]
    assert shapes.count() == 2 and described.count() == 2


def test_inventory(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "bad.csv").write_text("a,a,\n1,,x\n1,,x\n\n5\n")
    (tmp_path / "empty.csv").write_text("")
    described, columns, issues, samples = inventory.inventory(spark, str(tmp_path), delimiter=",", sample_rows=1)
    status = {r.file_name: r for r in described.collect()}
    assert status["good.csv"].status == "ok" and status["empty.csv"].status == "empty_file"
    bad = status["bad.csv"]
    assert (bad.data_row_count, bad.malformed_row_count, bad.blank_row_count, bad.duplicate_data_row_count) == (2, 1, 1, 1)
    assert list(bad.status_reasons) == ["duplicate_data_rows", "duplicate_headers", "empty_headers", "high_blank_ratio", "malformed_rows"]
    assert issues.where("issue_type = 'high_blank_ratio'").first().message == "Column 'a' is blank in 100.0% of observed rows."
    assert columns.count() == 5 and samples.count() == 2


def test_quarantine_after_a_header_offset(spark, tmp_path):
    path = tmp_path / "night_log.csv"
    path.write_text("log of the watch\nkept by hand\nHour,Wind,Sea\n1,SW,calm\n2,W,calm\n3,W\n4,NW,rough\n")
    rows = pipeline.quarantine_export(export(spark, path, header_row_number=3), "NightLog", context=1).collect()
    assert {r.malformed_group_id for r in rows} == {"night_log:row:6"}
    assert sorted((r.relative_offset, r.row_role, r.raw_line_text) for r in rows) == [
        (-1, "before", "2,W,calm"), (0, "malformed", "3,W"), (1, "after", "4,NW,rough"),
    ]


def test_quarantine_matches_a_sequential_walk(spark, tmp_path):
    """Groups built by joins equal groups built by walking the file once."""
    rng = random.Random(3)
    path = tmp_path / "walk.csv"
    lines = ["A,B"]
    for i in range(120):
        lines.append(rng.choice(["1,2", "1,2", "x", '"m\nn",2', "", ",,", "1,2,3"]))
    path.write_text("\n".join(lines) + "\n")
    width, k = 2, 3
    records = []
    for number, line, row in expected_records(path, "utf-8")[1:]:
        kept = row[:width] if len(row) > width and not any(v.strip() for v in row[width:]) else row
        records.append((number, line, bool(any(v.strip() for v in row)) and len(kept) != width))
    expected = []
    for at, (_, center, bad) in enumerate(records):
        if bad:
            for other in range(max(0, at - k), min(len(records), at + k + 1)):
                offset = records[other][1] - center
                if other <= at or offset <= k:
                    expected.append((f"walk:row:{center}", offset, int(records[other][2])))
    rows = pipeline.quarantine_export(export(spark, path), "w", context=k).collect()
    assert sorted((r.malformed_group_id, r.relative_offset, r.is_malformed) for r in rows) == sorted(expected)


def test_negative_context_is_refused(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("A\n1\n")
    with pytest.raises(ValueError):
        pipeline.quarantine_export(export(spark, path), "w", context=-1)
