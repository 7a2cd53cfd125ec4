"""Layer jobs end to end on small files, audit trail, reviews and keys."""

import random
import re
from datetime import datetime
from decimal import Decimal
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from siltline import fixed
from siltline.operators import anomalies, checks, digest, harmonise, headers, history, profile, review, surrogate, tokens
from siltline.plans import layers, pipeline, reports
from siltline.plans.audit import Audit
from siltline.plans.config import Pipeline
from siltline.sources import exports

CSV = (
    "Vendor,PO-NUMBER,PaidAmount,InvoiceDate,Line Qty,Note\n"
    'V1,9558.0000,"$(1,234.56)",01-APR-22,2.000,"two\nlines"\n'
    "V2,77,10,1900-01-01,3.000,\n"
    "V3,78,5,31-OCT-24,4.000,  hi  \n"
)


def entry(tmp_path, name, content=CSV, **profile_options):
    path = tmp_path / f"{name}.csv"
    path.write_text(content)
    columns = content.splitlines()[0].split(",")
    return Pipeline.from_config(name, {
        "source_table": f"raw.{name}", "staging_table": f"stg.{name}", "target_table": f"zen.{name}",
        "preload_profile": {
            "source_files": [str(path)], "column_mappings": {c: c.replace(" ", "_") for c in columns}, "max_malformed_rows": 0,
            "has_header": True, "delimiter": ",", **profile_options,
        },
    })


@pytest.fixture(scope="module")
def audit(spark):
    return Audit(spark, "audit_test")


def test_full_run_then_append(spark, tmp_path, audit):
    p = entry(tmp_path, "Vendor")
    run = pipeline.run_pipeline(spark, p, audit=audit)
    raw = {r.Vendor: r for r in spark.table("raw.Vendor").collect()}
    assert raw["V1"].Note == "two lines" and raw["V2"].Note is None
    assert spark.table("raw.Vendor").columns[-2:] == fixed.RAW_METADATA
    staged = spark.table("stg.Vendor")
    assert staged.columns == ["Vendor", "PO_NUMBER", "PaidAmount", "InvoiceDate", "Line_Qty", "Note", "LoadDate", "SFileName", "AutoId"]
    rows = {r.Vendor: r for r in staged.collect()}
    assert (rows["V1"].PO_NUMBER, rows["V1"].PaidAmount, rows["V1"].Line_Qty, rows["V2"].Note) == ("9558", Decimal("-1234.5600"), 2, "")
    # 1900-01-01 and 31-OCT-24 are the extremes, so the column is a date; the sentinel is NULL.
    assert rows["V2"].InvoiceDate is None and str(rows["V3"].InvoiceDate) == "2024-10-31"
    assert sorted(r.AutoId for r in rows.values()) == [1, 2, 3]
    assert spark.table("zen.Vendor").count() == 3
    pipeline.run_pipeline(spark, p, mode="zen", audit=audit)
    assert sorted(r.AutoId for r in spark.table("zen.Vendor").collect()) == [1, 2, 3, 4, 5, 6]
    state = {r.RunID: r for r in audit.runs().collect()}
    assert state[run].Status == "SUCCESS" and state[run].SourceRowCount == 3 and state[run].StartTime is not None
    summary = audit.summary([run]).orderBy("step_order").collect()
    assert [r.step_name for r in summary] == ["PRELOAD_CSV", "RAW_LOAD", "STAGING_LOAD", "TARGET_LOAD", "PIPELINE_TOTAL"]
    assert [r.proper_row_count for r in summary[:4]] == [3, 3, 3, 3]
    assert audit.day_summary(f"{datetime.now():%Y-%m-%d}").count() >= 5


def test_failed_gate_is_logged_and_raised(spark, tmp_path, audit):
    p = entry(tmp_path, "Broken", "A,B\n1,2\n3\n")
    with pytest.raises(ValueError, match="malformed"):
        pipeline.run_pipeline(spark, p, audit=audit)
    failed = audit.runs().where("PipelineName = 'Broken'").first()
    assert failed.Status == "FAILED" and "malformed" in failed.ErrorMessage


def test_profile_mode_resets_audit_and_warns(spark, tmp_path):
    own = Audit(spark, "audit_profile")
    p = entry(tmp_path, "Warned", "OrderID,B\n1,2\n3\n")
    pipeline.run_pipeline(spark, p, mode="profile", audit=own)
    pipeline.run_pipeline(spark, p, mode="profile", audit=own)
    assert [r.Status for r in own.runs().collect()] == ["PROFILED_WARN"]
    logged = {r.ColumnName: r for r in own.table("ColumnProfileLog").collect()}
    assert logged["OrderID"].RecommendedSqlType == "VARCHAR(100)" and logged["B"].DefinedSqlType == "VARCHAR(4000)"


def test_raw_mode_writes_no_run_row(spark, tmp_path):
    own = Audit(spark, "audit_raw")
    pipeline.run_pipeline(spark, entry(tmp_path, "RawOnly", "A,B\n1,2\n"), mode="raw", audit=own)
    assert own.runs().count() == 0 and spark.table("raw.RawOnly").count() == 1
    with pytest.raises(ValueError, match="schema drift"):
        pipeline.run_pipeline(spark, entry(tmp_path, "RawOnly", "A,C\n1,2\n"), mode="raw", audit=own)


def test_mode_requirements(spark, tmp_path, audit):
    bare = Pipeline("Bare", "raw.Bare")
    for mode in ("staging", "zen"):
        with pytest.raises(ValueError):
            pipeline.run_pipeline(spark, bare, mode=mode, audit=audit)
    with pytest.raises(ValueError):
        pipeline.run_pipeline(spark, bare, mode="other", audit=audit)


def test_sql_files_replace_the_generated_stage(spark, tmp_path, audit):
    pipeline.run_pipeline(spark, entry(tmp_path, "Sqlled", "A,B\n1,2\n3,4\n"), mode="raw", audit=audit)
    (tmp_path / "stage.sql").write_text("SELECT cast(A AS int) AS a, B AS b FROM raw.Sqlled;\n")
    (tmp_path / "target.sql").write_text("SELECT sum(a) AS total FROM stg.Sqlled")
    (tmp_path / "empty.sql").write_text(" \n")
    p = Pipeline("Sqlled", "raw.Sqlled", None, "stg.Sqlled", "zen.Sqlled", "stage.sql", "target.sql")
    pipeline.run_pipeline(spark, p, audit=audit, sql_folder=str(tmp_path))
    assert spark.table("zen.Sqlled").first().total == 4
    with pytest.raises(ValueError, match="empty"):
        pipeline.read_sql(spark, str(tmp_path / "empty.sql"))
    with pytest.raises(Exception):
        pipeline.read_sql(spark, str(tmp_path / "missing.sql"))


def test_wide_text_needs_a_max_column(spark, tmp_path, audit):
    content = "A,B\n" + "x" * 5000 + ",1\n"
    with pytest.raises(Exception, match="longer than 4000"):
        pipeline.run_pipeline(spark, entry(tmp_path, "Wide1", content), mode="raw", audit=audit)
    p = entry(tmp_path, "Wide2", content, column_sql_types={"A": "VARCHAR(MAX)"})
    pipeline.run_pipeline(spark, p, audit=audit)
    assert len(spark.table("stg.Wide2").first().A) == 5000


def catalog(spark, rows):
    return spark.createDataFrame(
        [(i + 1, name, kind, "VARCHAR(4000)") for i, (name, kind) in enumerate(rows)],
        "ordinal_position int, column_name string, recommended_sql_type string, defined_sql_type string",
    )


def test_stage_layout_checks_names(spark):
    raw = spark.createDataFrame([("1", "2")], "a string, b string")
    for clash in ([("A.B", None), ("a_b", None)], [("autoid", None)]):
        with pytest.raises(ValueError):
            layers.stage_columns(catalog(spark, clash), raw)
    layout = layers.stage_columns(catalog(spark, [("strClient", ""), ("dAmt", "MONEY")]), raw)
    assert [c.sql_type for c in layout] == ["VARCHAR(4000)", "MONEY"]
    defined = layers.stage_columns(catalog(spark, [("dAmt", "MONEY")]), raw, type_authority="defined")
    assert defined[0].sql_type == "VARCHAR(4000)"
    assert [c.name for c in layers.stage_columns(None, raw)] == ["a", "b"]
    kept = layers.stage_columns(catalog(spark, [("Paid", "VARCHAR(255)")]), raw, {"Paid": "VARCHAR(MAX)"})
    assert kept[0].sql_type == "VARCHAR(MAX)"


def test_recommendations(spark):
    cases = [
        ("DISTR_QTY", "-.0800", "9992.0000", 10, "DECIMAL(17, 4)"), ("QTY", "0", "9992", 4, "INT"),
        ("FLX_CREATE_DATE", "2020-01-01 01:30:44.590000000", "2024-05-02 14:50:56.040000000", 29, "DATE"),
        ("CASH_CLEARED_DT", "01-APR-22", "31-OCT-24", 9, "DATE"),
        ("COMMENT_ID", "01-APR-22 01.04.17.000000000 PM", "31-OCT-23 12.58.20.000551000 PM", 35, "DATE"),
        ("PaidVendor", "5701.000000000000000", "5858.000000000000000", 20, "VARCHAR(100)"),
        ("BaseCurrencyNumberOfDecimals", "2.000000000000000", "2.000000000000000", 17, "INT"),
        ("BasePaymentAmount", "0.000000000000000", "0.000000000000000", 17, "MONEY"),
        ("NumberOfLines", "0.000000000000000", "98.000000000000000", 18, "INT"), ("CancelSequence", "0.000", "9999.000", 20, "INT"),
        ("CashLedgerTransaction", "0.000000000000000", "9999.000000000000000", 20, "INT"),
        ("OriginalPurchaseOrder", "0.000000000000000", "48366.000000000000000", 21, "VARCHAR(100)"),
        ("CreditReceived", "0.000000000000000", "998.460000000000000", 21, "MONEY"),
        ("ReturnValue", "-70.000000000000000", "9984.600000000000000", 22, "MONEY"),
        ("DiscRate", "0.125", "5", 5, "DECIMAL(17, 4)"), ("DiscRate", "0.12", "5", 5, "VARCHAR(100)"), ("Memo", "a", "9", 300, "VARCHAR(1000)"),
        ("PaidAmount", "2024-01-01", "9", 12, "VARCHAR(100)"), ("Anything", None, None, None, "VARCHAR(100)"),
    ]
    frame = spark.createDataFrame(
        [(i, *c[:4]) for i, c in enumerate(cases)],
        "i int, column_name string, minimum_non_null_value string, maximum_non_null_value string, max_string_length int",
    )
    got = [r.recommended_sql_type for r in profile.recommend(frame).orderBy("i").collect()]
    assert got == [c[4] for c in cases]


def test_merged_profiles(spark):
    frame = spark.createDataFrame(
        [("x", 1, "Berth", "m4", "q1", 2, 5, 11), ("y", 1, "Berth", "c", "p99", 3, 0, 6), ("z", 1, "Berth", "n", "n", 1, 2, 1)],
        "source_file string, ordinal_position int, column_name string, minimum_non_null_value string, maximum_non_null_value string, "
        "max_string_length int, blank_row_count bigint, non_null_row_count bigint",
    )
    row = profile.merge_profiles(frame).first()
    assert (row.minimum_non_null_value, row.maximum_non_null_value, row.max_string_length) == ("c", "q1", 3)
    assert (row.blank_row_count, row.non_null_row_count, row.nullability) == (7, 18, "NULL")


def test_inference_details(spark):
    rows = [("1.50", "1e3", "urn:uuid:12345678-1234-5678-1234-567812345678", "1_000", "x"), ("22.125", "2E-2", "{12345678123456781234567812345678}", "70000", "9:05 pm")]
    got = {r.column_name: r.inferred_sql_type for r in profile.infer_types(spark.createDataFrame(rows, "dec string, exp string, id string, n string, t string")).collect()}
    assert got == {"dec": "DECIMAL(5,3)", "exp": "DECIMAL(3,2)", "id": "UNIQUEIDENTIFIER", "n": "INT", "t": "VARCHAR(100)"}


def test_inference_of_an_empty_frame(spark):
    row = profile.infer_types(spark.createDataFrame([], "a string")).first()
    assert (row.column_name, row.inferred_sql_type, row.inference_reason) == ("a", "VARCHAR(100)", "all values blank")
    assert (row.non_null_row_count, row.blank_row_count, row.confidence_pct) == (0, 0, 0.0)


def test_canonical_names_agree(spark):
    header = ["Doc. Date", "", "Amount", "Amount", "123 Code", "Pur. Doc.", "A.B", ".Name", "Name."]
    expected = ["Doc_Date", "Column_002", "Amount", "Amount_2", "Column_123_Code", "Pur_Doc", "A_B", "Name", "Name_2"]
    frame = spark.createDataFrame([(1, header)], "k int, header array<string>")
    assert list(frame.select(headers.canonical_names(F.col("header"))).first()[0]) == expected
    assert [r.column_name for r in headers.canonical_columns(frame, ["k"]).orderBy("ordinal_position").collect()] == expected


def variant_profiles(spark, rows):
    return spark.createDataFrame(
        rows, "variant string, ordinal_position int, column_name string, minimum_non_null_value string, maximum_non_null_value string, non_null_row_count bigint"
    )


def test_harmonise_rules(spark):
    profiles = variant_profiles(spark, [
        ("BSAK_V01", 1, "CoCd", "a", "b", 5), ("BSAK_V01", 2, "Column_004", None, None, 0), ("BSAK_V02", 1, "Post.Date", "2024-01-01", "x", 2),
        ("BSAK_V02", 2, "Column_031", "v", "v", 1), ("BSAK_V02", 3, "Due Date", "soon", "soon", 1), ("BSAK_V02", 4, "Old Date", None, None, 0),
    ])
    plan = {r.out_name: r.sql_type for r in harmonise.column_plan(profiles).collect()}
    assert plan == {"CoCd": "VARCHAR(4000)", "Column_031": "VARCHAR(4000)", "Post_Date": "DATE", "Due_Date": "VARCHAR(4000)", "Old_Date": "DATE"}
    frames = {
        "BSAK_V01": spark.createDataFrame([(" 1 ", "", "f")], "CoCd string, Column_004 string, SFileName string"),
        "BSAK_V02": spark.createDataFrame([("1900-01-01", "v", "soon", "", "g")], "`Post.Date` string, Column_031 string, `Due Date` string, `Old Date` string, SFileName string"),
    }
    rows = {r.SourceVariant: r for r in harmonise.harmonise(frames, profiles).collect()}
    assert rows["BSAK_V01"].CoCd == "1" and rows["BSAK_V01"].Post_Date is None and rows["BSAK_V02"].Post_Date is None
    assert rows["BSAK_V02"].SourceTable == "raw.BSAK_V02"
    with pytest.raises(ValueError, match="both become"):
        harmonise.harmonise(frames, variant_profiles(spark, [("BSAK_V01", 1, "A.B", "x", "x", 1), ("BSAK_V01", 2, "A_B", "x", "x", 1)]))
    with pytest.raises(ValueError, match="reserved"):
        harmonise.harmonise(frames, variant_profiles(spark, [("BSAK_V01", 1, "autoid", "x", "x", 1)]))


def test_harmonised_then_reviewed_tables(spark, tmp_path):
    for name, columns, rows in (("E_V01", "Amount_LC string, Column_031 string", [("$5", "z")]), ("E_V02", "Amount_in_LC string", [("7",), (" ",)])):
        frame = spark.createDataFrame(rows, columns).withColumn("LoadDate", F.current_timestamp()).withColumn("SFileName", F.lit("f.csv"))
        layers.write_table(frame, f"raw.{name}")
    profiles = variant_profiles(spark, [
        ("E_V01", 1, "Amount_LC", "$5", "$5", 1), ("E_V01", 2, "Column_031", "z", "z", 1), ("E_V02", 1, "Amount_in_LC", "7", "7", 1),
    ])
    assert layers.load_harmonised(spark, {"E_V01": "raw.E_V01", "E_V02": "raw.E_V02"}, profiles, "hrm.E") == 3
    assert sorted(r.AutoId for r in spark.table("hrm.E").collect()) == [1, 2, 3]
    (tmp_path / "review.csv").write_text(
        "entity_name,anomaly_type,hrm_column_name,candidate_column_name,review_decision\n"
        "e,unnamed_source_column_with_values,Column_031,,\ne,possible_rename_pair,Amount_LC,Amount_in_LC,yes\n"
    )
    decisions = layers.read_review(spark, str(tmp_path / "review.csv"))["E"]
    assert layers.read_review(spark, str(tmp_path / "review.csv"), require_decision=True)["E"].drop_columns == frozenset()
    types = spark.createDataFrame([("Amount_LC", "MONEY"), ("Amount_in_LC", "VARCHAR(100)")], "ColumnName string, sql_type string")
    assert layers.load_reviewed(spark, "hrm.E", "stg.E", decisions, types, drop_source=True) == 3
    staged = spark.table("stg.E")
    assert staged.columns == ["Amount_in_LC", "SourceVariant", "SourceTable", "LoadDate", "SFileName", "AutoId"]
    assert sorted(r.Amount_in_LC for r in staged.collect()) == [Decimal(0), Decimal(5), Decimal(7)]
    assert not spark.catalog.tableExists("hrm.E")
    with pytest.raises(ValueError, match="source and target"):
        layers.reviewed_columns(["a", "b", "c"], layers.ReviewDecisions(rename_pairs=(("a", "b"), ("b", "c"))))


def test_reconciled_types(spark):
    rows = [("a", "VARCHAR(100)"), ("a", "VARCHAR(255)"), ("b", "VARCHAR(4000)"), ("b", "MONEY"), ("c", "INT"), ("c", "DECIMAL(17, 4)"), ("d", "VARCHAR(MAX)"), ("e", "DATETIME"), ("e", "MONEY")]
    got = {r.ColumnName: r.sql_type for r in history.reconcile_types(spark.createDataFrame(rows, "ColumnName string, sql_type string")).collect()}
    assert got == {"a": "VARCHAR(255)", "b": "MONEY", "c": "DECIMAL(17, 4)", "d": "VARCHAR(4000)", "e": "DATE"}


def brute_pairs(columns):
    def form(name):
        text = name.lower()
        for old, new in fixed.SIMILARITY_WORDS:
            text = text.replace(old, new)
        return "".join(c for c in text if c in "abcdefghijklmnopqrstuvwxyz0123456789")

    found = set()
    for a in columns:
        for b in columns:
            x, y = form(a), form(b)
            if a < b and x and y and (x in y or y in x or SequenceMatcher(None, x, y).ratio() >= 0.72):
                found.add((a, b))
    return found


def test_similar_pairs_equal_brute_force(spark):
    rng = random.Random(11)
    stems = ["amount", "vendor", "qty", "created_by", "del_note", "discount", "tax", "ship", "date", "ref", "line", "po", "abc", "zq9"]
    columns = {"Amount_LC", "Amount_in_LC", "DN_Qty", "Del_Note_Qty", "Created_By", "Created", "Supplier", "Amount", "___"}
    while len(columns) < 220:
        name = "_".join(rng.sample(stems, rng.randint(1, 3)))
        letters = list(name)
        for _ in range(rng.randint(0, 3)):
            letters.insert(rng.randrange(len(letters) + 1), rng.choice("aeioxz_1"))
        columns.add("".join(letters))
    frame = spark.createDataFrame([("E", c) for c in columns], "entity_name string, column_name string")
    got = {(r.left_column, r.right_column) for r in anomalies.similar_pairs(frame).collect()}
    expected = brute_pairs(columns)
    assert len(expected) > 100 and got == expected
    assert {("Amount_LC", "Amount_in_LC"), ("DN_Qty", "Del_Note_Qty"), ("Created", "Created_By")} <= got
    assert ("Amount", "Supplier") not in got


def test_rename_candidates_need_disjoint_variants(spark):
    rows = [("E", "V1", "Amount_LC"), ("E", "V2", "Amount_in_LC"), ("E", "V1", "Tax"), ("E", "V1", "Taxes"), ("E", "V1", "Id"), ("E", "V2", "Id")]
    frame = spark.createDataFrame([(*r, 1, 0) for r in rows], "entity_name string, pipeline_name string, column_name string, non_null_row_count int, blank_row_count int")
    assert [(r.left_column, r.right_column) for r in anomalies.rename_candidates(frame).collect()] == [("Amount_LC", "Amount_in_LC")]


def test_invoice_tokens(spark):
    text = "40.5 - Supplier Invoice: ROPE77   8.20 - Supplier Invoice: TAR-9 \n -3.4 - Supplier Invoice: oak_2 (6.75) - Supplier Invoice: Z $12,300 - Supplier Invoice: Q4"
    paid = spark.createDataFrame([(1, "T", text), (2, "U", "  "), (3, "W", "none")], "AutoId int, Transaction_Number string, Invoices_Paid string")
    rows = tokens.invoice_bridge(paid).orderBy("Invoice_Paid_Ordinal").collect()
    assert [(r.Invoice_Paid_Ordinal, float(r.Invoice_Paid_Amount), r.Invoice_Number) for r in rows] == [
        (1, 40.5, "ROPE77"), (2, 8.2, "TAR-9"), (3, -3.4, "oak_2"), (4, -6.75, "Z"), (5, 12300.0, "Q4"),
    ]


def test_reviews(spark):
    columns = spark.createDataFrame(
        [("f", "a", "INT", "NULL", 3, 99.0), ("f", "b", "INT", "NULL", 3, 10.0), ("g", "a", "DATE", "NULL", 9, 80.0)],
        "file_name string, column_name string, defined_sql_type string, nullability string, max_string_length int, confidence_pct double",
    )
    files = lambda *rows: spark.createDataFrame(list(rows), "file_name string, review_status string, approved_by string")
    overrides = spark.createDataFrame([("f", "a", "BIGINT ", "n")], "file_name string, column_name string, override_sql_type string, review_notes string")
    with pytest.raises(ValueError, match="unknown file_name"):
        review.apply_decisions(columns, files(("zz", "APPROVED", "me")))
    with pytest.raises(ValueError, match="invalid"):
        review.apply_decisions(columns, files(("f", "MAYBE", "me")))
    with pytest.raises(ValueError, match="unknown"):
        review.apply_decisions(columns, overrides=overrides.withColumn("column_name", F.lit("q")))
    half = review.apply_decisions(columns, files(("f", "approved", "me")), overrides)
    with pytest.raises(ValueError, match="not fully approved"):
        review.approved_schema(half)
    done = review.apply_decisions(half, files(("g", "APPROVED", "")))
    final = {(r.file_name, r.column_name): r.final_sql_type for r in review.approved_schema(done).collect()}
    assert final == {("f", "a"): "BIGINT", ("f", "b"): "INT", ("g", "a"): "DATE"}
    order = review.columns_to_review(done).where("file_name = 'f'").orderBy("review_rank").collect()
    assert [r.column_name for r in order] == ["a", "b"]
    assert review.review_status(done).first().all_approved


def test_error_digest_without_row_numbers(spark):
    lines = spark.createDataFrame([(1, "bad value 7"), (2, " bad value 9 "), (3, ""), (4, "Column x: oops")], "n int, line string")
    row = digest.digest(digest.parse_errors(lines)).first()
    assert (row.error_line_count, row.error_row_count, row.sample_error_columns) == (3, 3, "x")
    assert [(r.message, r.line_count) for r in digest.top_messages(digest.parse_errors(lines), "n").collect()][0] == ("bad value <n>", 2)


def test_keys_are_dense_and_follow_the_order(spark, tmp_path):
    shuffled = spark.range(0, 5000, 1, 7).select(F.col("id"), (F.col("id") % 3).alias("part"))
    keyed = surrogate.key_by_order(shuffled, ["part", "id"], start=10).orderBy("AutoId").collect()
    assert [r.AutoId for r in keyed] == list(range(11, 5011))
    assert [(r.part, r.id) for r in keyed] == sorted((r.part, r.id) for r in keyed)
    shuffled.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r.AutoId for r in surrogate.key_by_position(table).collect()) == list(range(1, 5001))


def test_rows_of_one_file_do_not_meet_in_one_task(spark, tmp_path):
    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "t"))
    keyed = surrogate.key_by_position(spark.read.parquet(str(tmp_path / "t")))
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert surrogate.key_summary(keyed).first() == (1000, 1000, 1, 1000)


def test_key_summary_of_any_keys(spark):
    keys = [None, None, 0, 0, -1, -64, -65, 63, 64, 64, 2**63 - 1, -(2**63), 5]
    keyed = spark.createDataFrame([(k,) for k in keys], "AutoId long").repartition(3)
    assert surrogate.key_summary(keyed).first() == (13, 9, -(2**63), 2**63 - 1)
    assert surrogate.key_summary(keyed.limit(0)).first() == (0, 0, None, None)


def test_inference_code_is_small_enough_to_be_compiled(spark, capsys):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        profile.infer_types(spark.createDataFrame([("1", "x")], "a string, b string")).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:([0-9]+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # the JVM interprets longer methods


def test_inference_of_odd_values(spark):
    expected = {
        "2020-02-30": "VARCHAR(100)", "2020-13-01": "VARCHAR(100)", "0000-01-07": "DATE", "2020-1-2": "DATE", "2/29/2020": "DATE",
        "2/30/2020 1:02": "VARCHAR(100)", "20200229T10": "DATETIME2", "2020-02-29x10:11Z": "DATETIMEOFFSET", "20200230": "INT",
        "30000009912": "BIGINT", "+9_223_372_036_854_775_807": "BIGINT", "9223372036854775808": "DECIMAL(19,0)", "1.20E-3": "DECIMAL(5,4)",
        "-.5": "DECIMAL(2,1)", "+-1": "VARCHAR(100)", "1__0": "VARCHAR(100)", "0" * 50 + "7": "TINYINT",
    }
    row = spark.createDataFrame([tuple(expected)], ", ".join(f"c{i} string" for i in range(len(expected))))
    got = {int(r.column_name[1:]): r.inferred_sql_type for r in profile.infer_types(row).collect()}
    assert {v: got[i] for i, v in enumerate(expected)} == expected


def test_bulk_text_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([("Y", "24.000", "Example Health")], "opt string, pct string, name string")
    columns = [("opt", "BIT"), ("pct", "DECIMAL(18,0)"), ("name", "VARCHAR(255)")]
    lines = reports.bulk_lines(rows, columns, "2026-03-17 13:00:00", "tmp\\a.csv")
    reports.write_bulk(lines, str(tmp_path / "bulk"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "bulk").glob("part-*")))
    assert data == b"1\x1f24\x1fExample Health\x1f2026-03-17 13:00:00\x1ftmp\\a.csv\r\n"
    with pytest.raises(Exception, match="not valid for BIT"):
        reports.bulk_lines(spark.createDataFrame([("?",)], "opt string"), [("opt", "BIT")]).collect()
    with pytest.raises(ValueError):
        reports.bulk_lines(rows, columns, load_date="x")
    reports.write_csv(rows.withColumn("tags", F.array(F.lit("a"), F.lit("b"))), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().tags == "a;b"
    reports.write_json(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first().opt == "Y"


def test_partial_loads(spark):
    table = spark.createDataFrame([("2026-01-01", "a"), ("2026-01-01", "a")], "LoadDate string, SFileName string")
    written = spark.createDataFrame([("2026-01-01", "a", 2), ("2026-01-01", "b", 1)], "LoadDate string, SFileName string, row_count bigint")
    assert [(r.SFileName, r.row_count) for r in checks.partial_loads(written, table).collect()] == [("b", 0)]


def test_metadata_backfill(spark):
    raw = layers.with_metadata(spark.createDataFrame([("x",)], "a string"), datetime(2026, 1, 1, 2, 3, 4, 5))
    row = raw.first()
    assert row.SFileName == "" and row.LoadDate == datetime(2026, 1, 1, 2, 3, 4)


def test_raw_load_gates_leave_the_table_alone(spark, tmp_path):
    p = entry(tmp_path, "Gated", "A,B\n1,2\n3,4\n")
    assert pipeline.run_pipeline(spark, p, mode="raw") is not None
    before = sorted(map(tuple, spark.table("raw.Gated").collect()))
    for content, told in (("A,B\n1,2\n3\n", "malformed"), ("A,B\n", "no data"), ("A,B\n1," + "x" * 4001 + "\n", "longer than")):
        (tmp_path / "Gated.csv").write_text(content)
        with pytest.raises(Exception, match=told):
            layers.load_raw(exports.open_export(spark, p.profile), p.profile, "raw.Gated")
        assert sorted(map(tuple, spark.table("raw.Gated").collect())) == before
        assert not spark.catalog.tableExists("raw.Gated__loading")


def test_short_slice_leaves_the_table_alone(spark):
    layers.write_table(spark.range(3).toDF("n"), "raw.Slices")

    def refuse(stored):
        raise ValueError(f"{stored.count()} rows are too few")

    with pytest.raises(ValueError, match="2 rows"):
        layers.write_table(spark.range(2).toDF("n"), "raw.Slices", verify=refuse)
    assert spark.table("raw.Slices").count() == 3


def test_zen_append_numbers_staged_tables_of_any_kind(spark):
    layers.write_table(spark.createDataFrame([("a", 1), ("b", 2)], "Name string, N int"), "stg.Unkeyed")
    assert layers.append_zen(spark, "stg.Unkeyed", "zen.Mixed") == 2
    layers.write_table(spark.createDataFrame([("c", 3, 70), ("d", 4, 90)], "Name string, N int, AutoId bigint"), "stg.Sparse")
    assert layers.append_zen(spark, "stg.Sparse", "zen.Mixed") == 2
    layers.write_table(spark.createDataFrame([("f", 6, 2), ("e", 5, 1)], "Name string, N int, AutoId bigint"), "stg.Dense")
    assert layers.append_zen(spark, "stg.Dense", "zen.Mixed") == 2
    keys = {r.Name: r.AutoId for r in spark.table("zen.Mixed").collect()}
    assert sorted(keys.values()) == [1, 2, 3, 4, 5, 6] and (keys["e"], keys["f"]) == (5, 6) and {keys["a"], keys["b"]} == {1, 2}


def test_header_longer_than_the_sample_is_whole(spark, tmp_path):
    from siltline.sources import files

    names = ['"first\nline"', '"' + "long name\n" * 4_000 + 'end"', "last"]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n1,2,3\n" * 50)
    header = files.file_settings(spark, [str(tmp_path / "wide.csv")]).first().header
    assert [len(h) for h in header] == [10, 40_003, 4] and header[2] == "last"


def test_one_source_may_not_feed_two_targets():
    decisions = layers.ReviewDecisions(rename_pairs=(("a", "b"), ("a", "c")))
    with pytest.raises(ValueError, match="more than one target"):
        layers.reviewed_columns(["a", "b", "c"], decisions)


def test_reconciled_decimal_holds_all(spark):
    rows = [("x", k) for k in ("DECIMAL(10, 2)", "DECIMAL(38, 2)", "DECIMAL(9,6)", "INT")] + [("y", "DECIMAL(5, 1)"), ("y", "VARCHAR(9)")]
    got = {r.ColumnName: r.sql_type for r in history.reconcile_types(spark.createDataFrame(rows, "ColumnName string, sql_type string")).collect()}
    assert got == {"x": "DECIMAL(38, 2)", "y": "DECIMAL(5, 1)"}


def test_approval_has_a_time_and_file_notes(spark):
    columns = spark.createDataFrame([("f", "c", "INT"), ("g", "c", "INT")], "file_name string, column_name string, defined_sql_type string")
    files = spark.createDataFrame([("f", "approved", "me", "fine"), ("g", "rejected", "me", None)], "file_name string, review_status string, approved_by string, review_notes string")
    moment = datetime(2024, 5, 1, 12)
    got = {r.file_name: r for r in review.apply_decisions(columns, files, decided_at=moment).collect()}
    assert got["f"].approved_at_utc == moment and got["f"].file_review_notes == "fine"
    assert got["g"].approved_at_utc is None and got["g"].file_review_notes == ""
    with pytest.raises(ValueError, match="g .REJECTED"):
        review.approved_schema(review.apply_decisions(columns, files, decided_at=moment))


def test_gate_of_the_approved_schema_is_registered(spark):
    from siltline.plans.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    open_files = {r.review_status for r in QUERIES["blocking_files"](spark, folder).collect()}
    assert open_files == {"PENDING", "REJECTED"} and QUERIES["approved_schema_gated"](spark, folder).count() > 0
