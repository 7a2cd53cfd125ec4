"""The approval gate as rows, and what the approved schema carries."""

from datetime import datetime

import pytest

from siltline.operators import review

COLUMNS = "file_name string, column_name string, defined_sql_type string, nullability string"


def review_of(spark, decisions, decided_at=None):
    columns = spark.createDataFrame([(f, c, "INT", "NULL") for f, _ in decisions for c in ("a", "b")], COLUMNS)
    files = spark.createDataFrame([(f, s, "lead", f"note {f}") for f, s in decisions if s], "file_name string, review_status string, approved_by string, review_notes string")
    return review.apply_decisions(columns, files, decided_at=decided_at)


def test_gate_of_one_review(spark):
    blocked = review_of(spark, [("x", "APPROVED"), ("z", "REJECTED"), ("y", None)])
    assert tuple(review.approval_gate(blocked).first()) == (3, 2, "y (PENDING), z (REJECTED)", False, 0)
    with pytest.raises(ValueError, match=r"y \(PENDING\), z \(REJECTED\)"):
        review.approved_schema(blocked)
    assert tuple(review.approval_gate(review_of(spark, [("x", "approved")])).first()) == (1, 0, "", True, 2)
    many = review_of(spark, [(f"f{i:02d}", None if i else "APPROVED") for i in range(13)])
    gate = review.approval_gate(many).first()
    assert gate.blocking_count == 12 and gate.blocking_files.count("(PENDING)") == 10 and gate.blocking_files.startswith("f01 ")
    assert tuple(review.approval_gate(blocked.limit(0)).first()) == (0, 0, "", True, 0)


def test_approved_schema_says_who_when_and_why(spark):
    moment = datetime(2026, 2, 3, 4, 5, 6)
    rows = review.approved_schema(review_of(spark, [("x", "Approved")], moment)).collect()
    assert {(r.column_name, r.approved_by, r.approved_at_utc, r.file_review_notes) for r in rows} == {(c, "lead", moment, "note x") for c in "ab"}
