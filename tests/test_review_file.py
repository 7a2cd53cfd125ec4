"""Lines of a reviewed anomaly file: every case on a few rows."""

from pyspark.sql import functions as F

from siltline.operators.review_file import DROPS, NOTES, RENAMES, parse_review

LINES = [
    f'e,{DROPS},"Column ""5"", old",,',
    f"e,{RENAMES},a,b,yes",
    f"E,{RENAMES},a,b,",
    f"e,{RENAMES},c,d,yes",
    f"e,{RENAMES},c,f,YES",
    f"e,{RENAMES},g,h,yes",
    f"e,{RENAMES},h,i,yes",
    f"e,{RENAMES},k,k,yes",
    f"f,{RENAMES},b,a,yes",
    f"e,{NOTES},x,,yes",
    f",{NOTES},x,,yes",
    f"e,{DROPS}, ,,yes",
    "e,other,x,,yes",
    f"e,{DROPS},x",
    f"e,{DROPS},x,,yes,more",
    "",
    None,
]


def actions(spark, lines, **how):
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, line string")
    return {r.n: (r.action, r.reason) for r in parse_review(frame, "n", **how).collect()}


def test_every_line_has_an_action(spark):
    got = actions(spark, LINES)
    assert [got[i][0] for i in (0, 1, 2, 8, 9)] == ["drop", "rename", "rename", "rename", "note"]
    assert got[3] == got[4] == ("reject", "more than one target")
    assert got[5] == got[6] == ("reject", "source and target of renames")
    assert [got[i][1] for i in (7, 10, 11, 12)] == ["renamed to itself", "no entity", "no column", "unknown anomaly type"]
    assert got[13] == got[14] == ("reject", "another number of fields")
    assert got[15][0] == got[16][0] == "reject" and len(got) == len(LINES)


def test_decisions_are_asked_for(spark):
    got = actions(spark, LINES, require_decision=True)
    assert got[0] == got[2] == ("skip", None) and got[1] == ("rename", None)
    assert actions(spark, [f"e,{RENAMES},c,d,yes", f"e,{RENAMES},c,f,no"], require_decision=True) == {0: ("rename", None), 1: ("skip", None)}


def test_empty_file(spark):
    none = spark.createDataFrame([], "n int, line string").withColumn("extra", F.lit(1))
    assert parse_review(none, "n").count() == 0
