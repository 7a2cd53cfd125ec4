"""Replacing layer tables: stops after every statement, and columns that must not be NULL."""

import pytest
from pyspark.sql import functions as F

from siltline.operators import constraints
from siltline.plans import layers


class Stopped(BaseException):
    """As when the driver is killed: no handler runs."""


def rows_of(spark, table):
    return sorted(r.n for r in layers.layer_table(spark, table).collect())


def test_a_stop_after_any_statement_leaves_a_whole_table(spark, monkeypatch):
    run, table = layers._run, "raw.Stops"
    stops = 0
    for stop_after in range(12):
        layers.write_table(spark.range(3).toDF("n"), table)
        done = []

        def stopping(session, statement):
            if len(done) == stop_after:
                raise Stopped
            run(session, statement)
            done.append(statement)

        monkeypatch.setattr(layers, "_run", stopping)
        try:
            layers.write_table(spark.range(10, 12).toDF("n"), table)
            stopped = False
        except Stopped:
            stopped = True
        monkeypatch.setattr(layers, "_run", run)
        stops += stopped
        with pytest.raises(Exception, match="broken"):
            layers.write_table(spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("n")), table)
        assert rows_of(spark, table) in ([0, 1, 2], [10, 11])
        assert not any(spark.catalog.tableExists(table + end) for end in (layers.LOADING, layers.REPLACED))
        if not stopped:
            break
    assert stops == 4 and rows_of(spark, table) == [10, 11]


def test_a_stop_in_the_first_load_leaves_no_table(spark, monkeypatch):
    run = layers._run

    def stopping(session, statement):
        if "RENAME" in statement:
            raise Stopped
        run(session, statement)

    monkeypatch.setattr(layers, "_run", stopping)
    with pytest.raises(Stopped):
        layers.write_table(spark.range(3).toDF("n"), "raw.FirstStop")
    monkeypatch.setattr(layers, "_run", run)
    layers.recover(spark, "raw.FirstStop")
    assert not spark.catalog.tableExists("raw.FirstStop") and not spark.catalog.tableExists("raw.FirstStop__loading")
    layers.recover(spark, "nowhere.Table")


@pytest.mark.parametrize("sql_type, profiled, expected", [
    ("DATE", "NOT NULL", True), ("DATETIME2", None, True), ("SMALLDATETIME", "NULL", True), ("MONEY", None, False), ("VARCHAR(10)", None, False),
    ("INT", "NULL", True), ("INT", "NOT NULL", False), ("BIT", None, True), ("BIT", "NOT NULL", False), ("BIT", "", True),
])
def test_which_columns_may_be_null(sql_type, profiled, expected):
    assert constraints.may_be_null(sql_type, profiled) is expected


def staged_layout(spark, kinds):
    catalog = spark.createDataFrame(
        [(i + 1, name, kind, "VARCHAR(4000)", null) for i, (name, kind, null) in enumerate(kinds)],
        "ordinal_position int, column_name string, recommended_sql_type string, defined_sql_type string, nullability string",
    )
    return layers.stage_columns(catalog, spark.createDataFrame([], ", ".join(f"{name} string" for name, _, _ in kinds)))


def test_nulls_in_required_columns_leave_the_staged_table(spark):
    kinds = [("Open", "BIT", "NOT NULL"), ("Amount", "MONEY", "NOT NULL"), ("Day", "DATE", "NOT NULL"), ("Note", "VARCHAR(10)", "NULL")]
    layout = staged_layout(spark, kinds)
    assert [(c.name, c.nullable) for c in layout] == [("Open", False), ("Amount", False), ("Day", True), ("Note", True)]
    raw = "Open string, Amount string, Day string, Note string"
    layers.write_table(spark.createDataFrame([("Y", "x", "no day", None)], raw), "raw.Nulls")
    assert layers.load_stage(spark, "raw.Nulls", "stg.Nulls", layout) == 1
    layers.write_table(spark.createDataFrame([("maybe", "1", "", None), (None, "2", "", ""), ("N", "", "", "")], raw), "raw.Nulls")
    with pytest.raises(constraints.NullViolation, match=r"Open \(2 rows\); the table is unchanged") as broken:
        layers.load_stage(spark, "raw.Nulls", "stg.Nulls", layout)
    assert broken.value.counts == {"Open": 2} and spark.table("stg.Nulls").count() == 1
    # Where blanks stay NULL, the amount that is blank breaks its rule too.
    with pytest.raises(constraints.NullViolation) as broken:
        layers.load_stage(spark, "raw.Nulls", "stg.Nulls", layout, blank_policy="null")
    assert broken.value.counts == {"Open": 2, "Amount": 1}
    unprofiled = staged_layout(spark, [(name, kind, None) for name, kind, _ in kinds])
    assert layers.required_columns(unprofiled) == ["Amount", "Note"] and layers.required_columns(unprofiled, "null") == []
    assert layers.load_stage(spark, "raw.Nulls", "stg.Nulls", unprofiled, blank_policy="null") == 3


def test_null_counts_of_an_empty_table_and_an_append(spark):
    layout = staged_layout(spark, [("A", "INT", "NOT NULL")])
    found = layers.null_violations(spark.createDataFrame([], "A int"), layout).collect()
    assert [tuple(r) for r in found] == [("A", "INT", "NOT NULL", 0, False)]
    layers.write_table(spark.range(2).toDF("n"), "zen.Required")
    with pytest.raises(constraints.NullViolation):
        layers.write_table(spark.createDataFrame([(None,)], "n bigint"), "zen.Required", mode="append", required=["n"])
    assert spark.table("zen.Required").count() == 2
    layers.write_table(spark.range(2).toDF("n"), "zen.Required", mode="append", required=["n"])
    assert spark.table("zen.Required").count() == 4


def test_profiling_an_export_sorts_nothing_by_file(spark, tmp_path):
    from siltline.sources import exports

    (tmp_path / "a.csv").write_text("A,B\n1,x\n2,y\n")
    export = exports.open_export(spark, exports.ExportProfile(source_files=(str(tmp_path / "a.csv"),)))
    by_file = exports.file_gates(export, layers.unsorted(F.min(F.get("fields", F.lit(0)))).alias("low"))
    assert "SortAggregate" not in by_file._jdf.queryExecution().executedPlan().toString()
    found = layers.profile_export(export, exports.ExportProfile(source_files=(str(tmp_path / "a.csv"),)))
    assert [(r.column_name, r.minimum_non_null_value, r.maximum_non_null_value) for r in found.columns.orderBy("ordinal_position").collect()] == [("A", "1", "2"), ("B", "x", "y")]


def test_more_groups_than_the_map_holds_give_the_same_rows(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 700).alias("k"), F.col("id").cast("string").alias("t"))
    expected = sorted(map(tuple, rows.groupBy("k").agg(F.max("t"), F.max_by("t", "id")).collect()))
    assert sorted(map(tuple, rows.groupBy("k").agg(layers.unsorted(F.max("t")), layers.unsorted(F.max_by("t", "id"))).collect())) == expected


def test_files_of_a_failed_write_do_not_block_the_next_load(spark):
    from pathlib import Path

    layers.write_table(spark.range(2).toDF("n"), "raw.Stray")
    where = spark.catalog.getDatabase("raw").locationUri.removeprefix("file:")
    left = Path(where) / ("stray" + layers.LOADING) / "part-0"
    left.parent.mkdir(parents=True)
    left.write_text("left")
    layers.write_table(spark.range(5, 7).toDF("n"), "raw.Stray")
    assert rows_of(spark, "raw.Stray") == [5, 6] and not left.exists()
