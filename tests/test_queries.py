"""Every registered query against its SQL counterpart, and scale properties of their plans."""

import os

import compare
import pytest

import __spark_entry__ as driver
from siltline.plans import catalog, oracle

FOLDER = os.environ.get("SILTLINE_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.QUERIES, oracle.statements()


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    assert compare.difference(frame, connection, SQL[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan  # groups with text extremes stay in hash maps, see operators/folding.py


def test_sql_covers_all():
    assert set(QUERIES) == set(SQL)


def test_rename_candidates_equal_brute_force(spark):
    from test_jobs import brute_pairs

    from siltline.plans.catalog import part_columns

    rows = part_columns(spark, FOLDER).collect()
    places, variants = {}, {}
    for r in rows:
        places.setdefault((r.entity_name, r.column_name), set()).add(r.pipeline_name)
        variants.setdefault(r.entity_name, set()).add(r.pipeline_name)
    expected = set()
    for entity, names in variants.items():
        only = {c for (e, c), where in places.items() if e == entity and where != names}
        expected |= {(entity, a, b) for a, b in brute_pairs(only) if not places[entity, a] & places[entity, b]}
    got = {(r.entity_name, r.left_column, r.right_column) for r in QUERIES["rename_candidates"](spark, FOLDER).collect()}
    assert got == expected


def test_entry(spark):
    assert driver.entry(spark).count() == 16
