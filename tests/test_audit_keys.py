"""Keys of audit rows: growing, and never the same twice."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest

from siltline.plans.audit import MOST_COLUMNS, Audit
from siltline.session import ensure_checkpoint_dir


def test_keys_of_one_moment_differ_and_grow():
    moment = datetime(2026, 1, 2, 3, 4, 5)
    with ThreadPoolExecutor(8) as pool:
        keys = list(pool.map(lambda _: Audit._id(moment), range(2000)))
    assert len(set(keys)) == 2000
    later = Audit._id(moment + timedelta(days=400), MOST_COLUMNS + 1)
    assert later > max(keys)
    # A profile's columns take their keys behind its first one; the next event comes after all of them.
    assert Audit._id(moment) > later + MOST_COLUMNS


def test_events_of_a_run_are_in_order(spark):
    audit = Audit(spark, "audit_keys")
    moment = datetime(2026, 1, 2, 3, 4, 5)
    audit.start_run("r1", "p", "a.csv", "raw.A", moment)
    audit.end_run("r1", moment, moment, "SUCCESS", 3, 3)
    row = audit.runs().first()
    assert (row.Status, row.SourceRowCount, row.PipelineName) == ("SUCCESS", 3, "p")
    for n in (1, 2):
        audit.count("r1", "p", "raw.A", "RAW_LOAD", n, at=moment)
    assert {r.proper_row_count for r in audit.summary(["r1"]).where("step_name = 'RAW_LOAD'").collect()} == {2}


class Cluster:
    """What ``ensure_checkpoint_dir`` asks of a session, with no folder named."""

    def __init__(self, master, warehouse):
        self.master, self.warehouse, self.chosen = master, warehouse, None
        self.sparkContext = self._jsc = self.conf = self

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isDefined(self):
        return False

    def getConf(self):
        return {}

    def get(self, key, default=None):
        return self.warehouse if key == "spark.sql.warehouse.dir" else default

    def setCheckpointDir(self, folder):
        self.chosen = folder


def test_a_local_warehouse_is_no_shared_folder_of_a_cluster():
    for master, warehouse, fits in (
        ("local[8]", "file:/tmp/w", True), ("yarn", "hdfs://n/w", True), ("yarn", "file:/tmp/w", False), ("spark://h:7077", "/tmp/w", False),
    ):
        session = Cluster(master, warehouse)
        if fits:
            ensure_checkpoint_dir(session)
            assert session.chosen == f"{warehouse}-checkpoints"
        else:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                ensure_checkpoint_dir(session)
