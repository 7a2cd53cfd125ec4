"""Shared folders, names and text rules of the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.session import ensure_checkpoint_dir

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so (column names compare without case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """The column of that exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


class Workspace:
    """Tables that one operator run keeps in the folder which all executors share.

    A kept table cuts the lineage: a lost executor costs the tasks that read it, not what made it.
    ``drop`` removes tables that no later read needs.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.root = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
