"""From raw documents to sharded training text: five stages, each one operator over all that is left.

Every stage takes (spark, documents, folder of the tables) and returns a DataFrame that is written as
Parquet before the next one reads it. All but the last return the columns of documents; the last adds
``shard``. Null ids, null and empty texts, repeated rows and further columns pass as the operators
define it; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltline.llm.common import Workspace, table
from siltline.llm.contamination import without_contaminated
from siltline.llm.mixing import sample_mixture
from siltline.llm.neardup import keep_one
from siltline.llm.sharding import with_shard
from siltline.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores 0.5 or more go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are a twentieth or more go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics have their target weights."""
    return sample_mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets one of 24 shards of nearly equal bytes."""
    return with_shard(docs, 24)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# A learnt score decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    place, docs = Workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = place.keep(stage(spark, docs, sf_dir), name)
        if i:
            place.drop(STAGES[i - 1][0])
    return docs
