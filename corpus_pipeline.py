"""From raw documents to packed training sequences, each stage written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftline.llm import stages
from shiftline.llm.workspace import Workspace

STAGES = [
    ("language_id", stages.known_language),
    ("near_duplicates", stages.one_of_each_group),
    ("personal_data", stages.masked),
    ("mixing", stages.mixed),
    ("packing", stages.packed),
]

# No SQL states hashing, training, dependent rounding and tokenizing; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; see ``shiftline.llm.stages``."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
