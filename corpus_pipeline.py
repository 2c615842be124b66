"""The corpus pipeline: stages that each call one operator of ``fraudlake.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame
that is written as Parquet and read again as the next stage's ``docs``. All stages but the
last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudlake.llm import stages
from fraudlake.llm.store import read_table, saved

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("secret_scan", stages.secret_scan),
    ("bpe_round_trip", stages.bpe_round_trip),
]

#: SQL cannot express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
