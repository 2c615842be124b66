"""Stages of the corpus pipeline: an operator's decisions applied to a frame of documents.

Each function takes (spark, docs, sf_dir) and keeps every column of ``docs``, whatever their
names: a row travels as one struct, so the operators' own columns never meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, neardup, quality, secrets
from .store import if_small, lookup_join, packed, read_table, saved, unpacked


def _numbered(docs: DataFrame) -> DataFrame:
    """r, a number of each row, and ``row``; written, so that a repeated task finds the same numbers."""
    return saved(packed(docs).select(F.monotonically_increasing_id().alias("r"), "row"), "numbered")


def _without(rows: DataFrame, gone: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents of ``rows`` whose number isn't in ``gone``."""
    return rows.join(if_small(saved(gone.select("r").distinct(), "gone")), "r", "left_anti").select(*unpacked(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: that with the smallest doc_id (null: last).

    Rows are told apart, not ids: repeated rows and rows without an id are one group like others.
    """
    rows = _numbered(docs)
    own = rows.select(F.col("r").alias("doc_id"), F.col("row.text").alias("text"))
    found = saved(neardup.near_duplicates(own).where("n_shingles > 0").select(F.col("doc_id").alias("r"), "component_id"), "components")
    shared = saved(found.where("r <> component_id").select("component_id").distinct(), "shared_components")
    found = found.join(if_small(shared), "component_id", "left_semi")
    found = saved(found.join(rows.select("r", F.col("row.doc_id").alias("doc_id")), "r"), "copies")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "r")).alias("first"))
    first = saved(first.select("component_id", F.col("first.r").alias("first")), "first_copies")
    return _without(rows, lookup_join(found, first, "component_id", "inner", rows=first.count()).where("r <> first"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, row by row."""
    rows = _numbered(docs)
    own = rows.select(F.col("r").alias("doc_id"), F.col("row.text").alias("text"))
    found = decontam.overlaps(own, read_table(spark, sf_dir, "benchmark"))
    return _without(rows, found.select(F.col("doc_id").alias("r")), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return secrets.redact(docs)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the decoded text of every document."""
    return bpe.encode(docs, bpe.default_path())
