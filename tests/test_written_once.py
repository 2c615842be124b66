"""Rows that several passes read are made once and hold only what is read; fits get tasks for all cores."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fraudlake.llm import neardup
from fraudlake.operators import drift, model, profile
from fraudlake.plans import queries

N = 400


@pytest.fixture
def counted(spark):
    """A column ``amount`` that counts how often its rows are made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(i):
        made.add(1)
        return float(i % 37)

    return made, spark.range(N).withColumn("amount", value.asNondeterministic()("id"))


def gold(df):
    return df.select(
        "amount", F.lit(dt.date(1999, 1, 1)).alias("date"), F.when(F.col("id") % 2 == 0, "r").otherwise("n").alias("errors"),
        *[F.lit("x").alias(c) for c in queries.DRIFT_CATEGORICAL if c != "errors"],
        *[F.col("id").cast("int").alias(c) for c in queries.DRIFT_NUMERIC if c != "amount"])


def test_numeric_profile_makes_its_rows_once(counted):
    made, df = counted
    row = profile.profile_numeric(df, ["amount"]).first()
    assert row["count"] == N and made.value == N


def test_reference_set_makes_its_rows_once(spark, counted, monkeypatch):
    made, df = counted
    monkeypatch.setattr(queries, "gold_features", lambda s, d: gold(df))
    rows = {(r["run_name"], r["errors"]): r["n"] for r in queries.reference_set(spark, "").collect()}
    assert rows == {("run-1", "n"): N // 2, ("run-2", "r"): N // 2} and made.value == N


def test_numeric_psi_reads_numeric_columns_alone(spark, counted, monkeypatch):
    monkeypatch.setattr(queries, "gold_features", lambda s, d: gold(counted[1]))
    seen = []
    real = drift.psi_numeric_tagged
    monkeypatch.setattr(drift, "psi_numeric_tagged", lambda t, c: seen.extend(t.columns) or real(t, c))
    assert queries.psi_numeric(spark, "").count() == len(queries.DRIFT_NUMERIC)
    assert seen == [drift.SIDE, *queries.DRIFT_NUMERIC]


def test_bins_of_nulls_nans_and_merged_edges(spark):
    rows = [(1, None, 1.0), (1, 0.5, float("nan")), (0, 1.0, 2.0), (0, 9.0, None)]
    df = spark.createDataFrame(rows, f"{drift.SIDE} int, a double, b double")
    got = sorted((r[drift.SIDE], r["column_name"], r["value"]) for r in drift.bin_values(df, {"a": [0.7, 1.0, 8.0], "b": []}).collect())
    assert got == [(0, "a", 1), (0, "a", 3), (0, "b", -1), (0, "b", 0), (1, "a", -1), (1, "a", 0), (1, "b", 0), (1, "b", 0)]


def test_fits_are_spread_over_tasks(spark):
    enc = model._sized(spark.range(0, 50_000, 1, 1))
    assert enc.rdd.getNumPartitions() == 4 and enc.count() == 50_000


def test_prefixes_bring_their_labels(spark):
    texts = [(i, " ".join(f"w{j}" for j in range(30)) + f" x{i % 5}") for i in range(10)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = neardup.set_rows(docs, docs.select(F.col("doc_id").alias("rep")), 3).withColumn("label", F.col("rep") % 2)
    rows = neardup._prefixes(sets, (80, 100)).collect()
    assert rows and all(r["label"] == r["rep"] % 2 for r in rows)
