"""Exact quantiles by sketch and brackets, and the distances between two distributions, against numpy."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.operators import drift, ordered

AT = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def frame(spark, **cols):
    n = max(map(len, cols.values()))
    rows = [tuple(c[i] if i < len(c) else None for c in cols.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(6)


def expected(values):
    v = np.sort([x for x in values if x is not None])
    out = []
    for q in AT:
        p = q * (len(v) - 1)
        lo, hi = v[math.floor(p)], v[math.ceil(p)]
        out.append(lo if lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi)
    return [float(x) for x in out]


@pytest.fixture(scope="module")
def columns():
    rng = np.random.default_rng(0)
    return {
        "even": [float(x) for x in rng.random(30_000)],
        "steep": [float(x) for x in np.exp(rng.normal(0, 6, 30_000))],
        "hot": [7.0] * 15_000 + [float(x) for x in rng.integers(-3, 20, 15_000)],
        "nulls": [None if i % 3 else float(i) for i in range(30_000)],
        "one": [5.0],
        "two": [1.0, 2.0],
    }


def check(spark, columns):
    df = frame(spark, **columns, none=[None])
    got = {r["column_name"]: list(r["q"]) for r in ordered.quantiles(df, [*columns, "none"], AT).collect()}
    assert got == {c: expected(v) for c, v in columns.items()}


def test_quantiles_are_exact(spark, columns):
    check(spark, columns)


def test_missed_brackets_are_widened(spark, columns, monkeypatch):
    """A coarse sketch misses ranks; the answers stay exact."""
    monkeypatch.setattr(ordered, "SKETCH_SIZE", 8)
    monkeypatch.setattr(ordered, "SKETCH_MARGIN", 1e-4)
    check(spark, columns)


def test_many_values_about_a_rank(spark, columns, monkeypatch):
    monkeypatch.setattr(ordered, "WINDOW_VALUES", 0)
    check(spark, columns)


def test_no_rows(spark):
    assert ordered.quantiles(spark.createDataFrame([], "a double"), ["a"], [0.5]).collect() == []


def test_next_values_across_tasks_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.range(100).select((F.col("id") * 2).cast("double").alias("v"), F.lit(1).cast("long").alias("n")).repartition(7)
        got = sorted((r["v"], r["cum_n"], r["next_v"]) for r in ordered.running_sums(df, ["v"], ["n"], partitions=9, lead=["v"]).collect() if r["v"] < 198)
        assert got == [(2.0 * i, i + 1, 2.0 * i + 2) for i in range(99)]
        last = ordered.running_sums(df, ["v"], ["n"], partitions=9, lead=["v"]).filter("v = 198").first()
        assert last["next_v"] is None or math.isnan(last["next_v"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def wasserstein(a, b):
    every = np.sort(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), every[:-1], "right") / len(a) - np.searchsorted(np.sort(b), every[:-1], "right") / len(b))
    return float((gap * np.diff(every)).sum()) / max(float(np.std(a)), 0.001)


def test_wasserstein_and_ks(spark):
    rng = np.random.default_rng(3)
    ref = {"x": rng.normal(size=400), "ties": rng.integers(0, 5, 400).astype(float), "flat": np.full(400, 3.0)}
    cur = {"x": rng.normal(0.4, 2, 300), "ties": rng.integers(1, 7, 300).astype(float), "flat": np.full(300, 3.0)}
    tables = [frame(spark, **{c: [float(x) for x in v] + [None] * 5 for c, v in side.items()}, gone=[1.0] if side is ref else [None]) for side in (ref, cur)]
    got = {r["column_name"]: r for r in drift.distances_tagged(drift.tag_sides(*tables), ["x", "ties", "flat", "gone"]).collect()}
    for c in ref:
        assert got[c]["wasserstein"] == pytest.approx(wasserstein(ref[c], cur[c]), abs=1e-9)
        every = np.concatenate([ref[c], cur[c]])
        ks = max(abs((ref[c] <= v).mean() - (cur[c] <= v).mean()) for v in every)
        assert got[c]["ks"] == pytest.approx(ks, abs=1e-12)
    assert got["gone"]["ks"] is None and got["gone"]["wasserstein"] is None
