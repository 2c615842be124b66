import numpy as np
from pyspark.sql import functions as F

from fraudlake.operators import drift, prep, resample
from paths import SF_SMALL


def _vectors(spark, n=300, d=6, classes=2):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % classes), [float(x) for x in rng.normal(size=d)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, label int, v array<double>")


def test_knn_blocks_match_brute_force(spark):
    rows, df = _vectors(spark)
    got = resample.knn_within_class(df, "id", "label", "v", k=4, block_rows=32).collect()  # many blocks per class
    got = {(r["id"], r["rank"]): r["nn_id"] for r in got}
    for i, lbl, v in rows:
        cands = sorted((float(np.sum((np.array(v) - np.array(w)) ** 2)), j) for j, l2, w in rows if l2 == lbl and j != i)
        assert [got[(i, r)] for r in range(1, 5)] == [j for _, j in cands[:4]]


def test_smote_balances_and_stays_between_parents(spark):
    rows = [(i, 1 if i < 40 else 0, [float(i % 7), float(i % 5)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    out = resample.smote(df, "id", "label", "v", k=3, seed=1, block_rows=16)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 160, 1: 160}
    vec = {i: np.array(v) for i, _, v in rows}
    for r in out.filter("is_synthetic = 1").collect():
        a, b, x = vec[r["parent_id"]], vec[r["neighbour_id"]], np.array(r["v"])
        lo, hi = np.minimum(a, b) - 1e-9, np.maximum(a, b) + 1e-9
        assert np.all(x >= lo) and np.all(x <= hi)


def test_one_hot_unknown_is_all_zero_and_mode_fills(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    enc = prep.OneHot.fit(train, ["c"])
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    rows = enc.dummy_columns(test.withColumn("k", F.monotonically_increasing_id())).orderBy("k").collect()
    assert [(r["c=a"], r["c=b"]) for r in rows] == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_standardiser_population_std_after_imputation(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    st = prep.Standardiser.fit(train, ["x"])
    mean, std = st.params["x"]
    assert mean == 2.0 and abs(std - np.std([1.0, 3.0, 2.0])) < 1e-12


def test_drift_report_rows_and_flag(spark):
    ref = spark.createDataFrame([("a", 1.0)] * 50 + [("b", 2.0)] * 50, "c string, x double")
    cur = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 9.0)] * 95, "c string, x double")
    cols, ds = drift.drift_report(ref, cur, ["x"], ["c"], threshold=0.2, share=0.5)
    assert ds.first()["dataset_drift"] == 1
    rep = drift.report_rows(cols, run_id="r1")
    assert {r["run_id"] for r in rep.collect()} == {"r1"} and rep.count() == 2


def test_read_csv_schema_and_missing(spark, tmp_dir):
    import os
    import pytest
    from pyspark.errors import AnalysisException
    from fraudlake.sources import files
    p = os.path.join(tmp_dir, "cards.csv")
    with open(p, "w") as fh:
        fh.write("id,cvv,credit_limit\n1,007,$24295\n")
    r = files.read_csv(spark, p, ["id", "cvv", "credit_limit"]).first()
    assert r["cvv"] == "007" and r["credit_limit"] == "$24295"
    with pytest.raises(AnalysisException):
        files.read_csv(spark, os.path.join(tmp_dir, "missing.csv"), ["id"])
