"""Plan shape (pruning reaches the scan) and behaviour on a key holding a third of the rows."""
import os
import re

from pyspark.sql import functions as F

from fraudlake.operators import integrity, metrics, model, online, splits
from fraudlake.plans import queries as Q
from fraudlake.sources import files
from paths import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_scan_reads_only_needed_columns(spark):
    plan = _plan(Q.gold_features(spark, SF_SMALL))
    li = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert li and "l_tax" not in li[0] and "l_quantity" not in li[0]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_snapshot_month_filter_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snap")
    df = spark.createDataFrame([("2020-01-05", 1), ("2020-02-07", 2), ("2020-03-09", 3)], "date string, v int")
    files.write_snapshots(df, path, "date")
    plan = _plan(files.read_snapshots(spark, path, start="2020-02-01"))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date#\d+ >= 2020-02-01", plan), plan


def _hot(spark, n=3000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 4 == 0).cast("int").alias("label"), (F.col("id") % 97 / 97.0).alias("score"),
    )


def test_last_per_key_with_hot_key(spark):
    out = {r["k"]: r["id"] for r in online.last_per_key(_hot(spark), "k", ["id"]).collect()}
    assert out[0] == 2997 and len(out) == 2001


def test_orphans_with_hot_key(spark):
    child = _hot(spark)
    parent = spark.range(1, 3000).select(F.col("id").alias("k"))
    rep = integrity.orphan_report([("hot", child, "k", parent, "k")]).first()
    assert rep["missing"] == 1 and rep["examples"] == "0"


def test_stratified_split_on_skewed_classes(spark):
    df = _hot(spark).withColumn("label", (F.col("k") == 0).cast("int"))
    out = splits.stratified_split(df, "id", "label", 0.2, 7)
    got = {r["label"]: (r["n"], r["t"]) for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got[1] == (1000, 200) and got[0] == (2000, 400)


def test_auc_grouped_by_hot_key(spark):
    df = _hot(spark).withColumn("g", (F.col("k") == 0).cast("int"))
    by = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(df, "label", "score", by="g").collect()}
    one = metrics.roc_auc(df.filter("g = 1"), "label", "score").first()["roc_auc"]
    assert abs(by[1] - one) < 1e-12


def test_estimators_by_name(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense([float(i % 5), float(i % 3)]), int(i % 5 > 2), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label", "weight"])
    for name in ("logistic", "gbt", "mlp"):
        est = model.make_estimator(name, {"n_estimators": 5, "max_depth": 2, "hidden": 4, "max_iter": 10}, 2,
                                   weight=None if name == "mlp" else "weight")
        out = model.positive_probability(est.fit(df).transform(df))
        assert out.filter(F.col("p1").between(0, 1)).count() == 60
