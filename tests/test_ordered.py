import numpy as np
from pyspark.sql import functions as F

from fraudlake.operators import metrics, ordered


def test_running_sums_match_pandas(spark):
    df = spark.range(0, 5000).select(F.col("id"), ((F.col("id") * 7919) % 13).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("f"))
    out = ordered.running_sums(df, ["k", "id"], ["f"], partitions=7).toPandas().sort_values("rn")
    ref = df.toPandas().sort_values(["k", "id"]).reset_index(drop=True)
    assert list(out["id"]) == list(ref["id"])
    assert list(out["rn"]) == list(range(1, 5001))
    assert list(out["cum_f"]) == list(ref["f"].cumsum())


def test_rolling_rate_matches_window(spark):
    df = spark.range(0, 3000).select("id", (F.col("id") % 5 == 0).cast("int").alias("flag"))
    out = ordered.rolling_rate(df, ["id"], "flag", 100, keep=["id"]).toPandas().sort_values("id")
    ref = df.toPandas().sort_values("id")["flag"].rolling(100).mean()
    assert np.allclose(out["rolling_rate"].fillna(-1).to_numpy(), ref.fillna(-1).to_numpy())


def test_auc_against_brute_force(spark):
    rows = [(i, int(i % 4 == 0), round(((i * 37) % 100) / 100 + (0.2 if i % 4 == 0 else 0), 2)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    auc = metrics.roc_auc(df, "label", "score").first()["roc_auc"]
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    brute = sum((sum(n < p for n in neg) + 0.5 * sum(n == p for n in neg)) for p in pos) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12


def test_running_sums_descending_order(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 2).cast("int").alias("f"))
    out = ordered.running_sums(df, [F.desc("id")], ["f"], partitions=5).toPandas().sort_values("rn")
    assert list(out["id"]) == list(range(999, -1, -1))
    assert list(out["cum_f"]) == list(np.cumsum([i % 2 for i in range(999, -1, -1)]))


def test_rolling_window_longer_than_data_is_null(spark):
    df = spark.range(0, 50).select("id", F.lit(1).alias("flag"))
    out = ordered.rolling_rate(df, ["id"], "flag", 100, keep=["id"]).collect()
    assert len(out) == 50 and all(r["rolling_rate"] is None for r in out)


def test_running_sums_empty_input(spark):
    df = spark.range(0).select("id", F.lit(1).alias("f"))
    assert ordered.running_sums(df, ["id"], ["f"], partitions=3).count() == 0


def test_average_precision_against_brute_force(spark):
    rows = [(i, int(i % 3 == 0), round(((i * 53) % 50) / 50, 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    ap = metrics.average_precision(df, "label", "score").first()["avg_precision"]
    P = sum(y for _, y, _ in rows)
    total = 0.0
    for s in sorted({s for _, _, s in rows}, reverse=True):
        tp = sum(1 for _, y, x in rows if x >= s and y == 1)
        fp = sum(1 for _, y, x in rows if x >= s and y == 0)
        pos_here = sum(1 for _, y, x in rows if x == s and y == 1)
        total += pos_here / P * (tp / (tp + fp))
    assert abs(ap - total) < 1e-12
