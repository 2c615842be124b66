from pyspark.sql import functions as F

from fraudlake.operators import splits
from fraudlake.plans import fixtures as fx
from paths import SF_SMALL


def test_oot_sets_disjoint_and_complete(spark):
    tx = fx.transactions(spark, SF_SMALL)
    out = splits.split_oot(tx, "date", 3, 30)
    assert out.count() == tx.count()
    b = {r["split_id"]: (r["lo"], r["hi"]) for r in out.groupBy("split_id").agg(F.min(F.to_date("date")).alias("lo"), F.max(F.to_date("date")).alias("hi")).collect()}
    assert b["oot3"][1] < b["oot2"][0] and b["oot2"][1] < b["oot1"][0] and b["train"][1] < b["oot3"][0]


def test_stratified_sizes(spark):
    ev = fx.scored_events(spark, SF_SMALL)
    out = splits.stratified_split(ev, "event_id", "label", 0.2, 42)
    for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == int(0.2 * r["n"] + 0.5)
    assert out.count() == ev.count()


def test_undersample_balances(spark):
    ev = fx.scored_events(spark, SF_SMALL)
    out = splits.undersample(ev, "event_id", "label", 1.0, 42)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1]
