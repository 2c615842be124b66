import json

from fraudlake.operators import online


def test_key_value_last_row_wins_and_nulls(spark):
    df = spark.createDataFrame([("c1", "2020-01-01", "a", None), ("c1", "2021-01-01", "b", 5), ("c2", None, "z", 1)],
                               "card_number string, opened string, brand string, lim int")
    kv = {r["key"]: json.loads(r["value"]) for r in online.to_key_value(df, "card_number", order=["opened"]).collect()}
    assert kv["c1"]["brand"] == "b" and kv["c1"]["lim"] == "5"
    assert kv["c2"]["opened"] == ""


def test_lookup_rejects_unknown(spark):
    req = spark.createDataFrame([("t1", "c1", "web"), ("t2", "c9", "pos")], "transaction_id string, card_number string, channel string")
    prof = spark.createDataFrame([("c1", "gold", "app")], "card_number string, brand string, channel string")
    m, rej = online.lookup_profiles(req, prof)
    assert [r["channel"] for r in m.collect()] == ["web"]
    assert [r["transaction_id"] for r in rej.collect()] == ["t2"]


def test_lookup_takes_the_last_of_two_profiles_and_keeps_null_cards(spark):
    req = spark.createDataFrame([("t1", "c1"), ("t2", "c1"), ("t3", None)], "transaction_id string, card_number string")
    prof = spark.createDataFrame([("c1", "gold", 1), ("c1", "basic", 2), (None, "none", 3)], "card_number string, brand string, card_id int")
    m, rej = online.lookup_profiles(req, prof, order=["card_id"])
    assert sorted((r["transaction_id"], r["brand"]) for r in m.collect()) == [("t1", "basic"), ("t2", "basic")]
    assert [r["transaction_id"] for r in rej.collect()] == ["t3"]
