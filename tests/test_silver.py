from pyspark.sql import functions as F

from fraudlake.functions import columns as C
from fraudlake.operators import silver


def test_money_and_month_text(spark):
    df = spark.createDataFrame(
        [("$-77.00", "24.0", " 03/2019 ", None), ("$24295", "$24.5", "13/2020", "ok"), ("junk", None, None, None)],
        "amount string, limit_text string, month string, state string",
    )
    r = df.select(
        C.money_to_float("amount").alias("f"), C.money_to_int("limit_text").alias("i"),
        C.month_text_to_date("month").alias("d"), C.fill_state("state").alias("s"),
    ).collect()
    assert r[0]["f"] == -77.0 and r[0]["i"] == 24 and str(r[0]["d"]) == "2019-03-01" and r[0]["s"] == "online"
    assert r[1]["f"] == 24295.0 and r[1]["i"] == 24 and r[1]["d"] is None and r[1]["s"] == "ok"
    assert r[2]["f"] is None and r[2]["i"] is None and r[2]["d"] is None


def test_clean_transactions_fills(spark):
    df = spark.createDataFrame(
        [("1", None, None, None, "$1.50", "Swipe Transaction", "NYC"), ("2", " CA ", "1537.0", " Bad PIN ", "$-2", "Chip", "LA")],
        "id string, merchant_state string, zip string, errors string, amount string, use_chip string, merchant_city string",
    )
    out = {r["id"]: r for r in silver.clean_transactions(df).collect()}
    assert out["1"]["merchant_state"] == "online" and out["1"]["zip"] == "0" and out["1"]["errors"] == "no_error"
    assert out["2"]["merchant_state"] == "ca" and out["2"]["zip"] == "1537" and out["2"]["errors"] == "bad pin"
    assert out["2"]["use_chip"] == "Chip" and out["2"]["merchant_city"] == "la"


def test_cast_report_counts_new_nulls(spark):
    raw = spark.createDataFrame([("$10", "01/2020"), ("x", "13/2020"), (None, None)], "credit_limit string, expires string")
    rep = {r["column_name"]: r["nulls_made"] for r in silver.cast_report(raw, silver.clean_cards(raw), ["credit_limit", "expires"]).collect()}
    assert rep == {"credit_limit": 1, "expires": 1}


def test_time_features_null_in_null_out(spark):
    from fraudlake.operators.gold import add_time_features
    df = spark.createDataFrame([("2020-03-31", "2020-01-01", 2018), ("2020-03-31", None, None)],
                               "date string, acct_open_date string, year_pin_last_changed int")
    r = add_time_features(df.withColumn("acct_open_date", F.to_date("acct_open_date"))).collect()
    assert r[0]["acct_opened_months"] == 3.0 and r[0]["yrs_since_pin_changed"] == 2
    assert r[1]["acct_opened_months"] is None and r[1]["yrs_since_pin_changed"] is None
