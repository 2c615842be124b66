import json
import os

import pytest
from pyspark.sql import functions as F

from fraudlake.sources import files


def test_month_starts(spark):
    got = [str(r[0]) for r in files.month_starts(spark, "2018-01-15", "2018-04-01").collect()]
    assert got == ["2018-01-01", "2018-02-01", "2018-03-01", "2018-04-01"]


def test_snapshot_rerun_overwrites_month_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snap")
    df = spark.createDataFrame([("2020-01-05", 1), ("2020-02-07", 2), ("2020-02-09", 3), (None, 4)], "date string, v int")
    files.write_snapshots(df, path, "date")
    files.write_snapshots(df.filter(F.col("v") == 2), path, "date")
    got = {str(r["snapshot_date"]): r["count"] for r in files.read_snapshots(spark, path).groupBy("snapshot_date").count().collect()}
    assert got == {"2020-01-01": 1, "2020-02-01": 1}
    assert files.read_snapshots(spark, path, start="2020-02-01").count() == 1


def test_json_maps(spark, tmp_dir):
    small = os.path.join(tmp_dir, "mcc.json")
    with open(small, "w") as fh:
        json.dump({"5411": "Grocery Stores, Supermarkets", "7538": "Auto Service"}, fh)
    rows = {r[0]: r[1] for r in files.read_json_map(spark, small, "mcc_code", "mcc_description").collect()}
    assert rows["5411"] == "Grocery Stores, Supermarkets"
    big = os.path.join(tmp_dir, "labels.json")
    with open(big, "w") as fh:
        json.dump({"target": {str(i): ("Yes" if i % 7 == 0 else "No") for i in range(5000)}}, fh)
    lab = files.read_json_map(spark, big, "transaction_id", "is_fraud", prefix="target", splittable=True)
    assert lab.count() == 5000 and lab.select("transaction_id").distinct().count() == 5000
    assert lab.filter("is_fraud = 'Yes'").count() == len([i for i in range(5000) if i % 7 == 0])


def _fragments(spark, text):
    frags = spark.createDataFrame([(f,) for f in text.split(",")], "value string")
    return {r["k"]: r["v"] for r in files.parse_pair_fragments(frags, "value", "k", "v", "target").collect()}


def test_fragments_keep_scalars_and_fail_rather_than_lose_pairs(spark):
    assert _fragments(spark, '{"target":{"1":"Yes","2":null,"3":1}}') == {"1": "Yes", "2": None, "3": "1"}
    for text in ('{"target":{"1":"No, maybe","2":"No"}}', '{"meta":{"a":"b"},"target":{"1":"Yes"}}'):
        with pytest.raises(Exception, match="not one pair of the map"):
            _fragments(spark, text)


def test_unix_seconds_in_any_session_zone(spark):
    from fraudlake.functions import columns as C

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            row = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07' AS ts").select(C.local_to_unix_seconds("ts", "America/New_York").alias("s"))
            assert row.first()["s"] == 1704085207
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
