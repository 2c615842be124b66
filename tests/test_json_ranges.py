"""A JSON object read by byte ranges against the json module, for ranges of many sizes."""
import json
import os
import random

import pytest

from fraudlake.operators import profile
from fraudlake.sources.json_ranges import read_json_ranges


def made(rng, n):
    bits = ["a", ",", '"', "\\", "{", "}", "[", "]", ":", " ", "é", "\n", "target", '": {', "x,y"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    values = [text, text, lambda: None, lambda: 12, lambda: -1.5, lambda: True, lambda: {"q": text(), "r": [1, text()]}, lambda: [text(), {}]]
    return {f"{i}{text()}": rng.choice(values)() for i in range(n)}


def plain(v):
    return v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)


@pytest.mark.parametrize("size", [40, 300, 1 << 20, 7, 1])
def test_ranges_of_any_size(spark, tmp_dir, size):
    rng = random.Random(size)
    wanted = made(rng, 12 if size == 1 else 80)
    plains = os.path.join(tmp_dir, "plain.json")
    with open(plains, "w", encoding="utf-8") as f:
        json.dump(wanted, f, ensure_ascii=False, indent=rng.choice([None, 1]))
    nested = os.path.join(tmp_dir, "nested.json")
    around = {"before": made(rng, 3), "x,target": {"k": "no"}, "target": wanted, "list": [1, {"target": {"k": "no"}}], "after": {"target": "no"}}
    with open(nested, "w", encoding="utf-8") as f:
        json.dump(around, f, ensure_ascii=rng.random() < 0.5)
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for path, prefix in ((plains, None), (nested, "target")):
            got = read_json_ranges(spark, path, "k", "v", prefix).collect()
            assert sorted((r["k"], str(r["v"])) for r in got) == sorted((k, str(plain(v))) for k, v in wanted.items())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_objects(spark, tmp_dir):
    for i, (text, prefix) in enumerate([("{}", None), ('{"target": {}}', "target"), ('{"other": {"a": 1}}', "target"), (" { } ", None)]):
        path = os.path.join(tmp_dir, f"{i}.json")
        with open(path, "w") as f:
            f.write(text)
        assert read_json_ranges(spark, path, "k", "v", prefix).collect() == []


def test_columns_of_few_values(spark):
    rows = [(i, i % 3, None if i % 2 else "x", "same" if i else "other", None) for i in range(5000)]
    df = spark.createDataFrame(rows, "many int, three int, half string, two string, none string").repartition(6)
    got = sorted((r["column_name"], str(r["value"]), r["n"]) for r in profile.few_values(df, df.columns, 3).collect())
    assert got == [("half", "None", 2500), ("half", "x", 2500), ("three", "0", 1667), ("three", "1", 1667), ("three", "2", 1666), ("two", "other", 1), ("two", "same", 4999)]
    apart = spark.range(12).repartitionByRange(12, "id").selectExpr("id as v")  # few in each task, many in all
    assert profile.few_values(apart, ["v"], 10).collect() == [] and profile.few_values(apart.filter("v < 10"), ["v"], 10).count() == 10
