"""Correlations in one pass, dictionary tables, append-mode windows, scoring with rejects, the job list."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.operators import comoments
from fraudlake.operators.dictionary import Dictionary
from fraudlake.operators.model import with_profiles
from fraudlake.plans import chain
from fraudlake.streaming import jobs


def test_correlations_of_200_columns_in_one_pass(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, (400, 200)) + rng.normal(0, 1, (400, 1))
    x[rng.random(x.shape) < 0.1] = np.nan
    cols = [f"f{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r.col_a, r.col_b): (r.n, r["corr"]) for r in comoments.pair_correlations(df, cols).collect()}
    assert len(got) == 200 * 199 // 2
    for i, j in [(0, 1), (0, 199), (57, 101), (198, 199)]:
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        n, r = got[f"f{i}", f"f{j}"]
        assert n == ok.sum() and abs(r - np.corrcoef(x[ok, i], x[ok, j])[0, 1]) < 1e-9


def test_correlations_without_rows_or_spread(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in comoments.pair_correlations(none, ["a", "b"]).collect()] == [("a", "b", 0, None)]
    flat = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, 4.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): (r.n, r["corr"]) for r in comoments.pair_correlations(flat, ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): (2, None), ("a", "c"): (1, None), ("b", "c"): (1, None)}


def test_states_merge_in_any_order():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4))
    x[rng.random(x.shape) < 0.3] = np.nan
    whole = comoments.batch_state(x)
    parts = [comoments.batch_state(p) for p in (x[:1], x[1:20], x[20:20], x[20:])]
    for order in ([0, 1, 2, 3], [3, 2, 0, 1]):
        got = parts[order[0]]
        for k in order[1:]:
            got = comoments.merge_states(got, parts[k])
        assert np.allclose(got[[0, 3, 4, 5]], whole[[0, 3, 4, 5]])


def test_dictionary_of_one_category_a_row_and_a_hot_one(spark):
    train = spark.createDataFrame([(i, f"k{i:04d}", "hot" if i % 3 else None, None) for i in range(900)], "id long, a string, b string, c string")
    enc = Dictionary.fit(train, ["a", "b", "c"])
    assert enc.size == 901 and enc.modes["b"] == "hot"
    rows = spark.createDataFrame([(1, "k0007", "hot", "x"), (2, "new", None, None), (3, None, "cold", None)], "id long, a string, b string, c string")
    got = {r.id: list(r.indices) for r in enc.indices(rows, "id").collect()}
    assert got == {1: [7, 900], 2: [900], 3: [0]}  # a tie of modes takes the least value
    assert all(len(r.indices) == 2 for r in enc.indices(train, "id").collect())


def test_dictionary_of_an_empty_table(spark):
    none = spark.createDataFrame([], "id long, a string")
    enc = Dictionary.fit(none, ["a"])
    assert enc.size == 0
    assert [list(r.indices) for r in enc.indices(spark.createDataFrame([(1, "x")], "id long, a string"), "id").collect()] == [[]]


def test_closed_windows_come_out_once(spark, tmp_dir):
    src, sink, marks = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/marks"
    day = dt.datetime(2024, 1, 1)

    def put(*rows):
        spark.createDataFrame(list(rows), "ts timestamp, kind string").coalesce(1).write.mode("append").parquet(src)

    def drain():
        events = spark.readStream.schema("ts timestamp, kind string").parquet(src)
        counts = jobs.closed_windows(spark, events, marks, "ts", ["kind"], "1 day", "1 hour")
        jobs.run_available(counts.select(F.to_date("w.start").alias("day"), "kind", "n"), sink)
        return sorted(((str(r.day), r.kind, r.n) for r in spark.read.schema("day date, kind string, n long").parquet(sink).collect()), key=str)

    jobs.write_marker(spark, marks, None)
    put((day, "a"), (day + dt.timedelta(hours=3), "a"), (day + dt.timedelta(days=1), None))
    assert drain() == []  # the watermark lies an hour before the last event
    put((day + dt.timedelta(days=1, hours=5), None))
    first = [("2024-01-01", "a", 2)]
    assert drain() == first
    jobs.write_marker(spark, marks, F.lit(day + dt.timedelta(days=2, hours=1)))
    both = sorted([*first, ("2024-01-02", None, 2)], key=str)
    assert drain() == both
    assert drain() == both  # nothing new: no row twice
    put((day, "late"))
    assert drain() == both


def test_requests_of_unknown_cards_are_rejected_alone(spark):
    req = spark.createDataFrame(
        [("t1", "4001", dt.date(2024, 1, 31), "req"), ("t2", "nope", dt.date(2024, 1, 31), "req"), ("t3", None, dt.date(2024, 1, 31), "req")],
        "transaction_id string, card_number string, date date, use_chip string")
    prof = spark.createDataFrame(
        [("4001", dt.date(2024, 1, 1), 2020, "old"), ("4001", dt.date(2024, 1, 16), 2021, "new")],
        "card_number string, acct_open_date date, year_pin_last_changed int, use_chip string")
    got = {r.transaction_id: r for r in with_profiles(req, prof).collect()}
    assert [got[t].rejected for t in ("t1", "t2", "t3")] == [False, True, True]
    assert got["t1"].acct_opened_months == 0.5 and got["t1"].yrs_since_pin_changed == 3 and got["t1"].use_chip == "req"
    assert got["t2"].acct_opened_months is None


def test_the_job_list_is_checked():
    chain.check(chain.JOBS)
    with pytest.raises(ValueError, match="before they are made"):
        chain.check([chain.Job("gold", "labels", lambda s, x: x, ("silver/labels",))])
    with pytest.raises(ValueError, match="made twice"):
        chain.check([chain.JOBS[0], chain.JOBS[0]])
    with pytest.raises(ValueError, match="one raw file or tables"):
        chain.check([chain.Job("gold", "x", lambda s: None)])


def test_a_run_replaces_its_months_and_keeps_the_others(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    job = [chain.JOBS[0], next(j for j in chain.JOBS if j.name == "silver/transactions")]

    def put(*rows):
        spark.createDataFrame(list(rows), "id string, date string, amount string").write.mode("overwrite").option("header", "true").csv(f"{raw}/transactions_data.csv")

    put(("007", "2024-01-05 00:00:00", "$1.50"), ("2", "2024-02-05 00:00:00", "$2"), ("3", None, "$3"))
    chain.run(spark, raw, out, jobs=job)
    put(("9", "2024-02-07 00:00:00", "$-4"))
    folder = chain.run(spark, raw, out, "2024-02-01", "2024-02-29", jobs=job)
    assert [(r.id, r.amount) for r in folder.read("silver/transactions").collect()] == [("9", -4.0)]
    every = chain.Folder(spark, raw, out, monthly={"silver/transactions"}).read("silver/transactions")
    assert sorted((r.id, r.amount) for r in every.collect()) == [("007", 1.5), ("9", -4.0)]
