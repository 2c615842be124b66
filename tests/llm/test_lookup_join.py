"""Lookup tables that are small as files and large in memory aren't broadcast uncounted."""
from pyspark.sql import functions as F

from fraudlake.llm import store


def _sides(spark):
    left = store.saved(spark.range(500).select((F.col("id") % 3).alias("h"), F.col("id").alias("x")), "left")
    right = store.saved(spark.range(20_000).select((F.col("id") % 2).alias("h"), F.lit(7).alias("y")), "right")
    return left, right


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_shuffled(spark):
    left, right = _sides(spark)
    for rows in (None, store.BROADCAST_ROWS + 1):
        out = store.lookup_join(left, right, "h", "inner", rows=rows)
        assert out.count() == 334 * 10_000
        out.write.format("noop").mode("overwrite").save()
        assert "Broadcast" not in _plan(out)


def test_counted_rows_are_broadcast(spark):
    left, right = _sides(spark)
    one = store.saved(right.groupBy("h").agg(F.max("y").alias("y")), "one")
    out = store.lookup_join(left, one, "h", rows=one.count())
    assert "Broadcast" in _plan(out)
    assert sorted((r.x, r.y) for r in out.collect()) == [(i, None if i % 3 == 2 else 7) for i in range(500)]
