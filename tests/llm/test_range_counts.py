"""The order of a crowd's shingles comes from counts of a fixed size, not from a row for each shingle."""
import numpy as np
import pytest

from fraudlake.llm import neardup


@pytest.fixture
def crowd(spark):
    rng = np.random.default_rng(5)
    often = rng.integers(0, 2**64, 20, dtype=np.uint64)
    sets = [np.sort(np.concatenate([often, rng.integers(0, 2**64, 180, dtype=np.uint64)])) for _ in range(300)]
    rows = [(i, bytearray(x.tobytes()), i) for i, x in enumerate(sets)]
    return often, sets, spark.createDataFrame(rows, "rep long, shingles binary, label long").coalesce(2)


def test_counting_makes_rows_by_task_not_by_shingle(spark, crowd):
    _, sets, df = crowd
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = neardup._range_counts(df).count()
        counts = neardup._counts(df)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert rows <= 2 * neardup.PARTS < 54_000  # 54,020 distinct shingles
    want = np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=neardup.HEAVY)
    assert len(counts) == neardup.HEAVY == 1 << 20 and (counts == want).all()
    assert neardup._counts(df.limit(0)).sum() == 0


def test_frequent_shingles_come_last(crowd):
    often, _, df = crowd
    got = np.array([r.h for r in neardup._prefixes(df, (50, 100)).collect()]).view(np.uint64)
    assert len(got) == 300 * 101 and not np.isin(got, often).any()
