"""Correlations of all column pairs from one pass over the rows.

A task turns each Arrow batch into six c x c matrices by matrix products: for every pair of
columns the rows where both have a value, the mean of each side over those rows, both sums of
squared deviations and the sum of products of deviations. States are merged by the pairwise
update of means and deviations, so no large sums are subtracted from each other. A task sends
one state of 6 c^2 numbers, these are merged into ``FAN_IN`` states as they arrive, and those into
one: what a task holds depends on the number of columns alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
_STATE = "part int, state binary"


def batch_state(x: np.ndarray) -> np.ndarray:
    """[6, c, c] of one batch ``x`` [rows, c] with NaN for no value: n, mean a, mean b, dev a, dev b, product."""
    seen = ~np.isnan(x)
    m = seen.astype(np.float64)
    rows = m.sum(0)
    shift = np.where(seen, x, 0.0).sum(0) / np.maximum(rows, 1.0)
    z = np.where(seen, x - shift, 0.0)
    n = m.T @ m
    k = np.maximum(n, 1.0)
    a = z.T @ m  # sums of the pair's first column where the second has a value
    square = (z * z).T @ m
    dev = np.maximum(square - a * a / k, 0.0)
    return np.stack([n, shift[:, None] + a / k, shift[None, :] + a.T / k, dev, dev.T, z.T @ z - a * a.T / k])


def merge_states(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    n = p[0] + q[0]
    k = np.maximum(n, 1.0)
    # a side without rows has means that say nothing
    da, db = (np.where((p[0] > 0) & (q[0] > 0), q[i] - p[i], 0.0) for i in (1, 2))
    both = p[0] * q[0] / k
    mean = [np.where(p[0] > 0, p[i] + d * q[0] / k, q[i]) for i, d in ((1, da), (2, db))]
    return np.stack([n, *mean, p[3] + q[3] + da * da * both, p[4] + q[4] + db * db * both, p[5] + q[5] + da * db * both])


def pair_states(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row ``(part, state)``: the merged state of all rows."""
    c = len(cols)

    def packed(state: np.ndarray | None, part: int) -> Iterator[pa.RecordBatch]:
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([state.tobytes()], pa.binary())], ["part", "state"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(c)])
            if len(x):
                new = batch_state(x)
                state = new if state is None else merge_states(state, new)
        yield from packed(state, TaskContext.get().partitionId())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for part, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                new = np.frombuffer(blob).reshape(6, c, c)
                held[part] = merge_states(held[part], new) if part in held else new
        for part, state in held.items():
            yield from packed(state, part)

    numbers = df.select(*[F.col(x).cast("double").alias(f"c{i}") for i, x in enumerate(cols)])
    # NULL and NaN both come as NaN: neither is a value
    nothing = df.sparkSession.createDataFrame([(0, bytearray(6 * c * c * 8))], _STATE)
    states = numbers.mapInArrow(gather, _STATE).unionByName(nothing)  # so that an empty table has a state too
    for parts in (FAN_IN, 1):
        states = states.withColumn("part", F.pmod(F.col("part"), F.lit(parts)).cast("int")).repartition(parts, "part").mapInArrow(merge, _STATE)
    return states


def pair_correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(col_a, col_b, n, corr)`` of every pair a < b in list order.

    ``n`` counts the rows where both have a value. ``corr`` is NULL for fewer than two of them
    or a column without spread. NaN counts as no value.
    """
    c = len(cols)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(1).to_pylist():
                n, _, _, da, db, ab = np.frombuffer(blob).reshape(6, c, c)
                i, j = np.triu_indices(c, 1)
                spread = np.sqrt(da[i, j]) * np.sqrt(db[i, j])
                ok = (n[i, j] > 1) & (spread > 0)
                r = np.where(ok, ab[i, j] / np.where(ok, spread, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols[k] for k in i]), pa.array([cols[k] for k in j]), pa.array(n[i, j].astype(np.int64)),
                     pa.array(np.clip(r, -1.0, 1.0), mask=~ok)], ["col_a", "col_b", "n", "corr"])

    return pair_states(df, cols).mapInArrow(finish, "col_a string, col_b string, n long, corr double")
