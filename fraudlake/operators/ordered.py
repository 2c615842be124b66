"""Global row numbers and running sums over a total order, without a one-task window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Here the rows are range-partitioned on the order key (Spark samples the
bounds), each partition numbers and sums its own sorted rows in one Arrow
pass, and the per-partition totals - one row per partition, a bound we set -
give each partition its offset. The numbered rows are checkpointed once so
every consumer sees one consistent numbering. Used by the rolling rate (W1), ROC AUC and
average precision (A19, A20), KS and Wasserstein distances (D2), and exact quantiles (A6, D2) where many
values lie about a rank.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import checkpoint_root


def _sort_key(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def running_sums(df: DataFrame, order: list[str | Column], sums: list[str], partitions: int | None = None,
                 rn_col: str = "rn", lead: list[str] | None = None) -> DataFrame:
    """Add a global 1-based row number ``rn_col``, inclusive running sums ``cum_<c>`` and, for the
    columns ``lead``, the next row's value ``next_<c>`` (NULL on the last row).

    ``order`` must be a total order (end it with a unique column); ``sums`` are
    integer columns (NULL counts as 0). Work per task is bounded by the range
    partition size, never by the table size.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [_sort_key(c) for c in order]
    ranged = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
    )
    local_fields = [StructField("_lrn", LongType(), False)] + [StructField(f"_lc_{c}", LongType(), False) for c in sums]
    lead = lead or []
    lead_fields = [StructField(f"next_{c}", ranged.schema[c].dataType, True) for c in lead]
    if lead:
        lead_fields.append(StructField("_last", IntegerType(), False))
    schema = StructType(ranged.schema.fields + local_fields + lead_fields)

    def number(batches):
        numbered = running(batches)
        if not lead:
            yield from numbered
            return
        held = None  # the last row of a batch waits for the first of the next
        for pdf in numbered:
            if not len(pdf):
                continue
            for c in lead:
                pdf[f"next_{c}"] = pdf[c].shift(-1)
                if held is not None:
                    held[f"next_{c}"] = [pdf[c].iloc[0]]
            pdf["_last"] = np.int32(0)
            if held is not None:
                yield held
            held = pdf.iloc[[-1]].copy()
            if len(pdf) > 1:
                yield pdf.iloc[:-1]
        if held is not None:
            held["_last"] = np.int32(1)
            yield held

    def running(batches):
        seen = 0
        acc = {c: 0 for c in sums}
        for pdf in batches:
            k = len(pdf)
            pdf["_lrn"] = np.arange(seen + 1, seen + k + 1, dtype="int64")
            seen += k
            for c in sums:
                cs = pd.to_numeric(pdf[c]).fillna(0).astype("int64").to_numpy().cumsum() + acc[c]
                if k:
                    acc[c] = int(cs[-1])
                pdf[f"_lc_{c}"] = cs
            yield pdf

    # Range bounds are sampled at run time, so two evaluations of this plan can
    # cut the rows differently. Materialise the numbered partitions once (a
    # reliable checkpoint in the shared spark.checkpoint.dir): the totals and
    # the offset join below then read the very same rows, and lineage is cut.
    checkpoint_root(spark)
    local = ranged.mapInPandas(number, schema).checkpoint(eager=True)
    totals = local.groupBy("_pid").agg(
        F.max("_lrn").alias("_rows"), *[F.max_by(f"_lc_{c}", "_lrn").alias(f"_t_{c}") for c in sums],
        *[F.min_by(c, "_lrn").alias(f"_f_{c}") for c in lead],
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_pid").cast(IntegerType()).alias("_pid"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.lead(f"_f_{c}").over(Window.orderBy("_pid")).alias(f"_n_{c}") for c in lead],
    )
    # offsets has one row per range partition: a size we chose, safe to broadcast
    joined = local.join(F.broadcast(offsets), "_pid")
    return joined.select(
        *df.columns,
        (F.col("_rows_before") + F.col("_lrn")).alias(rn_col),
        *[(F.col(f"_o_{c}") + F.col(f"_lc_{c}")).cast("long").alias(f"cum_{c}") for c in sums],
        *[F.when(F.col("_last") == 1, F.col(f"_n_{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in lead],
    )


#: Size of the rank sketches, and their rank error with a wide margin: a bracket reaches that far
#: to either side of a rank.
SKETCH_SIZE = 4096
SKETCH_MARGIN = 0.004
#: Values about the ranks that one window per column puts in order; beyond, running sums do.
WINDOW_VALUES = 500_000


def quantiles(df: DataFrame, cols: list[str], at: list[float]) -> DataFrame:
    """``(column_name, q)``: exact quantiles of each column, linear between ranks; NULLs are left out.

    Two passes. A mergeable rank sketch per column brackets each rank by two values. Then values are
    counted, those outside the brackets by the gap they lie in (a number per gap and task), those
    inside by value, so only these few are shuffled. The counts tell the ranks exactly; a
    rank that its bracket has missed is looked for once more in a wider one. A column of NULLs
    alone has no row.
    """
    spark = df.sparkSession
    x = {c: F.col(c).cast("double") for c in cols}
    margin, found, left = SKETCH_MARGIN, {}, list(cols)
    points = lambda m: sorted({min(max(q + e, 0.0), 1.0) for q in at for e in (-m, m)})
    edges: dict[str, list[float]] = {}
    sketch = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                    *[F.kll_sketch_agg_double(x[c], F.lit(SKETCH_SIZE)).alias(f"s{i}") for i, c in enumerate(cols)])
    while left:
        ps = points(margin)
        asked = F.array(*map(F.lit, ps))
        row = sketch.select(*[f"n{i}" for i in range(len(cols))], *[
            F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), asked)).alias(f"v{i}") for i in range(len(cols))
        ]).first()
        total = {c: row[f"n{i}"] for i, c in enumerate(cols)}
        left = [c for c in left if total[c]]
        for c in left:
            known = dict(zip(ps, row[f"v{cols.index(c)}"] or []))
            edges[c] = _merged([(-math.inf if q <= margin else known.get(q - margin, -math.inf),
                                 math.inf if q >= 1 - margin else known.get(q + margin, math.inf)) for q in at])
        picked = _ranked(df.select(*[x[c].alias(c) for c in left]), left, edges, at, total, margin) if left else {}
        found |= {c: v for c, v in picked.items() if None not in v}
        left = [c for c in left if c not in found]
        margin = margin * 8 if margin < 1 else math.inf
    rows = []
    for c in cols:
        if c in found:
            q = []
            for i, share in enumerate(at):
                lo, hi = found[c][2 * i : 2 * i + 2]
                p = float(share) * (total[c] - 1)
                q.append(lo if lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi)
            rows.append((c, q))
    return spark.createDataFrame(rows, "column_name string, q array<double>")


def _merged(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Spans in order, those that meet made one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def exceeded(col: Column, v: Column, bounds: list[list[float]], or_equal: bool = False) -> Column:
    """How many of the bounds of its column ``v`` exceeds (or is equal to); ``col`` numbers the columns."""
    out = F.lit(0)
    for j in range(max(map(len, bounds), default=0)):
        nth = F.get(F.array(*[F.lit(b[j] if j < len(b) else None).cast("double") for b in bounds]), col)
        out = out + F.coalesce((v >= nth if or_equal else v > nth).cast("int"), F.lit(0))
    return out


def _ranked(vals: DataFrame, cols: list[str], edges: dict, at: list[float], total: dict, margin: float) -> dict[str, list]:
    """By column the values at the ranks below and above each quantile; None where it isn't in a bracket."""
    pairs = vals.select(F.posexplode(F.array(*[F.col(c) for c in cols])).alias("col", "v")).filter(F.col("v").isNotNull())
    # 2i before span i, 2i + 1 in it
    starts = exceeded(F.col("col"), F.col("v"), [[lo for lo, _ in edges[c]] for c in cols], or_equal=True)
    ends = exceeded(F.col("col"), F.col("v"), [[hi for _, hi in edges[c] if hi != math.inf] for c in cols])
    pairs = pairs.withColumn("cell", starts + ends)
    inside = F.when(F.col("cell") % 2 == 1, F.col("v"))
    counts = pairs.groupBy("col", "cell", inside.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    most = sum(total[c] * min(1.0, 2 * margin * len(at)) for c in cols)
    if most <= WINDOW_VALUES:
        w = Window.partitionBy("col").orderBy("cell", "v")
        cum = counts.withColumn("cum_n", F.sum("n").over(w)).withColumn("_base", F.lit(0))
    else:
        cum = running_sums(counts, ["col", "cell", "v"], ["n"])
        first = cum.groupBy("col").agg(F.min(F.col("cum_n") - F.col("n")).alias("_base"))
        cum = cum.join(F.broadcast(first), "col")  # one row per column
    last = F.col("cum_n") - F.col("_base") - 1
    place = F.element_at(F.array(*[F.lit(total[c] - 1) for c in cols]), F.col("col") + 1)
    here = lambda rank: F.max(F.when((last - F.col("n") < rank) & (rank <= last), F.col("v")))
    picks = [here(end(F.lit(float(q)) * place)).alias(f"p{2 * i + k}") for i, q in enumerate(at) for k, end in enumerate((F.floor, F.ceil))]
    return {cols[r["col"]]: [r[f"p{i}"] for i in range(2 * len(at))] for r in cum.groupBy("col").agg(*picks).collect()}


def rolling_rate(df: DataFrame, order: list[str | Column], flag: str, n: int, keep: list[str]) -> DataFrame:
    """Mean of ``flag`` over the last ``n`` rows in ``order`` (NULL until ``n`` rows exist).

    Running sum at row i minus the running sum at row i - n, matched by an
    equi-join on the global row number.
    """
    cols = list(dict.fromkeys([*keep, flag]))
    num = running_sums(df.select(*cols, *[c for c in order if isinstance(c, str) and c not in cols]), order, [flag])
    cur = num.select(*keep, "rn", F.col(f"cum_{flag}").alias("_cum"))
    prev = num.select((F.col("rn") + F.lit(n)).alias("rn"), F.col(f"cum_{flag}").alias("_prev"))
    j = cur.join(prev, "rn", "left")
    rate = (
        F.when(F.col("rn") < n, F.lit(None).cast("double"))
        .otherwise((F.col("_cum") - F.coalesce(F.col("_prev"), F.lit(0))).cast("double") / F.lit(float(n)))
    )
    return j.select(*keep, "rn", rate.alias("rolling_rate"))
