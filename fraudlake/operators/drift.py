"""Drift between a reference table and a current table.

PSI = sum over categories of (q - p) * ln(q / p), p the reference share and q
the current share, both floored at ``PSI_FLOOR``. Numeric columns are binned
at the reference deciles (duplicate edges merged, NULL its own bin). KS is
the largest gap between the two empirical CDFs, the normed Wasserstein distance
the area between them over the reference's standard deviation; both come from
per-value counts and running sums in value order (no task sorts a whole column).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import exceeded, quantiles, running_sums

PSI_FLOOR = 0.0001
#: Least norm of a Wasserstein distance (fixed value).
NORM_FLOOR = 0.001
DECILES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


SIDE = "_is_ref"


def tag_sides(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """One frame of both sides with a reference flag (``_is_ref`` 1/0)."""
    return ref.withColumn(SIDE, F.lit(1)).unionByName(cur.withColumn(SIDE, F.lit(0)))


def _long_values(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """(side, column_name, value) triples for the given column expressions."""
    return df.select(F.col(SIDE), F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), expr.cast("string").alias("value")) for name, expr in cols.items()
    ])).alias("p")).select(SIDE, "p.*")


def _psi(values: DataFrame, floor: float = PSI_FLOOR) -> DataFrame:
    """PSI per column from ONE pass over (side, column_name, value) rows.

    Counts of both sides come out of the same grouping (a value seen on one
    side only counts 0 on the other); each column's counts sum to the side's
    row count, taken from a per-column aggregate (one row per column, broadcast).
    """
    counts = values.groupBy("column_name", "value").agg(
        F.count_if(F.col(SIDE) == 1).alias("n_ref"), F.count_if(F.col(SIDE) == 0).alias("n_cur")
    )
    totals = counts.groupBy("column_name").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    j = counts.join(F.broadcast(totals), "column_name").select(
        "column_name",
        F.greatest(F.col("n_ref").cast("double") / F.col("t_ref").cast("double"), F.lit(floor)).alias("p"),
        F.greatest(F.col("n_cur").cast("double") / F.col("t_cur").cast("double"), F.lit(floor)).alias("q"),
    )
    return j.groupBy("column_name").agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"))


def psi_categorical_tagged(tagged: DataFrame, cols: list[str], floor: float = PSI_FLOOR) -> DataFrame:
    """D1 on a side-tagged frame: ``(column_name, psi)``; NULL is a category."""
    return _psi(_long_values(tagged, {c: F.col(c) for c in cols}), floor)


def psi_categorical(ref: DataFrame, cur: DataFrame, cols: list[str], floor: float = PSI_FLOOR) -> DataFrame:
    """``(column_name, psi)`` per categorical column (NULL is a category)."""
    return psi_categorical_tagged(tag_sides(ref, cur), cols, floor)


def decile_edges(ref: DataFrame, cols: list[str]) -> dict[str, list[float]]:
    """Reference deciles per column (9 numbers each), duplicates merged, ascending."""
    found = {r["column_name"]: r["q"] for r in quantiles(ref, cols, DECILES).collect()}
    return {c: sorted(set(found.get(c, []))) for c in cols}


def bin_values(tagged: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(side, column_name, value): each value's bin, how many edges of its column it exceeds; NULL -> -1.

    The columns are spread to rows first, so one short expression serves them all: one for each
    column makes a method too long for the JVM's compiler.
    """
    long = tagged.select(F.col(SIDE), F.posexplode(F.array(*[F.col(c).cast("double") for c in edges])).alias("col", "v"))
    value = F.when(F.col("v").isNull(), F.lit(-1)).otherwise(exceeded(F.col("col"), F.col("v"), list(edges.values())))
    names = F.array(*map(F.lit, edges))
    return long.select(SIDE, F.get(names, "col").alias("column_name"), value.alias("value"))


def psi_numeric_tagged(tagged: DataFrame, cols: list[str], floor: float = PSI_FLOOR) -> DataFrame:
    """D2(a) on a side-tagged frame: PSI over bins at the reference deciles."""
    edges = decile_edges(tagged.filter(F.col(SIDE) == 1), cols)
    return _psi(bin_values(tagged, edges), floor)


def psi_numeric(ref: DataFrame, cur: DataFrame, cols: list[str], floor: float = PSI_FLOOR) -> DataFrame:
    """D2(a): PSI over bins at the reference deciles."""
    return psi_numeric_tagged(tag_sides(ref, cur), cols, floor)


def distances_tagged(tagged: DataFrame, cols: list[str]) -> DataFrame:
    """D2(b, c) on a side-tagged frame: ``(column_name, ks, wasserstein)`` per column, NULLs ignored.

    ``wasserstein`` is normed by the reference's population standard deviation, ``NORM_FLOOR`` at
    least. A column without values on either side has NULLs.
    """
    vals = tagged.select(F.col(SIDE), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("p")).select(SIDE, "p.*").filter(F.col("v").isNotNull())
    g = vals.groupBy("column_name", "v").agg(
        F.count_if(F.col(SIDE) == 1).alias("n_ref"), F.count_if(F.col(SIDE) == 0).alias("n_cur")
    )
    cum = running_sums(g, ["column_name", "v"], ["n_ref", "n_cur"], lead=["v"])
    n, v = F.col("n_ref").cast("double"), F.col("v")
    mean = F.sum(n * v) / F.sum(n)
    per_col = cum.groupBy("column_name").agg(
        F.min(F.col("cum_n_ref") - F.col("n_ref")).alias("_br"), F.min(F.col("cum_n_cur") - F.col("n_cur")).alias("_bc"),
        F.sum("n_ref").alias("_tr"), F.sum("n_cur").alias("_tc"), F.max("v").alias("_most"), F.when(F.sum(n) > 0, mean).alias("_mean"),
    )
    j = cum.join(F.broadcast(per_col), "column_name")  # one row per column
    share = lambda cum_n, base, total: F.when(F.col(total) > 0, (F.col(cum_n) - F.col(base)).cast("double") / F.col(total).cast("double"))
    gap = F.abs(share("cum_n_ref", "_br", "_tr") - share("cum_n_cur", "_bc", "_tc"))
    wide = F.when(v < F.col("_most"), F.col("next_v") - v).otherwise(F.lit(0.0))
    far = v - F.col("_mean")
    out = j.groupBy("column_name").agg(
        F.max(gap).alias("ks"), F.sum(gap * wide).alias("_area"), (F.sum(n * far * far) / F.sum(n)).alias("_var"),
    )
    return out.select("column_name", "ks", (F.col("_area") / F.greatest(F.sqrt("_var"), F.lit(NORM_FLOOR))).alias("wasserstein"))


def ks_numeric_tagged(tagged: DataFrame, cols: list[str]) -> DataFrame:
    """D2(b) on a side-tagged frame: two-sample KS statistic per column (NULLs ignored)."""
    return distances_tagged(tagged, cols).select("column_name", "ks")


def ks_numeric(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """D2(b): two-sample KS statistic per numeric column (NULLs ignored)."""
    return ks_numeric_tagged(tag_sides(ref, cur), cols)


def wasserstein_numeric_tagged(tagged: DataFrame, cols: list[str]) -> DataFrame:
    """D2(c) on a side-tagged frame: normed Wasserstein distance per column (NULLs ignored)."""
    return distances_tagged(tagged, cols).select("column_name", "wasserstein")


def wasserstein_numeric(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """D2(c): normed Wasserstein distance per numeric column (NULLs ignored)."""
    return wasserstein_numeric_tagged(tag_sides(ref, cur), cols)


def column_report_tagged(tagged: DataFrame, num_cols: list[str], cat_cols: list[str], psi_threshold: float = 0.1,
                         distance_threshold: float = 0.1) -> DataFrame:
    """The configured report: ``(column_name, kind, test, score, drifted)``, PSI for the categorical
    columns, normed Wasserstein distance for the numeric ones."""
    t = tagged.select(SIDE, *num_cols, *cat_cols)
    part = lambda df, kind, test, score, threshold: df.select(
        "column_name", F.lit(kind).alias("kind"), F.lit(test).alias("test"), F.col(score).alias("score"),
        F.coalesce((F.col(score) >= F.lit(threshold)).cast("int"), F.lit(0)).alias("drifted"))
    return part(psi_categorical_tagged(t, cat_cols), "categorical", "psi", "psi", psi_threshold).unionByName(
        part(wasserstein_numeric_tagged(t, num_cols), "numeric", "wasserstein", "wasserstein", distance_threshold))


def drift_report_tagged(tagged: DataFrame, num_cols: list[str], cat_cols: list[str], threshold: float = 0.2,
                        share: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """D1-D4 on a side-tagged frame: per-column PSI with a drift flag, and the dataset flag."""
    t = tagged.select(SIDE, *num_cols, *cat_cols)
    cols = psi_categorical_tagged(t, cat_cols).withColumn("kind", F.lit("categorical")).unionByName(
        psi_numeric_tagged(t, num_cols).withColumn("kind", F.lit("numeric"))
    ).withColumn("drifted", (F.col("psi") >= F.lit(threshold)).cast("int"))
    dataset = cols.agg(
        F.count(F.lit(1)).alias("n_columns"), F.sum("drifted").cast("long").alias("n_drifted"),
    ).select(
        "n_columns", "n_drifted", (F.col("n_drifted").cast("double") / F.col("n_columns").cast("double")).alias("share"),
        (F.col("n_drifted").cast("double") / F.col("n_columns").cast("double") >= F.lit(share)).cast("int").alias("dataset_drift"),
    )
    return cols, dataset


def drift_report(ref: DataFrame, cur: DataFrame, num_cols: list[str], cat_cols: list[str], threshold: float = 0.2,
                 share: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Per-column PSI with a drift flag, and the dataset flag (share of drifted columns >= ``share``)."""
    cols = [*num_cols, *cat_cols]
    return drift_report_tagged(tag_sides(ref.select(*cols), cur.select(*cols)), num_cols, cat_cols, threshold, share)


def report_rows(columns: DataFrame, run_id: str | None = None, run_time: dt.datetime | None = None) -> DataFrame:
    """Report rows tagged with a run id and time, ready to append to a report table."""
    rid = run_id or uuid.uuid4().hex
    rt = run_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return columns.select(F.lit(rid).alias("run_id"), F.lit(rt).alias("run_time"), "*")


def write_reference_set(df: DataFrame, cols: list[str], path: str, run_name: str) -> None:
    """K4: the training reference rows (configured columns) kept for later drift checks, one partition per run."""
    out = df.select(*cols).withColumn("run_name", F.lit(run_name))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_name").parquet(path))
