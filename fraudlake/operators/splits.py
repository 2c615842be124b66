"""Train/test carving: out-of-time windows (W3, W4), stratified and quota selection.

Random membership comes from ``md5(seed:id)``, identical in every engine and
stable across task retries. Selecting "the first q rows of a class in hash
order" is done without a per-class window over the whole class: rows are
bucketed by a hash prefix, bucket counts locate the one boundary bucket per class,
and only that bucket is ranked.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .joins import maybe_broadcast

#: Classes that the per-class steps of SMOTE handle; splits and undersampling have no bound.
MAX_CLASSES = 10_000


def oot_cutoffs(df: DataFrame, date_col: str, splits: int, days: int) -> list[dt.date]:
    """Cutoffs c_i = max(D_i) - days with D_{i+1} = dates of D_i before c_i.

    Each step is one small aggregate over the distinct dates (a calendar-bounded
    set); only the k cutoff dates come back to the driver.
    """
    dates = df.select(F.to_date(F.col(date_col)).alias("d")).filter(F.col("d").isNotNull()).distinct()
    cutoffs: list[dt.date] = []
    hi = dates.agg(F.max("d")).first()[0]
    for _ in range(splits):
        if hi is None:
            break
        c = hi - dt.timedelta(days=days)
        cutoffs.append(c)
        hi = dates.filter(F.col("d") < F.lit(c)).agg(F.max("d")).first()[0]
    return cutoffs


def split_oot(df: DataFrame, date_col: str, splits: int, days: int, out: str = "split_id") -> DataFrame:
    """Label rows ``oot1`` (latest window) .. ``ootk``; the rest (and NULL dates) ``train``.

    Windows are inclusive: ``date >= cutoff``, as the reference carves them.
    """
    d = F.to_date(F.col(date_col))
    expr: Column | None = None
    for i, c in enumerate(oot_cutoffs(df, date_col, splits, days), start=1):
        cond = d >= F.lit(c)
        expr = F.when(cond, F.lit(f"oot{i}")) if expr is None else expr.when(cond, F.lit(f"oot{i}"))
    label = F.lit("train") if expr is None else expr.otherwise(F.lit("train"))
    return df.withColumn(out, label)


def split_cutoffs(df: DataFrame, date_col: str, cutoffs: dict[str, str], out: str = "split_id",
                  default: str = "train") -> DataFrame:
    """Named start dates; a row goes to the latest window whose start it reaches."""
    d = F.to_date(F.col(date_col))
    expr: Column | None = None
    for name, start in sorted(cutoffs.items(), key=lambda kv: kv[1], reverse=True):
        cond = d >= F.to_date(F.lit(start))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr.otherwise(F.lit(default)) if expr is not None else F.lit(default))


def hash_key(id_col: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string")))


def class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[0]: r[1] for r in rows}


def select_first_by_hash(df: DataFrame, id_col: str, label: str, quota: Column | dict, seed: int | str,
                         out: str = "selected", digits: int = 4) -> DataFrame:
    """Mark the first rows of each class in ``(md5(seed:id), id)`` order, as many as its quota.

    ``quota``: an expression of ``_n``, the rows of the class, or a dict from class to rows.
    Exact, and no task ever ranks more than one hash bucket of one class: of the buckets of a
    class, those before the cut are taken whole and only the one at the cut is ranked. The cuts
    are one row per class, so any number of classes works; they are broadcast if few.
    """
    spark = df.sparkSession
    tagged = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, digits))
    per_class = Window.partitionBy("_sl")
    buckets = tagged.groupBy(F.col(label).alias("_sl"), "_b").agg(F.count(F.lit(1)).alias("_cnt")).select(
        "*", F.sum("_cnt").over(per_class).alias("_n"), F.sum("_cnt").over(per_class.orderBy("_b")).alias("_upto")
    )
    if isinstance(quota, dict):
        label_type = df.schema[label].dataType.simpleString()
        q = spark.createDataFrame([(k, int(v)) for k, v in quota.items()], f"_lbl {label_type}, _quota bigint")
        buckets = buckets.join(F.broadcast(q), F.col("_sl").eqNullSafe(F.col("_lbl")), "left")
    else:
        buckets = buckets.withColumn("_quota", quota)
    left = F.coalesce("_quota", F.lit(0)) - (F.col("_upto") - F.col("_cnt"))
    cuts = buckets.groupBy("_sl").agg(
        F.min(F.when(F.col("_cnt") > left, F.struct(F.col("_b").alias("bucket"), left.alias("left")))).alias("_cut")
    )
    checkpoint_root(spark)
    j = tagged.join(maybe_broadcast(cuts.checkpoint(eager=True)), F.col(label).eqNullSafe(F.col("_sl")))
    at_cut = F.coalesce((F.col("_b") == F.col("_cut.bucket")) & (F.col("_cut.left") > 0), F.lit(False))
    before = F.coalesce(F.col("_b") < F.col("_cut.bucket"), F.lit(True))  # no cut: the whole class
    ranks = Window.partitionBy("_sl", "_b").orderBy("_h", id_col)
    ranked = j.filter(at_cut).withColumn(out, F.row_number().over(ranks) <= F.col("_cut.left"))
    return j.filter(~at_cut).withColumn(out, before).unionByName(ranked).select(*df.columns, out)


def hash_cutoffs(rows: DataFrame, group: list[str], id_col: str, quota: Column, digits: int = 4) -> DataFrame:
    """``(group..., h, id)``: the last row of each group's quota in the order of ``(h, id)``.

    ``rows`` has a text hash ``h``; ``quota`` is an expression of ``_n``, the rows of the group, and of
    the group's columns. Groups without quota have no row. Buckets of the hash are counted, and only the one that holds the last
    row is ranked. One row per group comes out.
    """
    per = Window.partitionBy(*group)
    rows = rows.select(*group, F.col(id_col).alias("id"), "h", F.substring("h", 1, digits).alias("_b"))
    counts = rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_cnt")).select(
        "*", F.sum("_cnt").over(per).alias("_n"), F.sum("_cnt").over(per.orderBy("_b")).alias("_upto")
    )
    left = (quota - (F.col("_upto") - F.col("_cnt"))).alias("_left")
    at = counts.select(*group, "_b", "_cnt", left).filter(F.col("_left").between(1, F.col("_cnt"))).drop("_cnt")
    ranked = rows.join(maybe_broadcast(at), [*group, "_b"]).withColumn("_r", F.row_number().over(per.orderBy("h", "id")))
    return ranked.filter("_r = _left").select(*group, "h", "id")


def split_trials(df: DataFrame, id_col: str, label: str, fraction: float, seeds: list[int], out: str = "val") -> DataFrame:
    """W6 for many seeds at once: ``out``, an array with one flag per seed, as ``stratified_split`` sets it.

    The cuts (one per seed and class) are found in one pass over all seeds.
    """
    spark = df.sparkSession
    keys = F.array(*(hash_key(id_col, s) for s in seeds))
    every = df.select(F.col(label).alias("_c"), F.col(id_col), F.posexplode(keys).alias("_t", "h"))
    cuts = hash_cutoffs(every, ["_t", "_c"], id_col, half_up(F.lit(float(fraction)) * F.col("_n")))
    found: dict = {}
    for r in cuts.collect():  # one row per seed and class
        found.setdefault(r["_c"], [None] * len(seeds))[r["_t"]] = (r["h"], r["id"])
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    table = spark.createDataFrame([(c, v) for c, v in found.items()], f"_c {types[label]}, _cut array<struct<h:string,id:{types[id_col]}>>")
    flags = F.array(*(
        F.coalesce(F.struct(hash_key(id_col, s).alias("h"), F.col(id_col).alias("id")) <= F.col("_cut")[t], F.lit(False)) for t, s in enumerate(seeds)
    ))
    return df.join(F.broadcast(table), F.col(label).eqNullSafe(F.col("_c")), "left").select(*df.columns, flags.alias(out))


def half_up(x: Column) -> Column:
    return F.floor(x + F.lit(0.5)).cast("long")


def stratified_split(df: DataFrame, id_col: str, label: str, fraction: float = 0.2, seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """Per class, the first ``round(fraction * n_class)`` rows in hash order are test."""
    return select_first_by_hash(df, id_col, label, half_up(F.lit(float(fraction)) * F.col("_n")), seed, out)


def undersample(df: DataFrame, id_col: str, label: str, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """M6: keep every minority row and ``round(ratio * n_minority)`` majority rows per other class."""
    n_min = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.min("_n")).first()[0] or 0
    n = F.col("_n")
    quota = F.when(n == n_min, n).otherwise(F.least(n, half_up(F.lit(float(ratio) * n_min))))
    return select_first_by_hash(df, id_col, label, quota, seed, "_keep").filter("_keep").drop("_keep")
