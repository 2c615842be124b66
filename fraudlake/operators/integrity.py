"""Referential checks between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-NULL child keys that have no parent row (column ``k``).

    ``distinct`` aggregates map-side first, so a hot key costs one row per task.
    """
    ck = child.select(F.col(child_key).alias("k")).filter(F.col("k").isNotNull()).distinct()
    pk = parent.select(F.col(parent_key).alias("k"))
    return ck.join(pk, "k", "left_anti")


def orphan_report(checks: list[tuple[str, DataFrame, str, DataFrame, str]], examples: int = 5) -> DataFrame:
    """Per check ``(check_name, missing, examples)``; examples are the smallest orphan keys, comma-joined.

    The ``row_number() <= n`` filter is planned as a partial window group limit
    before the shuffle, so no task sorts all orphans of a check.
    """
    spark = checks[0][1].sparkSession
    orphans = reduce(
        DataFrame.unionByName,
        [missing_keys(c, ck, p, pk).select(F.lit(name).alias("check_name"), F.col("k").cast("string").alias("k"))
         for name, c, ck, p, pk in checks],
    )
    # one NULL-key row per check so checks without orphans still report 0
    zeros = reduce(
        DataFrame.unionByName,
        [spark.range(1).select(F.lit(name).alias("check_name"), F.lit(None).cast("string").alias("k"))
         for name, *_ in checks],
    )
    counts = orphans.unionByName(zeros).groupBy("check_name").agg(F.count("k").alias("missing"))
    w = Window.partitionBy("check_name").orderBy("k")
    top = orphans.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= examples)
    ex = top.groupBy("check_name").agg(F.concat_ws(",", F.array_sort(F.collect_list("k"))).alias("examples"))
    return counts.join(ex, "check_name", "left").select(
        "check_name", "missing", F.coalesce("examples", F.lit("")).alias("examples")
    )


def unlabeled_share(items: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Items with no label row: ``(total, unlabeled, unlabeled_pct)``, percent to 2 places."""
    flagged = items.select(key).join(labels.select(key).distinct().withColumn("_has", F.lit(1)), key, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_has").isNull()).alias("unlabeled"),
    ).select(
        "total", "unlabeled",
        F.round(F.col("unlabeled").cast("double") * 100.0 / F.col("total"), 2).alias("unlabeled_pct"),
    )
