"""Classifier metrics as aggregates over a scored table.

Every metric accepts ``by`` (e.g. ``split_id``) and is computed for all groups
in the same pass. Rank metrics first group rows by distinct score (map-side
partial aggregation), then take running sums in score order with
``ordered.running_sums`` - no task holds all scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_sums

EPS = 1e-15


def _by(by: str | list[str] | None) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def predict(score: str | Column, threshold: float = 0.5) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (s >= F.lit(float(threshold))).cast("int")


def confusion(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """``(by..., label, prediction, n)``."""
    return df.groupBy(*_by(by), F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def f1_scores(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """Tp, fp, fn, tn, precision, recall, F1 (0 when undefined), positive class 1."""
    y, p = F.col(label), F.col(pred)
    agg = df.groupBy(*_by(by)).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    safe = lambda num, den: F.when(den > 0, num / den).otherwise(F.lit(0.0))
    return agg.select(
        *_by(by), "tp", "fp", "fn", "tn",
        safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def log_loss(df: DataFrame, label: str, prob: str, by=None) -> DataFrame:
    """Mean binary cross-entropy with p clipped to [1e-15, 1 - 1e-15]."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    y = F.col(label).cast("double")
    loss = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return df.groupBy(*_by(by)).agg(F.avg(loss).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def score_groups(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """Positives and negatives per distinct score (and group)."""
    y = F.col(label)
    return df.groupBy(*_by(by), F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """AUC = sum_s pos(s) * (neg below s + neg(s)/2) / (P * N); tied scores count half."""
    g = score_groups(df, label, score, by)
    keys = _by(by)
    cum = running_sums(g, [*keys, "score"], ["neg"])
    # running sums run across groups in key order; remove the earlier groups' share
    if keys:
        first = cum.groupBy(*keys).agg(F.min(F.col("cum_neg") - F.col("neg")).alias("_base"))
        cum = cum.join(F.broadcast(first), keys)  # one row per group of ``by``
        below = F.col("cum_neg") - F.col("neg") - F.col("_base")
    else:
        below = F.col("cum_neg") - F.col("neg")
    contrib = F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") / 2.0)
    agg = cum.groupBy(*keys).agg(F.sum(contrib).alias("_s"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                 F.col("_s") / (F.col("_p").cast("double") * F.col("_n").cast("double")))
    return agg.select(*keys, auc.alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """AP = sum over scores descending of (R_n - R_{n-1}) * P_n, ties taken together."""
    g = score_groups(df, label, score, by)
    keys = _by(by)
    cum = running_sums(g, [*keys, F.desc("score")], ["pos", "neg"])
    if keys:
        base = cum.groupBy(*keys).agg(
            F.min(F.col("cum_pos") - F.col("pos")).alias("_bp"), F.min(F.col("cum_neg") - F.col("neg")).alias("_bn")
        )
        cum = cum.join(F.broadcast(base), keys)  # one row per group of ``by``
        tp, fp = F.col("cum_pos") - F.col("_bp"), F.col("cum_neg") - F.col("_bn")
    else:
        tp, fp = F.col("cum_pos"), F.col("cum_neg")
    term = F.col("pos").cast("double") * (tp.cast("double") / (tp + fp).cast("double"))
    agg = cum.groupBy(*keys).agg(F.sum(term).alias("_s"), F.sum("pos").alias("_p"))
    return agg.select(*keys, F.when(F.col("_p") > 0, F.col("_s") / F.col("_p").cast("double")).alias("avg_precision"))


def curve_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct threshold (descending): tpr, fpr, precision, recall."""
    g = score_groups(df, label, score)
    cum = running_sums(g, [F.desc("score")], ["pos", "neg"])
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = float(tot["P"] or 0), float(tot["N"] or 0)
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    return cum.select(
        F.col("score").alias("threshold"),
        (tp / F.lit(P) if P else F.lit(None).cast("double")).alias("tpr"),
        (fp / F.lit(N) if N else F.lit(None).cast("double")).alias("fpr"),
        (tp / (tp + fp)).alias("precision"),
    )


def running_champion(trials: DataFrame, trial: str, value: str) -> DataFrame:
    """Best value before each trial, whether it is a new champion, and its improvement in percent.

    improvement = |previous best - value| / value * 100 for a new champion after the first.
    The window has no partition: it is meant for a trials table (one row per trial).
    """
    prior = Window.orderBy(trial).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.max(F.col(value)).over(prior)
    out = trials.withColumn("prev_best", prev)
    champ = F.col("prev_best").isNull() | (F.col(value) > F.col("prev_best"))
    return out.select(
        trial, value, "prev_best", champ.cast("int").alias("is_champion"),
        F.when(champ & F.col("prev_best").isNotNull(),
               F.abs(F.col("prev_best") - F.col(value)) / F.col(value) * 100.0).alias("improvement_pct"),
    )


def metric_table(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, keys, "full"), frames)
