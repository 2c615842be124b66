"""Data profiling.

Each report is one pass of aggregates over the table, wide (one expression
per column) and then reshaped to long form with ``stack``; nothing but
per-column metadata (a few numbers per column) comes back to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from .comoments import pair_correlations
from .ordered import quantiles
from ..session import saved

QUARTILES = [0.25, 0.5, 0.75]


def _stack(df: DataFrame, keep: list[str], items: list[tuple[str, list[str]]], names: list[str]) -> DataFrame:
    """Unpivot a one-row wide frame: each item = (label, [column per output name])."""
    parts = ", ".join(", ".join([f"'{label}'"] + [f"`{c}`" for c in cs]) for label, cs in items)
    expr = f"stack({len(items)}, {parts}) as (column_name, {', '.join(names)})"
    return df.select(*keep, F.expr(expr))


def pct(num: Column | str, den: Column | str) -> Column:
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return n.cast("double") * 100.0 / d.cast("double")


def profile_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: ``(column_name, missing, missing_pct)`` for columns with NULLs only."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in cols])
    long = _stack(wide, ["_n"], [(c, [f"m_{c}"]) for c in cols], ["missing"])
    return long.filter(F.col("missing") > 0).select("column_name", "missing", pct("missing", "_n").alias("missing_pct"))


def profile_cardinality(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """A4: ``(column_name, unique_values, missing_values, cardinality_pct)``.

    Reported columns: id-like names, text columns, and columns with at most two
    values. ``exact=False`` uses HyperLogLog (``approx_count_distinct``) - the
    right choice for very wide tables at scale.
    """
    cols = cols or df.columns
    distinct = (lambda c: F.count_distinct(F.col(c))) if exact else (lambda c: F.approx_count_distinct(F.col(c)))
    wide = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[distinct(c).alias(f"u_{c}") for c in cols],
        *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in cols],
    )
    long = _stack(wide, ["_n"], [(c, [f"u_{c}", f"m_{c}"]) for c in cols], ["unique_values", "missing_values"])
    text_like = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, StringType)]
    id_like = [c for c in cols if "id" in c.lower()]
    keep = F.col("column_name").isin(sorted(set(text_like + id_like))) | (F.col("unique_values") <= 2)
    return long.filter(keep).select(
        "column_name", "unique_values", "missing_values",
        F.round(pct("unique_values", "_n"), 2).alias("cardinality_pct"),
    )


def few_values(df: DataFrame, cols: list[str], max_values: int = 10) -> DataFrame:
    """``(column_name, value, n)`` of the columns with 1 to ``max_values`` distinct values, NULL counted
    beside them, from one scan.

    Each task counts a column's values until it has seen too many and gives the column up; so a
    task sends a few rows per column, whatever the columns hold, and a column that any task, or
    all together, gave up is left out.
    """
    texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[dict | None] = [{} for _ in cols]
        for b in batches:
            for i, own in enumerate(seen):
                if own is None:
                    continue
                for x in pc.value_counts(b.column(i)).to_pylist():
                    own[x["values"]] = own.get(x["values"], 0) + x["counts"]
                if len(own) - (None in own) > max_values:
                    seen[i] = None
        rows = [(i, v, n) for i, own in enumerate(seen) if own is not None for v, n in own.items()]
        rows += [(i, None, -1) for i, own in enumerate(seen) if own is None]  # given up
        at, value, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(value, pa.string()), pa.array(n, pa.int64())], ["col", "value", "n"])

    counts = texts.mapInArrow(run, "col int, value string, n long").groupBy("col", "value").agg(
        F.sum(F.greatest("n", F.lit(0))).alias("n"), F.min("n").alias("_least"))
    own = Window.partitionBy("col")  # a few rows per column and task
    kept = counts.withColumns({"_up": F.min("_least").over(own), "_d": F.count("value").over(own)})
    names = F.array(*map(F.lit, cols))
    return kept.filter((F.col("_up") >= 0) & F.col("_d").between(1, max_values)).select(names[F.col("col")].alias("column_name"), "value", "n")


def profile_distribution(df: DataFrame, cols: list[str] | None = None, max_values: int = 10) -> DataFrame:
    """A5: value counts with NULL as a value: ``(column_name, value, n, pct)``, id-like columns left out."""
    cand = [c for c in (cols or df.columns) if "id" not in c.lower()]
    if not cand:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n bigint, pct double")
    return _with_share(few_values(df, cand, max_values))


def _with_share(counts: DataFrame) -> DataFrame:
    """``(column_name, value, n)`` and each count's percentage of its column's rows."""
    total = F.sum("n").over(Window.partitionBy("column_name"))
    return counts.select("column_name", "value", "n", pct(F.col("n"), total).alias("pct"))


def numeric_columns(df: DataFrame, exclude_id: bool = True) -> list[str]:
    """Numeric columns from the schema, id-like names excluded."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not (exclude_id and "id" in f.name.lower())]


def profile_numeric(df: DataFrame, cols: list[str] | None = None, exact: bool = True, digits: int = 6) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max per column.

    ``exact=True`` ranks the distinct values over range partitions (``ordered.quantiles``);
    ``exact=False`` uses ``percentile_approx``, one pass with bounded state.
    """
    cols = cols or numeric_columns(df)
    if exact:  # several passes: the rows are made once
        df = saved(df.select(*cols), "profiled")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        q = F.lit(None).cast("array<double>") if exact else F.percentile_approx(x, QUARTILES, 100000)
        aggs += [
            F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"std_{c}"),
            F.min(x).alias(f"min_{c}"), q.alias(f"q_{c}"), F.max(x).alias(f"max_{c}"),
        ]
    wide = df.agg(*aggs)
    long = _stack(wide, [], [(c, [f"n_{c}", f"mean_{c}", f"std_{c}", f"min_{c}", f"q_{c}", f"max_{c}"]) for c in cols],
                  ["count", "mean", "std", "min", "q", "max"])
    if exact:  # one row per column on either side
        long = long.drop("q").join(F.broadcast(quantiles(df, cols, QUARTILES)), "column_name", "left")
    r = lambda c: F.round(c, digits)
    return long.select(
        "column_name", "count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"),
        r(F.col("min")).alias("min"), r(F.col("q")[0]).alias("p25"), r(F.col("q")[1]).alias("p50"),
        r(F.col("q")[2]).alias("p75"), r(F.col("max")).alias("max"),
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, pct)``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.lit(label).alias("column_name"), F.col(label).cast("string").alias("value"), "n")
    return _with_share(counts).select(F.col("value").alias(label), "n", "pct")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Fixed-width bins over [min, max]: ``(bin, bin_lo, bin_hi, n)``, empty bins included."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin").cast("double") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1).cast("double") * F.lit(width)).alias("bin_hi"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair (a < b in list order), one pass for any number of columns."""
    return pair_correlations(df, cols).select("col_a", "col_b", F.round("corr", digits).alias("corr"))


def crosstab_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """A13 in long form: ``(row, col, n)`` of any number of values, NULL as a value."""
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str, values: list | None = None) -> DataFrame:
    """Counts of ``row`` x ``col`` with one column per ``col`` value, absent -> 0.

    For a column of few values, which become names of columns: ``values``, or else all that
    occur but NULL. ``crosstab_counts`` has the same counts as rows, whatever their number.
    """
    counts = crosstab_counts(df, row, col)
    if values is None:
        values = sorted(r[0] for r in counts.filter(F.col(col).isNotNull()).select(col).distinct().collect())
    piv = counts.groupBy(row).pivot(col, values).agg(F.sum("n"))
    return piv.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0).cast("long")).alias(str(v)) for v in values])


def date_range(df: DataFrame, col: str, name: str) -> DataFrame:
    """``(table_name, min_date, max_date)``."""
    d = F.to_date(F.col(col))
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date")).select(
        F.lit(name).alias("table_name"), "min_date", "max_date"
    )


def length_distribution(df: DataFrame, col: str) -> DataFrame:
    """``(length, n)`` of a text column's lengths."""
    return df.groupBy(F.length(F.col(col)).cast("int").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values (ties by value)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(k)


def transaction_flags(df: DataFrame) -> DataFrame:
    """Derived flags on silver transactions."""
    return df.withColumns({
        "is_online_merchant": (F.col("merchant_state") == "online").cast("int"),
        "is_refund": (F.col("amount") < 0).cast("int"),
        "has_error": (F.col("errors") != "no_error").cast("int"),
        "has_zip": (F.col("zip") != "0").cast("int"),
        "has_merchant_state": (F.col("merchant_state") != "online").cast("int"),
    })


def cross_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows by every combination of the flags (1/0) that occurs, and its percentage of all rows."""
    counts = df.select(*[c.cast("int").alias(name) for name, c in flags.items()]).groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # two to the number of flags rows at most
    return counts.select(*flags, "n", pct(F.col("n"), total).alias("pct"))


def cvv_available(c: str | Column = "cvv") -> Column:
    """CVV text of length 3 or more."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.length(col) >= 3).cast("int")


def flag_rates(df: DataFrame, flags: list[str]) -> DataFrame:
    """One pass: rows, and count and percent of each flag."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(f)).cast("long").alias(f"s_{f}") for f in flags])
    long = _stack(wide, ["_n"], [(f, [f"s_{f}"]) for f in flags], ["n"])
    return long.select(F.col("column_name").alias("flag"), "n", pct("n", "_n").alias("pct"))
