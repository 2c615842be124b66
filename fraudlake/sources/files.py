"""File sources and sinks of the pipeline.

Raw CSV is read with an explicit all-STRING schema (typing happens in the
silver step), JSON maps are parsed JVM-side, and monthly snapshots live in
ONE table partitioned by ``snapshot_date`` so that month filters prune
directories instead of naming paths.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import month_start

# Column lists of the raw inputs (fixed values: the raw file layouts).
RAW_COLUMNS = {
    "transactions": [
        "id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id",
        "merchant_city", "merchant_state", "zip", "mcc", "errors",
    ],
    "cards": [
        "id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv", "has_chip",
        "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed", "card_on_dark_web",
    ],
    "users": [
        "id", "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address",
        "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt", "credit_score",
        "num_credit_cards",
    ],
}


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with header, every column STRING (no inference pass, leading zeros kept).

    A missing path raises ``AnalysisException`` at definition time.
    """
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(string_schema(columns)).option("enforceSchema", "false")
    return reader.csv(path)


def parse_json_map(text: Column, key_name: str, value_name: str) -> list[Column]:
    """S3 helper: explode a JSON object text ``{k: v, ...}`` into (key, value) columns."""
    m = F.from_json(text, "map<string,string>")
    return [F.explode(m).alias(key_name, value_name)]


def read_json_map(spark: SparkSession, path: str, key_name: str, value_name: str,
                  prefix: str | None = None, splittable: bool = False) -> DataFrame:
    """Read a JSON object of string pairs as rows.

    ``splittable=False``: whole-file read + ``from_json`` (values may hold commas).
    ``splittable=True``: the file is split on ``,`` so one large object is read by
    many tasks; each fragment holds one ``"key": scalar`` pair, possibly
    preceded by the opening brace(s) or followed by the closing ones. Other files
    (a value with a comma, a second object) make it fail; ``json_ranges.read_json_ranges``
    reads any object by many tasks. ``prefix`` names an enclosing key (``{"target": {...}}``).
    """
    if not splittable:
        raw = spark.read.option("wholetext", "true").text(path)
        text = F.col("value")
        if prefix is not None:
            text = F.get_json_object(text, f"$.{prefix}")
        return raw.select(*parse_json_map(text, key_name, value_name))
    frags = spark.read.option("lineSep", ",").text(path)
    return parse_pair_fragments(frags, "value", key_name, value_name, prefix)


PAIR_RE = r'"((?:[^"\\]|\\.)*)"\s*:\s*(?:"((?:[^"\\]|\\.)*)"|(null|true|false|-?[0-9][0-9.eE+-]*))[\s}]*$'
OPEN_RE = r'"((?:[^"\\]|\\.)*)"\s*:\s*\{'


def parse_pair_fragments(df: DataFrame, text_col: str, key_name: str, value_name: str, prefix: str | None = None) -> DataFrame:
    """S4 helper: one ``"k": scalar`` pair per fragment (opening braces ignored).

    A fragment that is neither blank nor one pair fails the job, as does a pair that
    opens an object of another name than ``prefix``: no pair is lost or taken in silently.
    Such files go through the whole-file path. A JSON null gives a NULL value.
    """
    t = F.col(text_col)
    text, plain = F.regexp_extract(t, PAIR_RE, 2), F.regexp_extract(t, PAIR_RE, 3)
    value = F.when(plain == "", text).when(plain != "null", plain)
    opens = F.regexp_extract(t, OPEN_RE, 1)
    foreign = (t.rlike(OPEN_RE) & (opens != prefix)) if prefix is not None else F.lit(False)
    bad = F.raise_error(F.concat(F.lit("not one pair of the map: "), F.substring(t, 1, 200))).cast("boolean")
    keep = F.when(t.rlike(r"^[\s{}]*$"), False).when(t.rlike(PAIR_RE) & ~foreign, True).otherwise(bad)
    return df.select(F.regexp_extract(t, PAIR_RE, 1).alias(key_name), value.alias(value_name), keep.alias("_ok")).filter("_ok").drop("_ok")


def month_starts(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """First-of-month dates from start's month up to ``end`` inclusive."""
    return spark.range(1).select(month_sequence(F.lit(str(start)), F.lit(str(end))))


def month_sequence(start: Column, end: Column) -> Column:
    """S9 as a generator column over DATE/TIMESTAMP/text bounds."""
    return F.explode(
        F.sequence(F.trunc(F.to_date(start), "MM"), F.to_date(end), F.expr("interval 1 month"))
    ).alias("snapshot_date")


def write_snapshots(df: DataFrame, path: str, date_col: str = "date", start: str | None = None,
                    end: str | None = None) -> None:
    """K1: one pass writes every month as a ``snapshot_date`` partition.

    Dynamic partition overwrite: a rerun replaces exactly the months present and
    keeps the others. Rows with NULL date or outside [start month, end] land nowhere.
    Rows are dealt by month, and adaptive execution splits a month that is too large for one task.
    """
    snap = df.withColumn("snapshot_date", month_start(date_col))
    cond = F.col("snapshot_date").isNotNull()
    if start is not None:
        cond &= F.col("snapshot_date") >= F.trunc(F.to_date(F.lit(start)), "MM")
    if end is not None:
        cond &= F.col("snapshot_date") <= F.to_date(F.lit(end))
    (
        snap.filter(cond)
        .hint("rebalance", "snapshot_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """All months of a snapshot table, optionally from ``start`` on (partition pruning)."""
    df = spark.read.option("basePath", path).parquet(path)
    if start is not None:
        df = df.filter(F.col("snapshot_date") >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(F.col("snapshot_date") <= F.to_date(F.lit(end)))
    return df


def file_stats(df: DataFrame, name: str) -> DataFrame:
    """One summary row (name, rows, columns, schema text) without a driver preview."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("name"),
        F.col("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def append_table(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """K5/K6: append rows (file created on first write)."""
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """K2: full overwrite."""
    df.write.mode("overwrite").parquet(path)


def read_predictions(df: DataFrame, start_s: int, end_s: int, time_col: str = "event_time") -> DataFrame:
    """Predictions with ``start_s <= time <= end_s`` (Unix seconds), oldest first.

    When the log is partitioned by ``event_date`` the date bounds prune files.
    """
    cond = F.col(time_col).between(F.lit(int(start_s)), F.lit(int(end_s)))
    if "event_date" in df.columns:
        # a day is added on both sides: event_date may follow another time zone; time_col decides
        lo = F.date_sub(F.to_date(F.timestamp_seconds(F.lit(int(start_s)))), 1)
        hi = F.date_add(F.to_date(F.timestamp_seconds(F.lit(int(end_s)))), 1)
        cond = F.col("event_date").between(lo, hi) & cond
    return df.filter(cond).orderBy(time_col, "transaction_id")
