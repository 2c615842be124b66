"""Structured Streaming forms of the scoring and ingest paths.

All sinks are native file sinks with their own checkpoint folder under the
shared ``spark.checkpoint.dir`` (exactly-once per micro-batch; no Python
``foreachBatch`` callback). ``run_available`` drains what is there now
(``trigger(availableNow=True)``) and stops, which is how tests and batch
schedulers run a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from ..operators.gold import add_time_features
from ..operators.joins import maybe_broadcast
from ..operators.online import one_per_key
from ..session import scratch_path


def read_table_stream(spark: SparkSession, folder: str, file_name: str, schema: StructType,
                      max_files: int | None = None) -> DataFrame:
    """A parquet file stream over ``folder``, limited to files named ``file_name``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_name)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def run_available(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Drain the stream into a file sink (append) and stop; returns the sink path."""
    w = (
        df.writeStream.format(fmt).outputMode("append")
        .option("path", path).option("checkpointLocation", path + "._checkpoint")
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return path


def enrich_stream(requests: DataFrame, profiles: DataFrame, key: str = "card_number") -> DataFrame:
    """Stream-static LEFT join of requests with profiles, then the shared time features.

    Request columns win on a name clash; unmatched requests keep NULL profile
    fields and ``matched = 0`` so they can be routed to a reject sink. Of several
    profiles of one key the last counts, so a request never multiplies.
    """
    clash = [c for c in profiles.columns if c in requests.columns and c != key]
    # the stream must be the outer side; the static profiles are broadcast when measured small
    prof = maybe_broadcast(one_per_key(profiles, key).drop(*clash).withColumn("_found", F.lit(1)))
    joined = requests.join(prof, key, "left")
    return add_time_features(joined).withColumn("matched", F.coalesce(F.col("_found"), F.lit(0))).drop("_found")


def prediction_log(scored: DataFrame, time_col: str, id_col: str, label_col: str) -> DataFrame:
    """Prediction records ``(event_time seconds, event_date, transaction_id, is_fraud)``.

    A zone-less (``TIMESTAMP_NTZ``) time is read as UTC wall-clock time whatever
    the session zone; a zoned timestamp is an instant already.
    """
    t = F.col(time_col)
    if isinstance(scored.schema[time_col].dataType, TimestampNTZType):
        seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
    else:
        seconds = F.unix_timestamp(t)
    return scored.select(
        seconds.cast("long").alias("event_time"), F.to_date(t).alias("event_date"),
        F.col(id_col).cast("string").alias("transaction_id"), F.col(label_col).cast("int").alias("is_fraud"),
    )


def windowed_counts(stream: DataFrame, time_col: str, by: list[str], window: str = "1 day",
                    watermark: str = "1 day") -> DataFrame:
    """T4: tumbling-window counts with a watermark (``time_col`` cast to TIMESTAMP first)."""
    ts = F.col(time_col).cast("timestamp")
    s = stream.withColumn("_ts", ts).withWatermark("_ts", watermark)
    return s.groupBy(F.window("_ts", window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))


def closed_windows(spark: SparkSession, events: DataFrame, markers: str, time_col: str, by: list[str],
                   window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """T4 in append mode: the counts of windows that are over, each emitted once.

    Append mode holds a window back until the watermark passes its end, so the last windows of a
    stream that stops would never come out. ``markers`` is a folder of closing markers, one time
    each (``write_marker``), that joins the stream before the watermark: a marker moves the
    watermark and is counted nowhere. Events that come later than a closed window are dropped,
    as are all that are later than the watermark.
    """
    marks = spark.readStream.schema("closes_at timestamp").parquet(markers)
    both = events.select(F.col(time_col).cast("timestamp").alias("_ts"), *by, F.lit(1).alias("_one")).unionByName(
        marks.select(F.col("closes_at").alias("_ts"), F.lit(0).alias("_one")), allowMissingColumns=True)
    counts = both.withWatermark("_ts", watermark).groupBy(F.window("_ts", window).alias("w"), *by).agg(
        F.sum("_one").cast("long").alias("n"))
    return counts.filter(F.col("n") > 0)


def write_marker(spark: SparkSession, markers: str, closes_at: Column | None) -> None:
    """Append a closing marker; None only makes the folder, which a stream must find when it starts."""
    one = spark.range(0 if closes_at is None else 1)
    one.select((F.lit(None) if closes_at is None else closes_at).cast("timestamp").alias("closes_at")).write.mode("append").parquet(markers)


def dedup_stream(stream: DataFrame, time_col: str, key: str, watermark: str = "1 day") -> DataFrame:
    """T5: drop repeated ``key`` within the watermark (state is bounded by the watermark)."""
    s = stream.withColumn("_ts", F.col(time_col).cast("timestamp")).withWatermark("_ts", watermark)
    return s.dropDuplicatesWithinWatermark([key]).drop("_ts")


def ingest_files(spark: SparkSession, source_dir: str, schema: StructType, fmt: str, sink: str,
                 date_col: str, max_files: int | None = None) -> str:
    """Incremental bronze ingest - new raw files become monthly ``snapshot_date`` partitions."""
    reader = spark.readStream.schema(schema).option("header", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.format(fmt).load(source_dir)
    snap = raw.withColumn("snapshot_date", F.trunc(F.to_date(F.col(date_col).cast("timestamp")), "MM"))
    return run_available(snap.filter(F.col("snapshot_date").isNotNull()), sink, ["snapshot_date"])


def new_sink(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
