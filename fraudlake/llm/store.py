"""Reading the document tables, written intermediates, and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import saved, scratch_path  # noqa: F401 - the operators take both from here

#: Rows up to which a side of a join is broadcast; it is counted first.
BROADCAST_ROWS = 100_000

#: Parts into which the rows of one key are dealt when a side is too large to broadcast.
SALTS = 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", *, rows: int | None = None) -> DataFrame:
    """Join a lookup table with one row per key, whatever share of ``left`` one key holds.

    ``rows``: the counted rows of ``right``. Up to BROADCAST_ROWS it is broadcast. Beyond, or if they
    weren't counted, the rows of each key are dealt over SALTS parts, by a hash of the whole row, so that
    a repeated task deals them alike, and the lookup rows are copied to each part. Those copies are always
    shuffled: Spark would size them by the written file, which may be small for what it holds.
    """
    if rows is not None and rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), key, how)
    hashed = [c for c in left.columns if "map<" not in left.schema[c].dataType.simpleString()]
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(F.lit(7), *hashed), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [key, "__salt"], how).drop("__salt")


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, and the columns named: no other name can meet theirs."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[docs[c] for c in names])


def unpacked(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``row``, but those given anew."""
    return [(changed[c] if c in changed else F.col("row").getField(c)).alias(c) for c in docs.columns]


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written frame of narrow rows for broadcast if it has so few; else it is shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


def id_type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()


def bucket_of(doc_id: str, n: int):
    """crc32(doc_id as text) mod n; a null id gives null."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n)).cast("int")
