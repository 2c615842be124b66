"""Online profile store as a table (J2, P13, P20, P24, K3, U4) and request lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import empty_if_null, is_temporal


def format_dates(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Every DATE/TIMESTAMP column (found from the schema) as text."""
    return df.select(*[
        F.date_format(F.col(f.name), fmt).alias(f.name) if is_temporal(f.dataType) else F.col(f.name)
        for f in df.schema.fields
    ])


def build_profiles(cards: DataFrame, users: DataFrame) -> DataFrame:
    """Cards INNER users on client_id; card ``id`` kept as ``card_id``, user id not repeated."""
    u = users.withColumnRenamed("id", "client_id")
    return cards.withColumnRenamed("id", "card_id").join(u, "client_id", "inner")


def last_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """U4: the row with the greatest ``order`` tuple per key (end ``order`` with a unique column).

    ``max_by(row, order)`` aggregates map-side first (partial aggregation;
    Spark runs it sort-based since the buffer is a struct), so a hot key sends
    one row per map task to the shuffle and never gathers its rows in one task
    (a ``row_number`` window would).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row")).select(*keys, "_row.*")


def to_json_row(cols: list[str]) -> Column:
    """JSON object of the given columns, every value text, NULL -> ''."""
    return F.to_json(F.struct(*[empty_if_null(c).alias(c) for c in cols]))


def to_key_value(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """K3: one ``(key, value)`` row per key; value = JSON of the other columns.

    Dates become ``yyyy-MM-dd`` text first; with ``order`` the last row per key wins.
    """
    if order:
        df = last_per_key(df, key, order)
    df = format_dates(df)
    value_cols = [c for c in df.columns if c != key]
    return df.select(F.col(key).alias("key"), to_json_row(value_cols).alias("value"))


def one_per_key(profiles: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """The last profile of each key by ``order`` (all other columns in turn if not given)."""
    others = [c for c in profiles.columns if c != key]
    return last_per_key(profiles, key, order or others) if others else profiles.distinct()


def lookup_profiles(requests: DataFrame, profiles: DataFrame, key: str = "card_number",
                    order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """J7 + P19: enrich each request with its profile; request fields win on a name clash.

    Returns ``(matched, rejected)``: a missing key rejects that request only,
    instead of failing the whole batch. Of several profiles of one key the last
    one counts (``one_per_key``), so a request never multiplies. Both results are
    sides of one LEFT join, split on a flag; AQE broadcasts a small side from its
    real bytes and splits a hot card.
    """
    clash = [c for c in profiles.columns if c in requests.columns and c != key]
    prof = one_per_key(profiles, key, order).drop(*clash).withColumn("_found", F.lit(True))
    joined = requests.join(prof, key, "left")
    matched = joined.filter("_found").select(*requests.columns, *[c for c in prof.columns if c not in (key, "_found")])
    rejected = joined.filter(F.col("_found").isNull()).select(*requests.columns)
    return matched, rejected


def from_key_value(kv: DataFrame, fields: list[str], key_name: str = "card_number") -> DataFrame:
    """P20: decode the JSON values of a key-value table back into text columns."""
    schema = "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"
    return kv.select(F.col("key").alias(key_name), F.from_json("value", schema).alias("_v")).select(key_name, "_v.*")
