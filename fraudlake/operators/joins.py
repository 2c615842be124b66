"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Defaults for the broadcast check: a dimension is broadcast only when it has at
# most this many rows AND its estimated width keeps it under the byte bound.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def estimated_row_bytes(df: DataFrame) -> int:
    """Rough in-memory row width: 40 bytes per string, 8 per other field, plus overhead."""
    return 16 + sum(40 if isinstance(f.dataType, StringType) else 8 for f in df.schema.fields)


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    rows_cap = min(max_rows, max(1, max_bytes // estimated_row_bytes(df)))
    return df.count() <= rows_cap  # one number a task; a limit would bring the rows themselves to one task


def maybe_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its measured size is bounded, else ``df`` unchanged.

    Unchanged means a shuffle join; AQE may still pick a broadcast at run time
    from real stage sizes, and its skew-join rule splits a hot key's partition.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def maybe_broadcast_all(dims: list[DataFrame], max_rows: int = MAX_BROADCAST_ROWS,
                        max_bytes: int = MAX_BROADCAST_BYTES) -> list[DataFrame]:
    """``maybe_broadcast`` for several dimensions; the size checks run as concurrent jobs."""
    with ThreadPoolExecutor(max_workers=max(1, len(dims))) as pool:
        fits = list(pool.map(lambda d: fits_broadcast(d, max_rows, max_bytes), dims))
    return [F.broadcast(d) if ok else d for d, ok in zip(dims, fits)]


def dimension_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left",
                   drop: tuple[str, ...] = (), checked: bool = False) -> DataFrame:
    """Fact-to-dimension equi-join that keeps the fact's row count for unique dim keys.

    The dimension key and any ``drop`` columns are removed from the result, as the
    gold step drops duplicate keys after each join. ``checked=True``: the caller
    already applied the broadcast decision.
    """
    d = dim if checked else maybe_broadcast(dim)
    joined = fact.join(d, fact[fact_key] == d[dim_key], how)
    for c in (dim_key, *drop):
        joined = joined.drop(d[c])
    return joined
