"""Column expressions used across the pipeline (all JVM-side, no UDFs).

Every raw parse goes through a ``try_*`` form: the session runs with ANSI
mode on, where a plain cast or ``to_date`` raises on bad text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_text_to_date(c: str | Column) -> Column:
    """``'MM/yyyy'`` text -> first day of that month; bad or NULL text -> NULL."""
    return F.try_to_date(F.concat_ws("/", F.lit("01"), F.trim(col_(c))), "dd/MM/yyyy")


def strip_money(c: str | Column) -> Column:
    """Drop every ``$`` from a money text (``'$-77.00'`` -> ``'-77.00'``)."""
    return F.regexp_replace(col_(c).cast("string"), r"\$", "")


def money_to_float(c: str | Column) -> Column:
    """Money text -> FLOAT (32-bit, as the silver schema); junk -> NULL."""
    return strip_money(c).try_cast("float")


def money_to_int(c: str | Column) -> Column:
    """Money text -> INT, truncating any fraction; junk or overflow -> NULL.

    ``'24.0'`` cannot be cast to INT directly under ANSI, so go through DOUBLE.
    """
    return _trunc_to_int(strip_money(c).try_cast("double"))


def _trunc_to_int(d: Column) -> Column:
    in_range = d.between(-2147483648.0, 2147483647.0)
    truncated = F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d))
    return F.when(in_range, truncated.cast("int"))


def fill_state(c: str | Column) -> Column:
    """NULL merchant state -> ``'online'``, else lower + trim."""
    c = col_(c)
    return F.when(c.isNull(), F.lit("online")).otherwise(F.lower(F.trim(c)))


def fill_zip(c: str | Column) -> Column:
    """NULL zip -> ``'0'``; zip kept as text, a trailing ``.0`` (from a numeric read) removed."""
    text = col_(c).cast("string")
    return F.coalesce(F.regexp_replace(text, r"\.0$", ""), F.lit("0"))


def fill_errors(c: str | Column) -> Column:
    """P5: NULL errors -> ``'no_error'``, else lower + trim."""
    c = col_(c)
    return F.when(c.isNull(), F.lit("no_error")).otherwise(F.trim(F.lower(c)))


def norm_category(c: str | Column) -> Column:
    """Lower + trim."""
    return F.trim(F.lower(col_(c).cast("string")))


def lower_only(c: str | Column) -> Column:
    """Lower without trim."""
    return F.lower(col_(c).cast("string"))


def safe_cast(c: str | Column, dtype: DataType | str) -> Column:
    """Cast that yields NULL instead of raising (ANSI-safe)."""
    c = col_(c)
    name = dtype if isinstance(dtype, str) else dtype.simpleString()
    if name in ("int", "integer"):
        # text such as '24.0' or '24.5' becomes 24, like a non-ANSI string->int cast
        return F.coalesce(c.try_cast("int"), _trunc_to_int(c.try_cast("double")))
    return c.try_cast(name)


def month_key(c: str | Column) -> Column:
    """``yyyy-MM`` month key of a date/timestamp."""
    return F.date_format(col_(c), "yyyy-MM")


def month_start(c: str | Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(F.to_date(col_(c)), "MM")


def tenure_months(tx_date: str | Column, open_date: str | Column) -> Column:
    """Account tenure in 30-day months at transaction date, one decimal, negative allowed."""
    days = F.datediff(F.to_date(col_(tx_date)), F.to_date(col_(open_date)))
    return F.round(days.cast("double") / F.lit(30.0), 1)


def pin_age_years(tx_date: str | Column, pin_year: str | Column) -> Column:
    """Calendar years between transaction and the last PIN change."""
    return (F.year(F.to_date(col_(tx_date))) - col_(pin_year)).cast("int")


def label_to_int(c: str | Column) -> Column:
    """Yes -> 1, no -> 0, anything else -> NULL (case and spaces ignored)."""
    v = F.trim(F.lower(col_(c)))
    return F.when(v == "yes", 1).when(v == "no", 0).cast("int")


def threshold_class(p: str | Column, t: float = 0.5) -> Column:
    """Probability >= t -> 1 else 0."""
    return (col_(p) >= F.lit(float(t))).cast("int")


def local_to_unix_seconds(ts: str | Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` -> Unix seconds, whatever the session zone."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), col_(ts).cast("timestamp_ntz"))
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc).cast("long")


def empty_if_null(c: str | Column) -> Column:
    """NULL -> ``''`` after a cast to text."""
    return F.coalesce(col_(c).cast("string"), F.lit(""))


def is_temporal(dtype: DataType) -> bool:
    return isinstance(dtype, (DateType, TimestampType, TimestampNTZType))


