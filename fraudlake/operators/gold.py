"""Gold step: point-in-time feature rows (J1, J3, J4) and time features.

``add_time_features`` is the single definition used by the gold table, batch
scoring and the scoring stream, so training and serving cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pin_age_years, tenure_months
from .joins import dimension_join, maybe_broadcast_all


def add_time_features(df: DataFrame, tx_date: str = "date", open_date: str = "acct_open_date",
                      pin_year: str = "year_pin_last_changed") -> DataFrame:
    """Date cut to DATE, account tenure (months) and PIN age (years)."""
    return df.withColumns({
        tx_date: F.to_date(F.col(tx_date)),
        "acct_opened_months": tenure_months(tx_date, open_date),
        "yrs_since_pin_changed": pin_age_years(tx_date, pin_year),
    })


def build_features(tx: DataFrame, users: DataFrame, cards: DataFrame, mcc: DataFrame) -> DataFrame:
    """Tx LEFT users (client_id=id) LEFT cards (card_id=id) LEFT mcc (mcc=mcc_code).

    Duplicate keys are dropped after each join; unmatched rows keep NULLs. Each
    dimension is broadcast only when its measured size allows, otherwise the
    join shuffles on the key (AQE splits a hot card or client).
    """
    users, cards, mcc = maybe_broadcast_all([users, cards, mcc])
    out = dimension_join(tx, users, "client_id", "id", checked=True)
    out = dimension_join(out, cards, "card_id", "id", drop=("client_id",), checked=True)
    out = dimension_join(out, mcc, "mcc", "mcc_code", checked=True)
    return add_time_features(out)


def attach_labels(features: DataFrame, labels: DataFrame, key: str = "transaction_id", how: str = "inner",
                  require_rows: bool = True) -> DataFrame:
    """J3 (inner, must not be empty) / J4 (left) join of features and labels."""
    joined = features.join(labels, key, how)
    if require_rows and how == "inner" and joined.isEmpty():
        raise ValueError("feature/label join produced no rows")
    return joined
