"""Silver step: type and normalise raw tables (P1-P8), one projection per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

# Target types of the silver schema (fixed values: the reference's typed layout).
CARD_TYPES = {
    "id": "string", "client_id": "string", "card_number": "string", "card_brand": "string",
    "card_type": "string", "has_chip": "string", "card_on_dark_web": "string", "cvv": "string",
    "credit_limit": "int", "num_cards_issued": "int", "year_pin_last_changed": "int",
}
USER_TYPES = {
    "id": "string", "gender": "string", "address": "string", "current_age": "int",
    "retirement_age": "int", "birth_year": "int", "birth_month": "int", "credit_score": "int",
    "num_credit_cards": "int", "per_capita_income": "int", "yearly_income": "int", "total_debt": "int",
}
TRANSACTION_TYPES = {
    "id": "string", "client_id": "string", "card_id": "string", "merchant_id": "string",
    "mcc": "string", "zip": "string", "errors": "string", "date": "timestamp",
}
CARD_CATEGORIES = ["card_brand", "card_type", "has_chip", "card_on_dark_web"]
USER_MONEY = ["per_capita_income", "yearly_income", "total_debt"]


def _apply(df: DataFrame, exprs: dict) -> DataFrame:
    """One select: replaced columns in place, untouched columns passed through."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def cast_map(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast present columns by a ``{column: type}`` map, NULL on bad values."""
    return _apply(df, {c: C.safe_cast(c, t) for c, t in types.items() if c in df.columns})


def clean_cards(df: DataFrame) -> DataFrame:
    e = {}
    for c in ("expires", "acct_open_date"):
        if c in df.columns:
            e[c] = C.month_text_to_date(c)
    for c in CARD_CATEGORIES:
        if c in df.columns:
            e[c] = C.norm_category(c)
    if "credit_limit" in df.columns:
        e["credit_limit"] = C.money_to_int("credit_limit")
    for c, t in CARD_TYPES.items():
        if c in df.columns and c not in e:
            e[c] = C.safe_cast(c, t)
    return _apply(df, e)


def clean_users(df: DataFrame) -> DataFrame:
    e = {}
    if "gender" in df.columns:
        e["gender"] = C.lower_only("gender")
    if "address" in df.columns:
        e["address"] = C.norm_category("address")
    for c in USER_MONEY:
        if c in df.columns:
            e[c] = C.money_to_int(c)
    for c, t in USER_TYPES.items():
        if c in df.columns and c not in e:
            e[c] = C.safe_cast(c, t)
    return _apply(df, e)


def clean_mcc(df: DataFrame) -> DataFrame:
    return _apply(df, {"mcc_code": C.lower_only("mcc_code"), "mcc_description": C.norm_category("mcc_description")})


def clean_labels(df: DataFrame) -> DataFrame:
    return _apply(df, {"transaction_id": C.lower_only("transaction_id"), "is_fraud": C.norm_category("is_fraud")})


def clean_transactions(df: DataFrame) -> DataFrame:
    """P2-P5, P7, P8 on raw transactions; ``use_chip`` passes through untouched."""
    e = {}
    if "merchant_city" in df.columns:
        e["merchant_city"] = C.lower_only("merchant_city")
    if "merchant_state" in df.columns:
        e["merchant_state"] = C.fill_state("merchant_state")
    if "zip" in df.columns:
        e["zip"] = C.fill_zip("zip")
    if "errors" in df.columns:
        e["errors"] = C.fill_errors("errors")
    if "amount" in df.columns:
        e["amount"] = C.money_to_float("amount")
    for c, t in TRANSACTION_TYPES.items():
        if c in df.columns and c not in e:
            e[c] = C.safe_cast(c, t)
    return _apply(df, e)


def cast_report(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """NULLs created by cleaning, per column (``column_name, nulls_made``), from two one-pass aggregates.

    ``before`` and ``after`` must be the same rows (``after`` = clean(``before``)).
    """
    b = before.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    a = after.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    bl = b.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, nulls_before)")
    al = a.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, nulls_after)")
    return bl.join(al, "column_name").select(
        "column_name", (F.col("nulls_after") - F.col("nulls_before")).cast("long").alias("nulls_made")
    )
