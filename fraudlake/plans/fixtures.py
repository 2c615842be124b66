"""Card-domain tables derived by Spark from the driver's test tables.

Mapping (FIXTURES.md section 3):
  transactions = lineitem JOIN orders  (card_id=l_orderkey, client_id=o_custkey,
                 mcc=l_partkey, amount=l_extendedprice, date=l_shipdate,
                 errors=l_returnflag, use_chip=l_linestatus)
  cards        = orders    users = customer    mcc = part
  keyed transactions / requests / labels = events

The raw (bronze) forms are made messy inside the query - money text with
``$``, month text with bad values, NULLs, odd case and spaces - so that the
silver step has real work to do. Every derivation has an SQL twin in
``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table


#: States of raw merchants, dealt by user so that they say nothing of the label (fixed values).
STATES = ("CL", "ER", "PU", "SI", "VI")
#: Errors of raw transactions, dealt likewise (fixed values).
ERRORS = ("BAD PIN", "BAD CVV", "TECHNICAL GLITCH", "INSUFFICIENT BALANCE")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# ---------------------------------------------------------------- silver-typed
def transactions(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        _s("l_orderkey").alias("card_id"),
        _s("o_custkey").alias("client_id"),
        _s("l_partkey").alias("mcc"),
        F.col("l_extendedprice").cast("float").alias("amount"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
        F.lower("l_returnflag").alias("errors"),
        F.col("l_linestatus").alias("use_chip"),
        F.date_format("l_shipdate", "yyyy-MM").alias("year_month"),
    )


def cards(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        _s("o_orderkey").alias("id"),
        _s("o_custkey").alias("client_id"),
        F.concat(F.lit("4"), F.lpad(_s("o_orderkey"), 15, "0")).alias("card_number"),
        F.lower("o_orderstatus").alias("card_brand"),
        F.lower("o_orderpriority").alias("card_type"),
        F.when(F.col("o_orderkey") % 3 == 0, "no").otherwise("yes").alias("has_chip"),
        (F.col("o_orderkey") % 3 + 1).cast("int").alias("num_cards_issued"),
        F.floor("o_totalprice").cast("int").alias("credit_limit"),
        F.to_date("o_orderdate").alias("acct_open_date"),
        (F.year("o_orderdate") - F.col("o_orderkey") % 5).cast("int").alias("year_pin_last_changed"),
    )


def users(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        _s("c_custkey").alias("id"),
        F.lower("c_mktsegment").alias("gender"),
        F.floor("c_acctbal").cast("int").alias("yearly_income"),
        (F.col("c_nationkey") % 5 + 1).cast("int").alias("num_credit_cards"),
    )


def mcc(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(_s("p_partkey").alias("mcc_code"), F.lower(F.trim("p_name")).alias("mcc_description"))


# ------------------------------------------------------------ keyed (events)
def fraud_flag() -> F.Column:
    """Label of an event: error events are fraud."""
    return (F.col("event_type") == "error").cast("int")


def score() -> F.Column:
    """A fixed, deterministic score in [0, 1) correlated with the label, with ties."""
    base = ((F.col("event_id") * 37 + F.floor(F.col("value") * 10).cast("long")) % 1000).cast("double") / 1000.0
    return F.round((base + F.when(F.col("event_type") == "error", 0.35).otherwise(0.0)) / 1.35, 3)


def scored_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.to_date("ts").alias("day"),
        fraud_flag().alias("label"),
        score().alias("score"),
    )


def raw_transactions(spark: SparkSession, d: str) -> DataFrame:
    """Bronze transactions (all text) from events, with NULLs, money text and odd case."""
    return raw_of(table(spark, d, "events"))


def raw_of(e: DataFrame) -> DataFrame:
    """The bronze transactions of event rows, of a table or a stream."""
    cents = F.round(F.col("value") * 100).cast("long")
    money = F.concat(
        F.lit("$"),
        F.when(F.col("event_id") % 5 == 0, F.lit("-")).otherwise(F.lit("")),
        F.expr("cast(cast(round(value * 100) as bigint) div 100 as string)"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    return e.select(
        _s("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        _s("user_id").alias("client_id"),
        _s(F.col("event_id") % 997).alias("card_id"),
        F.when(F.col("event_id") % 11 == 0, F.lit("$n/a")).otherwise(money).alias("amount"),
        F.when(F.col("value") > 25, "Chip Transaction").otherwise("Swipe Transaction").alias("use_chip"),
        _s(F.col("user_id") * 7).alias("merchant_id"),
        F.concat(F.lit("City "), F.upper(F.col("event_type"))).alias("merchant_city"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.element_at(F.array(*map(F.lit, STATES)), (F.col("user_id") % len(STATES) + 1).cast("int")), F.lit(" ")))
        .alias("merchant_state"),
        F.when(F.col("event_id") % 7 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(_s(F.col("user_id") * 101), F.lit(".0")))
        .alias("zip"),
        F.get_json_object("props", "$.k").alias("mcc"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.element_at(F.array(*map(F.lit, ERRORS)), (F.col("user_id") * 3 % len(ERRORS) + 1).cast("int")), F.lit("  ")))
        .alias("errors"),
    )


def raw_cards(spark: SparkSession, d: str) -> DataFrame:
    """Bronze cards (all text) from orders: '$' limits, 'MM/yyyy' dates with bad values."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    month = F.date_format("o_orderdate", "MM/yyyy")
    return o.select(
        _s(k).alias("id"),
        _s("o_custkey").alias("client_id"),
        F.concat(F.lit("  "), F.upper("o_orderstatus"), F.lit(" ")).alias("card_brand"),
        F.concat(F.lit(" "), F.upper("o_orderpriority")).alias("card_type"),
        F.concat(F.lit("4"), F.lpad(_s(k), 15, "0")).alias("card_number"),
        F.date_format(F.add_months(F.to_date("o_orderdate"), 48), "MM/yyyy").alias("expires"),
        F.lpad(_s(k % 1000), 3, "0").alias("cvv"),
        F.when(k % 3 == 0, " NO").otherwise("Yes ").alias("has_chip"),
        _s(k % 3 + 1).alias("num_cards_issued"),
        F.when(k % 19 == 0, F.lit("$unknown"))
        .otherwise(F.concat(F.lit("$"), _s(F.floor("o_totalprice"))))
        .alias("credit_limit"),
        F.when(k % 13 == 0, F.lit("13/2020")).when(k % 17 == 0, F.lit(None).cast("string")).otherwise(month)
        .alias("acct_open_date"),
        _s(F.year("o_orderdate") - k % 5).alias("year_pin_last_changed"),
        F.when(k % 2 == 0, "No").otherwise("YES").alias("card_on_dark_web"),
    )


def raw_users(spark: SparkSession, d: str) -> DataFrame:
    """Bronze users (all text) from customer: '$' money, '24.0'-style numbers, odd case."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        _s(k).alias("id"),
        F.upper("c_mktsegment").alias("gender"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("address"),
        F.concat(F.lit("$"), _s(F.floor("c_acctbal"))).alias("yearly_income"),
        F.concat(F.lit("$"), _s(k * 3), F.lit(".0")).alias("total_debt"),
        F.when(k % 19 == 0, F.lit("$n/a")).otherwise(F.concat(F.lit("$"), _s(k % 500 + 100))).alias("per_capita_income"),
        _s(F.col("c_nationkey") + 20).alias("current_age"),
        _s(F.col("c_nationkey") % 5 + 1).alias("num_credit_cards"),
        F.concat(_s(k * 37 % 551 + 300), F.lit(".0")).alias("credit_score"),
    )


def raw_labels(spark: SparkSession, d: str) -> DataFrame:
    """Bronze labels for events: 'Yes'/'NO' with spaces; ids with event_id % 9 = 4 unlabeled."""
    e = table(spark, d, "events")
    return e.filter(F.col("event_id") % 9 != 4).select(
        _s("event_id").alias("transaction_id"),
        F.when(F.col("event_type") == "error", " Yes").otherwise("NO ").alias("is_fraud"),
    )
