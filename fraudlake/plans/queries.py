"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator of SURVEY section 2.

Each reads the driver's tables (through ``plans.fixtures``) over their whole
extent and runs the library operator on them. Every computed column is cast
and aliased so the DuckDB twin in ``plans.oracle`` yields the same schema.
"""

from __future__ import annotations

import calendar
import random
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import dictionary, drift, gold, integrity, metrics, model, online, ordered, prep, profile, resample, silver, splits
from ..session import checkpoint_root, saved
from ..sources import files
from ..sources.json_ranges import read_json_ranges
from ..streaming import jobs as stream_jobs
from ..sources.tables import table
from . import chain
from . import fixtures as fx

GOLD_COLUMNS = [
    "card_id", "client_id", "mcc", "amount", "date", "errors", "use_chip", "year_month",
    "gender", "yearly_income", "num_credit_cards", "card_number", "card_brand", "card_type",
    "has_chip", "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed",
    "mcc_description", "acct_opened_months", "yrs_since_pin_changed",
]

GOLD_LABEL_COLUMNS = [
    "transaction_id", "client_id", "card_id", "mcc", "amount", "date", "merchant_state", "zip", "errors", "use_chip",
    "gender", "address", "card_brand", "card_type", "credit_limit", "acct_open_date", "mcc_description",
    "acct_opened_months", "yrs_since_pin_changed", "is_fraud", "label",
]


# ------------------------------------------------------------------ sources
def month_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Month list spanning the transaction dates."""
    li = table(spark, d, "lineitem")
    bounds = li.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    return bounds.select(files.month_sequence(F.col("lo"), F.col("hi")))


def snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    """A1/K1: rows per monthly snapshot inside the configured range, one pass."""
    tx = fx.transactions(spark, d)
    snap = tx.withColumn("snapshot_date", F.trunc(F.to_date("date"), "MM"))
    in_range = snap.filter(F.col("snapshot_date").between(F.lit("1996-01-01").cast("date"), F.lit("2000-12-01").cast("date")))
    return in_range.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


def json_map_rows(spark: SparkSession, d: str) -> DataFrame:
    """S3: JSON objects {mcc_code: description} (one per key block) parsed back to rows."""
    p = fx.mcc(spark, d).withColumn("blk", (F.col("mcc_code").cast("long") / 1000).cast("long"))
    docs = p.groupBy("blk").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("mcc_code", "mcc_description")))).alias("text")
    )
    return docs.select(*files.parse_json_map(F.col("text"), "mcc_code", "mcc_description"))


def json_range_rows(spark: SparkSession, d: str) -> DataFrame:
    """One JSON file of all events, with commas, quotes and brackets in its texts, read by byte ranges."""
    path = stream_jobs.new_sink(spark, "one_json")
    e = table(spark, d, "events")
    text = F.concat("event_type", F.lit(', "'), F.col("user_id").cast("string"), F.lit('"\n{'))
    pair = F.to_json(F.create_map(F.col("event_id").cast("string"), text))
    line = lambda x: spark.range(1).select(F.lit(x).alias("value"))
    rows = e.select(F.concat(F.substring(pair, F.lit(2), F.length(pair) - 2), F.lit(",")).alias("value"))
    whole = line('{"note": {"1": "no, {"}, "target": {').unionByName(rows).unionByName(line('"end": null}, "after": {"2": "no"}}'))
    whole.coalesce(1).write.text(path)  # one file, as such maps come
    return read_json_ranges(spark, path, "transaction_id", "note", "target")


def json_label_rows(spark: SparkSession, d: str) -> DataFrame:
    """A label map split into comma fragments (as a splittable text read gives) parsed to rows."""
    e = table(spark, d, "events")
    pair = F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('": "'),
                    F.when(F.col("event_type") == "error", "Yes").otherwise("No"), F.lit('"'))
    frag = F.concat(
        F.when(F.col("event_id") % 1000 == 0, F.lit('{"target": {')).otherwise(F.lit(" ")),
        pair,
        F.when(F.col("event_id") % 1000 == 999, F.lit("}}")).otherwise(F.lit("")),
    )
    parsed = files.parse_pair_fragments(e.select(frag.alias("value")), "value", "transaction_id", "is_fraud")
    return silver.clean_labels(parsed)


# ------------------------------------------------------------------- silver
def silver_money(spark: SparkSession, d: str) -> DataFrame:
    """Money text ('$-77.00', junk) -> FLOAT amount and INT amount (fraction truncated)."""
    raw = fx.raw_transactions(spark, d).select("id", "amount", F.col("amount").alias("amount_int"))
    return silver.clean_transactions(raw).withColumn("amount_int", C.money_to_int("amount_int"))


def silver_month_dates(spark: SparkSession, d: str) -> DataFrame:
    """P1: 'MM/yyyy' text (with bad and NULL values) -> first-of-month DATE."""
    c = silver.clean_cards(fx.raw_cards(spark, d).select("id", "expires", "acct_open_date"))
    return c


def silver_null_fill(spark: SparkSession, d: str) -> DataFrame:
    """NULL state/zip/errors filled, text normalised, ids and date typed."""
    t = silver.clean_transactions(fx.raw_transactions(spark, d))
    return t.select(
        "id", "client_id", "card_id", "merchant_id", "mcc", "merchant_city", "merchant_state", "zip",
        "errors", "use_chip", F.to_date("date").alias("date"),
        F.hour("date").cast("int").alias("hour"),
    )


def silver_categories(spark: SparkSession, d: str) -> DataFrame:
    """P6-P8 on cards and users: lower/trim categories, typed numbers."""
    c = silver.clean_cards(fx.raw_cards(spark, d))
    return c.select("id", "client_id", "card_brand", "card_type", "has_chip", "card_on_dark_web", "cvv",
                    "num_cards_issued", "credit_limit", "year_pin_last_changed")


def silver_users(spark: SparkSession, d: str) -> DataFrame:
    """P6-P8 on users: lower-only gender, trimmed address, '$' and '24.0' numbers to INT."""
    return silver.clean_users(fx.raw_users(spark, d))


def cast_nulls(spark: SparkSession, d: str) -> DataFrame:
    """NULLs introduced by the silver casts, per column."""
    raw = fx.raw_cards(spark, d)
    return silver.cast_report(raw, silver.clean_cards(raw), ["credit_limit", "acct_open_date", "expires"])


# --------------------------------------------------------------------- gold
def gold_features(spark: SparkSession, d: str) -> DataFrame:
    """J1 + P10-P12: the point-in-time feature table."""
    out = gold.build_features(fx.transactions(spark, d), fx.users(spark, d), fx.cards(spark, d), fx.mcc(spark, d))
    return out.select(*GOLD_COLUMNS)


def _events_tx(spark: SparkSession, d: str) -> DataFrame:
    """Silver transactions keyed by ``transaction_id`` (P14 rename), from events."""
    return silver.clean_transactions(fx.raw_transactions(spark, d)).withColumnRenamed("id", "transaction_id")


def _silver_labels(spark: SparkSession, d: str) -> DataFrame:
    return silver.clean_labels(fx.raw_labels(spark, d))


def _labelled_gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold rows of events with all their columns and labels."""
    cards = silver.clean_cards(fx.raw_cards(spark, d))
    users = silver.clean_users(fx.raw_users(spark, d))
    feats = gold.build_features(_events_tx(spark, d), users, cards, fx.mcc(spark, d))
    out = gold.attach_labels(feats, _silver_labels(spark, d), "transaction_id", how="left", require_rows=False)
    return out.withColumn("label", C.label_to_int("is_fraud"))


def gold_with_labels(spark: SparkSession, d: str) -> DataFrame:
    """J4 + P15: five-table chain with labels by LEFT join; label yes/no -> 1/0."""
    return _labelled_gold(spark, d).select(*GOLD_LABEL_COLUMNS)


def feature_label_join(spark: SparkSession, d: str) -> DataFrame:
    """Items INNER labels; an empty result raises."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return gold.attach_labels(docs, table(spark, d, "labels"), "doc_id", how="inner")


def unlabeled_share(spark: SparkSession, d: str) -> DataFrame:
    """Items without a label: count and percent."""
    return integrity.unlabeled_share(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


def orphan_report(spark: SparkSession, d: str) -> DataFrame:
    """Five key checks; parents lose the rows with key % 11 = 0 to create orphans."""
    tx = fx.transactions(spark, d)
    cards = fx.cards(spark, d)
    users = fx.users(spark, d)
    mcc = fx.mcc(spark, d)
    ev_tx = _events_tx(spark, d)
    drop11 = lambda df, k: df.filter(F.col(k).cast("long") % 11 != 0)
    checks = [
        ("labels_to_tx", _silver_labels(spark, d), "transaction_id", drop11(ev_tx, "transaction_id"), "transaction_id"),
        ("tx_client_to_cards", tx, "client_id", drop11(cards, "client_id"), "client_id"),
        ("cards_client_to_users", cards, "client_id", drop11(users, "id"), "id"),
        ("tx_card_to_cards", tx, "card_id", drop11(cards, "id"), "id"),
        ("tx_mcc_to_mcc", tx, "mcc", drop11(mcc, "mcc_code"), "mcc_code"),
    ]
    return integrity.orphan_report(checks, examples=5)


PROFILE_VALUE_COLUMNS = [
    "client_id", "card_id", "card_brand", "card_type", "credit_limit", "acct_open_date", "expires",
    "year_pin_last_changed", "gender", "address", "yearly_income",
]


def online_profiles(spark: SparkSession, d: str) -> DataFrame:
    """J2 + U4 + P13 + P24 + K3: card profiles as (key, JSON value), latest card per number wins.

    Card numbers are re-issued here (two cards share a number) so the
    last-row-wins rule has work to do.
    """
    cards = silver.clean_cards(fx.raw_cards(spark, d)).withColumn(
        "card_number", F.concat(F.lit("4"), F.lpad((F.col("id").cast("long") / 2).cast("long").cast("string"), 15, "0"))
    )
    users = silver.clean_users(fx.raw_users(spark, d)).select("id", "gender", "address", "yearly_income")
    prof = online.build_profiles(
        cards.select("id", "client_id", "card_number", "card_brand", "card_type", "credit_limit",
                     "acct_open_date", "expires", "year_pin_last_changed"),
        users,
    ).select("card_number", *PROFILE_VALUE_COLUMNS)
    return online.to_key_value(prof, "card_number", order=["acct_open_date", "card_id"])


def last_per_key(spark: SparkSession, d: str) -> DataFrame:
    """U4: latest event per user by (ts, event_id)."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return online.last_per_key(e, "user_id", ["ts", "event_id"]).drop("ts")


def _requests(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.lit("4"), F.lpad((F.col("event_id") * 3 % 20011).cast("string"), 15, "0")).alias("card_number"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").alias("mcc"),
        F.col("event_type").alias("errors"),
    )


def request_lookup(spark: SparkSession, d: str) -> DataFrame:
    """J7 + P19 + P11/P12: requests enriched with the card profile and time features."""
    prof = online.build_profiles(fx.cards(spark, d), fx.users(spark, d))
    matched, _ = online.lookup_profiles(_requests(spark, d), prof)
    scored = gold.add_time_features(matched)
    return scored.select("transaction_id", "card_number", "amount", "mcc", "errors", "card_brand", "card_type",
                         "credit_limit", "gender", "date", "acct_opened_months", "yrs_since_pin_changed")


def request_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Requests whose card has no profile (rejected, not failing the batch)."""
    prof = online.build_profiles(fx.cards(spark, d), fx.users(spark, d))
    _, rejected = online.lookup_profiles(_requests(spark, d), prof)
    return rejected.select("transaction_id", "card_number")


def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    """Full-row dedup of events unioned with a repeated slice of itself."""
    e = table(spark, d, "events")
    doubled = e.unionByName(e.filter(F.col("event_id") % 10 == 0))
    return doubled.dropDuplicates().select("event_id", "user_id", "event_type", "value", "props")


# ---------------------------------------------------------------- profiling
NUMERIC_PROFILE = ["amount", "yearly_income", "credit_limit", "acct_opened_months", "yrs_since_pin_changed",
                   "num_cards_issued"]


def profile_missing(spark: SparkSession, d: str) -> DataFrame:
    """A3: missing count and percent per column of the raw transactions."""
    raw = fx.raw_transactions(spark, d)
    return profile.profile_missing(raw.withColumn("amount", C.money_to_float("amount")))


def profile_cardinality(spark: SparkSession, d: str) -> DataFrame:
    """A4: unique/missing counts of id-like, text and two-valued columns."""
    return profile.profile_cardinality(_events_tx(spark, d))


def profile_distribution(spark: SparkSession, d: str) -> DataFrame:
    """A5: value distribution (NULL included) of columns with 1-10 values."""
    return profile.profile_distribution(fx.raw_transactions(spark, d))


def profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    """Numeric summary of the gold features."""
    return profile.profile_numeric(gold_features(spark, d), NUMERIC_PROFILE)


def class_balance(spark: SparkSession, d: str) -> DataFrame:
    """Label counts and shares (unlabeled rows as NULL)."""
    return profile.class_balance(gold_with_labels(spark, d), "label")


def histogram(spark: SparkSession, d: str) -> DataFrame:
    """50-bin histogram of transaction amounts."""
    return profile.histogram(fx.transactions(spark, d), "amount", 50)


def monthly_volume(spark: SparkSession, d: str) -> DataFrame:
    """A10: transactions and error rows per month."""
    tx = fx.transactions(spark, d)
    return tx.groupBy(C.month_start("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("errors") == "r").alias("n_returned")
    )


def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Pairwise Pearson correlation of the gold numeric features."""
    return profile.corr_matrix(gold_features(spark, d), NUMERIC_PROFILE)


def crosstab(spark: SparkSession, d: str) -> DataFrame:
    """Card brand x card type counts."""
    return profile.crosstab(fx.cards(spark, d), "card_brand", "card_type")


def date_range(spark: SparkSession, d: str) -> DataFrame:
    """First and last date of each dated table."""
    return (
        profile.date_range(fx.transactions(spark, d), "date", "transactions")
        .unionByName(profile.date_range(fx.cards(spark, d), "acct_open_date", "cards"))
        .unionByName(profile.date_range(table(spark, d, "events"), "ts", "events"))
    )


def length_dist(spark: SparkSession, d: str) -> DataFrame:
    """Distribution of zip text lengths."""
    return profile.length_distribution(_events_tx(spark, d), "zip")


def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (brand, type) pairs of cards."""
    return fx.cards(spark, d).select("card_brand", "card_type").distinct()


def top_values(spark: SparkSession, d: str) -> DataFrame:
    """Ten most frequent merchant categories."""
    return profile.top_values(fx.transactions(spark, d), "mcc", 10)


def top_preview(spark: SparkSession, d: str) -> DataFrame:
    """Five largest online transactions (NULL-state rows), ties by id."""
    tx = _events_tx(spark, d)
    online_tx = tx.filter((F.col("merchant_state") == "online") & F.col("amount").isNotNull())
    return online_tx.orderBy(F.desc("amount"), F.asc("transaction_id")).limit(5).select(
        "transaction_id", "amount", "merchant_state", "errors"
    )


def profile_flags(spark: SparkSession, d: str) -> DataFrame:
    """P17 + A8: derived transaction flags, counts and rates in one pass."""
    flags = profile.transaction_flags(_events_tx(spark, d))
    names = ["is_online_merchant", "is_refund", "has_error", "has_zip", "has_merchant_state"]
    cards = silver.clean_cards(fx.raw_cards(spark, d)).select(profile.cvv_available("cvv").alias("cvv_available"))
    return profile.flag_rates(flags, names).unionByName(profile.flag_rates(cards, ["cvv_available"]))


def flag_cross(spark: SparkSession, d: str) -> DataFrame:
    """Online merchants against missing states in the raw rows, counted together."""
    raw = fx.raw_transactions(spark, d)
    online = F.col("use_chip") == "Swipe Transaction"
    return profile.cross_counts(raw, {"is_online": online, "state_missing": F.col("merchant_state").isNull()})


def column_values(spark: SparkSession, d: str) -> DataFrame:
    """M1: the feature columns by kind, found from the types, and their values that aren't NULL."""
    g = gold_with_labels(spark, d)
    numeric, categorical = prep.split_columns(g, exclude=("label",))
    kinds = dict.fromkeys(numeric, "numeric") | dict.fromkeys(categorical, "categorical")
    wide = g.agg(*[F.count(c).alias(c) for c in kinds])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), F.col(c).alias("n")) for c, k in kinds.items()])
    return wide.select(F.explode(pairs).alias("p")).select("p.*")


def silver_mcc(spark: SparkSession, d: str) -> DataFrame:
    """P6/P7 on merchant categories with odd case and spaces."""
    p = table(spark, d, "part")
    raw = p.select(F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("mcc_code"),
                   F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("mcc_description"))
    return silver.clean_mcc(raw)


def table_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """K2: a table written in full twice holds the rows of the second write alone."""
    path = stream_jobs.new_sink(spark, "overwritten")
    cards = fx.cards(spark, d)
    for rows in (cards, cards.filter(F.col("has_chip") == "yes")):
        files.overwrite_table(rows, path)
    return spark.read.parquet(path).groupBy("card_brand", "has_chip").agg(F.count(F.lit(1)).alias("n"))


def reference_set(spark: SparkSession, d: str) -> DataFrame:
    """K4: the reference rows of two training runs, the first written once more; rows and sums by run."""
    path = stream_jobs.new_sink(spark, "reference_sets")
    cols = [*DRIFT_NUMERIC, *DRIFT_CATEGORICAL]
    rows = saved(_drift_frame(spark, d).filter(F.col(drift.SIDE) == 1).select(*cols), "reference_rows")  # the gold join runs once
    for run, part in (("run-1", rows), ("run-2", rows.filter(F.col("errors") == "r")), ("run-1", rows.filter(F.col("errors") != "r"))):
        drift.write_reference_set(part, cols, path, run)
    back = spark.read.parquet(path)
    return back.groupBy("run_name", "errors").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("credit_limit").cast("long")).alias("credit_limit"), F.countDistinct("card_type").alias("card_types"))


def table_shape(spark: SparkSession, d: str) -> DataFrame:
    """Rows and columns of the source tables."""
    out = None
    for name in ("lineitem", "orders", "customer", "part", "events"):
        st = files.file_stats(table(spark, d, name), name).drop("schema")
        out = st if out is None else out.unionByName(st)
    return out


# ------------------------------------------------------ splits and metrics
ROLLING_N = 1000
OOT_TX = (3, 30)      # splits x days on the card transactions (model configs)
OOT_EVENTS = (3, 7)   # splits x days on the events (demo config)
EVENT_CUTOFFS = {"oot1": "2024-01-16", "oot2": "2024-01-21", "oot3": "2024-01-26"}


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return fx.scored_events(spark, d).withColumn("prediction", metrics.predict("score", 0.5))


def _scored_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_oot(_scored(spark, d), "day", *OOT_EVENTS)


def rolling_rate(spark: SparkSession, d: str) -> DataFrame:
    """Fraud rate over the last 1,000 events in time order."""
    ev = fx.scored_events(spark, d)
    r = ordered.rolling_rate(ev, ["ts", "event_id"], "label", ROLLING_N, keep=["event_id"])
    return r.select("event_id", F.round("rolling_rate", 6).alias("rolling_rate"))


def oot_splits(spark: SparkSession, d: str) -> DataFrame:
    """Three inclusive 30-day out-of-time windows carved from the latest date back."""
    tx = splits.split_oot(fx.transactions(spark, d), "date", *OOT_TX)
    return tx.groupBy("split_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("date")).alias("min_date"), F.max(F.to_date("date")).alias("max_date")
    )


def cutoff_splits(spark: SparkSession, d: str) -> DataFrame:
    """Named cutoff windows, the rest split 80/20 train/test by class."""
    ev = splits.split_cutoffs(fx.scored_events(spark, d), "day", EVENT_CUTOFFS, default="pool")
    pool = splits.stratified_split(ev.filter(F.col("split_id") == "pool"), "event_id", "label", 0.2, 42)
    pool = pool.withColumn("split_id", F.when(F.col("is_test"), "test").otherwise("train")).drop("is_test")
    rest = ev.filter(F.col("split_id") != "pool")
    return rest.unionByName(pool).groupBy("split_id", "label").agg(F.count(F.lit(1)).alias("n"))


def cutoff_train_val(spark: SparkSession, d: str) -> DataFrame:
    """W4 + W6: named cutoff windows, the rest split by class into test, validation and train."""
    ev = splits.split_cutoffs(fx.scored_events(spark, d), "day", EVENT_CUTOFFS, default="pool")
    pool = splits.stratified_split(ev.filter(F.col("split_id") == "pool"), "event_id", "label", 0.2, 42)
    fit = splits.stratified_split(pool.filter(~F.col("is_test")).drop("is_test"), "event_id", "label", 0.25, 43, out="is_val")
    named = lambda df, name: df.select("label", name.alias("split_id"))
    out = named(ev.filter(F.col("split_id") != "pool"), F.col("split_id"))
    out = out.unionByName(named(pool.filter("is_test"), F.lit("test"))).unionByName(named(fit, F.when(F.col("is_val"), "val").otherwise("train")))
    return out.groupBy("split_id", "label").agg(F.count(F.lit(1)).alias("n"))


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    """80/20 split per class, seed 42."""
    out = splits.stratified_split(fx.scored_events(spark, d), "event_id", "label", 0.2, 42)
    return out.select("event_id", "label", F.col("is_test").cast("int").alias("is_test"))


def validation_split(spark: SparkSession, d: str) -> DataFrame:
    """75/25 validation split of the training part, by class, with a trial seed (before any resampling)."""
    train = splits.stratified_split(fx.scored_events(spark, d), "event_id", "label", 0.2, 42).filter(~F.col("is_test"))
    out = splits.stratified_split(train.drop("is_test"), "event_id", "label", 0.25, 7, out="is_val")
    return out.select("event_id", "label", F.col("is_val").cast("int").alias("is_val"))


def undersample(spark: SparkSession, d: str) -> DataFrame:
    """M6: majority class cut to the minority size in hash order."""
    out = splits.undersample(fx.scored_events(spark, d), "event_id", "label", 1.0, 42)
    return out.select("event_id", "label")


def trial_champion(spark: SparkSession, d: str) -> DataFrame:
    """Daily F1 as a trial series; running champion and improvement."""
    sc = _scored(spark, d).withColumn("trial", F.dayofmonth("day").cast("int"))
    f1 = metrics.f1_scores(sc, "label", "prediction", by="trial").select("trial", F.round("f1", 6).alias("value"))
    out = metrics.running_champion(f1, "trial", "value")
    return out.select("trial", "value", "prev_best", "is_champion", F.round("improvement_pct", 6).alias("improvement_pct"))


def confusion(spark: SparkSession, d: str) -> DataFrame:
    """Confusion counts at threshold 0.5."""
    return metrics.confusion(_scored(spark, d), "label", "prediction")


def f1_by_split(spark: SparkSession, d: str) -> DataFrame:
    """Precision, recall and F1 per out-of-time split."""
    f = metrics.f1_scores(_scored_split(spark, d), "label", "prediction", by="split_id")
    return f.select("split_id", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def log_loss(spark: SparkSession, d: str) -> DataFrame:
    """Clipped log loss per split."""
    ll = metrics.log_loss(_scored_split(spark, d), "label", "score", by="split_id")
    return ll.select("split_id", F.round("log_loss", 6).alias("log_loss"), "n")


def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    """ROC AUC per split (tied scores count half)."""
    a = metrics.roc_auc(_scored_split(spark, d), "label", "score", by="split_id")
    return a.select("split_id", F.round("roc_auc", 6).alias("roc_auc"))


def avg_precision(spark: SparkSession, d: str) -> DataFrame:
    """Average precision per split."""
    a = metrics.average_precision(_scored_split(spark, d), "label", "score", by="split_id")
    return a.select("split_id", F.round("avg_precision", 6).alias("avg_precision"))


def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    """ROC / PR curve points at every distinct score."""
    c = metrics.curve_points(_scored(spark, d), "label", "score")
    return c.select("threshold", *[F.round(x, 6).alias(x) for x in ("tpr", "fpr", "precision")])


# -------------------------------------------------------------------- drift
DRIFT_CUTOFF = "2000-01-01"
DRIFT_SECOND_RUN = "2000-12-31"
DRIFT_CATEGORICAL = ["errors", "use_chip", "card_brand", "card_type", "gender", "has_chip"]
DRIFT_NUMERIC = ["amount", "credit_limit", "acct_opened_months", "yrs_since_pin_changed", "yearly_income",
                 "num_cards_issued"]


def _drift_frame(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Gold rows tagged reference (before the cutoff) or current (from it on); configured columns only.

    One frame for both sides, so the gold join runs once per pass instead of once per side.
    """
    g = gold_features(spark, d)
    is_ref = (F.col("date") < F.lit(DRIFT_CUTOFF).cast("date")).cast("int")
    return g.filter(F.col("date").isNotNull()).select(is_ref.alias(drift.SIDE), *DRIFT_NUMERIC, *DRIFT_CATEGORICAL, *more)


def _drift_rows(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """The drift frame written once, for reports of several passes: the gold join isn't run again for each."""
    return saved(_drift_frame(spark, d, *more), "drift_rows")


def psi_categorical(spark: SparkSession, d: str) -> DataFrame:
    """Categorical PSI, reference vs current."""
    out = drift.psi_categorical_tagged(_drift_frame(spark, d), DRIFT_CATEGORICAL)
    return out.select("column_name", F.round("psi", 6).alias("psi"))


def psi_numeric(spark: SparkSession, d: str) -> DataFrame:
    """D2(a): numeric PSI at reference deciles."""
    rows = saved(_drift_frame(spark, d).select(drift.SIDE, *DRIFT_NUMERIC), "drift_rows")
    out = drift.psi_numeric_tagged(rows, DRIFT_NUMERIC)
    return out.select("column_name", F.round("psi", 6).alias("psi"))


def ks_numeric(spark: SparkSession, d: str) -> DataFrame:
    """D2(b): two-sample KS statistic."""
    return drift.ks_numeric_tagged(_drift_frame(spark, d), DRIFT_NUMERIC).select("column_name", F.round("ks", 6).alias("ks"))


def wasserstein_numeric(spark: SparkSession, d: str) -> DataFrame:
    """D2(c): normed Wasserstein distance."""
    out = drift.wasserstein_numeric_tagged(_drift_frame(spark, d), DRIFT_NUMERIC)
    return out.select("column_name", F.round("wasserstein", 6).alias("wasserstein"))


def drift_report_table(spark: SparkSession, d: str) -> DataFrame:
    """The report of two runs (all rows; the rows up to ``DRIFT_SECOND_RUN``) appended to one table."""
    path = stream_jobs.new_sink(spark, "drift_reports")
    frame = _drift_rows(spark, d, "date")
    runs = {"run-1": frame, "run-2": frame.filter(F.col("date") <= F.lit(DRIFT_SECOND_RUN).cast("date"))}
    for run_id, rows in runs.items():
        report = drift.column_report_tagged(rows, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
        files.append_table(drift.report_rows(report, run_id), path)
    out = spark.read.parquet(path)
    return out.select("run_id", "column_name", "kind", "test", F.round("score", 6).alias("score"), "drifted")


def dataset_drift(spark: SparkSession, d: str) -> DataFrame:
    """D3: share of drifted columns (PSI >= 0.2) and the dataset flag (share >= 0.5)."""
    _, ds = drift.drift_report_tagged(_drift_rows(spark, d), DRIFT_NUMERIC, DRIFT_CATEGORICAL, threshold=0.2, share=0.5)
    return ds.select("n_columns", "n_drifted", F.round("share", 6).alias("share"), "dataset_drift")


# ------------------------------------------------------- prep and resampling
PREP_CUTOFF = "2024-01-21"
STANDARDISE_COLUMNS = ["amount", "credit_limit", "acct_opened_months", "yrs_since_pin_changed"]
ONE_HOT_COLUMNS = ["merchant_state", "errors", "use_chip"]


def standardise(spark: SparkSession, d: str) -> DataFrame:
    """M2/M4: mean impute + standardise (population std), fitted on the rows before the cutoff."""
    g = gold_with_labels(spark, d).select("transaction_id", "date", *STANDARDISE_COLUMNS)
    model = prep.Standardiser.fit(g.filter(F.col("date") < F.lit(PREP_CUTOFF).cast("date")), STANDARDISE_COLUMNS)
    z = model.transform(g)
    return z.select("transaction_id", *[F.round(c, 6).alias(c) for c in STANDARDISE_COLUMNS])


def _prep_input(spark: SparkSession, d: str) -> DataFrame:
    raw = fx.raw_transactions(spark, d)
    return raw.select(
        F.col("id").alias("transaction_id"), F.to_date("date").alias("day"),
        C.norm_category("merchant_state").alias("merchant_state"), C.norm_category("errors").alias("errors"), "use_chip",
    )


def one_hot(spark: SparkSession, d: str) -> DataFrame:
    """M3/M4: mode impute + one-hot over training categories (unknown -> all zeros)."""
    x = _prep_input(spark, d)
    enc = prep.OneHot.fit(x.filter(F.col("day") < F.lit(PREP_CUTOFF).cast("date")), ONE_HOT_COLUMNS)
    return enc.dummy_columns(x.drop("day"))


SPARSE_COLUMNS = ["merchant_state", "errors", "use_chip", "merchant_id", "zip", "mcc"]


def one_hot_sparse(spark: SparkSession, d: str) -> DataFrame:
    """M3 with the dictionary as a table: merchants and zips, as many categories as there are users; the features that are 1."""
    raw = fx.raw_transactions(spark, d).withColumnRenamed("id", "transaction_id")
    x = raw.select("transaction_id", F.to_date("date").alias("day"), *SPARSE_COLUMNS)
    enc = dictionary.Dictionary.fit(x.filter(F.col("day") < F.lit(PREP_CUTOFF).cast("date")), SPARSE_COLUMNS)
    return enc.indices(x, "transaction_id").select(
        "transaction_id", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"), F.lit(enc.size).cast("long").alias("n_features"))


def smote_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """M5: exact 5 nearest neighbours of every vector inside its class."""
    nn = resample.knn_within_class(table(spark, d, "embeddings"), "vec_id", "label", "embedding", k=5)
    return nn.select(F.col("id").alias("vec_id"), "rank", "nn_id", F.round("dist", 6).alias("dist"))


def smote_rows(spark: SparkSession, d: str) -> DataFrame:
    """M5: every class oversampled to the largest class; rows and synthetic rows per class."""
    out = resample.smote(table(spark, d, "embeddings"), "vec_id", "label", "embedding", k=5, seed=42)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_synthetic").cast("long").alias("n_synthetic"))


# ---------------------------------------------------------------- streaming
PREDICTION_WINDOW = ("2024-01-10 00:00:00", "2024-01-12 12:00:00")


def _request_columns(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.lit("4"), F.lpad((F.col("event_id") * 3 % 20011).cast("string"), 15, "0")).alias("card_number"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").alias("mcc"),
        F.col("event_type").alias("errors"),
    )


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    return stream_jobs.read_table_stream(spark, d, "events.parquet", table(spark, d, "events").schema)


def stream_enrich(spark: SparkSession, d: str) -> DataFrame:
    """Streamed requests, stream-static LEFT join with profiles, time features, file sink."""
    prof = online.build_profiles(fx.cards(spark, d), fx.users(spark, d))
    out = stream_jobs.enrich_stream(_request_columns(_event_stream(spark, d)), prof).select(
        "transaction_id", "card_number", "amount", "mcc", "errors", "card_brand", "card_type", "credit_limit",
        "gender", "date", "acct_opened_months", "yrs_since_pin_changed", "matched",
    )
    path = stream_jobs.run_available(out, stream_jobs.new_sink(spark, "stream_enrich"))
    return spark.read.parquet(path)


def stream_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Streamed scoring into a prediction log partitioned by date."""
    scored = _event_stream(spark, d).withColumn("prediction", metrics.predict(fx.score(), 0.5))
    log = stream_jobs.prediction_log(scored, "ts", "event_id", "prediction")
    path = stream_jobs.run_available(log, stream_jobs.new_sink(spark, "predictions"), ["event_date"])
    return spark.read.parquet(path)


def prediction_range(spark: SparkSession, d: str) -> DataFrame:
    """S10 + K6: append a batch prediction log, then read a time range back (date partitions pruned)."""
    scored = fx.scored_events(spark, d).withColumn("prediction", metrics.predict("score", 0.5))
    path = stream_jobs.new_sink(spark, "prediction_log")
    files.append_table(stream_jobs.prediction_log(scored, "ts", "event_id", "prediction"), path, ["event_date"])
    lo, hi = (calendar.timegm(dt.datetime.strptime(t, "%Y-%m-%d %H:%M:%S").timetuple()) for t in PREDICTION_WINDOW)
    return files.read_predictions(spark.read.parquet(path), lo, hi).select(
        "event_time", "transaction_id", "is_fraud"
    )


def stream_daily(spark: SparkSession, d: str) -> DataFrame:
    """T4: daily tumbling counts per event type, append mode into a file sink; a closing marker ends the last day."""
    sink = stream_jobs.new_sink(spark, "daily")
    markers = stream_jobs.new_sink(spark, "daily_markers")
    stream_jobs.write_marker(spark, markers, None)

    def drain() -> None:
        counts = stream_jobs.closed_windows(spark, _event_stream(spark, d), markers, "ts", ["event_type"])
        stream_jobs.run_available(counts.select(F.to_date("w.start").alias("window_start"), "event_type", "n"), sink)

    drain()
    last = table(spark, d, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("t")).first()["t"]
    if last is not None:  # past the end of the last window by more than the watermark's delay
        stream_jobs.write_marker(spark, markers, F.lit(last + dt.timedelta(days=3)))
        drain()
    return spark.read.schema("window_start date, event_type string, n long").parquet(sink)


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """T5: two deliveries of the same events; duplicates dropped within the watermark."""
    twice = _event_stream(spark, d).unionByName(_event_stream(spark, d))
    out = stream_jobs.dedup_stream(twice, "ts", "event_id", "1 day").select("event_id", "user_id", "event_type", "value")
    path = stream_jobs.run_available(out, stream_jobs.new_sink(spark, "dedup"))
    return spark.read.parquet(path)


def stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Raw CSV files ingested incrementally into monthly snapshot partitions; rows per month."""
    raw_dir = stream_jobs.new_sink(spark, "raw_csv")
    raw = fx.transactions(spark, d).select(
        "card_id", "client_id", "mcc", F.col("amount").cast("string").alias("amount"),
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
    )
    raw.write.option("header", "true").csv(raw_dir)
    schema = files.string_schema(["card_id", "client_id", "mcc", "amount", "date"])
    sink = stream_jobs.ingest_files(spark, raw_dir, schema, "csv", stream_jobs.new_sink(spark, "bronze"), "date")
    return files.read_snapshots(spark, sink).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------- models
#: The configured features.
MODEL_NUMERIC = ["amount", "num_credit_cards", "num_cards_issued", "credit_limit", "year_pin_last_changed", "acct_opened_months",
                 "yrs_since_pin_changed", "per_capita_income", "credit_score", "yearly_income"]
MODEL_CATEGORICAL = ["use_chip", "merchant_state", "mcc", "errors", "has_chip", "card_brand", "card_type"]
MODEL_TRIALS = 10


def _model_frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled gold rows with 3 x 7-day OOT windows; the rest split 80/20 by class."""
    checkpoint_root(spark)
    # the OOT cutoffs and class counts each read the labelled rows: materialise them first
    g = _labelled_gold(spark, d).dropDuplicates().filter(F.col("label").isNotNull()).checkpoint(eager=True)
    g = splits.split_oot(g, "date", *OOT_EVENTS)
    strat = splits.stratified_split(g.filter(F.col("split_id") == "train"), "transaction_id", "label", 0.2, 42)
    strat = strat.withColumn("split_id", F.when(F.col("is_test"), "test").otherwise("train")).drop("is_test")
    # every fit, trial and evaluation below reads these rows: materialise them once
    rows = g.filter(F.col("split_id") != "train").unionByName(strat).checkpoint(eager=True)
    train = rows.filter(F.col("split_id") == "train").drop("split_id")
    test = rows.filter(F.col("split_id") == "test")
    return rows.filter(F.col("split_id") != "train"), train, test


def model_search(spark: SparkSession, d: str) -> DataFrame:
    """M8/M9 + W2: seeded random search over the logistic space, F1 objective, SMOTE on the fit part;
    the champions among the trials and their improvement."""
    trials = _search(_model_frames(spark, d)[1])
    return trials.join(metrics.running_champion(trials, "trial", "f1").drop("f1"), "trial")


def _search(train: DataFrame) -> DataFrame:
    return model.search(train, "label", "transaction_id", MODEL_NUMERIC, MODEL_CATEGORICAL, "logistic",
                        n_trials=MODEL_TRIALS, seed=42)


def _final_model(spark: SparkSession, d: str):
    held_out, train, _ = _model_frames(spark, d)
    trials = _search(train)
    best = trials.orderBy(F.desc("f1"), "trial").first()
    import json
    trained = model.fit_final(train, "label", "transaction_id", MODEL_NUMERIC, MODEL_CATEGORICAL, "logistic",
                              json.loads(best["params"]), seed=42)
    return trained, held_out, train


def model_eval(spark: SparkSession, d: str) -> DataFrame:
    """Best trial refit on all training rows; F1 / AUC / log loss on train, test and each OOT window."""
    trained, held_out, train = _final_model(spark, d)
    every = train.withColumn("split_id", F.lit("train")).unionByName(held_out)
    scored = trained.score(every.withColumn("label", F.col("label").cast("int")))
    return model.evaluate(scored, "label", "p1", 0.5, by="split_id")


# M11 scores with a model fitted at fixed parameters; choosing them is M9/M10's job (model_eval)
SCORING_PARAMS = {"C": 1.0, "penalty": "l2", "max_iter": 100}


def _score_requests(requests: DataFrame) -> DataFrame:
    """Requests of the scoring service: a silver transaction and the number of a card, known or not."""
    number = F.concat(F.lit("4"), F.lpad((F.col("transaction_id").cast("long") * 3 % 20011).cast("string"), 15, "0"))
    return requests.select("transaction_id", number.alias("card_number"), "date", "amount", "use_chip", "merchant_state", "mcc", "errors")


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return online.build_profiles(silver.clean_cards(fx.raw_cards(spark, d)), silver.clean_users(fx.raw_users(spark, d)))


def scoring_features(spark: SparkSession, d: str) -> DataFrame:
    """M11 but for the model: each request with its card's profile and the time features, or rejected."""
    feats = model.with_profiles(_score_requests(_events_tx(spark, d)), _profiles(spark, d))
    return feats.select("transaction_id", "card_number", "rejected", "date", *MODEL_NUMERIC, *MODEL_CATEGORICAL)


def _scoring_model(spark: SparkSession, d: str) -> model.Trained:
    _, train, _ = _model_frames(spark, d)
    return model.fit_final(train, "label", "transaction_id", MODEL_NUMERIC, MODEL_CATEGORICAL, "logistic", SCORING_PARAMS, seed=42)


def batch_scores(spark: SparkSession, d: str) -> DataFrame:
    """Requests looked up by card, merged, prepared and scored; a request with an unknown card is rejected."""
    feats = model.with_profiles(_score_requests(_events_tx(spark, d)), _profiles(spark, d))
    out = _scoring_model(spark, d).score_known(feats)
    return out.select("transaction_id", "rejected", F.round("p1", 6).alias("probability"), "is_fraud")


def stream_scores(spark: SparkSession, d: str) -> DataFrame:
    """T1 + M11: the fitted model inside the stream: requests looked up, scored or rejected, into a file sink."""
    trained = _scoring_model(spark, d)
    events = _event_stream(spark, d)
    requests = _score_requests(silver.clean_transactions(fx.raw_of(events)).withColumnRenamed("id", "transaction_id"))
    scored = trained.score_known(model.with_profiles(requests, _profiles(spark, d)))
    out = scored.select("transaction_id", "rejected", F.round("p1", 6).alias("probability"), "is_fraud")
    path = stream_jobs.run_available(out, stream_jobs.new_sink(spark, "stream_scores"), ["rejected"])
    return spark.read.schema("transaction_id string, probability double, is_fraud int, rejected boolean").parquet(path)


# ------------------------------------------------------------ the job list
def _raw_files(spark: SparkSession, d: str) -> str:
    """The pipeline's raw files: CSV tables and two JSON objects, each one file as they come."""
    raw = stream_jobs.new_sink(spark, "raw_files")
    for name, df in (("transactions", fx.raw_transactions(spark, d)), ("cards", fx.raw_cards(spark, d)), ("users", fx.raw_users(spark, d))):
        df.write.option("header", "true").csv(f"{raw}/{name}_data.csv")

    def pairs(df: DataFrame, key: str, value: str, head: str, tail: str, name: str) -> None:
        pair = F.to_json(F.create_map(F.col(key), F.col(value)))
        rows = df.select(F.concat(F.substring(pair, F.lit(2), F.length(pair) - 2), F.lit(",")).alias("value"))
        line = lambda x: spark.range(1).select(F.lit(x).alias("value"))
        line(head).unionByName(rows).unionByName(line(tail)).coalesce(1).write.text(f"{raw}/{name}")

    pairs(fx.mcc(spark, d), "mcc_code", "mcc_description", "{", '"none": null}', "mcc_codes.json")
    pairs(fx.raw_labels(spark, d), "transaction_id", "is_fraud", '{"target": {', '"none": null}}', "train_fraud_labels.json")
    return raw


def etl_chain(spark: SparkSession, d: str) -> DataFrame:
    """The job list from raw files to the gold tables, their features with their labels."""
    folder = chain.run(spark, _raw_files(spark, d), stream_jobs.new_sink(spark, "datamart"), layers=("bronze", "silver", "gold"))
    rows = gold.attach_labels(folder.read("gold/features"), folder.read("gold/labels"), "transaction_id", how="left", require_rows=False)
    return rows.withColumn("label", C.label_to_int("is_fraud")).select(*GOLD_LABEL_COLUMNS)


def etl_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each table that the job list makes, the online table included."""
    return chain.row_counts(chain.run(spark, _raw_files(spark, d), stream_jobs.new_sink(spark, "datamart")))


def gbt_eval(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees (positive-class weight 2.5) at one seeded draw from their space, per-split metrics."""
    held_out, train, _ = _model_frames(spark, d)
    params = model.draw(model.SPACES["gbt"], random.Random(42))
    trained = model.fit_final(train, "label", "transaction_id", MODEL_NUMERIC, MODEL_CATEGORICAL, "gbt", params,
                              seed=42)
    every = train.withColumn("split_id", F.lit("train")).unionByName(held_out)
    scored = trained.score(every.withColumn("label", F.col("label").cast("int")))
    return model.evaluate(scored, "label", "p1", 0.5, by="split_id")


def mlp_eval(spark: SparkSession, d: str) -> DataFrame:
    """A neural network at one seeded draw from its space, per-split metrics."""
    held_out, train, _ = _model_frames(spark, d)
    params = model.draw(model.SPACES["mlp"], random.Random(42))
    trained = model.fit_final(train, "label", "transaction_id", MODEL_NUMERIC, MODEL_CATEGORICAL, "mlp", params, seed=42)
    every = train.withColumn("split_id", F.lit("train")).unionByName(held_out)
    scored = trained.score(every.withColumn("label", F.col("label").cast("int")))
    return model.evaluate(scored, "label", "p1", 0.5, by="split_id")


def unix_seconds(spark: SparkSession, d: str) -> DataFrame:
    """Event wall-clock time in New York -> Unix seconds."""
    e = table(spark, d, "events")
    return e.select("event_id", C.local_to_unix_seconds("ts", "America/New_York").alias("unix_seconds"))


# ------------------------------------------------------------ more sources
def snapshot_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K1 + S2/S5/U1: write monthly snapshots in one pass (range 1996-2000), read back from 1999-01 on."""
    path = stream_jobs.new_sink(spark, "snapshots")
    files.write_snapshots(fx.transactions(spark, d), path, "date", start="1996-01-01", end="2000-12-31")
    snap = files.read_snapshots(spark, path, start="1999-01-01")
    return snap.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


def profile_decode(spark: SparkSession, d: str) -> DataFrame:
    """P20: online profile values decoded from JSON back into columns."""
    kv = online_profiles(spark, d)
    return online.from_key_value(kv, ["client_id", "card_id", "card_brand", "credit_limit", "acct_open_date"])


def imputation_values(spark: SparkSession, d: str) -> DataFrame:
    """Training mode (categorical, smallest on a tie) and mean (numeric) used for imputation."""
    x = _prep_input(spark, d).filter(F.col("day") < F.lit(PREP_CUTOFF).cast("date"))
    g = gold_with_labels(spark, d).filter(F.col("date") < F.lit(PREP_CUTOFF).cast("date"))
    modes = prep.OneHot.fit_modes(x, ONE_HOT_COLUMNS)
    means = prep.Standardiser.fit(g, STANDARDISE_COLUMNS).params
    rows = [(c, v, None) for c, v in modes.items()] + [(c, None, m) for c, (m, _) in means.items()]
    return spark.createDataFrame(rows, "column_name string, mode string, mean double").select(
        "column_name", "mode", F.round("mean", 6).alias("mean")
    )


QUERIES = {
    "gold_features": gold_features,
    "month_sequence": month_sequence,
    "snapshot_counts": snapshot_counts,
    "json_map_rows": json_map_rows,
    "json_label_rows": json_label_rows,
    "json_range_rows": json_range_rows,
    "silver_money": silver_money,
    "silver_month_dates": silver_month_dates,
    "silver_null_fill": silver_null_fill,
    "silver_categories": silver_categories,
    "silver_users": silver_users,
    "cast_nulls": cast_nulls,
    "gold_with_labels": gold_with_labels,
    "feature_label_join": feature_label_join,
    "unlabeled_share": unlabeled_share,
    "orphan_report": orphan_report,
    "online_profiles": online_profiles,
    "last_per_key": last_per_key,
    "request_lookup": request_lookup,
    "request_rejects": request_rejects,
    "dedup_rows": dedup_rows,
    "profile_missing": profile_missing,
    "profile_cardinality": profile_cardinality,
    "profile_distribution": profile_distribution,
    "profile_numeric": profile_numeric,
    "class_balance": class_balance,
    "histogram": histogram,
    "monthly_volume": monthly_volume,
    "corr_matrix": corr_matrix,
    "crosstab": crosstab,
    "date_range": date_range,
    "length_dist": length_dist,
    "distinct_values": distinct_values,
    "top_values": top_values,
    "top_preview": top_preview,
    "profile_flags": profile_flags,
    "flag_cross": flag_cross,
    "column_values": column_values,
    "silver_mcc": silver_mcc,
    "table_overwrite": table_overwrite,
    "reference_set": reference_set,
    "cutoff_train_val": cutoff_train_val,
    "table_shape": table_shape,
    "rolling_rate": rolling_rate,
    "oot_splits": oot_splits,
    "cutoff_splits": cutoff_splits,
    "stratified_split": stratified_split,
    "validation_split": validation_split,
    "undersample": undersample,
    "trial_champion": trial_champion,
    "confusion": confusion,
    "f1_by_split": f1_by_split,
    "log_loss": log_loss,
    "roc_auc": roc_auc,
    "avg_precision": avg_precision,
    "roc_curve": roc_curve,
    "psi_categorical": psi_categorical,
    "psi_numeric": psi_numeric,
    "ks_numeric": ks_numeric,
    "dataset_drift": dataset_drift,
    "wasserstein_numeric": wasserstein_numeric,
    "drift_report_table": drift_report_table,
    "standardise": standardise,
    "one_hot": one_hot,
    "one_hot_sparse": one_hot_sparse,
    "smote_neighbours": smote_neighbours,
    "smote_rows": smote_rows,
    "stream_enrich": stream_enrich,
    "stream_predictions": stream_predictions,
    "prediction_range": prediction_range,
    "stream_daily": stream_daily,
    "stream_dedup": stream_dedup,
    "stream_bronze": stream_bronze,
    "unix_seconds": unix_seconds,
    "snapshot_roundtrip": snapshot_roundtrip,
    "profile_decode": profile_decode,
    "imputation_values": imputation_values,
    "model_search": model_search,
    "model_eval": model_eval,
    "batch_scores": batch_scores,
    "scoring_features": scoring_features,
    "stream_scores": stream_scores,
    "etl_chain": etl_chain,
    "etl_counts": etl_counts,
    "gbt_eval": gbt_eval,
    "mlp_eval": mlp_eval,
}
