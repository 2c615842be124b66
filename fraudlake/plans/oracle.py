"""DuckDB SQL twins of ``plans.queries`` (same column names and types).

The CTEs below mirror ``plans.fixtures`` line by line.
"""

from __future__ import annotations

TX = """tx AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS card_id, CAST(o.o_custkey AS VARCHAR) AS client_id,
         CAST(l.l_partkey AS VARCHAR) AS mcc, CAST(l.l_extendedprice AS FLOAT) AS amount,
         l.l_shipdate AS date, lower(l.l_returnflag) AS errors, l.l_linestatus AS use_chip,
         strftime(l.l_shipdate, '%Y-%m') AS year_month
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CARDS = """cards AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS client_id,
         '4' || lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS card_number,
         lower(o_orderstatus) AS card_brand, lower(o_orderpriority) AS card_type,
         CASE WHEN o_orderkey % 3 = 0 THEN 'no' ELSE 'yes' END AS has_chip,
         CAST(o_orderkey % 3 + 1 AS INTEGER) AS num_cards_issued,
         CAST(floor(o_totalprice) AS INTEGER) AS credit_limit,
         CAST(o_orderdate AS DATE) AS acct_open_date,
         CAST(year(o_orderdate) - o_orderkey % 5 AS INTEGER) AS year_pin_last_changed
  FROM orders)"""

USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_mktsegment) AS gender,
         CAST(floor(c_acctbal) AS INTEGER) AS yearly_income,
         CAST(c_nationkey % 5 + 1 AS INTEGER) AS num_credit_cards
  FROM customer)"""

MCC = """mcc AS (SELECT CAST(p_partkey AS VARCHAR) AS mcc_code, lower(trim(p_name)) AS mcc_description FROM part)"""

SCORED = """scored AS (
  SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS day,
         CAST(event_type = 'error' AS INTEGER) AS label,
         round((CAST((event_id * 37 + CAST(floor(value * 10) AS BIGINT)) % 1000 AS DOUBLE) / 1000.0
                + CASE WHEN event_type = 'error' THEN 0.35 ELSE 0.0 END) / 1.35, 3) AS score
  FROM events)"""

RAW_TX = """raw_tx AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
         CAST(user_id AS VARCHAR) AS client_id,
         CAST(event_id % 997 AS VARCHAR) AS card_id,
         CASE WHEN event_id % 11 = 0 THEN '$n/a'
              ELSE '$' || CASE WHEN event_id % 5 = 0 THEN '-' ELSE '' END
                   || CAST(CAST(round(value * 100) AS BIGINT) // 100 AS VARCHAR) || '.'
                   || lpad(CAST(CAST(round(value * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS amount,
         CASE WHEN value > 25 THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip,
         CAST(user_id * 7 AS VARCHAR) AS merchant_id,
         'City ' || upper(event_type) AS merchant_city,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE '  ' || (['CL', 'ER', 'PU', 'SI', 'VI'])[CAST(user_id % 5 AS INTEGER) + 1] || ' ' END AS merchant_state,
         CASE WHEN event_id % 7 = 3 THEN NULL ELSE CAST(user_id * 101 AS VARCHAR) || '.0' END AS zip,
         json_extract_string(props, '$.k') AS mcc,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE ' ' || (['BAD PIN', 'BAD CVV', 'TECHNICAL GLITCH', 'INSUFFICIENT BALANCE'])[CAST(user_id * 3 % 4 AS INTEGER) + 1] || '  ' END AS errors
  FROM events)"""

RAW_CARDS = """raw_cards AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS client_id,
         '  ' || upper(o_orderstatus) || ' ' AS card_brand, ' ' || upper(o_orderpriority) AS card_type,
         '4' || lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS card_number,
         strftime(CAST(o_orderdate AS DATE) + INTERVAL 48 MONTH, '%m/%Y') AS expires,
         lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS cvv,
         CASE WHEN o_orderkey % 3 = 0 THEN ' NO' ELSE 'Yes ' END AS has_chip,
         CAST(o_orderkey % 3 + 1 AS VARCHAR) AS num_cards_issued,
         CASE WHEN o_orderkey % 19 = 0 THEN '$unknown' ELSE '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS credit_limit,
         CASE WHEN o_orderkey % 13 = 0 THEN '13/2020' WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE strftime(o_orderdate, '%m/%Y') END AS acct_open_date,
         CAST(year(o_orderdate) - o_orderkey % 5 AS VARCHAR) AS year_pin_last_changed,
         CASE WHEN o_orderkey % 2 = 0 THEN 'No' ELSE 'YES' END AS card_on_dark_web
  FROM orders)"""

RAW_USERS = """raw_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, upper(c_mktsegment) AS gender,
         '  ' || upper(c_name) || ' ' AS address,
         '$' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS yearly_income,
         '$' || CAST(c_custkey * 3 AS VARCHAR) || '.0' AS total_debt,
         CASE WHEN c_custkey % 19 = 0 THEN '$n/a' ELSE '$' || CAST(c_custkey % 500 + 100 AS VARCHAR) END AS per_capita_income,
         CAST(c_nationkey + 20 AS VARCHAR) AS current_age,
         CAST(c_nationkey % 5 + 1 AS VARCHAR) AS num_credit_cards,
         CAST(c_custkey * 37 % 551 + 300 AS VARCHAR) || '.0' AS credit_score
  FROM customer)"""


def money_int(x: str) -> str:
    d = f"TRY_CAST(replace({x}, '$', '') AS DOUBLE)"
    return f"(CASE WHEN {d} BETWEEN -2147483648 AND 2147483647 THEN CAST(trunc({d}) AS INTEGER) END)"


def money_float(x: str) -> str:
    return f"TRY_CAST(replace({x}, '$', '') AS FLOAT)"


def month_date(x: str) -> str:
    return f"CAST(try_strptime('01/' || trim({x}), '%d/%m/%Y') AS DATE)"


def int_text(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS INTEGER), {money_int(x)})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SILVER_CARDS = f"""silver_cards AS (
  SELECT id, client_id, card_number, {month_date('expires')} AS expires, {month_date('acct_open_date')} AS acct_open_date,
         trim(lower(card_brand)) AS card_brand, trim(lower(card_type)) AS card_type,
         trim(lower(has_chip)) AS has_chip, trim(lower(card_on_dark_web)) AS card_on_dark_web, cvv,
         {int_text('num_cards_issued')} AS num_cards_issued, {money_int('credit_limit')} AS credit_limit,
         {int_text('year_pin_last_changed')} AS year_pin_last_changed
  FROM raw_cards)"""

SILVER_TX = """silver_tx AS (
  SELECT id, TRY_CAST(date AS TIMESTAMP) AS date, client_id, card_id,
         TRY_CAST(replace(amount, '$', '') AS FLOAT) AS amount, use_chip, merchant_id,
         lower(merchant_city) AS merchant_city,
         CASE WHEN merchant_state IS NULL THEN 'online' ELSE lower(trim(merchant_state)) END AS merchant_state,
         coalesce(regexp_replace(zip, '\\.0$', ''), '0') AS zip, mcc,
         CASE WHEN errors IS NULL THEN 'no_error' ELSE trim(lower(errors)) END AS errors
  FROM raw_tx)"""

SQL: dict[str, str] = {}

SQL["gold_features"] = with_(TX, CARDS, USERS, MCC) + """
SELECT tx.card_id, tx.client_id, tx.mcc, tx.amount, CAST(tx.date AS DATE) AS date, tx.errors, tx.use_chip,
       tx.year_month, u.gender, u.yearly_income, u.num_credit_cards, c.card_number, c.card_brand, c.card_type,
       c.has_chip, c.num_cards_issued, c.credit_limit, c.acct_open_date, c.year_pin_last_changed,
       m.mcc_description,
       round(CAST(date_diff('day', c.acct_open_date, CAST(tx.date AS DATE)) AS DOUBLE) / 30.0, 1) + CAST(0 AS DOUBLE) AS acct_opened_months,
       CAST(year(tx.date) - c.year_pin_last_changed AS INTEGER) AS yrs_since_pin_changed
FROM tx LEFT JOIN users u ON tx.client_id = u.id
        LEFT JOIN cards c ON tx.card_id = c.id
        LEFT JOIN mcc m ON tx.mcc = m.mcc_code"""

SQL["month_sequence"] = """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date
FROM (SELECT date_trunc('month', min(l_shipdate)) AS lo, max(l_shipdate) AS hi FROM lineitem)"""

SQL["snapshot_counts"] = with_(TX) + """
SELECT CAST(date_trunc('month', date) AS DATE) AS snapshot_date, count(*) AS n
FROM tx
WHERE CAST(date_trunc('month', date) AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-01'
GROUP BY 1"""

SQL["json_map_rows"] = with_(MCC) + "SELECT mcc_code, mcc_description FROM mcc"

SQL["json_range_rows"] = """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_type || ', "' || CAST(user_id AS VARCHAR) || '"' || chr(10) || '{' AS note FROM events
UNION ALL SELECT 'end', NULL"""

SQL["json_label_rows"] = """
SELECT lower(CAST(event_id AS VARCHAR)) AS transaction_id,
       CASE WHEN event_type = 'error' THEN 'yes' ELSE 'no' END AS is_fraud
FROM events"""

SQL["silver_money"] = with_(RAW_TX) + f"""
SELECT id, {money_float('amount')} AS amount, {money_int('amount')} AS amount_int FROM raw_tx"""

SQL["silver_month_dates"] = with_(RAW_CARDS) + f"""
SELECT id, {month_date('expires')} AS expires, {month_date('acct_open_date')} AS acct_open_date FROM raw_cards"""

SQL["silver_null_fill"] = with_(RAW_TX, SILVER_TX) + """
SELECT id, client_id, card_id, merchant_id, mcc, merchant_city, merchant_state, zip, errors, use_chip,
       CAST(date AS DATE) AS date, CAST(hour(date) AS INTEGER) AS hour
FROM silver_tx"""

SQL["silver_categories"] = with_(RAW_CARDS, SILVER_CARDS) + """
SELECT id, client_id, card_brand, card_type, has_chip, card_on_dark_web, cvv, num_cards_issued, credit_limit,
       year_pin_last_changed
FROM silver_cards"""

SQL["silver_users"] = with_(RAW_USERS) + f"""
SELECT id, lower(gender) AS gender, trim(lower(address)) AS address,
       {money_int('yearly_income')} AS yearly_income, {money_int('total_debt')} AS total_debt,
       {money_int('per_capita_income')} AS per_capita_income,
       {int_text('current_age')} AS current_age, {int_text('num_credit_cards')} AS num_credit_cards,
       {int_text('credit_score')} AS credit_score
FROM raw_users"""

SQL["cast_nulls"] = with_(RAW_CARDS, SILVER_CARDS) + """
SELECT * FROM (
  SELECT 'credit_limit' AS column_name,
         CAST((SELECT count(*) FROM silver_cards WHERE credit_limit IS NULL)
            - (SELECT count(*) FROM raw_cards WHERE credit_limit IS NULL) AS BIGINT) AS nulls_made
  UNION ALL
  SELECT 'acct_open_date', CAST((SELECT count(*) FROM silver_cards WHERE acct_open_date IS NULL)
            - (SELECT count(*) FROM raw_cards WHERE acct_open_date IS NULL) AS BIGINT)
  UNION ALL
  SELECT 'expires', CAST((SELECT count(*) FROM silver_cards WHERE expires IS NULL)
            - (SELECT count(*) FROM raw_cards WHERE expires IS NULL) AS BIGINT))"""

SILVER_USERS = f"""silver_users AS (
  SELECT id, lower(gender) AS gender, trim(lower(address)) AS address,
         {money_int('yearly_income')} AS yearly_income, {money_int('total_debt')} AS total_debt,
         {money_int('per_capita_income')} AS per_capita_income,
         {int_text('current_age')} AS current_age, {int_text('num_credit_cards')} AS num_credit_cards
  FROM raw_users)"""

LABELS = """silver_labels AS (
  SELECT lower(CAST(event_id AS VARCHAR)) AS transaction_id,
         trim(lower(CASE WHEN event_type = 'error' THEN ' Yes' ELSE 'NO ' END)) AS is_fraud
  FROM events WHERE event_id % 9 <> 4)"""

SQL["gold_with_labels"] = with_(RAW_TX, SILVER_TX, RAW_CARDS, SILVER_CARDS, RAW_USERS, SILVER_USERS, MCC, LABELS) + """
SELECT t.id AS transaction_id, t.client_id, t.card_id, t.mcc, t.amount, CAST(t.date AS DATE) AS date,
       t.merchant_state, t.zip, t.errors, t.use_chip, u.gender, u.address, c.card_brand, c.card_type,
       c.credit_limit, c.acct_open_date, m.mcc_description,
       round(CAST(date_diff('day', c.acct_open_date, CAST(t.date AS DATE)) AS DOUBLE) / 30.0, 1) + CAST(0 AS DOUBLE) AS acct_opened_months,
       CAST(year(t.date) - c.year_pin_last_changed AS INTEGER) AS yrs_since_pin_changed,
       l.is_fraud,
       CAST(CASE WHEN trim(lower(l.is_fraud)) = 'yes' THEN 1 WHEN trim(lower(l.is_fraud)) = 'no' THEN 0 END AS INTEGER) AS label
FROM silver_tx t
LEFT JOIN silver_users u ON t.client_id = u.id
LEFT JOIN silver_cards c ON t.card_id = c.id
LEFT JOIN mcc m ON t.mcc = m.mcc_code
LEFT JOIN silver_labels l ON t.id = l.transaction_id"""

SQL["feature_label_join"] = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

SQL["unlabeled_share"] = """
SELECT count(*) AS total, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS unlabeled,
       round(CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS DOUBLE) * 100.0 / count(*), 2) AS unlabeled_pct
FROM documents d"""

SQL["orphan_report"] = with_(TX, CARDS, USERS, MCC, LABELS, """orph AS (
  SELECT 'labels_to_tx' AS check_name, k FROM (SELECT DISTINCT transaction_id AS k FROM silver_labels WHERE transaction_id IS NOT NULL)
    WHERE k NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_id % 11 <> 0)
  UNION ALL
  SELECT 'tx_client_to_cards', k FROM (SELECT DISTINCT client_id AS k FROM tx WHERE client_id IS NOT NULL)
    WHERE k NOT IN (SELECT client_id FROM cards WHERE CAST(client_id AS BIGINT) % 11 <> 0)
  UNION ALL
  SELECT 'cards_client_to_users', k FROM (SELECT DISTINCT client_id AS k FROM cards WHERE client_id IS NOT NULL)
    WHERE k NOT IN (SELECT id FROM users WHERE CAST(id AS BIGINT) % 11 <> 0)
  UNION ALL
  SELECT 'tx_card_to_cards', k FROM (SELECT DISTINCT card_id AS k FROM tx WHERE card_id IS NOT NULL)
    WHERE k NOT IN (SELECT id FROM cards WHERE CAST(id AS BIGINT) % 11 <> 0)
  UNION ALL
  SELECT 'tx_mcc_to_mcc', k FROM (SELECT DISTINCT mcc AS k FROM tx WHERE mcc IS NOT NULL)
    WHERE k NOT IN (SELECT mcc_code FROM mcc WHERE CAST(mcc_code AS BIGINT) % 11 <> 0))""", """names AS (
  SELECT * FROM (VALUES ('labels_to_tx'), ('tx_client_to_cards'), ('cards_client_to_users'),
                        ('tx_card_to_cards'), ('tx_mcc_to_mcc')) v(check_name))""") + """
SELECT n.check_name, count(o.k) AS missing,
       coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT k FROM orph o2 WHERE o2.check_name = n.check_name ORDER BY k LIMIT 5)), '') AS examples
FROM names n LEFT JOIN orph o ON o.check_name = n.check_name
GROUP BY n.check_name"""

SQL["online_profiles"] = with_(RAW_CARDS, SILVER_CARDS, RAW_USERS, SILVER_USERS, """prof AS (
  SELECT '4' || lpad(CAST(CAST(c.id AS BIGINT) // 2 AS VARCHAR), 15, '0') AS card_number,
         c.client_id, c.id AS card_id, c.card_brand, c.card_type, c.credit_limit, c.acct_open_date, c.expires,
         c.year_pin_last_changed, u.gender, u.address, u.yearly_income
  FROM silver_cards c JOIN silver_users u ON c.client_id = u.id)""", """last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY card_number
                     ORDER BY acct_open_date DESC NULLS LAST, card_id DESC) AS rn FROM prof) WHERE rn = 1)""") + """
SELECT card_number AS key,
       CAST(json_object('client_id', coalesce(client_id, ''), 'card_id', coalesce(card_id, ''),
         'card_brand', coalesce(card_brand, ''), 'card_type', coalesce(card_type, ''),
         'credit_limit', coalesce(CAST(credit_limit AS VARCHAR), ''),
         'acct_open_date', coalesce(strftime(acct_open_date, '%Y-%m-%d'), ''),
         'expires', coalesce(strftime(expires, '%Y-%m-%d'), ''),
         'year_pin_last_changed', coalesce(CAST(year_pin_last_changed AS VARCHAR), ''),
         'gender', coalesce(gender, ''), 'address', coalesce(address, ''),
         'yearly_income', coalesce(CAST(yearly_income AS VARCHAR), '')) AS VARCHAR) AS value
FROM last"""

SQL["last_per_key"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""

REQUESTS = """req AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         '4' || lpad(CAST(event_id * 3 % 20011 AS VARCHAR), 15, '0') AS card_number,
         ts AS date, value AS amount, json_extract_string(props, '$.k') AS mcc, event_type AS errors
  FROM events)"""

SQL["request_lookup"] = with_(CARDS, USERS, REQUESTS) + """
SELECT r.transaction_id, r.card_number, r.amount, r.mcc, r.errors, c.card_brand, c.card_type, c.credit_limit,
       u.gender, CAST(r.date AS DATE) AS date,
       round(CAST(date_diff('day', c.acct_open_date, CAST(r.date AS DATE)) AS DOUBLE) / 30.0, 1) + CAST(0 AS DOUBLE) AS acct_opened_months,
       CAST(year(r.date) - c.year_pin_last_changed AS INTEGER) AS yrs_since_pin_changed
FROM req r JOIN cards c ON r.card_number = c.card_number JOIN users u ON c.client_id = u.id"""

SQL["request_rejects"] = with_(CARDS, USERS, REQUESTS) + """
SELECT r.transaction_id, r.card_number FROM req r
WHERE r.card_number NOT IN (SELECT c.card_number FROM cards c JOIN users u ON c.client_id = u.id)"""

SQL["dedup_rows"] = """
SELECT DISTINCT event_id, user_id, event_type, value, props FROM (
  SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)"""

# ---------------------------------------------------------------- profiling
GOLD_CTES = [TX, CARDS, USERS, MCC, "gold AS (" + SQL["gold_features"][SQL["gold_features"].index("SELECT tx.card_id"):] + ")"]
GOLD_LABELS_CTES = [RAW_TX, SILVER_TX, RAW_CARDS, SILVER_CARDS, RAW_USERS, SILVER_USERS, MCC, LABELS,
                    "gwl AS (" + SQL["gold_with_labels"][SQL["gold_with_labels"].index("SELECT t.id AS transaction_id"):] + ")"]
NUMERIC_PROFILE = ["amount", "yearly_income", "credit_limit", "acct_opened_months", "yrs_since_pin_changed",
                   "num_cards_issued"]
RAW_TX_COLUMNS = ["id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city",
                  "merchant_state", "zip", "mcc", "errors"]

SQL["profile_missing"] = with_(RAW_TX, f"""r AS (SELECT * REPLACE ({money_float('amount')} AS amount) FROM raw_tx)""") + (
    "SELECT * FROM (" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS missing_pct FROM r"
        for c in RAW_TX_COLUMNS) + ") WHERE missing > 0")

_CARD_COLS = ["transaction_id", "client_id", "card_id", "use_chip", "merchant_id", "merchant_city", "merchant_state",
              "zip", "mcc", "errors"]
SQL["profile_cardinality"] = with_(RAW_TX, SILVER_TX, "t AS (SELECT * RENAME (id AS transaction_id) FROM silver_tx)") + (
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_values, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_values, "
        f"round(CAST(count(DISTINCT {c}) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE), 2) AS cardinality_pct FROM t"
        for c in _CARD_COLS))

SQL["profile_distribution"] = with_(RAW_TX) + (
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n, "
        f"CAST(count(*) AS DOUBLE) * 100.0 / CAST((SELECT count(*) FROM raw_tx) AS DOUBLE) AS pct FROM raw_tx GROUP BY {c}"
        for c in ["use_chip", "merchant_city", "merchant_state", "errors"]))

SQL["profile_numeric"] = with_(*GOLD_CTES) + (
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(CAST({c} AS DOUBLE)) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, round(min(CAST({c} AS DOUBLE)), 6) AS min, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, round(max(CAST({c} AS DOUBLE)), 6) AS max FROM gold"
        for c in NUMERIC_PROFILE))

SQL["class_balance"] = with_(*GOLD_LABELS_CTES) + """
SELECT CAST(label AS VARCHAR) AS label, count(*) AS n,
       CAST(count(*) AS DOUBLE) * 100.0 / CAST((SELECT count(*) FROM gwl) AS DOUBLE) AS pct
FROM gwl GROUP BY label"""

SQL["histogram"] = with_(TX, """b AS (SELECT min(CAST(amount AS DOUBLE)) AS lo, max(CAST(amount AS DOUBLE)) AS hi,
                 (max(CAST(amount AS DOUBLE)) - min(CAST(amount AS DOUBLE))) / 50 AS w FROM tx)""",
                         """c AS (SELECT CAST(least(floor((CAST(amount AS DOUBLE) - b.lo) / b.w), 49) AS INTEGER) AS bin, count(*) AS n
           FROM tx, b WHERE amount IS NOT NULL GROUP BY 1)""") + """
SELECT CAST(g.bin AS INTEGER) AS bin, b.lo + CAST(g.bin AS DOUBLE) * b.w AS bin_lo,
       b.lo + CAST(g.bin + 1 AS DOUBLE) * b.w AS bin_hi, coalesce(c.n, 0) AS n
FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin"""

SQL["monthly_volume"] = with_(TX) + """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n, count(*) FILTER (WHERE errors = 'r') AS n_returned
FROM tx GROUP BY 1"""

_PAIRS = [(a, b) for i, a in enumerate(NUMERIC_PROFILE) for b in NUMERIC_PROFILE[i + 1:]]
SQL["corr_matrix"] = with_(*GOLD_CTES) + "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM gold"
    for a, b in _PAIRS)

_TYPES = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]
SQL["crosstab"] = with_(CARDS) + "SELECT card_brand, " + ", ".join(
    f"count(*) FILTER (WHERE card_type = '{t}') AS \"{t}\"" for t in _TYPES) + " FROM cards GROUP BY card_brand"

SQL["date_range"] = with_(TX, CARDS) + """
SELECT 'transactions' AS table_name, CAST(min(date) AS DATE) AS min_date, CAST(max(date) AS DATE) AS max_date FROM tx
UNION ALL SELECT 'cards', min(acct_open_date), max(acct_open_date) FROM cards
UNION ALL SELECT 'events', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events"""

SQL["length_dist"] = with_(RAW_TX, SILVER_TX) + """
SELECT CAST(length(zip) AS INTEGER) AS length, count(*) AS n FROM silver_tx GROUP BY 1"""

SQL["distinct_values"] = with_(CARDS) + "SELECT DISTINCT card_brand, card_type FROM cards"

SQL["top_values"] = with_(TX) + """
SELECT mcc, count(*) AS n FROM tx GROUP BY mcc ORDER BY n DESC, mcc ASC LIMIT 10"""

SQL["top_preview"] = with_(RAW_TX, SILVER_TX) + """
SELECT id AS transaction_id, amount, merchant_state, errors FROM silver_tx
WHERE merchant_state = 'online' AND amount IS NOT NULL ORDER BY amount DESC, id ASC LIMIT 5"""

_FLAGS = {
    "is_online_merchant": "merchant_state = 'online'", "is_refund": "amount < 0", "has_error": "errors <> 'no_error'",
    "has_zip": "zip <> '0'", "has_merchant_state": "merchant_state <> 'online'",
}
SQL["profile_flags"] = with_(RAW_TX, SILVER_TX, RAW_CARDS, SILVER_CARDS) + "\nUNION ALL ".join(
    [f"SELECT '{k}' AS flag, CAST(sum(CAST({v} AS INTEGER)) AS BIGINT) AS n, "
     f"CAST(CAST(sum(CAST({v} AS INTEGER)) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct FROM silver_tx"
     for k, v in _FLAGS.items()]
    + ["SELECT 'cvv_available', CAST(sum(CAST(length(cvv) >= 3 AS INTEGER)) AS BIGINT), "
       "CAST(CAST(sum(CAST(length(cvv) >= 3 AS INTEGER)) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) FROM silver_cards"])

SQL["table_shape"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rows, {n} AS columns FROM {t}"
    for t, n in [("lineitem", 11), ("orders", 6), ("customer", 5), ("part", 6), ("events", 6)])

SQL["flag_cross"] = with_(RAW_TX) + """
SELECT CAST(use_chip = 'Swipe Transaction' AS INTEGER) AS is_online, CAST(merchant_state IS NULL AS INTEGER) AS state_missing, count(*) AS n,
       CAST(count(*) AS DOUBLE) * 100.0 / CAST((SELECT count(*) FROM raw_tx) AS DOUBLE) AS pct
FROM raw_tx GROUP BY 1, 2"""

_KINDS = {"numeric": ["amount", "credit_limit", "acct_opened_months", "yrs_since_pin_changed"],
          "categorical": ["transaction_id", "client_id", "card_id", "mcc", "merchant_state", "zip", "errors", "use_chip", "gender", "address",
                          "card_brand", "card_type", "mcc_description", "is_fraud"]}
SQL["column_values"] = with_(*GOLD_LABELS_CTES) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS kind, count({c}) AS n FROM gwl" for k, cs in _KINDS.items() for c in cs)

SQL["silver_mcc"] = """
SELECT 'm' || CAST(p_partkey AS VARCHAR) AS mcc_code, trim(lower('  ' || upper(p_name) || ' ')) AS mcc_description FROM part"""

SQL["table_overwrite"] = with_(CARDS) + """
SELECT card_brand, has_chip, count(*) AS n FROM cards WHERE has_chip = 'yes' GROUP BY 1, 2"""

# ------------------------------------------------------ splits and metrics
def oot_ctes(src: str, date_expr: str, splits: int, days: int, prefix: str) -> list[str]:
    ctes = [f"{prefix}d AS (SELECT DISTINCT CAST({date_expr} AS DATE) AS d FROM {src} WHERE {date_expr} IS NOT NULL)",
            f"{prefix}1 AS (SELECT max(d) - {days} AS c FROM {prefix}d)"]
    for i in range(2, splits + 1):
        ctes.append(f"{prefix}{i} AS (SELECT max(d) - {days} AS c FROM {prefix}d WHERE d < (SELECT c FROM {prefix}{i - 1}))")
    return ctes


def oot_case(date_expr: str, splits: int, prefix: str) -> str:
    whens = " ".join(f"WHEN CAST({date_expr} AS DATE) >= (SELECT c FROM {prefix}{i}) THEN 'oot{i}'" for i in range(1, splits + 1))
    return f"CASE {whens} ELSE 'train' END"


SCORED_SPLIT = [SCORED, *oot_ctes("scored", "day", 3, 7, "e"),
                f"ss AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction, {oot_case('day', 3, 'e')} AS split_id FROM scored)"]

SQL["rolling_rate"] = with_(SCORED) + """
SELECT event_id, CASE WHEN rn >= 1000 THEN round(CAST(s AS DOUBLE) / 1000.0, 6) END AS rolling_rate FROM (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn,
         sum(label) OVER (ORDER BY ts, event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS s FROM scored)"""

SQL["oot_splits"] = with_(TX, *oot_ctes("tx", "date", 3, 30, "t")) + f"""
SELECT split_id, count(*) AS n, min(CAST(date AS DATE)) AS min_date, max(CAST(date AS DATE)) AS max_date
FROM (SELECT *, {oot_case('date', 3, 't')} AS split_id FROM tx) GROUP BY split_id"""


def strat_rank(src: str, seed: int) -> str:
    return (f"row_number() OVER (PARTITION BY label ORDER BY md5('{seed}:' || CAST(event_id AS VARCHAR)), event_id) AS rn, "
            f"count(*) OVER (PARTITION BY label) AS n_label")


SQL["cutoff_splits"] = with_(SCORED, """ev AS (SELECT *, CASE WHEN day >= DATE '2024-01-26' THEN 'oot3'
                                 WHEN day >= DATE '2024-01-21' THEN 'oot2'
                                 WHEN day >= DATE '2024-01-16' THEN 'oot1' ELSE 'pool' END AS split_id FROM scored)""",
                             f"pool AS (SELECT *, {strat_rank('ev', 42)} FROM ev WHERE split_id = 'pool')") + """
SELECT split_id, label, count(*) AS n FROM (
  SELECT split_id, label FROM ev WHERE split_id <> 'pool'
  UNION ALL
  SELECT CASE WHEN rn <= floor(CAST(0.2 AS DOUBLE) * n_label + 0.5) THEN 'test' ELSE 'train' END, label FROM pool)
GROUP BY split_id, label"""

SQL["cutoff_train_val"] = with_(SCORED, """ev AS (SELECT *, CASE WHEN day >= DATE '2024-01-26' THEN 'oot3'
                                 WHEN day >= DATE '2024-01-21' THEN 'oot2'
                                 WHEN day >= DATE '2024-01-16' THEN 'oot1' ELSE 'pool' END AS split_id FROM scored)""",
                                f"pool AS (SELECT *, {strat_rank('ev', 42)} FROM ev WHERE split_id = 'pool')",
                                "tv AS (SELECT event_id, label FROM pool WHERE NOT (rn <= floor(CAST(0.2 AS DOUBLE) * n_label + 0.5)))",
                                f"v AS (SELECT *, {strat_rank('tv', 43)} FROM tv)") + """
SELECT split_id, label, count(*) AS n FROM (
  SELECT split_id, label FROM ev WHERE split_id <> 'pool'
  UNION ALL SELECT 'test', label FROM pool WHERE rn <= floor(CAST(0.2 AS DOUBLE) * n_label + 0.5)
  UNION ALL SELECT CASE WHEN rn <= floor(CAST(0.25 AS DOUBLE) * n_label + 0.5) THEN 'val' ELSE 'train' END, label FROM v)
GROUP BY split_id, label"""

SQL["stratified_split"] = with_(SCORED, f"r AS (SELECT *, {strat_rank('scored', 42)} FROM scored)") + """
SELECT event_id, label, CAST(rn <= floor(CAST(0.2 AS DOUBLE) * n_label + 0.5) AS INTEGER) AS is_test FROM r"""

SQL["validation_split"] = with_(
    SCORED, f"r AS (SELECT *, {strat_rank('scored', 42)} FROM scored)",
    "tr AS (SELECT event_id, label FROM r WHERE NOT (rn <= floor(CAST(0.2 AS DOUBLE) * n_label + 0.5)))",
    f"v AS (SELECT *, {strat_rank('tr', 7)} FROM tr)") + """
SELECT event_id, label, CAST(rn <= floor(CAST(0.25 AS DOUBLE) * n_label + 0.5) AS INTEGER) AS is_val FROM v"""

SQL["undersample"] = with_(SCORED, f"r AS (SELECT *, {strat_rank('scored', 42)} FROM scored)",
                           "m AS (SELECT min(n) AS n_min FROM (SELECT count(*) AS n FROM scored GROUP BY label))") + """
SELECT event_id, label FROM r
WHERE rn <= CASE WHEN n_label = (SELECT n_min FROM m) THEN n_label
                 ELSE least(n_label, floor(CAST(1.0 AS DOUBLE) * (SELECT n_min FROM m) + 0.5)) END"""

F1_EXPR = """round(CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0.0 END, 6)"""
COUNTS = """count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn"""

SQL["trial_champion"] = with_(SCORED, f"""f AS (SELECT CAST(dayofmonth(day) AS INTEGER) AS trial, {COUNTS}
   FROM (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM scored) GROUP BY 1)""",
                              f"v AS (SELECT trial, {F1_EXPR} AS value FROM f)",
                              "p AS (SELECT trial, value, max(value) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM v)") + """
SELECT trial, value, prev_best, CAST(prev_best IS NULL OR value > prev_best AS INTEGER) AS is_champion,
       CASE WHEN (prev_best IS NULL OR value > prev_best) AND prev_best IS NOT NULL
            THEN round(abs(prev_best - value) / value * 100.0, 6) END AS improvement_pct
FROM p"""

SQL["confusion"] = with_(SCORED) + """
SELECT label, CAST(score >= 0.5 AS INTEGER) AS prediction, count(*) AS n FROM scored GROUP BY 1, 2"""

SQL["f1_by_split"] = with_(*SCORED_SPLIT, f"c AS (SELECT split_id, {COUNTS} FROM ss GROUP BY split_id)") + f"""
SELECT split_id, tp, fp, fn, tn,
       round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END, 6) AS recall,
       {F1_EXPR} AS f1
FROM c"""

SQL["log_loss"] = with_(*SCORED_SPLIT, """q AS (SELECT split_id, CAST(label AS DOUBLE) AS y,
    least(greatest(CAST(score AS DOUBLE), 1e-15), 1 - 1e-15) AS p FROM ss)""") + """
SELECT split_id, round(avg(-(y * ln(p) + (1.0 - y) * ln(1.0 - p))), 6) AS log_loss, count(*) AS n FROM q GROUP BY split_id"""

GROUPS = """g AS (SELECT split_id, CAST(score AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
                      count(*) FILTER (WHERE label = 0) AS neg FROM ss GROUP BY 1, 2)"""

SQL["roc_auc"] = with_(*SCORED_SPLIT, GROUPS, """c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split_id ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)""") + """
SELECT split_id, round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
         sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0))
         / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END, 6) AS roc_auc
FROM c GROUP BY split_id"""

SQL["avg_precision"] = with_(*SCORED_SPLIT, GROUPS, """c AS (SELECT *,
    sum(pos) OVER (PARTITION BY split_id ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
    sum(neg) OVER (PARTITION BY split_id ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM g)""") + """
SELECT split_id, round(CASE WHEN sum(pos) > 0 THEN
         sum(CAST(pos AS DOUBLE) * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / CAST(sum(pos) AS DOUBLE) END, 6) AS avg_precision
FROM c GROUP BY split_id"""

SQL["roc_curve"] = with_(SCORED, """g AS (SELECT CAST(score AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
                      count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1)""", """c AS (SELECT *,
    sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
    sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
    sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)""") + """
SELECT score AS threshold, round(CAST(tp AS DOUBLE) / CAST(P AS DOUBLE), 6) AS tpr,
       round(CAST(fp AS DOUBLE) / CAST(N AS DOUBLE), 6) AS fpr,
       round(CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE), 6) AS precision
FROM c"""

# -------------------------------------------------------------------- drift
DRIFT_CATEGORICAL = ["errors", "use_chip", "card_brand", "card_type", "gender", "has_chip"]
DRIFT_NUMERIC = ["amount", "credit_limit", "acct_opened_months", "yrs_since_pin_changed", "yearly_income",
                 "num_cards_issued"]
DRIFT_SIDES = [*GOLD_CTES, "ref AS (SELECT * FROM gold WHERE date < DATE '2000-01-01')",
               "cur AS (SELECT * FROM gold WHERE date >= DATE '2000-01-01')"]


SQL["reference_set"] = with_(*DRIFT_SIDES) + """
SELECT run_name, errors, count(*) AS n, CAST(sum(credit_limit) AS BIGINT) AS credit_limit, count(DISTINCT card_type) AS card_types FROM (
  SELECT 'run-1' AS run_name, * FROM ref WHERE errors <> 'r' UNION ALL SELECT 'run-2', * FROM ref WHERE errors = 'r')
GROUP BY run_name, errors"""


def psi_ctes(value_of: dict[str, str]) -> list[str]:
    def counts(side: str) -> str:
        return "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({e} AS VARCHAR) AS value, count(*) AS n FROM {side} GROUP BY 2"
                                   for c, e in value_of.items())
    return [f"rc AS ({counts('ref')})", f"cc AS ({counts('cur')})", """sh AS (
  SELECT coalesce(r.column_name, c.column_name) AS column_name,
         greatest(CAST(coalesce(r.n, 0) AS DOUBLE) / CAST((SELECT count(*) FROM ref) AS DOUBLE), 0.0001) AS p,
         greatest(CAST(coalesce(c.n, 0) AS DOUBLE) / CAST((SELECT count(*) FROM cur) AS DOUBLE), 0.0001) AS q
  FROM rc r FULL JOIN cc c ON r.column_name = c.column_name AND r.value IS NOT DISTINCT FROM c.value)""",
            "psi AS (SELECT column_name, sum((q - p) * ln(q / p)) AS psi FROM sh GROUP BY column_name)"]


_EDGES = "edges AS (SELECT " + ", ".join(
    f"list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e_{c}"
    for c in DRIFT_NUMERIC) + " FROM ref)"
_BINS = {c: f"(CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter((SELECT e_{c} FROM edges), lambda e: CAST({c} AS DOUBLE) > e)) END)"
         for c in DRIFT_NUMERIC}

SQL["psi_categorical"] = with_(*DRIFT_SIDES, *psi_ctes({c: c for c in DRIFT_CATEGORICAL})) + \
    "SELECT column_name, round(psi, 6) AS psi FROM psi"

SQL["psi_numeric"] = with_(*DRIFT_SIDES, _EDGES, *psi_ctes(_BINS)) + "SELECT column_name, round(psi, 6) AS psi FROM psi"

_CDF = ["vals AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v, 1 AS is_ref FROM ref WHERE {c} IS NOT NULL "
    f"UNION ALL SELECT '{c}', CAST({c} AS DOUBLE), 0 FROM cur WHERE {c} IS NOT NULL" for c in DRIFT_NUMERIC) + ")",
    """g AS (SELECT column_name, v, count(*) FILTER (WHERE is_ref = 1) AS nr, count(*) FILTER (WHERE is_ref = 0) AS nc
          FROM vals GROUP BY 1, 2)""", """c AS (SELECT *,
    sum(nr) OVER (PARTITION BY column_name ORDER BY v ROWS UNBOUNDED PRECEDING) AS cr,
    sum(nc) OVER (PARTITION BY column_name ORDER BY v ROWS UNBOUNDED PRECEDING) AS cc,
    sum(nr) OVER (PARTITION BY column_name) AS tr, sum(nc) OVER (PARTITION BY column_name) AS tc,
    lead(v) OVER (PARTITION BY column_name ORDER BY v) AS next_v,
    sum(nr * v) OVER (PARTITION BY column_name) / sum(nr) OVER (PARTITION BY column_name) AS mean FROM g)"""]
_GAP = "abs(CAST(cr AS DOUBLE) / CAST(tr AS DOUBLE) - CAST(cc AS DOUBLE) / CAST(tc AS DOUBLE))"
_WASSERSTEIN = f"""wd AS (SELECT column_name, sum({_GAP} * coalesce(next_v - v, 0))
    / greatest(sqrt(sum(nr * (v - mean) * (v - mean)) / sum(nr)), 0.001) AS wasserstein FROM c GROUP BY column_name)"""

SQL["ks_numeric"] = with_(*DRIFT_SIDES, *_CDF) + f"SELECT column_name, round(max({_GAP}), 6) AS ks FROM c GROUP BY column_name"

SQL["wasserstein_numeric"] = with_(*DRIFT_SIDES, *_CDF, _WASSERSTEIN) + "SELECT column_name, round(wasserstein, 6) AS wasserstein FROM wd"


def report_sql(run_id: str, rows: str) -> str:
    """The report of one run, as a query of its own."""
    sides = [*GOLD_CTES, f"own AS (SELECT * FROM gold WHERE {rows})", "ref AS (SELECT * FROM own WHERE date < DATE '2000-01-01')",
             "cur AS (SELECT * FROM own WHERE date >= DATE '2000-01-01')"]
    return with_(*sides, *_CDF, _WASSERSTEIN, *psi_ctes({c: c for c in DRIFT_CATEGORICAL})) + f"""
SELECT '{run_id}' AS run_id, column_name, 'categorical' AS kind, 'psi' AS test, round(psi, 6) AS score, CAST(psi >= 0.1 AS INTEGER) AS drifted FROM psi
UNION ALL
SELECT '{run_id}', column_name, 'numeric', 'wasserstein', round(wasserstein, 6), CAST(wasserstein >= 0.1 AS INTEGER) FROM wd"""


SQL["drift_report_table"] = f"""SELECT * FROM ({report_sql("run-1", "date IS NOT NULL")})
UNION ALL SELECT * FROM ({report_sql("run-2", "date <= DATE '2000-12-31'")})"""

_PSI_CAT = psi_ctes({c: c for c in DRIFT_CATEGORICAL})
_PSI_NUM = [x.replace("rc AS", "rn AS").replace("cc AS", "cn AS").replace("sh AS", "shn AS").replace("psi AS (", "psin AS (")
            .replace("FROM rc r FULL JOIN cc c", "FROM rn r FULL JOIN cn c").replace("FROM sh GROUP", "FROM shn GROUP")
            for x in psi_ctes(_BINS)]
SQL["dataset_drift"] = with_(*DRIFT_SIDES, _EDGES, *_PSI_CAT, *_PSI_NUM,
                             "allp AS (SELECT psi FROM psi UNION ALL SELECT psi FROM psin)") + """
SELECT count(*) AS n_columns, CAST(sum(CAST(psi >= 0.2 AS INTEGER)) AS BIGINT) AS n_drifted,
       round(CAST(sum(CAST(psi >= 0.2 AS INTEGER)) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS share,
       CAST(CAST(sum(CAST(psi >= 0.2 AS INTEGER)) AS DOUBLE) / CAST(count(*) AS DOUBLE) >= 0.5 AS INTEGER) AS dataset_drift
FROM allp"""

# ------------------------------------------------------- prep and resampling
STANDARDISE_COLUMNS = ["amount", "credit_limit", "acct_opened_months", "yrs_since_pin_changed"]
SQL["standardise"] = with_(*GOLD_LABELS_CTES, "tr AS (SELECT * FROM gwl WHERE date < DATE '2024-01-21')", "st AS (SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m_{c}, sqrt(var_pop(CAST({c} AS DOUBLE)) * count({c}) / count(*)) AS s_{c}"
    for c in STANDARDISE_COLUMNS) + " FROM tr)") + "SELECT transaction_id, " + ", ".join(
    f"round((coalesce(CAST({c} AS DOUBLE), m_{c}) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END, 6) AS {c}"
    for c in STANDARDISE_COLUMNS) + " FROM gwl, st"

_OH = {"merchant_state": ["cl", "er", "pu", "si", "vi"], "errors": ["bad cvv", "bad pin", "insufficient balance", "technical glitch"],
       "use_chip": ["Chip Transaction", "Swipe Transaction"]}
SQL["one_hot"] = with_(RAW_TX, """x AS (SELECT id AS transaction_id, CAST(CAST(date AS TIMESTAMP) AS DATE) AS day,
    trim(lower(merchant_state)) AS merchant_state, trim(lower(errors)) AS errors, use_chip FROM raw_tx)""",
                       "md AS (SELECT " + ", ".join(f"mode() WITHIN GROUP (ORDER BY {c}) AS md_{c}" for c in _OH)
                       + " FROM x WHERE day < DATE '2024-01-21')") + "SELECT transaction_id, " + ", ".join(
    f"CAST(coalesce({c}, md_{c}) = '{v}' AS DOUBLE) AS \"{c}={v}\"" for c, vs in _OH.items() for v in vs) + " FROM x, md"

_SPARSE = ["merchant_state", "errors", "use_chip", "merchant_id", "zip", "mcc"]
SQL["one_hot_sparse"] = with_(RAW_TX, "x AS (SELECT *, CAST(CAST(date AS TIMESTAMP) AS DATE) AS day FROM raw_tx)",
    "ones AS (" + " UNION ALL ".join(f"SELECT id, day, {i} AS place, {c} AS value FROM x" for i, c in enumerate(_SPARSE)) + ")",
    """md AS (SELECT place, value FROM (SELECT place, value, row_number() OVER (PARTITION BY place ORDER BY count(*) DESC, value) AS r
      FROM ones WHERE day < DATE '2024-01-21' AND value IS NOT NULL GROUP BY place, value) WHERE r = 1)""",
    """dict AS (SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS idx
      FROM (SELECT DISTINCT place, value FROM ones WHERE day < DATE '2024-01-21' AND value IS NOT NULL))""",
    """hits AS (SELECT o.id, d.idx FROM ones o JOIN md USING (place) JOIN dict d ON d.place = o.place AND d.value = coalesce(o.value, md.value))""",
    "per_row AS (SELECT id, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices FROM hits GROUP BY id)") + """
SELECT x.id AS transaction_id, coalesce(indices, '') AS indices, (SELECT count(*) FROM dict) AS n_features
FROM x LEFT JOIN per_row ON x.id = per_row.id"""

SQL["smote_neighbours"] = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS nn_id,
             list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))) AS dist
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nn_id) AS rank FROM p)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, nn_id, round(dist, 6) AS dist FROM r WHERE rank <= 5"""

SQL["smote_rows"] = """
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT label, (SELECT max(n) FROM c) AS n_rows, CAST((SELECT max(n) FROM c) - n AS BIGINT) AS n_synthetic FROM c"""

# ---------------------------------------------------------------- streaming
SQL["stream_enrich"] = with_(CARDS, USERS, REQUESTS, """prof AS (SELECT c.*, u.gender FROM cards c JOIN users u ON c.client_id = u.id)""") + """
SELECT r.transaction_id, r.card_number, r.amount, r.mcc, r.errors, p.card_brand, p.card_type, p.credit_limit,
       p.gender, CAST(r.date AS DATE) AS date,
       round(CAST(date_diff('day', p.acct_open_date, CAST(r.date AS DATE)) AS DOUBLE) / 30.0, 1) + CAST(0 AS DOUBLE) AS acct_opened_months,
       CAST(year(r.date) - p.year_pin_last_changed AS INTEGER) AS yrs_since_pin_changed,
       CASE WHEN p.card_number IS NULL THEN 0 ELSE 1 END AS matched
FROM req r LEFT JOIN prof p ON r.card_number = p.card_number"""

PRED_LOG = with_(SCORED) + """SELECT CAST(epoch_us(ts) // 1000000 AS BIGINT) AS event_time, CAST(ts AS DATE) AS event_date,
       CAST(event_id AS VARCHAR) AS transaction_id, CAST(score >= 0.5 AS INTEGER) AS is_fraud FROM scored"""
SQL["stream_predictions"] = PRED_LOG

SQL["prediction_range"] = "SELECT event_time, transaction_id, is_fraud FROM (" + PRED_LOG + """)
WHERE event_time BETWEEN CAST(epoch_us(TIMESTAMP '2024-01-10 00:00:00') // 1000000 AS BIGINT)
                     AND CAST(epoch_us(TIMESTAMP '2024-01-12 12:00:00') // 1000000 AS BIGINT)"""

SQL["stream_daily"] = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2"""

SQL["stream_dedup"] = "SELECT DISTINCT event_id, user_id, event_type, value FROM events"

SQL["stream_bronze"] = with_(TX) + """
SELECT CAST(date_trunc('month', date) AS DATE) AS snapshot_date, count(*) AS n FROM tx GROUP BY 1"""

SQL["unix_seconds"] = """
SELECT event_id, CAST(epoch_us(timezone('America/New_York', ts)) // 1000000 AS BIGINT) AS unix_seconds FROM events"""

# ------------------------------------------------------------ more sources
SQL["snapshot_roundtrip"] = with_(TX) + """
SELECT CAST(date_trunc('month', date) AS DATE) AS snapshot_date, count(*) AS n FROM tx
WHERE CAST(date_trunc('month', date) AS DATE) BETWEEN DATE '1999-01-01' AND DATE '2000-12-01' GROUP BY 1"""

SQL["profile_decode"] = SQL["online_profiles"].rsplit("SELECT card_number AS key", 1)[0] + """
SELECT card_number, coalesce(client_id, '') AS client_id, coalesce(card_id, '') AS card_id,
       coalesce(card_brand, '') AS card_brand, coalesce(CAST(credit_limit AS VARCHAR), '') AS credit_limit,
       coalesce(strftime(acct_open_date, '%Y-%m-%d'), '') AS acct_open_date
FROM last"""

SQL["imputation_values"] = with_(*GOLD_LABELS_CTES, """x AS (SELECT CAST(CAST(date AS TIMESTAMP) AS DATE) AS day,
    trim(lower(merchant_state)) AS merchant_state, trim(lower(errors)) AS errors, use_chip FROM raw_tx
    WHERE CAST(CAST(date AS TIMESTAMP) AS DATE) < DATE '2024-01-21')""", "g AS (SELECT * FROM gwl WHERE date < DATE '2024-01-21')") + "\nUNION ALL ".join(
    [f"SELECT '{c}' AS column_name, (SELECT mode() WITHIN GROUP (ORDER BY {c}) FROM x) AS mode, CAST(NULL AS DOUBLE) AS mean"
     for c in ["merchant_state", "errors", "use_chip"]]
    + [f"SELECT '{c}', CAST(NULL AS VARCHAR), round((SELECT avg(CAST({c} AS DOUBLE)) FROM g), 6)" for c in STANDARDISE_COLUMNS])

# ------------------------------------------------- scoring and the job list
SQL["scoring_features"] = with_(RAW_TX, SILVER_TX, RAW_CARDS, SILVER_CARDS, RAW_USERS,
    "silver_users AS (" + SQL["silver_users"][SQL["silver_users"].index("SELECT id, lower(gender)"):] + ")",
    """prof AS (SELECT c.*, u.num_credit_cards, u.per_capita_income, u.credit_score, u.yearly_income, row_number() OVER (PARTITION BY card_number
      ORDER BY c.id DESC) AS r FROM silver_cards c JOIN silver_users u ON c.client_id = u.id)""",
    "req AS (SELECT *, '4' || lpad(CAST(CAST(id AS BIGINT) * 3 % 20011 AS VARCHAR), 15, '0') AS number FROM silver_tx)") + """
SELECT q.id AS transaction_id, q.number AS card_number, p.card_number IS NULL AS rejected, CAST(q.date AS DATE) AS date, q.amount,
       p.num_credit_cards, p.num_cards_issued, p.credit_limit, p.year_pin_last_changed,
       round(CAST(date_diff('day', p.acct_open_date, CAST(q.date AS DATE)) AS DOUBLE) / 30.0, 1) + CAST(0 AS DOUBLE) AS acct_opened_months,
       CAST(year(q.date) - p.year_pin_last_changed AS INTEGER) AS yrs_since_pin_changed,
       p.per_capita_income, p.credit_score, p.yearly_income, q.use_chip, q.merchant_state, q.mcc, q.errors, p.has_chip, p.card_brand, p.card_type
FROM req q LEFT JOIN prof p ON q.number = p.card_number AND p.r = 1"""

SQL["etl_chain"] = SQL["gold_with_labels"]

SQL["etl_counts"] = """
WITH n AS (SELECT (SELECT count(*) FROM events) AS tx, (SELECT count(*) FROM orders) AS cards, (SELECT count(*) FROM customer) AS users,
  (SELECT count(*) + 1 FROM part) AS mcc, (SELECT count(*) + 1 FROM events WHERE event_id % 9 <> 4) AS labels,
  (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS prof)
SELECT layer || '/' || job AS job, n FROM (""" + " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{job}' AS job, {c} AS n FROM n" for layer, job, c in (
        *((x, y, z) for x in ("bronze", "silver") for y, z in (
            ("transactions", "tx"), ("cards", "cards"), ("users", "users"), ("mcc", "mcc"), ("labels", "labels"))),
        ("gold", "labels", "labels"), ("gold", "features", "tx"), ("online", "profiles", "prof"))) + ")"
