"""SQL (DuckDB dialect) for every registered query.

Each model is one named CTE written from the operator's definition; a query's SQL is the CTEs it needs (found by name) followed by a
final SELECT.  The views ``region nation customer supplier orders lineitem``
are the driver's parquet tables.  The models here, the profiles and the
constraint list are written by hand; the SQL of the charts and of the other
assertions is generated from the same catalogues as the Spark side (they
state data, not logic), so a missing catalogue entry shows only in the tests
that compare the catalogues' sizes.
"""

from __future__ import annotations

import re

from ledgerlake.params import DEFAULT_AS_OF, DEFAULT_LOAD_TS, DEFAULT_SOURCE, EVENT_LOADS, SECOND_LOAD_TS, THIRD_LOAD_TS, sql_date, sql_ts

LOAD = sql_ts(DEFAULT_LOAD_TS)
LOAD2 = sql_ts(SECOND_LOAD_TS)
LOAD3 = sql_ts(THIRD_LOAD_TS)
AS_OF = sql_date(DEFAULT_AS_OF)
SRC = f"'{DEFAULT_SOURCE}'"


def hk(col: str) -> str:
    return f"md5(upper(trim(CAST({col} AS VARCHAR))))"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), "
            f"'[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), lambda w: upper(w[1]) || w[2:]), '')")


def shift(ts: str) -> str:
    return f"CAST(CAST({ts} AS DATE) + INTERVAL 20 YEAR AS DATE)"


def money_total(x: str) -> str:
    return f"CAST(coalesce(sum({x}), 0) AS DECIMAL(38,2))"


def money_avg(x: str) -> str:
    return f"coalesce(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0), 0.0)"


def pct(part: str, whole: str) -> str:
    return (f"CASE WHEN ({whole}) = 0 THEN NULL ELSE "
            f"CAST((CAST({part} AS BIGINT) * 20000 + CAST({whole} AS BIGINT)) // (CAST({whole} AS BIGINT) * 2) AS DOUBLE) / 100.0 END")


TIER = ("CASE WHEN credit_score IS NULL THEN NULL WHEN credit_score >= 800 THEN 'super_prime' "
        "WHEN credit_score >= 740 THEN 'prime' WHEN credit_score >= 670 THEN 'near_prime' "
        "WHEN credit_score >= 580 THEN 'subprime' ELSE 'deep_subprime' END")
TIER_ORDER = ("CASE credit_tier WHEN 'deep_subprime' THEN 1 WHEN 'subprime' THEN 2 "
              "WHEN 'near_prime' THEN 3 WHEN 'prime' THEN 4 WHEN 'super_prime' THEN 5 ELSE 99 END")


def datekey(d: str) -> str:
    return f"CAST(strftime(CAST({d} AS DATE), '%Y%m%d') AS INTEGER)"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


# ---------------------------------------------------------------------------
# sources (driver tables -> banking tables)
# ---------------------------------------------------------------------------

def _accounts_sql(where: str = "", bump: str = "") -> str:
    return f"""
    SELECT 'A' || CAST(o_orderkey AS VARCHAR) AS account_id,
           'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'Business' WHEN 'O' THEN 'Checking' WHEN 'P' THEN 'Savings' END AS account_type,
           CAST(CASE WHEN o_orderkey % 211 = 0 THEN -CAST(o_totalprice AS DECIMAL(14,2))
                     ELSE CAST(o_totalprice AS DECIMAL(14,2)) END {bump} AS DECIMAL(14,2)) AS balance_usd,
           {shift('o_orderdate')} AS open_date
    FROM orders {where}"""


CTES: dict[str, str] = {
    "customers": f"""
    SELECT 'C' || CAST(c.c_custkey AS VARCHAR) AS customer_id,
           split_part(c.c_name, '#', 1) AS first_name,
           split_part(c.c_name, '#', 2) AS last_name,
           CASE WHEN c.c_custkey % 97 = 0 THEN lower(replace(c.c_name, '#', '.')) || 'example.com'
                ELSE lower(replace(c.c_name, '#', '.')) || '@example.com' END AS email,
           n.n_name AS city,
           CAST(CASE WHEN c.c_custkey % 53 = 0 THEN NULL WHEN c.c_custkey % 101 = 0 THEN 900
                     ELSE 300 + (c.c_custkey * 37) % 551 END AS INTEGER) AS credit_score,
           CAST(DATE '2015-01-01' + CAST((c.c_custkey * 13) % 3000 AS INTEGER) AS TIMESTAMP) AS created_at
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "accounts": _accounts_sql(),
    "accounts_b1": _accounts_sql("WHERE o_orderkey % 7 <> 0"),
    "accounts_b2": _accounts_sql("", "+ CASE WHEN o_orderkey % 10 = 0 THEN 100 ELSE 0 END"),
    "cards": f"""
    SELECT 'D' || CAST(o_orderkey AS VARCHAR) AS card_id,
           'A' || CAST(o_orderkey AS VARCHAR) AS account_id,
           CASE WHEN o_orderkey % 199 = 0 THEN 'Prepaid' WHEN o_orderkey % 3 = 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
           {shift('o_orderdate')} + CAST(365 * (1 + o_orderkey % 5) AS INTEGER) AS expiration_date
    FROM orders WHERE o_orderkey % 2 = 0""",
    "loans": f"""
    SELECT 'L' || CAST(o_orderkey AS VARCHAR) AS loan_id,
           'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(o_totalprice AS DECIMAL(14,2)) AS loan_amount,
           CAST(CAST(o_orderkey % 1200 AS DECIMAL(10,0)) / 100 AS DECIMAL(5,2)) AS interest_rate,
           {shift('o_orderdate')} AS start_date
    FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "merchants": """
    SELECT 'M' || CAST(s.s_suppkey AS VARCHAR) AS merchant_id,
           CASE WHEN s.s_suppkey % 50 = 7 THEN '' ELSE s.s_name END AS merchant_name,
           n.n_name AS city
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "branches": """
    SELECT 'B' || CAST(n.n_nationkey AS VARCHAR) AS branch_id, n.n_name AS branch_name,
           'manager ' || CAST(n.n_nationkey AS VARCHAR) AS manager_name, n.n_name AS city,
           r.r_name AS country
    FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "transactions": f"""
    SELECT concat_ws('-', 'T' || CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                     CAST(CAST(l_shipdate AS DATE) AS VARCHAR),
                     CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)) AS transaction_id,
           'A' || CAST(l_orderkey AS VARCHAR) AS account_id,
           'M' || CAST(l_suppkey AS VARCHAR) AS merchant_id,
           CAST(l_extendedprice AS DECIMAL(14,2)) AS amount_usd,
           CAST({shift('l_shipdate')} AS TIMESTAMP) AS transaction_date
    FROM lineitem""",
}

SOURCE_OF = {"customer": "customers", "account": "accounts", "card": "cards", "merchant": "merchants",
             "branch": "branches", "loan": "loans", "transaction": "transactions"}
KEY_OF = {e: f"{e}_id" for e in SOURCE_OF}

for _t in ["customers", "accounts", "cards", "merchants", "branches", "loans", "transactions",
           "accounts_b1", "accounts_b2"]:
    _ts = LOAD2 if _t == "accounts_b2" else LOAD
    CTES[f"bronze_{_t}"] = f"SELECT *, {_ts} AS _loaded_at, {SRC} AS _source FROM {_t}"


# ---------------------------------------------------------------------------
# silver: hubs, links, satellites, quarantine
# ---------------------------------------------------------------------------

def _hub_sql(entity: str, bronze: str, load: str = LOAD) -> str:
    key = KEY_OF[entity]
    return f"""
    SELECT {hk(key)} AS hk_{entity}, min({key}) AS {key}, {load} AS load_dts, min(_source) AS rec_src
    FROM {bronze} GROUP BY 1"""


for _e, _s in SOURCE_OF.items():
    CTES[f"hub_{_e}"] = _hub_sql(_e, f"bronze_{_s}")

LINK_SPECS = {"customer_account": ("customer", "account", "accounts"),
              "account_card": ("account", "card", "cards"),
              "customer_loan": ("customer", "loan", "loans"),
              "account_transaction": ("account", "transaction", "transactions"),
              "merchant_transaction": ("merchant", "transaction", "transactions")}


def _link_sql(a: str, b: str, bronze: str, load: str = LOAD) -> str:
    name = f"hk_link_{a}_{b}"
    return f"""
    SELECT {name}, hk_{a}, hk_{b}, {load} AS load_dts, rec_src FROM (
      SELECT md5(concat(hk_{a}, hk_{b})) AS {name}, hk_{a}, hk_{b}, rec_src FROM (
        SELECT {hk(KEY_OF[a])} AS hk_{a}, {hk(KEY_OF[b])} AS hk_{b}, _source AS rec_src FROM {bronze}))
    QUALIFY row_number() OVER (PARTITION BY {name} ORDER BY hk_{a} NULLS FIRST, hk_{b} NULLS FIRST,
                                rec_src NULLS FIRST) = 1"""


for _n, (_a, _b, _s) in LINK_SPECS.items():
    CTES[f"link_{_n}"] = _link_sql(_a, _b, f"bronze_{_s}")

# cleaned attribute expressions, hash_diff order, validity (now = load time)
SAT_SPECS = {
    "customer": ([("first_name", initcap("trim(first_name)")), ("last_name", initcap("trim(last_name)")),
                  ("email", "lower(trim(email))"), ("city", initcap("trim(city)")),
                  ("credit_score", "credit_score"), ("created_at", "created_at")],
                 "(email IS NULL OR regexp_matches(email, '^[^@]+@[^@]+\\.[^@]+$')) "
                 "AND (credit_score IS NULL OR credit_score BETWEEN 300 AND 850) "
                 "AND (created_at IS NULL OR created_at <= {now})"),
    "account": ([("account_type", "trim(account_type)"), ("balance_usd", "balance_usd"),
                 ("open_date", "open_date")],
                "(balance_usd IS NULL OR balance_usd >= 0) AND "
                "(account_type IS NULL OR account_type IN ('Business', 'Checking', 'Savings'))"),
    "card": ([("card_type", "trim(card_type)"), ("expiration_date", "expiration_date")],
             "(card_type IS NULL OR card_type IN ('Credit', 'Debit'))"),
    "merchant": ([("merchant_name", "trim(merchant_name)"), ("city", initcap("trim(city)"))],
                 "(merchant_name IS NOT NULL AND merchant_name <> '')"),
    "branch": ([("branch_name", initcap("trim(branch_name)")), ("manager_name", initcap("trim(manager_name)")),
                ("city", initcap("trim(city)")), ("country", "trim(country)")],
               "(branch_name IS NOT NULL AND branch_name <> '')"),
    "loan": ([("loan_amount", "loan_amount"), ("interest_rate", "interest_rate"), ("start_date", "start_date")],
             "(loan_amount IS NULL OR loan_amount > 0) AND (interest_rate IS NULL OR interest_rate BETWEEN 0 AND 100)"),
    "transaction": ([("amount_usd", "amount_usd"), ("transaction_date", "transaction_date")],
                    "(amount_usd IS NULL OR amount_usd > 0) AND (transaction_date IS NULL OR transaction_date <= {now})"),
}


def sat_cols(entity: str) -> str:
    attrs = [a for a, _ in SAT_SPECS[entity][0]]
    return ", ".join([f"hk_{entity}", *attrs, "hash_diff", "_is_valid", "load_dts", "rec_src"])


def _staged_sat_sql(entity: str, bronze: str, load: str = LOAD) -> str:
    attrs, valid = SAT_SPECS[entity]
    key = KEY_OF[entity]
    names = [a for a, _ in attrs]
    cleaned = ", ".join(f"{expr} AS {a}" for a, expr in attrs)
    order = ", ".join(f"{n} NULLS FIRST" for n in names)
    return f"""
    SELECT {hk(key)} AS hk_{entity}, {', '.join(names)},
           md5(concat({', '.join(names)})) AS hash_diff,
           ({valid.format(now=load)}) AS _is_valid,
           {load} AS load_dts, _source AS rec_src
    FROM (SELECT {key}, {cleaned}, _source FROM {bronze})
    QUALIFY row_number() OVER (PARTITION BY {hk(key)}, md5(concat({', '.join(names)})) ORDER BY {order}) = 1"""


for _e, _s in SOURCE_OF.items():
    CTES[f"sat_{_e}"] = _staged_sat_sql(_e, f"bronze_{_s}")

# fixed values: the reason texts
QUARANTINE_REASON = {
    "customer": "failed customer validation: email format, credit_score range (300-850), or created_at in the future",
    "account": "failed account validation: balance_usd negative or account_type not recognized",
    "card": "failed card validation: card_type not recognized",
    "merchant": "failed merchant validation: merchant_name is null or empty",
    "branch": "failed branch validation: branch_name is null or empty",
    "loan": "failed loan validation: loan_amount not positive or interest_rate outside 0-100",
    "transaction": "failed transaction validation: amount_usd not positive or transaction_date in the future",
}

CTES["quarantine"] = "\n    UNION ALL\n".join(
    f"""    SELECT '{e}' AS source_table, {KEY_OF[e]} AS source_business_key, hk_{e} AS hash_key,
           '{reason}' AS rejection_reason, bad.load_dts
    FROM hub_{e} INNER JOIN (SELECT hk_{e}, load_dts FROM sat_{e} WHERE NOT _is_valid) AS bad USING (hk_{e})"""
    for e, reason in QUARANTINE_REASON.items())

# incremental: two batches of accounts
CTES["hub_account_b1"] = _hub_sql("account", "bronze_accounts_b1")
CTES["hub_account_b2"] = _hub_sql("account", "bronze_accounts_b2", LOAD2)
CTES["hub_account_incremental"] = """
    SELECT * FROM hub_account_b1
    UNION ALL
    SELECT * FROM hub_account_b2 n WHERE NOT EXISTS (SELECT 1 FROM hub_account_b1 e WHERE e.hk_account = n.hk_account)"""
CTES["link_customer_account_b1"] = _link_sql("customer", "account", "bronze_accounts_b1")
CTES["link_customer_account_b2"] = _link_sql("customer", "account", "bronze_accounts_b2", LOAD2)
CTES["link_customer_account_incremental"] = """
    SELECT * FROM link_customer_account_b1
    UNION ALL
    SELECT * FROM link_customer_account_b2 n WHERE NOT EXISTS (
      SELECT 1 FROM link_customer_account_b1 e WHERE e.hk_link_customer_account = n.hk_link_customer_account)"""
CTES["sat_account_b1"] = _staged_sat_sql("account", "bronze_accounts_b1")
CTES["sat_account_b2"] = _staged_sat_sql("account", "bronze_accounts_b2", LOAD2)
CTES["sat_account_incremental"] = f"""
    SELECT {sat_cols('account')} FROM sat_account_b1
    UNION ALL
    SELECT {', '.join('d.' + c.strip() for c in sat_cols('account').split(','))}
    FROM sat_account_b2 d
    LEFT JOIN (SELECT hk_account, hash_diff AS existing_hash_diff FROM sat_account_b1
               QUALIFY row_number() OVER (PARTITION BY hk_account ORDER BY load_dts DESC, hash_diff DESC) = 1) le
      ON d.hk_account = le.hk_account
    WHERE le.existing_hash_diff IS NULL OR le.existing_hash_diff <> d.hash_diff"""


# a third batch with batch one's accounts again: A -> B -> A stores three versions
CTES["sat_account_b3"] = _staged_sat_sql("account", "bronze_accounts_b1", LOAD3)
CTES["sat_account_three_batches"] = f"""
    SELECT {sat_cols('account')} FROM sat_account_incremental
    UNION ALL
    SELECT {sat_cols('account')} FROM sat_account_b3 AS third
    WHERE hash_diff IS DISTINCT FROM (
        SELECT arg_max(stored.hash_diff, (stored.load_dts, stored.hash_diff)) FROM sat_account_incremental AS stored
        WHERE stored.hk_account = third.hk_account)"""

# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------

def _scd2_tail() -> str:
    return ("load_dts AS effective_start_date, "
            "coalesce(next_load_dts, TIMESTAMP '9999-12-31 00:00:00') AS effective_end_date, "
            "next_load_dts IS NULL AS is_current, rec_src AS record_source")


CTES["dim_customer"] = f"""
    SELECT md5(concat(hk_customer, CAST(load_dts AS VARCHAR))) AS customer_key,
           hk_customer AS customer_hub_key, customer_id, first_name, last_name, email, city, credit_score,
           {TIER} AS credit_tier, CAST(created_at AS DATE) AS created_date,
           {month('created_at')} AS acquisition_month, {_scd2_tail()}
    FROM (SELECT s.*, h.customer_id,
                 lead(s.load_dts) OVER (PARTITION BY s.hk_customer ORDER BY s.load_dts, s.hash_diff) AS next_load_dts
          FROM sat_customer s JOIN hub_customer h ON h.hk_customer = s.hk_customer)"""


def _dim_account_sql(sat: str, hub: str, link: str) -> str:
    return f"""
    SELECT md5(concat(hk_account, CAST(load_dts AS VARCHAR))) AS account_key,
           hk_account AS account_hub_key, account_id, hk_customer AS customer_hub_key,
           account_type, open_date, {_scd2_tail()}
    FROM (SELECT s.*, h.account_id, l.hk_customer,
                 lead(s.load_dts) OVER (PARTITION BY s.hk_account
                                        ORDER BY s.load_dts, s.hash_diff, l.hk_customer NULLS LAST) AS next_load_dts
          FROM {sat} s JOIN {hub} h ON h.hk_account = s.hk_account
          JOIN {link} l ON l.hk_account = s.hk_account)"""


CTES["dim_account"] = _dim_account_sql("sat_account", "hub_account", "link_customer_account")
CTES["dim_account_history"] = _dim_account_sql("sat_account_incremental", "hub_account_incremental",
                                               "link_customer_account_incremental")
CTES["dim_account_upkeep"] = _dim_account_sql("sat_account_three_batches", "hub_account_incremental",
                                              "link_customer_account_incremental")
# the same two batches loaded while the transactions happened (2017 and 2019)
_L1, _L2 = (sql_ts(t) for t in EVENT_LOADS)
CTES["event_sat"] = f"""
    SELECT * REPLACE (CASE load_dts WHEN {LOAD} THEN {_L1} ELSE {_L2} END AS load_dts) FROM sat_account_incremental"""
CTES["event_dim_account"] = _dim_account_sql("event_sat", "hub_account_incremental", "link_customer_account_incremental")
CTES["dim_card"] = f"""
    SELECT md5(concat(hk_card, CAST(load_dts AS VARCHAR))) AS card_key,
           hk_card AS card_hub_key, card_id, hk_account AS account_hub_key, card_type, expiration_date,
           {_scd2_tail()}
    FROM (SELECT s.*, h.card_id, l.hk_account,
                 lead(s.load_dts) OVER (PARTITION BY s.hk_card
                                        ORDER BY s.load_dts, s.hash_diff, l.hk_account NULLS LAST) AS next_load_dts
          FROM sat_card s JOIN hub_card h ON h.hk_card = s.hk_card
          JOIN link_account_card l ON l.hk_card = s.hk_card)"""
CTES["dim_merchant"] = f"""
    SELECT md5(concat(hk_merchant, CAST(load_dts AS VARCHAR))) AS merchant_key,
           hk_merchant AS merchant_hub_key, merchant_id, merchant_name, city, {_scd2_tail()}
    FROM (SELECT s.*, h.merchant_id,
                 lead(s.load_dts) OVER (PARTITION BY s.hk_merchant ORDER BY s.load_dts, s.hash_diff) AS next_load_dts
          FROM sat_merchant s JOIN hub_merchant h ON h.hk_merchant = s.hk_merchant)"""
CTES["dim_branch"] = f"""
    SELECT md5(concat(hk_branch, CAST(load_dts AS VARCHAR))) AS branch_key,
           hk_branch AS branch_hub_key, branch_id, branch_name, city, country, manager_name, {_scd2_tail()}
    FROM (SELECT s.*, h.branch_id,
                 lead(s.load_dts) OVER (PARTITION BY s.hk_branch ORDER BY s.load_dts, s.hash_diff) AS next_load_dts
          FROM sat_branch s JOIN hub_branch h ON h.hk_branch = s.hk_branch)"""
CTES["dim_date"] = """
    SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day,
           CAST(extract(year FROM date_day) AS INTEGER) AS year,
           CAST(extract(quarter FROM date_day) AS INTEGER) AS quarter,
           CAST(extract(month FROM date_day) AS INTEGER) AS month,
           strftime(date_day, '%B') AS month_name,
           CAST(extract(day FROM date_day) AS INTEGER) AS day_of_month,
           CAST(isodow(date_day) AS INTEGER) AS day_of_week,
           strftime(date_day, '%A') AS day_name,
           isodow(date_day) IN (6, 7) AS is_weekend,
           CAST(week(date_day) AS INTEGER) AS week_of_year,
           CAST(dayofyear(date_day) AS INTEGER) AS day_of_year,
           date_day = last_day(date_day) AS is_month_end
    FROM (SELECT CAST(d AS DATE) AS date_day
          FROM generate_series(DATE '2015-01-01', DATE '2030-01-01', INTERVAL 1 DAY) t(d))"""
CTES["transaction_parties"] = """
    SELECT hk_transaction, hk_account, hk_merchant
    FROM link_account_transaction INNER JOIN link_merchant_transaction USING (hk_transaction)"""
CTES["fact_transactions"] = f"""
    SELECT hk_transaction AS transaction_hub_key, hk_account AS account_hub_key, hk_merchant AS merchant_hub_key,
           hk_customer AS customer_hub_key, {datekey('version.transaction_date')} AS date_key,
           version.transaction_date, version.amount_usd, version.rec_src AS record_source,
           version.load_dts AS load_date
    FROM (SELECT hk_account, hk_customer FROM link_customer_account) AS holder
    INNER JOIN transaction_parties USING (hk_account)
    INNER JOIN sat_transaction AS version USING (hk_transaction)"""
CTES["fact_loans"] = f"""
    SELECT s.hk_loan AS loan_hub_key, l.hk_customer AS customer_hub_key, {datekey('s.start_date')} AS date_key,
           s.start_date, s.loan_amount, s.interest_rate, s.rec_src AS record_source, s.load_dts AS load_date
    FROM sat_loan s JOIN link_customer_loan l ON l.hk_loan = s.hk_loan"""
CTES["fact_account_balance"] = f"""
    SELECT s.hk_account AS account_hub_key, l.hk_customer AS customer_hub_key,
           {datekey('s.load_dts')} AS date_key, CAST(s.load_dts AS DATE) AS snapshot_date, s.open_date,
           s.balance_usd, s.rec_src AS record_source, s.load_dts AS load_date
    FROM (SELECT * FROM sat_account
          QUALIFY row_number() OVER (PARTITION BY hk_account ORDER BY load_dts DESC, hash_diff DESC) = 1) s
    JOIN link_customer_account l ON l.hk_account = s.hk_account"""

# ---------------------------------------------------------------------------
# reporting
# ---------------------------------------------------------------------------

CTES["cur_customers"] = "SELECT * FROM dim_customer WHERE is_current"
CTES["cur_accounts"] = "SELECT * FROM dim_account WHERE is_current"
CTES["cur_cards"] = "SELECT * FROM dim_card WHERE is_current"
CTES["cur_merchants"] = "SELECT * FROM dim_merchant WHERE is_current"
CTES["customer_balances"] = """
    SELECT customer_hub_key, sum(balance_usd) AS total_balance_usd, count(*) AS account_count
    FROM fact_account_balance GROUP BY 1"""

CTES["holdings"] = """
    SELECT customer_hub_key, total_balance_usd, account_count
    FROM customer_balances SEMI JOIN cur_customers USING (customer_hub_key)"""
CTES["customer_kpis"] = f"""
    SELECT n AS total_customers, CAST(accounts AS BIGINT) AS total_accounts, deposits AS total_deposits_usd,
           several AS customers_with_multiple_accounts,
           coalesce({pct('several', 'n')}, 0.0) AS pct_customers_with_multiple_accounts,
           (SELECT {money_total('loan_amount')} FROM fact_loans) AS total_loan_book_usd,
           (SELECT {money_total('amount_usd')} FROM fact_transactions) AS total_transaction_volume_usd,
           {AS_OF} AS snapshot_date
    FROM (SELECT (SELECT count(*) FROM cur_customers) AS n, coalesce(sum(account_count), 0) AS accounts,
                 {money_total('total_balance_usd')} AS deposits,
                 count(*) FILTER (WHERE account_count >= 2) AS several FROM holdings)"""
CTES["monthly_customer_growth"] = """
    SELECT acquisition_month, count(*) AS new_customers FROM cur_customers GROUP BY 1"""
CTES["yearly_account_openings_by_type"] = """
    SELECT CAST(date_trunc('year', open_date) AS DATE) AS open_year, account_type, count(*) AS new_accounts
    FROM cur_accounts GROUP BY 1, 2"""
CTES["account_type_deposits"] = f"""
    SELECT ca.account_type, count(*) AS account_count, {money_total('fab.balance_usd')} AS total_balance_usd,
           {money_avg('fab.balance_usd')} AS avg_balance_usd
    FROM fact_account_balance fab JOIN cur_accounts ca ON ca.account_hub_key = fab.account_hub_key
    GROUP BY 1"""
CTES["account_opening_cohort_trend"] = f"""
    SELECT {month('ca.open_date')} AS open_month, ca.account_type, count(*) AS account_count,
           {money_total('fab.balance_usd')} AS total_balance_usd, {money_avg('fab.balance_usd')} AS avg_balance_usd
    FROM fact_account_balance fab JOIN cur_accounts ca ON ca.account_hub_key = fab.account_hub_key
    GROUP BY 1, 2"""
CTES["customer_balance_summary"] = """
    SELECT *, row_number() OVER (ORDER BY total_balance_usd DESC, customer_id) AS balance_rank
    FROM (SELECT customer_hub_key, customer_id, first_name, last_name, city, credit_tier,
                 count(account_hub_key) AS account_count,
                 CAST(coalesce(sum(balance_usd), 0) AS DECIMAL(38,2)) AS total_balance_usd
          FROM (SELECT * FROM dim_customer WHERE is_current)
          LEFT JOIN (SELECT customer_hub_key, account_hub_key, balance_usd FROM fact_account_balance)
            USING (customer_hub_key)
          GROUP BY ALL)"""
CTES["customer_balance_kpis"] = f"""
    SELECT count(*) AS customers_with_balance_rows, {money_avg('total_balance_usd')} AS avg_balance_usd,
           coalesce(percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(total_balance_usd AS DOUBLE)), 0.0)
             AS median_balance_usd,
           {money_total('total_balance_usd')} AS total_balance_usd, {AS_OF} AS snapshot_date
    FROM (SELECT customer_hub_key, sum(balance_usd) AS total_balance_usd FROM fact_account_balance GROUP BY 1)"""
CTES["loan_monthly_trend"] = f"""
    SELECT {month('start_date')} AS origination_month, count(*) AS loan_count,
           {money_total('loan_amount')} AS total_loan_amount_usd, {money_avg('interest_rate')} AS avg_interest_rate
    FROM fact_loans GROUP BY 1"""
CTES["interest_rate_by_credit_tier"] = f"""
    SELECT cc.credit_tier, {TIER_ORDER.replace('credit_tier', 'cc.credit_tier')} AS credit_tier_sort_order,
           count(*) AS loan_count, {money_total('fl.loan_amount')} AS total_loan_amount_usd,
           {money_avg('fl.interest_rate')} AS avg_interest_rate
    FROM fact_loans fl JOIN cur_customers cc ON cc.customer_hub_key = fl.customer_hub_key
    GROUP BY 1, 2"""
CTES["loan_penetration_by_credit_tier"] = f"""
    SELECT *, {pct('customers_with_loans', 'total_customers')} AS loan_penetration_pct
    FROM (SELECT credit_tier, {TIER_ORDER} AS credit_tier_sort_order, count(*) AS total_customers,
                 count(*) FILTER (WHERE customer_hub_key IN (
                     SELECT customer_hub_key FROM fact_loans WHERE customer_hub_key IS NOT NULL)) AS customers_with_loans
          FROM dim_customer WHERE is_current GROUP BY ALL)"""
CTES["customer_credit_mix_monthly"] = f"""
    SELECT acquisition_month, credit_tier, {TIER_ORDER} AS credit_tier_sort_order, customer_count,
           {pct('customer_count', 'sum(customer_count) OVER (PARTITION BY acquisition_month)')} AS pct_of_month_total
    FROM (SELECT acquisition_month, credit_tier, count(*) AS customer_count FROM cur_customers GROUP BY 1, 2)"""
CTES["card_portfolio_summary"] = """
    SELECT ca.account_type, cc.card_type, count(*) AS card_count
    FROM cur_cards cc JOIN cur_accounts ca ON ca.account_hub_key = cc.account_hub_key GROUP BY 1, 2"""
CTES["dim_card_enriched"] = f"""
    SELECT card_hub_key, card_id, account_hub_key, account_id, account_type, customer_hub_key, customer_id,
           credit_tier, owner.city AS customer_city, card_type, expiration_date, days_to_expiration,
           {', '.join(f'coalesce(days_to_expiration <= {d}, false) AS expires_within_{d}_days' for d in (30, 60, 90))},
           {AS_OF} AS snapshot_date
    FROM (SELECT *, CAST(date_diff('day', {AS_OF}, expiration_date) AS INTEGER) AS days_to_expiration
          FROM dim_card WHERE is_current)
    INNER JOIN (SELECT account_hub_key, account_id, account_type, customer_hub_key FROM dim_account WHERE is_current)
      USING (account_hub_key)
    LEFT JOIN (SELECT customer_hub_key, customer_id, credit_tier, city FROM dim_customer WHERE is_current) AS owner
      USING (customer_hub_key)"""
CTES["card_expiry_buckets"] = f"""
    SELECT days AS bucket_days, format('<= {{}} days', days) AS bucket_label,
           (SELECT count(card_id) FROM dim_card
            WHERE is_current AND date_diff('day', {AS_OF}, expiration_date) <= days) AS cards_expiring_count,
           {AS_OF} AS snapshot_date
    FROM (SELECT unnest([30, 60, 90]) AS days)"""
CTES["transaction_monthly_summary"] = f"""
    SELECT {month('transaction_date')} AS transaction_month, count(*) AS transaction_count,
           {money_total('amount_usd')} AS total_transaction_volume_usd,
           {money_avg('amount_usd')} AS avg_transaction_amount_usd
    FROM fact_transactions GROUP BY 1"""
CTES["top_merchants"] = f"""
    SELECT merchant_hub_key, merchant_id, merchant_name, city, transaction_count, total_transaction_volume_usd,
           row_number() OVER (ORDER BY total_transaction_volume_usd DESC, merchant_id) AS volume_rank
    FROM (SELECT merchant_hub_key, count(*) AS transaction_count,
                 {money_total('amount_usd')} AS total_transaction_volume_usd
          FROM fact_transactions GROUP BY merchant_hub_key)
    INNER JOIN (SELECT merchant_hub_key, merchant_id, merchant_name, city FROM dim_merchant WHERE is_current)
      USING (merchant_hub_key)"""
CTES["avg_transaction_by_account_type"] = f"""
    SELECT ca.account_type, count(*) AS transaction_count,
           {money_total('ft.amount_usd')} AS total_transaction_volume_usd,
           {money_avg('ft.amount_usd')} AS avg_transaction_amount_usd
    FROM fact_transactions ft JOIN cur_accounts ca ON ca.account_hub_key = ft.account_hub_key GROUP BY 1"""
CTES["signups_by_month"] = f"""
    SELECT {month('created_date')} AS signup_month, count(*) AS customer_count FROM dim_customer GROUP BY 1"""


# ---------------------------------------------------------------------------
# assembly
# ---------------------------------------------------------------------------

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(sql: str) -> list[str]:
    seen = []
    for w in _WORD.findall(sql):
        if w in CTES and w not in seen:
            seen.append(w)
    return seen


def build(final_select: str) -> str:
    """``WITH`` clause of every CTE the SELECT needs (transitively, in
    dependency order) followed by the SELECT."""
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        if name in stack:
            raise ValueError(f"cycle at {name}")
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, stack + (name,))
        order.append(name)

    for d in _deps(final_select):
        visit(d)
    if not order:
        return final_select
    body = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    return f"WITH {body}\n{final_select}"


def table(name: str) -> str:
    return build(f"SELECT * FROM {name}")
