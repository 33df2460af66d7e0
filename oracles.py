"""DuckDB SQL for every registered query, over the same tables.

``CTES`` are named building blocks; ``_sql`` puts those a query uses in front of it.
"""

from __future__ import annotations

import re

from catalog import (AS_OF, CALENDAR, GIVEN_CUSTOMER, REPORT_DAY, WIDE_CUSTOMER, _day_suite, transaction_suite,
                     transaction_suite_rows)
from fixtures import ADAPTERS, duck
from tidemark.quality import suites
from tidemark.quality.rules import Rule

CTES: dict[str, str] = {name: duck(name) for name in ADAPTERS}

MONEY = "decimal(18,2)"


def _key(*columns: str) -> str:
    """Surrogate key text."""
    parts = [f"coalesce(cast({c} as varchar), '_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


CTES["stg_t"] = f"""
select transaction_id, account_id, customer_id, upper(trim(transaction_type)) as transaction_type,
  upper(trim(currency)) as currency, upper(trim(merchant_category)) as merchant_category,
  cast(amount as {MONEY}) as amount, cast(balance_before as {MONEY}) as balance_before,
  cast(balance_after as {MONEY}) as balance_after,
  cast(dest_balance_before as {MONEY}) as dest_balance_before,
  cast(dest_balance_after as {MONEY}) as dest_balance_after, orig_account_id, dest_account_id,
  is_fraud = 1 as is_fraud, is_flagged_fraud = 1 as is_flagged_fraud,
  is_fraud = 1 and is_flagged_fraud = 0 as is_missed_fraud,
  transaction_date, created_at, _loaded_at, _batch_id
from txn where amount > 0 and transaction_id is not null"""
CTES["stg_c"] = """
select customer_id, trim(full_name) as full_name, lower(trim(email)) as email,
  trim(phone) as phone, trim(address) as address, upper(trim(segment)) as segment,
  upper(trim(kyc_status)) as kyc_status, created_at, updated_at
from cust_v where customer_id is not null"""
CTES["stg_a"] = f"""
select account_id, customer_id, upper(trim(account_type)) as account_type,
  cast(balance as {MONEY}) as balance, opened_date, upper(trim(status)) as account_status,
  product_id
from acct where account_id is not null"""
CTES["dim_c"] = f"""
select {_key('customer_id', 'updated_at')} as customer_key, customer_id as customer_natural_key,
  full_name, email, phone, address, segment, kyc_status, created_at, updated_at as valid_from,
  coalesce(successor, timestamp '9999-12-31 00:00:00') as valid_to,
  successor is null as is_current
from (select *, lead(updated_at) over (partition by customer_id order by updated_at) as successor
      from stg_c)"""
CTES["dim_a"] = f"""
select {_key('account_id')} as account_key, account_id as account_natural_key, customer_id,
  account_type, balance, opened_date, account_status, product_id,
  case when balance >= 50000 then 'HIGH' when balance >= 5000 then 'MEDIUM'
       when balance >= 0 then 'LOW' else 'NEGATIVE' end as balance_tier,
  cast(floor((date '{AS_OF}' - opened_date) / 365.0) as bigint) as account_age_years
from stg_a"""


def _products(source: str) -> str:
    return f"""
select {_key('product_id')} as product_key, product_id as product_natural_key,
  case when n between 1 and 5 then 'BASIC' when n between 6 and 10 then 'PREMIUM'
       when n between 11 and 15 then 'CORPORATE' else 'SPECIALIZED' end as product_tier,
  case when n between 1 and 5 then 'Entry-level banking product'
       when n between 6 and 10 then 'Premium banking product with benefits'
       when n between 11 and 15 then 'Corporate treasury product'
       else 'Specialized financial instrument' end as product_description,
  cast(case when n between 1 and 5 then 0.00 when n between 6 and 10 then 9.99
       when n between 11 and 15 then 49.99 else 99.99 end as double) as monthly_fee
from (select distinct product_id, cast(replace(product_id, 'PROD', '') as int) as n
      from {source} where product_id is not null)"""


CTES["dim_p"] = _products("stg_a")
CTES["fact"] = """
select t.transaction_id, c.customer_key, a.account_key, p.product_key, t.amount,
  t.balance_before, t.balance_after, t.balance_after - t.balance_before as balance_delta,
  t.transaction_type, t.currency, t.merchant_category, t.orig_account_id, t.dest_account_id,
  t.is_fraud, t.is_flagged_fraud, t.is_missed_fraud,
  case when t.amount < 1000 then 'MICRO' when t.amount < 10000 then 'SMALL'
       when t.amount < 100000 then 'MEDIUM' when t.amount < 1000000 then 'LARGE'
       else 'XLARGE' end as amount_bucket,
  t.transaction_type in ('CASH_OUT', 'TRANSFER') and t.amount > 200000 as is_high_risk_pattern,
  t.transaction_date, t.created_at, c.segment as customer_segment, a.account_type, t._batch_id
from stg_t t
left join (select * from dim_c where is_current) c on c.customer_natural_key = t.customer_id
left join dim_a a on a.account_natural_key = t.account_id
left join dim_p p on p.product_natural_key = a.product_id"""
CTES["alerts"] = """
select transaction_id, customer_key, account_key, transaction_type, amount, balance_before,
  balance_after, balance_delta, orig_account_id, dest_account_id, is_fraud, is_flagged_fraud,
  is_missed_fraud,
  case when is_fraud and is_flagged_fraud then 'TRUE_POSITIVE'
       when is_flagged_fraud then 'FALSE_POSITIVE' when is_fraud then 'FALSE_NEGATIVE'
       else 'TRUE_NEGATIVE' end as detection_outcome,
  amount_bucket, is_high_risk_pattern, transaction_date, created_at, customer_segment, _batch_id
from fact where is_fraud or is_flagged_fraud"""
CTES["daily"] = """
select transaction_date as date, transaction_type, count(*) as tx_count,
  sum(amount) as total_volume, count(*) filter (where is_fraud) as fraud_count
from fact group by all"""
CTES["card_h"] = f"""
select 'CARD-' || cast(t.id as varchar) as transaction_id, 'CARD' as channel,
  t.client_id as customer_natural_key, cast(t.card_id as varchar) as card_id,
  cast(t.merchant_id as varchar) as merchant_id, cast(t.mcc as bigint) as mcc,
  coalesce(m.mcc_category, 'UNKNOWN') as merchant_category,
  case when t.value < 0 then 'REFUND' else 'PURCHASE' end as transaction_type,
  case t.use_chip when 'Swipe Transaction' then 'SWIPE' when 'Chip Transaction' then 'CHIP'
       when 'Online Transaction' then 'ONLINE' else 'OTHER' end as entry_mode,
  t.value as amount, abs(t.value) as abs_amount, cast(null as {MONEY}) as balance_before,
  cast(null as {MONEY}) as balance_after, l.fraud_label = 'Yes' as is_fraud,
  cast(null as boolean) as is_flagged_fraud, l.transaction_id is not null as is_fraud_labeled,
  t.date as txn_timestamp, cast(t.date as date) as txn_date, t._batch_id
from (select *, cast(replace(amount, '$', '') as {MONEY}) as value from card) t
left join labels l on l.transaction_id = t.id left join mcc m on m.mcc = t.mcc"""
_CONTENT = ["step", "type", "amount", '"nameOrig"', '"oldbalanceOrg"', '"newbalanceOrig"',
            '"nameDest"', '"oldbalanceDest"', '"newbalanceDest"', '"isFraud"',
            '"isFlaggedFraud"']
_TYPED = ", ".join(
    f"cast({c} as {MONEY}) as {c}" if "balance" in c or c == "amount" else c for c in _CONTENT)
CTES["money_n"] = f"select {_TYPED}, _batch_id from money"
CTES["money_i"] = f"""
select *, content || '-' || cast(row_number() over (partition by content) as varchar) as row_id
from (select *, {_key(*_CONTENT)} as content from money_n)"""
CTES["pool"] = "select id, row_number() over (order by id) as rn from users"


def _bucket(text: str, size: str) -> str:
    return f"cast(concat('0x', substr(md5({text}), 1, 8)) as bigint) % {size} + 1"


CTES["money_h"] = f"""
select 'MM-' || m.row_id as transaction_id, 'MOBILE_MONEY' as channel,
  p.id as customer_natural_key, cast(null as varchar) as card_id,
  cast(null as varchar) as merchant_id, cast(null as bigint) as mcc,
  case when starts_with(m."nameDest", 'M') then 'MERCHANT_PAYMENT' else 'P2P_TRANSFER' end
    as merchant_category,
  m.type as transaction_type, cast(null as varchar) as entry_mode, m.amount,
  abs(m.amount) as abs_amount, m."oldbalanceOrg" as balance_before,
  m."newbalanceOrig" as balance_after, m."isFraud" = 1 as is_fraud,
  m."isFlaggedFraud" = 1 as is_flagged_fraud, true as is_fraud_labeled,
  timestamp '2024-01-01 00:00:00' + m.step * interval '1 hour' as txn_timestamp,
  cast(timestamp '2024-01-01 00:00:00' + m.step * interval '1 hour' as date) as txn_date,
  m._batch_id
from money_i m
left join pool p on p.rn = {_bucket('m."nameOrig"', '(select count(*) from users)')}"""
CTES["merchants"] = """
select md5(cast(g.merchant_id as varchar)) as merchant_key,
  cast(g.merchant_id as varchar) as merchant_natural_key, cast(g.mcc as bigint) as mcc,
  coalesce(m.mcc_category, 'UNKNOWN') as merchant_category, g.merchant_city, g.merchant_state
from (select merchant_id, min(mcc) as mcc, min(merchant_city) as merchant_city,
        min(merchant_state) as merchant_state from card where merchant_id is not null
      group by merchant_id) g
left join mcc m on m.mcc = g.mcc"""
CTES["channels"] = """
select * from (values (1, 'CARD', 'IBM credit-card issuing platform', 'USD'),
  (2, 'MOBILE_MONEY', 'PaySim mobile-money platform', 'LOCAL'))
  v(channel_key, channel, description, currency_basis)"""
CTES["both_h"] = "select * from card_h union all by name select * from money_h"
CTES["unified"] = f"""
select u.transaction_id, h.channel_key, md5(cast(c.id as varchar)) as customer_key,
  md5(cast(k.id as varchar)) as card_key, m.merchant_key,
  case when u.txn_date between date '{CALENDAR[0]}' and date '{CALENDAR[1]}' then u.txn_date end
    as date_key,
  u.channel, u.transaction_type, u.entry_mode, u.merchant_category, u.amount, u.abs_amount,
  u.balance_before, u.balance_after, u.balance_after - u.balance_before as balance_delta,
  u.is_fraud, u.is_flagged_fraud, u.is_fraud_labeled,
  u.abs_amount > 200000 and u.transaction_type in ('CASH_OUT', 'TRANSFER') as is_high_risk,
  u.txn_timestamp, u.txn_date, u._batch_id
from both_h u
left join channels h on h.channel = u.channel
left join users c on c.id = u.customer_natural_key
left join cards k on cast(k.id as varchar) = u.card_id
left join merchants m on m.merchant_natural_key = u.merchant_id"""


def _sql(body: str) -> str:
    """``body`` with the building blocks it uses, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"(?:from|join)\s+([a-z_]+)", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    blocks = [f"{name} as ({text.strip()})" for name, text in CTES.items() if name in needed]
    return ("with " + ",\n".join(blocks) + "\n" if blocks else "") + body.strip()


def _plain(source: str, money: str = "", text: str = "") -> str:
    """All columns of a block, money as double and dates as text."""
    change = [f"cast({c} as double) as {c}" for c in money.split()]
    change += [f"cast({c} as varchar) as {c}" for c in text.split()]
    return _sql(f"select * replace ({', '.join(change)}) from {source}" if change
                else f"select * from {source}")


FACT_MONEY = "amount balance_before balance_after balance_delta"
FACT_TEXT = "transaction_date created_at"
DIM_TEXT = "created_at valid_from valid_to"
HARMONIZED = ("amount abs_amount balance_before balance_after", "txn_timestamp txn_date")

ORACLES: dict[str, str] = {}

ORACLES["stg_transactions"] = _plain(
    "stg_t", "amount balance_before balance_after dest_balance_before dest_balance_after",
    FACT_TEXT)
ORACLES["stg_customers"] = _plain("stg_c", text="created_at updated_at")
ORACLES["stg_accounts"] = _plain("stg_a", "balance", "opened_date")
ORACLES["stg_loans"] = _sql(f"""
select loan_id, customer_id, account_id,
  cast(cast(principal as {MONEY}) as double) as principal,
  cast(cast(interest_rate as decimal(6,4)) as double) as interest_rate, term_months,
  cast(disbursement_date as varchar) as disbursement_date,
  cast(maturity_date as varchar) as maturity_date, upper(trim(status)) as loan_status
from loans where loan_id is not null and principal is not null""")
ORACLES["map_feed"] = _sql(f"""
select row_id as transaction_id,
  'ACC' || cast(999 + {_bucket("'a' || row_id", '3001')} as varchar) as account_id,
  'CUST' || cast(99 + {_bucket("'c' || row_id", '1000')} as varchar) as customer_id,
  type as transaction_type, cast(amount as double) as amount, 'USD' as currency,
  case when "nameDest" like 'M%'
       then (['RETAIL', 'FOOD', 'UTILITIES', 'HEALTHCARE', 'TRAVEL'])[{_bucket("'m' || row_id", '5')}]
       else 'TRANSFER' end as merchant_category,
  "nameOrig" as orig_account_id, "nameDest" as dest_account_id,
  cast("oldbalanceOrg" as double) as balance_before,
  cast("newbalanceOrig" as double) as balance_after,
  cast("oldbalanceDest" as double) as dest_balance_before,
  cast("newbalanceDest" as double) as dest_balance_after,
  cast("isFraud" as bigint) as is_fraud, cast("isFlaggedFraud" as bigint) as is_flagged_fraud,
  strftime(timestamp '2024-01-01' + step * interval '1 hour', '%Y-%m-%d') as transaction_date,
  strftime(timestamp '2024-01-01' + step * interval '1 hour', '%Y-%m-%dT%H:%M:%S') as created_at
from money_i""")

# --- history ----------------------------------------------------------------------------
ORACLES["dim_customer_scd2"] = _plain("dim_c", text=DIM_TEXT)
ORACLES["dim_customer_scd2_dense"] = _sql(f"""
select {_key('customer_id', 'updated_at')} as customer_key, customer_id as customer_natural_key,
  segment, note, cast(updated_at as varchar) as valid_from,
  cast(coalesce(nxt, timestamp '9999-12-31 00:00:00') as varchar) as valid_to,
  nxt is null as is_current
from (select *, lead(updated_at) over (partition by customer_id order by updated_at) as nxt
      from cust_events)""")
ORACLES["scd2_current"] = ORACLES["dim_customer_scd2"] + " where is_current"
_AT = "timestamp '1998-01-01 00:10:00'"
ORACLES["scd2_as_of"] = _sql(f"""
select * replace (cast(created_at as varchar) as created_at,
  cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to)
from (select * from dim_c where valid_from <= {_AT} and valid_to > {_AT})""")
ORACLES["scd2_asof_join"] = _sql("""
select t.transaction_id, t.customer_id, cast(t.created_at as varchar) as created_at,
  cast(t.amount as double) as amount, c.customer_key, c.segment
from stg_t t left join dim_c c on c.customer_natural_key = t.customer_id
  and c.valid_from <= t.created_at and t.created_at < c.valid_to""")
ORACLES["scd2_asof_join_merge"] = ORACLES["scd2_asof_join"]
CTES["damaged"] = """
select *, row_number() over () as r from (
  select customer_natural_key as k, valid_from as f, valid_to as t from dim_c
  union all
  select customer_natural_key, valid_from - interval 30 day, valid_from + interval 370 day
  from dim_c where segment = 'CORPORATE')"""
ORACLES["scd2_overlaps"] = _sql("""
select a.k as customer_natural_key, cast(a.f as varchar) as a_valid_from,
  cast(a.t as varchar) as a_valid_to, cast(b.f as varchar) as b_valid_from,
  cast(b.t as varchar) as b_valid_to, count(*) as pairs
from damaged a join damaged b on a.k = b.k and a.r <> b.r and a.f < b.t and a.t > b.f
group by all""")
CTES["damaged_keyed"] = """
select customer_natural_key as k, customer_key, segment, valid_from as f, valid_to as t from dim_c
union all
select customer_natural_key, md5(customer_key || 'x'), segment, valid_from - interval 30 day,
  valid_from + interval 370 day from dim_c where segment = 'CORPORATE'"""
ORACLES["scd2_overlapping"] = _sql("""
select k as customer_natural_key, customer_key, cast(f as varchar) as valid_from, cast(t as varchar) as valid_to,
  cast(until as varchar) as covered_until
from (select *, max(t) over (partition by k order by f, t, customer_key rows between unbounded preceding and 1 preceding) as until
      from damaged_keyed) where until > f""")
ORACLES["scd2_asof_damaged_search"] = _sql("""
select x.transaction_id, x.customer_id, cast(x.created_at as varchar) as created_at, c.customer_key, c.segment
from stg_t x left join damaged_keyed c on c.k = x.customer_id and c.f <= x.created_at and x.created_at < c.t
qualify row_number() over (partition by x.transaction_id
  order by c.f desc, c.t desc, c.customer_key desc, c.segment desc) = 1""")
ORACLES["scd2_asof_damaged_merge"] = ORACLES["scd2_asof_damaged_search"]
ORACLES["multi_version_customers"] = _sql("""
select customer_id, count(*) as versions from stg_c group by customer_id having count(*) > 1""")
ORACLES["customer_latest"] = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  cast(o_orderdate as varchar) as o_orderdate, o_orderpriority
from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""
_LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]
ORACLES["dedup_latest"] = f"""
select * replace (cast(l_shipdate as varchar) as l_shipdate) from (
  select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
    order by lineitem.l_shipdate desc, {', '.join(c + ' desc' for c in _LINE_REST)}) = 1)"""

# --- core star --------------------------------------------------------------------------
ORACLES["customer_accounts"] = _sql("""
select c.customer_id, c.full_name, c.email, c.segment, c.kyc_status, s.total_accounts,
  cast(s.total_balance as double) as total_balance, s.has_loan, s.has_checking, s.has_savings,
  case when s.total_balance >= 100000 then 'HIGH_VALUE'
       when s.total_balance >= 10000 then 'MID_VALUE' else 'STANDARD' end as value_tier
from (select * from stg_c qualify row_number() over
        (partition by customer_id order by updated_at desc) = 1) c
left join (select customer_id, count(*) as total_accounts, sum(balance) as total_balance,
    cast(bool_or(account_type = 'LOAN') as bigint) as has_loan,
    cast(bool_or(account_type = 'CHECKING') as bigint) as has_checking,
    cast(bool_or(account_type = 'SAVINGS') as bigint) as has_savings
  from stg_a group by customer_id) s on s.customer_id = c.customer_id""")
ORACLES["dim_account"] = _plain("dim_a", "balance", "opened_date")
ORACLES["dim_product"] = _sql(_products("acct_brand"))
ORACLES["fact_transactions"] = _plain("fact", FACT_MONEY, FACT_TEXT)
ORACLES["fact_fraud_alerts"] = _plain("alerts", FACT_MONEY, FACT_TEXT)

# --- reports ----------------------------------------------------------------------------
ORACLES["daily_volume"] = _plain("daily", "total_volume", "date")
ORACLES["daily_volume_30d"] = _sql(f"""
select * replace (cast(total_volume as double) as total_volume, cast(date as varchar) as date)
from (select * from daily where date >= date '{REPORT_DAY}' - 30)""")
ORACLES["kpis"] = _sql(f"""
select count(*) as total_transactions, cast(coalesce(sum(amount), 0) as double) as total_volume,
  count(*) filter (where is_fraud) as fraud_transactions,
  cast(cast(sum(amount) / count(amount) as decimal(22,6)) as double) as avg_amount
from (select is_fraud, cast(amount as decimal(30,8)) as amount from fact)""")
_TOTALS = """
select transaction_type, cast(sum(tx_count) as bigint) as tx_count,
  cast(sum(total_volume) as double) as total_volume,
  cast(sum(fraud_count) as bigint) as fraud_count {more}
from daily group by transaction_type"""
ORACLES["type_totals"] = _sql(_TOTALS.format(more=""))
ORACLES["fraud_rate_by_type"] = _sql(_TOTALS.format(
    more=", round(100.0::double * sum(fraud_count) / sum(tx_count), 2) as fraud_rate"))
ORACLES["type_rollup"] = _sql("""
select transaction_type, false as is_total, count(*) as tx_count,
  cast(sum(amount) as double) as total_volume, count(*) filter (where is_fraud) as fraud_count,
  round(100.0::double * count(*) filter (where is_fraud) / count(*), 2) as fraud_rate
from fact group by transaction_type
union all
select null, true, count(*), cast(sum(amount) as double), count(*) filter (where is_fraud),
  round(100.0::double * count(*) filter (where is_fraud) / count(*), 3)
from fact""")
_TYPES = ["CASH_OUT", "PAYMENT", "CASH_IN", "TRANSFER", "DEBIT"]
ORACLES["daily_pivot"] = _sql("select cast(date as varchar) as date, " + ", ".join(
    f"cast(sum(tx_count) filter (where transaction_type = '{t}') as bigint) as {t}"
    for t in _TYPES) + " from daily group by date")
ORACLES["segment_share"] = _sql("""
select segment, customer_count,
  round(100.0::double * customer_count / sum(customer_count) over (), 1) as pct
from (select segment, count(distinct customer_natural_key) as customer_count
      from dim_c where is_current group by segment)""")
ORACLES["kyc_status"] = _sql("select kyc_status, count(*) as count from stg_c group by kyc_status")
ORACLES["outcome_matrix"] = _sql("""
select transaction_type, detection_outcome, count(*) as n from alerts group by all""")
ORACLES["missed_fraud_value"] = _sql("""
select cast(sum(amount) filter (where is_fraud) as double) as fraud_value,
  cast(sum(amount) filter (where detection_outcome = 'FALSE_NEGATIVE') as double)
    as missed_fraud_value,
  count(*) filter (where is_missed_fraud and amount > 100000) as high_value_misses
from alerts""")
ORACLES["high_value_misses"] = _sql("""
select transaction_id, transaction_type, cast(amount as double) as amount,
  cast(transaction_date as varchar) as transaction_date
from alerts where is_missed_fraud and amount > 100000""")
ORACLES["detection_rates"] = _sql("""
select round(avg(case when is_flagged_fraud then 1.0::double else 0 end), 6) as flagged_share,
  round(tp::double / (tp + fn), 6) as recall, round(tp::double / (tp + fp), 6) as precision
from alerts, (select count(*) filter (where detection_outcome = 'TRUE_POSITIVE') as tp,
    count(*) filter (where detection_outcome = 'FALSE_POSITIVE') as fp,
    count(*) filter (where detection_outcome = 'FALSE_NEGATIVE') as fn from alerts)
group by tp, fp, fn""")
ORACLES["fraud_by_type"] = _sql(
    "select transaction_type, count(*) as n from alerts group by transaction_type")
ORACLES["feed_profile"] = _sql("""
select count(*) as row_count, count(*) filter (where is_fraud) as fraud_count,
  round(100.0::double * count(*) filter (where is_fraud) / count(*), 3) as fraud_pct,
  cast(min(transaction_date) as varchar) as first_date,
  cast(max(transaction_date) as varchar) as last_date
from stg_t""")
ORACLES["type_share"] = _sql("""
select transaction_type, n, round(100.0::double * n / sum(n) over (), 2) as share
from (select transaction_type, count(*) as n from stg_t group by transaction_type)""")
ORACLES["table_counts"] = _sql("\nunion all\n".join(
    f"select '{label}' as table_name, count(*) as row_count from {block}" for label, block in [
        ("transactions", "txn"), ("customers", "cust_v"), ("accounts", "acct"),
        ("loans", "loans"), ("card_transactions", "card"), ("money_transactions", "money")]))
ORACLES["batch_audit"] = _sql("""
select _batch_id, count(*) as row_count, min(_loaded_at) as first_loaded_at,
  count(distinct _source_file) as files from txn group by _batch_id""")
ORACLES["batch_rows"] = _sql("""
select transaction_id, amount, _loaded_at, _source_file, _batch_id
from txn where _batch_id = 'batch_3'""")
ORACLES["exact_sample"] = _sql("""
select transaction_id, customer_id, amount from txn
order by md5('42:' || transaction_id), transaction_id limit 1000""")

# --- two channels -----------------------------------------------------------------------
ORACLES["harmonize_card"] = _plain("card_h", *HARMONIZED)
ORACLES["harmonize_money"] = _plain("money_h", *HARMONIZED)
ORACLES["entity_bucket"] = _sql(f"""
select s."nameOrig" as "nameOrig", s.rows, p.id as client_id, p.rn
from (select "nameOrig", count(*) as rows from money group by "nameOrig") s
join pool p on p.rn = {_bucket('s."nameOrig"', '(select count(*) from users)')}""")
ORACLES["unified_transactions"] = _plain(
    "unified", HARMONIZED[0] + " balance_delta", HARMONIZED[1] + " date_key")
ORACLES["channel_summary"] = _sql("""
select coalesce(channel, 'TOTAL') as channel,
  case channel when 'CARD' then 'USD' when 'MOBILE_MONEY' then 'LOCAL' end as currency_basis,
  count(*) as transactions, count(*) filter (where is_fraud) as frauds,
  count(*) filter (where is_fraud_labeled) as labelled,
  round(100.0::double * count(*) filter (where is_fraud) / count(*), 3) as fraud_pct,
  round(100.0::double * count(*) filter (where is_fraud)
    / count(*) filter (where is_fraud_labeled), 3) as fraud_pct_labelled,
  case when channel is not null then cast(sum(amount) as double) end as amount
from unified group by rollup (channel)""")
ORACLES["dim_merchant"] = _plain("merchants")
ORACLES["dim_merchant_consistent"] = _sql("""
select md5(cast(g.merchant_id as varchar)) as merchant_key,
  cast(g.merchant_id as varchar) as merchant_natural_key, cast(g.mcc as bigint) as mcc,
  coalesce(m.mcc_category, 'UNKNOWN') as merchant_category, g.merchant_city, g.merchant_state
from (select merchant_id, mcc, merchant_city, merchant_state from card
      qualify row_number() over (partition by merchant_id
        order by mcc, merchant_city, merchant_state) = 1) g
left join mcc m on m.mcc = g.mcc""")
ORACLES["dim_date"] = _sql("""
select cast(d.d as varchar) as date_key, year(d.d) as year, quarter(d.d) as quarter,
  month(d.d) as month, day(d.d) as day, dayofweek(d.d) as day_of_week,
  strftime(d.d, '%B') as month_name, dayofweek(d.d) in (0, 6) as is_weekend, n.transactions
from (select cast(unnest(generate_series(cast(min(txn_date) as timestamp),
        cast(max(txn_date) as timestamp), interval '1 day')) as date) as d from both_h) d
left join (select txn_date, count(*) as transactions from both_h group by txn_date) n
  on n.txn_date = d.d""")
ORACLES["dim_card"] = _sql(f"""
select md5(cast(id as varchar)) as card_key, id as card_natural_key,
  client_id as customer_natural_key, card_brand, card_type, has_chip, num_cards_issued,
  cast(cast(replace(credit_limit, '$', '') as {MONEY}) as double) as credit_limit,
  card_on_dark_web from cards""")
ORACLES["dim_customer_master"] = _sql("""
select md5(cast(id as varchar)) as customer_key, id as customer_natural_key, current_age,
  retirement_age, gender, address, latitude, longitude,
  cast(replace(per_capita_income, '$', '') as double) as per_capita_income,
  cast(replace(yearly_income, '$', '') as double) as yearly_income,
  cast(replace(total_debt, '$', '') as double) as total_debt, credit_score, num_credit_cards,
  '1900-01-01 00:00:00' as valid_from, cast(null as varchar) as valid_to, true as is_current
from users""")
ORACLES["dim_channel"] = _sql("""
select c.*, n.transactions from channels c
left join (select channel, count(*) as transactions from both_h group by channel) n
  on n.channel = c.channel""")
ORACLES["fk_orphans"] = _sql("""
select 'account' as dimension, account_id as orphan_key, count(*) as fact_rows from stg_t
where account_id not in (select account_natural_key from dim_a) group by account_id
union all
select 'customer', customer_id, count(*) from stg_t
where customer_id not in (select customer_natural_key from dim_c) group by customer_id
union all
select 'owner', customer_id, count(*) from stg_a
where customer_id not in (select customer_natural_key from dim_c) group by customer_id
union all
select 'product', product_id, count(*) from stg_a
where product_id not in (select product_natural_key from dim_p) group by product_id""")

ORACLES["dq_relationships"] = _sql(f"""
select 'account' as relation, account_id as orphan_key, count(*) as fact_rows from stg_t
where account_id not in (select account_natural_key from dim_a) group by account_id
union all select 'customer', customer_id, count(*) from stg_t
where customer_id not in (select customer_natural_key from dim_c) group by customer_id
union all select 'owner', customer_id, count(*) from stg_a
where customer_id not in (select customer_natural_key from dim_c) group by customer_id
union all select 'product', product_id, count(*) from stg_a
where product_id not in (select product_natural_key from dim_p) group by product_id
union all select 'card', card_id, count(*) from both_h
where card_id not in (select cast(id as varchar) from cards) group by card_id
union all select 'merchant', merchant_id, count(*) from both_h
where merchant_id not in (select merchant_natural_key from merchants) group by merchant_id
union all select 'channel', channel, count(*) from both_h where channel not in (select channel from channels) group by channel
union all select 'date', cast(txn_date as varchar), count(*) from both_h
where txn_date not between date '{CALENDAR[0]}' and date '{CALENDAR[1]}' group by txn_date
union all select 'customer_master', cast(customer_natural_key as varchar), count(*) from both_h
where customer_natural_key not in (select id from users) group by customer_natural_key""")


# --- quality ----------------------------------------------------------------------------

def _quoted(values: list) -> str:
    return ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)


def _bad(rule: Rule) -> str | None:
    c, a = rule.column, rule.args
    if rule.kind == "not_null":
        return f"{c} is null"
    if rule.kind == "in_set":
        return f"{c} not in ({_quoted(a['values'])})"
    if rule.kind == "between":
        return f"{c} not between {a['min']} and {a['max']}"
    if rule.kind == "matches":
        return f"not regexp_matches({c}, '{a['pattern']}')"
    return None


def _rule_sql(suite: str, number: int, rule: Rule, block: str, columns: str) -> str:
    c, a = rule.column, rule.args
    name = f"'{c}'" if c else "cast(null as varchar)"
    head = f"'{suite}' as suite, {number} as rule_no, '{rule.kind}' as rule, {name} as column_name"
    none = "cast(null as bigint)"
    bad = _bad(rule)
    if bad:
        seen = "count(*)" if rule.kind == "not_null" else f"count({c})"
        wrong = f"count(*) filter (where {bad})"
        good = f"(1 - {wrong}::double / {seen})"
        rest = (f"round({good}, 6) as observed, {wrong} as unexpected, {seen} as evaluated, "
                f"{good} >= {rule.mostly} as success from {block}")
    elif rule.kind == "columns_present":
        wanted = _quoted(sorted(a["columns"]))
        missing = (f"(select count(*) from (select unnest([{wanted}]) as w) "
                   f"where w not in ({columns}))")
        rest = (f"{missing}::double as observed, {missing} as unexpected, "
                f"{len(a['columns'])} as evaluated, {missing} = 0 as success")
    elif rule.kind == "row_count_between":
        rest = (f"count(*)::double as observed, {none} as unexpected, count(*) as evaluated, "
                f"count(*) between {a['min']} and {a['max']} as success from {block}")
    elif rule.kind == "mean_between":
        rest = (f"round(avg({c}), 6) as observed, {none} as unexpected, count({c}) as evaluated, "
                f"avg({c}) between {a['min']} and {a['max']} as success from {block}")
    elif rule.kind == "fresh":
        rest = (f"(date '{a['as_of'][:10]}' - cast(max({c}) as date))::double as observed, "
                f"{none} as unexpected, count({c}) as evaluated, "
                f"max({c}) >= timestamp '{a['as_of']}' - interval {a['max_age_days']} day "
                f"as success from {block}")
    else:
        per = (f"from (select {c}, count(*) as n from {block} where {c} is not null "
               f"group by {c})")
        rows = "cast(sum(n) as bigint)"
        if rule.kind == "unique":
            twice = "cast(coalesce(sum(n) filter (where n > 1), 0) as bigint)"
            rest = (f"{twice}::double as observed, {twice} as unexpected, {rows} as evaluated, "
                    f"{twice} = 0 as success {per}")
        else:
            part = "count(*)" if rule.kind == "distinct_ratio_between" else "max(n)"
            ratio = f"({part}::double / sum(n))"
            low = f"{ratio} >= {a['min']}" if "min" in a else "true"
            rest = (f"round({ratio}, 6) as observed, {none} as unexpected, {rows} as evaluated, "
                    f"{low} and {ratio} <= {a['max']} as success {per}")
    return f"select {head}, {rest}"


def _suite_sql(suite: str, rules: list[Rule], block: str) -> str:
    columns = _quoted(re.findall(r"as \"?(\w+)\"?[,\n]", CTES[block] + "\n"))
    return "\nunion all\n".join(
        _rule_sql(suite, i, r, block, columns) for i, r in enumerate(rules, start=1))


_TXN = _suite_sql("bronze_transactions", transaction_suite(), "txn")
_TXN_STRICT = _suite_sql("bronze_transactions", transaction_suite(suites.ACCOUNT_PATTERN), "txn")
_CUST = _suite_sql("bronze_customers", suites.bronze_customers(GIVEN_CUSTOMER), "cust_v")
_SILVER = _suite_sql("silver_transactions", suites.silver_transactions(), "stg_t")
ORACLES["dq_bronze_transactions"] = _sql(_TXN)
ORACLES["dq_customers"] = _sql(_suite_sql("bronze_customers", suites.bronze_customers(WIDE_CUSTOMER), "cust_v"))
_DAY = _suite_sql("bronze_transactions", _day_suite(), "txn")
ORACLES["dq_merged_state"] = _sql(_DAY)
ORACLES["dq_merged_state_redelivered"] = _sql(_DAY.replace(
    "from txn", "from (select * from txn union all select * from txn where _batch_id = 'batch_4')"))
ORACLES["dq_silver_transactions"] = _sql(_SILVER)
ORACLES["dq_suite_summary"] = _sql(f"""
select suite, bool_and(success) as success, count(*) filter (where success) as passed,
  count(*) filter (where not success) as failed, count(*) as total
from ({_TXN}
union all
{_CUST}
union all
{_SILVER}) group by suite""")
ORACLES["dq_violations"] = _sql("\nunion all\n".join(
    f"select transaction_id as row_key, {i} as rule_no, '{r.kind}' as rule, "
    f"'{r.column}' as column_name from txn where {_bad(r)}"
    for i, r in enumerate(transaction_suite_rows(), start=1)))
ORACLES["dq_duplicate_keys"] = """
select line_key, l_partkey, l_suppkey from (
  select concat_ws('-', l_orderkey, l_linenumber) as line_key, l_partkey, l_suppkey,
    count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) where n > 1"""
ORACLES["dq_freshness"] = _sql(_suite_sql("freshness", [
    Rule("fresh", "created_at", {"as_of": "2001-08-03 00:00:00", "max_age_days": 7}),
    Rule("fresh", "created_at", {"as_of": "2001-09-03 00:00:00", "max_age_days": 7}),
    Rule("max_share", "transaction_type", {"max": 0.5}),
    Rule("max_share", "transaction_type", {"max": 0.1})], "stg_t"))
ORACLES["dq_latest_status"] = _sql(f"""
select w.suite, coalesce(r.success, false) as success, coalesce(r.evaluated, 0) as evaluated,
  coalesce(r.successful, 0) as successful, coalesce(r.failed, 0) as failed, r.run_time,
  case when bool_and(coalesce(r.success, false)) over () then 'PASS' else 'FAIL' end
    as overall_status
from (values ('bronze_transactions'), ('bronze_customers'), ('silver_transactions')) w(suite)
left join (
  select suite, run_time, bool_and(success) as success, count(*) as evaluated,
    count(*) filter (where success) as successful, count(*) filter (where not success) as failed
  from (select *, '2024-01-01 06:00:00' as run_time from ({_TXN_STRICT})
        union all select *, '2024-01-01 06:00:00' from ({_CUST})
        union all select *, '2024-01-02 06:00:00' from ({_TXN}))
  group by suite, run_time
  qualify row_number() over (partition by suite order by run_time desc) = 1) r
on r.suite = w.suite""")
ORACLES["negative_amounts"] = _sql(
    "select transaction_id, cast(amount as double) as amount from card_h where amount < 0")
ORACLES["drift_report"] = _sql("""
select d.column_name, d.drift, d.expected, d.actual, d.severity,
  case d.column_name
    when 'amount' then (select count(*) from txn where transaction_type = 'DEBIT')
    when 'is_fraud' then 0 end as uncastable
from (values ('currency', 'MISSING', 'string', null, 'CRITICAL'),
  ('channel_hint', 'NEW', null, 'string', 'WARNING'),
  ('amount', 'TYPE', 'double', 'string', 'WARNING'),
  ('is_fraud', 'TYPE', 'bigint', 'string', 'WARNING'))
  d(column_name, drift, expected, actual, severity)""")

# --- incremental ------------------------------------------------------------------------
ORACLES["incremental_fact"] = ORACLES["fact_transactions"]
ORACLES["incremental_late_rows"] = ORACLES["fact_transactions"]
ORACLES["incremental_vs_full"] = _sql("""
select count(*) as incremental, count(*) as "full", 0 as differing from fact""")
ORACLES["upsert_corrections"] = _sql("""
select transaction_id, cast(amount + fix as double) as amount, transaction_type,
  cast(transaction_date + 45 * fix as varchar) as transaction_date,
  cast(created_at + fix * interval 45 day as varchar) as created_at,
  cast(cast(date_trunc('month', transaction_date + 45 * fix) as date) as varchar)
    as transaction_month
from (select *, cast(transaction_type = 'CASH_OUT' as int) as fix from stg_t)""")

ORACLES["full_refresh"] = ORACLES["fact_transactions"]
ORACLES["incremental_ledger"] = ORACLES["fact_transactions"]
ORACLES["incremental_by_mark"] = ORACLES["fact_transactions"]
ORACLES["versions_read_back"] = _sql("""
select 1 as version, transaction_id, cast(amount as double) as amount from fact where _batch_id = 'batch_1'
union all select 2, transaction_id, cast(amount as double) from fact""")
ORACLES["upsert_key_index"] = ORACLES["upsert_corrections"]
_UNIFIED_TEXT = ", ".join(f"cast({c} as varchar) as {c}" for c in (HARMONIZED[1] + " date_key").split())
_UNIFIED_MONEY = ", ".join(f"cast({c} as double) as {c}" for c in (HARMONIZED[0] + " balance_delta").split())
ORACLES["incremental_unified"] = _sql(f"""select * exclude (_batch_id) replace ({_UNIFIED_TEXT}, {_UNIFIED_MONEY})
  from unified qualify row_number() over (partition by transaction_id order by txn_timestamp desc) = 1""")
ORACLES["channels_run"] = ORACLES["incremental_unified"]
ORACLES["pipeline_run"] = _sql(f"""select * exclude (_batch_id) replace ({", ".join(f"cast({c} as double) as {c}" for c in FACT_MONEY.split())},
  {", ".join(f"cast({c} as varchar) as {c}" for c in FACT_TEXT.split())}) from fact""")
ORACLES["money_ids_over_batches"] = _sql("""
select _batch_id, content || '-' || cast(row_number() over (partition by content order by _batch_id) as varchar) as row_id, step, "nameOrig"
from (select _batch_id, content, step, "nameOrig" from money_i union all
      select 'b1', content, step, "nameOrig" from money_i where step % 2 = 0)""")
ORACLES["upsert_out_of_order"] = ORACLES["upsert_corrections"]
ORACLES["upsert_null_and_repeated_keys"] = _sql("""
select distinct case when transaction_type <> 'DEBIT' then transaction_id end as transaction_id, account_id,
  cast(transaction_date as varchar) as transaction_date, cast(created_at as varchar) as created_at,
  cast(cast(date_trunc('month', transaction_date) as date) as varchar) as transaction_month
from stg_t""")

# --- sources and sinks ------------------------------------------------------------------
ORACLES["load_bronze_many_files"] = _sql("""
select customer_id, '1st' || chr(10) || 'line, ' || address as address, trim(segment) as segment,
  cast(updated_at as varchar) as updated_at, upper(trim(segment)) = 'PREMIUM' as compressed,
  '20240101_060000' as _batch_id
from cust_v""")
ORACLES["load_bronze"] = _sql("""
select * replace (address || ', Main "St" 1' as address, cast(created_at as varchar) as created_at,
    cast(updated_at as varchar) as updated_at),
  '2024-01-01T06:00:00' as _loaded_at, '20240101_060000' as _batch_id
from stg_c""")
ORACLES["read_dirty_csv"] = _sql("""
select customer_id, address || ', x' as address, segment,
  case when short then null else cast(created_at as varchar) end as created_at,
  case when short then null else cast(updated_at as varchar) end as updated_at, short as flagged
from (select *, upper(trim(segment)) = 'CORPORATE' as short from cust_v)""")
ORACLES["read_json_map"] = _sql("select mcc, mcc_category from mcc")
ORACLES["read_label_json"] = _sql("select transaction_id, fraud_label from labels")
ORACLES["read_label_documents"] = ORACLES["read_label_json"]
ORACLES["read_multiline_csv"] = """
select o_orderkey as id, 'said "no",' || chr(10) || regexp_replace(o_orderpriority, '[- ]', chr(10), 'g')
  || chr(10) || '"' || chr(10) as note, o_orderstatus as status, false as flagged
from orders"""
_AUDITED = """
select '{batch}' as _batch_id, count(*) as row_count, '2024-01-01T06:00:00' as first_loaded_at,
  1 as files, '{mode}' as table_mode from {block}"""
ORACLES["replace_and_append"] = _sql("\nunion all\n".join([
    _AUDITED.format(batch="20240101_060000", mode="append", block="acct"),
    _AUDITED.format(batch="20240102_060000", mode="append", block="acct_brand"),
    _AUDITED.format(batch="20240102_060000", mode="replace", block="acct_brand")]))
ORACLES["partition_pruned_archive"] = _sql(
    "select segment, count(*) as row_count from cust_v group by segment")

# --- streams ----------------------------------------------------------------------------
ORACLES["stream_daily_volume"] = f"""
select cast(cast(ts as date) as varchar) as date, event_type, count(*) as tx_count,
  cast(sum(cast(value as {MONEY})) as double) as total_volume,
  count(*) filter (where event_type = 'error') as fraud_count
from events group by cast(ts as date), event_type"""
ORACLES["stream_dedup"] = """
select event_id, cast(ts as varchar) as ts, user_id, event_type, value from events"""
ORACLES["stream_upsert"] = f"""
select event_id, user_id, upper(trim(event_type)) as event_type,
  cast(cast(value as {MONEY}) as double) as amount, cast(ts as varchar) as ts,
  cast(cast(ts as date) as varchar) as event_date from events"""
ORACLES["stream_merge"] = ORACLES["stream_upsert"]
