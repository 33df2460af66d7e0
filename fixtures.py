"""Raw tables of both stars, derived from the given tables.

Every adapter is one SELECT over whole tables, in SQL that Spark and DuckDB both accept. Spark
gets the tables as parameters; for DuckDB the same text is used as it stands. Codes come in mixed
case and with blanks, some amounts are negative or NULL, some keys have no partner: every filter
and every CASE branch is reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

ADAPTERS: dict[str, str] = {}

ADAPTERS["txn"] = """
select concat('T', cast(o_orderkey as string)) as transaction_id,
       concat('ACC', cast(case when o_orderkey % 97 = 0 then o_custkey + 90000000 else o_custkey end as string)) as account_id,
       concat('CUST', cast(o_custkey as string)) as customer_id,
       case o_orderpriority when '1-URGENT' then ' cash_out' when '2-HIGH' then 'TRANSFER'
            when '3-MEDIUM' then 'PAYMENT ' when '4-NOT SPECIFIED' then 'CASH_IN' else 'DEBIT' end as transaction_type,
       case when o_orderkey % 211 = 0 then -o_totalprice when o_orderkey % 223 = 0 then null
            when o_orderkey % 10 = 1 then o_totalprice * 10 when o_orderkey % 10 = 2 then cast(o_orderkey % 1000 + 1 as double)
            else o_totalprice end as amount,
       'usd' as currency,
       case when o_orderpriority in ('3-MEDIUM', '5-LOW') then 'RETAIL' else 'TRANSFER' end as merchant_category,
       concat('C', cast(100000000 + o_custkey as string)) as orig_account_id,
       concat(case when o_orderpriority in ('3-MEDIUM', '5-LOW') then 'M' else 'C' end, cast(200000000 + o_orderkey as string)) as dest_account_id,
       o_totalprice as balance_before, cast(0.0 as double) as balance_after,
       cast(0.0 as double) as dest_balance_before, o_totalprice as dest_balance_after,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderkey % 25 = 0 then 1 else 0 end as is_fraud,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderkey % 50 = 0 then 1
            when o_orderkey % 331 = 0 then 1 else 0 end as is_flagged_fraud,
       cast(o_orderdate as date) as transaction_date,
       o_orderdate + interval '1' second * (o_orderkey % 86400) as created_at,
       concat('2024-01-0', cast(o_orderkey % 5 + 1 as string), 'T06:00:00') as _loaded_at,
       concat('feed_', cast(o_orderkey % 10 as string), '.csv') as _source_file,
       concat('batch_', cast(o_orderkey % 5 as string)) as _batch_id
from {orders}
"""

ADAPTERS["cust_v"] = """
select concat('CUST', cast(c_custkey as string)) as customer_id, concat(' ', c_name) as full_name,
       concat('USER', cast(c_custkey as string), '@Example.com ') as email,
       cast(c_nationkey as string) as phone, c_name as address,
       case c_mktsegment when 'BUILDING' then 'premium' when 'AUTOMOBILE' then 'CORPORATE ' else 'RETAIL' end as segment,
       case c_custkey % 4 when 0 then 'VERIFIED' when 1 then 'PENDING' when 2 then 'FAILED' else 'EXPIRED' end as kyc_status,
       timestamp '1995-01-01 00:00:00' as created_at,
       timestamp '1995-01-01 00:00:00' + interval '1' second * c_custkey as updated_at
from {customer}
union all
select concat('CUST', cast(c_custkey as string)), concat(' ', c_name),
       concat('USER', cast(c_custkey as string), '@Example.com '),
       cast(c_nationkey as string), c_name,
       case c_mktsegment when 'BUILDING' then 'RETAIL' when 'AUTOMOBILE' then 'RETAIL' else 'PREMIUM' end,
       'VERIFIED', timestamp '1995-01-01 00:00:00',
       timestamp '1998-01-01 00:00:00' + interval '1' second * c_custkey
from {customer} where c_acctbal > 6500
"""

ADAPTERS["cust_events"] = """
select concat('CUST', cast(user_id as string)) as customer_id, upper(event_type) as segment,
       cast(value as string) as note, ts as updated_at
from {events}
"""

ADAPTERS["acct"] = """
select concat('ACC', cast(c_custkey as string)) as account_id,
       concat('CUST', cast(c_custkey % 1000 as string)) as customer_id,
       case c_custkey % 3 when 0 then 'CHECKING' when 1 then 'SAVINGS' else 'loan' end as account_type,
       c_acctbal * 10 as balance, date '1992-01-01' + cast(c_custkey % 2000 as int) as opened_date,
       'active' as status,
       case when c_custkey % 41 = 0 then null else concat('PROD', lpad(cast(c_custkey % 20 + 1 as string), 3, '0')) end as product_id
from {customer}
"""

ADAPTERS["acct_brand"] = """
select concat('ACC', cast(p_partkey as string)) as account_id,
       concat('CUST', cast(p_partkey as string)) as customer_id, 'SAVINGS' as account_type,
       p_retailprice as balance, date '1992-01-01' as opened_date, 'active' as status,
       concat('PROD', lpad(replace(p_brand, 'Brand#', ''), 3, '0')) as product_id
from {part}
"""

ADAPTERS["loans"] = """
select concat('LOAN', lpad(cast(s_suppkey as string), 5, '0')) as loan_id,
       concat('CUST', cast(s_suppkey as string)) as customer_id, concat('ACC', cast(s_suppkey as string)) as account_id,
       case when s_acctbal < 0 then null else s_acctbal end as principal,
       cast(3.5 + (s_suppkey % 145) * 0.1 as double) as interest_rate, cast(12 * (s_suppkey % 5 + 1) as bigint) as term_months,
       date '1996-01-01' + cast(s_suppkey % 365 as int) as disbursement_date,
       date '2000-01-01' + cast(s_suppkey % 365 as int) as maturity_date, ' Active' as status
from {supplier}
"""

ADAPTERS["card"] = """
select ((l_orderkey * 10 + l_linenumber) * 20011 + l_partkey) * 1009 + l_suppkey as id, l_shipdate as date,
       l_orderkey % 150 as client_id, l_partkey % 200 as card_id,
       concat(case when l_returnflag = 'R' then '$-' else '$' end, cast(cast(l_extendedprice as decimal(18,2)) as string)) as amount,
       case when l_returnflag = 'N' then 'Swipe Transaction' when l_returnflag = 'A' and l_linestatus = 'O' then 'Chip Transaction'
            when l_returnflag = 'A' then 'Online Transaction' else 'Other' end as use_chip,
       l_suppkey as merchant_id, concat('City', cast(l_partkey % 7 as string)) as merchant_city,
       l_linestatus as merchant_state, cast(l_partkey % 60 as int) as mcc, 'b0' as _batch_id
from {lineitem}
"""

ADAPTERS["mcc"] = """
select cast(p_size as int) as mcc, min(p_type) as mcc_category from {part} group by p_size
"""

# Labels exist for what was shipped before 2000; later transactions are unlabelled.
ADAPTERS["labels"] = """
select distinct ((l_orderkey * 10 + l_linenumber) * 20011 + l_partkey) * 1009 + l_suppkey as transaction_id,
       case when l_orderkey % 97 = 0 then 'Yes' else 'No' end as fraud_label
from {lineitem} where l_shipdate < date '2000-01-01'
"""

ADAPTERS["users"] = """
select c_custkey as id, cast(20 + c_custkey % 60 as int) as current_age, 65 as retirement_age,
       case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender, c_name as address,
       cast(c_nationkey as double) as latitude, cast(-c_nationkey as double) as longitude,
       concat('$', cast(cast(abs(c_acctbal) as decimal(18,2)) as string)) as per_capita_income,
       concat('$', cast(cast(abs(c_acctbal) as decimal(18,2)) as string)) as yearly_income,
       concat('$', cast(cast(abs(c_acctbal) as decimal(18,2)) as string)) as total_debt,
       cast(300 + c_custkey % 550 as int) as credit_score, cast(c_custkey % 5 as int) as num_credit_cards
from {customer}
"""

ADAPTERS["cards"] = """
select p_partkey as id, p_partkey % 150 as client_id, p_brand as card_brand, p_type as card_type,
       case when p_size > 10 then 'YES' else 'NO' end as has_chip, p_size as num_cards_issued,
       concat('$', cast(cast(p_retailprice as decimal(18,2)) as string)) as credit_limit, 'No' as card_on_dark_web
from {part}
"""

ADAPTERS["money"] = """
select cast(event_id % 720 as int) as step,
       case event_type when 'click' then 'PAYMENT' when 'view' then 'CASH_IN' when 'purchase' then 'TRANSFER'
            when 'signup' then 'DEBIT' else 'CASH_OUT' end as type,
       value * 1000 as amount, concat('C', cast(100000000 + user_id as string)) as "nameOrig",
       value * 2000 as "oldbalanceOrg", value * 1000 as "newbalanceOrig",
       concat(case when event_type in ('click', 'signup') then 'M' else 'C' end, cast(300000000 + event_id % 977 as string)) as "nameDest",
       cast(0.0 as double) as "oldbalanceDest", value * 1000 as "newbalanceDest",
       case when event_type in ('purchase', 'error') and event_id % 20 = 0 then 1 else 0 end as "isFraud",
       case when event_id % 80 = 0 then 1 else 0 end as "isFlaggedFraud", 'b0' as _batch_id
from {events}
"""


#: Adapters for feeds whose ids are tested. The SQL of loans keeps five digits of a supplier's number, so that from 100,000
#: suppliers on several loans have one id; here longer numbers stay whole, shorter ones are padded alike.
WHOLE_IDS = {"loans": ADAPTERS["loans"].replace(
    "cast(s_suppkey as string), 5, '0'", "cast(s_suppkey as string), greatest(5, length(cast(s_suppkey as string))), '0'")}


def adapter(spark: SparkSession, sf_dir: str, name: str, whole_ids: bool = False) -> DataFrame:
    """The adapter as a Spark DataFrame over the Parquet tables of ``sf_dir``."""
    text = (WHOLE_IDS if whole_ids else ADAPTERS)[name].replace('"', "`")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{%s}" % t in text}
    return spark.sql(text, **used)


def duck(name: str) -> str:
    """The adapter as DuckDB SQL over tables or views of the given names."""
    return ADAPTERS[name].format(**{t: t for t in TABLES}).strip()
