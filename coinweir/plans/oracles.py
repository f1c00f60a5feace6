"""The registered queries as DuckDB SQL, written independently of the operators."""

from __future__ import annotations

from coinweir.plans import registry as r
from coinweir.schemas import STAGING
from coinweir.vocab import (
    CATEGORIES,
    CHECK_COUNT,
    CHECK_MERCHANT,
    CHECK_NET,
    CHECK_SPEND,
    MODEL_NOT_PUBLISHED,
    PUBLISHED_NOT_MODEL,
    PUBLISHED_TWICE,
    RAW_NOT_STAGED,
    STAGED_NOT_RAW,
)

_COLUMNS = ", ".join(STAGING.fieldNames())

_DELIVERIES = """
deliveries as (
  select
    l_orderkey::varchar || '-' || l_linenumber::varchar as transaction_id,
    o_custkey::varchar as account_id,
    case l_returnflag when 'A' then 1 else -1 end * (l_quantity * 100)::bigint as amount_minor_units,
    'GBP' as currency,
    l_shipdate::timestamp as created_at,
    case when l_linestatus = 'F' then o_orderdate::timestamp end as settled_at,
    l_linestatus = 'F' and o_orderdate is not null as is_settled,
    l_returnflag = 'R' and l_linestatus = 'O' as is_declined,
    p_type as description,
    lower(replace(p_name, ' ', '_')) as category,
    case when l_linestatus = 'F' then p_brand end as notes,
    false as is_load,
    case when l_returnflag = 'R' and l_linestatus = 'O' then 'INSUFFICIENT_FUNDS' end as decline_reason,
    case when l_linenumber <> 7 then s_suppkey::varchar end as merchant_id,
    case when l_linenumber <> 7 then s_name end as merchant_name,
    case when l_linenumber <> 7 then 'nation_' || s_nationkey::varchar end as merchant_category,
    null::varchar as merchant_emoji,
    case when l_linenumber <> 7 then s_acctbal > 0 end as merchant_online,
    case when l_linenumber <> 7 then false end as merchant_atm,
    case when l_tax < 0.04 then 'reconciliation' else 'webhook' end as ingestion_source
  from lineitem
  left join orders on o_orderkey = l_orderkey
  left join part on p_partkey = l_partkey
  left join supplier on s_suppkey = l_suppkey
)"""

_RANK = """row_number() over (
      partition by transaction_id
      order by (ingestion_source = 'reconciliation') desc, created_at desc nulls last,
        account_id desc nulls last, amount_minor_units desc nulls last, settled_at desc nulls last,
        description desc nulls last, category desc nulls last, notes desc nulls last,
        decline_reason desc nulls last, merchant_id desc nulls last)"""


def _deduped(name: str, rows: str) -> str:
    return f"""
{name} as (
  select {_COLUMNS} from (select *, {_RANK} as pick from {rows}) ranked where pick = 1
)"""


_MONTH = "date_trunc('month', created_at)::timestamp"
_SPENT = "amount_minor_units < 0 and not is_declined"
_LABEL = "upper(left(replace(category, '_', ' '), 1)) || substr(replace(category, '_', ' '), 2)"


def _marts(source: str, prefix: str = "") -> str:
    """The four marts as common table expressions over a staging relation."""
    return f"""
{prefix}spend as (
  select {_MONTH} as transaction_month, category, {_LABEL} as category_label,
    (-sum(amount_minor_units)) / 100.0::double as total_spend, count(*) as transaction_count
  from {source} where {_SPENT} group by all
),
{prefix}cashflow as (
  select {_MONTH} as transaction_month,
    coalesce(sum(amount_minor_units) filter (amount_minor_units > 0), 0) / 100.0::double as income,
    coalesce(-sum(amount_minor_units) filter (amount_minor_units < 0), 0) / 100.0::double as expenses,
    sum(amount_minor_units) / 100.0::double as net
  from {source} where not is_declined group by all
),
{prefix}merchants as (
  select merchant_id, min(merchant_name) as merchant_name, min(merchant_category) as merchant_category
  from {source} where merchant_id is not null group by merchant_id
),
{prefix}summary as (
  select m.merchant_id, m.merchant_name, m.merchant_category,
    (-sum(t.amount_minor_units)) / 100.0::double as total_spend, count(*) as transaction_count,
    (-sum(t.amount_minor_units)) / 100.0::double / count(*) as avg_transaction_amount,
    min(t.created_at) as first_transaction_at, max(t.created_at) as last_transaction_at
  from {source} t, {prefix}merchants m
  where t.merchant_id = m.merchant_id and t.amount_minor_units < 0 and not t.is_declined
  group by all
),
{prefix}recurring as (
  select t.merchant_id, m.merchant_name, m.merchant_category, -t.amount_minor_units as charged,
    count(distinct {_MONTH.replace('created_at', 't.created_at')}) as months_charged,
    count(*) as charge_count,
    min(t.created_at) as first_charged_at, max(t.created_at) as last_charged_at
  from {source} t, {prefix}merchants m
  where t.merchant_id = m.merchant_id and t.amount_minor_units < 0 and not t.is_declined
  group by all
),
{prefix}subs as (
  select merchant_id, merchant_name, merchant_category, charged / 100.0::double as charge_amount,
    months_charged, charge_count, first_charged_at, last_charged_at
  from {prefix}recurring where months_charged > 1
)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


_STG = _deduped("stg", "deliveries")
_BOTH = _with(_DELIVERIES, _STG)
_ALL = _with(_DELIVERIES, _STG, _marts("stg"))
_WEBHOOK = "(select * from deliveries where ingestion_source = 'webhook') w"
_RECONCILED = "(select * from deliveries where ingestion_source = 'reconciliation') x"
_YEAR_MONTH = """strftime(created_at, '%Y') as transaction_year, strftime(created_at, '%m') as transaction_month"""
_SCAN_FROM = "date_trunc('month', date_trunc('month', max(created_at))::date - interval {} day)::date"
_CATEGORY_LIST = ", ".join(f"'{name}'" for name in CATEGORIES)


# Purchases are the only accepted envelopes; the last one a user has on a day stands.
_STREAMED = """with standing as (
  select user_id, ts, if(value < 10, null, (props::json->>'$.k')::bigint) as amount
  from (
    select *, row_number() over (partition by user_id, ts::date order by event_id desc) as n
    from events where event_type = 'purchase')
  where n = 1
)
"""


def _sum_check(name: str, published: str, expected: str) -> str:
    return f"""select '{name}' as check_name, {published} as published_value, {expected} as expected_value"""


def oracle_sql() -> dict[str, str]:
    sums = " union all ".join(
        [
            _sum_check(
                CHECK_NET,
                "(select sum(net::decimal(28,6))::double from cashflow)",
                "(select sum(amount_minor_units) / 100.0::double from stg where not is_declined)",
            ),
            _sum_check(
                CHECK_SPEND,
                "(select sum(total_spend::decimal(28,6))::double from spend)",
                f"(select -sum(amount_minor_units) / 100.0::double from stg where {_SPENT})",
            ),
            _sum_check(
                CHECK_COUNT,
                "(select sum(transaction_count)::double from spend)",
                f"(select count(*)::double from stg where {_SPENT})",
            ),
            _sum_check(
                CHECK_MERCHANT,
                "(select sum(total_spend::decimal(28,6))::double from summary)",
                "(select -sum(amount_minor_units) / 100.0::double from stg "
                f"where {_SPENT} and merchant_id is not null)",
            ),
        ]
    )
    recon_raw_vs_staging = (
        _BOTH
        + f""", landed as (
  select distinct transaction_id from deliveries
  where ingestion_source = 'webhook' and created_at::date < date '{r.TODAY}'
), staged as (select distinct transaction_id from stg where created_at < timestamp '{r.TODAY}')
select '{RAW_NOT_STAGED}' as issue, transaction_id from landed anti join staged using (transaction_id)
union all
select '{STAGED_NOT_RAW}', transaction_id from staged anti join landed using (transaction_id)"""
    )
    recon_published_vs_model = (
        _with(
            _DELIVERIES,
            " published as (select transaction_id, count(*) as n from deliveries "
            "where ingestion_source = 'webhook' group by all)",
            " model as (select distinct transaction_id from deliveries where ingestion_source = 'reconciliation')",
        )
        + f"""select '{MODEL_NOT_PUBLISHED}' as issue, transaction_id
from model anti join published using (transaction_id)
union all
select '{PUBLISHED_NOT_MODEL}', transaction_id from published anti join model using (transaction_id)
union all
select '{PUBLISHED_TWICE}', transaction_id from published where n > 1"""
    )
    return {
        "raw_scan": _with(_DELIVERIES) + f"select {_COLUMNS} from deliveries",
        "raw_window": _with(_DELIVERIES)
        + f"select {_COLUMNS} from deliveries where created_at >= timestamp '{r.PRUNE_MONTH}' and created_at < timestamp '{r.RAW_THROUGH}' + interval 1 month",
        "raw_files_listed": _with(_DELIVERIES)
        + """select date_trunc('month', created_at)::timestamp as month, count(distinct day(created_at) < 15) as file_count
from deliveries group by all""",
        "flatten_transactions": _with(_DELIVERIES) + f"select {_COLUMNS} from deliveries",
        "stg_transactions": _BOTH + f"select {_COLUMNS} from stg",
        "stg_incremental": _with(
            _DELIVERIES,
            _deduped("published", _WEBHOOK),
            f" mark as (select {_SCAN_FROM.format(r.WIDE_LOOKBACK_DAYS)} as scan_from from published)",
            _deduped("fresh", "(select * from deliveries where created_at >= (select scan_from from mark)) f"),
        )
        + f"""select {_COLUMNS} from fresh
union all
select {_COLUMNS} from published where date_trunc('month', created_at) < (select scan_from from mark)""",
        "staging_scan_pruned": _BOTH
        + f"""select transaction_id, created_at, amount_minor_units, {_YEAR_MONTH}
from stg where year(created_at) * 100 + month(created_at) < {r.PRUNE_MONTH:%Y%m}""",
        "staging_publish_roundtrip": _BOTH + f"select {_COLUMNS}, {_YEAR_MONTH} from stg",
        "incremental_watermark": _BOTH
        + f"""select date_trunc('month', max(created_at))::timestamp as latest_month,
  {_SCAN_FROM.format(30)}::timestamp as scan_from from stg""",
        "month_spine": _with(_DELIVERIES)
        + f"""select g.month::timestamp as month, count(d.transaction_id) as file_count
from generate_series(
  date_trunc('month', date '{r.SPINE_START}')::timestamp, timestamp '{r.SPINE_END}', interval 1 month) g(month)
left join deliveries d on date_trunc('month', d.created_at) = g.month
group by all""",
        "raw_path_keys": _with(_DELIVERIES)
        + "select transaction_id, created_at::date::timestamp as path_date from deliveries",
        "raw_month_counts": _with(_DELIVERIES)
        + """select date_trunc('month', created_at)::timestamp as month, count(*) as file_count
from deliveries group by all""",
        "recent_lookback": _with(_DELIVERIES)
        + f"""select {_COLUMNS} from deliveries
where created_at >= timestamp '{r.LOOKBACK_AS_OF}' - interval 1 day""",
        "backfill_windows": _with(
            _DELIVERIES,
            _STG,
            " opened as (select account_id, min(created_at) as opened_at from stg group by all)",
            f""" windows as (
  select account_id, i::int as window_index, opened_at + to_days(365 * i::int) as window_start,
    least(opened_at + to_days(365 * (i::int + 1)), timestamp '{r.BACKFILL_AS_OF}') as window_end
  from opened, range(0, 1000) steps(i)
  where opened_at + to_days(365 * i::int) < timestamp '{r.BACKFILL_AS_OF}')""",
        )
        + """select w.account_id, w.window_index, w.window_start, w.window_end,
  count(t.transaction_id) as transaction_count
from windows w left join stg t
  on t.account_id = w.account_id and t.created_at >= w.window_start and t.created_at < w.window_end
group by all""",
        "dim_account": _BOTH
        + """select account_id, min(created_at) as first_transaction_at,
  max(created_at) as last_transaction_at, count(*) as transaction_count from stg group by all""",
        "dim_category": _BOTH
        + f"select category, {_LABEL} as category_label from stg where category is not null group by all",
        "dim_merchant": _BOTH
        + """select merchant_id, min(merchant_name) as merchant_name,
  min(merchant_category) as merchant_category, min(merchant_emoji) as merchant_emoji,
  bool_and(merchant_online) as is_online_merchant, bool_and(merchant_atm) as is_atm
from stg where merchant_id is not null group by merchant_id""",
        "fct_transactions": _BOTH
        + f"""select transaction_id, account_id, merchant_id, category, created_at, settled_at,
  {_MONTH} as transaction_month, is_settled, is_declined, amount_minor_units,
  amount_minor_units / 100.0::double as amount, amount_minor_units > 0 as is_credit,
  amount_minor_units < 0 as is_debit, currency, description, notes, ingestion_source
from stg""",
        "mart_spend_by_category": _ALL + "select * from spend",
        "mart_monthly_cashflow": _ALL + "select * from cashflow",
        "mart_merchant_summary": _ALL + "select * from summary",
        "mart_subscriptions": _ALL + "select * from subs",
        "q_spend_by_category": _ALL
        + "select * from spend order by transaction_month, total_spend desc, category",
        "q_spend_by_category_month": _ALL
        + f"""select * from spend where strftime(transaction_month, '%Y-%m') = '{r.SPEND_MONTH}'
order by total_spend desc, category""",
        "q_monthly_cashflow": _ALL + "select * from cashflow order by transaction_month desc limit 12",
        "q_top_merchants": _ALL
        + """select merchant_name, merchant_category, total_spend, transaction_count,
  avg_transaction_amount, last_transaction_at
from summary order by total_spend desc, merchant_id limit 10""",
        "q_subscriptions": _ALL
        + """select merchant_name, merchant_category, charge_amount, months_charged, charge_count,
  last_charged_at from subs order by months_charged desc, charge_amount desc, merchant_id""",
        "q_data_quality_report": _BOTH
        + f"""select count(*) as transaction_count, count(distinct transaction_id) as distinct_transaction_ids,
  count(distinct account_id) as account_count, count(distinct category) as category_count,
  count(distinct merchant_id) as merchant_count, count(*) filter (is_declined) as declined_count,
  min(created_at) as earliest_transaction_at, max(created_at) as latest_transaction_at,
  date_diff('hour', max(created_at), timestamp '{r.PROFILE_AS_OF}') as hours_since_last_transaction,
  count(*) <> count(distinct transaction_id) as has_duplicate_transaction_ids
from stg""",
        "q_mart_row_counts": _ALL
        + """select 'spend_by_category' as mart, count(*) as row_count from spend
union all select 'monthly_cashflow', count(*) from cashflow
union all select 'merchant_summary', count(*) from summary
union all select 'subscriptions', count(*) from subs""",
        "q_adhoc_sql": _ALL
        + """select s.category, count(*) as n_months, sum(s.transaction_count)::bigint as transaction_count,
  max(f.expenses) as highest_expenses
from spend s, cashflow f where f.transaction_month = s.transaction_month group by s.category""",
        "dq_unique": _with(_DELIVERIES)
        + """select transaction_id as value, count(*) as n_records from deliveries
where transaction_id is not null group by all having count(*) > 1""",
        "dq_duplicates": _with(_DELIVERIES)
        + """select merchant_id as value, count(*) as n_records from deliveries
group by all having count(*) > 1""",
        "dq_not_null": _with(_DELIVERIES)
        + " union all ".join(
            f"""select '{name}' as column_name, count(*) as n_records from deliveries
where {name} is null having count(*) > 0"""
            for name in STAGING.fieldNames()
        ),
        "dq_accepted_values": _BOTH
        + f"""select 'accepted_values stg_transactions.category' as check_name, 'warn' as severity,
  category as value, count(*) as n_records
from stg where category not in ({_CATEGORY_LIST}) group by all""",
        "dq_relationships": _with(_DELIVERIES)
        + """select 'relationships webhook to reconciliation' as check_name, 'error' as severity,
  w.transaction_id as value, count(*) as n_records
from deliveries w
where w.ingestion_source = 'webhook' and not exists (
  select 1 from deliveries x
  where x.transaction_id = w.transaction_id and x.ingestion_source = 'reconciliation')
group by all""",
        "dq_liveness": f"""with signals as (
  select 'heartbeat' as signal, max(ts) as last_at, 24 as max_hours from events
  where event_type = 'purchase'
  union all select 'monthly_cashflow', max(ts), 48 from events
)
select signal, last_at, max_hours,
  (epoch_us(timestamp '{r.LIVENESS_AS_OF}') - epoch_us(last_at)) / 3600e6::double as age_hours,
  (epoch_us(timestamp '{r.LIVENESS_AS_OF}') - epoch_us(last_at)) / 3600e6::double > max_hours as is_stale
from signals""",
        "dq_suite": _ALL + _suite_sql(),
        "recon_raw_vs_staging": recon_raw_vs_staging,
        "recon_raw_by_month": recon_raw_vs_staging,
        "recon_published_vs_model": recon_published_vs_model,
        "recon_published_by_month": recon_published_vs_model,
        "recon_marts_vs_fact": _with(_DELIVERIES, _STG, _marts("deliveries"))
        + f""", sums as ({sums})
select check_name, published_value, expected_value, published_value - expected_value as difference
from sums where abs(coalesce(published_value, 0) - coalesce(expected_value, 0)) > 0.005""",
        "recon_subscriptions_vs_fact": _with(
            _DELIVERIES, _STG, _marts("deliveries"), _marts("stg", "true_")
        )
        + """select p.merchant_id, -p.charged as amount_minor_units, p.charge_count as published_value,
  f.charge_count as expected_value
from (select * from recurring where months_charged > 1) p
left join true_recurring f on f.merchant_id = p.merchant_id and f.charged = p.charged
where p.charge_count is distinct from f.charge_count""",
        "landing_precedence": """select created_date::timestamp as created_date, transaction_id, source, meta_source, delivery_id
from (
  select *, row_number() over (
    partition by created_date, transaction_id
    order by coalesce(meta_source = 'reconciliation', false) desc, ts desc, delivery_id desc) as pick
  from (
    select ts, ts::date as created_date, user_id::varchar as transaction_id, event_id as delivery_id,
      if(event_type = 'purchase', 'reconciliation', 'webhook') as source,
      case event_type when 'purchase' then 'reconciliation' when 'signup' then null else 'webhook' end
        as meta_source
    from events))
where pick = 1""",
        "validate_events": """select event_id, case event_type
  when 'error' then 'Invalid JSON'
  when 'view' then 'Unsupported event type'
  when 'signup' then 'Missing fields: account_id, created'
  when 'click' then 'Missing fields: amount' end as reject_reason
from events""",
        "iso_presentation": """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
  || case when microsecond(ts) % 1000000 > 0 then strftime(ts, '.%f') else '' end as ts
from events""",
        "recon_raw_lines": recon_raw_vs_staging,
        "reconcile_heartbeat": _with(_DELIVERIES)
        + f"""select timestamp '{r.LOOKBACK_AS_OF}' as last_run_at, count(*) as transactions_written
from deliveries where created_at >= timestamp '{r.LOOKBACK_AS_OF}' - interval 24 hour""",
        "stream_rejects": """select reject_reason, count(*)::bigint as n_bodies from (
  select case event_type
    when 'error' then 'Invalid JSON'
    when 'view' then 'Unsupported event type'
    when 'signup' then 'Missing fields: account_id, created'
    when 'click' then 'Missing fields: amount' end as reject_reason
  from events
) where reject_reason is not null group by reject_reason""",
        "stream_landing": _STREAMED
        + """select 'webhook' as source, 'tx_' || user_id as id, user_id::varchar as account_id,
  amount, replace(ts::varchar, ' ', 'T') || 'Z' as created
from standing""",
        "landing_compacted": _STREAMED
        + """select 'webhook' as source, 'tx_' || user_id as transaction_id, 'webhook' as meta_source, ts::date::timestamp as created_date
from standing""",
        "stream_staging": _STREAMED
        + """select 'tx_' || user_id as transaction_id, user_id::varchar as account_id,
  amount as amount_minor_units, ts as created_at, strftime(ts, '%Y') as transaction_year,
  strftime(ts, '%m') as transaction_month
from (select *, row_number() over (partition by user_id order by ts desc) as pick from standing)
where pick = 1""",
        "stream_moved_ids": _BOTH + f"select {_COLUMNS} from stg",
        "stream_marts": _ALL + "select * from summary",
    }


def _suite_sql() -> str:
    """Every declared column rule, spelled out."""
    models = {
        "stg_transactions": "stg",
        "dim_account": "(select distinct account_id from stg)",
        "dim_category": "(select distinct category from stg where category is not null)",
        "dim_merchant": "merchants",
        "fct_transactions": "stg",
        "spend_by_category": "spend",
        "monthly_cashflow": "cashflow",
        "merchant_summary": "summary",
    }
    unique = [
        ("stg_transactions", "transaction_id"),
        ("dim_account", "account_id"),
        ("dim_category", "category"),
        ("dim_merchant", "merchant_id"),
        ("fct_transactions", "transaction_id"),
        ("monthly_cashflow", "transaction_month"),
        ("merchant_summary", "merchant_id"),
    ]
    required = unique + [
        ("stg_transactions", "account_id"),
        ("stg_transactions", "amount_minor_units"),
        ("stg_transactions", "currency"),
        ("stg_transactions", "created_at"),
        ("fct_transactions", "account_id"),
        ("spend_by_category", "total_spend"),
    ]
    parts = [
        f"""select 'unique {name}.{column}' as check_name, 'error' as severity, count(*) as violations
from (select {column} from {models[name]} m where {column} is not null group by all having count(*) > 1)"""
        for name, column in unique
    ]
    parts += [
        f"select 'not_null {name}.{column}', 'error', count(*) from {models[name]} m where {column} is null"
        for name, column in required
    ]
    for column, severity, values in (
        ("currency", "error", "'GBP'"),
        ("category", "warn", _CATEGORY_LIST),
        ("ingestion_source", "error", "'webhook', 'reconciliation'"),
    ):
        parts.append(
            f"select 'accepted_values stg_transactions.{column}', '{severity}', count(distinct {column}) "
            f"from stg where {column} not in ({values})"
        )
    for column, parent in (("account_id", "dim_account"), ("category", "dim_category")):
        parts.append(
            f"select 'relationships fct_transactions.{column} to {parent}.{column}', 'error', "
            f"count(distinct {column}) from stg "
            f"where {column} not in (select {column} from {models[parent]} m where {column} is not null)"
        )
    return " union all ".join(parts)
