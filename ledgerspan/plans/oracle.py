"""SQL counterparts of the named queries, for DuckDB over the same tables.

Each statement is put together from the common table expressions it needs.  Sums of daily premiums and of
earned shares are taken as decimals and rounded as doubles: half cents are common there, and a plain sum of doubles decides
them by the order of its rows, so that not even two runs need agree.
Contracts are materialised because DuckDB 2.0 fails when it unnests next to dictionary-encoded text.
"""

from __future__ import annotations

# --- common table expressions ------------------------------------------------------------------

RAW = """raw as (
  select cast(o_orderkey as varchar) as transaction_id,
         case when o_orderkey % 97 = 0 then 'not a date'
              else strftime(o_orderdate + to_seconds(o_orderkey * 7919 % 86400), '%-m/%-d/%Y %-H:%M:%S')
         end as created_at,
         case when o_orderkey % 101 = 0 then 'n/a'
              when o_orderkey % 103 = 0 then '-' || cast(cast(o_totalprice as decimal(18,2)) as varchar)
              when o_orderkey % 107 = 0 then '0.00'
              else cast(cast(o_totalprice as decimal(18,2)) as varchar)
         end as premium_amount,
         'EUR' as premium_currency,
         case when o_orderkey % 113 = 0 then 'newpartner'
              when o_orderkey % 109 = 0 then null
              when o_custkey % 4 = 0 then 'berlinre'
              when o_custkey % 4 = 1 then 'dronant'
              when o_custkey % 4 = 2 then 'getland'
              else 'liadigital'
         end as charged_party,
         case when o_orderkey % 127 = 0 then 'chargeback'
              when o_orderkey % 131 = 0 then null
              when o_orderkey % 11 = 0 then 'failed'
              when o_orderstatus = 'F' then 'processed'
              when o_orderstatus = 'O' then 'process'
              when o_orderstatus = 'P' then 'refunded'
         end as status
  from orders)"""

TYPED = """typed as (
  select transaction_id, premium_currency, charged_party as party, status as status_raw,
         try_strptime(created_at, '%m/%d/%Y %H:%M:%S') as created_at_ts,
         try_cast(premium_amount as double) as premium_amount
  from raw)"""

SILVER = """silver as (
  select transaction_id,
         created_at_ts,
         cast(created_at_ts as date) as transaction_date,
         strftime(created_at_ts, '%Y-%m') as transaction_month,
         premium_amount,
         premium_currency,
         party,
         case when status_raw = 'process' then 'processed' else status_raw end as status,
         status_raw,
         status_raw = 'process' as _status_normalized,
         concat_ws(',',
           case when created_at_ts is null then 'unparseable_timestamp' end,
           case when premium_amount is null then 'unparseable_premium' end,
           case when premium_amount < 0 then 'negative_premium' end,
           case when party is null then 'missing_party' end) as _dq_flags,
         (created_at_ts is not null and premium_amount is not null and premium_amount >= 0
          {party_test}) as _is_clean,
         'orders.parquet' as _source_file
  from typed)"""

STRICT = SILVER.format(party_test="and party is not null")
LENIENT = SILVER.format(party_test="")

MONTHLY = """refunds as (
  select party, transaction_month, round(sum(premium_amount), 2) as refunded, count(*) as refund_count
  from silver
  where status_raw = 'refunded' and _is_clean and premium_amount > 0
  group by all),
written as (
  select party, transaction_month as month,
         round(sum(premium_amount), 2) as written_premium,
         round(cast(sum(cast(premium_amount as decimal(18,2))
                        * (date_diff('day', transaction_date, last_day(transaction_date)) + 1)) as double)
               / max(day(last_day(transaction_date))), 2) as earned_premium,
         count(*) as transaction_count,
         min(transaction_date) as first_transaction_date,
         max(transaction_date) as last_transaction_date
  from silver
  where status = 'processed' and _is_clean and premium_amount > 0
  group by all),
monthly as (
  select w.party, w.month, w.written_premium as premium, w.written_premium,
         coalesce(r.refunded, 0) as refunded_premium,
         coalesce(r.refund_count, 0) as refund_count,
         round(w.written_premium - coalesce(r.refunded, 0), 2) as net_premium,
         w.earned_premium, w.transaction_count, w.first_transaction_date, w.last_transaction_date
  from written w left join refunds r on r.party = w.party and r.transaction_month = w.month)"""

ACCOUNTING = """cents as (
  select party, month, cast(round(written_premium * 100) as bigint) as c,
         (cast(substr(month, 1, 4) as int) * 12 + cast(substr(month, 6, 2) as int)) % 5 as k
  from monthly),
accounting as (
  select party, month,
         case when party = 'berlinre' and month = '1995-02' then 0.0::double
              when k = 1 then cast(c * 1004 // 1000 as double) / 100
              when k = 2 then cast(c * 103 // 100 as double) / 100
              else cast(c as double) / 100 end as accounting_premium
  from cents where k <> 3
  union all select 'getland', '2010-01', 100.0::double
  union all select 'dronant', '2010-02', -50.0::double)"""

COMPARED = """compared as (
  select a.party, a.month, a.accounting_premium,
         coalesce(m.written_premium, 0.0::double) as finance_premium,
         coalesce(m.net_premium, 0.0::double) as net_premium,
         coalesce(m.refunded_premium, 0.0::double) as refunded_premium,
         coalesce(m.transaction_count, 0) as transaction_count
  from accounting a left join monthly m on m.party = a.party and m.month = a.month),
recon as (
  select party, month, accounting_premium, finance_premium, net_premium, refunded_premium,
         round(net_premium - accounting_premium, 2) as net_delta,
         transaction_count,
         round(finance_premium - accounting_premium, 2) as delta,
         round(abs(finance_premium - accounting_premium) / nullif(accounting_premium, 0) * 100, 4) as delta_pct,
         case when abs(finance_premium - accounting_premium) < 0.01 then 'MATCH'
              when abs(finance_premium - accounting_premium) / nullif(accounting_premium, 0) < 0.01 then 'NEAR_MATCH'
              else 'DISCREPANCY' end as reconciliation_status,
         abs(finance_premium - accounting_premium) < 0.01 as is_reconciled
  from compared)"""

SWEEP = """scenarios(scenario, scenario_rank, statuses) as (
  values ('processed_only', 0, ['processed']),
         ('processed_plus_refunded', 1, ['processed', 'refunded']),
         ('all_non_failed', 2, ['processed', 'refunded', 'process']),
         ('all_statuses', 3, ['processed', 'refunded', 'process', 'failed'])),
finance as (
  select scenario, party, transaction_month as month, round(sum(premium_amount), 2) as finance_premium
  from lenient s join scenarios c on list_contains(c.statuses, s.status)
  where _is_clean and premium_amount > 0
  group by all),
sweep as (
  select c.scenario, c.scenario_rank, a.party, a.month, a.accounting_premium,
         coalesce(f.finance_premium, 0.0::double) as finance_premium,
         round(coalesce(f.finance_premium, 0.0::double) - a.accounting_premium, 2) as delta
  from accounting a cross join scenarios c
  left join finance f on f.scenario = c.scenario and f.party = a.party and f.month = a.month),
totals as (
  select scenario, scenario_rank, round(cast(sum(abs(cast(delta as decimal(18,2)))) as double), 2) as total_abs_delta,
         count(*) as compared_rows
  from sweep group by all)"""

CUSTOMERS = """spans as (
  select o_custkey, cast(min(o_orderdate) as date) as first_order, cast(max(o_orderdate) as date) as last_order
  from orders group by o_custkey),
customers as materialized (
  select cast(c_custkey as varchar) as user_id,
         first_order as acquisition_date,
         first_order + cast(c_custkey % 30 as int) as started_at,
         case when c_custkey % 3 = 0 then null
              when c_custkey % 17 = 0 then first_order + cast(c_custkey % 30 as int) - 1
              else last_order end as churned_at,
         5 + (c_custkey % 2000) / 100.0::double as monthly_premium,
         lower(c_mktsegment) as product_group
  from customer join spans on o_custkey = c_custkey)"""


def mart(source: str, name: str) -> str:
    return f"""{name}_days as (
  select *, cast(unnest(generate_series(started_at, coalesce(churned_at, date '2001-08-01'), interval '1 day'))
                 as date) as activity_date
  from {source}),
{name} as (
  select activity_date, user_id, product_group, acquisition_date, started_at, churned_at,
         round(monthly_premium / day(last_day(activity_date)), 6) as daily_premium,
         monthly_premium,
         activity_date - acquisition_date as days_since_acquisition,
         strftime(activity_date, '%Y-%m') as activity_month
  from {name}_days)"""


MART = mart("customers", "mart")

CHANGES = """feed as (
  select *, case when cast(user_id as bigint) % 10 = 0 and churned_at is not null
                 then timestamp '2001-08-02' else timestamp '2001-08-01' end as updated_at
  from customers),
changes as (
  select user_id, started_at + 30 as new_end from feed where updated_at > timestamp '2001-08-01'),
updated as (
  select c.user_id, c.acquisition_date, c.started_at,
         case when x.user_id is not null then x.new_end else c.churned_at end as churned_at,
         c.monthly_premium, c.product_group
  from customers c left join changes x on x.user_id = c.user_id),
changed as materialized (select * from updated where user_id in (select user_id from changes))"""

REBUILT = mart("changed", "rebuilt")

LATER = """later as (
  select user_id, acquisition_date, started_at, churned_at,
         case when cast(user_id as bigint) % 31 = 0 then monthly_premium + 1 else monthly_premium end as monthly_premium,
         case when cast(user_id as bigint) % 37 = 0 then 'moved' else product_group end as product_group
  from updated where cast(user_id as bigint) % 23 <> 0
  union all
  select user_id || 'n', acquisition_date, started_at, churned_at, monthly_premium, product_group
  from customers where cast(user_id as bigint) % 41 = 0)"""
LATER_MART = mart("later", "mart")

HISTORY = """states as (
  select transaction_id, transaction_date, transaction_month, premium_amount, premium_currency, party, status, status_raw,
         _status_normalized, _dq_flags, _is_clean, timestamp '2001-08-01 01:00:00' as _bronze_ingested_at,
         timestamp '2001-08-01 01:00:00' as _silver_transformed_at, cast(transaction_id as bigint) as k
  from silver),
later as (
  select * replace (
         case when k % 17 = 0 then premium_amount + 1 else premium_amount end as premium_amount,
         case when k % 13 = 0 then 'refunded' else status end as status,
         case when k % 13 = 0 then 'refunded' else status_raw end as status_raw,
         timestamp '2001-08-02 01:00:00' as _silver_transformed_at)
  from states),
moved as (
  select s.k, s.k % 19 = 0 as gone,
         (s.status is distinct from l.status or s.premium_amount is distinct from l.premium_amount) as changed
  from states s join later l on l.k = s.k),
versions as (
  select s.*, timestamp '2001-08-01' as valid_from,
         case when gone or changed then timestamp '2001-08-02' end as valid_to
  from states s join moved m on m.k = s.k
  union all
  select l.*, timestamp '2001-08-02', null from later l join moved m on m.k = l.k where changed and not gone
  union all
  select l.*, timestamp '2001-08-03', null from later l join moved m on m.k = l.k where gone),
history as (
  select * exclude (k), valid_from as updated_at,
         md5(transaction_id || '|' || cast(valid_from as varchar)) as version_id
  from versions)"""

BASE = [RAW, TYPED, STRICT]
MONTHS = BASE + [MONTHLY]
RECON = MONTHS + [ACCOUNTING, COMPARED]
SWEPT = MONTHS + [ACCOUNTING, LENIENT.replace("silver as", "lenient as", 1), SWEEP]
LOOSE = [RAW, TYPED, LENIENT]
SPINE = [CUSTOMERS, MART]
CORRECTED = [CUSTOMERS, CHANGES, REBUILT, MART]
MOVED = [CUSTOMERS, CHANGES, LATER, LATER_MART]
VERSIONED = BASE + [HISTORY]


def statement(parts: list[str], select: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


# The parameters shared with the queries.
IN_RANGE = "activity_date between date '1996-01-01' and date '1996-12-31'"
UNTIL = "activity_date <= date '1998-06-30'"


def decimal_sum(column: str, digits: int, scale: int = 6) -> str:
    return f"round(cast(sum(cast({column} as decimal(18,{scale}))) as double), {digits})"


DAILY_KPI = f"""select activity_date, product_group, count(distinct user_id) as active_customers,
       {decimal_sum('daily_premium', 4)} as daily_premium_total
from mart {{where}} group by all"""

COLLECTED = f"""select product_group, {decimal_sum('daily_premium', 2)} as premium_collected
from mart where {IN_RANGE} group by all"""

ACCUMULATED = f"""select user_id, product_group, min(started_at) as started_at, max(churned_at) as churned_at,
       {decimal_sum('daily_premium', 2)} as accumulated_premium
from mart where {UNTIL} group by user_id, product_group"""

BY_MONTH = """select activity_month, count(*) as mart_rows, count(*) filter (churned_at is null) as open_rows,
       cast(sum(days_since_acquisition) as bigint) as customer_days
from {source} group by activity_month"""

UPSERTED = BY_MONTH.format(
    source="""(select m.* from mart m
      where not exists (select 1 from rebuilt r where r.user_id = m.user_id and r.activity_date = m.activity_date)
      union all select * from rebuilt)"""
)
REPLACED = BY_MONTH.format(
    source="""(select * from mart where user_id not in (select user_id from changes)
      union all select * from rebuilt)"""
)

# --- data checks -------------------------------------------------------------------------------

# The declared checks, as (table, name, check, columns, severity, accepted values).
PARTY_SET = ["berlinre", "dronant", "getland", "liadigital"]


def _null_checks(name: str, table: str, columns: str, severity: str = "error") -> list[tuple]:
    return [(name, table, "not_null", c, severity, None) for c in columns.split()]


CHECKS: list[tuple] = (
    _null_checks(
        "bronze", "raw", "transaction_id created_at premium_amount premium_currency charged_party status"
    )
    + [
        ("bronze", "raw", "accepted_values", "premium_currency", "error", ["EUR"]),
        ("bronze", "raw", "accepted_values", "charged_party", "error", PARTY_SET),
        ("bronze", "raw", "accepted_values", "status", "error", ["processed", "process", "failed", "refunded"]),
    ]
    + _null_checks("silver", "silver", "transaction_id party status")
    + _null_checks("silver", "silver", "created_at_ts", "warn")
    + [
        ("silver", "silver", "unique", "transaction_id", "warn", None),
        ("silver", "silver", "accepted_values", "party", "error", PARTY_SET),
        ("silver", "silver", "accepted_values", "status", "error", ["processed", "failed", "refunded"]),
    ]
    + _null_checks(
        "monthly",
        "monthly",
        "party month premium written_premium refunded_premium net_premium earned_premium",
    )
    + [
        ("monthly", "monthly", "accepted_values", "party", "error", PARTY_SET),
        ("monthly", "monthly", "unique_combination", "party,month", "error", None),
    ]
    + _null_checks("reconciliation", "recon", "party month accounting_premium finance_premium")
    + [
        (
            "reconciliation", "recon", "accepted_values", "reconciliation_status", "error",
            ["MATCH", "NEAR_MATCH", "DISCREPANCY"],
        ),
        ("reconciliation", "recon", "unique_combination", "party,month", "error", None),
    ]
    + _null_checks("activity", "mart", "activity_date user_id product_group daily_premium")
    + [("activity", "mart", "unique_combination", "user_id,activity_date", "error", None)]
)


def _check_sql(name, table, check, columns, severity, values) -> str:
    if check == "not_null":
        failing = f"select 1 from {table} where {columns} is null"
    elif check == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in values)
        failing = f"select {columns} from {table} where {columns} not in ({listed}) group by {columns}"
    else:
        present = f"where {columns} is not null" if check == "unique" else ""
        failing = f"select {columns} from {table} {present} group by {columns} having count(*) > 1"
    return (
        f"select '{name}' as table_name, '{check}' as check_name, '{columns}' as column_name, "
        f"'{severity}' as severity, count(*) as failures, count(*) = 0 as passed from ({failing})"
    )


GROUPED = "case when {c} is null then 'unknown' when {c} in ({known}) then {c} else 'other' end"


def _bucket(column: str, known: list[str]) -> str:
    return GROUPED.format(c=column, known=", ".join(f"'{v}'" for v in known))


def _grid(cell: str, source: str) -> str:
    """One column a party, and those of all others and of none."""
    cells = ", ".join(cell.format(p=p) + f" as {p}" for p in [*PARTY_SET, "other", "unknown"])
    return f"select month, {cells} from (select *, {_bucket('party', PARTY_SET)} as g from {source}) group by month"


WORST = """case min(case reconciliation_status when 'DISCREPANCY' then 0 when 'NEAR_MATCH' then 1 else 2 end) filter (g = '{p}')
  when 0 then 'DISCREPANCY' when 1 then 'NEAR_MATCH' when 2 then 'MATCH' end"""


def _per_status(cell: str) -> str:
    return ", ".join(cell.format(s=s) for s in ("processed", "failed", "refunded", "other", "unknown"))


CLEAN_BY_STATUS = f"""from (select *, {_bucket('status', ['processed', 'failed', 'refunded'])} as g from silver where _is_clean)
group by party, transaction_month"""


def _numbered(sql: str, order: str) -> str:
    """The rows with their place: by the named columns, then the rest by name as they stand in the query."""
    return f"select *, cast(row_number() over (order by {order}) as int) as row_number from ({sql})"


# --- statements --------------------------------------------------------------------------------

ORACLE_SQL: dict[str, str] = {
    "ingest_csv": statement([RAW], "select *, true as has_provenance from raw"),
    "reference_from_rows": statement(RECON, "select party, month, accounting_premium, finance_premium, reconciliation_status from recon"),
    "open_windows_today": statement(
        [CUSTOMERS],
        """select user_id, coalesce(churned_at, current_date) = current_date as runs_to_today,
       (coalesce(churned_at, current_date) - started_at + 1)::bigint as days
from customers where started_at <= coalesce(churned_at, current_date)""",
    ),
    "missing_input": """select 'orders' as input, count(*) as rows, '' as error from orders
union all select 'no_such_orders', null, 'PATH_NOT_FOUND'""",
    "landing_ledger": statement(
        [RAW], "select *, true as has_provenance, case when cast(transaction_id as bigint) % 2 = 0 then 'r1' else 'r2' end as landing_run from raw"
    ),
    "bronze_rows": statement([RAW], "select *, 'orders.parquet' as _source_file from raw"),
    "silver_transactions": statement(BASE, "select * from silver"),
    "silver_without_party_test": statement(LOOSE, "select transaction_id, _dq_flags, _is_clean from silver"),
    "monthly_premiums": statement(MONTHS, "select * from monthly"),
    "monthly_premiums_with_unmatched": statement(
        MONTHS,
        """select coalesce(w.party, r.party) as party, coalesce(w.month, r.transaction_month) as month,
       coalesce(w.written_premium, 0) as premium, coalesce(w.written_premium, 0) as written_premium,
       coalesce(r.refunded, 0) as refunded_premium, coalesce(r.refund_count, 0) as refund_count,
       round(coalesce(w.written_premium, 0) - coalesce(r.refunded, 0), 2) as net_premium,
       coalesce(w.earned_premium, 0) as earned_premium, coalesce(w.transaction_count, 0) as transaction_count,
       w.first_transaction_date, w.last_transaction_date
from written w full join refunds r on r.party = w.party and r.transaction_month = w.month""",
    ),
    "reconciliation": statement(RECON, "select * from recon"),
    "reconciliation_with_unmatched": statement(
        MONTHS + [ACCOUNTING],
        """, both_sides as (
  select coalesce(a.party, m.party) as party, coalesce(a.month, m.month) as month,
         coalesce(a.accounting_premium, 0.0::double) as accounting_premium,
         coalesce(m.written_premium, 0.0::double) as finance_premium,
         coalesce(m.net_premium, 0.0::double) as net_premium,
         coalesce(m.refunded_premium, 0.0::double) as refunded_premium,
         coalesce(m.transaction_count, 0) as transaction_count
  from accounting a full join monthly m on m.party = a.party and m.month = a.month)
select party, month, accounting_premium, finance_premium, net_premium, refunded_premium,
       round(net_premium - accounting_premium, 2) as net_delta, transaction_count,
       round(finance_premium - accounting_premium, 2) as delta,
       round(abs(finance_premium - accounting_premium) / nullif(abs(accounting_premium), 0) * 100, 4) as delta_pct,
       case when abs(finance_premium - accounting_premium) < 0.01 then 'MATCH'
            when abs(finance_premium - accounting_premium) / nullif(abs(accounting_premium), 0) < 0.01
              then 'NEAR_MATCH'
            else 'DISCREPANCY' end as reconciliation_status,
       abs(finance_premium - accounting_premium) < 0.01 as is_reconciled
from both_sides""",
    ).replace("\n, both_sides", ",\nboth_sides"),
    "status_sweep_detail": statement(SWEPT, "select *, abs(delta) <= 0.01 as within_tolerance from sweep"),
    "status_sweep_totals": statement(SWEPT, "select * from totals"),
    "status_sweep_best": statement(SWEPT, "select * from totals order by total_abs_delta, scenario_rank limit 1"),
    "alerts": statement(
        RECON,
        """select party, month, accounting_premium, finance_premium, delta, delta_pct, reconciliation_status,
       case when reconciliation_status = 'DISCREPANCY' and abs(delta) > 1 then 'discrepancy,large_delta'
            when reconciliation_status = 'DISCREPANCY' then 'discrepancy'
            else 'large_delta' end as alert_reason
from recon where reconciliation_status = 'DISCREPANCY' or abs(delta) > 1""",
    ),
    "gross_vs_net_gap": statement(
        RECON,
        f"""select *, net_abs_delta > gross_abs_delta as net_widens_gap from (
  select {decimal_sum('abs(delta)', 2, 2)} as gross_abs_delta,
         {decimal_sum('abs(net_delta)', 2, 2)} as net_abs_delta from recon)""",
    ),
    "refund_summary": statement(
        LOOSE,
        """select party, transaction_month, count(*) as refund_count, round(sum(premium_amount), 2) as refunded_amount
from silver where status_raw = 'refunded' group by party, transaction_month""",
    ),
    "status_breakdown": statement(
        LOOSE,
        """select party, transaction_month, status_raw, count(*) as transaction_count,
       round(sum(premium_amount), 2) as total_amount
from silver where _is_clean group by party, transaction_month, status_raw""",
    ),
    "unparseable_count": statement(
        BASE, "select count(*) as unparseable_timestamps from silver where created_at_ts is null"
    ),
    "dq_excluded_rows": statement(
        BASE,
        """select transaction_id, transaction_date, premium_amount, party, status, _dq_flags
from silver where _dq_flags <> ''""",
    ),
    "dq_flag_counts": statement(
        BASE,
        """select dq_flag, count(*) as flagged_rows, round(sum(premium_amount), 2) as flagged_amount
from (select unnest(string_split(_dq_flags, ',')) as dq_flag, premium_amount from silver where _dq_flags <> '')
group by dq_flag""",
    ),
    "cutoff_months": statement(
        BASE,
        """select transaction_month, count(*) filter (clock = 'utc') as utc_rows,
       count(*) filter (clock = 'zone') as zone_rows
from (select transaction_month, 'utc' as clock from silver where created_at_ts is not null
      union all
      select strftime((created_at_ts at time zone 'UTC') at time zone 'America/New_York', '%Y-%m'), 'zone'
      from silver where created_at_ts is not null)
group by transaction_month""",
    ),
    "cutoff_monthly_premiums": statement(
        [
            RAW,
            TYPED.replace(
                "try_strptime(created_at, '%m/%d/%Y %H:%M:%S')",
                "(try_strptime(created_at, '%m/%d/%Y %H:%M:%S') at time zone 'UTC') "
                "at time zone 'America/New_York'",
            ),
            STRICT,
            MONTHLY,
        ],
        "select * from monthly",
    ),
    "boundary_transactions": statement(
        BASE,
        """select transaction_id, created_at_ts, transaction_month, party, status, premium_amount,
       case when created_at_ts <= date_trunc('month', created_at_ts) + interval 48 hours
            then 'month_start' else 'month_end' end as boundary
from silver
where created_at_ts <= date_trunc('month', created_at_ts) + interval 48 hours
   or created_at_ts >= date_trunc('month', created_at_ts) + interval 1 month - interval 48 hours""",
    ),
    "rounding_order": statement(
        BASE
        + [
            """charged as (
  select party, transaction_month as month, premium_amount, transaction_date,
         premium_amount * cast(date_diff('day', transaction_date, last_day(transaction_date)) + 1 as double)
           / cast(day(last_day(transaction_date)) as double) as earned
  from silver where status = 'processed' and _is_clean and premium_amount > 0),
sums as (
  select party, month, round(sum(premium_amount), 2) as written_sum_then_round,
         round(sum(round(premium_amount, 2)), 2) as written_round_then_sum,
         round(cast(sum(cast(premium_amount as decimal(18,2))
                        * (date_diff('day', transaction_date, last_day(transaction_date)) + 1)) as double)
               / max(day(last_day(transaction_date))), 2) as earned_sum_then_round,
         round(sum(round(earned, 2)), 2) as earned_round_then_sum
  from charged group by party, month)"""
        ],
        """select *, round(written_round_then_sum - written_sum_then_round, 2) as written_difference,
       round(earned_round_then_sum - earned_sum_then_round, 2) as earned_difference from sums""",
    ),
    "activity_daily_rows": statement(
        SPINE,
        """select user_id, activity_month, count(*) as mart_rows, md5(string_agg(row, ',' order by row)) as rows_md5
from (
  select user_id, activity_month, concat_ws('|', activity_date, acquisition_date, started_at, coalesce(churned_at::varchar, '-'), product_group,
         cast(round(daily_premium * 1000000) as bigint), cast(round(monthly_premium * 1000000) as bigint), days_since_acquisition) as row
  from mart)
group by user_id, activity_month""",
    ),
    "activity_months": statement(
        SPINE,
        """select activity_month, product_group, count(*) as mart_rows,
       cast(sum(days_since_acquisition) as bigint) as customer_days,
       min(activity_date) as first_day, max(activity_date) as last_day
from mart group by activity_month, product_group""",
    ),
    "activity_daily_content": statement(
        SPINE,
        """select activity_month, product_group, count(*) as mart_rows,
       cast(sum(cast(user_id as bigint)) as bigint) as user_ids,
       cast(sum(activity_date - date '1970-01-01') as bigint) as activity_days,
       cast(sum((activity_date - date '1970-01-01') * cast(user_id as bigint)) as bigint) as days_by_user,
       cast(sum(acquisition_date - date '1970-01-01') as bigint) as acquisition_days,
       cast(sum(started_at - date '1970-01-01') as bigint) as start_days,
       cast(sum(churned_at - date '1970-01-01') as bigint) as churn_days,
       count(churned_at) as churned_rows,
       cast(sum(cast(round(daily_premium * 1000000) as bigint)) as bigint) as daily_micros,
       cast(sum(cast(round(monthly_premium * 100) as bigint)) as bigint) as monthly_cents,
       cast(sum(days_since_acquisition) as bigint) as customer_days
from mart group by activity_month, product_group""",
    ),
    "activity_summary": statement(SPINE, DAILY_KPI.format(where="")),
    "kpi_active_customers": statement(SPINE, DAILY_KPI.format(where=f"where {IN_RANGE}")),
    "kpi_active_customers_distinct": statement(SPINE, DAILY_KPI.format(where=f"where {IN_RANGE}")),
    "kpi_one_day": statement(SPINE, DAILY_KPI.format(where="where activity_date = date '1997-03-15'")),
    "kpi_accumulated_by_customer_window": statement(
        SPINE,
        f"""select user_id, count(*) as active_days, min(activity_date) as first_day, max(activity_date) as last_day,
       {decimal_sum('daily_premium', 2)} as premium from mart group by user_id""",
    ),
    "kpi_unrounded": statement(
        SPINE,
        f"select product_group, round(sum(daily_premium), 4) as premium_collected from mart where {IN_RANGE} group by product_group",
    ),
    "earned_premium_unrounded": statement(
        BASE,
        """select party, transaction_month as month,
       round(sum(premium_amount * cast(date_diff('day', transaction_date, last_day(transaction_date)) + 1 as double)
                 / cast(day(last_day(transaction_date)) as double)), 4) as earned_premium
from silver where status = 'processed' and _is_clean and premium_amount > 0 group by party, transaction_month""",
    ),
    "kpi_active_customers_running": statement(SPINE, DAILY_KPI.format(where="")),
    "kpi_premium_collected": statement(SPINE, COLLECTED),
    "kpi_premium_collected_contracts": statement(SPINE, COLLECTED),
    "kpi_accumulated_premium": statement(SPINE, ACCUMULATED),
    "kpi_accumulated_premium_by_user": statement(
        SPINE,
        f"""select user_id, {decimal_sum('daily_premium', 2)} as accumulated_premium
from mart where {UNTIL} group by user_id""",
    ),
    "kpi_accumulated_premium_contracts": statement(SPINE, ACCUMULATED),
    "active_on_date": statement(
        [CUSTOMERS],
        """select * from customers
where started_at <= date '1997-03-15' and coalesce(churned_at, date '2001-08-01') >= date '1997-03-15'""",
    ),
    "active_on_dates": statement(
        [CUSTOMERS],
        """select d.as_of_date, count(*) as active_customers
from (select distinct cast(o_orderdate as date) as as_of_date from orders) d
join customers c on d.as_of_date between c.started_at and coalesce(c.churned_at, date '2001-08-01')
group by d.as_of_date""",
    ),
    "active_counts_on_dates": statement(
        [CUSTOMERS],
        """select d.as_of_date, count(*) as active_customers
from (select distinct cast(o_orderdate as date) as as_of_date from orders) d
join customers c on d.as_of_date between c.started_at and coalesce(c.churned_at, date '2001-08-01')
group by d.as_of_date""",
    ),
    "changed_since": statement(
        [CUSTOMERS, CHANGES], "select * from feed where updated_at > timestamp '2001-08-01'"
    ),
    "next_watermark": statement([CUSTOMERS, CHANGES], "select max(updated_at) as watermark from feed"),
    "contract_updates": statement([CUSTOMERS, CHANGES], "select * from updated"),
    "delete_insert": statement(
        CORRECTED,
        BY_MONTH.format(
            source="""(select m.* from mart m
      where not exists (select 1 from rebuilt r where r.user_id = m.user_id and r.activity_date = m.activity_date)
      union all select * from rebuilt)"""
        ),
    ),
    "retro_truncate": statement(
        CORRECTED,
        BY_MONTH.format(
            source="""(select m.* from mart m left join changes x on x.user_id = m.user_id
      where x.user_id is null or m.activity_date <= x.new_end)"""
        ),
    ),
    "retro_replace_entities": statement(CORRECTED, REPLACED),
    "retro_impact": statement(
        CORRECTED,
        """, sides as (
  select user_id, daily_premium, true as old from mart where user_id in (select user_id from changes)
  union all select user_id, daily_premium, false from rebuilt),
sums as (
  select user_id, count(*) filter (old) as rows_before, count(*) filter (not old) as rows_after,
         coalesce(round(cast(sum(cast(daily_premium as decimal(18,6))) filter (old) as double), 2), 0)
           as amount_before,
         coalesce(round(cast(sum(cast(daily_premium as decimal(18,6))) filter (not old) as double), 2), 0)
           as amount_after
  from sides group by user_id)
select *, rows_before - rows_after as rows_removed, round(amount_before - amount_after, 2) as amount_removed
from sums""",
    ).replace("\n, sides", ",\nsides"),
    "sync_columns": statement(
        [CUSTOMERS],
        """select user_id, acquisition_date, started_at, churned_at, monthly_premium,
       cast(null as timestamp) as updated_at from customers""",
    ),
    "stored_mart_refresh": statement(CORRECTED, REPLACED),
    "stored_truncate": statement(
        CORRECTED,
        BY_MONTH.format(
            source="""(select m.* from mart m left join changes x on x.user_id = m.user_id
      where x.user_id is null or m.activity_date <= x.new_end)"""
        ),
    ),
    "stored_upsert": statement(CORRECTED, UPSERTED),
    "stored_schema_sync": statement(
        CORRECTED,
        """select activity_month, count(*) as mart_rows, count(*) filter (fresh) as with_channel, false as has_acquisition_date
from (select m.activity_month, false as fresh from mart m
      where not exists (select 1 from rebuilt r where r.user_id = m.user_id and r.activity_date = m.activity_date)
      union all select activity_month, true from rebuilt)
group by activity_month""",
    ),
    "incremental_refresh": statement(CORRECTED, f"select *, mart_rows::bigint as summary_rows from ({REPLACED})"),
    "entity_changes": statement(
        [CUSTOMERS, CHANGES, LATER],
        """select coalesce(c.user_id, l.user_id) as user_id,
       case when c.user_id is null then 'new' when l.user_id is null then 'gone' else 'changed' end as change
from customers c full join later l on l.user_id = c.user_id
where c.user_id is null or l.user_id is null
   or (c.acquisition_date, c.started_at, c.churned_at, c.monthly_premium, c.product_group)
      is distinct from (l.acquisition_date, l.started_at, l.churned_at, l.monthly_premium, l.product_group)""",
    ),
    "contracts_refresh": statement(MOVED, BY_MONTH.format(source="mart")),
    "summary_by_differences": statement(MOVED, DAILY_KPI.format(where="")),
    "scd2_history": statement(VERSIONED, "select * from history"),
    "scd2_as_of": statement(
        VERSIONED,
        """select * from history where valid_from <= timestamp '2001-08-02 12:00:00'
  and (valid_to is null or valid_to > timestamp '2001-08-02 12:00:00')""",
    ),
    "stored_snapshots": statement(VERSIONED, "select * from history"),
    "stored_as_of": statement(
        VERSIONED,
        """select * from history where valid_from <= timestamp '2001-08-02 12:00:00'
  and (valid_to is null or valid_to > timestamp '2001-08-02 12:00:00')""",
    ),
    "dq_not_null": statement(BASE, "select transaction_id from silver where party is null"),
    "dq_accepted_values": statement(
        [RAW],
        """select status as value_field, count(*) as n_records from raw
where status not in ('processed', 'failed') group by status""",
    ),
    "dq_unique": "select l_orderkey, count(*) as n_records from lineitem "
    "where l_orderkey is not null group by l_orderkey having count(*) > 1",
    "dq_unique_combination": "select l_orderkey, l_linenumber, count(*) as n_records from lineitem "
    "group by l_orderkey, l_linenumber having count(*) > 1",
    "dq_suite": statement(
        RECON + SPINE,
        "\nunion all ".join(_check_sql(*c) for c in CHECKS),
    ),
    "dq_by_month": statement(
        [
            CUSTOMERS,
            CHANGES,
            MART,
            """held as (
  select * from mart m where not exists (select 1 from changes x where x.user_id = m.user_id and m.activity_date > x.new_end)),
found as (
  select 'not_null' as check_name, 'activity_date' as column_name, count(*) filter (activity_date is null) as failures from held
  union all select 'not_null', 'user_id', count(*) filter (user_id is null) from held
  union all select 'not_null', 'product_group', count(*) filter (product_group is null) from held
  union all select 'not_null', 'daily_premium', count(*) filter (daily_premium is null) from held
  union all select 'unique_combination', 'user_id,activity_date', count(*) from (
    select 1 from held group by user_id, activity_date having count(*) > 1)
  union all select 'accepted_values', 'product_group', count(distinct product_group) filter (
    product_group not in ('building', 'machinery', 'household')) from held)""",
        ],
        "select 'activity' as table_name, check_name, column_name, 'error' as severity, failures, failures = 0 as passed from found",
    ),
    "rpt_written_pivot": statement(
        MONTHS, _grid("coalesce(round(sum(written_premium) filter (g = '{p}'), 2), 0.0::double)", "monthly")
    ),
    "rpt_written_vs_earned": statement(
        MONTHS,
        f"""select *, round(written_premium - earned_premium, 2) as unearned_premium from (
  select month, {decimal_sum('written_premium', 2, 2)} as written_premium,
         {decimal_sum('earned_premium', 2, 2)} as earned_premium from monthly group by month)""",
    ),
    "rpt_finance_vs_accounting": statement(
        RECON,
        "select party, month, finance_premium, accounting_premium, delta, delta >= -0.01 as is_ok from recon",
    ),
    "rpt_delta_series": statement(RECON, "select party, month, delta, reconciliation_status from recon"),
    "rpt_status_matrix": statement(RECON, _grid(WORST, "recon")),
    "rpt_status_totals": statement(
        RECON,
        "select reconciliation_status, count(*) as party_months from recon group by reconciliation_status",
    ),
    "rpt_status_counts": statement(
        BASE,
        "select party, transaction_month as month, "
        + _per_status("count(*) filter (g = '{s}') as {s}")
        + ", count(*) as total "
        + CLEAN_BY_STATUS,
    ),
    "rpt_status_amounts": statement(
        BASE,
        "select party, transaction_month as month, "
        + _per_status("coalesce(round(sum(premium_amount) filter (g = '{s}'), 2), 0) as {s}")
        + " "
        + CLEAN_BY_STATUS,
    ),
    "rpt_party_totals": statement(
        MONTHS,
        f"select party, {decimal_sum('written_premium', 2, 2)} as total_written_premium from monthly group by party",
    ),
    "rpt_delta_pct": statement(
        RECON,
        """select party, month, delta_pct, reconciliation_status, delta_pct >= 1 as above_threshold from recon""",
    ),
}

ORACLE_SQL |= {
    "rpt_delta_series_ordered": statement(
        RECON, _numbered("select party, month, delta, reconciliation_status from recon", "party nulls last, month nulls last")
    ),
    "rpt_sweep_ordered": statement(
        SWEPT,
        _numbered("select *, abs(delta) <= 0.01 as within_tolerance from sweep", "scenario_rank, party nulls last, month nulls last"),
    ),
    "rpt_status_breakdown_ordered": statement(
        LOOSE,
        _numbered(
            """select party, transaction_month, status_raw, count(*) as transaction_count,
       round(sum(premium_amount), 2) as total_amount
from silver where _is_clean group by party, transaction_month, status_raw""",
            "party nulls last, transaction_month nulls last, status_raw nulls last",
        ),
    ),
    "rpt_refunds_ordered": statement(
        LOOSE,
        _numbered(
            """select party, transaction_month, count(*) as refund_count, round(sum(premium_amount), 2) as refunded_amount
from silver where status_raw = 'refunded' group by party, transaction_month""",
            "party nulls last, transaction_month nulls last",
        ),
    ),
    "rpt_kpi_days_ordered": statement(
        SPINE, _numbered(DAILY_KPI.format(where=f"where {IN_RANGE}"), "activity_date, product_group nulls last")
    ),
    "rpt_party_totals_ordered": statement(
        MONTHS,
        _numbered(
            f"select party, {decimal_sum('written_premium', 2, 2)} as total_written_premium from monthly group by party",
            "total_written_premium desc nulls last, party nulls last",
        ),
    ),
    "layer_rows": statement(
        MONTHS + [ACCOUNTING],
        """select 'bronze' as layer, count(*) as written, count(*) as held, 0::bigint as stamped from raw
union all select 'silver', count(*), count(*), count(*) from raw
union all select 'seeds', count(*), count(*), 0 from accounting""",
    ),
    "accounting_from_csv": statement(MONTHS + [ACCOUNTING], "select * from accounting"),
}
