"""What each registered query must return, stated independently in SQL.

The statements start from the driver tables, so they restate the views and the operators
together. Money leaves as DOUBLE, dates and arrays as text, as in the queries.
"""

from __future__ import annotations

# ---- shared statements ---------------------------------------------------------------

RAW_LOANS = """
paid as (
  select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey
), raw as (
  select
    case when o_orderkey % 211 = 0 then 'Total rows ' || o_orderkey
         else cast(o_orderkey as varchar) end as id,
    case when o_orderkey % 223 = 0 then 'n/a'
         else strftime(o_orderdate, '%b-%Y') end as issue_d,
    case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end as term,
    case when o_custkey % 37 = 0 then floor(o_totalprice / 360) * 360
         else o_totalprice end as loan_amnt,
    o_totalprice as funded_amnt,
    case when o_orderkey % 509 = 0 then null when o_custkey % 37 = 0 then 0.0
         else 5 + o_custkey % 20 end::double as int_rate,
    o_totalprice / case when o_orderkey % 3 = 0 then 60 else 36 end as installment,
    substr('ABCDEFG', cast(1 + o_custkey % 7 as int), 1) as grade,
    substr('ABCDEFG', cast(1 + o_custkey % 7 as int), 1)
      || cast(1 + o_orderkey % 5 as varchar) as sub_grade,
    o_orderpriority as purpose,
    'NATION_' || (o_custkey % 25) as addr_state,
    cast(20000 + (o_custkey % 1000) * 100 as double) as annual_inc,
    cast(o_custkey % 400 as double) / 10 as dti,
    case when o_orderkey % 29 = 0 then 'Joint App' else 'Individual' end as application_type,
    case o_custkey % 3 when 0 then 'RENT' when 1 then 'OWN' else 'MORTGAGE' end as home_ownership,
    case when o_custkey % 17 = 0 then null
         else (o_custkey % 10) || ' years' end as emp_length,
    case when o_custkey % 2 = 0 then 'Verified' else 'Not Verified' end as verification_status,
    cast(600 + o_custkey % 200 as double) as fico_range_low,
    cast(604 + o_custkey % 200 as double) as fico_range_high,
    case when o_orderstatus = 'O' then 'Current'
         when o_orderstatus = 'F' and o_orderkey % 19 = 0
           then 'Does not meet the credit policy. Status:Fully Paid'
         when o_orderstatus = 'F' then 'Fully Paid'
         when o_orderkey % 23 = 0 then 'Default'
         when o_orderkey % 19 = 0 then 'Does not meet the credit policy. Status:Charged Off'
         else 'Charged Off' end as loan_status,
    o_totalprice / 2 as out_prncp, o_totalprice / 4 as total_pymnt,
    o_totalprice / 8 as total_rec_prncp,
    case when shipped > o_orderdate then strftime(shipped, '%b-%Y') end as last_pymnt_d,
    case when o_orderstatus = 'P' then o_totalprice * 0.05::double end as recoveries
  from orders left join paid on l_orderkey = o_orderkey
)"""

MASTER = RAW_LOANS + """, master as (
  select id, cast(try_strptime('01-' || issue_d, '%d-%b-%Y') as date) as issue_d,
    loan_amnt, funded_amnt, int_rate, installment, grade, sub_grade, purpose, addr_state,
    annual_inc, dti, application_type, home_ownership, emp_length, verification_status,
    fico_range_low, fico_range_high, loan_status, out_prncp, total_pymnt, total_rec_prncp,
    cast(try_strptime('01-' || last_pymnt_d, '%d-%b-%Y') as date) as last_pymnt_d, recoveries,
    try_cast(regexp_extract(term, '[0-9]+') as int) as term_months,
    substr(sha256('lc-' || id), 1, 16) as customer_id,
    'LC-' || id as exposure_id
  from raw
  where regexp_full_match(id, '[0-9]+')
    and try_strptime('01-' || issue_d, '%d-%b-%Y') is not null
)"""


def position(dates: str) -> str:
    """The book on each of some dates, step by step as the lifecycle is described."""
    return MASTER + f""", snaps as (
  select unnest([{dates}]) as snapshot_date
), aged as (
  select master.*, snapshot_date,
    (year(snapshot_date) - year(issue_d)) * 12 + month(snapshot_date) - month(issue_d) as m,
    (year(snapshot_date) - year(coalesce(last_pymnt_d, issue_d))) * 12
      + month(snapshot_date) - month(coalesce(last_pymnt_d, issue_d)) as pm,
    loan_status in ('Charged Off', 'Default',
      'Does not meet the credit policy. Status:Charged Off') as dfl,
    loan_status in ('Fully Paid',
      'Does not meet the credit policy. Status:Fully Paid') as stl,
    coalesce(date_diff('day', last_pymnt_d, snapshot_date), 0) as days
  from master join snaps on issue_d <= snapshot_date
), paying as (
  select *, greatest(m - pm, 0) as months_paid, m > greatest(m - pm, 0) as stopped from aged
), late as (
  select *, case when dfl and stopped then greatest(days, 0) else 0 end as dpd,
    stl and stopped as gone,
    pow(1 + int_rate / 100.0::double / 12.0::double, term_months) as g_end,
    pow(1 + int_rate / 100.0::double / 12.0::double,
      greatest(0, least(term_months,
        least(m, case when dfl or stl then months_paid else m end)))) as g_now,
    greatest(0, least(term_months,
      least(m, case when dfl or stl then months_paid else m end))) as elapsed
  from paying
), staged as (
  select *,
    case when gone then 'closed' when dpd >= 180 then 'written_off'
         when dpd >= 90 then 'defaulted' when dpd > 0 then 'past_due'
         else 'performing' end as status,
    case when gone or dpd >= 180 then 0.0::double
         else greatest(0, coalesce(case when g_end = 1
           then loan_amnt * (1 - elapsed::double / greatest(term_months, 1))
           else loan_amnt * (g_end - g_now) / (g_end - 1) end, 0)) end as outstanding_amount
  from late
  where case when dpd >= 180 then dpd - 180 when gone then days else 0 end <= 30
), book as (
  select * exclude (m, pm, dfl, stl, days, months_paid, stopped, gone, g_end, g_now, elapsed, dpd),
    dpd as days_past_due,
    status = 'defaulted' as default_flag,
    case when status = 'defaulted'
      then greatest(outstanding_amount - coalesce(recoveries, 0), 0) else 0.0::double end
      as provision_amount
  from staged
)"""


ON_DATE = "date '1998-12-31'"
MONTHS = (
    "date '1998-09-30', date '1998-10-31', date '1998-11-30', date '1998-12-31', "
    "date '1999-01-31'"
)


def conformed(source: str, name: str = "silver") -> str:
    """Silver types. Computed amounts go to cents by their digits: scaling the double first
    would round 445131.52499999997 up."""
    return f""", {name} as (
  select exposure_id, customer_id, issue_d as origination_date, term_months,
    cast(issue_d + to_months(term_months) as date) as maturity_date,
    try_cast(loan_amnt as decimal(18,2)) as original_amount,
    try_cast(outstanding_amount::varchar as decimal(18,2)) as outstanding_amount,
    try_cast(provision_amount::varchar as decimal(18,2)) as provision_amount,
    try_cast(int_rate as decimal(6,4)) as interest_rate,
    grade as rating_grade, sub_grade as rating_subgrade, status, days_past_due, default_flag,
    purpose, addr_state as region,
    try_cast(annual_inc as decimal(18,2)) as annual_income,
    try_cast(dti as decimal(8,4)) as debt_to_income,
    cast(fico_range_low as int) as fico_low, cast(fico_range_high as int) as fico_high,
    home_ownership, emp_length, verification_status, application_type, snapshot_date
  from {source}
)"""


BROKEN = """, broken as (
  select * replace (
    case when n % 50 = 0 then 'Z' else grade end as grade,
    case when n % 97 = 0 then -5 else days_past_due end as days_past_due,
    case when n % 101 <> 0 then customer_id end as customer_id,
    case when n % 103 = 0 then outstanding_amount * 3 else outstanding_amount end
      as outstanding_amount)
  from (select *, cast(substr(exposure_id, 4) as bigint) as n from book)
)"""

SILVER = position(ON_DATE) + conformed("book")
SILVER_MONTHS = position(MONTHS) + conformed("book")
BROKEN_SILVER = position(ON_DATE) + BROKEN + conformed("broken")


def tagged(source: str, rules: dict[str, str], name: str = "tagged") -> str:
    """Names of the broken rules as joined text; an undefined condition breaks nothing."""
    cases = ",\n    ".join(
        f"case when not ({cond}) then '{rule}' end" for rule, cond in rules.items()
    )
    return f""", {name} as (
  select *, concat_ws(',', {cases}) as failed_rules from {source}
)"""


EXPOSURE_RULES = {
    "exposure_id_present": "exposure_id is not null",
    "customer_id_present": "customer_id is not null",
    "original_amount_positive": "original_amount > 0",
    "outstanding_not_negative": "outstanding_amount >= 0",
    "outstanding_within_original":
        "outstanding_amount::double <= original_amount::double * 1.1::double",
    "days_past_due_not_negative": "days_past_due >= 0",
    "default_flag_matches_status": "(status = 'defaulted') = default_flag",
    "past_due_has_days_past_due": "status <> 'past_due' or days_past_due > 0",
    "provision_within_outstanding": "provision_amount <= outstanding_amount",
    "rating_grade_known": "rating_grade in ('A', 'B', 'C', 'D', 'E', 'F', 'G')",
    "interest_rate_plausible": "interest_rate between 0 and 100",
}
BROKEN_TAGGED = BROKEN_SILVER + tagged("silver", EXPOSURE_RULES)


def sent(date: str, source: str = "silver") -> str:
    return f""", sent as (
  select {date} as reporting_date, exposure_id, customer_id, 'retail_other' as exposure_class,
    original_amount, outstanding_amount, 0::decimal(18,2) as undrawn_amount, 'USD' as currency,
    rating_grade, rating_subgrade, origination_date, maturity_date, term_months, interest_rate,
    status, days_past_due, default_flag,
    case when status = 'defaulted'
      then cast({date} - to_days(days_past_due - 90) as date) end as default_date,
    provision_amount, false as collateral_flag, 0::decimal(18,2) as collateral_value,
    purpose, region
  from {source} where outstanding_amount > 0 or status = 'defaulted'
)"""


SENT_COLUMNS = [
    "reporting_date", "exposure_id", "customer_id", "exposure_class", "original_amount",
    "outstanding_amount", "undrawn_amount", "currency", "rating_grade", "rating_subgrade",
    "origination_date", "maturity_date", "term_months", "interest_rate", "status",
    "days_past_due", "default_flag", "default_date", "provision_amount", "collateral_flag",
    "collateral_value", "purpose", "region",
]

INPUT_RULES = {
    "reporting_date_present": "reporting_date is not null",
    "exposure_id_present": "exposure_id is not null",
    "customer_id_present": "customer_id is not null",
    "exposure_class_present": "exposure_class is not null",
    "exposure_class_allowed": "exposure_class in ('retail_other')",
    "original_amount_present": "original_amount is not null",
    "original_amount_min": "original_amount >= 0",
    "outstanding_amount_present": "outstanding_amount is not null",
    "outstanding_amount_min": "outstanding_amount >= 0",
    "undrawn_amount_present": "undrawn_amount is not null",
    "undrawn_amount_min": "undrawn_amount >= 0",
    "currency_present": "currency is not null",
    "currency_allowed": "currency in ('USD')",
    "rating_grade_present": "rating_grade is not null",
    "rating_grade_allowed": "rating_grade in ('A', 'B', 'C', 'D', 'E', 'F', 'G')",
    "rating_subgrade_present": "rating_subgrade is not null",
    "origination_date_present": "origination_date is not null",
    "maturity_date_present": "maturity_date is not null",
    "term_months_present": "term_months is not null",
    "term_months_allowed": "term_months in (36, 60)",
    "interest_rate_present": "interest_rate is not null",
    "interest_rate_min": "interest_rate >= 0",
    "status_present": "status is not null",
    "status_allowed": "status in ('performing', 'past_due', 'defaulted')",
    "days_past_due_present": "days_past_due is not null",
    "days_past_due_min": "days_past_due >= 0",
    "default_flag_present": "default_flag is not null",
    "provision_amount_present": "provision_amount is not null",
    "provision_amount_min": "provision_amount >= 0",
    "collateral_flag_present": "collateral_flag is not null",
    "collateral_value_present": "collateral_value is not null",
    "collateral_value_min": "collateral_value >= 0",
    "purpose_present": "purpose is not null",
    "region_present": "region is not null",
    "reporting_date_is_month_end": "reporting_date = last_day(reporting_date)",
    "outstanding_within_original": "outstanding_amount <= original_amount * 1.1",
    "defaulted_carries_flag": "(status = 'defaulted') = default_flag",
    "past_due_has_days": "status <> 'past_due' or days_past_due > 0",
    "defaulted_at_ninety_days": "status <> 'defaulted' or days_past_due >= 90",
    "provision_within_outstanding": "provision_amount <= outstanding_amount",
    "provision_only_when_defaulted": "status = 'defaulted' or provision_amount = 0",
    "default_date_when_defaulted": "status <> 'defaulted' or default_date is not null",
    "maturity_after_origination": "maturity_date > origination_date",
}
INPUT_TAGGED = BROKEN_SILVER + sent(ON_DATE) + tagged("sent", INPUT_RULES)

RWA = """, weighted as (
  select reporting_date, exposure_id, customer_id, rating_grade, status,
    case when status = 'defaulted'
      then greatest(outstanding_amount - provision_amount, 0::decimal(18,2))
      else outstanding_amount end::decimal(18,2) as ead,
    case when status = 'defaulted' then 1.50
      else case rating_grade when 'A' then 0.20 when 'B' then 0.35 when 'C' then 0.55
        when 'D' then 0.75 when 'E' then 1.00 when 'F' then 1.25 when 'G' then 1.50 end
      end::decimal(6,4) as risk_weight
  from sent
), rwa as (
  select *, (ead * risk_weight)::decimal(18,2) as rwa,
    (ead * risk_weight * 0.08::decimal(2,2))::decimal(18,2) as capital_required
  from weighted
)"""
RWA_ON_DATE = SILVER + sent(ON_DATE) + RWA
RWA_MONTHS = SILVER_MONTHS + sent("snapshot_date") + RWA

FAULTY_RETURN = RWA_ON_DATE + """, returned as (
  select reporting_date, exposure_id,
    case when rating_grade = 'C' then ead + 0.50::decimal(18,2) else ead end as ead
  from rwa where rating_grade <> 'G' or status <> 'performing'
)"""

MEASURED = """, period as (
  select reporting_date, count(*)::double as exposure_count, sum(ead)::double as total_ead,
    sum(rwa)::double as total_rwa
  from rwa group by reporting_date
), measured as (
  select reporting_date, unnest(['exposure_count', 'total_ead', 'total_rwa']) as measure,
    unnest([exposure_count, total_ead, total_rwa]) as value
  from period
), moves as (
  select measure, lag(reporting_date) over w as previous_period, reporting_date as period,
    lag(value) over w as previous, value as current
  from measured window w as (partition by measure order by reporting_date)
)"""

TXN = """
bronze as (
  select 1 + cast(floor(epoch(ts - timestamp '2024-01-01') / 3600) as int) as step,
    case event_type when 'purchase' then 'TRANSFER' when 'error' then 'CASH_OUT'
      when 'click' then 'PAYMENT' when 'view' then 'CASH_IN' else 'DEBIT' end as type,
    value as amount, 'C' || user_id as name_orig,
    round(case when event_id % 10 = 0 then value else value * (2 + event_id % 5) end, 2)
      as old_balance_orig,
    round(case when event_id % 10 = 0 then 0 else value * (1 + event_id % 5) end, 2)
      as new_balance_orig,
    'M' || user_id || '-' || (event_id % 40) as name_dest,
    round(value * 3, 2) as old_balance_dest, round(value * 4, 2) as new_balance_dest,
    case when event_id % 10 = 0 and event_id % 70 <> 0
      and event_type in ('purchase', 'error') then 1 else 0 end as is_fraud,
    case when event_id % 630 = 0 then 1 else 0 end as is_flagged_fraud,
    cast(user_id % 6 as int) as kafka_partition, event_id as kafka_offset
  from events
)"""


def conformed_txn(source: str) -> str:
    return f""", txn as (
  select step, type, amount::decimal(18,2) as amount, name_orig,
    old_balance_orig::decimal(18,2) as old_balance_orig,
    new_balance_orig::decimal(18,2) as new_balance_orig, name_dest,
    old_balance_dest::decimal(18,2) as old_balance_dest,
    new_balance_dest::decimal(18,2) as new_balance_dest, is_fraud, kafka_offset, kafka_partition
  from {source}
)"""


SILVER_TXN = TXN + conformed_txn("bronze")
BROKEN_TXN = TXN + """, spoiled as (
  select * replace (
    case when kafka_offset % 97 <> 0 then amount end as amount,
    case when kafka_offset % 89 = 0 then 'REFUND' else type end as type,
    case when kafka_offset % 101 = 0 then -1.0 else old_balance_orig end as old_balance_orig,
    case when kafka_offset % 103 <> 0 then name_dest end as name_dest,
    case when kafka_offset % 107 = 0 then 2 else is_fraud end as is_fraud)
  from bronze
)""" + conformed_txn("spoiled")
REPLAYED = SILVER_TXN + """, replayed as (
  select * from txn union all select * from txn where type = 'TRANSFER'
)"""

TXN_RULES = {
    "step_present": "step is not null",
    "step_min": "step >= 1",
    "type_present": "type is not null",
    "type_allowed": "type in ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT')",
    "amount_present": "amount is not null",
    "amount_min": "amount >= 0",
    "name_orig_present": "name_orig is not null",
    "old_balance_orig_present": "old_balance_orig is not null",
    "old_balance_orig_min": "old_balance_orig >= 0",
    "new_balance_orig_present": "new_balance_orig is not null",
    "new_balance_orig_min": "new_balance_orig >= 0",
    "name_dest_present": "name_dest is not null",
    "old_balance_dest_present": "old_balance_dest is not null",
    "old_balance_dest_min": "old_balance_dest >= 0",
    "new_balance_dest_present": "new_balance_dest is not null",
    "new_balance_dest_min": "new_balance_dest >= 0",
    "is_fraud_present": "is_fraud is not null",
    "is_fraud_allowed": "is_fraud in (0, 1)",
    "kafka_offset_present": "kafka_offset is not null",
    "kafka_offset_min": "kafka_offset >= 0",
    "amount_positive": "amount > 0",
    "known_party": "name_orig is not null and name_dest is not null",
    "debit_balance_consistent":
        "type not in ('TRANSFER', 'CASH_OUT', 'DEBIT', 'PAYMENT') "
        "or abs(old_balance_orig - new_balance_orig - amount) <= 1 or new_balance_orig = 0",
}

# What the kinds of spoiled message leave to be read.
SPOILED = """, messages as (
  select *, case kind when 1 then 'unreadable' when 2 then 'unreadable'
    when 3 then 'unreadable' when 4 then 'no destination' when 5 then 'amount is text'
    else 'readable' end as state
  from (select *, (kafka_offset % 7)::int as kind from bronze)
)"""

# Sweep, drain, velocity and structuring, with the limits scaled to the event amounts.
RULES = SILVER_TXN + """, moved as (
  select *, timestamp '2018-01-01' + to_hours(step) as event_time
  from txn where type in ('TRANSFER', 'CASH_OUT')
), swept as (
  select * from moved
  where old_balance_orig > 0 and abs(amount - old_balance_orig) <= 1.0
), drained as (
  select * from moved
  where new_balance_orig = 0 and old_balance_orig > 0 and amount >= 100
), velocity as (
  select window_start, window_start + to_hours(2) as window_end, name_orig,
    count(*) as txn_count, sum(amount) as total_amount, max(is_fraud) as any_fraud
  from (
    select *, date_trunc('hour', event_time) - to_hours(slide) as window_start
    from moved, (values (0), (1)) as slides(slide)
  )
  group by window_start, name_orig
  having count(*) >= 3 or sum(amount) >= 200
), structuring as (
  select date_trunc('day', event_time) as window_start, name_orig,
    count(*) as txn_count, sum(amount) as total_amount, max(is_fraud) as any_fraud
  from moved where amount >= 40 and amount < 200
  group by 1, 2
  having count(*) >= 2 and sum(amount) >= 100
), alerts as (
  select step, name_orig, name_dest, type, amount, 'whole_account_sweep' as rule,
    is_fraud as label from swept
  union all
  select step, name_orig, name_dest, type, amount, 'drain', is_fraud from drained
  union all
  select cast(epoch(window_start - timestamp '2018-01-01') / 3600 as int), name_orig, null, null,
    total_amount, 'velocity', any_fraud from velocity
  union all
  select cast(epoch(window_start - timestamp '2018-01-01') / 3600 as int), name_orig, null, null,
    total_amount, 'structuring', any_fraud from structuring
)"""

# What the stream lets through: the one defect in the events is a zero amount.
STREAMED = TXN + """, fit as (select * from bronze where amount > 0)""" + conformed_txn("fit")
STREAMED_RULES = STREAMED + RULES[len(SILVER_TXN):]

VELOCITY_COLUMNS = """window_start::varchar as window_start, window_end::varchar as window_end,
    name_orig, txn_count, total_amount::double as total_amount, 'velocity' as rule,
    case when txn_count >= 3 then 'count' else 'amount' end as breach_type, any_fraud"""
STRUCTURING_COLUMNS = """window_start::varchar as window_start, name_orig, txn_count,
    total_amount::double as total_amount, 'structuring' as rule"""
SWEEP_COLUMNS = """name_orig, name_dest, type, amount::double as amount, is_fraud as label"""

# Every name against every entry: the plain statement of what the screening must find.
NAMES = """
suppliers as (
  select s_suppkey, substr(letters, 1, 7) || ' ' || substr(letters, 8, 8) as s_name
  from (select s_suppkey, translate(md5(s_suppkey::varchar), '0123456789abcdef', 'aeiounrstlmdkvbz') as letters
        from supplier)
), listed as (
  select 'WL-' || substr(sha256(name), 1, 8) as entity_id, name,
    case substr(sha256(name), 2, 1) when '0' then 'SDN' when '1' then 'EU' else 'UN' end
      as program
  from (select distinct p_name as name from part union all select s_name from suppliers)
), accounts as (
  select user_id, k, user_id * 40 + k as n
  from (select distinct user_id, event_id % 40 as k from events)
), based as (
  select user_id, k, n, case when n % 3 = 0 then s_name else p_name end as base
  from accounts join part on p_partkey = n % (select max(p_partkey) + 1 from part)
    join suppliers on s_suppkey = n % (select count(*) from supplier)
), named as (
  select 'M' || user_id || '-' || k as name_dest,
    case n % 11 when 0 then substr(base, 1, length(base) - 1)
      when 1 then replace(base, ' ', '  ') when 2 then replace(base, 'e', 'i')
      when 3 then upper(base)
      else chr(cast(97 + n % 26 as int)) || '. ' || split_part(base, ' ', 2) || ' '
        || split_part(base, ' ', 1) end as dest_name,
    n % 11 < 4 as seeded_hit
  from based
), scored as (
  select key, entity_id, program, jaro_winkler_similarity(key, lower(name)) as score
  from (select distinct lower(dest_name) as key from named), listed
)"""


def screened(threshold: float) -> str:
    return NAMES + f""", best as (
  select *, row_number() over (partition by key order by score desc, entity_id) as place
  from scored where score >= {threshold}
), hits as (
  select name_dest, dest_name, seeded_hit, entity_id as watchlist_entity, program,
    round(score, 3) as match_score
  from named join best on key = lower(dest_name) and place = 1
)"""


VERSIONS = """
versioned as (
  select l_suppkey as part, year(l_shipdate)::bigint as version, l_orderkey, l_linenumber,
    cast(l_quantity * 1000 as bigint) as bytes
  from lineitem
), commits as (
  select month_start::timestamp as committed_at, count(*) as added_rows,
    (year(month_start) * 12 + month(month_start))::bigint as version
  from (select date_trunc('month', o_orderdate) as month_start from orders)
  group by month_start
)"""

EXPOSURE_COLUMNS = """exposure_id, customer_id, origination_date::varchar as origination_date,
    term_months, maturity_date::varchar as maturity_date,
    original_amount::double as original_amount, outstanding_amount::double as outstanding_amount,
    provision_amount::double as provision_amount, interest_rate::double as interest_rate,
    rating_grade, rating_subgrade, status, days_past_due, default_flag, purpose, region"""

PROFILED = [
    "id", "issue_d", "term", "loan_amnt", "funded_amnt", "int_rate", "installment", "grade",
    "sub_grade", "purpose", "addr_state", "annual_inc", "dti", "application_type",
    "home_ownership", "emp_length", "verification_status", "fico_range_low", "fico_range_high",
    "loan_status", "out_prncp", "total_pymnt", "total_rec_prncp", "last_pymnt_d", "recoveries",
]


def _each(template: str, names: list[str]) -> str:
    return " union all ".join(template.format(c=name) for name in names)


ORACLES: dict[str, str] = {
    "loan_master": f"""with {MASTER}
        select * replace (issue_d::varchar as issue_d, last_pymnt_d::varchar as last_pymnt_d)
        from master""",
    "csv_loans": f"""with {MASTER}
        select * replace (issue_d::varchar as issue_d, last_pymnt_d::varchar as last_pymnt_d)
        from master""",
    "loan_rejects": f"""with {RAW_LOANS}, judged as (
          select regexp_full_match(id, '[0-9]+') as keyed,
            try_strptime('01-' || issue_d, '%d-%b-%Y') is not null as dated from raw)
        select count(*) as rows_read, count(*) filter (not keyed) as rejected_key,
          count(*) filter (keyed and not dated) as rejected_issue_date,
          count(*) filter (keyed and dated) as rows_kept from judged""",
    "portfolio_as_of": f"""with {position(ON_DATE)}
        select exposure_id, status, days_past_due, default_flag,
          round(outstanding_amount, 2) as outstanding_amount,
          round(provision_amount, 2) as provision_amount,
          snapshot_date::varchar as snapshot_date from book""",
    "portfolio_months": f"""with {position(MONTHS)}
        select snapshot_date::varchar as snapshot_date, exposure_id, status, days_past_due,
          round(outstanding_amount, 2) as outstanding_amount from book""",
    "portfolio_metrics": f"""with {SILVER_MONTHS}
        select snapshot_date::varchar as snapshot_date, count(*) as row_count,
          coalesce(sum(outstanding_amount) filter (outstanding_amount > 0), 0)::double
            as live_balance,
          count(*) filter (status = 'performing') as performing,
          count(*) filter (status = 'past_due') as past_due,
          count(*) filter (status = 'defaulted') as defaulted,
          coalesce(sum(provision_amount), 0)::double as total_provision,
          round(coalesce(sum(outstanding_amount) filter (status = 'defaulted'), 0)::double
            / greatest(coalesce(sum(outstanding_amount) filter (outstanding_amount > 0), 0)::double,
                       1) * 100, 6) as npl_pct
        from silver group by silver.snapshot_date""",
    "arrival_gaps": f"""with {SILVER_MONTHS}, expected as (
          select unnest([date '1998-08-31', {MONTHS}, date '1999-02-28']) as d)
        select d::varchar as snapshot_date, count(exposure_id) as row_count
        from expected left join silver on snapshot_date = d group by d""",
    "conform_exposure": f"""with {SILVER}
        select {EXPOSURE_COLUMNS}, annual_income::double as annual_income,
          debt_to_income::double as debt_to_income, fico_low, fico_high, home_ownership,
          emp_length, verification_status, application_type,
          snapshot_date::varchar as snapshot_date from silver""",
    "exposure_quarantine": f"""with {BROKEN_TAGGED}
        select exposure_id, rating_grade, failed_rules from tagged where failed_rules <> ''""",
    "exposure_passed": f"""with {BROKEN_TAGGED}
        select exposure_id, status, rating_grade, outstanding_amount::double as outstanding_amount
        from tagged where failed_rules = ''""",
    "quarantine_by_rule": f"""with {BROKEN_TAGGED}
        select rule, count(*) as row_count from (
          select unnest(string_split(failed_rules, ',')) as rule from tagged
          where failed_rules <> '') group by rule""",
    "quarantine_by_combination": f"""with {BROKEN_TAGGED}
        select failed_rules, count(*) as row_count from tagged where failed_rules <> ''
        group by failed_rules""",
    "quarantine_by_size": f"""with {BROKEN_TAGGED}
        select len(string_split(failed_rules, ',')) as broken, count(*) as row_count
        from tagged where failed_rules <> '' group by 1""",
    "engine_input_rows": f"""with {SILVER} {sent(ON_DATE)}
        select reporting_date::varchar as reporting_date, exposure_class,
          undrawn_amount::double as undrawn_amount, currency,
          default_date::varchar as default_date, collateral_flag,
          collateral_value::double as collateral_value, {EXPOSURE_COLUMNS} from sent""",
    "contract_input_split": f"""with {INPUT_TAGGED}
        select exposure_id, failed_rules from tagged""",
    "contract_assertions": f"""with {INPUT_TAGGED}, tally as (
          select count(*) filter (failed_rules = '') as kept,
            count(*) filter (failed_rules <> '') as dropped,
            count(distinct case when failed_rules = '' then (exposure_id, reporting_date) end)
              as keys
          from tagged)
        select 1 as position, 'min_rows' as assertion, (kept + dropped)::double as observed,
          1.0::double as required, kept + dropped < 1 as breached from tally
        union all
        select 2, 'unique_grain', (kept - keys)::double, 0.0, kept <> keys from tally
        union all
        select 3, 'max_quarantine_pct',
          round(coalesce(dropped::double / nullif(kept + dropped, 0) * 100, 0), 6), 1.0,
          coalesce(dropped::double / nullif(kept + dropped, 0) * 100, 0) > 1.0 from tally""",
    "scope_report": f"""with {SILVER_MONTHS}
        select snapshot_date::varchar as snapshot_date, count(*) as silver_rows,
          count(*) filter (outstanding_amount > 0 or status = 'defaulted') as engine_input_rows,
          count(*) filter (not (outstanding_amount > 0 or status = 'defaulted')) as excluded_rows
        from silver group by silver.snapshot_date""",
    "rwa_output": f"""with {RWA_ON_DATE}
        select reporting_date::varchar as reporting_date, exposure_id, customer_id, rating_grade,
          status, ead::double as ead, risk_weight::double as risk_weight, rwa::double as rwa,
          capital_required::double as capital_required from rwa""",
    "rwa_published": f"""with {RWA_ON_DATE}
        select reporting_date::varchar as reporting_date, exposure_id, rating_grade,
          ead::double as ead, rwa::double as rwa, capital_required::double as capital_required
        from rwa""",
    "duplicate_halts": f"""with {SILVER} {sent(ON_DATE)}
        select status, count(*) as row_count, sum(outstanding_amount)::double as balance,
          (select count(*) from sent where status = 'defaulted') || ' rows duplicate the grain' as halt
        from sent group by status""",
    "schema_breaks": f"""with {SILVER} {sent(ON_DATE)}
        select column_name, 'refused' as outcome, (select count(*) from sent) as row_count
        from (select unnest([{", ".join(f"'{c}'" for c in SENT_COLUMNS)}]) as column_name)""",
    "total_rwa": f"""with {RWA_ON_DATE}
        select coalesce(sum(rwa), 0)::double as total_rwa from rwa""",
    "reconcile_totals": f"""with {FAULTY_RETURN}
        select (select count(*) from rwa) as sent_count,
          (select count(*) from returned) as returned_count,
          (select sum(ead)::double from rwa) as sent_ead,
          (select sum(ead)::double from returned) as returned_ead""",
    "reconcile_breaks": f"""with {FAULTY_RETURN}
        select a.reporting_date::varchar as reporting_date, a.exposure_id,
          case when b.exposure_id is null then 'dropped' else 'distorted' end as kind,
          a.ead::double as ead_sent, b.ead::double as ead_returned
        from rwa a left join returned b on a.exposure_id = b.exposure_id
          and a.reporting_date = b.reporting_date
        where b.exposure_id is null or a.ead <> b.ead""",
    "rwa_monthly_trend": f"""with {RWA_MONTHS}
        select reporting_date::varchar as reporting_date, count(*) as exposure_count,
          sum(ead)::double as total_ead, sum(rwa)::double as total_rwa,
          sum(capital_required)::double as total_capital,
          round(sum(rwa)::double / nullif(sum(ead), 0)::double, 4) as avg_risk_weight
        from rwa group by rwa.reporting_date""",
    "capital_by_grade": f"""with {RWA_MONTHS}
        select reporting_date::varchar as reporting_date, rating_grade,
          count(*) as exposure_count, sum(ead)::double as total_ead, sum(rwa)::double as total_rwa,
          sum(capital_required)::double as total_capital
        from rwa where reporting_date = (select max(reporting_date) from rwa)
        group by rwa.reporting_date, rating_grade""",
    "conform_txn": f"""with {SILVER_TXN}
        select step, type, amount::double as amount, name_orig,
          old_balance_orig::double as old_balance_orig,
          new_balance_orig::double as new_balance_orig, name_dest,
          old_balance_dest::double as old_balance_dest,
          new_balance_dest::double as new_balance_dest, is_fraud, kafka_offset, kafka_partition
        from txn""",
    "txn_contract_split": f"""with {BROKEN_TXN} {tagged("txn", TXN_RULES)}
        select kafka_partition, kafka_offset, failed_rules from tagged""",
    "poison_payloads": f"""with {TXN} {SPOILED}
        select kind, case state
            when 'unreadable' then 11
            when 'no destination' then 2 + (amount = 0)::int
            when 'amount is text' then 1
            else (amount = 0)::int end as broken,
          count(*) as row_count
        from messages group by all""",
    "skip_malformed": f"""with {TXN} {SPOILED}
        select kafka_offset, step, type, name_orig from messages where state <> 'unreadable'""",
    "sweep_alerts": f"""with {RULES}
        select step, {SWEEP_COLUMNS}, old_balance_orig::double as old_balance_orig,
          'whole_account_sweep' as rule from swept""",
    "drain_alerts": f"""with {RULES}
        select step, name_orig, type, amount::double as amount,
          old_balance_orig::double as old_balance_orig, 'drain' as rule, is_fraud as any_fraud
        from drained""",
    "velocity_alerts": f"with {RULES} select {VELOCITY_COLUMNS} from velocity",
    "structuring_alerts": f"with {RULES} select {STRUCTURING_COLUMNS} from structuring",
    "alerts_all": f"""with {RULES}
        select step, name_orig, coalesce(name_dest, '-') as name_dest, coalesce(type, '-') as type,
          amount::double as amount, rule, label from alerts""",
    "rule_scorecard": f"""with {RULES}, fraud as (select sum(is_fraud)::bigint as n from txn)
        select rule, count(*) as alert_count, sum(label)::bigint as true_positive,
          (count(*) - sum(label))::bigint as false_positive,
          (any_value(n) - sum(label))::bigint as false_negative,
          round(sum(label)::double / any_value(n), 6) as recall,
          round(sum(label)::double / count(*), 6) as precision
        from alerts, fraud where rule in ('whole_account_sweep', 'drain') group by rule""",
    "flag_baseline": f"""with {TXN}
        select count(*) as row_count, sum(is_fraud)::bigint as fraud_count,
          sum(is_flagged_fraud)::bigint as flagged_count,
          round(sum(is_flagged_fraud)::double / greatest(sum(is_fraud), 1) * 100, 6)
            as flag_recall_pct
        from bronze""",
    "alerts_by_rule": f"""with {RULES}
        select rule, count(*) as alert_count, sum(label)::bigint as true_fraud,
          round(sum(label)::double / count(*), 4) as precision from alerts group by rule""",
    "alerts_by_type": f"""with {RULES}
        select type, count(*) as alert_count, sum(label)::bigint as true_fraud,
          sum(amount)::double as total_amount,
          (sum(amount)::decimal(38,2) / count(*))::decimal(18,2)::double as avg_amount
        from alerts where rule in ('whole_account_sweep', 'drain') group by type""",
    "watchlist_screen": f"with {screened(0.9)} select * from hits",
    "watchlist_screen_shuffled": f"with {screened(0.85)} select * from hits",
    "screen_top10": f"""with {screened(0.9)}
        select * from hits order by match_score desc, name_dest limit 10""",
    "drift_measures": f"""with {RWA_MONTHS} {MEASURED}
        select reporting_date::varchar as period, measure, round(value, 2) as value from measured""",
    "drift_moves": f"""with {RWA_MONTHS} {MEASURED}
        select measure, previous_period::varchar as previous_period, period::varchar as period,
          previous, current, round(current / previous, 6) as ratio,
          case when current = previous then 'unchanged'
            when abs(current / previous - 1) > 0.05 then 'drift' else 'within' end as kind
        from moves where previous_period is not null""",
    "drift_breaches": f"""with {RWA_MONTHS.replace(
            "), rwa as (", "), exact as (")}, rwa as (
          select * replace (
            ead * case when reporting_date = {ON_DATE} then 100 else 1 end as ead,
            rwa * case when reporting_date = {ON_DATE} then 100 else 1 end as rwa)
          from exact) {MEASURED}, judged as (
          select *, case when current = previous then 'unchanged'
            when abs(current / previous - 1) > 0.25 then 'drift' end as kind
          from moves where previous_period is not null)
        select measure, previous_period::varchar as previous_period, period::varchar as period,
          previous, current, round(current / previous, 6) as ratio, kind,
          case when kind = 'unchanged'
            then format('{{}}: unchanged at {{:,.2f}}', measure, current)
            else format('{{}}: {{:,.2f}} -> {{:,.2f}} ({{:,.2f}}x)', measure, previous, current,
              current / previous) end as text
        from judged where kind is not null""",
    "profile_columns": f"with {RAW_LOANS} " + _each(
        "select '{c}' as column_name, round(count({c}) * 100.0::double / count(*), 6) "
        "as non_null_pct, count(distinct {c}) as distinct_count from raw", PROFILED),
    "null_rates": f"with {RAW_LOANS} " + _each(
        "select '{c}' as column_name, "
        "round((count(*) - count({c})) * 100.0::double / count(*), 6) as null_pct from raw",
        PROFILED),
    "category_frequencies": f"with {RAW_LOANS} " + _each(
        "select '{c}' as column_name, {c}::varchar as value, count(*) as row_count, "
        "round(count(*) * 100.0::double / (select count(*) from raw), 6) as share_pct "
        "from raw where {c} is not null group by {c}",
        ["grade", "loan_status", "term", "purpose", "application_type", "emp_length"]),
    "rows_per_year": f"""with {RAW_LOANS}
        select right(issue_d, 4) as year, count(*) as row_count from raw
        where issue_d is not null group by 1""",
    "fraud_by_type": f"""with {SILVER_TXN}, types as (
          select unnest(['PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT']) as type)
        select types.type, count(txn.type) as row_count,
          coalesce(sum(is_fraud), 0)::bigint as fraud_count,
          round(coalesce(sum(is_fraud)::double * 100 / nullif(count(txn.type), 0), 0), 6)
            as fraud_pct,
          round(coalesce(sum(amount)::double / nullif(count(txn.type), 0), 0), 6) as avg_amount
        from types left join txn on txn.type = types.type group by types.type""",
    "amount_stats": f"""with {SILVER_TXN}
        select is_fraud, count(*) as row_count,
          round(median(amount::double), 6) as median_amount,
          round(sum(amount)::double / count(*), 6) as mean_amount,
          max(amount)::double as max_amount
        from txn group by is_fraud""",
    "loan_amount_median": f"""with {MASTER}
        select grade, round(median(loan_amnt), 6) as median from master group by grade""",
    "drain_signature": f"""with {SILVER_TXN}, marked as (
          select is_fraud, new_balance_orig = 0 and old_balance_orig > 0 as drained from txn)
        select count(*) filter (is_fraud = 1) as fraud_count,
          count(*) filter (drained and is_fraud = 1) as drained_fraud,
          count(*) filter (drained and is_fraud <> 1) as drained_legit,
          round(count(*) filter (drained and is_fraud = 1) * 100.0::double
            / greatest(count(*) filter (is_fraud = 1), 1), 6) as drained_fraud_pct
        from marked""",
    "step_span": f"""with {SILVER_TXN}
        select min(step) as first_step, max(step) as last_step,
          round((max(step) - min(step) + 1)::double / 24, 6) as span_days from txn""",
    "duplicate_grain": f"""with {REPLAYED}
        select name_orig, step, kafka_offset, count(*) as copies from replayed
        group by name_orig, step, kafka_offset having count(*) > 1""",
    "stream_positions": f"""with {REPLAYED}
        select count(*) as row_count,
          count(distinct kafka_partition || ':' || kafka_offset) as position_count
        from replayed""",
    "dedupe_stream": f"""with {REPLAYED}
        select distinct kafka_partition, kafka_offset, type, amount::double as amount
        from replayed""",
    "report_tests": f"""with {RWA_MONTHS.strip()}, {RULES.strip()}, trend as (
          select reporting_date, sum(capital_required) as total_capital
          from rwa group by reporting_date
        ), grades as (
          select rating_grade from rwa
          where reporting_date = (select max(reporting_date) from rwa) group by rating_grade
        ), by_rule as (
          select rule, sum(label) / count(*) as precision from alerts group by rule
        ), by_type as (select type from alerts group by type)
        select 'rwa_monthly_trend' as model, 'reporting_date' as column_name, 'not_null' as test,
          count(*) filter (reporting_date is null) as failures from trend
        union all select 'rwa_monthly_trend', 'reporting_date', 'unique',
          count(reporting_date) - count(distinct reporting_date) from trend
        union all select 'rwa_monthly_trend', 'total_capital', 'not_null',
          count(*) filter (total_capital is null) from trend
        union all select 'capital_by_grade', 'rating_grade', 'not_null',
          count(*) filter (rating_grade is null) from grades
        union all select 'alerts_by_rule', 'rule', 'not_null',
          count(*) filter (rule is null) from by_rule
        union all select 'alerts_by_rule', 'rule', 'unique',
          count(rule) - count(distinct rule) from by_rule
        union all select 'alerts_by_rule', 'precision', 'not_null',
          count(*) filter (precision is null) from by_rule
        union all select 'alerts_by_type', 'type', 'not_null',
          count(*) filter (type is null) from by_type
        union all select 'alerts_by_type', 'type', 'unique',
          count(type) - count(distinct type) from by_type""",
    "read_as_of": f"""with {VERSIONS}
        select part, version, l_orderkey, l_linenumber, bytes from (
          select *, max(version) over (partition by part) as live
          from versioned where version <= 1998)
        where version = live""",
    "storage_audit": f"""with {VERSIONS}, marked as (
          select *, version = max(version) over (partition by part) as live from versioned)
        select (select count(*) from commits) as snapshots,
          count(*) filter (live) as live_files,
          (sum(bytes) filter (live))::bigint as live_bytes,
          count(*) as all_files, sum(bytes)::bigint as all_bytes,
          (sum(bytes) - sum(bytes) filter (live))::bigint as held_by_history,
          round((sum(bytes) - sum(bytes) filter (live))::double * 100
            / (sum(bytes) filter (live))::double, 6) as overhead_pct
        from marked""",
    "retention_plan": f"""with {VERSIONS}
        select count(*) as snapshots,
          count(*) filter (committed_at < timestamp '1999-06-30' - to_days(30))
            as older_than_cutoff,
          greatest(0, least(count(*) filter (committed_at < timestamp '1999-06-30' - to_days(30)),
            count(*) - 5)) as expirable
        from commits""",
    "latest_commits": f"""with {VERSIONS}
        select committed_at::varchar as committed_at, added_rows, version
        from commits order by commits.committed_at desc limit 10""",
    "landing_plan": f"""with {SILVER_MONTHS}
        select snapshot_date::varchar as snapshot_date, count(*) as row_count,
          case snapshot_date when date '1998-10-31' then 'new' when {ON_DATE} then 'replaced'
            else 'present' end as state
        from silver group by silver.snapshot_date""",
    "partition_rerun": f"""with {SILVER_MONTHS}
        select snapshot_date::varchar as snapshot_date, count(*) as row_count,
          sum(outstanding_amount)::double as balance
        from silver where snapshot_date <> {ON_DATE} or status = 'performing'
        group by silver.snapshot_date""",
    "landed_partitions": f"""with {SILVER_MONTHS}
        select snapshot_date::varchar as snapshot_date, count(*) as row_count,
          sum(outstanding_amount)::double as balance
        from silver group by silver.snapshot_date""",
    "compacted_rows": f"""with {SILVER_MONTHS}
        select snapshot_date::varchar as snapshot_date, count(*) as row_count,
          sum(outstanding_amount)::double as balance
        from silver group by silver.snapshot_date""",
    "alerts_published": f"""with {RULES}
        select rule, count(*) as alert_count from alerts group by rule""",
    "replay_head": f"""with {TXN}
        select step, kafka_offset as position, name_orig as key
        from bronze order by step, kafka_offset limit 500""",
    "replay_messages": f"""with {TXN}
        select step, kafka_offset as position, name_orig as key, type, amount, old_balance_orig,
          name_dest, is_fraud from bronze""",
    "stream_silver": f"""with {STREAMED}
        select step, type, amount::double as amount, name_orig, name_dest, is_fraud, kafka_offset
        from txn""",
    "stream_rerun": f"""with {STREAMED}
        select count(*) as row_count, count(distinct kafka_offset) as position_count from txn""",
    "stream_after_lost_checkpoint": f"""with {STREAMED}
        select step, type, amount::double as amount, name_orig, name_dest, is_fraud, kafka_offset
        from txn""",
    "stream_dedupe": f"""with {TXN}
        select kafka_offset, type, amount, name_orig from bronze""",
    "stream_sweep": f"with {STREAMED_RULES} select {SWEEP_COLUMNS} from swept",
    # Append mode emits a window once the watermark has passed its end.
    "stream_velocity": f"""with {STREAMED_RULES} select {VELOCITY_COLUMNS} from velocity
        where window_end <= (select max(event_time) - to_hours(3) from moved)""",
    # The end of the log closes the windows that the watermark alone would leave open.
    "stream_structuring": f"with {STREAMED_RULES} select {STRUCTURING_COLUMNS} from structuring",
}
