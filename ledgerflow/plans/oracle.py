"""Independent SQL statements of every catalog query, for DuckDB.

Each statement starts from the driver's views (``events``, ``orders``) and
spells the same semantics in plain SQL with window functions, so a mismatch
points at a real difference. Money is cast to decimal(18,2) on output (the
engines widen decimal sums differently).
"""

from __future__ import annotations

M = "DECIMAL(18,2)"
CUTOFF = "TIMESTAMP '2024-01-29 00:00:00'"
LAST_BATCH = "TIMESTAMP '2024-01-30 00:00:00'"
DQ_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
BUSINESS_DATE = "DATE '2024-01-29'"
RATE = "CAST('0.00055' AS DECIMAL(9,8))"
TYPES = "('WITHDRAWAL', 'TRANSFER_OUT', 'TRANSFER_IN', 'DEPOSIT', 'WALLET_CREATED')"

TX = """
select event_id,
  case when event_id % 97 = 0 then null else cast(user_id as varchar) end as user_id,
  case when event_id % 89 = 0 then null else concat('acc-', cast(user_id as varchar)) end as account_id,
  case when event_id % 83 = 0 then null
       when event_type = 'signup' then 'WALLET_CREATED'
       when event_type = 'view' then 'DEPOSIT'
       when event_type = 'purchase' then 'WITHDRAWAL'
       when event_type = 'click' and event_id % 2 = 0 then 'TRANSFER_IN'
       when event_type = 'click' then 'TRANSFER_OUT'
       else upper(event_type) end as transaction_type,
  cast(ts as timestamp) as event_time,
  cast(case when event_type = 'signup' then 0
            when event_type = 'purchase' or (event_type = 'click' and event_id % 2 = 1) then -value
            else value end as decimal(18,2)) as amount
from events"""

ROUTED = f"""
select *,
  case when user_id is null then 'user_id_null'
       when account_id is null then 'account_id_null'
       when transaction_type is null then 'transaction_type_null'
       when transaction_type not in {TYPES} then 'transaction_type_invalid'
       when event_time is null then 'event_time_null'
       when amount is null then 'amount_null'
       when event_id is null then 'event_id_null' end as reason
from tx"""

EV = "event_id, user_id, account_id, transaction_type, event_time, amount"
VALID = f"select {EV} from routed where reason is null"
PRIOR = f"select * from valid where event_time < {LAST_BATCH}"
LAST = f"select * from valid where event_time >= {LAST_BATCH}"

WORDERS = """
select o_orderkey as event_id, cast(o_custkey as varchar) as user_id,
  concat('cust-', cast(o_custkey as varchar)) as account_id,
  case o_orderstatus when 'F' then 'WITHDRAWAL' when 'O' then 'DEPOSIT' else 'TRANSFER_IN' end as transaction_type,
  cast(o_orderdate as timestamp) as event_time,
  cast(case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end as decimal(18,2)) as amount
from orders"""

RATES = """
select * from (values
  (DATE '2024-01-01', CAST('0.00050' AS DECIMAL(9,8))),
  (DATE '2024-01-05', CAST('0.00055' AS DECIMAL(9,8))),
  (DATE '2024-01-12', CAST('0.00060' AS DECIMAL(9,8))),
  (DATE '2024-01-20', CAST('0.00045' AS DECIMAL(9,8)))
) v(rate_date, rate)"""

BASE = [("tx", TX), ("routed", ROUTED), ("valid", VALID)]


def silver_of(src: str, cutoff: str = CUTOFF) -> str:
    early = f"coalesce(sum(case when event_time < {cutoff} then amount end), 0)"
    late = f"coalesce(sum(case when not (event_time < {cutoff}) then amount end), 0)"
    return f"""
select account_id,
  cast({early} + {late} as {M}) as total_amount,
  cast({early} as {M}) as amount_cdi_applicable,
  cast({late} as {M}) as amount_cdi_not_applicable
from {src} group by account_id"""


def gold_of(silver: str, bonus: str = "threshold") -> str:
    base = (
        "cast(case when amount_cdi_not_applicable < 0 "
        "then amount_cdi_applicable + amount_cdi_not_applicable else amount_cdi_applicable end as DECIMAL(18,2))"
    )
    if bonus == "threshold":
        b = f"cast(case when b > 100 then b * {RATE} else 0 end as {M})"
    elif bonus == "none":
        b = f"cast(b * {RATE} as {M})"
    else:  # threshold on the total
        b = f"cast(case when total_amount > 100 then b * {RATE} else 0 end as {M})"
    return f"""
select account_id, total_amount, amount_cdi_applicable, amount_cdi_not_applicable,
  b as balance_to_apply_cdi, bonus as cdi_bonus, cast(bonus + total_amount as {M}) as final_balance
from (select *, {b} as bonus from (select *, {base} as b from {silver}))"""


def daily_ctes(p: str, src: str) -> list[tuple[str, str]]:
    """Daily balance of ``src`` as CTEs named ``{p}_net`` .. ``{p}_daily``."""
    return [
        (f"{p}_net", f"select account_id, cast(event_time as date) as d, cast(sum(amount) as {M}) as net from {src} group by 1, 2"),
        (f"{p}_thr", f"select max(d) as through from {p}_net"),
        (f"{p}_first", f"select account_id, min(d) as first_d from {p}_net group by 1"),
        (
            f"{p}_spine",
            f"select account_id, cast(unnest(generate_series(cast(first_d as timestamp), cast(through as timestamp), interval 1 day)) as date) as d "
            f"from {p}_first cross join {p}_thr",
        ),
        (
            f"{p}_days",
            f"select s.account_id, s.d, coalesce(n.net, 0) as net from {p}_spine s "
            f"left join {p}_net n on n.account_id = s.account_id and n.d = s.d",
        ),
        (
            f"{p}_daily",
            f"select account_id, d, cast(closing - net as {M}) as opening, cast(net as {M}) as net, closing from ("
            f"select account_id, d, net, cast(sum(net) over (partition by account_id order by d "
            f"rows between unbounded preceding and current row) as {M}) as closing from {p}_days)",
        ),
    ]


def dense_rate_ctes(p: str, through_sql: str) -> list[tuple[str, str]]:
    return [
        (
            f"{p}_spans",
            f"select rate_date, rate, least(coalesce(lead(rate_date) over (order by rate_date) - 1, ({through_sql})), ({through_sql})) as e from rates",
        ),
        (
            f"{p}_dense",
            f"select cast(unnest(generate_series(cast(rate_date as timestamp), cast(e as timestamp), interval 1 day)) as date) as d, rate "
            f"from {p}_spans where rate_date <= e",
        ),
    ]


def payout_ctes(p: str, src: str) -> list[tuple[str, str]]:
    return (
        daily_ctes(p, src)
        + dense_rate_ctes(p, f"select through from {p}_thr")
        + [
            (
                f"{p}_payout",
                f"select b.account_id, b.d, cast(case when least(b.opening, b.closing) > 100 "
                f"then least(b.opening, b.closing) * r.rate else 0 end as {M}) as cdi_bonus "
                f"from {p}_daily b join {p}_dense r on r.d = b.d",
            )
        ]
    )


def hist(src: str) -> str:
    return f"""
select account_id, event_id, event_time, amount,
  cast(sum(amount) over (partition by account_id order by event_time, event_id
       rows between unbounded preceding and current row) as {M}) as balance
from {src}"""


DUP = f"""
select {EV} from valid
union all
select event_id, user_id, account_id, transaction_type, event_time + interval 1 minute, cast(amount + 1 as {M})
from valid where event_time >= {LAST_BATCH}
union all
select event_id, user_id, account_id, transaction_type, event_time - interval 1 minute, cast(amount - 1.00 as DECIMAL(18,2)) from valid where event_id % 50 = 0
union all
select event_id, user_id, account_id, transaction_type, event_time, amount from valid where event_id % 70 = 0"""


def sql(ctes: list[tuple[str, str]], body: str) -> str:
    seen: dict[str, str] = {}
    for name, text in ctes:
        seen.setdefault(name, text)
    w = ",\n".join(f"{n} as ({t})" for n, t in seen.items())
    return f"with {w}\n{body}"


STORED = [("prior", PRIOR), ("last_batch", LAST),
          ("prior_named", "select * replace (case when account_id like '%5' then account_id || '-stored' else account_id end as account_id) from prior"),
          ("batch_named", "select * replace (case when account_id like '%8' then account_id || '-incoming' else account_id end as account_id) from last_batch"),
          ("stored", f"select *, 'stored' as tag from ({silver_of('prior_named')})"),
          ("incoming", silver_of("batch_named"))]
SILVER = [("silver", silver_of("valid"))]
GOLD = SILVER + [("gold", gold_of("silver"))]

FOLD = """
select account_id, cast(sum(total_amount) as DECIMAL(18,2)) as total_amount,
  cast(sum(amount_cdi_applicable) as DECIMAL(18,2)) as amount_cdi_applicable,
  cast(sum(amount_cdi_not_applicable) as DECIMAL(18,2)) as amount_cdi_not_applicable
from (select account_id, total_amount, amount_cdi_applicable, amount_cdi_not_applicable from stored
      union all
      select account_id, total_amount, amount_cdi_applicable, amount_cdi_not_applicable from incoming)
group by account_id"""


def _upsert(update: list[str]) -> str:
    cols = ["total_amount", "amount_cdi_applicable", "amount_cdi_not_applicable"]
    parts = []
    for c in cols:
        if c in update:
            parts.append(f"case when s.account_id is not null then s.{c} else t.{c} end as {c}")
        else:
            parts.append(f"case when t.account_id is null then s.{c} else t.{c} end as {c}")
    return (
        "select coalesce(t.account_id, s.account_id) as account_id, "
        + ", ".join(parts)
        + ", t.tag from stored t full outer join incoming s on t.account_id = s.account_id"
    )


def _first_through(src: str) -> str:
    return f"select max(cast(event_time as date)) from {src}"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["valid_rows"] = sql(BASE, "select * from valid")
    q["quarantine_rows"] = sql(BASE, f"select {EV}, reason from routed where reason is not null")
    q["quarantine_reason_counts"] = sql(BASE, "select reason, count(*) as n from routed where reason is not null group by 1")
    q["routing_conservation"] = sql(
        BASE,
        "select count(*) as n_in, count(*) filter (where reason is null) as n_valid, "
        "count(*) filter (where reason is not null) as n_bad from routed",
    )
    q["schema_evolution_union"] = sql(
        BASE,
        f"select *, cast(null as varchar) as channel from valid where event_time < {CUTOFF} "
        f"union all select *, lower(transaction_type) as channel from valid where event_time >= {CUTOFF}",
    )
    q["eligibility_flag"] = sql(BASE, f"select event_id, account_id, event_time < {CUTOFF} as cdi_applicable from valid")
    q["sum_by_account_flag"] = sql(
        BASE,
        f"select account_id, event_time < {CUTOFF} as cdi_applicable, cast(sum(amount) as {M}) as amount_sum "
        "from valid group by 1, 2",
    )
    q["pivot_by_flag"] = sql(
        BASE,
        f"select account_id, cast(sum(case when event_time < {CUTOFF} then amount end) as {M}) as early, "
        f"cast(sum(case when not (event_time < {CUTOFF}) then amount end) as {M}) as late from valid group by 1",
    )
    q["silver_balances"] = sql(BASE + SILVER, "select * from silver")
    q["silver_from_day_state"] = sql(BASE + SILVER, "select * from silver")
    q["silver_cutoff_moved"] = sql(
        BASE + [("silver_prev", silver_of("valid", "TIMESTAMP '2024-01-28 00:00:00'"))], "select * from silver_prev"
    )
    q["silver_fold"] = sql(BASE + STORED, FOLD)
    q["fold_touched_only"] = sql(BASE + STORED, FOLD)
    q["merge_upsert"] = sql(BASE + STORED, _upsert(["total_amount", "amount_cdi_applicable", "amount_cdi_not_applicable"]))
    q["merge_upsert_partial"] = sql(BASE + STORED, _upsert(["total_amount"]))
    q["merge_upsert_touched_only"] = q["merge_upsert"]
    q["cutoff_from_data"] = sql(BASE, "select date_trunc('day', max(event_time) - interval 24 hours) as cutoff from valid")
    q["cutoff_from_as_of"] = sql(
        BASE,
        "select as_of_date, cast(as_of_date as timestamp) - interval 1 day as cutoff "
        "from (select distinct cast(event_time as date) as as_of_date from valid)",
    )
    q["wallet_history"] = sql(BASE + [("hist", hist("valid"))], "select * from hist")
    q["balance_intervals"] = sql(
        BASE + [("hist", hist("valid"))],
        "select account_id, event_id, balance, event_time as valid_from, "
        "lead(event_time) over (partition by account_id order by event_time, event_id) as valid_to from hist",
    )
    q["rolling_24h_min"] = sql(
        BASE + [("hist", hist("valid"))],
        "select account_id, event_id, min(balance) over (partition by account_id order by event_time "
        "range between interval 24 hours preceding and current row) as min_balance from hist",
    )
    q["stationary_balance"] = sql(
        BASE
        + SILVER
        + [
            (
                "late_prefix",
                f"select account_id, sum(amount) over (partition by account_id order by event_time, event_id "
                f"rows between unbounded preceding and current row) as p from valid where event_time >= {CUTOFF}",
            ),
            ("low", "select account_id, min(p) as mp from late_prefix group by 1"),
        ],
        f"select s.account_id, cast(least(s.amount_cdi_applicable, s.amount_cdi_applicable + coalesce(l.mp, 0)) as {M}) as stationary, "
        f"cast(case when s.amount_cdi_not_applicable < 0 then s.amount_cdi_applicable + s.amount_cdi_not_applicable "
        f"else s.amount_cdi_applicable end as {M}) as parity_base from silver s left join low l on l.account_id = s.account_id",
    )
    q["daily_balance"] = sql(BASE + daily_ctes("v", "valid"), "select * from v_daily")
    q["daily_tumbling_flow"] = sql(
        BASE, f"select account_id, cast(event_time as date) as d, cast(sum(amount) as {M}) as net from valid group by 1, 2"
    )
    q["accrual_base"] = sql(BASE + GOLD, "select account_id, balance_to_apply_cdi from gold")
    q["accrual_bonus"] = sql(BASE + GOLD, "select account_id, cdi_bonus from gold")
    q["accrual_bonus_no_min"] = sql(BASE + SILVER + [("g", gold_of("silver", "none"))], "select account_id, cdi_bonus from g")
    q["accrual_min_on_total"] = sql(BASE + SILVER + [("g", gold_of("silver", "total"))], "select account_id, cdi_bonus from g")
    q["gold_audit"] = sql(BASE + GOLD, f"select *, {BUSINESS_DATE} as business_date from gold")
    q["gold_daily_bonus"] = sql(BASE + GOLD, f"select account_id, cdi_bonus, {BUSINESS_DATE} as business_date from gold")
    q["gold_account_balance"] = sql(
        BASE + GOLD, "select account_id, final_balance as current_balance, cdi_bonus as last_day_bonus from gold"
    )
    q["layer_counts"] = sql(
        BASE + GOLD,
        "select 'raw' as layer, count(*) as n from routed "
        "union all select 'valid', count(*) filter (where reason is null) from routed "
        "union all select 'quarantine', count(*) filter (where reason is not null) from routed "
        "union all select 'silver', count(*) from gold "
        "union all select 'payout', count(*) filter (where cdi_bonus > 0) from gold",
    )
    rates = [("rates", RATES)]
    q["rate_asof"] = sql(
        BASE + rates + dense_rate_ctes("r", _first_through("valid")),
        "select d, rate from (select distinct cast(event_time as date) as d from valid) join r_dense using (d)",
    )
    q["accrual_by_rate_date"] = sql(
        BASE + rates + daily_ctes("v", "valid"),
        f"select b.account_id, b.d, r.rate, cast(case when least(b.opening, b.closing) > 100 "
        f"then least(b.opening, b.closing) * r.rate else 0 end as {M}) as cdi_bonus "
        "from v_daily b join rates r on r.rate_date = b.d",
    )
    q["daily_payout"] = sql(BASE + rates + payout_ctes("v", "valid"), "select * from v_payout")
    q["payout_new_only"] = sql(
        BASE + [("prior", PRIOR)] + rates + payout_ctes("c", "valid") + payout_ctes("p", "prior"),
        "select c.account_id, c.d as business_date, c.cdi_bonus from c_payout c where not exists "
        "(select 1 from p_payout p where p.account_id = c.account_id and p.d = c.d)",
    )
    q["audit_diff"] = sql(
        BASE
        + [("prior", PRIOR), ("s_old", silver_of("prior")), ("g_old", gold_of("s_old"))]
        + [("s_new", silver_of("valid")), ("g_new", gold_of("s_new"))],
        "select coalesce(a.account_id, r.account_id) as account_id, a.cdi_bonus as audited_bonus, "
        "r.cdi_bonus as recomputed_bonus, a.final_balance as audited_balance, r.final_balance as recomputed_balance "
        "from g_old a full outer join g_new r on a.account_id = r.account_id "
        "where a.cdi_bonus is distinct from r.cdi_bonus or a.final_balance is distinct from r.final_balance",
    )
    q["cdc_dedup"] = sql(
        BASE + [("dup", DUP)],
        "select event_id, account_id, event_time, amount from (select *, row_number() over (partition by event_id "
        "order by event_time desc, amount desc, user_id desc, account_id desc, transaction_type desc) as rn from dup) "
        "where rn = 1",
    )
    metrics = (
        "count(*) as n, count(*) filter (where amount is null) as null_amount, "
        "count(*) filter (where user_id is null or account_id is null) as null_ids, "
        "count(*) filter (where event_id is null) as null_event_id, "
        f"count(*) filter (where event_time > {DQ_AS_OF}) as future_ts, "
        "count(*) filter (where event_time < TIMESTAMP '1970-01-01 00:00:00') as pre_epoch_ts, "
        "count(*) filter (where amount < 0) as negative_amount"
    )
    q["dq_metrics"] = sql(
        BASE,
        f"select 'raw' as layer, {metrics} from routed union all select 'valid' as layer, {metrics} from routed where reason is null",
    )
    q["dq_duplicate_keys"] = sql(BASE + [("dup", DUP)], "select event_id, count(*) as n from dup group by 1 having count(*) > 1")
    q["dq_negative_balance"] = sql(
        BASE + [("hist", hist("valid"))],
        "select account_id, min(balance) as min_balance from hist group by 1 having min(balance) < 0",
    )
    q["dq_gold_checks"] = sql(
        BASE + GOLD,
        "select count(*) as n, count(*) filter (where cdi_bonus < 0) as negative_bonus, "
        "count(*) filter (where final_balance is null) as null_final_balance, "
        "count(*) filter (where cdi_bonus > 0 and balance_to_apply_cdi <= 100) as paid_below_min, "
        "count(*) filter (where cdi_bonus = 0 and balance_to_apply_cdi > 100) as unpaid_above_min from gold",
    )
    q["volume_drop"] = sql(
        BASE,
        "select d, n, cast(m as DECIMAL(18,4)) as mean_prev_7 from ("
        "select d, n, avg(n) over (order by datediff('day', DATE '1970-01-01', d) range between 7 preceding and 1 preceding) as m "
        "from (select c.d, count(t.event_id) as n from (select cast(unnest(generate_series((select min(cast(event_time as date)) from tx), "
        "(select max(cast(event_time as date)) from tx), interval 1 day)) as date) as d) c "
        "left join tx t on cast(t.event_time as date) = c.d group by 1)) where n < 1.0 * m",
    )
    ov = [("tx", WORDERS), ("routed", ROUTED), ("valid", VALID)]
    q["gold_audit_orders"] = sql(
        ov
        + [("oc", "select date_trunc('day', max(event_time) - interval 24 hours) as c from valid")]
        + [("silver", silver_of("valid", "(select c from oc)")), ("gold", gold_of("silver"))],
        "select *, (select cast(c as date) from oc) as business_date from gold",
    )
    q["wallet_history_orders"] = sql(ov + [("hist", hist("valid"))], "select * from hist")
    q["audit_digest_diff"] = q["audit_diff"]
    place = "md5(concat('7:', cast({} as varchar)))"
    q["sample_rows"] = sql(BASE, f"select {EV} from tx order by {place.format('event_id')} limit 100")
    q["sample_per_type"] = sql(
        BASE, f"select {EV} from (select *, row_number() over (partition by transaction_type order by {place.format('event_id')}) as i from tx) where i <= 20"
    )
    q["sample_accounts"] = sql(BASE, f"select {EV} from valid where ('0x' || substr({place.format('account_id')}, 1, 8))::bigint < round(0.1 * 4294967296)")
    q["volume_outage"] = sql(
        BASE
        + [
            ("per_day", "select cast(event_time as date) as d, count(*) as n from tx where event_time is not null group by 1"),
            (
                "days",
                "select c.d, coalesce(p.n, 0) as n from (select cast(unnest(generate_series(cast((select min(d) from per_day) as timestamp), "
                "TIMESTAMP '2024-01-31', interval 1 day)) as date) as d) c left join per_day p on p.d = c.d",
            ),
            ("judged", "select d, n, list(n) over (partition by dayofweek(d) order by d rows between 8 preceding and 1 preceding) as earlier from days"),
            ("middle", "select *, list_aggregate(earlier, 'median') as expected from judged where len(earlier) >= 3"),
            ("wide", "select *, list_aggregate(list_transform(earlier, lambda x: abs(x - expected)), 'median') * 1.4826 as spread from middle"),
        ],
        "select d, n, cast(expected as decimal(18,1)) as expected, cast(spread as decimal(18,4)) as spread from wide where n < expected - spread",
    )
    # --- queries that write tables ---
    silver_sql = q["silver_balances"]
    for name in ("stream_fold", "stream_account_totals", "fold_after_recompute", "silver_five_columns", "snapshot_latest", "cutoff_from_run_date"):
        q[name] = silver_sql
    q["stream_bronze_counts"] = sql(BASE, "select case when reason is null then 'valid' else 'quarantine' end as route, count(*) as n from routed group by 1")
    q["stream_dedup"] = sql(BASE, "select event_id, account_id, event_time, amount from valid")
    twice = ("twice", "select * from valid union all select * from valid where cast(event_time as date) = DATE '2024-01-02'")
    q["stream_daily_flow"] = sql(
        BASE + [twice],
        f"select account_id, cast(event_time as date) as d, cast(sum(amount) as {M}) as net from twice "
        "where cast(event_time as date) + interval 1 day <= (select max(event_time) - interval 1 day from valid) group by 1, 2",
    )
    fixed = (
        "fixed",
        f"select event_id, user_id, account_id, transaction_type, "
        f"case when event_time >= {LAST_BATCH} then event_time + interval 1 minute else event_time end as event_time, "
        f"case when event_time >= {LAST_BATCH} then amount + 1.00 else amount end as amount from valid",
    )
    q["stream_redelivery"] = sql(BASE + [fixed], silver_of("fixed"))
    q["stream_retracting"] = q["stream_redelivery"]
    q["pipeline_balance"] = q["gold_account_balance"]
    rerun = [("s1", silver_of("prior")), ("g1", gold_of("s1")), ("s2", silver_of("valid")), ("g2", gold_of("s2"))]
    q["balance_after_rerun"] = sql(
        BASE + [("prior", PRIOR)] + rerun,
        f"select g2.account_id, cast(g2.total_amount + coalesce(g1.cdi_bonus, g2.cdi_bonus) as {M}) as current_balance, "
        f"coalesce(g1.cdi_bonus, g2.cdi_bonus) as last_day_bonus, {BUSINESS_DATE} as business_date "
        "from g2 left join g1 on g1.account_id = g2.account_id",
    )
    q["export_partitions"] = q["daily_tumbling_flow"]
    q["quarantine_time_range"] = sql(
        BASE,
        "select reason, count(*) as n from (select case "
        "when reason in ('user_id_null', 'account_id_null', 'transaction_type_null', 'transaction_type_invalid', 'event_time_null') then reason "
        "when event_id % 101 = 0 or event_id % 103 = 0 then 'event_time_out_of_range' else reason end as reason from routed) "
        "where reason is not null group by 1",
    )
    q["contract_violations"] = sql(
        BASE + SILVER,
        "select 'duplicate_key' as kind, concat(count(*), ' keys repeat') as detail from silver where account_id like '%7' having count(*) > 0 "
        "union all select 'null_value', concat('total_amount: ', count(*), ' nulls') from silver where account_id like '%3' having count(*) > 0",
    )
    again = ("again", f"select * from valid union all select * from valid where event_time >= {LAST_BATCH}")
    q["rolling_24h_min_redelivered"] = sql(
        BASE + [again, ("hist", hist("again"))],
        "select account_id, event_id, min(balance) over (partition by account_id order by event_time "
        "range between interval 24 hours preceding and current row) as min_balance from hist",
    )
    q["catalog_append"] = q["schema_evolution_union"]
    q["catalog_overwrite"] = q["daily_tumbling_flow"]
    q["catalog_pipeline"] = q["gold_account_balance"]
    for name in ("catalog_fold", "stream_from_table", "text_event_ids", "state_buckets"):
        q[name] = silver_sql
    q["gold_from_day_state"] = q["gold_account_balance"]
    q["stream_schema_change"] = sql(
        BASE,
        f"select *, cast(null as varchar) as channel from valid where event_time < {LAST_BATCH} "
        f"union all select *, lower(transaction_type) as channel from valid where event_time >= {LAST_BATCH}",
    )
    for name in ("stream_custom_types", "stream_totals_custom_types"):
        only = ("only", f"select {EV} from tx where user_id is not null and account_id is not null and transaction_type in ('DEPOSIT', 'WITHDRAWAL') "
                        "and event_time >= TIMESTAMP '2024-01-10' and event_time < TIMESTAMP '2024-01-30' and amount is not null")
        q[name] = sql([("tx", TX), only], silver_of("only"))
    deliveries = [
        ("line1", f"select max(event_time) - interval 1 day as w from valid where event_time < {LAST_BATCH}"),
        ("line2", "select max(event_time) - interval 1 day as w from valid"),
        ("second", f"select * from valid where event_time >= {LAST_BATCH} union all select * from valid where cast(event_time as date) = DATE '2024-01-29'"),
        ("third", f"select * from valid where cast(event_time as date) in (DATE '2024-01-02', DATE '2024-01-30') "
                  f"union all select event_id + 1000000000, {EV[len('event_id, '):]} from valid where cast(event_time as date) >= DATE '2024-01-28'"),
        (
            "placed",
            f"select 0 as batch, 'out' as kind, amount from valid where event_time < {LAST_BATCH} "
            f"union all select 1, case when event_time < (select w from line1) then 'late' when event_time >= {LAST_BATCH} then 'out' else 'repeat' end, amount from second "
            "union all select 2, case when event_time < (select w from line2) then 'late' when event_id >= 1000000000 then 'out' else 'repeat' end, amount from third",
        ),
    ]
    q["stream_dedup_late"] = sql(BASE + deliveries, "select cast(batch as bigint) as batch, kind, count(*) as n from placed group by 1, 2")
    q["stream_metrics"] = sql(
        BASE,
        f"select cast(case when event_time >= {LAST_BATCH} then 1 else 0 end as bigint) as batch, count(*) as rows, count(*) filter (where reason is null) as valid, "
        "count(*) filter (where reason is not null) as quarantine from routed group by 1",
    )
    return q


ORACLE_SQL: dict[str, str] = build()
