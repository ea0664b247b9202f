"""Named queries over the driver's tables: one per operator.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Inputs are
always the whole tables (through the adapters in ``sources.fixtures``);
timestamps leave as wall-clock ``timestamp_ntz`` so outside readers see the
same values whatever their time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.config import AccrualRule, Columns, LedgerConfig
from ledgerflow.functions.timeutil import ts_lit, wall_clock
from ledgerflow.operators import accrual, balances, merge, quality, sampling
from ledgerflow.session import scratch_path
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import tables

COLS = Columns()
CUTOFF = fx.FIXTURE_CUTOFF
BUSINESS_DATE = fx.FIXTURE_CUTOFF.date()
RUN_ID = "fixture-run"

Query = Callable[[SparkSession, str], DataFrame]


# --- shared inputs ---------------------------------------------------------------

def tx(spark: SparkSession, sf: str) -> DataFrame:
    return fx.wallet_events(spark, sf)


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.valid_events(tx(spark, sf))


def prior(spark: SparkSession, sf: str) -> DataFrame:
    """Valid events already processed by the previous run (before the last day)."""
    return valid(spark, sf).filter(F.col("event_time") < ts_lit(fx.LAST_BATCH_START))


def last_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Valid events of the latest micro-batch (the last day)."""
    return valid(spark, sf).filter(F.col("event_time") >= ts_lit(fx.LAST_BATCH_START))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return balances.silver_balances(valid(spark, sf), CUTOFF)


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as stored by the previous run, with a column the source lacks;
    accounts ending in 5 are stored under another id, so the incoming ones are new."""
    return balances.silver_balances(_renamed(prior(spark, sf), "5", "-stored"), CUTOFF).withColumn("tag", F.lit("stored"))


def _renamed(events: DataFrame, last: str, suffix: str) -> DataFrame:
    """All events, those of accounts that end in ``last`` under a second id."""
    account = F.col("account_id")
    return events.withColumn("account_id", F.when(account.endswith(last), F.concat(account, F.lit(suffix))).otherwise(account))


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of the latest batch; accounts ending in 8 come under another id, so the stored ones stay as they are."""
    return balances.silver_balances(_renamed(last_batch(spark, sf), "8", "-incoming"), CUTOFF)


def _events_out(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", wall_clock("event_time"))


# --- Bronze ------------------------------------------------------------------------

def q_valid_rows(spark, sf):
    return _events_out(valid(spark, sf))


def q_quarantine_rows(spark, sf):
    _, bad = quality.route(tx(spark, sf))
    return _events_out(bad.select(*COLS.event_columns, quality.REASON))


def q_quarantine_reason_counts(spark, sf):
    return quality.reason_counts(tx(spark, sf))


def q_routing_conservation(spark, sf):
    return quality.routing_counts(tx(spark, sf))


def q_schema_evolution_union(spark, sf):
    """Append two batches to one table, the second with a new ``channel``
    column; read back with schema merge (older rows get NULL)."""
    path = scratch_path(spark, "schema-evolution")
    v = valid(spark, sf)
    early = v.filter(F.col("event_time") < ts_lit(CUTOFF))
    late = v.filter(F.col("event_time") >= ts_lit(CUTOFF)).withColumn(
        "channel", F.lower(F.col("transaction_type"))
    )
    tables.append(early, path)
    tables.append(late, path)
    return _events_out(tables.read_evolving(spark, path))


# --- Silver ------------------------------------------------------------------------

def q_eligibility_flag(spark, sf):
    return balances.flag_eligibility(valid(spark, sf), CUTOFF).select("event_id", "account_id", "cdi_applicable")


def q_sum_by_account_flag(spark, sf):
    return balances.sum_by_account_flag(valid(spark, sf), CUTOFF)


def q_pivot_by_flag(spark, sf):
    return balances.pivot_by_flag(valid(spark, sf), CUTOFF)


def q_silver_balances(spark, sf):
    return silver(spark, sf)


def q_silver_fold(spark, sf):
    return balances.fold(stored(spark, sf), incoming(spark, sf))


def q_fold_touched_only(spark, sf):
    return balances.fold_touched_only(stored(spark, sf), incoming(spark, sf))


def q_merge_upsert(spark, sf):
    return merge.upsert(stored(spark, sf), incoming(spark, sf), "account_id")


def q_merge_upsert_touched_only(spark, sf):
    """Upsert that joins only the target rows the source touches."""
    return merge.upsert_touched_only(stored(spark, sf), incoming(spark, sf), "account_id")


def q_merge_upsert_partial(spark, sf):
    return merge.upsert(stored(spark, sf), incoming(spark, sf), "account_id", update_cols=["total_amount"])


def q_silver_from_day_state(spark, sf):
    """Silver read out of the day-grain state folded from two batches."""
    state = balances.fold_day_state(balances.day_state(prior(spark, sf)), balances.day_state(last_batch(spark, sf)))
    return balances.accounts_at(state, CUTOFF)


def q_silver_cutoff_moved(spark, sf):
    """The same day-grain state answers an earlier cutoff without a recompute."""
    return balances.accounts_at(balances.day_state(valid(spark, sf)), CUTOFF - dt.timedelta(days=1))


def q_cutoff_from_data(spark, sf):
    return balances.data_cutoff(valid(spark, sf)).select(wall_clock("cutoff").alias("cutoff"))


def q_cutoff_from_as_of(spark, sf):
    return balances.as_of_cutoffs(valid(spark, sf)).select("as_of_date", wall_clock("cutoff").alias("cutoff"))


def q_wallet_history(spark, sf):
    return _events_out(balances.wallet_history(valid(spark, sf)))


def q_balance_intervals(spark, sf):
    b = balances.balance_intervals(valid(spark, sf))
    return b.withColumn("valid_from", wall_clock("valid_from")).withColumn("valid_to", wall_clock("valid_to"))


def q_rolling_24h_min(spark, sf):
    return balances.rolling_24h_min(valid(spark, sf))


def q_stationary_balance(spark, sf):
    return balances.stationary_balance(valid(spark, sf), CUTOFF)


def q_daily_balance(spark, sf):
    return balances.daily_balance(valid(spark, sf))


def q_daily_tumbling_flow(spark, sf):
    return balances.daily_net(valid(spark, sf))


# --- Gold --------------------------------------------------------------------------

def _gold(spark, sf, rule=AccrualRule()):
    return accrual.gold_frames(silver(spark, sf), BUSINESS_DATE, RUN_ID, rule)


def q_accrual_base(spark, sf):
    return _gold(spark, sf).audit.select("account_id", "balance_to_apply_cdi")


def q_accrual_bonus(spark, sf):
    return _gold(spark, sf).audit.select("account_id", "cdi_bonus")


def q_accrual_bonus_no_min(spark, sf):
    return _gold(spark, sf, AccrualRule(min_balance=None)).audit.select("account_id", "cdi_bonus")


def q_accrual_min_on_total(spark, sf):
    return _gold(spark, sf, AccrualRule(base="total")).audit.select("account_id", "cdi_bonus")


def q_gold_audit(spark, sf):
    return _gold(spark, sf).audit.drop("run_id")


def q_gold_daily_bonus(spark, sf):
    return _gold(spark, sf).payout.select("account_id", "cdi_bonus", "business_date")


def q_gold_account_balance(spark, sf):
    return _gold(spark, sf).balance


def q_layer_counts(spark, sf):
    """Rows per layer: raw, valid, quarantine, silver (accounts), payout
    (accounts with a non-zero bonus)."""
    r = quality.routing_counts(tx(spark, sf))
    g = _gold(spark, sf).audit.agg(
        F.count(F.lit(1)).alias("silver"), F.count(F.when(F.col("cdi_bonus") > 0, 1)).alias("payout")
    )
    bronze = r.select(
        F.explode(
            F.array(
                F.struct(F.lit("raw").alias("layer"), F.col("n_in").alias("n")),
                F.struct(F.lit("valid").alias("layer"), F.col("n_valid").alias("n")),
                F.struct(F.lit("quarantine").alias("layer"), F.col("n_bad").alias("n")),
            )
        ).alias("x")
    ).select("x.*")
    gold = g.select(
        F.explode(
            F.array(
                F.struct(F.lit("silver").alias("layer"), F.col("silver").alias("n")),
                F.struct(F.lit("payout").alias("layer"), F.col("payout").alias("n")),
            )
        ).alias("x")
    ).select("x.*")
    return bronze.unionByName(gold)


def q_rate_asof(spark, sf):
    v = valid(spark, sf)
    days = v.select(F.to_date("event_time").alias("d")).distinct()
    return accrual.rate_asof(days, fx.rates_table(spark))


def q_accrual_by_rate_date(spark, sf):
    daily = balances.daily_balance(valid(spark, sf))
    return accrual.accrual_by_rate_date(daily, fx.rates_table(spark))


def _payouts(spark, events: DataFrame) -> DataFrame:
    state = balances.day_state(events)
    daily = balances.daily_balance_from_state(state)
    return accrual.daily_payout(daily, fx.rates_table(spark), balances.day_span(state))


def q_daily_payout(spark, sf):
    return _payouts(spark, valid(spark, sf))


def q_payout_new_only(spark, sf):
    candidate = _payouts(spark, valid(spark, sf))
    published = _payouts(spark, prior(spark, sf))
    new = accrual.new_payouts_only(candidate, published)
    return new.select("account_id", F.col("d").alias("business_date"), "cdi_bonus")


def q_audit_diff(spark, sf):
    audited = accrual.with_accrual(balances.silver_balances(prior(spark, sf), CUTOFF))
    recomputed = accrual.with_accrual(silver(spark, sf))
    return accrual.audit_diff(audited, recomputed)


def q_audit_digest_diff(spark, sf):
    """The audit replay by digests: only buckets that differ are joined."""
    audited = accrual.with_accrual(balances.silver_balances(prior(spark, sf), CUTOFF))
    return accrual.audit_diff_by_digest(audited, accrual.with_accrual(silver(spark, sf)))


# --- samples -------------------------------------------------------------------------

def q_sample_rows(spark, sf):
    """A hundred events, the same at every run."""
    return _events_out(sampling.exactly(tx(spark, sf), "event_id", 100, seed=7))


def q_sample_per_type(spark, sf):
    """Twenty events of every transaction type, those without one included."""
    return _events_out(sampling.per_stratum(tx(spark, sf), "event_id", ["transaction_type"], 20, seed=7))


def q_sample_accounts(spark, sf):
    """A tenth of the accounts, with all their valid events."""
    return _events_out(sampling.share(valid(spark, sf), "account_id", 0.1, seed=7))


# --- data quality --------------------------------------------------------------------

def q_cdc_dedup(spark, sf):
    dup = fx.redelivered(valid(spark, sf), fx.LAST_BATCH_START)
    d = quality.dedup_latest(dup, "event_id", ("event_time", "amount"))
    return _events_out(d.select("event_id", "account_id", "event_time", "amount"))


def q_dq_metrics(spark, sf):
    return quality.dq_metrics(tx(spark, sf), fx.DQ_AS_OF)


def q_dq_duplicate_keys(spark, sf):
    return quality.duplicate_keys(fx.redelivered(valid(spark, sf), fx.LAST_BATCH_START), "event_id")


def q_dq_negative_balance(spark, sf):
    return balances.lowest_balance(valid(spark, sf)).filter(F.col("min_balance") < 0)


def q_dq_gold_checks(spark, sf):
    return quality.gold_checks(_gold(spark, sf).audit)


def q_volume_drop(spark, sf):
    return quality.volume_drop(tx(spark, sf), fraction=1.0)


def q_volume_outage(spark, sf):
    """Run two days after the last row: the silent day is found."""
    return quality.volume_outage(tx(spark, sf), dt.date(2024, 2, 1), spreads=1.0, least_drop=0.0)


# --- the same operators over the order-based ledger (multi-year, larger) --------------

def _orders_valid(spark, sf):
    return quality.valid_events(fx.order_events(spark, sf))


def q_gold_audit_orders(spark, sf):
    v = _orders_valid(spark, sf)
    cutoff = balances.resolve_cutoff(v, LedgerConfig())
    s = balances.silver_balances(v, cutoff)
    return accrual.gold_frames(s, cutoff.date(), RUN_ID).audit.drop("run_id")


def q_wallet_history_orders(spark, sf):
    return _events_out(balances.wallet_history(_orders_valid(spark, sf)))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
