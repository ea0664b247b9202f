"""Gold: accrual base, bonus, balances, daily rates, payouts, audit replay."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.config import AccrualRule, Columns
from ledgerflow.functions.rules import accrual_base, bonus, final_balance
from ledgerflow.operators.balances import day_span

@dataclass(frozen=True)
class GoldFrames:
    audit: DataFrame
    payout: DataFrame
    balance: DataFrame


def with_accrual(silver: DataFrame, rule: AccrualRule = AccrualRule(), cols: Columns = Columns()) -> DataFrame:
    """Silver + ``balance_to_apply_cdi``, ``cdi_bonus``, ``final_balance``."""
    base = accrual_base(F.col(cols.amount_cdi_applicable), F.col(cols.amount_cdi_not_applicable))
    s = silver.withColumn(cols.balance_to_apply_cdi, base)
    # base="total": the threshold tests total_amount; the rate still applies to the accrual base
    gate = F.col(cols.total_amount) if rule.base == "total" else None
    bon = bonus(F.col(cols.balance_to_apply_cdi), rule, gate=gate)
    return s.withColumn(cols.cdi_bonus, bon).withColumn(
        cols.final_balance, final_balance(F.col(cols.cdi_bonus), F.col(cols.total_amount))
    )


def gold_frames(
    silver: DataFrame,
    business_date: dt.date,
    run_id: str,
    rule: AccrualRule = AccrualRule(),
    cols: Columns = Columns(),
) -> GoldFrames:
    """The three Gold outputs, all keyed by (account, business_date, run_id).

    ``cdi_bonus_date`` (the statement time) is lineage only; the natural key
    of a payout is the account plus the business date.
    """
    a = with_accrual(silver, rule, cols).select(
        *cols.silver_columns,
        cols.balance_to_apply_cdi,
        cols.cdi_bonus,
        cols.final_balance,
        F.lit(business_date).alias(cols.business_date),
        F.lit(run_id).alias(cols.run_id),
    )
    payout = a.select(
        cols.account_id,
        cols.cdi_bonus,
        cols.business_date,
        cols.run_id,
        F.current_timestamp().alias(cols.cdi_bonus_date),
    )
    balance = a.select(
        cols.account_id,
        F.col(cols.final_balance).alias(cols.current_balance),
        F.col(cols.cdi_bonus).alias(cols.last_day_bonus),
    )
    return GoldFrames(a, payout, balance)


# --- rates ---------------------------------------------------------------------

def dense_rates(rates: DataFrame, span: DataFrame) -> DataFrame:
    """``d, rate``: one row per calendar day of ``span`` (one row ``_since,
    _through``, see ``balances.day_span``) that has a rate in force; a day
    without its own rate takes the latest earlier one.

    The window runs over the rate table itself (one row per rate change).
    """
    w = Window.orderBy("rate_date")
    spans = unique_rates(rates).select("rate_date", "rate", F.date_sub(F.lead("rate_date").over(w), 1).alias("_until"))
    inside = spans.join(F.broadcast(span), F.col("rate_date") <= F.col("_through"))  # one row
    start, end = F.greatest("rate_date", "_since"), F.least(F.coalesce("_until", "_through"), F.col("_through"))
    return inside.filter(start <= end).select(F.explode(F.sequence(start, end)).alias("d"), "rate")


def unique_rates(rates: DataFrame) -> DataFrame:
    """``rate_date, rate``; the job fails if a date repeats (two rates for one
    day would pay it twice, or at random)."""
    g = rates.groupBy("rate_date").agg(F.count(F.lit(1)).alias("_n"), F.any_value("rate").alias("rate"))
    repeated = F.raise_error(F.concat(F.lit("rate table repeats "), F.col("rate_date").cast("string")))
    return g.select(F.when(F.col("_n") > 1, repeated).otherwise(F.col("rate_date")).alias("rate_date"), "rate")


def rate_asof(days: DataFrame, rates: DataFrame) -> DataFrame:
    """``d, rate`` for each day in ``days`` (column ``d``) that has a rate in force."""
    return days.join(dense_rates(rates, day_span(days)), "d")


def accrual_by_rate_date(daily: DataFrame, rates: DataFrame, rule: AccrualRule = AccrualRule(), cols: Columns = Columns()) -> DataFrame:
    """``account_id, d, rate, cdi_bonus`` on days whose rate is published that
    very day (exact date match; the join strategy is left to AQE)."""
    r = unique_rates(rates).select(F.col("rate_date").alias("d"), "rate")
    j = daily.join(r, "d")
    base = F.least(F.col("opening"), F.col("closing"))
    return j.select(cols.account_id, "d", "rate", bonus(base, rule, F.col("rate")).alias(cols.cdi_bonus))


def daily_payout(
    daily: DataFrame,
    rates: DataFrame,
    span: DataFrame,
    rule: AccrualRule = AccrualRule(),
    cols: Columns = Columns(),
) -> DataFrame:
    """``account_id, d, cdi_bonus`` per calendar day with the as-of rate.

    The day's base is least(opening, closing), the parity rule applied to one
    calendar day; the threshold is strict. Days before the first rate are not
    paid. ``span`` (one row) must cover the days of ``daily``.
    """
    j = daily.join(dense_rates(rates, span), "d")
    base = F.least(F.col("opening"), F.col("closing"))
    return j.select(cols.account_id, "d", bonus(base, rule, F.col("rate")).alias(cols.cdi_bonus))


def new_payouts_only(candidate: DataFrame, published: DataFrame, keys=("account_id", "d")) -> DataFrame:
    """Idempotent publish: rows of ``candidate`` whose key is not yet published."""
    return candidate.join(published.select(*keys), list(keys), "left_anti")


#: Buckets of accounts whose digests an audit replay compares first.
DIGEST_BUCKETS = 4096


def digests(rows: DataFrame, buckets: int = DIGEST_BUCKETS, cols: Columns = Columns()) -> DataFrame:
    """``bucket, n, sum, xor`` over accounts, bonuses and balances: equal rows give
    equal digests in any order, with partial results map-side."""
    hashed = F.xxhash64(*[F.col(c).cast("string") for c in (cols.account_id, cols.cdi_bonus, cols.final_balance)])
    # a missing value and its neighbour's text must not hash alike
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in (cols.cdi_bonus, cols.final_balance)])
    rows = rows.select(_bucket(buckets, cols).alias("bucket"), hashed.alias("h"), F.xxhash64(F.lit("x"), hashed, nulls).alias("x"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("sum"), F.bit_xor("x").alias("xor"))


def _bucket(buckets: int, cols: Columns):
    return F.pmod(F.xxhash64(F.col(cols.account_id)), F.lit(buckets)).cast("int")


def audit_diff_by_digest(audited: DataFrame, recomputed: DataFrame, buckets: int = DIGEST_BUCKETS, cols: Columns = Columns()) -> DataFrame:
    """The rows of ``audit_diff``, with accounts joined only in buckets whose digests differ.

    Both sides are reduced to one digest per bucket first; the numbers of the
    buckets that differ, at most ``buckets``, are broadcast, and rows of equal
    buckets leave both scans before the shuffle. A replay that agrees, the
    usual case, joins nothing.
    """
    a, r = digests(audited, buckets, cols).alias("a"), digests(recomputed, buckets, cols).alias("r")
    same = F.lit(True)
    for c in ("n", "sum", "xor"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"r.{c}"))
    differ = a.join(r, F.col("a.bucket") == F.col("r.bucket"), "full_outer").filter(~same).select(F.coalesce("a.bucket", "r.bucket").alias("_bucket"))
    inside = lambda rows: rows.withColumn("_bucket", _bucket(buckets, cols)).join(F.broadcast(differ), "_bucket", "left_semi")
    return audit_diff(inside(audited), inside(recomputed), cols)


def audit_diff(audited: DataFrame, recomputed: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Accounts whose audited bonus or final balance differs from a replay:
    ``account_id, audited_bonus, recomputed_bonus, audited_balance,
    recomputed_balance`` (an account missing on one side counts as a difference)."""
    a = audited.select(
        cols.account_id,
        F.col(cols.cdi_bonus).alias("audited_bonus"),
        F.col(cols.final_balance).alias("audited_balance"),
    )
    r = recomputed.select(
        cols.account_id,
        F.col(cols.cdi_bonus).alias("recomputed_bonus"),
        F.col(cols.final_balance).alias("recomputed_balance"),
    )
    j = a.join(r, cols.account_id, "full_outer")
    same = F.col("audited_bonus").eqNullSafe(F.col("recomputed_bonus")) & F.col("audited_balance").eqNullSafe(
        F.col("recomputed_balance")
    )
    return j.filter(~same).select(
        cols.account_id, "audited_bonus", "recomputed_bonus", "audited_balance", "recomputed_balance"
    )
