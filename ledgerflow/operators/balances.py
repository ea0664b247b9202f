"""Silver: eligibility, account balances, folds, wallet history, daily balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.config import Columns, LedgerConfig
from ledgerflow.functions.money import money, zero
from ledgerflow.functions.rules import accrual_base, is_eligible
from ledgerflow.functions.timeutil import cutoff_from_as_of, cutoff_from_max, ts_lit, ts_text
from ledgerflow.operators.ordered import lowest_running_total, running_total, trailing_min_24h


# --- cutoffs -----------------------------------------------------------------

def data_cutoff(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """One row: ``cutoff`` = midnight of (latest event - 24h)."""
    return events.agg(cutoff_from_max(F.max(cols.event_time)).alias("cutoff"))


def as_of_cutoffs(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """For every calendar day with events, the cutoff a run on that day uses:
    ``as_of_date, cutoff`` (midnight of the previous day)."""
    days = events.select(F.to_date(cols.event_time).alias("as_of_date")).distinct()
    return days.select("as_of_date", cutoff_from_as_of(F.col("as_of_date")).alias("cutoff"))


def resolve_cutoff(events: DataFrame, cfg: LedgerConfig) -> dt.datetime:
    """The configured cutoff, that of the configured run date (midnight of the
    day before it), or the data-driven one (one scalar to the driver)."""
    if cfg.cutoff is not None:
        return cfg.cutoff
    if cfg.run_date is not None:
        return dt.datetime.combine(cfg.run_date, dt.time()) - dt.timedelta(days=1)
    # as text: a collected timestamp would be shifted into the driver's OS time zone
    row = data_cutoff(events, cfg.cols).select(ts_text("cutoff").alias("cutoff")).first()
    if row is None or row["cutoff"] is None:
        raise ValueError("cannot derive a cutoff from an empty event set")
    return dt.datetime.fromisoformat(row["cutoff"])


# --- account aggregate (Silver) ----------------------------------------------

def flag_eligibility(events: DataFrame, cutoff: dt.datetime | Column, cols: Columns = Columns()) -> DataFrame:
    return events.withColumn(cols.cdi_applicable, is_eligible(cols, cutoff))


def sum_by_account_flag(events: DataFrame, cutoff, cols: Columns = Columns()) -> DataFrame:
    """``account_id, cdi_applicable, amount_sum`` (nulls skipped by ``sum``)."""
    return (
        flag_eligibility(events, cutoff, cols)
        .groupBy(cols.account_id, cols.cdi_applicable)
        .agg(money(F.sum(cols.amount)).alias("amount_sum"))
    )


def pivot_by_flag(events: DataFrame, cutoff, cols: Columns = Columns(), method: str = "conditional") -> DataFrame:
    """``account_id, early, late``; a bucket with no rows is NULL.

    ``conditional`` (default) is one hash aggregate with two conditional sums:
    one shuffle, and the form that is also legal on a stream. ``pivot`` is the
    DataFrame ``pivot`` with explicit values; same rows, extra aggregate.
    """
    flagged = flag_eligibility(events, cutoff, cols)
    flag = F.col(cols.cdi_applicable)
    if method == "pivot":
        p = flagged.groupBy(cols.account_id).pivot(cols.cdi_applicable, [True, False]).agg(F.sum(cols.amount))
        return p.select(cols.account_id, money(F.col("true")).alias("early"), money(F.col("false")).alias("late"))
    if method != "conditional":
        raise ValueError(f"unknown pivot method {method!r}")
    return flagged.groupBy(cols.account_id).agg(
        money(F.sum(F.when(flag, F.col(cols.amount)))).alias("early"),
        money(F.sum(F.when(~flag, F.col(cols.amount)))).alias("late"),
    )


def silver_balances(events: DataFrame, cutoff, cols: Columns = Columns()) -> DataFrame:
    """One row per account: total, early (eligible) and late buckets; an absent
    bucket is 0.00. A single hash aggregate (partial sums map-side)."""
    p = pivot_by_flag(events, cutoff, cols)
    early = F.coalesce(F.col("early"), zero())
    late = F.coalesce(F.col("late"), zero())
    return p.select(
        cols.account_id,
        money(early + late).alias(cols.total_amount),
        early.alias(cols.amount_cdi_applicable),
        late.alias(cols.amount_cdi_not_applicable),
    )


# --- folds -------------------------------------------------------------------

def fold(stored: DataFrame, incoming: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Additive fold: stored + incoming per account (every stored row rewritten)."""
    sums = [cols.total_amount, cols.amount_cdi_applicable, cols.amount_cdi_not_applicable]
    u = stored.select(cols.account_id, *sums).unionByName(incoming.select(cols.account_id, *sums))
    return u.groupBy(cols.account_id).agg(*[money(F.sum(c)).alias(c) for c in sums])


def fold_touched_only(stored: DataFrame, incoming: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Same rows as ``fold``, but only accounts present in ``incoming`` are
    re-aggregated; the rest of ``stored`` is carried over by an anti join.

    The key set of ``incoming`` goes through one shuffle, so AQE sees its real
    size and turns both the semi and the anti join into broadcast joins when
    it is small: ``stored`` is then streamed, never shuffled.
    """
    keys = incoming.select(cols.account_id).distinct()
    touched = stored.join(keys, cols.account_id, "left_semi")
    untouched = stored.join(keys, cols.account_id, "left_anti").select(*cols.silver_columns)
    return fold(touched, incoming, cols).select(*cols.silver_columns).unionByName(untouched)


# --- day-grain state (late events, moving cutoffs) ----------------------------------

def day_state(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Silver state at (account, calendar day) grain: ``account_id, d, net``.

    Buckets split at a fixed cutoff go stale when the cutoff moves (money that
    was "late" yesterday is "early" today) and a late-arriving event would land
    in the wrong bucket. Net flow per day does not depend on the cutoff, so it
    can be folded incrementally and read out for any midnight cutoff.
    """
    return daily_net(events, cols)


def fold_day_state(stored: DataFrame, incoming: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Additive fold of two day-grain states (a late event just adds to its day)."""
    u = stored.select(cols.account_id, "d", "net").unionByName(incoming.select(cols.account_id, "d", "net"))
    return u.groupBy(cols.account_id, "d").agg(money(F.sum("net")).alias("net"))


def accounts_at(state: DataFrame, cutoff: dt.datetime, cols: Columns = Columns()) -> DataFrame:
    """The four Silver columns from a day-grain state, for a midnight cutoff."""
    if (cutoff.hour, cutoff.minute, cutoff.second, cutoff.microsecond) != (0, 0, 0, 0):
        raise ValueError("a day-grain state answers midnight cutoffs only; recompute from events otherwise")
    early_day = F.col("d") < F.lit(cutoff.date())
    early = F.coalesce(money(F.sum(F.when(early_day, F.col("net")))), zero())
    late = F.coalesce(money(F.sum(F.when(~early_day, F.col("net")))), zero())
    return state.groupBy(cols.account_id).agg(
        money(early + late).alias(cols.total_amount),
        early.alias(cols.amount_cdi_applicable),
        late.alias(cols.amount_cdi_not_applicable),
    )


# --- wallet history -----------------------------------------------------------

def wallet_history(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """``account_id, event_id, event_time, amount, balance``: the running balance
    per account in (event_time, event_id) order."""
    base = events.select(cols.account_id, cols.event_id, cols.event_time, cols.amount)
    return running_total(base, cols.account_id, cols.event_time, cols.event_id, cols.amount, "balance")


def balance_intervals(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """``account_id, event_id, balance, valid_from, valid_to``: each balance holds
    from its event until the account's next event (NULL for the latest)."""
    base = events.select(cols.account_id, cols.event_id, cols.event_time, cols.amount)
    h = running_total(base, cols.account_id, cols.event_time, cols.event_id, cols.amount, "balance", with_next_ts="valid_to")
    return h.select(
        cols.account_id, cols.event_id, "balance", F.col(cols.event_time).alias("valid_from"), "valid_to"
    )


def rolling_24h_min(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """``account_id, event_id, min_balance``: the lowest running balance among the
    account's events in the 24 hours up to and including each event. One row
    per delivered event: a repeated delivery keeps its own row."""
    h = wallet_history(events, cols)
    r = trailing_min_24h(h, cols.account_id, cols.event_time, "balance", "min_balance")
    return r.select(cols.account_id, cols.event_id, "min_balance")


def lowest_balance(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """``account_id, min_balance``: the lowest running balance of each account."""
    return lowest_running_total(events, cols.account_id, cols.event_time, cols.event_id, cols.amount, "min_balance")


def stationary_balance(events: DataFrame, cutoff, cols: Columns = Columns()) -> DataFrame:
    """``account_id, stationary, parity_base``.

    ``stationary`` is the money that stayed put from the cutoff to the end of
    the data: least(balance at the cutoff, lowest running balance after it).
    ``parity_base`` is the parity rule least(early, early + late), which
    misses a dip that recovers inside the window.

    Only events after the cutoff enter the ordered (window) step; the balance
    at the cutoff comes from the same hash aggregate as Silver.
    """
    buckets = silver_balances(events, cutoff, cols)
    late = events.filter(F.col(cols.event_time) >= ts_lit(cutoff)).select(
        cols.account_id, cols.event_id, cols.event_time, cols.amount
    )
    low = lowest_running_total(late, cols.account_id, cols.event_time, cols.event_id, cols.amount, "_min_prefix")
    early = F.col(cols.amount_cdi_applicable)
    return buckets.join(low, cols.account_id, "left").select(
        cols.account_id,
        money(F.least(early, early + F.coalesce(F.col("_min_prefix"), zero()))).alias("stationary"),
        accrual_base(early, F.col(cols.amount_cdi_not_applicable)).alias("parity_base"),
    )


# --- calendar days ------------------------------------------------------------

def daily_net(events: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """``account_id, d, net`` for calendar days with events (1-day tumbling
    windows in UTC; the streaming twin uses ``window``)."""
    return events.groupBy(cols.account_id, F.to_date(cols.event_time).alias("d")).agg(
        money(F.sum(cols.amount)).alias("net")
    )


def day_span(days: DataFrame, since: dt.date | None = None, through: dt.date | None = None) -> DataFrame:
    """One row ``_since, _through``: the first and last ``d`` of ``days``, or the
    given bounds. It stays in the plan (no scalar reaches the driver)."""
    lo = F.min("d") if since is None else F.min(F.lit(since))
    hi = F.max("d") if through is None else F.max(F.lit(through))
    return days.agg(lo.alias("_since"), hi.alias("_through"))


def daily_balance(events: DataFrame, cols: Columns = Columns(), through: dt.date | None = None) -> DataFrame:
    """``account_id, d, opening, net, closing`` for every calendar day from the
    account's first event day through ``through`` (default: the last event day);
    days without events carry the balance forward.

    Events are first reduced to one row per (account, day). A running window
    over those day rows gives each event day's closing balance and the next
    event day; each day row then expands into itself plus the quiet days up to
    the next event day. One aggregate, one window, no join: the per-account
    window holds at most one row per day, whatever the event volume.
    """
    return daily_balance_from_state(daily_net(events, cols), through, cols)


def daily_balance_from_state(state: DataFrame, through: dt.date | None = None, cols: Columns = Columns()) -> DataFrame:
    """``daily_balance`` from a day-grain state (``account_id, d, net``), so an
    incremental Silver table feeds daily payouts without re-reading events.
    Without ``through``, the last day comes from the state as a one-row side."""
    net = state.select(cols.account_id, "d", "net")
    span = F.broadcast(day_span(net, through=through).select("_through"))  # one row
    net = net.join(span, F.col("d") <= F.col("_through"))
    w = Window.partitionBy(cols.account_id).orderBy("d")
    x = net.withColumn("closing", money(F.sum("net").over(w.rowsBetween(Window.unboundedPreceding, 0)))).withColumn(
        "_next", F.lead("d").over(w)
    )
    end = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("_through"))
    y = x.select(
        cols.account_id, F.col("d").alias("_event_day"), "net", "closing", F.explode(F.sequence(F.col("d"), end)).alias("d")
    )
    day_net = F.when(F.col("d") == F.col("_event_day"), F.col("net")).otherwise(zero())
    return y.select(
        cols.account_id,
        "d",
        money(F.col("closing") - day_net).alias("opening"),
        day_net.alias("net"),
        "closing",
    )
