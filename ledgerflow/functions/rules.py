"""Business rules as pure ``Column`` expressions (all JVM-side, codegen'd)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.config import TIME_RANGE, AccrualRule, Columns
from ledgerflow.functions.money import decimal_lit, money, rate_lit, zero
from ledgerflow.functions.timeutil import ts_lit

# Quarantine reason codes, in the order they are tested (the first one that
# applies is the row's primary reason).
REASON_USER_NULL = "user_id_null"
REASON_ACCOUNT_NULL = "account_id_null"
REASON_TYPE_NULL = "transaction_type_null"
REASON_TYPE_INVALID = "transaction_type_invalid"
REASON_TIME_NULL = "event_time_null"
REASON_TIME_RANGE = "event_time_out_of_range"
REASON_AMOUNT_NULL = "amount_null"
REASON_EVENT_ID_NULL = "event_id_null"
REASON_ORDER = (
    REASON_USER_NULL,
    REASON_ACCOUNT_NULL,
    REASON_TYPE_NULL,
    REASON_TYPE_INVALID,
    REASON_TIME_NULL,
    REASON_TIME_RANGE,
    REASON_AMOUNT_NULL,
    REASON_EVENT_ID_NULL,
)


def quarantine_checks(
    cols: Columns, transaction_types: tuple[str, ...], with_event_id: bool = False, time_range=TIME_RANGE
) -> list[tuple[Column, str]]:
    """(predicate, reason) pairs in reason order. Every predicate is
    NULL-free (built from ``isNull`` / ``isNotNull``), so routing on them is
    total: a NULL type fails ``transaction_type_null`` instead of making the
    predicate NULL and falling out of both the valid and the quarantine side.
    When the input carries an event id it is required too (deduplication
    groups by it, so NULL ids would otherwise collapse into one event).
    """
    t = F.col(cols.transaction_type)
    at = F.col(cols.event_time)
    in_range = (at >= ts_lit(time_range[0])) & (at < ts_lit(time_range[1]))
    return [
        (F.col(cols.user_id).isNull(), REASON_USER_NULL),
        (F.col(cols.account_id).isNull(), REASON_ACCOUNT_NULL),
        (t.isNull(), REASON_TYPE_NULL),
        (t.isNotNull() & ~t.isin(*transaction_types), REASON_TYPE_INVALID),
        (at.isNull(), REASON_TIME_NULL),
        (at.isNotNull() & ~in_range, REASON_TIME_RANGE),
        (F.col(cols.amount).isNull(), REASON_AMOUNT_NULL),
    ] + ([(F.col(cols.event_id).isNull(), REASON_EVENT_ID_NULL)] if with_event_id else [])


def is_rejected(cols: Columns, transaction_types: tuple[str, ...], with_event_id: bool = False, time_range=TIME_RANGE) -> Column:
    """True when any check fails (a plain boolean: cheap on the valid path)."""
    conds = [c for c, _ in quarantine_checks(cols, transaction_types, with_event_id, time_range)]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def quarantine_reasons(cols: Columns, transaction_types: tuple[str, ...], with_event_id: bool = False, time_range=TIME_RANGE) -> Column:
    """``array<string>`` of every failed check; empty means the row is valid."""
    checks = quarantine_checks(cols, transaction_types, with_event_id, time_range)
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in checks]))


def is_eligible(cols: Columns, cutoff: dt.datetime | Column) -> Column:
    """Money that arrived strictly before the cutoff is eligible."""
    return F.col(cols.event_time) < ts_lit(cutoff)


def accrual_base(early: Column, late: Column) -> Column:
    """If the late bucket is negative it reduces the base: ``least(a, a + n)``."""
    return money(F.when(late < 0, early + late).otherwise(early))


def bonus(base: Column, rule: AccrualRule, rate: Column | None = None, gate: Column | None = None) -> Column:
    """``base * rate`` when ``gate > min_balance`` (strict; gate defaults to the
    base), else 0.00. A NULL gate earns 0.00; without a threshold a NULL base
    gives NULL."""
    r = rate if rate is not None else rate_lit(rule.rate)
    if rule.min_balance is None:
        return money(base * r)
    g = base if gate is None else gate
    return money(F.when(g > decimal_lit(rule.min_balance), base * r).otherwise(zero()))


def final_balance(bonus_col: Column, total: Column) -> Column:
    return money(bonus_col + total)
