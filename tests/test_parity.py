"""The accrual rule as a table of cases, derived from the rule itself."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ledgerflow.operators import accrual, balances
from ledgerflow.schema import EVENT, SILVER

CUTOFF = dt.datetime(2024, 5, 20)


def money(x: str) -> Decimal:
    return Decimal(x).quantize(Decimal("0.01"))


# early, late, base, bonus at the fixed rate 0.00055 (half up), final balance
RULE_CASES = [
    pytest.param("0", "0", "0", "0", "0", id="nothing"),
    pytest.param("100.00", "0", "100.00", "0", "100.00", id="the minimum itself earns nothing"),
    pytest.param("100.01", "0", "100.01", "0.06", "100.07", id="a cent above the minimum"),
    pytest.param("1000", "250", "1000", "0.55", "1250.55", id="a deposit after the cutoff does not earn"),
    pytest.param("1000", "-250", "750", "0.41", "750.41", id="a withdrawal after it does not either"),
    pytest.param("1000", "-950", "50", "0", "50", id="withdrawn to below the minimum"),
    pytest.param("-40", "5000", "-40", "0", "4960", id="negative before the cutoff"),
    pytest.param("300", "-500", "-200", "0", "-200", id="overdrawn after the cutoff"),
]


@pytest.mark.parametrize("early,late,base,bonus,final", RULE_CASES)
def test_accrual_rule(spark, early, late, base, bonus, final):
    total = money(early) + money(late)
    silver = spark.createDataFrame([("acct", total, money(early), money(late))], SILVER)
    frames = accrual.gold_frames(silver, CUTOFF.date(), "case")
    audit = frames.audit.first()
    assert (audit.balance_to_apply_cdi, audit.cdi_bonus, audit.final_balance) == (money(base), money(bonus), money(final))
    payout, balance = frames.payout.first(), frames.balance.first()
    assert payout.cdi_bonus == balance.last_day_bonus == money(bonus) and balance.current_balance == money(final)
    assert payout.cdi_bonus_date is not None and payout.business_date == CUTOFF.date()


# seconds from the cutoff and amount of each event; early and late sums
SPLIT_CASES = [
    pytest.param([(-1, "10")], "10", "0", id="a second before is early"),
    pytest.param([(0, "10")], "0", "10", id="the cutoff itself is late"),
    pytest.param([(-86400, "70"), (-5, "-20"), (60, "-80"), (120, "80")], "50", "0", id="a dip that recovers leaves the late sum at zero"),
]


@pytest.mark.parametrize("events,early,late", SPLIT_CASES)
def test_split_at_the_cutoff(spark, events, early, late):
    rows = [(n, "user", "acct", "DEPOSIT", CUTOFF + dt.timedelta(seconds=s), money(a)) for n, (s, a) in enumerate(events)]
    got = balances.silver_balances(spark.createDataFrame(rows, EVENT), CUTOFF).first()
    assert (got.amount_cdi_applicable, got.amount_cdi_not_applicable) == (money(early), money(late))
    assert got.total_amount == money(early) + money(late)
