"""Property checks on generated event frames (few examples: each runs Spark)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerflow.operators import balances, quality
from ledgerflow.schema import EVENT

CUT = dt.datetime(2024, 1, 29)

_event = st.tuples(
    st.sampled_from(["u1", "u2", None]),
    st.sampled_from(["a", "b", "c", None]),
    st.sampled_from(["DEPOSIT", "WITHDRAWAL", "TRANSFER_IN", "deposit", "BOGUS", None]),
    st.one_of(st.none(), st.integers(0, 40 * 24).map(lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h))),
    st.one_of(st.none(), st.integers(-50_000, 50_000).map(lambda c: Decimal(c) / 100)),
)


def _frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], EVENT)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_event, min_size=1, max_size=40), split=st.integers(0, 40))
def test_routing_total_and_fold_split_invariant(spark, rows, split):
    df = _frame(spark, rows)
    valid, bad = quality.route(df)
    v_ids = {r.event_id for r in valid.collect()}
    b_ids = {r.event_id for r in bad.collect()}
    assert v_ids.isdisjoint(b_ids) and v_ids | b_ids == set(range(len(rows)))

    first = valid.filter(valid.event_id < split)
    rest = valid.filter(valid.event_id >= split)
    whole = sorted(map(tuple, balances.silver_balances(valid, CUT).collect()))
    folded = balances.fold_touched_only(balances.silver_balances(first, CUT), balances.silver_balances(rest, CUT))
    assert sorted(map(tuple, folded.collect())) == whole
