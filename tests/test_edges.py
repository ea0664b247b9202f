"""Edge cases and invariants of the core operators."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.config import LedgerConfig, AccrualRule
from ledgerflow.operators import accrual, balances, merge, quality
from ledgerflow.operators.ordered import running_total, trailing_min_24h
from ledgerflow.schema import EVENT
from ledgerflow.sources.events import normalize

CUT = dt.datetime(2024, 1, 29)


def _events(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def ts(d, h=0, m=0):
    return dt.datetime(2024, 1, d, h, m)


def test_null_type_is_quarantined_not_lost(spark):
    rows = [
        (1, "u", "a", None, ts(1), Decimal("1")),  # null type: lost by a plain filter(c)/filter(~c)
        (2, "u", "a", "deposit", ts(1), Decimal("1")),  # case-sensitive domain
        (3, None, "a", "DEPOSIT", ts(1), Decimal("1")),
        (4, "u", None, "DEPOSIT", ts(1), Decimal("1")),
        (5, "u", "a", "DEPOSIT", None, Decimal("1")),
        (6, "u", "a", "DEPOSIT", ts(1), None),
        (7, "u", "a", "DEPOSIT", ts(1), Decimal("1")),
    ]
    df = _events(spark, rows)
    valid, bad = quality.route(df)
    assert [r.event_id for r in valid.collect()] == [7]
    reasons = {r.event_id: r.reason for r in bad.collect()}
    assert reasons == {
        1: "transaction_type_null",
        2: "transaction_type_invalid",
        3: "user_id_null",
        4: "account_id_null",
        5: "event_time_null",
        6: "amount_null",
    }
    c = quality.routing_counts(df).first()
    assert (c.n_in, c.n_valid, c.n_bad) == (7, 1, 6)


def test_text_times_are_parsed_not_compared_as_text(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-28 23:00:00.000", 10.0), ("a", "2024-01-29T00:00:00", 5.0), ("a", "garbage", 1.0)],
        "account_id string, event_time string, amount double",
    )
    n = normalize(df)
    assert dict(n.dtypes)["event_time"] == "timestamp"
    assert dict(n.dtypes)["amount"] == "decimal(18,2)"
    s = balances.silver_balances(n.filter(F.col("event_time").isNotNull()), CUT).first()
    assert s.amount_cdi_applicable == Decimal("10.00")
    assert s.amount_cdi_not_applicable == Decimal("5.00")
    assert n.filter(F.col("event_time").isNull()).count() == 1


def _silver(spark, rows):
    return spark.createDataFrame(
        rows, "account_id string, total_amount decimal(18,2), amount_cdi_applicable decimal(18,2), amount_cdi_not_applicable decimal(18,2)"
    )


def test_threshold_is_strict_and_nulls(spark):
    s = _silver(
        spark,
        [
            ("exact", Decimal("100.00"), Decimal("100.00"), Decimal("0")),
            ("above", Decimal("100.01"), Decimal("100.01"), Decimal("0")),
            ("neg", Decimal("-50"), Decimal("-20"), Decimal("-30")),
            ("nullbase", None, None, Decimal("0")),
        ],
    )
    out = {r.account_id: r for r in accrual.with_accrual(s).collect()}
    assert out["exact"].cdi_bonus == Decimal("0.00")
    assert out["above"].cdi_bonus == Decimal("0.06")  # 100.01 * 0.00055 = 0.0550055
    assert out["neg"].balance_to_apply_cdi == Decimal("-50.00")
    assert out["neg"].cdi_bonus == Decimal("0.00")
    assert out["nullbase"].cdi_bonus == Decimal("0.00")
    assert out["nullbase"].final_balance is None
    nomin = {r.account_id: r for r in accrual.with_accrual(s, AccrualRule(min_balance=None)).collect()}
    assert nomin["nullbase"].cdi_bonus is None
    assert nomin["exact"].cdi_bonus == Decimal("0.06")


def test_rate_rounds_half_up_in_decimal(spark):
    # 200 * 0.000025 = 0.005 exactly: half rounds up in decimal arithmetic
    s = _silver(spark, [("t", Decimal("200"), Decimal("200"), Decimal("0"))])
    r = accrual.with_accrual(s, AccrualRule(rate="0.000025")).first()
    assert r.cdi_bonus == Decimal("0.01")


def test_pivot_forms_agree(spark):
    rows = [(i, "u", f"a{i % 5}", "DEPOSIT", ts(20 + i % 11, i % 24), Decimal(i) - 20) for i in range(60)]
    df = _events(spark, rows)
    a = balances.pivot_by_flag(df, CUT, method="conditional")
    b = balances.pivot_by_flag(df, CUT, method="pivot")
    assert sorted(a.collect()) == sorted(b.collect())


def _random_events(spark, n=400, accounts=4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        acct = "hot" if rnd.random() < 0.6 else f"a{rnd.randrange(accounts)}"
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 30))
        rows.append((i, "u", acct, "DEPOSIT", t, Decimal(rnd.randrange(-5000, 9000)) / 100))
    return _events(spark, rows)


def test_invariants_on_random_frames(spark):
    df = _random_events(spark)
    s = balances.silver_balances(df, CUT)
    a = accrual.with_accrual(s)
    for r in a.collect():
        assert r.amount_cdi_applicable + r.amount_cdi_not_applicable == r.total_amount
        assert r.balance_to_apply_cdi <= r.amount_cdi_applicable
        if r.balance_to_apply_cdi <= 100:
            assert r.cdi_bonus == 0
    # fold of any split equals the whole
    first = df.filter(F.col("event_id") < 150)
    rest = df.filter(F.col("event_id") >= 150)
    folded = balances.fold(balances.silver_balances(first, CUT), balances.silver_balances(rest, CUT))
    touched = balances.fold_touched_only(balances.silver_balances(first, CUT), balances.silver_balances(rest, CUT))
    whole = s.select("account_id", "total_amount", "amount_cdi_applicable", "amount_cdi_not_applicable")
    assert sorted(folded.collect()) == sorted(whole.collect())
    assert sorted(touched.collect()) == sorted(whole.collect())


def _hot_events(spark):
    """Random events, repeated deliveries, and one account with most rows at one identical time."""
    df = _random_events(spark, n=500)
    again = df.filter(F.col("event_id") % 40 == 0)
    same = spark.range(10_000, 11_500).select(
        F.col("id").alias("event_id"), F.lit("u").alias("user_id"), F.lit("hot").alias("account_id"), F.lit("DEPOSIT").alias("transaction_type"),
        F.lit("2024-01-09 10:00:00").cast("timestamp").alias("event_time"), ((F.col("id") % 7) - 3).cast("decimal(18,2)").alias("amount"),
    )
    return df.unionByName(again).unionByName(same).select("account_id", "event_id", "event_time", "amount")


def test_bucketed_running_total_equals_plain_window(spark, monkeypatch):
    from ledgerflow.operators import ordered

    monkeypatch.setattr(ordered, "TIE_BITS", 4)  # the hot time is split into many tie-break ranges
    df = _hot_events(spark).dropDuplicates(["event_id"])
    got = running_total(df, "account_id", "event_time", "event_id", "amount", "balance", with_next_ts="nxt")
    w = Window.partitionBy("account_id").orderBy("event_time", "event_id")
    want = df.withColumn("balance", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(18,2)")).withColumn(
        "nxt", F.lead("event_time").over(w)
    )
    cols = ["account_id", "event_id", "balance", "nxt"]
    assert sorted(got.select(*cols).collect(), key=str) == sorted(want.select(*cols).collect(), key=str)
    low = ordered.lowest_running_total(df, "account_id", "event_time", "event_id", "amount", "low")
    assert sorted(low.collect()) == sorted(want.groupBy("account_id").agg(F.min("balance")).collect())
    text = df.withColumn("event_id", F.format_string("%012d", "event_id"))  # a text tie-break orders the same way
    got = running_total(text, "account_id", "event_time", "event_id", "amount", "balance")
    assert sorted(r.balance for r in got.collect()) == sorted(r.balance for r in want.collect())


def test_trailing_min_equals_plain_range_window(spark):
    """One form at every size; repeated deliveries keep their rows."""
    df = _hot_events(spark)
    h = balances.wallet_history(df)
    assert h.count() == df.count()
    got = trailing_min_24h(h, "account_id", "event_time", "balance", "m")
    w = Window.partitionBy("account_id").orderBy(F.unix_micros("event_time")).rangeBetween(-86_400_000_000, 0)
    want = h.withColumn("m", F.min("balance").over(w))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_cutoff_does_not_depend_on_the_os_time_zone(spark):
    import os
    import time

    rows = [(1, "u", "a", "DEPOSIT", dt.datetime(2024, 1, 29, 1), Decimal("5"))]
    df = spark.createDataFrame(rows, "event_id long, user_id string, account_id string, transaction_type string, event_time timestamp_ntz, amount decimal(18,2)")
    df = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
    was = os.environ.get("TZ")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            os.environ["TZ"] = zone
            time.tzset()
            assert balances.flag_eligibility(df, dt.datetime(2024, 1, 29)).first().cdi_applicable is False
            assert balances.resolve_cutoff(df, LedgerConfig()) == dt.datetime(2024, 1, 28)
    finally:
        os.environ.pop("TZ") if was is None else os.environ.update(TZ=was)
        time.tzset()
    assert balances.resolve_cutoff(df, LedgerConfig(run_date=dt.date(2024, 3, 1))) == dt.datetime(2024, 2, 29)


def test_impossible_times_are_quarantined(spark):
    rows = [(i, "u", "a", "DEPOSIT", dt.datetime(y, 1, 5), Decimal("1")) for i, y in enumerate((1969, 2024, 2124))]
    valid, bad = quality.route(_events(spark, rows))
    assert [r.event_id for r in valid.collect()] == [1]
    assert {r.reason for r in bad.collect()} == {"event_time_out_of_range"}


def test_repeated_rate_dates_fail(spark):
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), Decimal("0.1")), (dt.date(2024, 1, 1), Decimal("0.2"))], "rate_date date, rate decimal(9,8)")
    days = spark.createDataFrame([(dt.date(2024, 1, 2),)], "d date")
    with pytest.raises(Exception, match="repeats"):
        accrual.rate_asof(days, rates).collect()


def test_an_empty_day_is_a_volume_drop(spark):
    rows = [(100 * d + i, "u", "a", "DEPOSIT", ts(d, i), Decimal("1")) for d in (*range(1, 11), 12) for i in range(10)]
    got = quality.volume_drop(_events(spark, rows)).collect()
    assert [(r.d.day, r.n, r.mean_prev_7) for r in got] == [(11, 0, Decimal("10.0000"))]


def test_stationary_catches_recovered_dip(spark):
    rows = [
        (1, "u", "a", "DEPOSIT", ts(27), Decimal("200")),
        (2, "u", "a", "WITHDRAWAL", ts(29, 5), Decimal("-150")),
        (3, "u", "a", "DEPOSIT", ts(29, 9), Decimal("150")),
    ]
    r = balances.stationary_balance(_events(spark, rows), CUT).first()
    assert r.parity_base == Decimal("200.00")  # the parity rule misses the dip
    assert r.stationary == Decimal("50.00")


def test_daily_balance_carries_forward(spark):
    rows = [
        (1, "u", "a", "DEPOSIT", ts(1, 10), Decimal("10")),
        (2, "u", "a", "DEPOSIT", ts(3, 10), Decimal("5")),
        (3, "u", "b", "DEPOSIT", ts(2, 10), Decimal("7")),
    ]
    d = balances.daily_balance(_events(spark, rows), through=dt.date(2024, 1, 4))
    got = {(r.account_id, r.d.day): (r.opening, r.net, r.closing) for r in d.collect()}
    assert got[("a", 2)] == (Decimal("10.00"), Decimal("0.00"), Decimal("10.00"))
    assert got[("a", 4)] == (Decimal("15.00"), Decimal("0.00"), Decimal("15.00"))
    assert ("b", 1) not in got and got[("b", 4)][2] == Decimal("7.00")
    assert len(got) == 4 + 3


def test_dedup_keeps_latest_correction(spark):
    rows = [
        (1, "u", "a", "DEPOSIT", ts(1), Decimal("1")),
        (1, "u", "a", "DEPOSIT", ts(1, 0, 1), Decimal("2")),
        (2, "u", "a", "DEPOSIT", ts(1), Decimal("3")),
    ]
    out = {r.event_id: r.amount for r in quality.dedup_latest(_events(spark, rows)).collect()}
    assert out == {1: Decimal("2.00"), 2: Decimal("3.00")}


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 9, "n")], "k string, v int, tag string")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    once = merge.upsert(target, source, "k")
    got = sorted(map(tuple, once.collect()), key=str)
    assert got == sorted([("a", 1, "x"), ("b", 20, "y"), ("c", 30, None), (None, 9, "n")], key=str)
    twice = merge.upsert(once, source, "k")
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    with pytest.raises(Exception, match="repeats"):
        merge.upsert(target, source, "k").collect()


def test_rate_asof_fills_gaps(spark):
    from ledgerflow.sources.fixtures import rates_table

    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 4, 5, 19, 20, 30)], "d date")
    got = {r.d.day: r.rate for r in accrual.rate_asof(days, rates_table(spark)).collect()}
    assert got == {
        1: Decimal("0.00050000"),
        4: Decimal("0.00050000"),
        5: Decimal("0.00055000"),
        19: Decimal("0.00060000"),
        20: Decimal("0.00045000"),
        30: Decimal("0.00045000"),
    }


def test_upsert_touched_only_equals_upsert(spark):
    target = spark.createDataFrame(
        [(f"k{i}", i, f"t{i}") for i in range(40)] + [(None, -1, "nullkey")], "k string, v int, tag string"
    )
    source = spark.createDataFrame([(f"k{i}", 100 + i) for i in range(30, 50)], "k string, v int")
    a = merge.upsert(target, source, "k")
    b = merge.upsert_touched_only(target, source, "k")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    c = merge.upsert(target, source, "k", update_cols=[])
    d = merge.upsert_touched_only(target, source, "k", update_cols=[])
    assert sorted(map(tuple, c.collect()), key=str) == sorted(map(tuple, d.collect()), key=str)


def test_null_event_id_is_quarantined_last(spark):
    rows = [(None, "u", "a", "DEPOSIT", ts(1), Decimal("1")), (None, None, "a", "DEPOSIT", ts(1), Decimal("1")),
            (3, "u", "a", "DEPOSIT", ts(1), Decimal("1"))]
    valid, bad = quality.route(_events(spark, rows))
    assert [r.event_id for r in valid.collect()] == [3]
    assert sorted(r.reason for r in bad.collect()) == ["event_id_null", "user_id_null"]
    # without an event id column the check does not apply
    no_id = _events(spark, rows).drop("event_id")
    assert quality.valid_events(no_id).count() == 2
