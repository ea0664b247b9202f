"""End-to-end batch pipeline into a temp root; reruns must not change results."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import LedgerConfig, TablePaths
from ledgerflow.plans import pipeline as pl
from ledgerflow.plans.catalog import q_gold_account_balance, q_silver_balances
from ledgerflow.schema import EVENT, SILVER
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import tables

from .conftest import SF_SMALL


def _land_raw(spark, root):
    """Land the fixture events as raw files with the original raw types
    (text time, double amount)."""
    raw = fx.wallet_events(spark, SF_SMALL).select(
        "event_id",
        "user_id",
        "account_id",
        "transaction_type",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
        F.col("amount").cast("double").alias("amount"),
    )
    raw.repartition(3).write.parquet(os.path.join(root, "raw"))


def _snapshot(spark, path):
    return sorted(map(tuple, tables.SnapshotTable(path).read(spark).collect()), key=str)


def test_paths_share_one_root(tmp_root):
    p = TablePaths(tmp_root)
    for x in (p.bronze, p.quarantine, p.silver, p.audit, p.payout, p.balance, p.checkpoints):
        assert x.startswith(tmp_root)
    assert p.quarantine != p.bronze


def test_pipeline_end_to_end_and_rerun(spark, tmp_root):
    _land_raw(spark, tmp_root)
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    bd = dt.date(2024, 1, 29)
    pl.run_pipeline(spark, spec, business_date=bd, run_id="r1")
    paths = spec.paths

    n_raw = spark.read.parquet(paths.source).count()
    n_valid = spark.read.parquet(paths.bronze).count()
    n_bad = spark.read.parquet(paths.quarantine).count()
    assert n_valid + n_bad == n_raw

    bal = {r.account_id: (r.current_balance, r.last_day_bonus) for r in tables.SnapshotTable(paths.balance).read(spark).collect()}
    want = {r.account_id: (r.current_balance, r.last_day_bonus) for r in q_gold_account_balance(spark, SF_SMALL).collect()}
    assert bal == want

    silver1 = _snapshot(spark, paths.silver)
    balance1 = _snapshot(spark, paths.balance)
    payout1 = spark.read.parquet(paths.payout).count()
    assert payout1 == len(want)

    # second run: Bronze appends the same files again; Silver dedups on the
    # event key, Gold publishes no payout twice
    pl.run_pipeline(spark, spec, business_date=bd, run_id="r1")
    assert spark.read.parquet(paths.bronze).count() == 2 * n_valid
    assert _snapshot(spark, paths.silver) == silver1
    assert _snapshot(spark, paths.balance) == balance1
    assert spark.read.parquet(paths.payout).count() == payout1
    assert spark.read.parquet(paths.audit).count() == len(want)  # (date, run) partition replaced


def test_incremental_fold_replay_is_noop(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    tx = fx.wallet_events(spark, SF_SMALL)
    cut = F.lit(fx.LAST_BATCH_START).cast("timestamp")
    b0, b1 = tx.filter(F.col("event_time") < cut), tx.filter(F.col("event_time") >= cut)
    pl.fold_batch(spark, b0, 0, spec, fx.FIXTURE_CUTOFF)
    pl.fold_batch(spark, b1, 1, spec, fx.FIXTURE_CUTOFF)
    v2 = _snapshot(spark, spec.paths.silver)
    pl.fold_batch(spark, b1, 1, spec, fx.FIXTURE_CUTOFF)  # replay
    assert _snapshot(spark, spec.paths.silver) == v2
    whole = q_silver_balances(spark, SF_SMALL)
    assert sorted(map(tuple, whole.collect()), key=str) == v2
    assert all(isinstance(r[1], Decimal) for r in v2)


def test_bronze_observes_counts_in_flight(spark, tmp_root):
    _land_raw(spark, tmp_root)
    spec = pl.PipelineSpec(root=tmp_root)
    counts = pl.run_bronze(spark, spec)
    assert counts["rows"] == counts["valid"] + counts["quarantine"] == 1000
    assert counts["valid"] == spark.read.parquet(spec.paths.bronze).count()


def test_column_names_are_configuration(spark):
    from ledgerflow.config import Columns
    from ledgerflow.operators import accrual, balances

    cols = Columns(account_id="acct", event_time="ts", amount="amt", total_amount="tot",
                   amount_cdi_applicable="early", amount_cdi_not_applicable="late", cdi_bonus="bonus")
    ev = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), Decimal("300")), ("a", dt.datetime(2024, 1, 30), Decimal("-50"))],
        "acct string, ts timestamp, amt decimal(18,2)",
    )
    s = balances.silver_balances(ev, fx.FIXTURE_CUTOFF, cols)
    assert s.columns == ["acct", "tot", "early", "late"]
    g = accrual.gold_frames(s, dt.date(2024, 1, 29), "r", cols=cols).audit.first()
    assert g["balance_to_apply_cdi"] == Decimal("250.00") and g["bonus"] == Decimal("0.14")


def test_spec_from_json_and_inspection(spark, tmp_root):
    import json

    from ledgerflow.plans.inspect import layer_report

    _land_raw(spark, tmp_root)
    text = json.dumps({"root": tmp_root, "ledger": {"cutoff": "2024-01-29T00:00:00", "rate": "0.00055", "min_balance": 100}})
    spec = pl.PipelineSpec.from_json(text)
    assert spec.cfg.cutoff == fx.FIXTURE_CUTOFF and spec.cfg.rule.min_balance == "100"
    pl.run_pipeline(spec=spec, spark=spark, business_date=dt.date(2024, 1, 29), run_id="j")
    rep = layer_report(spark, tmp_root, sample_rows=2)
    assert rep["bronze"]["rows"] + rep["quarantine"]["rows"] == 1000
    assert rep["silver"]["rows"] == rep["balance"]["rows"] == 15
    assert len(rep["payout"]["sample"]) == 2


def test_daily_payouts_publish_each_day_once(spark, tmp_root):
    from ledgerflow.plans.catalog import q_daily_payout

    _land_raw(spark, tmp_root)
    spec = pl.PipelineSpec(root=tmp_root)
    pl.run_bronze(spark, spec)
    rates = fx.rates_table(spark)
    first = pl.run_daily_payouts(spark, spec, rates, "d1", through=dt.date(2024, 1, 20))
    rest = pl.run_daily_payouts(spark, spec, rates, "d2")
    again = pl.run_daily_payouts(spark, spec, rates, "d3")
    assert again == 0
    got = spark.read.parquet(spec.paths.daily_payout)
    want = q_daily_payout(spark, SF_SMALL)
    assert first + rest == got.count() == want.count()
    pairs = {(r.account_id, str(r.business_date)): r.cdi_bonus for r in got.collect()}
    assert pairs == {(r.account_id, str(r.d)): r.cdi_bonus for r in want.collect()}


def test_daily_payouts_from_day_state(spark, tmp_root):
    from ledgerflow.plans.catalog import q_daily_payout

    tx = fx.wallet_events(spark, SF_SMALL)
    spec = pl.PipelineSpec(root=tmp_root)
    cut = F.lit(fx.LAST_BATCH_START).cast("timestamp")
    pl.fold_batch(spark, tx.filter(F.col("event_time") < cut), 0, spec, grain="day")
    pl.fold_batch(spark, tx.filter(F.col("event_time") >= cut), 1, spec, grain="day")
    n = pl.run_daily_payouts(spark, spec, fx.rates_table(spark), "s", from_day_state=True)
    assert n == q_daily_payout(spark, SF_SMALL).count()


def test_gold_rerun_refuses_or_replaces_payouts(spark, tmp_root):
    _land_raw(spark, tmp_root)
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    bd = dt.date(2024, 1, 29)
    pl.run_pipeline(spark, spec, business_date=bd, run_id="r1")
    pl.run_gold(spark, spec, bd, "r2")  # refused: nothing new for that date
    runs = {r.run_id for r in spark.read.parquet(spec.paths.payout).collect()}
    assert runs == {"r1"}
    pl.run_gold(spark, spec, bd, "r3", replace_payouts=True)
    got = spark.read.parquet(spec.paths.payout)
    assert {r.run_id for r in got.collect()} == {"r3"} and got.count() == 15


def test_cross_batch_redelivery_is_folded_once(spark, tmp_root):
    tx = fx.wallet_events(spark, SF_SMALL)
    cut = F.lit(fx.LAST_BATCH_START).cast("timestamp")
    b0 = tx.filter(F.col("event_time") < cut)
    # the second batch re-delivers the events of 2024-01-28 (exact copies)
    b1 = tx.filter(F.col("event_time") >= cut).unionByName(tx.filter(F.dayofmonth("event_time") == 28))
    want = sorted(map(tuple, q_silver_balances(spark, SF_SMALL).collect()), key=str)
    for grain in ("account", "day"):
        spec = pl.PipelineSpec(root=os.path.join(tmp_root, grain), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
        for bid, b in ((0, b0), (1, b1), (1, b1)):  # the last one is a replay
            pl.fold_batch(spark, b, bid, spec, fx.FIXTURE_CUTOFF, grain=grain, cross_batch_dedup=True)
        got = tables.SnapshotTable(spec.paths.silver).read(spark)
        if grain == "day":
            got = pl.silver_view(spark, spec, fx.FIXTURE_CUTOFF)
        assert sorted(map(tuple, got.collect()), key=str) == want


def _event(i, account, time, amount):
    return (i, "u", account, "DEPOSIT", dt.datetime.fromisoformat(time), Decimal(amount))


def _frame(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def _totals(spark, spec):
    return {r.account_id: r.total_amount for r in tables.SnapshotTable(spec.paths.silver).read(spark).collect()}


def test_recompute_and_folds_share_one_line(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    first = _frame(spark, [_event(1, "a", "2024-01-05", "100")])
    bronze = _frame(spark, [_event(1, "a", "2024-01-05", "100"), _event(2, "a", "2024-01-06", "50")])
    tables.write_routed(bronze, spec.paths.routed)
    pl.fold_batch(spark, first, 0, spec)
    pl.run_silver(spark, spec)
    assert _totals(spark, spec) == {"a": Decimal("150.00")}
    later = _frame(spark, [_event(3, "a", "2024-01-07", "7")])
    for _ in range(2):  # the second is a replay
        pl.fold_batch(spark, later, 1, spec)
        assert _totals(spark, spec) == {"a": Decimal("157.00")}
    with pytest.raises(ValueError, match="does not follow"):
        pl.fold_batch(spark, later, 3, spec)


def test_stream_over_a_recomputed_table_is_refused(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    bronze = _frame(spark, [_event(1, "a", "2024-01-05", "100"), _event(2, "a", "2024-01-06", "50")])
    tables.write_routed(bronze, spec.paths.routed)
    pl.run_silver(spark, spec)
    with pytest.raises(ValueError, match="does not follow"):
        pl.fold_batch(spark, bronze, 0, spec)
    assert _totals(spark, spec) == {"a": Decimal("150.00")}


@pytest.mark.parametrize("grain", ["account", "day"])
def test_correction_in_a_later_batch_wins(spark, tmp_root, grain):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF), grain=grain)
    batches = [[_event(1, "a", "2024-01-05", "100")], [_event(1, "b", "2024-01-06", "120")], [_event(1, "a", "2024-01-05", "100")]]
    for n, rows in enumerate(batches):  # the account changes, too; the third is an older copy
        pl.fold_batch(spark, _frame(spark, rows), n, spec)
    view = pl.silver_view(spark, spec, fx.FIXTURE_CUTOFF) if grain == "day" else tables.SnapshotTable(spec.paths.silver).read(spark)
    assert {r.account_id: r.total_amount for r in view.collect()} == {"a": Decimal("0.00"), "b": Decimal("120.00")}


def test_five_column_events(spark, tmp_root):
    """Events without an id, with text time and double amount, in batch and as a fold."""
    rows = [("u", "a", "DEPOSIT", "2024-01-05T10:00:00.000", 10.0)] * 2 + [("u", "a", "DEPOSIT", "bad", 1.0), ("u", "b", "X", "2024-01-06T00:00:00", 2.0)]
    raw = spark.createDataFrame(rows, "user_id string, account_id string, transaction_type string, event_time string, amount double")
    raw.write.parquet(os.path.join(tmp_root, "raw"))
    spec = pl.PipelineSpec(root=tmp_root)
    pl.run_pipeline(spark, spec, run_id="r")
    assert _totals(spark, spec) == {"a": Decimal("20.00")}  # without an id nothing is a duplicate
    bad = spark.read.parquet(spec.paths.quarantine)
    assert {r["raw"]["event_time"] for r in bad.collect()} == {"bad", "2024-01-06T00:00:00"}
    other = pl.PipelineSpec(root=os.path.join(tmp_root, "fold"), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    pl.fold_batch(spark, raw, 0, other)
    assert _totals(spark, other) == {"a": Decimal("20.00")}
    assert spark.read.parquet(other.paths.fold_quarantine).count() == 2


def test_balance_follows_the_published_payout(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    store, balance = tables.SnapshotTable(spec.paths.silver), tables.SnapshotTable(spec.paths.balance)
    silver = lambda x: spark.createDataFrame([("a", Decimal(x), Decimal(x), Decimal("0"))], SILVER)
    read = lambda: [tuple(r) for r in balance.read(spark).select("current_balance", "last_day_bonus", "business_date").collect()]
    store.write(silver("1000"), 0, kind="recompute")
    pl.run_gold(spark, spec, dt.date(2024, 1, 29), "r1")
    store.write(silver("10000"), 1, kind="recompute")
    pl.run_gold(spark, spec, dt.date(2024, 1, 29), "r2")  # the published payout stays, and so does the bonus
    assert read() == [(Decimal("10000.55"), Decimal("0.55"), dt.date(2024, 1, 29))]
    pl.run_gold(spark, spec, dt.date(2024, 1, 30), "r3")
    latest = read()
    assert latest == [(Decimal("10005.50"), Decimal("5.50"), dt.date(2024, 1, 30))]
    pl.run_gold(spark, spec, dt.date(2024, 1, 28), "r4")  # an older date changes nothing
    assert read() == latest


def test_gold_refuses_a_broken_silver(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    rows = [("a", Decimal("1"), Decimal("1"), None), ("a", Decimal("1"), Decimal("1"), Decimal("0"))]
    frame = spark.createDataFrame(rows, "account_id string, total_amount decimal(18,2), amount_cdi_applicable decimal(18,2), amount_cdi_not_applicable decimal(18,2)")
    tables.SnapshotTable(spec.paths.silver).write(frame, 0)
    with pytest.raises(ValueError, match="null_value.*duplicate_key"):
        pl.run_gold(spark, spec, dt.date(2024, 1, 29), "r")
    assert not tables.has_data(spark, spec.paths.payout)


def test_spec_json_carries_incremental_options():
    import json

    spec = pl.PipelineSpec.from_json(json.dumps({"root": "/x", "grain": "day", "cross_batch_dedup": True}))
    assert spec.grain == "day" and spec.cross_batch_dedup and spec.paths.seen_events.startswith("/x")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_bronze_reads_text_sources(spark, tmp_root, fmt):
    raw = fx.wallet_events(spark, SF_SMALL).select(
        F.col("event_id").cast("string").alias("event_id"), "user_id", "account_id", "transaction_type",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        F.col("amount").cast("string").alias("amount"),
    )
    src = os.path.join(tmp_root, f"raw_{fmt}")
    writer = raw.coalesce(2).write
    (writer.option("header", "true").csv(src) if fmt == "csv" else writer.json(src))
    spec = pl.PipelineSpec(root=tmp_root, source=src, source_format=fmt, cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    counts = pl.run_bronze(spark, spec)
    assert counts["rows"] == 1000 and counts["valid"] + counts["quarantine"] == 1000
    pl.run_silver(spark, spec)
    got = sorted(map(tuple, tables.SnapshotTable(spec.paths.silver).read(spark).collect()), key=str)
    assert got == sorted(map(tuple, q_silver_balances(spark, SF_SMALL).collect()), key=str)
