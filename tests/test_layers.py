"""Roots of any store, layers by name, run ids and the day grain through Gold."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow import schema
from ledgerflow.config import Columns, LedgerConfig, TablePaths
from ledgerflow.operators import balances, quality
from ledgerflow.plans import pipeline as pl
from ledgerflow.plans import table_queries as tq
from ledgerflow.plans.catalog import q_gold_account_balance, q_silver_balances
from ledgerflow.session import release_scratch, scratch_path
from ledgerflow.sources import events as ev
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import tables
from ledgerflow.streaming import incremental as st

from .conftest import SF_SMALL

CUT = fx.FIXTURE_CUTOFF


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("root", ["s3a://bucket/lake", "s3a://bucket/lake/", "hdfs://nn:8020/lake", "viewfs://store/lake", "file:///lake", "/lake", "lake"])
def test_paths_keep_the_scheme(root):
    p = TablePaths(root)
    base = root.rstrip("/")
    assert p.silver == f"{base}/silver/accounts"
    assert p.bronze == f"{base}/bronze/routed/route=valid"
    for path in (p.source, p.audit, p.payout, p.balance, p.checkpoints, p.seen_events, p.fold_quarantine, p.metrics):
        assert path.startswith(base + "/") and "//" not in path.removeprefix(base)
    assert tables.SnapshotTable(p.silver).path(3) == f"{base}/silver/accounts/version=3"


@pytest.mark.parametrize("run_id", ["007", "2024-01-29", "1e3", "plain", "a:b/c d"])
def test_pipeline_on_a_uri_root_with_any_run_id(spark, tmp_root, run_id):
    spec = pl.PipelineSpec(root=f"file://{tmp_root}", cfg=LedgerConfig(cutoff=CUT))
    fx.wallet_events(spark, SF_SMALL).write.parquet(spec.source_path)
    pl.run_pipeline(spark, spec, business_date=CUT.date(), run_id=run_id)
    want = rows(q_gold_account_balance(spark, SF_SMALL))
    assert rows(tables.SnapshotTable(spec.paths.balance).read(spark).select("account_id", "current_balance", "last_day_bonus")) == want
    assert {r.run_id for r in spark.read.parquet(spec.paths.payout).select("run_id").collect()} == {run_id}
    pl.run_pipeline(spark, spec, business_date=CUT.date(), run_id=run_id)  # a rerun changes nothing
    assert spark.read.parquet(spec.paths.payout).count() == len(want)


@pytest.mark.parametrize("how", ["recompute", "fold"])
def test_day_grain_reaches_gold(spark, tmp_root, how):
    spec = pl.PipelineSpec(root=tmp_root, grain="day")
    tx = fx.wallet_events(spark, SF_SMALL)
    if how == "recompute":
        tx.write.parquet(spec.source_path)
        pl.run_pipeline(spark, spec, run_id="r")
    else:
        pl.fold_batch(spark, tx, 0, spec)
        pl.tasks(spec, run_id="r")["gold"](spark)
    got = tables.SnapshotTable(spec.paths.balance).read(spark)
    assert {r.business_date for r in got.collect()} == {CUT.date()}
    assert rows(got.select("account_id", "current_balance", "last_day_bonus")) == rows(q_gold_account_balance(spark, SF_SMALL))


def test_gate_runs_under_renamed_columns(spark, tmp_root):
    cols = Columns(account_id="acct", total_amount="tot", amount_cdi_applicable="early", amount_cdi_not_applicable="late")
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cols=cols, cutoff=CUT))
    assert schema.named(schema.SILVER, cols).fieldNames() == ["acct", "tot", "early", "late"]
    one = [("a", Decimal("200"), Decimal("200"), Decimal("0"))]
    ddl = "acct string, tot decimal(18,2), early decimal(18,2), late decimal(18,2)"
    store = tables.SnapshotTable(spec.paths.silver)
    store.write(spark.createDataFrame(one * 2, ddl), 0)
    with pytest.raises(ValueError, match="duplicate_key"):
        pl.run_gold(spark, spec, CUT.date(), "r")
    assert not tables.has_data(spark, spec.paths.payout)
    store.write(spark.createDataFrame(one, ddl), 1)
    pl.run_gold(spark, spec, CUT.date(), "r")
    assert tables.SnapshotTable(spec.paths.balance).read(spark).first().current_balance == Decimal("200.11")


def test_event_ids_keep_their_type(spark, tmp_root):
    ddl = "event_id string, user_id string, account_id string, transaction_type string, event_time timestamp, amount decimal(18,2)"
    at = dt.datetime(2024, 1, 5)
    frame = spark.createDataFrame([("e-1", "u", "a", "DEPOSIT", at, Decimal("5")), ("e-1", "u", "a", "DEPOSIT", at, Decimal("5")), (None, "u", "a", "DEPOSIT", at, Decimal("9"))], ddl)
    n = ev.normalize(frame)
    assert dict(n.dtypes)["event_id"] == "string"
    assert quality.valid_events(n).count() == 2
    assert dict(ev.normalize(frame, event_id_type="long").dtypes)["event_id"] == "bigint"
    assert dict(ev.normalize(frame.withColumn("event_id", F.lit(3)), event_id_type="string").dtypes)["event_id"] == "string"
    with pytest.raises(ValueError):
        ev.normalize(frame, event_id_type="double")
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=CUT))
    frame.write.parquet(spec.source_path)
    pl.run_pipeline(spark, spec, business_date=CUT.date(), run_id="r")
    assert tables.SnapshotTable(spec.paths.silver).read(spark).first().total_amount == Decimal("5.00")


def test_one_rule_set_for_batch_and_streams(spark, tmp_root):
    """Configured types and times give the same Silver from every entry."""
    cfg = LedgerConfig(cutoff=CUT, transaction_types=("DEPOSIT", "WITHDRAWAL"), time_range=(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 30)))
    results = []
    for n, run in enumerate(("batch", "fold", "totals")):
        spec = pl.PipelineSpec(root=os.path.join(tmp_root, run), cfg=cfg)
        fx.wallet_events(spark, SF_SMALL).write.parquet(spec.source_path)
        if run == "batch":
            pl.run_bronze(spark, spec)
            pl.run_silver(spark, spec)
        elif run == "fold":
            st.silver_fold_stream(spark, spec.source_path, spec, CUT).awaitTermination(300)
        else:
            st.account_totals_table_stream(spark, spec.source_path, spec, CUT).awaitTermination(300)
        results.append(rows(tables.SnapshotTable(spec.paths.silver).read(spark)))
    assert results[0] == results[1] == results[2]
    assert results[0] != rows(q_silver_balances(spark, SF_SMALL))


def test_layers_by_name(spark, tmp_root):
    database = tq._database(spark, "test-ledger")
    spec = pl.PipelineSpec.from_json(json.dumps({"root": tmp_root, "catalog": database, "ledger": {"cutoff": CUT.isoformat()}}))
    tx = fx.wallet_events(spark, SF_SMALL)
    tx.write.parquet(spec.source_path)
    name = spec.layers.name
    for n in range(4):  # reruns by name: Bronze grows, the rest stays
        pl.run_pipeline(spark, spec, business_date=CUT.date(), run_id="007")
        assert rows(spark.table(name("silver"))) == rows(q_silver_balances(spark, SF_SMALL))
        assert rows(spark.table(name("balance")).select("account_id", "current_balance", "last_day_bonus")) == rows(q_gold_account_balance(spark, SF_SMALL))
        assert spark.table(name("routed")).count() == (n + 1) * tx.count()
    assert spark.table(name("payout")).count() == spark.table(name("audit")).count() == 15
    assert {r.run_id for r in spark.table(name("audit")).select("run_id").collect()} == {"007"}
    versions = [t.name for t in spark.catalog.listTables(database) if "__v" in t.name and t.name.startswith("silver")]
    assert len(versions) == 3  # as many as are offered
    wider = tx.withColumn("channel", F.lit("web")).withColumn("event_id", F.col("event_id") + 10_000)
    wider.write.mode("append").parquet(spec.source_path)
    more = pl.PipelineSpec.from_json(json.dumps({"root": tmp_root, "catalog": database, "source": spec.source_path, "ledger": {"cutoff": CUT.isoformat()}}))
    spark.read.option("mergeSchema", "true").parquet(spec.source_path).filter("channel is not null").write.parquet(os.path.join(tmp_root, "raw2"))
    pl.run_bronze(spark, pl.PipelineSpec(root=tmp_root, catalog=database, source=os.path.join(tmp_root, "raw2"), cfg=more.cfg))
    assert spark.table(name("routed")).filter("channel = 'web'").count() == tx.count()
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_folds_by_name_share_files(spark, tmp_root):
    database = tq._database(spark, "test-folds")
    spec = pl.PipelineSpec(root=tmp_root, catalog=database, cfg=LedgerConfig(cutoff=CUT), state_buckets=8)
    v = quality.valid_events(fx.wallet_events(spark, SF_SMALL))
    for n in range(3):
        pl.fold_batch(spark, v.filter(F.pmod(F.xxhash64("account_id"), F.lit(3)) == n), n, spec)
        upto = v.filter(F.pmod(F.xxhash64("account_id"), F.lit(3)) <= n)
        assert rows(spark.table(spec.layers.name("silver"))) == rows(balances.silver_balances(upto, CUT))
    pl.fold_batch(spark, v.filter(F.pmod(F.xxhash64("account_id"), F.lit(3)) == 2), 2, spec)  # replay
    assert rows(spark.table(spec.layers.name("silver"))) == rows(balances.silver_balances(v, CUT))
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_main_runs_on_a_uri_root(spark, tmp_root, monkeypatch):
    """main stops its session; here it is given one that stays."""
    monkeypatch.setattr("ledgerflow.session.local_session", lambda *a, **k: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    root = f"file://{tmp_root}"
    fx.wallet_events(spark, SF_SMALL).write.parquet(f"{root}/raw")
    assert pl.main([root]) == 0
    assert rows(tables.SnapshotTable(f"{root}/silver/accounts").read(spark)) == rows(q_silver_balances(spark, SF_SMALL))
    assert pl.main([]) == 2


def test_scratch_is_released(spark):
    path = scratch_path(spark, "released")
    spark.range(3).write.parquet(path)
    assert tables.exists(spark, path)
    release_scratch(spark)
    assert not tables.exists(spark, path)
