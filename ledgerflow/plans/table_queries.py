"""Named queries whose operator writes tables: streams, folds, publishing, exports.

Each lands the whole input in a fresh folder of the shared scratch space, runs
the operator there (streams with ``availableNow``) and returns the table read
back. ``session.release_scratch`` removes the folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schema
from ledgerflow.config import Columns, LedgerConfig
from ledgerflow.functions.timeutil import ts_lit, wall_clock
from ledgerflow.operators import balances, contracts, quality
from ledgerflow.plans import pipeline as pl
from ledgerflow.session import scratch_path
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import tables
from ledgerflow.streaming import incremental as st
from ledgerflow.streaming import metrics

CUTOFF = fx.FIXTURE_CUTOFF
SILVER = Columns().silver_columns


def _spec(spark: SparkSession, name: str, **changes) -> pl.PipelineSpec:
    return pl.PipelineSpec(root=scratch_path(spark, name), cfg=LedgerConfig(cutoff=CUTOFF), **changes)


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return fx.wallet_events(spark, sf)


def _is_last(col: str = "event_time"):
    return F.col(col) >= ts_lit(fx.LAST_BATCH_START)


def _raw_types(tx: DataFrame) -> DataFrame:
    """Text times and double amounts, as raw files hold them."""
    return tx.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).withColumn("amount", F.col("amount").cast("double"))


def _silver(spark: SparkSession, spec: pl.PipelineSpec) -> DataFrame:
    return tables.SnapshotTable(spec.paths.silver).read(spark).select(*SILVER)


def _land(tx: DataFrame, path: str) -> str:
    """Two deliveries: everything before the last day, then the last day."""
    tx.filter(~_is_last() | F.col("event_time").isNull()).write.parquet(path)
    tx.filter(_is_last()).write.mode("append").parquet(path)
    return path


# --- streams ------------------------------------------------------------------------

def q_stream_bronze_counts(spark, sf):
    """Rows per route of a streamed Bronze over raw types; none is lost."""
    spec = _spec(spark, "stream-bronze")
    _raw_types(_tx(spark, sf)).write.parquet(spec.source_path)
    st.bronze_stream(spark, spec.source_path, spec.paths.routed, spec.paths.checkpoints, spec).awaitTermination()
    return spark.read.parquet(spec.paths.routed).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def q_stream_fold(spark, sf):
    spec = _spec(spark, "stream-fold")
    src = _land(_tx(spark, sf), spec.source_path)
    st.silver_fold_stream(spark, src, spec, CUTOFF).awaitTermination()
    return _silver(spark, spec)


def q_stream_account_totals(spark, sf):
    spec = _spec(spark, "stream-totals")
    src = _land(_tx(spark, sf), spec.source_path)
    st.account_totals_table_stream(spark, src, spec, CUTOFF).awaitTermination()
    return _silver(spark, spec)


def q_stream_dedup(spark, sf):
    """The last day's events delivered twice, dropped within the watermark."""
    spec = _spec(spark, "stream-dedup")
    valid = quality.valid_events(_tx(spark, sf))
    valid.unionByName(valid.filter(_is_last())).write.parquet(spec.source_path)
    st.dedup_stream(spark, spec.source_path, spec.paths.silver, spec.paths.checkpoints).awaitTermination()
    return spark.read.parquet(spec.paths.silver).select("event_id", "account_id", wall_clock("event_time").alias("event_time"), "amount")


def q_stream_daily_flow(spark, sf):
    """Closed days: what the stream emitted plus its side table of late flow."""
    spec = _spec(spark, "stream-flow")
    tx = _tx(spark, sf)
    tx.write.parquet(spec.source_path)
    tx.filter(F.dayofmonth("event_time") == 2).write.mode("append").parquet(spec.source_path)  # delivered again, late or not
    st.daily_flow_stream(spark, spec.source_path, spec.paths.silver, spec.paths.checkpoints).awaitTermination()
    emitted = spark.read.parquet(spec.paths.silver)
    late = st.late_flow(spark.read.parquet(spec.source_path), emitted)
    return emitted.unionByName(late).groupBy("account_id", "d").agg(F.sum("net").cast("decimal(18,2)").alias("net"))


def q_stream_dedup_late(spark, sf):
    """Three deliveries in three runs: every row is out, a repeat or late."""
    spec = _spec(spark, "stream-late")
    valid = quality.valid_events(_tx(spark, sf))
    day = F.to_date("event_time")
    other_ids = valid.filter(day >= "2024-01-28").withColumn("event_id", F.col("event_id") + 1_000_000_000)
    deliveries = (
        valid.filter(~_is_last()),
        valid.filter(_is_last()).unionByName(valid.filter(day == "2024-01-29")),
        valid.filter(day.isin("2024-01-02", "2024-01-30")).unionByName(other_ids),
    )
    for rows in deliveries:
        rows.write.mode("append").parquet(spec.source_path)
        st.dedup_stream(spark, spec.source_path, spec.paths.silver, spec.paths.checkpoints).awaitTermination()
    told = spark.read.schema(st.PROGRESS).parquet(f"{spec.paths.silver}_progress")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("n")) for k, c in (("out", "out"), ("repeat", "repeats"), ("late", "late"))])
    return told.select("batch", F.explode(kinds).alias("k")).select("batch", "k.*").filter("n > 0")


def q_stream_metrics(spark, sf):
    """What the listener recorded of two runs of the Bronze stream."""
    spec = _spec(spark, "stream-metrics")
    tx = _tx(spark, sf)
    with metrics.recorded(spark, spec.paths.metrics):
        for rows in (tx.filter(~_is_last() | F.col("event_time").isNull()), tx.filter(_is_last())):
            rows.write.mode("append").parquet(spec.source_path)
            st.bronze_stream(spark, spec.source_path, spec.paths.routed, spec.paths.checkpoints, spec).awaitTermination()
    return metrics.read(spark, spec.paths.metrics).select("batch", "rows", "valid", "quarantine")


def q_stream_schema_change(spark, sf):
    """A column that files gained between two runs on one checkpoint."""
    spec = _spec(spark, "stream-schema")
    tx = _tx(spark, sf)
    early, late = tx.filter(~_is_last() | F.col("event_time").isNull()), tx.filter(_is_last()).withColumn("channel", F.lower("transaction_type"))
    for rows in (early, late):
        rows.write.mode("append").parquet(spec.source_path)
        st.bronze_stream(spark, spec.source_path, spec.paths.routed, spec.paths.checkpoints, spec).awaitTermination()
    valid = tables.read_evolving(spark, spec.paths.routed).filter("route = 'valid'")
    return valid.select(*Columns().event_columns, "channel").withColumn("event_time", wall_clock("event_time"))


def _custom(spark, name):
    """Two types only, and events of twenty days only."""
    cfg = LedgerConfig(cutoff=CUTOFF, transaction_types=("DEPOSIT", "WITHDRAWAL"), time_range=(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 30)))
    return pl.PipelineSpec(root=scratch_path(spark, name), cfg=cfg)


def q_stream_custom_types(spark, sf):
    """The fold stream under configured types and times."""
    spec = _custom(spark, "custom-fold")
    src = _land(_tx(spark, sf), spec.source_path)
    st.silver_fold_stream(spark, src, spec, CUTOFF).awaitTermination()
    return _silver(spark, spec)


def q_stream_totals_custom_types(spark, sf):
    """The stateful aggregate under the same types and times."""
    spec = _custom(spark, "custom-totals")
    src = _land(_tx(spark, sf), spec.source_path)
    st.account_totals_table_stream(spark, src, spec, CUTOFF).awaitTermination()
    return _silver(spark, spec)


# --- tables by name ---------------------------------------------------------------------

def _database(spark: SparkSession, name: str) -> str:
    """A new database whose folder lies in the scratch space."""
    path = scratch_path(spark, name)
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    return database


def q_catalog_append(spark, sf):
    """Appends by name; the second brings a column that the table lacks."""
    name = f"{_database(spark, 'catalog-append')}.events"
    valid = quality.valid_events(_tx(spark, sf))
    early = F.col("event_time") < ts_lit(CUTOFF)
    tables.append_table(valid.filter(early), name)
    tables.append_table(valid.filter(~early).withColumn("channel", F.lower("transaction_type")), name)
    return tables.read_table(spark, name).withColumn("event_time", wall_clock("event_time"))


def q_catalog_overwrite(spark, sf):
    """Partitions replaced by name: half the days are written with a wrong sum first."""
    name = f"{_database(spark, 'catalog-overwrite')}.flow"
    flow = balances.daily_net(quality.valid_events(_tx(spark, sf)))
    odd = F.dayofmonth("d") % 2 == 1
    tables.append_table(flow.withColumn("net", F.when(odd, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("net"))), name, ["d"])
    tables.overwrite_table_partitions(flow.filter(odd), name, ["d"])
    return tables.read_table(spark, name).select("account_id", "d", "net")


def q_catalog_pipeline(spark, sf):
    """Raw files to current balances, every layer a table of a database."""
    spec = _spec(spark, "catalog-pipeline", catalog=_database(spark, "ledger"))
    _raw_types(_tx(spark, sf)).write.parquet(spec.source_path)
    pl.run_pipeline(spark, spec, business_date=CUTOFF.date(), run_id="query")
    return tables.read_table(spark, spec.layers.name("balance")).select("account_id", "current_balance", "last_day_bonus")


def q_catalog_fold(spark, sf):
    """Silver by name after two folds: the view's partitions lie in both versions."""
    spec = _spec(spark, "catalog-fold", catalog=_database(spark, "ledger"))
    tx = _tx(spark, sf)
    pl.fold_batch(spark, tx.filter(~_is_last()), 0, spec)
    pl.fold_batch(spark, tx.filter(_is_last()), 1, spec)
    return tables.read_table(spark, spec.layers.name("silver"))


def q_stream_from_table(spark, sf):
    """The fold over a catalog table read as a stream by name, in two runs."""
    database = _database(spark, "ledger")
    spec, name = _spec(spark, "stream-table", catalog=database), f"{database}.events"
    tx = _tx(spark, sf)
    for rows in (tx.filter(~_is_last() | F.col("event_time").isNull()), tx.filter(_is_last())):
        tables.append_table(rows, name)
        st.silver_fold_stream(spark, st.table_stream(spark, name), spec, CUTOFF).awaitTermination()
    return tables.read_table(spark, spec.layers.name("silver"))


# --- Silver on one version line --------------------------------------------------------

def q_fold_after_recompute(spark, sf):
    """Fold, full recompute, fold: nothing is lost or counted twice."""
    spec = _spec(spark, "fold-recompute")
    tx = _tx(spark, sf)
    before, last = tx.filter(~_is_last()), tx.filter(_is_last())
    tables.write_routed(before, spec.paths.routed)
    pl.fold_batch(spark, before, 0, spec)
    pl.run_silver(spark, spec)
    pl.fold_batch(spark, last, 1, spec)
    return _silver(spark, spec)


def q_stream_redelivery(spark, sf):
    """A later batch corrects events of an earlier one: the latest version counts."""
    spec = _spec(spark, "redelivery")
    valid = quality.valid_events(_tx(spark, sf))
    pl.fold_batch(spark, valid, 0, spec)
    again = fx.redelivered(valid, fx.LAST_BATCH_START).join(valid.select("event_id", F.col("event_time").alias("first")), "event_id")
    pl.fold_batch(spark, again.filter(F.col("event_time") > F.col("first")).drop("first"), 1, spec)
    return _silver(spark, spec)


def q_stream_retracting(spark, sf):
    """The corrections of ``stream_redelivery`` as two deliveries of a stream whose state is keyed by event."""
    spec = _spec(spark, "retracting")
    valid = quality.valid_events(_tx(spark, sf))
    valid.write.parquet(spec.source_path)
    st.retracting_totals_stream(spark, spec.source_path, spec, CUTOFF).awaitTermination()
    fx.redelivered(valid, fx.LAST_BATCH_START).write.mode("append").parquet(spec.source_path)
    st.retracting_totals_stream(spark, spec.source_path, spec, CUTOFF).awaitTermination()
    return _silver(spark, spec)


def q_silver_five_columns(spark, sf):
    """Raw events without an id, through Bronze and Silver."""
    spec = _spec(spark, "five-columns")
    _raw_types(_tx(spark, sf)).drop("event_id").write.parquet(spec.source_path)
    pl.run_bronze(spark, spec)
    pl.run_silver(spark, spec)
    return _silver(spark, spec)


def q_text_event_ids(spark, sf):
    """Events whose ids are text, some delivered again, folded in two batches."""
    spec = _spec(spark, "text-ids")
    tx = _tx(spark, sf).withColumn("event_id", F.concat(F.lit("evt-0000-"), F.col("event_id").cast("string")))
    before, last = tx.filter(~_is_last()), tx.filter(_is_last())
    pl.fold_batch(spark, before, 0, spec)
    pl.fold_batch(spark, last.unionByName(before.filter(F.dayofmonth("event_time") == 28)), 1, spec)
    return _silver(spark, spec)


def q_state_buckets(spark, sf):
    """Silver after a fold of everything and one fold per account group: each rewrites its own buckets only."""
    spec = _spec(spark, "state-buckets", state_buckets=32)
    tx = _tx(spark, sf)
    last = tx.filter(_is_last())
    group = F.pmod(F.xxhash64("account_id"), F.lit(2))
    pl.fold_batch(spark, tx.filter(~_is_last()), 0, spec)
    for n in (0, 1):
        pl.fold_batch(spark, last.filter(group == n), n + 1, spec)
    return _silver(spark, spec)


def q_gold_from_day_state(spark, sf):
    """Balances from a day-grain Silver, folded in two batches."""
    spec = _spec(spark, "gold-day", grain="day")
    tx = _tx(spark, sf)
    pl.fold_batch(spark, tx.filter(~_is_last()), 0, spec)
    pl.fold_batch(spark, tx.filter(_is_last()), 1, spec)
    pl.run_gold(spark, spec, CUTOFF.date(), "007")
    return tables.SnapshotTable(spec.paths.balance).read(spark).select("account_id", "current_balance", "last_day_bonus")


def q_snapshot_latest(spark, sf):
    """The latest complete version of a table that was created and replaced."""
    store = tables.SnapshotTable(scratch_path(spark, "snapshots"))
    valid = quality.valid_events(_tx(spark, sf))
    if not store.is_table(spark):
        store.write(balances.silver_balances(valid.filter(~_is_last()), CUTOFF), 0)
    store.write(balances.silver_balances(valid, CUTOFF), store.next_version(spark))
    return store.read(spark)


def q_cutoff_from_run_date(spark, sf):
    """Silver with the cutoff of a configured run date."""
    valid = quality.valid_events(_tx(spark, sf))
    cutoff = balances.resolve_cutoff(valid, LedgerConfig(run_date=dt.date(2024, 1, 30)))
    return balances.silver_balances(valid, cutoff)


# --- Gold and publishing ------------------------------------------------------------------

def q_pipeline_balance(spark, sf):
    """Raw files to current balances through every task of the pipeline."""
    spec = _spec(spark, "pipeline")
    _raw_types(_tx(spark, sf)).write.parquet(spec.source_path)
    pl.run_pipeline(spark, spec, business_date=CUTOFF.date(), run_id="query")
    return tables.SnapshotTable(spec.paths.balance).read(spark).select("account_id", "current_balance", "last_day_bonus")


def q_balance_after_rerun(spark, sf):
    """A rerun of a published date with more events: the bonus is the published one."""
    spec = _spec(spark, "rerun")
    valid = quality.valid_events(_tx(spark, sf))
    store = tables.SnapshotTable(spec.paths.silver)
    for n, events in enumerate((valid.filter(~_is_last()), valid)):
        store.write(balances.silver_balances(events, CUTOFF), n)
        pl.run_gold(spark, spec, CUTOFF.date(), f"run-{n}")
    return tables.SnapshotTable(spec.paths.balance).read(spark)


def q_export_partitions(spark, sf):
    """Daily flow exported by day; one day exported again replaces itself only."""
    path = scratch_path(spark, "export")
    flow = balances.daily_net(quality.valid_events(_tx(spark, sf)))
    tables.export_partitions(flow, path, "d")
    tables.export_partitions(flow.filter("d = date '2024-01-15'"), path, "d")
    return spark.read.parquet(path).select("account_id", F.col("d").cast("date").alias("d"), "net")


# --- data quality ----------------------------------------------------------------------------

def q_quarantine_time_range(spark, sf):
    """Events moved out of the accepted range of times, per reason."""
    years = F.when(F.col("event_id") % 101 == 0, 100 * 12).when(F.col("event_id") % 103 == 0, -60 * 12).otherwise(0)
    moved = _tx(spark, sf).withColumn("event_time", F.col("event_time") + F.make_ym_interval(F.lit(0), years))
    return quality.reason_counts(moved)


def q_contract_violations(spark, sf):
    """What the gate before Gold finds in a Silver table with repeated accounts and missing sums."""
    silver = balances.silver_balances(quality.valid_events(_tx(spark, sf)), CUTOFF)
    some = F.col("account_id").endswith("7")
    broken = silver.unionByName(silver.filter(some)).withColumn("total_amount", F.when(~F.col("account_id").endswith("3"), F.col("total_amount")))
    found = contracts.check(broken, schema.SILVER, ["account_id"])
    return spark.createDataFrame([(v.kind, v.detail) for v in found], "kind string, detail string")


def q_rolling_24h_min_redelivered(spark, sf):
    """The last day's events delivered twice: every delivery has its row."""
    valid = quality.valid_events(_tx(spark, sf))
    return balances.rolling_24h_min(valid.unionByName(valid.filter(_is_last())))


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
