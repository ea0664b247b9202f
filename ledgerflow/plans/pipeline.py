"""Bronze -> Silver -> Gold, batch and incremental, over one table root.

Idempotence rules (what a rerun or a replay does):

* Bronze appends, so the same file landed twice gives duplicate rows; Silver
  deduplicates on ``event_id`` before aggregating, so balances do not change.
* Silver has one line of versions. A full recompute adds a version made from
  all of Bronze; a fold adds one made from the latest version plus a
  micro-batch. Each records the last batch it contains: a fold whose batch
  does not follow is refused, a replayed batch rebuilds its own version.
* Gold writes the audit partition (business_date, run_id) with dynamic
  partition overwrite, publishes only payouts whose (account, business_date)
  is not yet published, and upserts balances, derived from the payout that was
  published, into a new snapshot version; a balance never goes back in time.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schema
from ledgerflow.config import MONEY_TYPE, LedgerConfig, TablePaths
from ledgerflow.operators import accrual, balances, contracts, merge, quality
from ledgerflow.session import remove_path
from ledgerflow.sources import events as ev
from ledgerflow.sources import tables
from ledgerflow.sources.layers import CatalogLayers, Layers, PathLayers
from ledgerflow.sources.runs import EventRuns

log = logging.getLogger("ledgerflow")


@dataclass(frozen=True)
class PipelineSpec:
    """The whole pipeline as one document; every path derives from ``root``."""

    root: str
    source: str | None = None  # raw event files (dir or glob); default <root>/raw
    cfg: LedgerConfig = field(default_factory=LedgerConfig)
    dedup: bool = True
    # incremental Silver: "account" (fixed cutoff) or "day" (any midnight cutoff)
    grain: str = "account"
    cross_batch_dedup: bool = True
    source_format: str = "parquet"  # parquet | csv | json
    # database whose tables are the layers; None: folders below the root
    catalog: str | None = None
    # hash buckets of Silver; a fold rewrites those it touches, so there should be many more than a batch's share of accounts
    state_buckets: int = 64

    @property
    def paths(self) -> TablePaths:
        return TablePaths(self.root)

    @property
    def layers(self) -> Layers:
        return CatalogLayers(self.catalog, self.paths) if self.catalog else PathLayers(self.paths)

    @property
    def source_path(self) -> str:
        return self.source or self.paths.source

    @classmethod
    def from_json(cls, text: str) -> "PipelineSpec":
        """``{"root": ..., "source": ..., "dedup": true, "grain": "account",
        "cross_batch_dedup": true, "catalog": null, "state_buckets": 64,
        "ledger": {...}}``; ``ledger`` as in ``config.ledger_config_from_dict``."""
        import json

        from ledgerflow.config import ledger_config_from_dict

        d = json.loads(text)
        return cls(
            root=d["root"],
            source=d.get("source"),
            cfg=ledger_config_from_dict(d.get("ledger", {})),
            dedup=bool(d.get("dedup", True)),
            grain=d.get("grain", "account"),
            cross_batch_dedup=bool(d.get("cross_batch_dedup", True)),
            source_format=d.get("source_format", "parquet"),
            catalog=d.get("catalog"),
            state_buckets=int(d.get("state_buckets", cls.state_buckets)),
        )


# --- Bronze ----------------------------------------------------------------------

def run_bronze(spark: SparkSession, spec: PipelineSpec) -> dict[str, int]:
    """Read raw events once and append them to the valid / quarantine tables;
    returns the row counts observed during the write."""
    observed, seen = tables.observe_routes(normalized(read_raw(spark, spec), spec), spec.cfg.cols, spec.cfg.transaction_types, spec.cfg.time_range)
    spec.layers.append(observed, "routed", [tables.ROUTE])
    counts = dict(seen.get)
    if counts["rows"] != counts["valid"] + counts["quarantine"]:
        raise RuntimeError(f"routing lost rows: {counts}")
    log.info("bronze: %s -> %s %s", spec.source_path, spec.paths.routed, counts)
    return counts


def normalized(raw: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Raw rows in the contract's types, with their values as delivered beside them."""
    return ev.normalize(tables.with_raw(raw), spec.cfg.cols, spec.cfg.event_id_type)


def read_raw(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """Raw event files in the configured format. Text formats are read with
    every column as a string (no inference pass over the data); ``normalize``
    then parses times and money, and unparseable values are quarantined."""
    fmt = spec.source_format
    if fmt == "parquet":
        return spark.read.parquet(spec.source_path)
    if fmt == "csv":
        return spark.read.option("header", "true").option("inferSchema", "false").csv(spec.source_path)
    if fmt == "json":
        return spark.read.option("primitivesAsString", "true").json(spec.source_path)
    raise ValueError(f"unsupported source format {fmt!r}")


def bronze_valid(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """Valid Bronze rows as delivered: the event columns that the source has."""
    df = spec.layers.read(spark, "routed").filter(F.col(tables.ROUTE) == "valid")
    return df.select(*[c for c in spec.cfg.cols.event_columns if c in df.columns])


def _deduplicated(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """The latest version of each event; events without an id column stay as they are."""
    cols = spec.cfg.cols
    if spec.dedup and cols.event_id in df.columns:
        return quality.dedup_latest(df, cols.event_id, (cols.event_time, cols.amount))
    return df


def bronze_events(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """Valid Bronze rows, deduplicated on the event key (latest correction wins)."""
    return _deduplicated(bronze_valid(spark, spec), spec)


# --- Silver ------------------------------------------------------------------------

def run_silver(spark: SparkSession, spec: PipelineSpec) -> int:
    """Full recompute from Bronze into a new Silver snapshot; returns its version.

    The data-driven cutoff comes from the latest delivered time, which needs
    no deduplication. The version keeps the number of the last batch folded
    before it, so the stream goes on from there.
    """
    cutoff = balances.resolve_cutoff(bronze_valid(spark, spec), spec.cfg)
    events = bronze_events(spark, spec)
    silver = balances.day_state(events, spec.cfg.cols) if spec.grain == "day" else balances.silver_balances(events, cutoff, spec.cfg.cols)
    store = spec.layers.snapshots("silver")
    latest = store.latest(spark)
    version = 0 if latest is None else latest + 1
    last_batch = None if latest is None else store.meta(spark, latest).get("last_batch")
    store.write(
        silver, version, spec.cfg.cols.account_id, spec.state_buckets, kind="recompute", grain=spec.grain, cutoff=cutoff.isoformat(), last_batch=last_batch
    )
    finish_version(spark, spec, store, version)
    log.info("silver: version %d (cutoff %s)", version, cutoff)
    return version


def fold_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    spec: PipelineSpec,
    cutoff: dt.datetime | None = None,
    grain: str | None = None,
    cross_batch_dedup: bool | None = None,
) -> int:
    """Fold one micro-batch of events into Silver as a new version; returns it.

    The batch must follow the last one that the latest version contains. A
    batch that a version was already made of is replayed: that version is
    rebuilt from the one below it, so nothing is added twice. Any other batch
    is refused, among them the first batch of a stream that starts over a
    table recomputed from the same Bronze rows.

    ``grain="account"`` stores the four Silver columns for a fixed ``cutoff``.
    ``grain="day"`` stores net flow per (account, day): late events fold into
    their own day and ``silver_view`` reads out any midnight cutoff later.
    Either way only the hash buckets of the batch's accounts are read and
    written; the files of the others stay.

    The routed batch is written once and read back: its rejected rows stay as
    the fold's quarantine, one partition per batch.
    Duplicates are removed within the batch, and across batches with
    ``cross_batch_dedup``: latest correction wins in either case, an event
    folded earlier being reversed before its correction is added. Events
    without an id column are folded as they come.
    """
    cols = spec.cfg.cols
    grain = grain or spec.grain
    cross_batch_dedup = spec.cross_batch_dedup if cross_batch_dedup is None else cross_batch_dedup
    cutoff = cutoff or spec.cfg.cutoff
    store = spec.layers.snapshots("silver")
    version, base = _place_of(spark, store, batch_id)
    routed = tables.tag_routes(normalized(batch, spec), cols, spec.cfg.transaction_types, spec.cfg.time_range)
    number = F.lit(batch_id).cast("long")
    tables.write_partitions(routed.withColumn("batch", number), spec.paths.fold_routed, [tables.ROUTE, "batch"])
    mine = f"{spec.paths.fold_routed}/{tables.ROUTE}=valid/batch={batch_id}"
    event_columns = [c for c in cols.event_columns if c in batch.columns]
    event_schema = routed.select(*event_columns).schema
    # without a valid row there is no such folder
    valid = spark.read.schema(event_schema).parquet(mine) if tables.has_data(spark, mine) else spark.createDataFrame([], event_schema)
    valid = _deduplicated(valid, spec).persist()
    runs = _runs(spec)
    by_id = spec.dedup and cols.event_id in event_columns
    changes = _net_of_earlier(spark, valid, batch_id, runs, spec) if cross_batch_dedup and by_id else valid
    if grain == "day":
        incoming, merge_fn = balances.day_state(changes, cols), balances.fold_day_state
    elif grain == "account":
        if cutoff is None:
            raise ValueError("an account-grain fold needs a fixed cutoff")
        incoming, merge_fn = balances.silver_balances(changes, cutoff, cols), balances.fold
    else:
        raise ValueError(f"unknown grain {grain!r}")
    meta = {"kind": "fold", "grain": grain, "cutoff": cutoff and cutoff.isoformat(), "last_batch": batch_id, "base": base}
    change_state(spark, spec, store, version, base, incoming, lambda old, new: merge_fn(old, new, cols), meta)
    if cross_batch_dedup and by_id:
        runs.compact(spark, below=batch_id)
    valid.unpersist()
    remove_path(spark, mine)
    return version


def change_state(
    spark: SparkSession,
    spec: PipelineSpec,
    store: tables.SnapshotTable,
    version: int,
    base: int | None,
    incoming: DataFrame,
    merge_fn: Callable[[DataFrame, DataFrame], DataFrame],
    meta: dict,
) -> None:
    """Write ``merge_fn(stored, incoming)`` as a new version, over the buckets of ``incoming`` alone.

    The driver learns which buckets those are, at most ``state_buckets``
    numbers. A base that was not written in buckets is rewritten whole.
    """
    key = spec.cfg.cols.account_id
    buckets = store.meta(spark, base).get("buckets") if base is not None else None
    if buckets is None:
        new = incoming if base is None else merge_fn(store.read(spark, base), incoming)
        store.write(new, version, key, spec.state_buckets, **meta)
    else:
        incoming = incoming.persist()  # a few numbers per account of the batch, used twice
        touched = [r[0] for r in incoming.select(tables.bucket_of(key, buckets)).distinct().collect()]
        new = merge_fn(store.read_buckets(spark, base, touched, incoming.schema), incoming)
        store.write_buckets(new, version, key, buckets, **meta)
        incoming.unpersist()
    finish_version(spark, spec, store, version)


def finish_version(spark: SparkSession, spec: PipelineSpec, store: tables.SnapshotTable, version: int, layer: str = "silver") -> None:
    """Drop what no offered version needs and give the new one to readers by name."""
    store.drop_below(spark, version)
    spec.layers.publish(spark, layer, version)


def _runs(spec: PipelineSpec) -> EventRuns:
    cols = spec.cfg.cols
    return EventRuns(spec.paths.seen_events, cols.event_id, (cols.event_time, cols.amount))


def _place_of(spark: SparkSession, store: tables.SnapshotTable, batch_id: int) -> tuple[int, int | None]:
    """(version to write, version to build from) for a micro-batch, or an error if it does not follow."""
    latest = store.latest(spark)
    if latest is None:
        if batch_id:
            raise ValueError(f"batch {batch_id} does not follow: there is no table yet")
        return 0, None
    meta = store.meta(spark, latest)
    last = meta.get("last_batch")
    if last is not None and batch_id == last + 1:
        return latest + 1, latest
    if meta.get("kind") == "fold" and batch_id == last:
        return latest, meta["base"]
    raise ValueError(f"batch {batch_id} does not follow version {latest} ({meta})")


def _net_of_earlier(spark: SparkSession, valid: DataFrame, batch_id: int, runs: EventRuns, spec: PipelineSpec) -> DataFrame:
    """The batch's events net of what earlier batches folded for the same ids.

    An incoming event later than its folded version (by time, then amount)
    comes with a reversal of that version; one that is not later is dropped.
    Of the folded events only the id ranges of this batch are read (see
    ``sources.runs``), and only batches below this one, so a replay sees what
    its first attempt saw.
    """
    cols = spec.cfg.cols
    key, order = cols.event_id, (cols.event_time, cols.amount)
    earlier = runs.lookup(spark, valid, batch_id)
    if earlier is None:
        return runs.write(valid, batch_id)
    earlier = earlier.select(*valid.columns)
    rank = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    pairs = valid.alias("new").join(earlier.alias("old"), F.col(f"new.{key}") == F.col(f"old.{key}"), "left")
    pairs = pairs.filter(F.col(f"old.{key}").isNull() | (rank("new") > rank("old")))
    fresh = runs.write(pairs.select(*[F.col(f"new.{c}").alias(c) for c in valid.columns]), batch_id)
    # what is new is in the run now; what it replaces is looked up under its ids
    undo = earlier.join(fresh.select(key), key, "left_semi").select(
        *[(-F.col(c)).cast(valid.schema[c].dataType).alias(c) if c == cols.amount else F.col(c) for c in valid.columns]
    )
    return fresh.unionByName(undo)


def silver_view(spark: SparkSession, spec: PipelineSpec, cutoff: dt.datetime) -> DataFrame:
    """Account rows from a day-grain Silver table for a midnight cutoff."""
    return balances.accounts_at(spec.layers.snapshots("silver").read(spark), cutoff, spec.cfg.cols)


def account_rows(spark: SparkSession, spec: PipelineSpec, business_date: dt.date) -> DataFrame:
    """The four Silver columns that Gold is computed from: Silver itself, or a
    day-grain Silver read out at the midnight the business date starts with."""
    store = spec.layers.snapshots("silver")
    version = store.latest(spark)
    if version is None:
        raise FileNotFoundError("there is no Silver version yet")
    if store.meta(spark, version).get("grain") == "day":
        return silver_view(spark, spec, dt.datetime.combine(business_date, dt.time()))
    return store.read(spark, version)


# --- Gold ----------------------------------------------------------------------------

def run_gold(
    spark: SparkSession, spec: PipelineSpec, business_date: dt.date, run_id: str, replace_payouts: bool = False
) -> None:
    """Compute Gold once and fan it out to the three tables.

    The audit partition is written first; payout and balance are projections
    of that written partition, so Silver is read and aggregated once and the
    lineage of the later writes is cut at a durable table.

    A rerun for a business date publishes no payout twice; with
    ``replace_payouts`` the date's payout partition is replaced instead.
    """
    cols = spec.cfg.cols
    silver = account_rows(spark, spec, business_date)
    contracts.require(silver, schema.named(schema.SILVER, cols), [cols.account_id], "silver")
    frames = accrual.gold_frames(silver, business_date, run_id, spec.cfg.rule, cols)
    spec.layers.replace_partitions(frames.audit, "audit", [cols.business_date, cols.run_id])

    audit = (
        spec.layers.read(spark, "audit")
        .filter((F.col(cols.business_date).cast("date") == F.lit(business_date)) & (F.col(cols.run_id) == F.lit(run_id)))
        .withColumn(cols.business_date, F.col(cols.business_date).cast("date"))
    )
    _publish_payouts(spark, audit, business_date, spec, replace_payouts)
    _upsert_balances(spark, audit, business_date, spec)
    log.info("gold: business_date=%s run_id=%s", business_date, run_id)


def _publish_payouts(
    spark: SparkSession, audit: DataFrame, business_date: dt.date, spec: PipelineSpec, replace: bool = False
) -> None:
    """Append payouts whose (account, business_date) is not yet published, or,
    with ``replace``, overwrite the business dates present in ``audit``."""
    cols = spec.cfg.cols
    candidate = audit.select(
        cols.account_id,
        cols.cdi_bonus,
        cols.run_id,
        F.current_timestamp().alias(cols.cdi_bonus_date),
        cols.business_date,
    )
    keys = [cols.account_id, cols.business_date]
    if replace:
        spec.layers.replace_partitions(candidate, "payout", [cols.business_date])
        return
    if spec.layers.exists(spark, "payout"):
        candidate = accrual.new_payouts_only(candidate, _published(spark, business_date, spec), keys)
    spec.layers.append(candidate, "payout", [cols.business_date])


def _published(spark: SparkSession, business_date: dt.date, spec: PipelineSpec) -> DataFrame:
    """The payouts of one business date (partition pruning)."""
    cols = spec.cfg.cols
    rows = spec.layers.read(spark, "payout").withColumn(cols.business_date, F.col(cols.business_date).cast("date"))
    return rows.filter(F.col(cols.business_date) == F.lit(business_date))


def _upsert_balances(spark: SparkSession, audit: DataFrame, business_date: dt.date, spec: PipelineSpec) -> None:
    """Current balances from the payouts that are published for the date, so
    the two tables agree whatever a rerun computed. An account whose stored
    balance is of a later date keeps it."""
    cols = spec.cfg.cols
    paid = _published(spark, business_date, spec).select(cols.account_id, F.col(cols.cdi_bonus).alias("_paid"))
    bonus = F.coalesce("_paid", F.lit(0).cast(MONEY_TYPE))
    source = audit.join(paid, cols.account_id, "left").select(
        cols.account_id,
        (F.col(cols.total_amount) + bonus).cast(MONEY_TYPE).alias(cols.current_balance),
        bonus.alias(cols.last_day_bonus),
        cols.business_date,
    )
    store = spec.layers.snapshots("balance")
    latest = store.latest(spark)
    if latest is None:
        store.write(source, 0, business_date=str(business_date))
        spec.layers.publish(spark, "balance", 0)
        return
    stored = store.read(spark, latest)
    newer = stored.filter(F.col(cols.business_date) > F.lit(business_date)).select(cols.account_id)
    source = source.join(newer, cols.account_id, "left_anti")
    update = [cols.current_balance, cols.last_day_bonus, cols.business_date]
    store.write(merge.upsert(stored, source, cols.account_id, update), latest + 1, business_date=str(business_date))
    finish_version(spark, spec, store, latest + 1, "balance")


# --- daily payouts (calendar days, date-varying rate) ---------------------------------

def run_daily_payouts(
    spark: SparkSession,
    spec: PipelineSpec,
    rates: DataFrame,
    run_id: str,
    through: dt.date | None = None,
    from_day_state: bool = False,
    backfill: bool = False,
) -> int:
    """Publish one payout per (account, calendar day) through ``through``.

    The base of a day is least(opening, closing) and the rate is the one in
    force that day (as-of). A run starts after the last published day: what
    happened up to it is one opening balance per account, so its cost follows
    the new days, not the age of the ledger, and a rerun publishes nothing.
    ``backfill`` goes over all days instead and publishes what is missing in
    any of them (accounts whose first events came late). Daily balances come
    from Bronze, or from a day-grain Silver table (``from_day_state``), which
    avoids re-reading events. Returns the number of rows published.
    """
    from pyspark.sql import Observation

    cols = spec.cfg.cols
    state = spec.layers.snapshots("silver").read(spark) if from_day_state else balances.day_state(bronze_events(spark, spec), cols)
    published = spec.layers.exists(spark, "daily_payout")
    done = spec.layers.last_date(spark, "daily_payout", cols.business_date) if published and not backfill else None
    if done is not None:
        opening = state.filter(F.col("d") <= F.lit(done)).groupBy(cols.account_id).agg(F.sum("net").cast(MONEY_TYPE).alias("net"))
        opening = opening.select(cols.account_id, F.lit(done).alias("d"), "net")
        state = state.select(cols.account_id, "d", "net").filter(F.col("d") > F.lit(done)).unionByName(opening)
    daily = balances.daily_balance_from_state(state, through, cols)
    pay = accrual.daily_payout(daily, rates, balances.day_span(state, through=through), spec.cfg.rule, cols)
    if done is not None:
        pay = pay.filter(F.col("d") > F.lit(done))
    candidate = pay.select(
        cols.account_id,
        cols.cdi_bonus,
        F.lit(run_id).alias(cols.run_id),
        F.current_timestamp().alias(cols.cdi_bonus_date),
        F.col("d").alias(cols.business_date),
    )
    if published and backfill:
        before = spec.layers.read(spark, "daily_payout").withColumn(cols.business_date, F.col(cols.business_date).cast("date"))
        candidate = accrual.new_payouts_only(candidate, before, [cols.account_id, cols.business_date])
    obs = Observation("daily_payouts")
    spec.layers.append(candidate.observe(obs, F.count(F.lit(1)).alias("rows")), "daily_payout", [cols.business_date])
    return int(obs.get["rows"])


def silver_date(spark: SparkSession, spec: PipelineSpec) -> dt.date:
    """The date of the cutoff that Silver was made with; a day-grain Silver
    folded without one gives the day before its last day with events."""
    store = spec.layers.snapshots("silver")
    cutoff = store.meta(spark, store.latest(spark)).get("cutoff")
    if cutoff:
        return dt.datetime.fromisoformat(cutoff).date()
    return store.read(spark).agg(F.date_sub(F.max("d"), 1)).first()[0]


# --- orchestration -------------------------------------------------------------------

def tasks(
    spec: PipelineSpec,
    business_date: dt.date | None = None,
    run_id: str = "run",
    rates: DataFrame | None = None,
) -> dict[str, Callable[[SparkSession], object]]:
    """Named tasks, in order. With a ``rates`` table, per-calendar-day payouts
    are published after Gold."""

    def gold(spark: SparkSession) -> None:
        bd = business_date
        run_gold(spark, spec, silver_date(spark, spec) if bd is None else bd, run_id)

    out: dict[str, Callable[[SparkSession], object]] = {
        "bronze": lambda spark: run_bronze(spark, spec),
        "silver": lambda spark: run_silver(spark, spec),
        "gold": gold,
    }
    if rates is not None:
        out["daily_payouts"] = lambda spark: run_daily_payouts(spark, spec, rates, run_id)
    return out


def run_pipeline(
    spark: SparkSession,
    spec: PipelineSpec,
    business_date: dt.date | None = None,
    run_id: str = "run",
    rates: DataFrame | None = None,
) -> None:
    for name, task in tasks(spec, business_date, run_id, rates).items():
        log.info("task %s", name)
        task(spark)


def main(argv: list[str] | None = None) -> int:
    """``python -m ledgerflow.plans.pipeline <root> [source]`` or
    ``python -m ledgerflow.plans.pipeline --config spec.json``; add
    ``--cluster`` to use the session from the submitting environment (e.g.
    ``spark-submit``) with SQL settings sized from the input.

    Always stops the session; errors propagate after being logged.
    """
    import sys

    from pyspark.sql import SparkSession

    from ledgerflow.session import apply_scale_settings, configure, local_session

    args = list(argv if argv is not None else sys.argv[1:])
    cluster = "--cluster" in args
    if cluster:
        args.remove("--cluster")
    if not args:
        print("usage: python -m ledgerflow.plans.pipeline (<root> [source] | --config spec.json) [--cluster]")
        return 2
    if args[0] == "--config":
        with open(args[1]) as fh:
            spec = PipelineSpec.from_json(fh.read())
    else:
        spec = PipelineSpec(root=args[0], source=args[1] if len(args) > 1 else None)
    if cluster:
        spark = configure(SparkSession.builder.appName("ledgerflow-pipeline").getOrCreate())
        settings = apply_scale_settings(spark, tables.input_size(spark, spec.source_path))
        log.info("scale settings: %s", settings)
    else:
        spark = local_session()
    try:
        run_pipeline(spark, spec)
        return 0
    except Exception:
        log.exception("pipeline failed")
        raise
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
