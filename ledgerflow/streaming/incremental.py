"""Structured Streaming twins of the batch operators.

* ``silver_fold_stream``: files -> ``foreachBatch`` fold into Silver snapshots,
  keyed by the micro-batch id (a replay rebuilds the same version).
* ``account_totals_table_stream``: the Silver aggregate as a native stateful
  aggregate in ``update`` mode (conditional sums; ``pivot`` is not allowed on a
  stream), upserted into Silver snapshots.
* ``retracting_totals_stream``: a stateful operator that keeps each event's version,
  so that a correction takes it back; its changes are folded into Silver.
* ``daily_flow_stream``: 1-day tumbling windows with a watermark, ``append``
  mode: each closed day is emitted once; ``late_flow`` gives what came after.
* ``dedup_stream``: one delivery of each event; what came after the watermark
  goes to a side table, so every row read is out, a repeat or late.
* ``bronze_stream``: normalised events to the valid and the quarantine
  partition of one checkpointed file sink; every row lands in one of them.

Types, names and time range are those of the configuration everywhere, so
every entry gives the same Silver. The stateful queries count valid rows only; run them over the valid partition
that ``bronze_stream`` writes, or beside it: it keeps what they pass over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerflow.config import LedgerConfig
from ledgerflow.functions.money import money, zero
from ledgerflow.functions.rules import is_eligible
from ledgerflow.operators import balances, merge, quality
from ledgerflow.plans.pipeline import PipelineSpec, _place_of, change_state, fold_batch
from ledgerflow.schema import EVENT
from ledgerflow.sources import events as ev
from ledgerflow.sources import tables
from ledgerflow.sources.runs import EventRuns
from ledgerflow.streaming.metrics import ROUTING


def _source(spark: SparkSession, source: str | DataFrame, max_files_per_trigger: int | None) -> DataFrame:
    """A directory of event files, or a streaming frame as it is (``table_stream``)."""
    return event_stream(spark, source, max_files_per_trigger) if isinstance(source, str) else source


def event_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None, schema=None) -> DataFrame:
    """Streaming scan of a directory of event Parquet files.

    The schema is the union over all files already there (raw sources may
    hold text times or double amounts, later ones more columns), else the
    event contract. A stream started again on the same checkpoint takes the
    schema of that moment: a column that files gained meanwhile is there, NULL
    for files without it.
    """
    if schema is None:
        schema = tables.read_evolving(spark, source_dir).schema if tables.has_data(spark, source_dir) else EVENT
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(source_dir)


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """Streaming read of a catalog table by name (new files/commits only)."""
    return spark.readStream.table(name)


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer


def silver_fold_stream(
    spark: SparkSession,
    source: str | DataFrame,
    spec: PipelineSpec,
    cutoff: dt.datetime | None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    grain: str | None = None,
    cross_batch_dedup: bool | None = None,
) -> StreamingQuery:
    """Process new files into Silver, one snapshot version per micro-batch.

    ``source`` is a directory of event files or a streaming frame, such as a
    catalog table read with ``table_stream``.

    Keep the checkpoint next to the Silver table: a fresh checkpoint restarts
    batch ids at 0, which must go with a fresh Silver table.
    """
    ckpt = checkpoint or f"{spec.paths.checkpoints}/silver_fold"

    def on_batch(df: DataFrame, batch_id: int) -> None:
        fold_batch(df.sparkSession, df, batch_id, spec, cutoff, grain, cross_batch_dedup)

    w = _source(spark, source, max_files_per_trigger).writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    return _trigger(w, available_now).start()


def _valid(events: DataFrame, cfg: LedgerConfig) -> DataFrame:
    return quality.valid_under(ev.normalize(events, cfg.cols, cfg.event_id_type), cfg)


def account_totals(events: DataFrame, cutoff: dt.datetime, cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """Silver aggregate as one stateful aggregate (valid rows only)."""
    cols = cfg.cols
    valid = _valid(events, cfg)
    flag = is_eligible(cols, cutoff)
    early = F.coalesce(money(F.sum(F.when(flag, F.col(cols.amount)))), zero())
    late = F.coalesce(money(F.sum(F.when(~flag, F.col(cols.amount)))), zero())
    return valid.groupBy(cols.account_id).agg(
        money(early + late).alias(cols.total_amount),
        early.alias(cols.amount_cdi_applicable),
        late.alias(cols.amount_cdi_not_applicable),
    )


def account_totals_table_stream(
    spark: SparkSession,
    source_dir: str,
    spec: PipelineSpec,
    cutoff: dt.datetime,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Update-mode stateful aggregate with a durable, replay-safe sink.

    The state store keeps one running row per account; each micro-batch
    emits the accounts it changed with their full current totals, which are
    upserted (replaced, not added) into a new Silver version. A batch that does
    not follow the latest version is refused; a replayed one rebuilds its own.
    (Use the RocksDB state store provider for large account counts.)
    """
    ckpt = checkpoint or f"{spec.paths.checkpoints}/account_totals"
    cols = spec.cfg.cols

    def on_batch(df: DataFrame, batch_id: int) -> None:
        store = spec.layers.snapshots("silver")
        version, base = _place_of(df.sparkSession, store, batch_id)
        meta = {"kind": "fold", "grain": "account", "cutoff": cutoff.isoformat(), "last_batch": batch_id, "base": base}
        # the batch holds only the accounts it changed, with their present totals
        replaced = lambda old, new: merge.upsert(old, new, cols.account_id)
        change_state(df.sparkSession, spec, store, version, base, df.select(*cols.silver_columns), replaced, meta)

    agg = account_totals(event_stream(spark, source_dir, max_files_per_trigger), cutoff, spec.cfg)
    w = agg.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", ckpt)
    return _trigger(w, available_now).start()


#: Groups of the retracting state. A call takes a whole group of events at once, and a batch rewrites the groups of its events.
EVENT_GROUPS = 4096
_VERSION = pa.schema([("event", pa.string()), ("account", pa.string()), ("at", pa.int64()), ("known", pa.bool_()), ("cents", pa.int64())])


def _pack(versions: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _VERSION, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_pandas(versions, _VERSION, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpack(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas()


def _latest(versions: pd.DataFrame) -> pd.DataFrame:
    """The latest version of every event (by time, then amount; of equal ones the first), events in order of appearance."""
    event = pd.factorize(versions["event"], use_na_sentinel=False)[0]
    at, known, cents = (versions[c].to_numpy() for c in ("at", "known", "cents"))
    order = np.lexsort((~cents, ~known, ~at, event))
    of = event[order]
    return versions.iloc[order[np.concatenate([[True], of[1:] != of[:-1]])]]


def _latest_versions(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What one batch changes about the events of one group: their folded versions taken back, their latest ones added.

    The state is the version counted so far of every event: account, time in
    microseconds, whether the amount is known, cents. A version that is not
    later (by time, then amount) changes nothing.
    """
    old = _unpack(state.get[0]) if state.exists else None
    best = old
    for part in parts:
        part = part[_VERSION.names]
        best = _latest(part if best is None else pd.concat([best, part], ignore_index=True))
    # the events of the state come first, in its order
    n = 0 if old is None else len(old)
    changed = np.ones(len(best), bool)
    if n:
        changed[:n] = np.any([best[c].to_numpy()[:n] != old[c].to_numpy() for c in ("at", "known", "cents")], axis=0)
    if changed.any():
        state.update((_pack(best),))
        now = best[changed].assign(sign=1)
        yield (pd.concat([now, old[changed[:n]].assign(sign=-1)]) if changed[:n].any() else now).drop(columns="event")


def account_changes(events: DataFrame, cfg: LedgerConfig = LedgerConfig(), groups: int = EVENT_GROUPS) -> DataFrame:
    """``account, time, amount`` rows whose sums are those of the latest version of every event.

    A stateful operator keyed by event: a correction that comes in a later
    batch emits the reversal of the version before it beside itself, also when
    it moves the event to another account or past the cutoff. The state holds
    one small row per event, packed by event hash into ``groups`` groups, so
    that a call of the function serves many events; no account's size
    matters. Events need an id. ``groups`` is part of a checkpoint: a stream
    cannot be started again with another number.
    """
    cols = cfg.cols
    if cols.event_id not in events.columns:
        raise ValueError("a retracting aggregate needs event ids")
    valid = _valid(events, cfg)
    account = valid.schema[cols.account_id].dataType
    amount = F.col(cols.amount)
    # whole numbers and text: times, decimals and numbers with nulls would pass Python's own types
    versions = valid.select(
        F.pmod(F.xxhash64(cols.event_id), F.lit(groups)).alias("group"),
        F.col(cols.event_id).cast("string").alias("event"),
        F.col(cols.account_id).cast("string").alias("account"),
        F.unix_micros(cols.event_time).alias("at"),
        amount.isNotNull().alias("known"),
        F.coalesce((money(amount) * 100).cast("long"), F.lit(0).cast("long")).alias("cents"),
    )
    fields = "account string, at bigint, known boolean, cents bigint, sign bigint"
    changes = versions.groupBy("group").applyInPandasWithState(_latest_versions, fields, "versions binary", "update", GroupStateTimeout.NoTimeout)
    signed = money((F.col("cents") * F.col("sign")).cast("decimal(18,0)") / 100)
    return changes.select(
        F.col("account").cast(account).alias(cols.account_id), F.timestamp_micros("at").alias(cols.event_time), F.when(F.col("known"), signed).alias(cols.amount)
    )


def retracting_totals_stream(
    spark: SparkSession,
    source: str | DataFrame,
    spec: PipelineSpec,
    cutoff: dt.datetime,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Silver from a stream with corrections: the changes of ``account_changes`` folded into a new version per batch.

    Gives what ``silver_fold_stream`` gives with cross-batch dedup; here the
    folded versions lie in the state store instead of sorted runs. Only the
    buckets of the batch's accounts are rewritten; a replayed batch rebuilds
    its own version, since its state is that of the batch before.
    """
    ckpt = checkpoint or f"{spec.paths.checkpoints}/retracting_totals"
    cols = spec.cfg.cols

    def on_batch(df: DataFrame, batch_id: int) -> None:
        store = spec.layers.snapshots("silver")
        version, base = _place_of(df.sparkSession, store, batch_id)
        meta = {"kind": "fold", "grain": "account", "cutoff": cutoff.isoformat(), "last_batch": batch_id, "base": base}
        incoming = balances.silver_balances(df, cutoff, cols)
        change_state(df.sparkSession, spec, store, version, base, incoming, lambda old, new: balances.fold(old, new, cols), meta)

    changes = account_changes(_source(spark, source, max_files_per_trigger), spec.cfg)
    w = changes.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", ckpt)
    return _trigger(w, available_now).start()


def daily_flow(events: DataFrame, watermark: str = "1 day", cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """Net flow per account and calendar day; with a watermark, append mode
    emits a day once the watermark has passed its end."""
    cols = cfg.cols
    return (
        _valid(events, cfg)
        .withWatermark(cols.event_time, watermark)
        .groupBy(cols.account_id, F.window(cols.event_time, "1 day").alias("w"))
        .agg(money(F.sum(cols.amount)).alias("net"))
        .select(cols.account_id, F.to_date(F.col("w.start")).alias("d"), "net")
    )


def daily_flow_stream(
    spark: SparkSession,
    source_dir: str,
    out_path: str,
    checkpoint: str,
    watermark: str = "1 day",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    cfg: LedgerConfig = LedgerConfig(),
) -> StreamingQuery:
    flows = daily_flow(event_stream(spark, source_dir, max_files_per_trigger), watermark, cfg)
    w = flows.writeStream.outputMode("append").format("parquet").option("path", out_path).option(
        "checkpointLocation", checkpoint
    )
    return _trigger(w, available_now).start()


def late_flow(events: DataFrame, emitted: DataFrame, cfg: LedgerConfig = LedgerConfig()) -> DataFrame:
    """``account_id, d, net``: the flow of closed days that ``daily_flow_stream``
    did not emit, because its events came after the watermark.

    The side table of the stream: all valid events against what was emitted,
    for the days up to the last emitted one. Emitted plus late is the whole
    flow of those days.
    """
    cols = cfg.cols
    whole = balances.daily_net(_valid(events, cfg), cols)
    last = emitted.agg(F.max("d").alias("_last"))
    minus = emitted.select(cols.account_id, "d", (-F.col("net")).alias("net"))
    both = whole.unionByName(minus).join(F.broadcast(last), F.col("d") <= F.col("_last")).drop("_last")  # one row
    return both.groupBy(cols.account_id, "d").agg(money(F.sum("net")).alias("net")).filter("net <> 0")


def dedup_stream(
    spark: SparkSession,
    source_dir: str,
    out_path: str,
    checkpoint: str,
    watermark: str = "1 day",
    cfg: LedgerConfig = LedgerConfig(),
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """One delivery of each event to ``out_path``, nothing lost on the way.

    Spark's own dropDuplicatesWithinWatermark drops events behind the
    watermark without a trace, so the batches are split here instead, under
    the same watermark: the latest event time of all batches before, less the
    delay. Beside ``out_path`` lie ``_late`` (rows behind the watermark, or
    without a time or an id, with the reason), ``_progress`` (one row per
    batch: rows read, out, repeats, late, watermark; rows = out + repeats +
    late) and ``_seen`` (ids that may still be repeated, as sorted runs). A
    batch replaces its own partitions, so a replay changes nothing.
    """

    def on_batch(df: DataFrame, batch_id: int) -> None:
        dedup_batch(df.sparkSession, df, batch_id, out_path, watermark, cfg)

    w = event_stream(spark, source_dir, max_files_per_trigger).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now).start()


PROGRESS = "rows long, out long, repeats long, late long, max_time timestamp, watermark timestamp, batch long"


def dedup_batch(spark: SparkSession, batch: DataFrame, batch_id: int, out_path: str, delay: str, cfg: LedgerConfig) -> None:
    """Split one micro-batch into new events, repeats and late rows (see ``dedup_stream``)."""
    cols = cfg.cols
    key, at, number = cols.event_id, F.col(cols.event_time), F.lit(batch_id).cast("long")
    seen = EventRuns(f"{out_path}_seen", key, (cols.event_time,))
    progress = f"{out_path}_progress"
    before = spark.createDataFrame([], PROGRESS)
    if tables.has_data(spark, progress):
        before = spark.read.schema(PROGRESS).parquet(progress).filter(F.col("batch") < batch_id)
    behind = lambda c: F.max(c) - F.expr(f"INTERVAL {delay}")
    # as text: a collected timestamp would be shifted into the driver's OS time zone
    limits = before.select(behind("max_time").alias("w"), (behind("max_time") - F.expr(f"INTERVAL {delay}")).alias("old")).select(
        F.col("w").cast("string").alias("w"), F.col("old").cast("string").alias("old")
    ).first()
    line = F.lit(limits.w).cast("timestamp")
    events = ev.normalize(batch, cols, cfg.event_id_type).withColumn(
        "reason", F.when(at.isNull(), "no_time").when(F.col(key).isNull(), "no_id").when(at < line, "late")
    ).persist()
    timely = events.filter("reason is null").drop("reason")
    rest = [F.col(c) for c in timely.columns if c != key]
    # of copies within the batch the earliest stays
    first = timely.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(at, *[c for c in rest])).alias("_r")).select(key, "_r.*")
    known = seen.candidates(spark, first, batch_id)
    new = first if known is None else first.join(known.select(key).distinct(), key, "left_anti")
    new = new.select(*timely.columns).withColumn("batch", number)
    tables.write_partitions(new, out_path, ["batch"])
    late = events.filter("reason is not null").withColumn("batch", number)
    tables.write_partitions(late, f"{out_path}_late", ["batch"])
    mine = f"{out_path}/batch={batch_id}"
    done = spark.read.schema(timely.schema).parquet(mine) if tables.has_data(spark, mine) else timely.limit(0)
    seen.write(done.select(key, cols.event_time), batch_id)
    zero = F.lit(0).cast("long")
    both = events.agg(F.count(F.lit(1)).alias("rows"), zero.alias("out"), F.count("reason").alias("late"), F.max(at).alias("max_time")).unionByName(
        done.agg(zero.alias("rows"), F.count(F.lit(1)).alias("out"), zero.alias("late"), F.max(at).alias("max_time"))
    )
    told = both.agg(*[F.sum(c).alias(c) for c in ("rows", "out", "late")], F.max("max_time").alias("max_time")).select(
        "rows", "out", (F.col("rows") - F.col("out") - F.col("late")).alias("repeats"), "late", "max_time", line.alias("watermark"), number.alias("batch")
    )
    tables.write_partitions(told, progress, ["batch"])
    events.unpersist()
    seen.compact(spark, below=batch_id)
    if limits.old:
        seen.drop_older(spark, batch_id, cols.event_time, limits.old)


def bronze_stream(
    spark: SparkSession,
    source_dir: str,
    out_path: str,
    checkpoint: str,
    spec: PipelineSpec | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """New files, normalised, to ``out_path/route=valid`` and ``route=quarantine``
    (append, checkpointed); rejected rows keep their raw values and reasons."""
    cfg = spec.cfg if spec else LedgerConfig()
    events = ev.normalize(tables.with_raw(event_stream(spark, source_dir, max_files_per_trigger)), cfg.cols, cfg.event_id_type)
    routed = tables.tag_routes(events, cfg.cols, cfg.transaction_types, cfg.time_range)
    # counted while it runs; streaming.metrics keeps the counts per batch
    w = routed.observe(ROUTING, *tables.route_counts(cfg.cols)).writeStream.outputMode("append").format("parquet").partitionBy(tables.ROUTE).option("path", out_path).option(
        "checkpointLocation", checkpoint
    )
    return _trigger(w, available_now).start()
