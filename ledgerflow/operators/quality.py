"""Bronze-side quality: total routing with reasons, dedup, data-quality metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.config import TIME_RANGE, TRANSACTION_TYPES, Columns, LedgerConfig
from ledgerflow.functions.rules import is_rejected, quarantine_reasons
from ledgerflow.functions.timeutil import ts_lit

REASONS = "reasons"
REASON = "reason"


def _has_id(df: DataFrame, cols: Columns) -> bool:
    return cols.event_id in df.columns


def with_reasons(df: DataFrame, cols: Columns = Columns(), transaction_types=TRANSACTION_TYPES, time_range=TIME_RANGE) -> DataFrame:
    """Add ``reasons`` (all failed checks) and ``reason`` (the first one)."""
    return df.withColumn(REASONS, quarantine_reasons(cols, tuple(transaction_types), _has_id(df, cols), time_range)).withColumn(
        REASON, F.get(F.col(REASONS), 0)
    )


def route(df: DataFrame, cols: Columns = Columns(), transaction_types=TRANSACTION_TYPES, time_range=TIME_RANGE) -> tuple[DataFrame, DataFrame]:
    """Split events into (valid, quarantine); every input row lands in exactly one.

    The valid side is a plain boolean filter; only quarantined rows build
    their ``reasons`` array. Writers that need both sides should use
    ``sources.tables.write_routed`` (one scan, one job).
    """
    rejected = is_rejected(cols, tuple(transaction_types), _has_id(df, cols), time_range)
    valid = df.filter(~rejected)
    bad = with_reasons(df.filter(rejected), cols, transaction_types, time_range)
    return valid, bad


def valid_under(df: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Valid rows under a whole configuration: names, types and time range."""
    return valid_events(df, cfg.cols, cfg.transaction_types, cfg.time_range)


def valid_events(df: DataFrame, cols: Columns = Columns(), transaction_types=TRANSACTION_TYPES, time_range=TIME_RANGE) -> DataFrame:
    return df.filter(~is_rejected(cols, tuple(transaction_types), _has_id(df, cols), time_range))


def reason_counts(df: DataFrame, cols: Columns = Columns(), transaction_types=TRANSACTION_TYPES, time_range=TIME_RANGE) -> DataFrame:
    """Quarantined rows per first failing reason: ``reason, n``."""
    _, bad = route(df, cols, transaction_types, time_range)
    return bad.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))


def routing_counts(df: DataFrame, cols: Columns = Columns(), transaction_types=TRANSACTION_TYPES, time_range=TIME_RANGE) -> DataFrame:
    """``n_in, n_valid, n_bad`` in one pass; n_in = n_valid + n_bad always."""
    rejected = is_rejected(cols, tuple(transaction_types), _has_id(df, cols), time_range)
    return df.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count(F.when(~rejected, 1)).alias("n_valid"),
        F.count(F.when(rejected, 1)).alias("n_bad"),
    )


def dedup_latest(df: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("event_time", "amount")) -> DataFrame:
    """Keep one row per ``key``: the greatest by ``order`` (latest correction).

    ``max_by`` over structs, planned as sort aggregates: each side of the one
    shuffle sorts by the key, and copies collapse map-side, so a key with a
    huge number of copies never reaches one task whole. Ties on the full ``order`` tuple keep the greatest remaining row.
    """
    rest = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    latest = F.max_by(F.struct(*[F.col(c) for c in rest]), ordering)
    return df.groupBy(key).agg(latest.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def duplicate_keys(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys delivered more than once: ``key, n``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dq_metrics(
    raw: DataFrame,
    as_of: dt.datetime,
    cols: Columns = Columns(),
    transaction_types=TRANSACTION_TYPES,
    time_range=TIME_RANGE,
) -> DataFrame:
    """Per layer (raw, valid): rows, null money, null user/account ids, null
    event ids, future / pre-epoch timestamps, negative amounts. One scan;
    valid-layer metrics are conditional counts over the same rows.
    """
    ok = ~is_rejected(cols, tuple(transaction_types), _has_id(raw, cols), time_range)
    ts = F.col(cols.event_time)
    metrics = {
        "n": F.lit(True),
        "null_amount": F.col(cols.amount).isNull(),
        "null_ids": F.col(cols.user_id).isNull() | F.col(cols.account_id).isNull(),
        "null_event_id": F.col(cols.event_id).isNull() if _has_id(raw, cols) else F.lit(False),
        "future_ts": ts > ts_lit(as_of),
        "pre_epoch_ts": ts < ts_lit(dt.datetime(1970, 1, 1)),
        "negative_amount": F.col(cols.amount) < 0,
    }
    aggs = []
    for layer, cond in (("raw", F.lit(True)), ("valid", ok)):
        for name, pred in metrics.items():
            aggs.append(F.count(F.when(cond & F.coalesce(pred, F.lit(False)), 1)).alias(f"{layer}__{name}"))
    wide = raw.agg(*aggs)
    layers = [
        F.struct(F.lit(layer).alias("layer"), *[F.col(f"{layer}__{m}").alias(m) for m in metrics])
        for layer in ("raw", "valid")
    ]
    return wide.select(F.explode(F.array(*layers)).alias("m")).select("m.*")


def volume_drop(raw: DataFrame, fraction: float = 0.5, ts_col: str = "event_time", lookback_days: int = 7) -> DataFrame:
    """Days whose row count is below ``fraction`` x the mean of the previous
    ``lookback_days`` calendar days: ``d, n, mean_prev_7``.

    Every calendar day between the first and the last one counts, a day
    without rows with 0, so an outage is reported. Days before the first one
    are not part of a mean. Rows are pre-aggregated to one per day before the
    (global) window, so its input is bounded by the number of days.
    """
    daily = raw.groupBy(F.to_date(ts_col).alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d is not null")
    calendar = daily.agg(F.sequence(F.min("d"), F.max("d")).alias("days")).select(F.explode("days").alias("d"))
    full = calendar.join(daily, "d", "left").select("d", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.orderBy(F.unix_date("d")).rangeBetween(-lookback_days, -1)
    return (
        full.withColumn("_mean", F.avg("n").over(w))
        .filter(F.col("n") < F.lit(fraction) * F.col("_mean"))
        .select("d", "n", F.col("_mean").cast("decimal(18,4)").alias("mean_prev_7"))
    )


def volume_outage(
    raw: DataFrame,
    as_of: dt.date,
    spreads: float = 3.0,
    least_drop: float = 0.2,
    weeks: int = 8,
    history: int = 3,
    ts_col: str = "event_time",
) -> DataFrame:
    """Days up to the one before ``as_of`` with far fewer rows than their weekday
    has: ``d, n, expected, spread``.

    The run's date bounds the calendar, not the last row, so a source that
    fell silent is reported from its first silent day on. A day is compared
    with the same weekday of the ``weeks`` weeks before it: ``expected`` is
    their median, ``spread`` the median distance from it (times 1.4826, as wide
    as a standard deviation); neither moves for a single odd day. A day is
    reported when it lies more than ``spreads`` spreads, and ``least_drop`` of
    the expected count, below it. Weekdays with fewer than ``history`` earlier
    days are not judged. Rows are counted per day first; what follows sees
    one row per day.
    """
    daily = raw.groupBy(F.to_date(ts_col).alias("d")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("d") < F.lit(as_of))
    calendar = daily.agg(F.min("d").alias("since")).filter("since is not null").select(F.explode(F.sequence("since", F.date_sub(F.lit(as_of), 1))).alias("d"))
    full = calendar.join(daily, "d", "left").select("d", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.partitionBy(F.weekday("d")).orderBy("d").rowsBetween(-weeks, -1)
    median = lambda a: (F.get(F.array_sort(a), F.floor((F.size(a) - 1) / 2).cast("int")) + F.get(F.array_sort(a), F.floor(F.size(a) / 2).cast("int"))) / 2
    judged = full.withColumn("_earlier", F.collect_list("n").over(w)).filter(F.size("_earlier") >= history).withColumn("expected", median(F.col("_earlier")))
    judged = judged.withColumn("_away", F.transform("_earlier", lambda x: F.abs(x - F.col("expected")))).withColumn("spread", median(F.col("_away")) * 1.4826)
    low = F.col("expected") - F.greatest(F.col("spread") * spreads, F.col("expected") * least_drop)
    return judged.filter(F.col("n") < low).select(
        "d", "n", F.col("expected").cast("decimal(18,1)").alias("expected"), F.col("spread").cast("decimal(18,4)").alias("spread")
    )


def gold_checks(audit: DataFrame, min_balance: str = "100", cols: Columns = Columns()) -> DataFrame:
    """Gold-layer checks in one aggregate: ``n, negative_bonus, null_final_balance,
    paid_below_min, unpaid_above_min`` (the last two catch a rule that drifted)."""
    bonus = F.col(cols.cdi_bonus)
    base = F.col(cols.balance_to_apply_cdi)
    floor = F.lit(min_balance).cast("decimal(18,2)")
    return audit.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(bonus < 0, 1)).alias("negative_bonus"),
        F.count(F.when(F.col(cols.final_balance).isNull(), 1)).alias("null_final_balance"),
        F.count(F.when((bonus > 0) & (base <= floor), 1)).alias("paid_below_min"),
        F.count(F.when((bonus == 0) & (base > floor), 1)).alias("unpaid_above_min"),
    )
