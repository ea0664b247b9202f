"""Per-key ordered computations that stay bounded when one key is hot.

A plain ``Window.partitionBy(account)`` puts every event of an account into
one task. If one account holds a third of all rows, that task holds a third
of the data. Everything here splits the ordered work by a fixed hierarchy of
buckets instead, the same at every data size:

    hour  >  (second, range of 65,536 tie-break values)

and stitches the buckets together with windows over per-bucket totals. Ids
being unique, the finest bucket holds at most 65,536 different events, even
where an account has most rows at one identical time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.money import money

DAY_MICROS = 24 * 3600 * 1_000_000
MINUTE_MICROS = 60 * 1_000_000
#: A finest bucket spans 2 ** TIE_BITS values of an integral tie-break column.
TIE_BITS = 16
#: ... or the values of a text one that start with the same so many characters.
TIE_PREFIX = 8

_HOUR, _FINE = "_b0", ["_b1", "_b2"]


def _bucketed(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    """Rows with a key and a time, with their buckets, dealt by (key, finest bucket).

    The explicit exchange serves the in-bucket window and the bucket totals
    alike, so the input is computed and shuffled once.
    """
    x = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    integral = isinstance(df.schema[tiebreak].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    tie = F.shiftright(F.col(tiebreak).cast("long"), TIE_BITS) if integral else F.substring(F.col(tiebreak).cast("string"), 1, TIE_PREFIX)
    # never null here; said so, no branch gets a null filter of its own below the shared exchange
    trunc = lambda unit: F.coalesce(F.date_trunc(unit, F.col(ts)), F.lit(0).cast("timestamp"))
    x = x.withColumn(_HOUR, trunc("hour")).withColumn("_b1", trunc("second")).withColumn("_b2", tie)
    return x.repartition(F.col(key), F.col(_HOUR), *map(F.col, _FINE))


def _before(w, c: str):
    return F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def running_total(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: str,
    value: str,
    out: str,
    with_next_ts: str | None = None,
) -> DataFrame:
    """``out`` = sum of ``value`` over rows of the same ``key`` ordered by
    (``ts``, ``tiebreak``) up to and including the current row.

    Optionally ``with_next_ts`` = ``ts`` of the next row of the same key
    (``lead``). Rows with a NULL key or ``ts`` are dropped; repeated rows stay.

    Plan: one shuffle of the rows by (key, finest bucket), used by the
    in-bucket window and by the bucket totals; the totals are offset within
    their hour and the hours within their key; one join brings each finest
    bucket's offset back to its rows.
    """
    x = _bucketed(df, key, ts, tiebreak)
    grp = [key, _HOUR, *_FINE]
    wb = Window.partitionBy(*grp).orderBy(F.col(ts), F.col(tiebreak))
    rows = x.withColumn("_run", F.sum(value).over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    if with_next_ts:
        rows = rows.withColumn("_lead", F.lead(ts).over(wb))
    # Counting the tie-break and taking the last time make every branch need the
    # same columns of the exchange; it would be pruned, and so computed, for each otherwise.
    fine = x.groupBy(*grp).agg(
        F.sum(value).alias("_s"), F.min(ts).alias("_st"), F.count(tiebreak).alias("_c"), F.max(F.unix_micros(F.col(ts))).alias("_mt")
    )
    w1 = Window.partitionBy(key, _HOUR).orderBy(*_FINE)
    fine = fine.withColumn("_o1", _before(w1, "_s")).withColumn("_n1", F.lead("_st").over(w1))
    hours = fine.groupBy(key, _HOUR).agg(F.sum("_s").alias("_hs"), F.min("_st").alias("_hst"), F.sum("_c").alias("_hc"), F.max("_mt").alias("_hmt"))
    w0 = Window.partitionBy(key).orderBy(_HOUR)
    hours = hours.select(key, _HOUR, "_hc", "_hmt", _before(w0, "_hs").alias("_o0"), F.lead("_hst").over(w0).alias("_n0"))
    offsets = fine.join(hours, [key, _HOUR]).filter("_c >= 0 and _hc >= 0 and _mt is not null and _hmt is not null").select(*grp, (F.col("_o0") + F.col("_o1")).alias("_off"), F.coalesce("_n1", "_n0").alias("_nx"))
    # every column but the tie range is non-null
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) if c == "_b2" else F.col(f"r.{c}") == F.col(f"o.{c}") for c in grp]
    joined = rows.alias("r").join(offsets.alias("o"), same)
    keep = [F.col(f"r.{c}").alias(c) for c in df.columns]
    extra = [F.coalesce("_lead", "_nx").alias(with_next_ts)] if with_next_ts else []
    return joined.select(*keep, money(F.col("_run") + F.col("_off")).alias(out), *extra)


def lowest_running_total(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, out: str) -> DataFrame:
    """``key, out``: the lowest value that ``running_total`` takes per key.

    Buckets are reduced to (sum, lowest prefix) and combined level by level;
    nothing is joined back to the rows.
    """
    x = _bucketed(df, key, ts, tiebreak)
    grp = [key, _HOUR, *_FINE]
    wb = Window.partitionBy(*grp).orderBy(F.col(ts), F.col(tiebreak))
    level = x.withColumn("_low", F.sum(value).over(wb.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*grp).agg(
        F.sum(value).alias("_s"), F.min("_low").alias("_low")
    )
    for parent, order in (([key, _HOUR], _FINE), ([key], [_HOUR])):
        w = Window.partitionBy(*parent).orderBy(*order)
        level = level.withColumn("_low", _before(w, "_s") + F.col("_low")).groupBy(*parent).agg(F.sum("_s").alias("_s"), F.min("_low").alias("_low"))
    return level.select(key, money(F.col("_low")).alias(out))


def trailing_min_24h(df: DataFrame, key: str, ts: str, value: str, out: str) -> DataFrame:
    """``out`` = min of ``value`` over rows of the same key with ``ts`` in
    ``[current ts - 24h, current ts]`` (a RANGE frame: rows with the same
    ``ts`` are peers and all included).

    Peers share their frame, so the rows are first reduced to one per (key,
    time), map-side combined: rows at one identical time, repeated
    deliveries among them, are one row here and all come back in the join at
    the end. The frame is cut at minute edges into (a) the current minute up
    to the row, (b) the whole minutes in between and (c) the tail of the
    minute where the frame starts. Each time also emits a probe at
    ``ts - 24h`` into that minute; one window per (key, minute) gives times
    their running minimum (a) and probes the suffix minimum (c). Part (b) is a
    window over a per-(key, minute) minimum table. No task holds more than the
    different times of one key's minute, and no size decides the form.
    """
    per_frame = DAY_MICROS // MINUTE_MICROS
    times = (
        df.groupBy(key, F.unix_micros(F.col(ts)).alias("_us"))
        .agg(F.min(value).alias("_v"))
        .withColumn("_b", F.floor(F.col("_us") / MINUTE_MICROS))
    )
    row = F.struct(F.lit(1).alias("_kind"), F.col("_us").alias("_t"), F.col("_b").alias("_part"))
    probe = F.struct(F.lit(0).alias("_kind"), (F.col("_us") - DAY_MICROS).alias("_t"), (F.col("_b") - per_frame).alias("_part"))
    x = times.select(key, "_us", "_b", "_v", F.explode(F.array(row, probe)).alias("_r")).select(key, "_us", "_b", "_v", "_r.*")
    real = F.when(F.col("_kind") == 1, F.col("_v"))
    wp = Window.partitionBy(key, "_part").orderBy("_t")
    upto = F.min(real).over(wp.rangeBetween(Window.unboundedPreceding, 0))
    since = F.min(real).over(wp.rangeBetween(0, Window.unboundedFollowing))
    x = x.withColumn("_upto", upto).withColumn("_from", since)
    part = F.when(F.col("_kind") == 1, F.col("_upto")).otherwise(F.col("_from"))
    minutes = times.groupBy(key, "_b").agg(F.min("_v").alias("_bmin"))
    wb = Window.partitionBy(key).orderBy("_b").rangeBetween(-(per_frame - 1), -1)
    between = minutes.select(key, "_b", F.min("_bmin").over(wb).alias("_mid"))
    lows = (
        x.select(key, "_us", "_b", part.alias("_p"))
        .join(between, [key, "_b"], "left")
        .groupBy(key, "_us")
        .agg(F.min(F.least("_p", "_mid")).alias(out))
    )
    return df.withColumn("_us", F.unix_micros(F.col(ts))).join(lows, [key, "_us"]).select(*df.columns, out)
