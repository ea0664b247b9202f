"""Sharding by sampled splitters: shards of nearly equal bytes.

A record's key is (hash of its text, hash of its whole row), so equal texts
are neighbours. A sample of keys, drawn with a chance proportional to bytes,
gives the quantile boundaries of many small ranges. The exact bytes of every
range are then measured; a range that came out overfull is sampled again on
its own and subdivided. What cannot be divided by key, one row repeated many
times, is divided by its copies. The measured ranges are dealt to the shards,
largest first, and every record is sent once, to its range, where its slot is
its place in key order.

A group of equal texts stays in one shard unless it holds more than a quarter
of a shard's bytes. A large group still spreads over many ranges, which are
merely dealt to the same shard, so no task holds all of it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import shuffle_width, stage, text_or_empty

SHARDS = 8
#: A group of equal texts above this part of a shard is divided between shards.
GROUP_PART = 0.25
#: Ranges aimed at: one per RANGE_BYTES of input, between these bounds. The driver holds a few numbers of each.
LEAST_RANGES = 4096
MOST_RANGES = 65_536
RANGE_BYTES = 256 << 20
#: Keys sampled per range aimed at (expected; records above a sample's share are always in, at most as many again).
SAMPLES = 16
#: A range is overfull above this many times the share aimed at, and subdivided at most ROUNDS times.
OVERFULL = 2
ROUNDS = 8

_SIGN = np.uint64(1 << 63)
_LAST = (1 << 63) - 1
_FIRST = -(1 << 63)


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes and one for the end."""
    return (F.octet_length(text_or_empty(text)) + 1).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """(record, h, k, size) per row: the whole row, its text's hash, its own hash and its size."""
    every = [docs[f"`{c}`"] for c in docs.columns]
    return docs.select(F.struct("*").alias("record"), F.xxhash64("text").alias("h"), F.xxhash64(*every).alias("k"), size_of().alias("size"))


def _packed(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The pairs as 16-byte strings in the order of (h, k)."""
    both = np.empty((len(h), 2), ">u8")
    both[:, 0] = np.asarray(h, "int64").view("uint64") ^ _SIGN
    both[:, 1] = np.asarray(k, "int64").view("uint64") ^ _SIGN
    return both.view("S16").ravel()


def numbered(cuts: list[tuple[int, int]]):
    """A column function (h, k) -> number of the range: how many cuts are at or below the key."""
    packed = _packed(np.array([c[0] for c in cuts], "int64"), np.array([c[1] for c in cuts], "int64"))

    @F.pandas_udf("int")
    def number(h: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(packed, _packed(h.to_numpy(), k.to_numpy()), side="right").astype("int32"))

    return number


def splitters(sample: pd.DataFrame, share: float) -> set[tuple[int, int]]:
    """Keys at which ranges begin, from sampled (h, k, weight): quantiles of about ``share`` bytes.

    A boundary inside a group of equal texts moves to the group's end, unless
    the group alone holds a share; then the group, and in it each record of a
    whole share, has ranges of its own.
    """
    if sample.empty:
        return set()
    sample = sample.sort_values(["h", "k"])
    h, k, w = sample["h"].to_numpy(), sample["k"].to_numpy(), sample["weight"].to_numpy("float64")
    ends = np.floor(np.cumsum(w) / share)
    cuts = np.flatnonzero(np.diff(np.concatenate([[0.0], ends])) > 0)
    group = sample.groupby("h")["weight"].transform("sum").to_numpy() >= share

    def after(h: int, k: int = _LAST) -> list[tuple[int, int]]:
        return [(h, k + 1)] if k < _LAST else [(h + 1, _FIRST)] if h < _LAST else []

    found: set[tuple[int, int]] = set()
    for i in cuts:
        found.update(after(int(h[i]), int(k[i])) if group[i] else after(int(h[i])))
    for x in np.unique(h[group]):
        found.update([(int(x), _FIRST), *after(int(x))])
    for i in np.flatnonzero(w >= share):
        found.update([(int(h[i]), int(k[i])), *after(int(h[i]), int(k[i]))])
    return found


def _drawn(records: DataFrame, rate: Column, salt: int) -> pd.DataFrame:
    """Records drawn with chance ``rate`` (by a hash of their key, so that reruns agree), each standing for weight / chance bytes."""
    u = F.shiftrightunsigned(F.xxhash64("h", "k", F.lit(salt)), 11) * F.lit(2.0**-53)
    chance = F.least(F.lit(1.0), rate)
    return records.filter(u < chance).select("h", "k", (F.col("n") * F.col("size") / chance).alias("weight")).toPandas()


def ranges(records: DataFrame, total: int, aimed: int) -> tuple[list[tuple[int, int]], pd.DataFrame]:
    """(cuts, one row (range, records, rows, bytes) per range that holds any)."""
    share = total / aimed
    weight = F.col("n") * F.col("size")
    cuts = splitters(_drawn(records, weight * (SAMPLES * aimed / total), 1), share)
    for turn in range(ROUNDS + 1):
        known = sorted(cuts)
        placed = records.withColumn("range", numbered(known)("h", "k"))
        found = placed.groupBy("range").agg(F.count("*").alias("records"), F.sum("n").alias("rows"), F.sum(weight).alias("bytes")).toPandas()
        over = found[(found["bytes"] > OVERFULL * share) & (found["records"] > 1)]
        if over.empty or turn == ROUNDS:
            break
        session = records.sparkSession
        inside = placed.join(F.broadcast(session.createDataFrame(over[["range"]])), "range")  # each over twice a share, so at most aimed / 2
        cuts |= splitters(_drawn(inside, weight * (SAMPLES * (turn + 2) / share), turn + 2), share)
    return known, found


def groups_of(cuts: list[tuple[int, int]], numbers: pd.Series) -> list[int | None]:
    """The text hash that all keys of a range share, or None where the cuts let in several."""
    out = []
    for r in numbers:
        low, high = (cuts[r - 1] if r else None), (cuts[r] if r < len(cuts) else None)
        inside = low and high and (high[0] == low[0] or high == (low[0] + 1, _FIRST))
        out.append(low[0] if inside else None)
    return out


def dealt(found: pd.DataFrame, cuts: list[tuple[int, int]], share: float, shards: int) -> pd.DataFrame:
    """(range, chunk, pieces, shard, rows, start) of every piece: largest first, each to the shard with the fewest bytes.

    Ranges of one group of equal texts go together unless the group is above
    GROUP_PART of a shard. A range of one record with many copies counts as
    several pieces. Pieces of a shard keep key order; start is the slot of the
    first row.
    """
    found = found.sort_values("range").assign(group=lambda f: groups_of(cuts, f["range"]))
    most = GROUP_PART * found["bytes"].sum() / shards
    units: dict[tuple, list] = {}
    for r in found.itertuples():
        pieces = min(int(r.rows), int(r.bytes // share) + 1) if r.records == 1 else 1
        each, more = divmod(int(r.rows), pieces)
        for c in range(pieces):
            rows = each + (c < more)
            units.setdefault(("range", r.range) if pd.isna(r.group) else ("group", r.group), []).append((int(r.range), c, pieces, rows, int(r.bytes) * rows // int(r.rows)))
    apart = [[p] for u in units.values() if sum(p[4] for p in u) > most for p in u]
    whole = [u for u in units.values() if sum(p[4] for p in u) <= most]
    load = [(0, s) for s in range(shards)]
    placed = []
    for unit in sorted(apart + whole, key=lambda u: (-sum(p[4] for p in u), u[0])):
        least, s = heapq.heappop(load)
        heapq.heappush(load, (least + sum(p[4] for p in unit), s))
        placed += [(number, chunk, pieces, s, rows) for number, chunk, pieces, rows, _ in unit]
    pieces = pd.DataFrame(sorted(placed), columns=["range", "chunk", "pieces", "shard", "rows"], dtype="int64")  # typed when empty, too
    pieces["start"] = pieces.groupby("shard")["rows"].cumsum() - pieces["rows"]
    return pieces


def shard(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write the rows of ``docs`` to ``path``, one folder a shard, and return what was written: (slot, record, shard).

    Needs the columns doc_id and text; the whole row is kept in the struct
    ``record``, so no name can clash (a column of a map type cannot be
    hashed). Shards hold nearly equal bytes: the sizes of their records, which
    are the UTF-8 bytes of the text and one more (a null text: none and one
    more). They differ by about one range, or by one record where that is
    larger. Slots count from 0 in each shard without gaps; files hold them in
    order. Equal rows are interchangeable and may be divided between shards;
    rows that repeat an id with another text are rows like any other, so are
    those without an id. An empty table writes no file and returns no row.
    Texts of any length are moved whole, once.
    """
    spark = docs.sparkSession
    rows = keyed(docs)
    records = stage(rows.groupBy("h", "k", "size").agg(F.count("*").alias("n")), "shard-records")
    total = records.agg(F.coalesce(F.sum(F.col("n") * F.col("size")), F.lit(0))).first()[0]
    aimed = max(LEAST_RANGES, min(MOST_RANGES, total // RANGE_BYTES))
    cuts, found = ranges(records, total, aimed) if total else ([], pd.DataFrame({"range": [], "records": [], "rows": [], "bytes": []}))
    pieces = dealt(found, cuts, max(total, 1) / aimed, shards)
    schema = "range int, chunk int, pieces int, shard int, rows long, start long"
    plan = spark.createDataFrame([tuple(int(x) for x in r) for r in pieces.itertuples(index=False)], schema)
    # one row divided by its copies holds at least a share of all bytes, so there are at most as many as ranges aimed at
    many = plan.filter("chunk = 0 and pieces > 1").select("range", "pieces")
    placed = rows.withColumn("range", numbered(cuts)("h", "k"))
    one = placed.join(F.broadcast(many.select("range")), "range", "left_anti").select("record", "h", "k", "range", F.lit(0).alias("chunk"), F.lit(1).cast("long").alias("copies"))
    repeated = (
        placed.join(F.broadcast(many), "range")
        .groupBy("range", "pieces", "h", "k")
        .agg(F.any_value("record").alias("record"), F.count("*").alias("n"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("copies", F.floor(F.col("n") / F.col("pieces")) + (F.col("chunk") < F.col("n") % F.col("pieces")).cast("long"))
        .select("record", "h", "k", "range", "chunk", "copies")
    )
    here = Window.partitionBy("range", "chunk").orderBy("h", "k")
    sent = (
        one.unionByName(repeated)
        .repartition(shuffle_width(spark), "range", "chunk")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .withColumn("place", F.row_number().over(here))
        .join(F.broadcast(plan.select("range", "chunk", "shard", "start")), ["range", "chunk"])  # a few numbers per range
        .select((F.col("start") + F.col("place") - 1).alias("slot"), "record", "shard")
    )
    sent.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(sent.schema).parquet(path)


def digests(written: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every record in the files."""
    crc = F.crc32(text_or_empty("record.text").cast("binary"))
    return written.select(
        F.col("record.doc_id").alias("doc_id"),
        size_of("record.text").alias("size"),
        crc.alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
