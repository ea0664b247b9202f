"""Exact deduplication through an extendible-hash index in shared files.

Each text (white-space runs made one blank) has a 64-bit hash. Hashes are
counted first, and the directory maps their leading bits to buckets: a bucket
over capacity is split by one more bit, which doubles the directory where
needed. Neighbouring buckets, about the same number of rows together, have one
owner task. Every text goes to the owner of its bucket, once, and the owner
compares it by its bytes with what shares its hash: equal texts are one entry,
others are chained. Texts under a hash that a large share of the rows has are
combined before they travel, so a text that a third of the rows share is one
row. The index, one row per distinct text, is written by the owners in bucket
order, one key range each.

Only DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import HEAVY_LEAST, HEAVY_SHARE, SPACE, join_by_key, shuffle_width, stage, text_or_empty

#: Keys a bucket holds before it is split; fewer where an owner would otherwise have less than OWNED buckets.
CAPACITY = 100_000
OWNED = 16
#: The directory never exceeds 2 ** MAX_DEPTH slots (a few MB when broadcast).
MAX_DEPTH = 18


def normalised(col: str = "text"):
    return F.regexp_replace(text_or_empty(col), SPACE, " ")


def hash_key(norm, hash_bits: int = 64):
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(norm)


def directory(keys: DataFrame, depth: int, capacity: int, hash_bits: int = 64) -> DataFrame:
    """(slot, local_depth, bucket, n_rows) for all 2**depth slots that hold keys of (h, n).

    A slot's bucket is the shortest prefix that holds at most ``capacity``
    keys, or the whole slot number at full depth. n_rows are those of the slot.
    """
    base = keys.groupBy(F.shiftrightunsigned("h", hash_bits - depth).alias("slot")).agg(F.count("*").alias("k"), F.sum("n").alias("n_rows"))
    prefixes = base.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "prefix", F.expr(f"shiftrightunsigned(slot, {depth} - d)")
    )
    over = prefixes.groupBy("d", "prefix").agg(F.sum("k").alias("k")).filter(F.col("k") > capacity).select("d", "prefix")
    split = prefixes.join(over, ["d", "prefix"]).groupBy("slot").agg((F.max("d") + 1).alias("d"))
    local = F.least(F.coalesce("d", F.lit(0)), F.lit(depth))
    return (
        base.select("slot", "n_rows")
        .join(split, "slot", "left")
        .select("slot", local.alias("local_depth"), "n_rows")
        .withColumn("bucket", F.expr(f"shiftleft(shiftrightunsigned(slot, {depth} - local_depth), {depth} - local_depth)"))
    )


def owned(slots: DataFrame, owners: int) -> DataFrame:
    """(slot, local_depth, bucket, owner): buckets in order, dealt to ``owners`` key ranges of about the same number of rows.

    The windows run over the directory, at most 2 ** MAX_DEPTH rows.
    """
    by_bucket = slots.withColumn("of_bucket", F.sum("n_rows").over(Window.partitionBy("bucket")))
    # a bucket's slots are neighbours: all rows of the buckets before it, the same for each of its slots
    before = F.sum("n_rows").over(Window.orderBy("bucket")) - F.col("of_bucket")
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    owner = F.expr(f"cast(least(({owners} * (before + of_bucket div 2)) div total, {owners - 1}) as int)")
    return by_bucket.withColumn("before", before).withColumn("total", total).select("slot", "local_depth", "bucket", owner.alias("owner"))


def build_index(texts: DataFrame, entries: DataFrame, n_rows: int, capacity: int = CAPACITY, hash_bits: int = 64) -> DataFrame:
    """The index: (bucket, local_depth, h, chain, text_sha256, keep_id, group_size), written by the owners in bucket order.

    ``texts`` has (doc_id, h, norm) per row, ``entries`` (at least) the h of
    the same ``n_rows`` rows. chain numbers the distinct texts of one hash
    from 1.
    """
    owners = shuffle_width(texts.sparkSession)
    keys = stage(entries.groupBy("h").agg(F.count("*").alias("n")), "exact-keys")
    n_keys = keys.count()
    capacity = max(1, min(capacity, n_keys // (OWNED * owners)))
    depth = min(max((n_keys // capacity).bit_length() + 2, 1), MAX_DEPTH, hash_bits)
    slots = stage(owned(directory(keys, depth, capacity, hash_bits), owners), "exact-directory")

    # at most HEAVY_SHARE hashes
    heavy = F.broadcast(keys.filter(F.col("n") >= max(HEAVY_LEAST, n_rows // HEAVY_SHARE)).select("h"))
    one = texts.join(heavy, "h", "left_anti").select("h", "norm", F.col("doc_id").alias("least_id"), F.lit(1).cast("long").alias("copies"))
    many = texts.join(heavy, "h").groupBy("h", "norm").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"))
    sent = (
        one.unionByName(many)
        .withColumn("slot", F.shiftrightunsigned("h", hash_bits - depth))
        .join(F.broadcast(slots), "slot")
        .repartitionById(owners, F.col("owner"))
    )
    # the owners group what they were sent where it lies: nothing is shuffled again
    compared = sent.groupBy("owner", "bucket", "local_depth", "h", "norm").agg(F.min("least_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    index = (
        compared.withColumn("text_sha256", F.sha2("norm", 256))
        .drop("norm")
        .withColumn("chain", F.row_number().over(Window.partitionBy("owner", "bucket", "h").orderBy("text_sha256")))
        .select("bucket", "local_depth", "h", "chain", "text_sha256", "keep_id", "group_size")
        .sortWithinPartitions("bucket", "h", "chain")
    )
    return stage(index, "exact-index")


def _indexed(docs: DataFrame, capacity: int, hash_bits: int) -> tuple[DataFrame, DataFrame, int]:
    """(entries, index, rows): doc_id, h and text_sha256 of every row, and the index over them."""
    texts = docs.select("doc_id", normalised().alias("norm")).withColumn("h", hash_key(F.col("norm"), hash_bits))
    entries = stage(texts.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256")), "exact-entries")
    n_rows = entries.count()
    return entries, build_index(texts, entries, n_rows, capacity, hash_bits), n_rows


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Needs the columns doc_id and text; others are ignored. A null text counts
    as empty, empty texts form a group like any other. Rows that repeat a
    doc_id with an equal text count as copies and share the kept flag. A null
    doc_id is kept only when its whole group has none. An empty table gives
    an empty result. Texts of any length are compared whole.
    """
    entries, index, n_rows = _indexed(docs, capacity, hash_bits)
    found = join_by_key(entries, n_rows, index.select("h", "text_sha256", "keep_id", "group_size"), ["h", "text_sha256"], "group_size")
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one row per group of equal texts, that of the smallest doc_id.

    Of rows that repeat both doc_id and text one stays. A group without any
    doc_id keeps one of its rows.
    """
    _, index, _ = _indexed(docs, capacity, 64)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stays = index.select(name("keep_id").alias("k"), F.col("text_sha256").alias("t"))
    rows = docs.select(F.struct("*").alias("row"), name("doc_id").alias("k"), F.sha2(normalised(), 256).alias("t"))
    one = F.row_number().over(Window.partitionBy("k", "t").orderBy(F.lit(0)))
    return rows.join(stays, ["k", "t"], "left_semi").withColumn("i", one).filter("i = 1").select("row.*")
