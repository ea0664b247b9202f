"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key -ln(u) / quality, u being a hash of its
id, so that reruns agree and documents of higher quality tend to come first.
Whole epochs of a source come before a fractional one, which takes documents
in key order until the rest of the source's token budget is used up.

The order within a source is never made by one task: keys fall into buckets
whose sizes are summed first; buckets wholly below or above the budget are
decided by their sum, and only the one bucket per source that the budget cuts
is sorted row by row. Only DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, stage, text_or_empty

#: No document is taken more often than this.
MAX_EPOCHS = 3
#: Weights given to the sources in turn.
WEIGHTS = (1, 2, 3)
#: Key buckets per source.
BUCKETS = 4096


def quality(size, chars):
    """Weight 0.5 to 1: 1 while the mean word (its blank included) has 3 to 12 characters."""
    mean = chars / F.greatest(size, F.lit(1))
    return F.when((mean >= 3) & (mean <= 12), 1.0).otherwise(0.5)


def sized(docs: DataFrame, *carry: Column) -> DataFrame:
    """(doc_id, source, size, key, bucket) per row, and what it carries; key and bucket rise together."""
    u = (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    key = -F.log("u") / quality(F.col("size"), F.col("chars"))
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    rows = docs.select("doc_id", "source", size.alias("size"), F.char_length(text_or_empty()).alias("chars"), u.alias("u"), *carry)
    return rows.withColumn("key", key).withColumn("bucket", bucket).drop("chars", "u")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from one (source, source_size) row per source.

    Water-filling: target = min(3 * size, level * weight), the level being the
    one at which the targets sum to all sizes. The sources in the order of
    the level at which each is full give it in one pass of running sums; the
    unpartitioned windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    full = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * MAX_EPOCHS).withColumn("full_at", F.col("cap") / F.col("w"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    every = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    level = (
        full.withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("left", F.col("all_size") - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), zero))
        .withColumn("level", F.col("left") / F.col("left_w"))
        # the level stands from the first source on that it does not fill
        .withColumn("final", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(every))
    )
    return level.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("final.level") * F.col("w")).alias("target"))


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source of ``sized`` rows: source_size, target, epochs, the rest of the budget, the bucket it cuts and the sizes before that bucket."""
    by_bucket = stage(rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    goal = targets(by_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights)
    goal = goal.withColumn("epochs", F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(MAX_EPOCHS)).cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bucket_size").over(below), F.lit(0).cast("long"))
    cut = (
        by_bucket.withColumn("start", start)
        .alias("b")
        .join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
        .filter("rest > 0 and start <= rest and start + bucket_size > rest")
        .groupBy("g.source")
        .agg(F.min("bucket").alias("cut"), F.min("start").alias("cut_start"))
    )
    all_or_none = F.when(F.col("rest") > 0, BUCKETS).otherwise(-1)
    return stage(
        goal.alias("g")
        .join(cut.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left")
        .select("g.source", "source_size", "target", "epochs", "rest", F.coalesce("cut", all_or_none).alias("cut"), "cut_start"),
        "mix-plan",
    )


def draw(rows: DataFrame, plan: DataFrame, *carried: str) -> DataFrame:
    """doc_id, size, source_size, target, taken and what is carried, per row of ``sized``."""
    mine = plan.withColumnRenamed("source", "plan_source")
    full = rows.join(mine, F.col("source").eqNullSafe(F.col("plan_source")))
    here = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("cut_start") + F.coalesce(F.sum("size").over(here), F.lit(0).cast("long"))
    out = ["doc_id", "size", "source_size", "target"]
    taken = lambda more: (F.col("size") * (F.col("epochs") + more.cast("long"))).alias("taken")
    sure = full.filter(F.col("bucket") != F.col("cut")).select(*out, taken(F.col("bucket") < F.col("cut")), *carried)
    edge = full.filter(F.col("bucket") == F.col("cut")).withColumn("before", before)
    return sure.unionByName(edge.select(*out, taken(F.col("before") + F.col("size") / 2 <= F.col("rest")), *carried))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken.

    Needs doc_id, text and source; other columns are ignored. A null text has
    size 0 and is never taken; a null source is a source of its own, the
    last. Equal keys (repeated ids) are told apart by size, equal rows may
    swap. The document that the budget cuts is taken whole if that comes
    nearer to it. An empty table gives an empty result.
    """
    rows = stage(sized(docs), "mix-sized")
    return draw(rows, plan(rows, weights))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them."""
    decided = draw(sized(docs, F.struct("*").alias("mixed_row")), plan(stage(sized(docs), "mix-sized"), weights), "mixed_row")
    times = (F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    return decided.filter("taken > 0").select(F.explode(F.array_repeat("mixed_row", times)).alias("mixed_row")).select("mixed_row.*")
