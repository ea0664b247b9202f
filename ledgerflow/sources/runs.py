"""Events folded so far, as sorted runs that a batch reads only in part.

Every batch leaves one run, its events sorted by id. A later batch that asks
which of its ids were folded before reads only the ranges its ids lie in: the
ranges are pushed down to the files, whose sorted row groups and pages outside
them are skipped. Runs of about the same size are merged, a few at a time, into
one of the next size, which keeps the latest version of each id; so there are
few runs, and an event is rewritten once per size only.

A run is named by the batches it covers. A reader takes the widest complete
runs, so a merge that broke off is not seen, and one that ended before its
parts were removed does no harm.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerflow.operators import quality
from ledgerflow.session import remove_path
from ledgerflow.sources import tables

#: Id ranges of a batch that are pushed down.
RANGES = 64
#: Neighbouring runs of one size tier that are merged, and the step between tiers.
FANOUT = 8
#: Bytes of the lowest tier.
TIER_BYTES = 1 << 20
#: Small row groups, so that a range skips most of a file.
ROW_GROUP = 16 << 20

_RUN = re.compile(r"^run=(\d+)-(\d+)$")


@dataclass(frozen=True)
class EventRuns:
    """Runs under ``root``, sorted by ``key``; of one id the greatest by ``order`` is the latest."""

    root: str
    key: str
    order: tuple[str, ...]

    def path(self, run: tuple[int, int]) -> str:
        return f"{self.root}/run={run[0]}-{run[1]}"

    def runs(self, spark: SparkSession, below: int | None = None) -> list[tuple[int, int]]:
        """The widest complete runs over batches below ``below``, in order."""
        found = [tuple(map(int, m.groups())) for n in tables.list_dirs(spark, self.root) if (m := _RUN.match(n))]
        out: list[tuple[int, int]] = []
        for run in sorted(found, key=lambda r: (r[0], -r[1])):
            if (below is None or run[1] < below) and not (out and run[1] <= out[-1][1]) and tables.exists(spark, self.path(run)):
                out.append(run)
        return out

    def _write(self, df: DataFrame, run: tuple[int, int]) -> None:
        # no count given: adaptive execution picks it from the run's size
        sorted_ids = df.repartitionByRange(F.col(self.key)).sortWithinPartitions(self.key)
        sorted_ids.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(self.path(run))

    def write(self, df: DataFrame, batch: int) -> DataFrame:
        """Write a batch's run (again, if it is replayed) and read it back."""
        self._write(df, (batch, batch))
        return df.sparkSession.read.schema(df.schema).parquet(self.path((batch, batch)))

    def ranges(self, ids: DataFrame) -> list[tuple]:
        """(first, last) of up to RANGES stretches that hold all ids, numbers cut once more at each one's widest gap: a few values, whatever the batch."""
        parts = ids.select(self.key).repartitionByRange(RANGES, self.key).withColumn("part", F.spark_partition_id())
        ends = [F.min(self.key).alias("lo"), F.max(self.key).alias("hi")]
        if not isinstance(parts.schema[self.key].dataType, NumericType):
            rows = parts.groupBy("part").agg(*ends).collect()
            return sorted((r.lo, r.hi) for r in rows if r.lo is not None)
        before = F.lag(self.key).over(Window.partitionBy("part").orderBy(self.key))
        gaps = parts.withColumn("before", before).withColumn("gap", F.col(self.key).cast("double") - F.col("before").cast("double"))
        rows = gaps.groupBy("part").agg(*ends, F.max_by(F.struct("before", F.col(self.key).alias("after")), "gap").alias("cut")).collect()
        cut = [[(r.lo, r.cut.before), (r.cut.after, r.hi)] if r.cut else [(r.lo, r.hi)] for r in rows if r.lo is not None]
        return sorted(stretch for two in cut for stretch in two)

    def lookup(self, spark: SparkSession, ids: DataFrame, below: int) -> DataFrame | None:
        """The latest folded version of each of ``ids`` in batches below ``below``, or None if there is no run."""
        found = self.candidates(spark, ids, below)
        return None if found is None else quality.dedup_latest(found.join(ids.select(self.key).distinct(), self.key, "left_semi"), self.key, self.order)

    def candidates(self, spark: SparkSession, ids: DataFrame, below: int) -> DataFrame | None:
        """The folded events in the ranges of ``ids``; the rest of the files is skipped."""
        runs = self.runs(spark, below)
        if not runs:
            return None
        inside = [F.col(self.key).between(F.lit(lo), F.lit(hi)) for lo, hi in self.ranges(ids)]
        return spark.read.parquet(*map(self.path, runs)).filter(reduce(lambda a, b: a | b, inside, F.lit(False)))

    def _tier(self, spark: SparkSession, run: tuple[int, int]) -> int:
        """Tier of a run's size, or of the merges its batches took, so that small runs too are rewritten once per tier."""
        merges, batches = 0, run[1] - run[0] + 1
        while batches >= FANOUT:
            merges, batches = merges + 1, batches // FANOUT
        return max(merges, math.ceil(math.log(max(tables.input_size(spark, self.path(run)), 1) / TIER_BYTES, FANOUT)))

    def compact(self, spark: SparkSession, below: int) -> list[tuple[int, int]]:
        """Merge FANOUT neighbouring runs of one tier, as often as there are any; returns the new runs.

        Only runs over batches below ``below`` are touched: a batch that may
        be replayed finds what it found at first.
        """
        made = []
        while True:
            runs = self.runs(spark, below)
            tiers = [self._tier(spark, r) for r in runs]
            at = next((i for i in range(len(runs) - FANOUT + 1) if len(set(tiers[i : i + FANOUT])) == 1), None)
            if at is None:
                break
            parts = runs[at : at + FANOUT]
            merged = (parts[0][0], parts[-1][1])
            self._write(quality.dedup_latest(spark.read.parquet(*map(self.path, parts)), self.key, self.order), merged)
            made.append(merged)
        self._remove_covered(spark)
        return made

    def drop_older(self, spark: SparkSession, below: int, at: str, limit: str) -> None:
        """Remove runs over batches below ``below`` all of whose times ``at`` lie before ``limit``; file footers tell."""
        for run in self.runs(spark, below):
            if not spark.read.parquet(self.path(run)).filter(F.col(at) >= F.lit(limit).cast("timestamp")).limit(1).count():
                remove_path(spark, self.path(run))

    def _remove_covered(self, spark: SparkSession) -> None:
        """Remove runs inside a wider complete one (also those of a merge that broke off before)."""
        kept = set(self.runs(spark))
        for name in tables.list_dirs(spark, self.root):
            m = _RUN.match(name)
            run = tuple(map(int, m.groups())) if m else None
            if run and run not in kept and any(lo <= run[0] and run[1] <= hi for lo, hi in kept):
                remove_path(spark, self.path(run))
