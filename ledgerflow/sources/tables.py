"""Table I/O on plain Parquet: appends with schema evolution, one-pass routed
writes, versioned snapshots (create / upsert without overwriting what is being
read), partitioned exports and catalog tables.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.config import TIME_RANGE, TRANSACTION_TYPES, Columns
from ledgerflow.functions.rules import is_rejected, quarantine_reasons
from ledgerflow.operators import quality
from ledgerflow.session import remove_path

_VERSION_DIR = re.compile(r"^version=(\d+)$")


# --- plain appends -------------------------------------------------------------

def append(df: DataFrame, path: str) -> None:
    """Append files to a Parquet table; new columns are allowed (read with
    ``read_evolving``, older files show them as NULL)."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table whose files have different (compatible) schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_with_text_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned Parquet table, its partition values as text.

    Inferred types change with the values: a run id ``007`` would come back
    as the number 7. Callers cast what they know to be a date.
    """
    types = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(types)
    spark.conf.set(types, "false")
    try:
        return spark.read.parquet(path)  # partitions are listed and typed here
    finally:
        spark.conf.set(types, before)


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a committed Spark write (its ``_SUCCESS`` marker)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")))


def file_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath))


def set_mark(spark: SparkSession, path: str, on: bool) -> None:
    """Create or remove an empty marker file."""
    if not on:
        remove_path(spark, path)
    elif not file_exists(spark, path):
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(hpath).close()


def has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds committed output of any Spark write.

    Writes with dynamic partition overwrite leave no ``_SUCCESS`` marker at
    the root; their partition directories (like appended files) only appear
    when the job commits, so any visible child means committed data.
    """
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(hpath))


def input_size(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (a directory, file or glob) from file-system
    metadata only; nothing is read."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    statuses = fs.globStatus(hpath) or []
    return int(sum(fs.getContentSummary(st.getPath()).getLength() for st in statuses))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory()]


def last_partition(spark: SparkSession, path: str, col: str) -> dt.date | None:
    """The latest date among the ``col=YYYY-MM-DD`` directories, from the listing alone."""
    names = [n.split("=", 1)[1] for n in list_dirs(spark, path) if n.startswith(f"{col}=")]
    return max((dt.date.fromisoformat(n) for n in names if re.fullmatch(r"\d{4}-\d\d-\d\d", n)), default=None)


# --- Bronze: one scan, two tables --------------------------------------------------

ROUTE = "route"
RAW = "raw"


def with_raw(df: DataFrame) -> DataFrame:
    """``df`` with its values as delivered, as text, in one struct column:
    evidence for rows that are rejected once the columns are normalised."""
    return df.withColumn(RAW, F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]))


def tag_routes(df: DataFrame, cols: Columns = Columns(), types=TRANSACTION_TYPES, time_range=TIME_RANGE) -> DataFrame:
    """Add ``route`` and, for rejected rows only, their reasons; the raw values
    stay with rejected rows and become NULL on valid ones."""
    with_id = cols.event_id in df.columns
    rejected = is_rejected(cols, tuple(types), with_id, time_range)
    reasons = F.when(rejected, quarantine_reasons(cols, tuple(types), with_id, time_range))
    out = (
        df.withColumn(quality.REASONS, reasons)
        .withColumn(quality.REASON, F.get(F.col(quality.REASONS), 0))
        .withColumn(ROUTE, F.when(rejected, F.lit("quarantine")).otherwise(F.lit("valid")))
    )
    return out.withColumn(RAW, F.when(rejected, F.col(RAW))) if RAW in df.columns else out


def observe_routes(df: DataFrame, cols: Columns = Columns(), types=TRANSACTION_TYPES, time_range=TIME_RANGE):
    """(tagged events, observation): the rows with their route, counted while they are written.

    The observation gives ``rows``, ``valid``, ``quarantine`` and
    ``null_amount`` once the write is done, so layer metrics cost no extra pass.
    """
    from pyspark.sql import Observation

    obs = Observation("bronze_routing")
    tagged = tag_routes(df, cols, tuple(types), time_range)
    return tagged.observe(obs, *route_counts(cols)), obs


def route_counts(cols: Columns = Columns()) -> list[Column]:
    """Counts over tagged events, for an observation in a batch or on a stream."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(ROUTE) == "valid", 1)).alias("valid"),
        F.count(F.when(F.col(ROUTE) == "quarantine", 1)).alias("quarantine"),
        F.count(F.when(F.col(cols.amount).isNull(), 1)).alias("null_amount"),
    ]


def write_routed(df: DataFrame, routed_path: str, **rules) -> dict[str, int]:
    """Append every event to ``routed_path/route=valid`` or
    ``routed_path/route=quarantine`` (with its ``reasons``) in one job over
    one scan: the two tables are the two partitions of one partitioned write.

    Returns the in-flight counts of ``observe_routes``.
    """
    observed, obs = observe_routes(
        df, rules.get("cols", Columns()), rules.get("transaction_types", TRANSACTION_TYPES), rules.get("time_range", TIME_RANGE)
    )
    observed.write.mode("append").partitionBy(ROUTE).parquet(routed_path)
    return dict(obs.get)


# --- versioned snapshots -------------------------------------------------------------

#: Folder level of a bucketed version; readers never see it as a column.
BUCKET = "state_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """The fixed hash bucket of a row's key."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class SnapshotTable:
    """A table stored as ``<root>/version=N`` directories.

    Readers take the highest version with a ``_SUCCESS`` marker. A writer
    never touches a directory it reads: version N is built from a complete
    version below N, so rebuilding N (a replayed micro-batch) gives the same
    snapshot again.

    A version is whole, or holds only the hash buckets of the key that it
    changed (``write_buckets``). Every other bucket of such a version is the
    newest one below it, down to the last whole version, and its files stay
    where they are: what a version writes follows what it changes. A version
    no longer offered to readers stays as far as its buckets are still used.
    """

    root: str

    def versions(self, spark: SparkSession) -> list[int]:
        return [v for v in self._numbers(spark) if self._offered(spark, v)]

    def path(self, version: int) -> str:
        return os.path.join(self.root, f"version={version}")

    def _numbers(self, spark: SparkSession) -> list[int]:
        return sorted(int(m.group(1)) for name in list_dirs(spark, self.root) if (m := _VERSION_DIR.match(name)))

    def _mark(self, kind: str, version: int) -> str:
        return os.path.join(self.root, f"_{kind}", f"v{version}")

    def _offered(self, spark: SparkSession, version: int) -> bool:
        return exists(spark, self.path(version)) and not file_exists(spark, self._mark("retired", version))

    def latest(self, spark: SparkSession, below: int | None = None) -> int | None:
        """Highest complete version (below ``below``): one directory listing,
        then marker checks from the top down until the first complete one."""
        for v in reversed(self._numbers(spark)):
            if (below is None or v < below) and self._offered(spark, v):
                return v
        return None

    def is_table(self, spark: SparkSession) -> bool:
        return self.latest(spark) is not None

    def is_partial(self, spark: SparkSession, version: int) -> bool:
        return file_exists(spark, self._mark("partial", version))

    def _buckets_in(self, spark: SparkSession, version: int) -> list[int]:
        return [int(n.split("=", 1)[1]) for n in list_dirs(spark, self.path(version)) if n.startswith(f"{BUCKET}=")]

    def composition(self, spark: SparkSession, version: int) -> dict[int, int]:
        """Of every bucket that holds rows, the version whose files it is in; from directory listings alone."""
        out: dict[int, int] = {}
        for v in reversed([n for n in self._numbers(spark) if n <= version]):
            if exists(spark, self.path(v)):
                for b in self._buckets_in(spark, v):
                    out.setdefault(b, v)
                if not self.is_partial(spark, v):
                    break
        return out

    def bucket_path(self, version: int, bucket: int) -> str:
        return os.path.join(self.path(version), f"{BUCKET}={bucket}")

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        v = self.latest(spark) if version is None else version
        if v is None:
            raise FileNotFoundError(f"no complete snapshot under {self.root}")
        if self.is_partial(spark, v):
            return self.read_buckets(spark, v)
        return spark.read.parquet(self.path(v)).drop(BUCKET)

    def read_buckets(self, spark: SparkSession, version: int, buckets: list[int] | None = None, schema: StructType | None = None) -> DataFrame:
        """The given buckets of a bucketed version (all without a list): only their folders are listed and read.

        ``schema`` is that of the result where no version holds a row yet.
        """
        held = self.composition(spark, version)
        wanted = sorted(held if buckets is None else held.keys() & set(buckets))
        if not wanted:  # the schema of any version will do
            some = next((v for v in reversed(self._numbers(spark)) if v <= version and self._buckets_in(spark, v)), None)
            if some is None and schema is not None:
                return spark.createDataFrame([], schema)
            return spark.read.parquet(self.path(version if some is None else some)).drop(BUCKET).limit(0)
        return spark.read.parquet(*[self.bucket_path(held[b], b) for b in wanted])

    def write(self, df: DataFrame, version: int, key: str | None = None, buckets: int | None = None, **meta) -> None:
        """Write version N whole (overwriting only an incomplete or replayed N),
        with a ``key`` dealt to that many hash buckets.

        ``meta`` says what the version holds (kind, grain, cutoff, last batch,
        the version it was built from); it is stored beside the versions,
        before the data, so a complete version always has it.
        """
        spark = df.sparkSession
        self._begin(spark, version, False, {**meta, "buckets": buckets})
        if key is None:
            df.write.mode("overwrite").parquet(self.path(version))
        else:
            self._write_dealt(df, version, key, buckets)

    def write_buckets(self, df: DataFrame, version: int, key: str, buckets: int, **meta) -> None:
        """Write version N as the buckets that ``df`` holds, over a bucketed version below.

        ``df`` must hold every row of each bucket it touches.
        """
        self._begin(df.sparkSession, version, True, {**meta, "buckets": buckets})
        self._write_dealt(df, version, key, buckets)

    def _write_dealt(self, df: DataFrame, version: int, key: str, buckets: int) -> None:
        dealt = df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET)  # one file per bucket
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(self.path(version))

    def _begin(self, spark: SparkSession, version: int, partial: bool, meta: dict) -> None:
        row = spark.createDataFrame([(version, json.dumps(meta, sort_keys=True))], "version int, meta string")
        row.coalesce(1).write.mode("overwrite").parquet(os.path.join(self.root, "_meta", f"v{version}"))
        remove_path(spark, self.path(version))  # a replayed version must not be read under another mark
        set_mark(spark, self._mark("partial", version), partial)
        set_mark(spark, self._mark("retired", version), False)

    def meta(self, spark: SparkSession, version: int) -> dict:
        """What ``write`` was told about a version (empty if nothing)."""
        path = os.path.join(self.root, "_meta", f"v{version}")
        return json.loads(spark.read.schema("version int, meta string").parquet(path).first()["meta"]) if exists(spark, path) else {}

    def drop_below(self, spark: SparkSession, version: int, keep: int = 2) -> None:
        """Offer only the newest ``keep`` complete versions below ``version``; of
        older ones remove all that no offered version still uses."""
        below = [v for v in self.versions(spark) if v < version]
        oldest = min(below[-keep:] if keep else [version], default=version)
        used: dict[int, set[int]] = {}
        for b, v in self.composition(spark, oldest).items():
            used.setdefault(v, set()).add(b)
        for v in [v for v in self._numbers(spark) if v < oldest]:
            if v in used:
                set_mark(spark, self._mark("retired", v), True)
                for b in set(self._buckets_in(spark, v)) - used[v]:
                    remove_path(spark, self.bucket_path(v, b))
            else:
                remove_path(spark, self.path(v))
                for kind in ("partial", "retired", "meta"):
                    remove_path(spark, self._mark(kind, v))

    def next_version(self, spark: SparkSession) -> int:
        v = self.latest(spark)
        return 0 if v is None else v + 1


def write_partitions(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``. The overwrite mode is
    an option of this write alone; other writes of the session keep theirs."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def export_partitions(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet") -> None:
    """Bulk-load export: one directory per ``partition_col`` value; rerunning a
    date replaces only that date's partition."""
    write_partitions(df, path, [partition_col], fmt)


# --- catalog tables ----------------------------------------------------------------

def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Batch read of a catalog table by name."""
    return spark.table(name)


def create_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Create a managed table from a frame (an error if it exists)."""
    writer = df.writeTo(name).using("parquet")
    (writer.partitionedBy(*[F.col(c) for c in partition_by]) if partition_by else writer).create()


def _fitted(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the columns, types and order of a table, to which its new columns are added first."""
    spark = df.sparkSession
    known = {f.name for f in spark.table(name).schema.fields}
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    target = spark.table(name).schema
    cols = [F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None) for f in target.fields]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, target.fields, strict=True)])


def append_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Append to a managed table by column name, creating it on first use.

    Columns that the table lacks are added to it (older rows show NULL);
    columns that ``df`` lacks are written as NULL. A partitioned table takes
    rows of any partition.
    """
    if not table_exists(df.sparkSession, name):
        create_table(df, name, partition_by)
    else:
        _fitted(df, name).write.mode("append").insertInto(name)


def overwrite_table_partitions(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions of a managed table that ``df`` holds, creating the table on first use."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        create_table(df, name, partition_by)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert by name takes it from the session alone
    try:
        _fitted(df, name).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a managed table, schema included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
