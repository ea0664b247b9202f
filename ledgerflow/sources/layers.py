"""Where the pipeline's layers live: folders below one root, or catalog tables.

Both offer the same few operations, so the pipeline says what it reads and
writes and not how it is addressed:

* ``append`` and ``replace_partitions`` for tables that grow,
* ``read`` and ``exists``,
* ``snapshots`` for tables that are replaced as a whole (Silver, balances),
  and ``publish``, which makes a version of one the readers' version.

By name, growing tables are managed tables of a database: appended to and
overwritten by column name, new columns added. A replaced table is a view
over its version's table. That table's partitions point at the folders the
version is made of, so publishing writes no data, and one statement moves all
readers by name to the new version.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.config import TablePaths
from ledgerflow.sources import tables


class Layers(Protocol):
    def append(self, df: DataFrame, layer: str, partition_by: list[str]) -> None: ...
    def replace_partitions(self, df: DataFrame, layer: str, partition_by: list[str]) -> None: ...
    def exists(self, spark: SparkSession, layer: str) -> bool: ...
    def read(self, spark: SparkSession, layer: str) -> DataFrame: ...
    def last_date(self, spark: SparkSession, layer: str, col: str) -> dt.date | None: ...
    def snapshots(self, layer: str) -> tables.SnapshotTable: ...
    def publish(self, spark: SparkSession, layer: str, version: int) -> None: ...


@dataclass(frozen=True)
class PathLayers:
    """Layers as folders (``config.TablePaths``). Partition values are read back as text."""

    paths: TablePaths

    def _path(self, layer: str) -> str:
        return getattr(self.paths, layer)

    def append(self, df: DataFrame, layer: str, partition_by: list[str]) -> None:
        df.write.mode("append").partitionBy(*partition_by).parquet(self._path(layer))

    def replace_partitions(self, df: DataFrame, layer: str, partition_by: list[str]) -> None:
        tables.write_partitions(df, self._path(layer), partition_by)

    def exists(self, spark: SparkSession, layer: str) -> bool:
        return tables.has_data(spark, self._path(layer))

    def read(self, spark: SparkSession, layer: str) -> DataFrame:
        return tables.read_with_text_partitions(spark, self._path(layer))

    def last_date(self, spark: SparkSession, layer: str, col: str) -> dt.date | None:
        """The latest date among a table's partitions, from the listing alone."""
        return tables.last_partition(spark, self._path(layer), col)

    def snapshots(self, layer: str) -> tables.SnapshotTable:
        return tables.SnapshotTable(self._path(layer))

    def publish(self, spark: SparkSession, layer: str, version: int) -> None:
        """Readers by path find the highest version themselves."""


@dataclass(frozen=True)
class CatalogLayers:
    """Layers as tables of ``database``; versions of replaced tables lie in folders of ``paths``."""

    database: str
    paths: TablePaths

    #: Names of the tables in the database.
    NAMES = {
        "routed": "bronze_transactions",
        "silver": "silver_accounts",
        "audit": "daily_cdi_stagin_audit",
        "payout": "daily_cdi_bonus",
        "balance": "account_balance_last_day_cdi",
        "daily_payout": "daily_payout",
    }

    def name(self, layer: str) -> str:
        return f"{self.database}.{self.NAMES[layer]}"

    def _ensure(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def append(self, df: DataFrame, layer: str, partition_by: list[str]) -> None:
        self._ensure(df.sparkSession)
        tables.append_table(_as_text(df), self.name(layer), partition_by)

    def replace_partitions(self, df: DataFrame, layer: str, partition_by: list[str]) -> None:
        self._ensure(df.sparkSession)
        tables.overwrite_table_partitions(_as_text(df), self.name(layer), partition_by)

    def exists(self, spark: SparkSession, layer: str) -> bool:
        return tables.table_exists(spark, self.name(layer))

    def read(self, spark: SparkSession, layer: str) -> DataFrame:
        return tables.read_table(spark, self.name(layer))

    def last_date(self, spark: SparkSession, layer: str, col: str) -> dt.date | None:
        """The latest date among a table's partitions."""
        return self.read(spark, layer).agg(F.max(F.col(col).cast("date"))).first()[0]

    def snapshots(self, layer: str) -> tables.SnapshotTable:
        return tables.SnapshotTable(getattr(self.paths, layer))

    def publish(self, spark: SparkSession, layer: str, version: int) -> None:
        """Point the name at a complete version (also again, if it was rebuilt)."""
        self._ensure(spark)
        store, name = self.snapshots(layer), self.name(layer)
        at = f"{name}__v{version}"
        spark.sql(f"DROP TABLE IF EXISTS {at}")  # external: its files stay
        held = store.composition(spark, version)
        columns = store.read(spark, version).schema
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields]
        if held:
            spark.sql(f"CREATE TABLE {at} ({', '.join([*fields, f'{tables.BUCKET} INT'])}) USING parquet PARTITIONED BY ({tables.BUCKET}) LOCATION '{store.path(version)}'")
            parts = [f"PARTITION ({tables.BUCKET} = {b}) LOCATION '{store.bucket_path(v, b)}'" for b, v in sorted(held.items())]
            spark.sql(f"ALTER TABLE {at} ADD {' '.join(parts)}")
        else:
            spark.sql(f"CREATE TABLE {at} ({', '.join(fields)}) USING parquet LOCATION '{store.path(version)}'")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{f}`' for f in columns.fieldNames())} FROM {at}")
        offered = set(store.versions(spark))
        prefix = f"{self.NAMES[layer]}__v"
        for t in spark.catalog.listTables(self.database):
            if t.name.startswith(prefix) and int(t.name[len(prefix) :]) not in offered:
                spark.sql(f"DROP TABLE {self.database}.{t.name}")


def _as_text(df: DataFrame) -> DataFrame:
    """The raw values of rejected rows as one JSON text: a table's column cannot change its type when raw files gain columns."""
    return df.withColumn(tables.RAW, F.to_json(tables.RAW)) if tables.RAW in df.columns and dict(df.dtypes)[tables.RAW].startswith("struct") else df
