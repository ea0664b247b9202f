"""Session helpers: a local session for tests/bench and a shared scratch dir."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerflow", extra: dict | None = None
) -> SparkSession:
    """Local session with the settings every test and bench run shares
    (``extra``: further builder settings, e.g. an event-log folder)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="ledgerflow-ckpt-"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings the ledger semantics depend on (safe to call on any session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, also
    when it is not in the working directory (a cluster gets it as usual, with
    its image or --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir``; only when it is unset on a local master
    (tests) create a private folder under the system temp dir and register it.
    On a cluster a machine-local folder would be invisible to the other
    machines, so an unset folder is an error there.
    """
    workers_find_package(spark)
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[(?!.*,.*,)|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


#: Scratch locations handed out in this process and not yet removed.
_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location inside the shared folder (see ``release_scratch``)."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.add(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through the store's own file system (any scheme); absent is fine."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
    _SCRATCH.discard(path)


def release_scratch(spark: SparkSession) -> int:
    """Remove every scratch location this process was given; returns how many.

    Frames read from them are unusable afterwards: call it once their results
    are written, before the session stops.
    """
    paths = sorted(_SCRATCH)
    for path in paths:
        remove_path(spark, path)
    return len(paths)


GIB = 1 << 30


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Runtime SQL settings for a cluster run, sized from the input.

    The initial shuffle width aims at ~1 GiB of *input* per partition (shuffle
    data is much smaller after column pruning and map-side partial
    aggregation) and never below 3x the cores; AQE then coalesces small
    partitions to the advisory size and splits skewed ones. Broadcasts are
    decided at runtime from measured sizes, under a fixed threshold.
    """
    width = max(3 * total_cores, min(200_000, input_bytes // GIB))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.parquet.compression.codec": "zstd",
    }


# Submit-time settings (static: set them on the cluster, not from a session):
# graceful decommissioning migrates shuffle and cached blocks off executors
# that are being taken away, so their map outputs need not be recomputed.
SUBMIT_SETTINGS = {
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def apply_scale_settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    cores = spark.sparkContext.defaultParallelism
    settings = scale_settings(input_bytes, cores)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
