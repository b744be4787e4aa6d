"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import shutil
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def session(
    app_name: str,
    *,
    master: str | None = None,
    codec: str = "gzip",
    broadcast_timeout: int = 600,
    shuffle_partitions: int | None = None,
    split_bytes: int | None = None,
    advisory_bytes: int | None = None,
    kryo: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session.

    ``split_bytes`` sets how much input one scan task reads. Weather scans want it
    large (512 MB and up): more rows per task means more readings folded into each
    cell before the shuffle. ``shuffle_partitions`` is a starting point only, as
    adaptive execution merges small partitions and splits large ones; ``advisory_bytes``
    is the size it aims at, and so about the most that one task writes.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Measured, not estimated: applies once the side has been computed.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
        # Writing into many folders takes time per file, whatever its size: small
        # partitions are better left to run side by side than merged into one task.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        "spark.sql.parquet.compression.codec": codec,
        "spark.sql.broadcastTimeout": str(broadcast_timeout),
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if split_bytes is not None:
        settings["spark.sql.files.maxPartitionBytes"] = str(split_bytes)
    if advisory_bytes is not None:
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(advisory_bytes)
    if kryo:
        settings["spark.serializer"] = "org.apache.spark.serializer.KryoSerializer"
    settings.update(extra or {})

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder, named but not created, below the one the cluster shares.

    The cluster names that folder in ``spark.checkpoint.dir``. Where the whole session runs
    on this machine, a folder in its warehouse stands in, and goes when the process ends.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        base = _own_folder(spark.conf.get("spark.sql.warehouse.dir"))
    return f"{base.rstrip('/')}/cellweave-{uuid.uuid4().hex}"


@cache
def _own_folder(warehouse: str) -> str:
    folder = f"{warehouse.rstrip('/')}/_cellweave-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return folder


def _place(spark: SparkSession, path: str):
    """A path and the file system that Spark would look for it in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has made."""
    place, store = _place(spark, path)
    store.delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark would look for it in."""
    place, store = _place(spark, path)
    return store.makeQualified(place).toUri().toString()


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; nothing may be at the target."""
    place, store = _place(spark, path)
    if not store.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {path} to {target}")


def siblings(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What lies beside a path under a name that begins so, by name."""
    place, store = _place(spark, path)
    parent = place.getParent()
    if parent is None or not store.exists(parent):
        return []
    names = (status.getPath().getName() for status in store.listStatus(parent))
    return sorted(f"{parent.toString().rstrip('/')}/{name}" for name in names if name.startswith(prefix))


def beside(spark: SparkSession, path: str, name: str) -> str:
    """A place in the folder that a path is in."""
    place, _ = _place(spark, path)
    return f"{place.getParent().toString().rstrip('/')}/{name}"
