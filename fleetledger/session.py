"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dir: dict[str, tempfile.TemporaryDirectory] = {}
_open_jobs: list[list[str]] = []


# Shuffle partitions are sized for this many bytes each, up to a count the driver can track (beyond
# 12 TB in one shuffle they grow, and tasks spill); adaptive execution joins small ones.
PARTITION_BYTES = 256 << 20
MAX_PARTITIONS = 50_000
UNKNOWN_BYTES = 1 << 60


def configure(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Set what the operators' results depend on (UTC) and what their plans rely on (AQE).

    With ``shuffled_bytes``, the size of the largest table that gets sorted or
    grouped, shuffles get enough partitions for one to fit a task's memory.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if shuffled_bytes:
        wanted = min(MAX_PARTITIONS, -(-shuffled_bytes // PARTITION_BYTES))
        spark.conf.set("spark.sql.shuffle.partitions", max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark


def estimated_bytes(*tables: DataFrame) -> int:
    """The size of tables by Spark's plan statistics (file sizes, after partition pruning); nothing is read.

    A table that no file backs, of which Spark only knows that it may be huge, counts nothing.
    """
    sizes = (int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in tables)
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"trip times are UTC; session time zone is {zone}, call fleetledger.session.configure")


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dir:
        _local_dir[app] = tempfile.TemporaryDirectory(prefix="fleetledger-", ignore_cleanup_errors=True)
    return _local_dir[app].name


def pin(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors and is the same for every later reader,
    unlike a recomputed plan whose row positions may move. Parquet keeps column
    pruning for the readers. The copy goes with the job it was made in, else with the application.
    ``codec`` packs a copy of wide rows smaller than the session's would.
    """
    path = f"{work_dir(df.sparkSession)}/fleetledger/{uuid.uuid4().hex}"
    if _open_jobs:
        _open_jobs[-1].append(path)
    df.write.parquet(path, compression=codec)
    if not _open_jobs:
        drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder, which must be there by now, when the application's driver ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, not there yet, that goes with the application, as does what is written beside it."""
    folder = f"{work_dir(spark)}/fleetledger/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    drop_at_exit(spark, folder)
    return f"{folder}/{name}"


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Tables pinned inside are deleted at the end, also after a failure; results must be stored by then."""
    _open_jobs.append([])
    try:
        yield
    finally:
        for path in _open_jobs.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
