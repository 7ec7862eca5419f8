"""Which log files hold which times, so that a time range opens few files.

The index has a row per file: path, modification time, least and greatest readable time of its lines.
An update lists the files, reads those that the index lacks or has an older state of, and adds them as one
piece. Names of files in a range meet on the driver, lines never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.sources import readers
from fleetledger.sources.store import RECORDS, Store


def update(spark: SparkSession, logs: str, path: str, time_field: int) -> int:
    """Index files that are new or were written again since; returns their number."""
    store = Store(spark, path)
    now = store.snapshot()
    known = _latest(store.read(RECORDS, schemas.LOG_FILES, snapshot=now)).select("path", "modified")
    # Listing reads no content.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(logs).select(
        "path", F.col("modificationTime").alias("modified"))
    new = [r.path for r in listed.join(known, ["path", "modified"], "left_anti").select("path").collect()]  # names of new files
    if not new:
        return 0
    at = F.try_to_timestamp(F.split_part("value", F.lit("|"), F.lit(time_field)))
    times = spark.read.text(new).select(F.col("_metadata.file_path").alias("uri"), at.alias("at"))
    by_file = times.groupBy("uri").agg(F.min("at").alias("least"), F.max("at").alias("greatest"))
    plain = listed.where(F.col("path").isin(new)) if len(new) <= 1_000 else listed.join(known, ["path", "modified"], "left_anti")
    met = plain.join(by_file, _as_uri("path") == _as_uri("uri"), "left")
    version, parts = store.write(RECORDS, met.select(*schemas.LOG_FILES.names))
    have = now.parts.get(RECORDS, {})
    store.commit({RECORDS: {p: {**have.get(p, {}), version: version} for p in parts}}, now)
    return len(new)


def _as_uri(column: str) -> Column:
    """A file's name without how its scheme is written; blanks and the like as they are in a path."""
    plain = F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B"))) if column == "uri" else F.col(column)
    return F.regexp_replace(plain, "^file:/+", "file:/")


def _latest(index: DataFrame) -> DataFrame:
    """The newest row of each file."""
    order = Window.partitionBy("path").orderBy(F.col("modified").desc())
    return index.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def files_in(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> list[str]:
    """Files with a line in the half-open range, by name."""
    index = _latest(Store(spark, path).read(RECORDS, schemas.LOG_FILES))
    found = index.where(F.col("greatest").isNotNull())
    found = found if start is None else found.where(F.col("greatest") >= F.lit(start).cast("timestamp"))
    found = found if end is None else found.where(F.col("least") < F.lit(end).cast("timestamp"))
    return [r.path for r in found.select("path").orderBy("path").collect()]


def read_range(spark: SparkSession, path: str, time_field: int, start: str | None = None, end: str | None = None,
               field: int = 6, stream_field: int | None = None) -> DataFrame:
    """``readers.read_log_lines`` of a time range, from the files that have any of it."""
    files = files_in(spark, path, start, end)
    if not files:
        return spark.createDataFrame([], "stream string, block struct<file_path:string,file_block_start:bigint>, line_no bigint, line string")
    return readers.read_log_lines(spark, files, field, stream_field, start, end, time_field)
