"""Sources: declared schemas, partition pruning, no file listing on the driver."""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetledger import schemas
from fleetledger.functions import times
from fleetledger.operators import logs
from fleetledger.sources.marks import file_system

Day = str | datetime.date | None


def as_date(day: Day) -> Column:
    """A ``YYYY-MM-DD`` processing date, yesterday when none is given. Other text raises."""
    return times.yesterday() if day is None else F.lit(datetime.date.fromisoformat(day_text(day)))


def day_text(day: Day) -> str:
    """The same as text, for a partition's folder."""
    if day is None:
        day = datetime.datetime.now(datetime.timezone.utc).date() - datetime.timedelta(days=1)
    if isinstance(day, str):
        day = datetime.datetime.strptime(day, "%Y-%m-%d").date()
    return day.isoformat()


def on_date(df: DataFrame, day: Day = None, column: str = "date") -> DataFrame:
    """Rows of one processing date; prunes partitions when the column is one."""
    return df.where(F.col(column) == as_date(day))


def strict_csv(reader: DataFrameReader, schema: T.StructType, partitioned: bool = False) -> DataFrameReader:
    """CSV with a header that must name the schema's columns in order; malformed rows raise.

    Of a ``date=/source=`` table the partition columns are in the folders, not in the header.
    """
    if partitioned:
        schema = T.StructType([f for f in schema.fields if f.name not in ("date", "source")])
    return (reader.format("csv").option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").schema(schema))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, strict: bool = True) -> DataFrame:
    """CSV with a header. Columns are matched by position and checked against the header.

    A malformed row raises when strict; else its text lands in ``_corrupt_record``.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType(), True)])
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(kept).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", root: str | None = None) -> DataFrame:
    """A table that may not exist yet; ``root`` names the table when the path is one of its partitions."""
    fs, place = file_system(spark, path)
    if not fs.exists(place):
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        reader = strict_csv(spark.read, schema, root is not None)
    else:
        reader = spark.read.schema(schema).format(fmt)
    if root is not None:
        reader = reader.option("basePath", root)
    return reader.load(path)


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet",
                     day: Day = None, source: str | None = None, every_day: bool = False) -> DataFrame:
    """A ``date=/source=`` table: one date (default yesterday), all its sources or one.

    One date is opened by its folder, so no other date is even listed; a date that
    was never written is empty.
    """
    root = root.rstrip("/")
    path = root if every_day else f"{root}/date={day_text(day)}"
    df = read_or_empty(spark, path, schema, fmt, root)
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields])  # partition values come as read
    return df if source is None else df.where(F.col("source") == source)


def read_report(spark: SparkSession, root: str, name: str, run: str) -> DataFrame:
    """One run's part of a report, with the run's column; ``run`` is like ``date=2024-01-15``."""
    folder = f"{root.rstrip('/')}/{name}"
    return spark.read.option("basePath", folder).parquet(f"{folder}/{run}")


def read_ledger(spark: SparkSession, path: str, environment: str, day: Day = None, every_day: bool = False) -> DataFrame:
    """One environment's publication ledger; empty before the first run."""
    path = path.rstrip("/")
    part = f"{path}/environment={environment}"
    return read_or_empty(spark, part if every_day else f"{part}/date={day_text(day)}", schemas.LEDGER, root=path)


def land_envelope(spark: SparkSession, path: str, record: T.StructType, body: str = "body") -> DataFrame:
    """Response documents (one per line) holding their rows under ``body``."""
    envelope = T.StructType([T.StructField(body, T.ArrayType(record), True)])
    return unpack_envelope(spark.read.schema(envelope).option("mode", "FAILFAST").json(path), body)


def land_envelope_or_quarantine(spark: SparkSession, path: str, record: T.StructType, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """The same, without ending at a document that can't be read: the rows of the others, and (document, file) of the bad ones."""
    envelope = T.StructType([T.StructField(body, T.ArrayType(record), True), T.StructField("_bad", T.StringType(), True)])
    lines = spark.read.text(path).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"))
    # The text is parsed once, by a generator that no filter is copied into.
    parsed = F.from_json("value", envelope, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    documents = lines.select("value", "file", F.inline(F.array(F.struct(parsed.alias("_doc")))))
    good = documents.where("_doc is not null and _doc._bad is null").select("_doc.*")
    bad = documents.where("_doc is null or _doc._bad is not null").select(F.col("value").alias("document"), "file")
    return unpack_envelope(good, body), bad


def unpack_envelope(documents: DataFrame, body: str = "body") -> DataFrame:
    return documents.select(F.explode(body).alias("_row")).select("_row.*")


def parse_envelope(text: DataFrame, record: T.StructType, column: str = "value", body: str = "body") -> DataFrame:
    """The same from a text column."""
    envelope = T.StructType([T.StructField(body, T.ArrayType(record), True)])
    return unpack_envelope(text.select(F.from_json(column, envelope, {"mode": "FAILFAST"}).alias("_doc")).select("_doc.*"), body)


def read_records(spark: SparkSession, path: str, schema: T.StructType, fields: Sequence[str] | None = None,
                 formula: Column | str | None = None, fmt: str = "json") -> DataFrame:
    """Exported nested records ``{id, fields{...}}``: a row formula, then a field list."""
    df = spark.read.schema(schema).format(fmt).load(path)
    if formula is not None:
        df = df.where(formula)
    return df if fields is None else df.select("id", F.struct(*[F.col(f"fields.{f}") for f in fields]).alias("fields"))


@dataclass(frozen=True)
class View:
    """A stored view of a record table: which rows, and which of their fields."""

    fields: tuple[str, ...] | None = None
    formula: str | None = None


def read_views(spark: SparkSession, path: str) -> dict[str, View]:
    """Views by name from a parameter document: ``{name: {fields: [...], formula: "..."}}``."""
    stored = read_document(spark, path)
    return {name: View(tuple(v["fields"]) if v.get("fields") else None, v.get("formula")) for name, v in stored.items()}


def read_view(spark: SparkSession, path: str, schema: T.StructType, views: Mapping[str, View], name: str, fmt: str = "json") -> DataFrame:
    """The records of a named view; a name that no view has raises."""
    if name not in views:
        raise ValueError(f"no view {name}; there are: {', '.join(sorted(views)) or 'none'}")
    return read_records(spark, path, schema, views[name].fields, views[name].formula, fmt)


def declare_table(spark: SparkSession, name: str, root: str, schema: T.StructType, by: Sequence[str] = ("date", "source")) -> DataFrame:
    """Register a ``date=/source=`` folder as an external table, with all partitions it has by now.

    Partitions are then found in the catalog, and a join with a list of dates prunes them while the query runs.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in by)
    place = root.rstrip("/").replace("'", "\\'")
    spark.sql(f"create table if not exists {name} ({columns}) using parquet partitioned by ({parts}) location '{place}'")
    spark.sql(f"msck repair table {name} sync partitions")
    return spark.table(name)


def read_events(spark: SparkSession, path: str, name: str, from_block: int = 0, to_block: int | None = None,
                schema: T.StructType = schemas.LEDGER_EVENTS, fmt: str = "parquet") -> DataFrame:
    """Ledger events of one type in a block range."""
    df = spark.read.schema(schema).format(fmt).load(path)
    df = df.where((F.col("event") == name) & (F.col("block") >= from_block))
    df = df if to_block is None else df.where(F.col("block") <= to_block)
    return df.select("block", "seq", "args.*")


def read_log_lines(spark: SparkSession, path: str | Sequence[str], field: int = 6, stream_field: int | None = None,
                   start: str | None = None, end: str | None = None, time_field: int | None = None,
                   modified_after: str | None = None, modified_before: str | None = None) -> DataFrame:
    """Log files as (stream, block, line_no, line), the line being one ``|``-separated field.

    A stream is a file, or the value of ``stream_field`` where a file holds several.
    ``line_no`` follows the file's order without reading it in one task: a split's
    offset orders the splits, the row's place orders lines inside one. ``block`` is
    the file and that offset, so each split is one block of ``logs.publish_stats``, and a
    stream goes on from one file to the next in the order of their names. ``start`` and
    ``end`` keep lines whose ``time_field`` is in that half-open range; a line without a
    readable time is in no range. ``modified_after`` and ``modified_before`` (``YYYY-MM-DDTHH:MM:SS``) leave out
    files by the time they were written, before any is opened.
    """
    stream = F.col("_metadata.file_path") if stream_field is None else logs.cut_field("value", stream_field)
    reader = spark.read
    for option, at in (("modifiedAfter", modified_after), ("modifiedBefore", modified_before)):
        reader = reader if at is None else reader.option(option, at)
    raw = reader.text(path if isinstance(path, str) else list(path)).select(
        stream.alias("stream"), F.struct("_metadata.file_path", "_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"), "value")
    if time_field is not None:
        at = F.try_to_timestamp(F.split_part("value", F.lit("|"), F.lit(time_field)))
        raw = raw if start is None else raw.where(at >= F.lit(start).cast("timestamp"))
        raw = raw if end is None else raw.where(at < F.lit(end).cast("timestamp"))
    return raw.select("stream", "block", "line_no", logs.cut_field("value", field).alias("line"))


def read_document(spark: SparkSession, path: str) -> Any:
    """A small parameter document, YAML or JSON, parsed on the driver."""
    text = spark.read.text(path, wholetext=True).first()[0]
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)


def read_device_list(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A device list table."""
    return spark.read.schema(schemas.DEVICE_LIST).option("header", True).format(fmt).load(path)
