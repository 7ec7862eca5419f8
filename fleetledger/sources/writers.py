"""Sinks: idempotent partition overwrite, whole-table overwrite, keyed upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetledger.session import pin
from fleetledger.sources import readers


class EmptyInput(ValueError):
    """There is nothing to write and the sink asks for rows."""


def require_non_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyInput("no rows to write")
    return df


def write_partitioned(df: DataFrame, root: str, by: Sequence[str] = ("date", "source"), fmt: str = "parquet",
                      non_empty: bool = False, even: bool = True, **options: str) -> None:
    """Overwrite exactly the partitions present in ``df``.

    ``even`` lets adaptive execution gather each partition's rows into files of the
    advisory size: small ones are joined, and a partition with a large share of the
    rows is written by several tasks. Rows already sorted by the partition keys
    (as after id assignment) need none of it. ``options`` go to the writer.
    """
    if non_empty:
        require_non_empty(df)
    if even:
        df = df.hint("rebalance", *by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
     .options(**options).partitionBy(*by).format(fmt).save(root))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a whole table."""
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = ()) -> None:
    """Add rows to a table that only grows."""
    writer = df.write.mode("append").option("header", True).format(fmt)
    (writer.partitionBy(*by) if by else writer).save(path)


def by_block(events: DataFrame) -> DataFrame:
    """Ledger events in ranges of their block, sorted, so that a reader of some blocks skips the other files and row groups."""
    return events.repartitionByRange("block", "seq").sortWithinPartitions("block", "seq")


def write_report(df: DataFrame, root: str, name: str, run: str, fmt: str = "parquet") -> None:
    """Replace one run's part of a report: the folder ``name/run`` below ``root``, ``run`` being like ``date=2024-01-15``."""
    df.drop(run.split("=")[0]).write.mode("overwrite").option("header", True).format(fmt).save(f"{root.rstrip('/')}/{name}/{run}")


def write_day(df: DataFrame, root: str, day: readers.Day = None, fmt: str = "parquet") -> None:
    """Replace one date of a ``date=/source=`` table as a whole: a source without rows ends up empty."""
    rows = readers.on_date(df, day).drop("date")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True)
     .partitionBy("source").format(fmt).save(f"{root.rstrip('/')}/date={readers.day_text(day)}"))


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Overwrite the ledger's ``environment, date`` partitions with the merged entries."""
    write_partitioned(pin(ledger), path, ("environment", "date"))


def upsert(base: DataFrame, updates: DataFrame, key: str, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """``base`` with columns replaced where ``updates`` has a value for the key (unique there)."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    new = updates.select(key, *[F.col(u).alias(f"_new_{b}") for b, u in names.items()])
    return base.join(new, key, "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in names else F.col(c) for c in base.columns])


def upsert_fields(base: DataFrame, updates: DataFrame, fields: Sequence[str], key: str = "id") -> DataFrame:
    """The same for values nested in ``fields`` of a record table."""
    new = updates.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields])
    inner = F.col("fields")
    for f in fields:
        inner = inner.withField(f, F.coalesce(F.col(f"_new_{f}"), F.col(f"fields.{f}")))
    return base.join(new, key, "left").select(*[inner.alias(c) if c == "fields" else F.col(c) for c in base.columns])


def pairs_as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Location pairs as ``(lng, lat)`` text for a CSV extract."""
    return df.withColumns({
        c: F.concat(F.lit("("), F.col(f"{c}.lng").cast("string"), F.lit(", "), F.col(f"{c}.lat").cast("string"), F.lit(")"))
        for c in columns})
