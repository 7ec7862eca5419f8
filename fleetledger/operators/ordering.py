"""Numbering and running totals that never put one whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetledger.session import pin

# A group above this many rows is spread over several tasks.
HOT_ROWS = 1_000_000
# A list of hot groups, or of their slices, is broadcast up to this many rows, and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition number above these


def number_rows(df: DataFrame, order: Sequence[str | Column], index: str) -> DataFrame:
    """Add ``index``: 0, 1, 2, ... over the whole table in the given order.

    A global sort range-partitions by sampled bounds, so its partitions stay even
    under any key distribution; copies that tie on every key still spread, because
    the reading partition is the last sort key. With no order given, rows keep the
    order they are read in and nothing is shuffled. The rows are pinned with their
    place inside the partition; one offset per partition (one number each, whatever
    the data) completes it.
    """
    if order:
        df = df.withColumn("_from", F.spark_partition_id()).orderBy(*order, "_from").drop("_from")
    placed = pin(df.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _POSITION_BITS)
    within = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg((F.max(within) + 1).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(index, F.col("_offset") + within)
        .drop("_part", "_place", "_offset")
    )


def running_total(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    value: str,
    total: str,
    *,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Add ``total``: the sum of ``value`` up to and including each row, per group, nulls first.

    Ordinary groups are one window each. Rows of groups with more than ``hot_rows`` rows
    are range-partitioned by group and order into slices of about ``hot_rows``, whatever
    the values are, and pinned; each slice is summed by itself and gets the sum of its
    group's slices before it. The list of hot groups holds at most rows/hot_rows
    entries, hence its broadcast. Where ``df`` is costly to compute, group sizes can
    be taken from ``counted``, a cheaper table holding at least the same groups and rows.

    ``per_group`` (one row per group) adds its columns, null for a group it lacks.
    """
    size = (df if counted is None else counted).groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    found = size.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows")).first()  # two numbers
    extra = [] if per_group is None else [c for c in per_group.columns if c != group]

    def owing(rows: DataFrame, table: DataFrame | None = per_group) -> DataFrame:
        return rows if table is None else rows.join(table, group, "left")

    def summed(rows: DataFrame) -> DataFrame:
        own = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return owing(rows.withColumn(total, F.sum(value).over(own)))

    if not found["groups"]:
        return summed(df).select(*df.columns, *extra, total)
    slices = int(found["rows"] // hot_rows) + 1
    small = F.broadcast if found["groups"] + slices <= BROADCAST_ROWS else lambda table: table
    hot = size.select(group, F.lit(True).alias("_hot"))
    marked = df.join(small(hot), group, "left")
    sliced = pin(
        marked.where("_hot").drop("_hot").repartitionByRange(slices, group, *order)
        .withColumn("_slice", F.spark_partition_id()))
    inside = Window.partitionBy(group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.groupBy(group, "_slice").agg(F.sum(value).alias("_sum")).select(
        group, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    spread = (
        sliced.withColumn("_inside", F.sum(value).over(inside))
        .join(small(before), [group, "_slice"])
        .withColumn(total, F.col("_inside") + F.col("_before")))
    cold = summed(marked.where("_hot is null").drop("_hot"))
    theirs = None if per_group is None else small(per_group.join(small(hot), group, "left_semi"))
    columns = [*df.columns, *extra, total]
    return cold.select(*columns).unionByName(owing(spread, theirs).select(*columns))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the least by ``order`` (remaining columns break ties).

    A min over a struct combines on the map side, so copies of one key collapse
    before the shuffle however many there are.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    lead = [c for c in order if c != key]
    least = F.min(F.struct(*lead, *rest)).alias("_first")
    return df.groupBy(key).agg(least).select(
        *[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])
