"""Daily driver figures kept up by increments.

A batch of finished routes is reduced to one row per driver and day and stored as a piece of the days
it touches. A batch that is run again takes its earlier pieces' place, so it counts once. Figures are the sums
over a day's pieces: reading a day opens that day's pieces only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import metrics
from fleetledger.sources.store import Snapshot, Store

SUMS, MERGED = "sums", "merged"
BY = {"date": "date"}


def add(spark: SparkSession, path: str, routes: DataFrame, batch: str) -> Snapshot:
    """Take in one batch's finished routes. A batch whose pieces were merged by ``compact`` raises."""
    store = Store(spark, path)
    if batch in store.snapshot().facts.get(MERGED, []):
        raise ValueError(f"batch {batch} is part of merged figures and can't be run again")
    return store.add(SUMS, metrics.daily_driver(routes).select(*schemas.DRIVER_DAYS.names), batch, BY)


def figures(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """Routes, time and distance per driver and day, of all days or of some (``YYYY-MM-DD``)."""
    parts = None if days is None else [f"_by_date={d}" for d in days]
    return Store(spark, path).read(SUMS, schemas.DRIVER_DAYS, parts).groupBy("celo_address", "date").agg(
        *[F.sum(c).alias(c) for c in ("routes", "total_seconds", "total_distance")])


def compact(spark: SparkSession, path: str, pieces: int = 8) -> list[str]:
    """Merge the pieces of days that have many; returns those days' parts."""
    store = Store(spark, path)
    before = store.snapshot()
    many = [p for p, have in before.parts.get(SUMS, {}).items() if len(have) > pieces]
    if many:
        sums = store.read(SUMS, schemas.DRIVER_DAYS, many, before).groupBy("celo_address", "date").agg(
            *[F.sum(c).alias(c) for c in ("routes", "total_seconds", "total_distance")])
        version, parts = store.write(SUMS, sums.select(*schemas.DRIVER_DAYS.names), BY)
        merged = sorted({*before.facts.get(MERGED, []), *(name for p in many for name in before.parts[SUMS][p])})
        store.commit({SUMS: {p: {version: version} for p in parts}}, before, drop={SUMS: many}, facts={MERGED: merged})
    return many
