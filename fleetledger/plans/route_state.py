"""The state of recorded routes, kept by block: only blocks after the last one folded are read.

The first write to a token stands. New blocks are reduced to one row per token, looked up in the
buckets they touch, and added there; the counts per day grow by the same rows. State, counts and
the high-water block change in one step, so a fold that breaks off is done again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import metrics
from fleetledger.operators.ordering import first_per_key
from fleetledger.session import pin
from fleetledger.sources.store import BUCKET, Snapshot, Store, bucket_count, bucket_of, touched

STATE, PER_DAY, BLOCK = "state", "per_day", "block"


def last_block(spark: SparkSession, path: str) -> int:
    """The last block in the state; -1 before the first."""
    return int(Store(spark, path).snapshot().facts.get(BLOCK, -1))


def fold(spark: SparkSession, path: str, events: DataFrame) -> Snapshot:
    """Take in (block, seq, token_id, to, ...) rows of blocks after the last one; blocks must be complete."""
    store = Store(spark, path)
    now = store.snapshot()
    newer = pin(events.where(F.col("block") > int(now.facts.get(BLOCK, -1))).select(*schemas.ROUTE_STATE.names))
    top = newer.agg(F.max("block")).first()[0]
    if top is None:
        return now
    buckets = int(now.facts.get(BUCKET) or bucket_count(newer))
    first = first_per_key(newer, "token_id", ["block", "seq"])
    known = store.read(STATE, schemas.ROUTE_STATE, touched(newer, "token_id", buckets), now).select(F.col("token_id").alias("_known"))
    fresh = pin(first.join(known, F.col("token_id").eqNullSafe(F.col("_known")), "left_anti"))
    change = {}
    for table, rows, by in ((STATE, fresh, {BUCKET: bucket_of("token_id", buckets)}), (PER_DAY, metrics.routes_per_day(fresh), {})):
        version, parts = store.write(table, rows, by)
        have = now.parts.get(table, {})
        change[table] = {p: {**have.get(p, {}), version: version} for p in parts}
    return store.commit(change, now, facts={BUCKET: buckets, BLOCK: top})


def state(spark: SparkSession, path: str) -> DataFrame:
    return Store(spark, path).read(STATE, schemas.ROUTE_STATE)


def routes_per_day(spark: SparkSession, path: str) -> DataFrame:
    """Recorded routes per day, from the sums of the folds."""
    return Store(spark, path).read(PER_DAY, schemas.ROUTES_PER_DAY).groupBy("date").agg(F.sum("routes").alias("routes"))


def compact(spark: SparkSession, path: str, pieces: int = 8) -> None:
    store = Store(spark, path)
    buckets = store.snapshot().facts.get(BUCKET)
    if buckets:
        store.compact(STATE, schemas.ROUTE_STATE, {BUCKET: bucket_of("token_id", int(buckets))}, pieces)
        store.compact(PER_DAY, schemas.ROUTES_PER_DAY, {}, pieces)
