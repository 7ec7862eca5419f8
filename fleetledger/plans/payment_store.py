"""Balances, taken payment ids and outcomes as one store, folded run by run.

A run reads the pending payments, the buckets of taken ids that these touch, and the buckets of
balances of their credits. It writes those buckets and its outcomes, and shows all three in
one step, so a run that breaks off has no effect and a run that is repeated finds its records
recorded. Nothing reads the history of outcomes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import credits as ops
from fleetledger.session import pin
from fleetledger.sources.store import BUCKET, CODEC, Snapshot, Store, bucket_count, bucket_of, touched

BALANCES, TAKEN, OUTCOMES = "balances", "taken", "outcomes"
RECORD = ("payment_id", "id", "credit_id", "amount", "payment_date")


def is_open(spark: SparkSession, path: str) -> bool:
    return bool(Store(spark, path).snapshot().facts.get(BUCKET))


def open_credits(spark: SparkSession, path: str, issued: DataFrame, buckets: int | None = None) -> Snapshot:
    """Add balances for (credit_id, total_repayment) rows; a credit that has one keeps it."""
    store = Store(spark, path)
    now = store.snapshot()
    issued = pin(issued.select("credit_id", "total_repayment"))
    count = int(now.facts.get(BUCKET) or buckets or bucket_count(issued))
    known = store.read(BALANCES, schemas.BALANCES, touched(issued, "credit_id", count), now)
    fresh = issued if known.isEmpty() else issued.join(known.select("credit_id"), "credit_id", "left_anti")
    fresh = fresh.withColumn("paid", F.lit(0).cast("bigint"))
    version, parts = store.write(BALANCES, fresh, {BUCKET: bucket_of("credit_id", count)})
    have = now.parts.get(BALANCES, {})
    return store.commit({BALANCES: {p: {**have.get(p, {}), version: version} for p in parts}}, now, facts={BUCKET: count})


def payable(spark: SparkSession, path: str, payments: DataFrame) -> DataFrame:
    """The payments whose credit has a balance."""
    store = Store(spark, path)
    now = store.snapshot()
    parts = touched(payments, "credit_id", int(now.facts[BUCKET]))
    return payments.join(store.read(BALANCES, schemas.BALANCES, parts, now).select("credit_id"), "credit_id", "left_semi")


def record(spark: SparkSession, path: str, pending: DataFrame, run: str | None = None) -> DataFrame:
    """Record payments (id, payment_id, credit_id, amount, payment_date); returns this run's outcomes.

    A record that an earlier run has recorded is left out; another record of a taken id is a duplicate.
    Runs must follow the payments' order, as a balance is lowered in the order of recording.
    """
    store = Store(spark, path)
    now = store.snapshot()
    buckets = int(now.facts[BUCKET])
    pending = pin(pending.select(*RECORD), CODEC)
    valid = ops.acceptable(pending)
    taken = store.read(TAKEN, schemas.TAKEN, touched(valid, "payment_id", buckets), now)
    # Only records whose id another has, here or in an earlier run, are compared with others.
    shared = ops.shared_ids(valid, taken)
    several = shared.count()
    alone, together = ops.split_by(valid, shared, several)
    repeated = None
    if together is not None:
        # Of a taken record only a digest is moved; records of one digest are then compared in full.
        taken, digest = ops.of_ids(taken, shared, several), F.xxhash64(*RECORD)
        met = pin(together.join(taken.select("payment_id", digest.alias("_taken")), "payment_id", "left"), CODEC)
        together, known = met.where("_taken is null").drop("_taken"), met.where("_taken is not null")
        repeated, alike = known.where(F.col("_taken") != digest), known.where(F.col("_taken") == digest)
        if not alike.isEmpty():
            full = taken.select("payment_id", F.struct(*RECORD).alias("_full"))
            repeated = repeated.unionByName(
                alike.join(full, "payment_id").where(F.col("_full") != F.struct(*RECORD)).drop("_full"))
        repeated = repeated.drop("_taken")
    balances = store.read(BALANCES, schemas.BALANCES, touched(valid, "credit_id", buckets), now)
    state = balances.selectExpr("credit_id", "total_repayment - paid as total_repayment")
    found = ops.recorded_outcomes(state, alone, together)
    if repeated is not None:
        found = found.unionByName(ops.repeated_outcomes(repeated))
    # Written once: what follows reads the outcomes where they stay.
    run = run or uuid.uuid4().hex
    version, parts = store.write(OUTCOMES, found)
    have = now.parts.get(OUTCOMES, {})
    change = {OUTCOMES: {p: {**have.get(p, {}), run: version} for p in parts}}
    recorded = store.written(OUTCOMES, schemas.PAYMENT_OUTCOMES, version)
    outcomes = recorded.unionByName(pin(ops.unrecordable(pending)))

    accepted = recorded.where("outcome in ('applied_full', 'clamped')")
    paying = touched(accepted, "credit_id", buckets)
    paid = accepted.groupBy("credit_id").agg(F.sum("applied").alias("_paid"))
    after = _paid_off(store.read(BALANCES, schemas.BALANCES, paying, now), paid, buckets)
    version, parts = store.write(BALANCES, after, {BUCKET: BUCKET}, even=False, leave=[BUCKET])
    change[BALANCES] = {p: {version: version} for p in parts}
    version, parts = store.write(TAKEN, accepted.select(*RECORD), {BUCKET: bucket_of("payment_id", buckets)})
    have = now.parts.get(TAKEN, {})
    change[TAKEN] = {p: {**have.get(p, {}), version: version} for p in parts}
    store.commit(change, now)
    return outcomes


def _paid_off(balances: DataFrame, paid: DataFrame, buckets: int) -> DataFrame:
    """The balances after payments (credit_id, _paid), each moved once, to the task that writes its bucket."""
    own = F.col("_paid").isNull()
    every = balances.withColumn("_paid", F.lit(None).cast("bigint")).unionByName(paid, allowMissingColumns=True)
    dealt = every.withColumn(BUCKET, bucket_of("credit_id", buckets)).repartition(buckets, BUCKET)
    now = F.sum("_paid").over(Window.partitionBy(BUCKET, "credit_id"))
    return dealt.withColumn("_now", now).where(own).selectExpr(
        "credit_id", "total_repayment", "paid + coalesce(_now, 0) as paid", BUCKET)


def compact(spark: SparkSession, path: str, pieces: int = 8) -> None:
    """Write buckets of many small pieces anew."""
    store = Store(spark, path)
    buckets = int(store.snapshot().facts[BUCKET])
    for table, schema, key in ((BALANCES, schemas.BALANCES, "credit_id"), (TAKEN, schemas.TAKEN, "payment_id")):
        store.compact(table, schema, {BUCKET: bucket_of(key, buckets)}, pieces)


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Everything that was recorded."""
    return Store(spark, path).read(OUTCOMES, schemas.PAYMENT_OUTCOMES)


def balances(spark: SparkSession, path: str) -> DataFrame:
    """What each credit owed, and has paid."""
    return Store(spark, path).read(BALANCES, schemas.BALANCES)
