"""The daily jobs over stored tables: land, sync devices, process, publish, credits, payments.

The route and ledger jobs read only their day (yesterday unless named, worked out once
per job). Device map, records and states are stores (``sources.store``): changed in one step, so a
run that breaks off leaves them whole, and bucket by bucket, so a run writes what it touches.
Any job can be run again at any time: a day's routes, reports and ledger entries are replaced; states
only grow, by items not yet in them, and record flags are written last, so a run that broke
off is completed by the next one. With ``counts_path`` a job keeps what its steps counted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetledger import schemas
from fleetledger.functions import scalars
from fleetledger.operators import credits as credit_ops
from fleetledger.operators import ids, ledger, metrics
from fleetledger.params import ROUTES_TABLE_FORMAT, ParamSet
from fleetledger.plans import credit_pipeline, device_sync, payment_store, publication, route_pipeline
from fleetledger.session import configure, estimated_bytes, job, pin
from fleetledger.sources import readers, store, writers
from fleetledger.sources.readers import Day
from fleetledger.sources.store import BUCKET, RECORDS, Store, bucket_count, bucket_of, touched


class Incomplete(RuntimeError):
    """Not everything was published; run the job again."""


def land(spark: SparkSession, documents: str, raw_root: str, source: str, day: Day = None,
         bad_root: str | None = None, counts_path: str | None = None) -> None:
    """Unpack one source's response documents into its raw partition. No rows raises.

    With ``bad_root``, documents that can't be read are kept there by day and source instead of ending the job.
    """
    configure(spark)
    day = readers.day_text(day)
    record = T.StructType([f for f in schemas.ROUTES_RAW.fields if f.name not in ("date", "source")])
    counts = metrics.JobCounts("land", f"date={day},source={source}")
    if bad_root is None:
        rows = readers.land_envelope(spark, documents, record)
    else:
        rows, bad = readers.land_envelope_or_quarantine(spark, documents, record)
        bad = counts.watch(bad, "bad_documents")
        bad.write.mode("overwrite").parquet(f"{bad_root.rstrip('/')}/date={day}/source={source}")
    rows = rows.withColumns({"date": F.lit(day).cast("date"), "source": F.lit(source)})
    writers.require_non_empty(rows)
    writers.write_partitioned(counts.watch(rows, "rows"), raw_root)
    if counts_path:
        counts.store(spark, counts_path)


def sync_devices(spark: SparkSession, contacts_path: str, map_path: str,
                 derive: credit_ops.Derive = scalars.placeholder_address, counts_path: str | None = None) -> None:
    """Rebuild the device map and write derived addresses back to the contacts that get one."""
    configure(spark)
    contacts = store.read_table(spark, contacts_path, schemas.CONTACTS)
    configure(spark, estimated_bytes(contacts))
    counts = metrics.JobCounts("sync_devices", uuid.uuid4().hex)
    with job(spark):
        device_map, updates = device_sync.changes(contacts, derive)
        updates = pin(counts.watch(updates, "derived_addresses"))
        store.replace_table(counts.watch(device_map, "devices"), map_path)
        store.update_records(spark, contacts_path, schemas.CONTACTS, updates, ["celo_address"])
        if counts_path:
            counts.store(spark, counts_path)


def process(spark: SparkSession, raw_root: str, routes_root: str, params: ParamSet, map_path: str, assignments_path: str,
            known_path: str | None = None, prototypes_path: str | None = None, marks_path: str | None = None,
            reports_root: str | None = None, day: Day = None, base: int = ids.FIRST_BASE,
            strict: bool = False, counts_path: str | None = None) -> route_pipeline.RouteRun:
    """Clean, split, number and attribute one day of all sources and replace that day's routes.

    ``assignments_path`` has the ids given so far by day, ``marks_path`` the ids of every
    run, which a streaming job can share. What is not in the routes is in the day's
    reports: quarantine (unless strict, which raises), devices to alert on, split summary.
    Returns the stored results.
    """
    configure(spark)
    day = readers.day_text(day)
    if any(p.output_datetime_format != ROUTES_TABLE_FORMAT for p in params.params):
        raise ValueError("the routes table holds seconds; other time formats are for extracts")
    assignments_path, marks = assignments_path.rstrip("/"), marks_path or f"{assignments_path.rstrip('/')}_marks"
    reports = reports_root or f"{routes_root.rstrip('/')}_reports"
    counts = metrics.JobCounts("process", f"date={day}")

    def device_list(path: str | None) -> DataFrame | None:
        return None if path is None else readers.read_or_empty(spark, path, schemas.DEVICE_LIST)

    raw = readers.read_partitioned(spark, raw_root, schemas.ROUTES_RAW, day=day)
    configure(spark, estimated_bytes(raw))
    given = readers.read_or_empty(spark, f"{assignments_path}/date={day}", schemas.ID_ASSIGNMENTS, root=assignments_path)
    with job(spark):
        run = route_pipeline.process(
            raw, params, store.read_table(spark, map_path, schemas.DEVICE_MAP), device_list(known_path),
            device_list(prototypes_path), strict=strict, assignments=given,
            base=lambda count: ids.reserve(spark, marks, f"{routes_root} {day} {uuid.uuid4().hex}", count, base),
            screen=lambda trips: counts.watch(trips, "trips", segments=F.sum("segments")))
        # Recorded before use: a run that fails later finds the ids it gave.
        writers.append_table(counts.watch(run.new_assignments, "new_ids"), assignments_path, by=("date", "source"))
        without = F.count_if(F.col("celo_address").isNull())
        writers.write_day(counts.watch(run.final, "routes", without_owner=without), routes_root, day)
        for name, rows in (("quarantine", run.quarantine), ("unowned_devices", run.unowned), ("split_summary", run.summary)):
            writers.write_report(counts.watch(rows, name), reports, name, f"date={day}")
        if counts_path:
            counts.store(spark, counts_path)
    stored = [readers.read_report(spark, reports, name, f"date={day}") for name in ("unowned_devices", "quarantine", "split_summary")]
    return route_pipeline.RouteRun(readers.read_partitioned(spark, routes_root, schemas.ROUTES_FINAL, day=day), *stored, None)


def pending(spark: SparkSession, routes_root: str, ledger_path: str, environment: str,
            day: Day = None) -> tuple[DataFrame, DataFrame]:
    """One day's routes that can be sent, and those held back for want of an address."""
    day = readers.day_text(day)
    routes = readers.read_partitioned(spark, routes_root, schemas.ROUTES_FINAL, day=day)
    done = readers.read_ledger(spark, ledger_path, environment, day).withColumnRenamed("route_id", "routeid")
    return ledger.publishable(ledger.pending(routes, done, "routeid"))


def plan(spark: SparkSession, routes_root: str, ledger_path: str, environment: str, next_nonce: int,
         budget: float | None = None, cost: float = 1, day: Day = None) -> DataFrame:
    """The routes of one day that a run sends, within its budget, in order and with their nonces."""
    ready, _ = pending(spark, routes_root, ledger_path, environment, day)
    return publication.plan(ready.withColumn("cost", F.lit(cost)), next_nonce, budget)


def record(spark: SparkSession, routes_root: str, ledger_path: str, environment: str, attempts: DataFrame,
           day: Day = None, events_path: str | None = None, counts_path: str | None = None) -> None:
    """Fold a run's attempts into the ledger, then raise unless the whole day is published.

    Sent routes enter with their nonce, gas price and hash. The ledger is written in
    either case, so the next run resumes behind it. ``events_path`` takes a ``RouteRecorded`` event for
    each route sent, before the ledger: a run that breaks off in between sends some again, and the first stands.
    """
    configure(spark)
    day = readers.day_text(day)
    routes = readers.read_partitioned(spark, routes_root, schemas.ROUTES_FINAL, day=day)
    done = readers.read_ledger(spark, ledger_path, environment, day)
    configure(spark, estimated_bytes(routes))
    run = publication.reconcile(routes, done, readers.on_date(attempts, day), environment)
    counts = metrics.JobCounts("record", f"environment={environment},date={day}")
    with job(spark):
        if events_path:
            sent = writers.by_block(publication.recorded_events(routes, run.completed))
            writers.append_table(counts.watch(sent, "events"), events_path)  # watched behind the ranges, which are sampled
        writers.write_ledger(run.ledger, ledger_path)
    after = readers.read_ledger(spark, ledger_path, environment, day)
    row = ledger.outcome(routes, after).first()  # one day, one row
    if counts_path:
        counts.note("routes", total=row.total if row else 0, published=row.published if row else 0)
        counts.store(spark, counts_path)
    if row is not None and not row.all_success:
        raise Incomplete(f"only {row.published} of {row.total} routes are published")


def publish_credits(spark: SparkSession, credits_path: str, contacts_path: str, state_path: str, env: str,
                    derive: credit_ops.Derive = scalars.placeholder_address, attempts: DataFrame | None = None,
                    balances_path: str | None = None, counts_path: str | None = None) -> None:
    """Issue unpublished credits: state table, contact addresses and record flags.

    Raises unless ``attempts`` (results in order; all done, if none are given) have issued
    every one; those before the first failure are recorded, the others stay pending.
    ``balances_path`` is the payments' store: issued credits get a balance there.
    """
    configure(spark)
    raw = store.read_table(spark, credits_path, schemas.CREDITS_RAW)
    contacts = store.read_table(spark, contacts_path, schemas.CONTACTS)
    configure(spark, estimated_bytes(raw, contacts))
    counts = metrics.JobCounts("publish_credits", uuid.uuid4().hex)
    with job(spark):
        run = credit_pipeline.publish_credits(raw, contacts, env, derive, attempts=attempts)
        row = run.outcome.first()  # one row
        addresses, flags = pin(counts.watch(run.addresses, "derived_addresses")), pin(run.flags)
        issued = pin(counts.watch(run.state, "issued", principal=F.sum("principal")))
        _add_state(spark, state_path, issued)
        if balances_path:
            owed = issued.select("credit_id", F.col("outstanding").alias("total_repayment"))
            payment_store.open_credits(spark, balances_path, owed)
        store.update_records(spark, contacts_path, schemas.CONTACTS, addresses, ["celo_address"])
        store.update_records(spark, credits_path, schemas.CREDITS_RAW, flags, [f"published_{env}"])
        if counts_path:
            counts.note("credits", total=row.total, published=row.published)
            counts.store(spark, counts_path)
    if not row.all_success:
        raise Incomplete(f"only {row.published} of {row.total} credits are published")


def _add_state(spark: SparkSession, path: str, issued: DataFrame) -> None:
    """Add issued credits to the state; an issued id stays as it was. Only the ids' buckets are read."""
    states = Store(spark, path)
    now = states.snapshot()
    buckets = int(now.facts.get(BUCKET) or bucket_count(issued))
    known = states.read(RECORDS, schemas.CREDITS_STATE, touched(issued, "credit_id", buckets), now)
    fresh = issued.join(known.select("credit_id"), "credit_id", "left_anti").select(*schemas.CREDITS_STATE.names)
    version, parts = states.write(RECORDS, fresh, {BUCKET: bucket_of("credit_id", buckets)})
    have = now.parts.get(RECORDS, {})
    states.commit({RECORDS: {p: {**have.get(p, {}), version: version} for p in parts}}, now, facts={BUCKET: buckets})


def publish_payments(spark: SparkSession, payments_path: str, credits_path: str, outcomes_path: str, env: str,
                     counts_path: str | None = None) -> None:
    """Record unpublished payments against what earlier ones left, and flag them.

    ``outcomes_path`` is the payments' store (``plans.payment_store``). On the first run it is opened with the
    published credits; later runs read pending payments and the buckets that these touch, while
    credits are opened as they are issued, or here where the store lacks one.
    Raises when some could not be recorded; the others are, and those stay pending.
    """
    configure(spark)
    raw = store.read_table(spark, payments_path, schemas.PAYMENTS_RAW)
    configure(spark, estimated_bytes(raw))
    counts = metrics.JobCounts("publish_payments", uuid.uuid4().hex)
    with job(spark):
        pending = pin(credit_ops.unpublished(credit_ops.flatten_payments(raw, env)).drop("is_published"))
        _open_published(spark, credits_path, outcomes_path, env, pending)
        due = pin(payment_store.payable(spark, outcomes_path, pending))
        outcomes = payment_store.record(spark, outcomes_path, due)
        row = metrics.run_outcome(outcomes, "outcome <> 'error'", "records").first()
        failed = outcomes.where("outcome = 'error'").select("id").distinct()
        done = due.select("id").distinct().join(failed, "id", "left_anti").withColumn(f"published_{env}", F.lit(True))
        store.update_records(spark, payments_path, schemas.PAYMENTS_RAW, counts.watch(done, "flagged"), [f"published_{env}"])
        if counts_path:
            counts.note("payments", total=row.total, published=row.published)
            counts.store(spark, counts_path)
    if not row.all_success:
        raise Incomplete(f"only {row.published} of {row.total} payments are published")


def _open_published(spark: SparkSession, credits_path: str, outcomes_path: str, env: str, pending: DataFrame) -> None:
    """Balances for published credits that pending payments name and the store lacks; the records are read only if it lacks any."""
    asked = pending.where("credit_id is not null").select("credit_id").distinct()
    if payment_store.is_open(spark, outcomes_path):
        asked = pin(asked.join(payment_store.payable(spark, outcomes_path, asked), "credit_id", "left_anti"))
        if asked.isEmpty():
            return
    credits = credit_ops.flatten_credits(store.read_table(spark, credits_path, schemas.CREDITS_RAW), env)
    # What a credit owes is what its first issue says, published or not; it is open once any issue is.
    named = credits.join(asked, "credit_id", "left_semi")
    issued = named.where("is_published").select("credit_id").distinct()
    payment_store.open_credits(spark, outcomes_path, credit_ops.issued_totals(named).join(issued, "credit_id", "left_semi"))
