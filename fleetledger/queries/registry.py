"""Every operator as a query over whole benchmark tables.

Dates are shown as text and nested values flattened, so that results compare
across engines.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetledger import schemas
from fleetledger.functions import scalars
from fleetledger.operators import credits, devices, ids, ledger, logs, metrics, routes
from fleetledger.params import ParamSet, Range, SourceParams
from fleetledger.plans import credit_pipeline, delivery_extract, device_sync, publication, route_pipeline
from fleetledger.session import pin, scratch
from fleetledger.sources import readers, writers
from fleetledger.streaming import incremental
from fleetledger.sources.fixtures import DISTANCE, DURATION, MAX_PER_HOUR, PROTOTYPE_ADDRESS, SPLIT, Fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "2024-01-15"
BUDGET = 900
FIRST_NONCE = 5_000


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Fixtures(spark, folder))
    return build


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _scratch(fx: Fixtures, name: str) -> str:
    return scratch(fx.spark, name)


def _timed(fx: Fixtures) -> DataFrame:
    return routes.parse_times(fx.routes_raw())


def _counted(fx: Fixtures) -> DataFrame:
    """Filtered, capped trips with their segment count, stage by stage."""
    df = routes.filter_distance(_timed(fx), DISTANCE.min, DISTANCE.max)
    df = routes.filter_duration(df, DURATION.min, DURATION.max)
    df = routes.cap_distance(df, MAX_PER_HOUR)
    return routes.count_segments(df, SPLIT.max_distance, SPLIT.avg_distance)


def _device_map(fx: Fixtures) -> DataFrame:
    return device_sync.sync(fx.contacts())[0]  # raises where a device is claimed twice


def _final(fx: Fixtures, base: int = ids.FIRST_BASE) -> DataFrame:
    return route_pipeline.process(
        fx.routes_raw(), fx.params(), _device_map(fx), fx.known_unassigned(), fx.prototypes(), base=base).final


def _credits(fx: Fixtures) -> DataFrame:
    return credits.flatten_credits(fx.credits_raw(), "staging")


def _totals(fx: Fixtures) -> DataFrame:
    return credits.issued_totals(_credits(fx))


def _payments(fx: Fixtures) -> DataFrame:
    return credits.flatten_payments(fx.payments_raw(), "staging")


# --- routes -----------------------------------------------------------------


@query
def daily_driver_metrics(fx: Fixtures) -> DataFrame:
    params = fx.params()
    trips = route_pipeline.segment(route_pipeline.clean(fx.routes_raw(), params).trips, params)
    owned = devices.attach(trips, _device_map(fx))
    finished = routes.format_output(
        owned, [(routes.START, "timestampstart"), (routes.END, "timestampend"), (routes.DISTANCE, "measureddistance")],
        "unix", ["date"])
    return _text(metrics.daily_driver(finished), "date")


@query
def route_parse_duration(fx: Fixtures) -> DataFrame:
    return _timed(fx).select(
        "k_ruta", F.unix_seconds(routes.START).alias("start_s"), F.unix_seconds(routes.END).alias("end_s"),
        scalars.duration_minutes(routes.START, routes.END).alias("minutes"))


@query
def route_distance_filter(fx: Fixtures) -> DataFrame:
    return routes.filter_distance(fx.routes_raw(), 147, 20_000).select("k_ruta", "f_distancia")


@query
def route_duration_filter(fx: Fixtures) -> DataFrame:
    return routes.filter_duration(_timed(fx), 2, 90).select("k_ruta", "durationMinutes")


@query
def route_reference_filter(fx: Fixtures) -> DataFrame:
    return routes.filter_reference(fx.routes_raw()).select("k_ruta", "Referencia")


@query
def route_distance_cap(fx: Fixtures) -> DataFrame:
    return routes.cap_distance(_timed(fx), MAX_PER_HOUR).select("k_ruta", "f_distancia", "maxExpectedDistance")


@query
def route_segment_count(fx: Fixtures) -> DataFrame:
    return routes.count_segments(fx.routes_raw(), SPLIT.max_distance, SPLIT.avg_distance).select("k_ruta", "segments")


@query
def route_split_summary(fx: Fixtures) -> DataFrame:
    return _text(routes.split_summary(_counted(fx), "date", "source"), "date")


@query
def route_split(fx: Fixtures) -> DataFrame:
    return routes.split(_counted(fx)).select(
        "k_ruta", "segment", F.unix_micros(routes.START).alias("start_us"), F.unix_micros(routes.END).alias("end_us"),
        "f_distancia")


@query
def route_over_long_segments(fx: Fixtures) -> DataFrame:
    return routes.over_long_segments(routes.split(_counted(fx)), SPLIT.max_distance)


@query
def route_ids(fx: Fixtures) -> DataFrame:
    return ids.assign(routes.split(_counted(fx))).select("newID", "k_ruta", "segment")


@query
def route_ids_stable(fx: Fixtures) -> DataFrame:
    """A rerun where motorbike trips already have ids: they keep them, bicycle trips get the next."""
    cut = routes.split(_counted(fx)).withColumn("params_version", fx.params().version())
    none = fx.spark.createDataFrame([], schemas.ID_ASSIGNMENTS)
    _, first = ids.assign_stable(cut.where("source = 'motorbike'"), none)
    return ids.assign_stable(cut, first)[0].select("newID", "source", "k_ruta", "segment")


@query
def route_ids_two_days(fx: Fixtures) -> DataFrame:
    """Two runs that share the marks: trips up to a day, then the later ones; no id is given twice."""
    cut = routes.split(_counted(fx)).withColumn("params_version", fx.params().version())
    marks, none = _scratch(fx, "marks"), fx.spark.createDataFrame([], schemas.ID_ASSIGNMENTS)
    runs = []
    for name, day in (("first", "<="), ("second", ">")):
        base = lambda count, name=name: ids.reserve(fx.spark, marks, name, count)
        runs.append(ids.assign_stable(cut.where(f"date {day} date'{DAY}'"), none, base=base)[0])
    return runs[0].unionByName(runs[1]).select("newID", "source", "k_ruta", "segment")


@query
def route_accounting(fx: Fixtures) -> DataFrame:
    """Per date and source: trips that came in, were kept, were set aside, and failed a range. None is missing."""
    params = ParamSet([SourceParams("motorbike", distance=DISTANCE, duration=DURATION)])
    cleaned = route_pipeline.clean(fx.routes_raw(), params)
    parts = [(fx.routes_raw(), "came_in"), (cleaned.trips, "kept"), (cleaned.quarantine, "set_aside")]
    names = [name for _, name in parts]
    every = None
    for df, name in parts:
        part = df.select("date", "source", *[F.lit(int(n == name)).alias(n) for n in names])
        every = part if every is None else every.unionByName(part)
    counted = every.groupBy("date", "source").agg(*[F.sum(n).alias(n) for n in names])
    return _text(counted.withColumn("out_of_range", F.expr("came_in - kept - set_aside")), "date")


@query
def route_gps_points(fx: Fixtures) -> DataFrame:
    return routes.gps_points(fx.routes_raw()).select(
        "k_ruta", F.col("startLocation.lng").alias("start_lng"), F.col("startLocation.lat").alias("start_lat"),
        F.col("endLocation.lng").alias("end_lng"), F.col("endLocation.lat").alias("end_lat"))


@query
def routes_formatted(fx: Fixtures) -> DataFrame:
    owned = devices.attach(_counted(fx), _device_map(fx))
    rename = [("k_ruta", "routeID"), *SourceParams("any").column_rename_map]

    def shown(fmt: str) -> DataFrame:
        return _text(routes.format_output(owned, rename, fmt), "timestampStart", "timestampEnd").withColumn(
            "format", F.lit(fmt))

    return shown("unix").unionByName(shown("%Y-%m-%d %H:%M"))


@query
def routes_on_date(fx: Fixtures) -> DataFrame:
    return _text(readers.on_date(fx.routes_raw(), DAY).select("k_ruta", "k_dispositivo", "source", "date"), "date")


@query
def routes_final(fx: Fixtures) -> DataFrame:
    return _text(_final(fx), "date")


@query
def routes_two_sources(fx: Fixtures) -> DataFrame:
    """Own parameters per source: bicycles have other bounds, no cap and no split."""
    params = ParamSet([
        SourceParams("motorbike", output_datetime_format="unix", distance=DISTANCE, duration=DURATION,
                     max_per_hour=MAX_PER_HOUR, split=SPLIT),
        SourceParams("bicycle", output_datetime_format="unix", distance=Range(0, 30_000), duration=Range(1),
                     prototype_address=PROTOTYPE_ADDRESS)])
    run = route_pipeline.process(
        fx.routes_raw(), params, _device_map(fx), fx.known_unassigned(), fx.prototypes())
    return _text(run.final, "date")


@query
def routes_no_split(fx: Fixtures) -> DataFrame:
    """No optional stage at all: every trip passes as it is."""
    params = ParamSet([SourceParams(s, output_datetime_format="unix") for s in ("motorbike", "bicycle")])
    return _text(route_pipeline.process(fx.routes_raw(), params, _device_map(fx)).final, "date")


@query
def route_quarantine(fx: Fixtures) -> DataFrame:
    """Rows set aside when only one source has parameters, and its time format does not fit all rows."""
    params = ParamSet([SourceParams("motorbike", input_datetime_format="%Y-%m-%d 0%H:%M:%S")])
    return route_pipeline.clean(fx.routes_raw(), params).quarantine.select("k_ruta", "source", "reason")


@query
def delivery_extract_rows(fx: Fixtures) -> DataFrame:
    columns = delivery_extract.ExportColumns(
        routes.START, routes.END, routes.DISTANCE, "Referencia", ("lng_inicial", "lat_inicial"),
        ("lng_final", "lat_final"),
        (("k_ruta", "routeID"), (routes.DEVICE, "gpsID"), (routes.START, "timestampStart"), (routes.END, "timestampEnd"),
         (routes.DISTANCE, "measuredDistance"), ("durationMinutes", "durationMinutes")))
    return delivery_extract.extract(fx.routes_raw(), columns, "%Y-%m-%d %H:%M:%S")


# --- devices ----------------------------------------------------------------


@query
def device_address_map(fx: Fixtures) -> DataFrame:
    return device_sync.sync(fx.contacts())[0]


@query
def device_contact_updates(fx: Fixtures) -> DataFrame:
    """The contact table after the map job wrote derived addresses back."""
    return device_sync.sync(fx.contacts())[1].select("id", F.col("fields.celo_address").alias("celo_address"))


@query
def device_conflicts(fx: Fixtures) -> DataFrame:
    """Contacts without address registered a second time: their devices are claimed twice."""
    again = fx.contacts().where("fields.celo_address is null")
    return devices.build_map(fx.contacts().unionByName(again))[2]


@query
def route_addresses(fx: Fixtures) -> DataFrame:
    return devices.attach(fx.routes_raw(), _device_map(fx)).select("k_ruta", "k_dispositivo", "celo_address")


@query
def route_prototype_override(fx: Fixtures) -> DataFrame:
    owned = devices.attach(fx.routes_raw(), _device_map(fx))
    return devices.override(owned, fx.prototypes(), PROTOTYPE_ADDRESS).select("k_ruta", "k_dispositivo", "celo_address")


@query
def unassigned_devices(fx: Fixtures) -> DataFrame:
    """Devices without address: those on the known list, and those to alert on."""
    owned = devices.attach(fx.routes_raw(), _device_map(fx))
    known = devices.known_unassigned(owned, fx.known_unassigned())
    return known.withColumn("kind", F.lit("known")).unionByName(
        devices.unassigned(owned, known).withColumn("kind", F.lit("alert")))


@query
def routes_assigned_only(fx: Fixtures) -> DataFrame:
    owned = devices.attach(fx.routes_raw(), _device_map(fx))
    known = devices.known_unassigned(owned, fx.known_unassigned())
    return devices.drop_devices(owned, known).select("k_ruta", "k_dispositivo", "celo_address")


@query
def device_alert(fx: Fixtures) -> DataFrame:
    params = fx.params()
    table = devices.device_table(_device_map(fx), fx.prototypes(), fx.known_unassigned())
    trips = route_pipeline.clean(fx.routes_raw(), params).trips
    return _text(route_pipeline.alerts(trips, params, table), "date")


# --- publication ledger -------------------------------------------------------


@query
def routes_pending(fx: Fixtures) -> DataFrame:
    """Finished routes not in the ledger, whether each can be sent or lacks an address."""
    final = _final(fx, base=0)
    waiting = ledger.pending(final, fx.ledger().withColumnRenamed("route_id", "routeid"), "routeid")
    marked = ledger.held_back(waiting).withColumn("held", F.col("held").cast("int"))
    return _text(marked.select("routeid", "gpsid", "celo_address", "date", "held"), "date")


@query
def attempt_status(fx: Fixtures) -> DataFrame:
    both = ledger.classify(fx.attempts()).withColumn("payment_status", scalars.payment_status("message"))
    return both.select("seq", "status", "payment_status")


def _run(fx: Fixtures) -> publication.PublicationRun:
    return publication.reconcile(fx.attempts(), fx.ledger(), fx.attempts(), "staging")


@query
def publish_prefix(fx: Fixtures) -> DataFrame:
    return _text(_run(fx).completed.select("date", "seq", "route_id", "status"), "date")


@query
def ledger_merge(fx: Fixtures) -> DataFrame:
    columns = ("environment", "date", "route_id", "status", "nonce", "gas_price", "tx_hash")
    return _text(_run(fx).ledger.select(*columns), "date", "nonce", "gas_price")


@query
def publish_outcome(fx: Fixtures) -> DataFrame:
    return _text(_run(fx).outcome.withColumn("all_success", F.col("all_success").cast("int")), "date")


@query
def publish_budget(fx: Fixtures) -> DataFrame:
    waiting = ledger.pending(fx.attempts(), fx.ledger())
    return _text(ledger.within_budget(waiting, BUDGET).select("date", "seq", "route_id", "spent"), "date")


@query
def publish_nonces(fx: Fixtures) -> DataFrame:
    sent = _run(fx).completed.where("status = 'sent'")
    return _text(ledger.assign_nonces(sent, FIRST_NONCE).select("date", "seq", "route_id", "nonce"), "date")


@query
def ledger_first_write(fx: Fixtures) -> DataFrame:
    return ledger.first_write(fx.route_events()).withColumnRenamed("to", "owner")


@query
def routes_per_day(fx: Fixtures) -> DataFrame:
    return _text(metrics.routes_per_day(ledger.first_write(fx.route_events())), "date")


# --- credits and payments -----------------------------------------------------


@query
def credits_pending(fx: Fixtures) -> DataFrame:
    return credits.unpublished(_credits(fx)).select(
        "id", "credit_id", "client_record_id", "principal", "total_repayment", "own_address")


@query
def credit_terms(fx: Fixtures) -> DataFrame:
    return _credits(fx).select("credit_id", "term_days")


@query
def credit_dates(fx: Fixtures) -> DataFrame:
    return _credits(fx).select("credit_id", "issuance_date")


@query
def credit_addresses(fx: Fixtures) -> DataFrame:
    resolved = credits.resolve_addresses(_credits(fx), fx.contacts())[0]
    return resolved.selectExpr("credit_id", "client_record_id", "client_id", "address", "int(is_derived) as is_derived")


@query
def contact_updates(fx: Fixtures) -> DataFrame:
    """The contact table after the credit job wrote derived addresses back."""
    run = credit_pipeline.publish_credits(fx.credits_raw(), fx.contacts(), "staging")
    return run.contacts.select("id", F.col("fields.celo_address").alias("celo_address"))


@query
def credit_flags(fx: Fixtures) -> DataFrame:
    """The credit records after the issued ones were flagged."""
    run = credit_pipeline.publish_credits(fx.credits_raw(), fx.contacts(), "staging")
    return run.records.select("id", F.col("fields.published_staging").cast("int").alias("published"))


@query
def credit_run_outcome(fx: Fixtures) -> DataFrame:
    """A credit run that met an error: what was issued before it, and the run's outcome."""
    attempts = _credits(fx).where("not is_published").selectExpr(
        "credit_id as seq", "credit_id", "case when credit_id % 1009 = 1000 then 'nonce too low' when credit_id % 7 = 0 "
        f"then 'execution reverted: {scalars.ALREADY_MINTED}' else 'ok' end as message")
    run = credit_pipeline.publish_credits(fx.credits_raw(), fx.contacts(), "staging", attempts=attempts)
    flagged = run.records.agg(F.count_if("fields.published_staging").alias("flagged"))
    state = run.state.agg(F.count("*").alias("issued"), F.sum("outstanding").alias("outstanding"))
    one = F.lit(1).alias("one")
    joined = run.outcome.withColumn("all_success", F.col("all_success").cast("int")).select("*", one)
    return joined.join(flagged.select("*", one), "one").join(state.select("*", one), "one").drop("one")


@query
def credits_state(fx: Fixtures) -> DataFrame:
    resolved = credits.resolve_addresses(_credits(fx), fx.contacts())[0]
    return credits.issue(resolved)


@query
def payments_pending(fx: Fixtures) -> DataFrame:
    return credits.payments_pending(_payments(fx), _credits(fx)).select(
        "id", "payment_id", "credit_id", "amount", "payment_date")


@query
def payment_dedup(fx: Fixtures) -> DataFrame:
    return credits.dedup_payments(_payments(fx))


@query
def payment_balances(fx: Fixtures) -> DataFrame:
    return credits.apply_payments(_totals(fx), _payments(fx))


@query
def payment_outcomes(fx: Fixtures) -> DataFrame:
    return credits.payment_outcomes(_totals(fx), _payments(fx))


@query
def payment_run_outcome(fx: Fixtures) -> DataFrame:
    """Outcomes of one run: unpublished payments of published credits."""
    run = credit_pipeline.publish_payments(fx.payments_raw(), fx.credits_raw(), "staging")
    return run.outcomes.groupBy("outcome").agg(
        F.sum("records").alias("records"), F.sum("applied").alias("applied"))


@query
def payment_run_total(fx: Fixtures) -> DataFrame:
    """The same run in one row: payments, recorded ones, and whether that is all."""
    run = credit_pipeline.publish_payments(fx.payments_raw(), fx.credits_raw(), "staging")
    total = metrics.run_outcome(run.outcomes, "outcome <> 'error'", "records")
    return total.withColumn("all_success", F.col("all_success").cast("int"))


@query
def payment_later_run(fx: Fixtures) -> DataFrame:
    """A run after the flagged payments were recorded: their ids are taken and their amounts no longer owed."""
    earlier = _payments(fx).where("is_published")
    recorded = pin(credits.payment_outcomes(_totals(fx), earlier))
    run = credit_pipeline.publish_payments(fx.payments_raw(), fx.credits_raw(), "staging", recorded=recorded)
    return run.outcomes.select("id", "payment_id", "outcome", "applied", "records")


@query
def credit_outstanding(fx: Fixtures) -> DataFrame:
    state = _totals(fx)
    return credits.outstanding(state, credits.apply_payments(state, _payments(fx)))


# --- logs, sources and sinks --------------------------------------------------


@query
def publish_log_stats(fx: Fixtures) -> DataFrame:
    return logs.publish_stats(fx.publish_log())


@query
def publish_log_dates(fx: Fixtures) -> DataFrame:
    return logs.with_dates(fx.publish_log()).select("stream", "line_no", "date")


@query
def publish_log_files(fx: Fixtures) -> DataFrame:
    """The same statistics from delimited log files that hold many streams each."""
    path = _scratch(fx, "log")
    lines = fx.publish_log().repartitionByRange("stream").sortWithinPartitions("stream", "line_no")
    writers.write_table(lines.selectExpr("concat('EVENTS|1|2024|', stream, '|0|', line) as value"), path, "text")
    return logs.publish_stats(readers.read_log_lines(fx.spark, path, stream_field=4))


@query
def log_multi_file(fx: Fixtures) -> DataFrame:
    """The same where every stream goes on over several files, in the order of their names."""
    path = _scratch(fx, "logs")
    lines = fx.publish_log().selectExpr("concat('EVENTS|1|2024|', stream, '|0|', line) as value", "stream", "line_no")
    for part, where in enumerate(("line_no < 30", "line_no between 30 and 60", "line_no > 60")):
        ordered = lines.where(where).repartitionByRange("stream", "line_no").sortWithinPartitions("stream", "line_no")
        ordered.select("value").write.text(f"{path}/part={part}")
    return logs.publish_stats(readers.read_log_lines(fx.spark, path, stream_field=4))


@query
def log_time_range(fx: Fixtures) -> DataFrame:
    """Lines of a time range, from log files in which some lines have no readable time."""
    path = _scratch(fx, "log")
    at = "case when line_no % 10 = 3 then 'soon' else date_format(timestamp_seconds(1704067200 + stream * 3600 + line_no), 'yyyy-MM-dd HH:mm:ss') end"
    timed = fx.publish_log().selectExpr(f"concat({at}, '|', stream, '|', line_no, ' ', line) as value")
    writers.write_table(timed, path, "text")
    found = readers.read_log_lines(fx.spark, path, field=3, stream_field=2, start="2024-01-01 02:00:00", end="2024-01-02 00:00:50", time_field=1)
    return found.select("stream", "line")


@query
def routes_csv_scan(fx: Fixtures) -> DataFrame:
    """One raw CSV file per source, read by its header."""
    path = _scratch(fx, "csv")
    fields = [f for f in schemas.ROUTES_RAW.fields if f.name not in ("date", "source")]
    writers.write_table(fx.routes_raw().select(*[f.name for f in fields]), path, "csv")
    return readers.read_csv(fx.spark, path, T.StructType(fields)).select("k_ruta", "k_dispositivo", "o_fecha_inicial", "f_distancia")


@query
def device_map_stored(fx: Fixtures) -> DataFrame:
    """The device map written whole, twice, and read back."""
    path = _scratch(fx, "map")
    for _ in range(2):
        writers.write_table(device_sync.sync(fx.contacts())[0], path)
    return fx.spark.read.schema(schemas.DEVICE_MAP).parquet(path)


@query
def parameter_table(fx: Fixtures) -> DataFrame:
    """Parameters from documents, applied to trips: rows and longest distance that pass, per source."""
    documents = {"motorbike": {"distance_filter": {"min": 147}, "duration_filter": {"min": 2, "max": 90}, "distance_fix": {"expected_max_per_hour": 60000}},
                 "bicycle": {"duration_filter": {"min": 1}}}
    path = _scratch(fx, "params")
    fx.spark.createDataFrame([(json.dumps(documents),)], "value string").coalesce(1).write.text(path)
    stored = readers.read_document(fx.spark, path)
    params = ParamSet([SourceParams.from_document(source, doc) for source, doc in stored.items()])
    trips = route_pipeline.clean(fx.routes_raw(), params).trips
    return trips.groupBy("source").agg(F.count("*").alias("trips"), F.max("f_distancia").alias("longest"))


@query
def count_metrics(fx: Fixtures) -> DataFrame:
    """Counts observed while the trips are written: rows read and rows without a client."""
    path = _scratch(fx, "observed")
    watched, seen = metrics.observed(fx.routes_raw(), "trips", no_client=F.count_if(F.col("Referencia").isNull()))
    writers.write_table(watched, path)
    kept = fx.spark.read.parquet(path).agg(F.count("*").alias("written"))
    return kept.withColumns({name: F.lit(value).cast("bigint") for name, value in sorted(seen.get.items())})


@query
def routes_incremental(fx: Fixtures) -> DataFrame:
    """Newly landed files through the streaming job, each once: routes and their distance per source."""
    landing, output = _scratch(fx, "landing"), _scratch(fx, "stream")
    writers.write_table(fx.routes_raw(), landing)
    incremental.run_available(fx.spark, landing, output, _scratch(fx, "checkpoint"), fx.params(), _device_map(fx),
                              fx.known_unassigned(), fx.prototypes())
    return fx.spark.read.parquet(output).groupBy("source").agg(
        F.count("*").alias("routes"), F.count_distinct("routeid").alias("ids"), F.sum("measureddistance").alias("distance"))


@query
def routes_csv_roundtrip(fx: Fixtures) -> DataFrame:
    """Routes written as date and source partitions of CSV files, one partition twice, and read back."""
    path = _scratch(fx, "routes")
    final = _final(fx)
    writers.write_partitioned(final, path, fmt="csv", non_empty=True, even=False)  # numbered rows are sorted for the write
    writers.write_partitioned(readers.on_date(final, DAY), path, fmt="csv")
    return _text(readers.read_partitioned(fx.spark, path, schemas.ROUTES_FINAL, "csv", every_day=True), "date")


@query
def landing_envelope(fx: Fixtures) -> DataFrame:
    """Raw trips landed as response documents of at most a thousand rows, and unpacked again."""
    path = _scratch(fx, "landing")
    fields = [f.name for f in schemas.ROUTES_RAW.fields if f.name not in ("date", "source")]
    row = F.struct(*[F.col(c) for c in fields])
    numbered = fx.routes_raw().groupBy(F.expr("monotonically_increasing_id() div 1000").alias("document"))
    documents = numbered.agg(F.collect_list(row).alias("body"))
    writers.write_table(documents.select("body"), path, "json")
    record = T.StructType([f for f in schemas.ROUTES_RAW.fields if f.name in fields])
    return readers.land_envelope(fx.spark, path, record)


@query
def ledger_roundtrip(fx: Fixtures) -> DataFrame:
    """The ledger written by environment and date, merged with a run and rewritten."""
    path = _scratch(fx, "ledger")
    first = readers.read_ledger(fx.spark, path, "staging", every_day=True)
    writers.write_ledger(first.unionByName(fx.ledger(), allowMissingColumns=True), path)
    stored = readers.read_ledger(fx.spark, path, "staging", every_day=True)
    merged = publication.reconcile(fx.attempts(), stored, fx.attempts(), "staging").ledger
    writers.write_ledger(merged, path)
    back = readers.read_ledger(fx.spark, path, "staging", every_day=True)
    columns = ("environment", "date", "route_id", "status", "nonce", "gas_price", "tx_hash")
    return _text(back.select(*columns), "date", "nonce", "gas_price")


@query
def record_scan(fx: Fixtures) -> DataFrame:
    """Exported credit records read with a field list and a formula."""
    path = _scratch(fx, "credits")
    writers.write_table(fx.credits_raw(), path, "json")
    return readers.read_records(
        fx.spark, path, schemas.CREDITS_RAW, ["credit_id", "term_text"],
        "not coalesce(fields.published_staging, false)").select("id", "fields.*")


@query
def event_scan(fx: Fixtures) -> DataFrame:
    """Recorded routes read from an event log by name and block range, counted per day."""
    path = _scratch(fx, "events")
    log = fx.route_events().select(
        F.lit("RouteRecorded").alias("event"), F.expr("seq div 10").alias("block"), "seq",
        F.struct("to", "token_id", "timestamp_start", "timestamp_end", "distance").alias("args"))
    writers.write_table(log, path)
    found = readers.read_events(fx.spark, path, "RouteRecorded", from_block=0)
    return _text(metrics.routes_per_day(found), "date")
