"""Queries over kept state: stores that change in one step, and what is folded into them run by run."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetledger import schemas
from fleetledger.operators import devices, metrics, routes
from fleetledger.plans import daily, daily_figures, delivery_extract, payment_store, publication, route_pipeline, route_state
from fleetledger.queries import registry
from fleetledger.queries.oracle import ORACLE, _with
from fleetledger.queries.registry import _device_map, _payments, _scratch, _text, _totals, query
from fleetledger.session import pin
from fleetledger.sources import log_index, readers, store, writers
from fleetledger.sources.fixtures import Fixtures
from fleetledger.streaming import incremental

# A record table of a query has so many buckets.
BUCKETS = 64


@query
def table_replaced(fx: Fixtures) -> DataFrame:
    """A table replaced twice; the second version is read back."""
    path, device_map = _scratch(fx, "replaced"), _device_map(fx)
    store.replace_table(device_map.where("celo_address like '0x0%'"), path)
    store.replace_table(device_map, path)
    return store.read_table(fx.spark, path, schemas.DEVICE_MAP)


@query
def records_updated(fx: Fixtures) -> DataFrame:
    """Contacts after one in a hundred got another address; ``untouched`` tells whether the other buckets kept their files."""
    path = _scratch(fx, "contacts")
    table = store.Store(fx.spark, path)
    rows = fx.contacts()
    before = table.replace(store.RECORDS, rows, {store.BUCKET: store.bucket_of("id", BUCKETS)}, {store.BUCKET: BUCKETS})
    updates = rows.where("fields.client_id % 100 = 7").selectExpr("id", "concat('0xnew', fields.client_id) as celo_address")
    after = store.update_records(fx.spark, path, schemas.CONTACTS, updates, ["celo_address"])
    parts = store.touched(updates, "id", BUCKETS)
    old, new = before.parts[store.RECORDS], after.parts[store.RECORDS]
    same = all(old[p] == new[p] for p in old if p not in parts) and all(old[p] != new[p] for p in parts)
    return table.read(store.RECORDS, schemas.CONTACTS).select(
        "id", F.col("fields.celo_address").alias("celo_address"), F.lit(int(same)).alias("untouched"))


def _paid_in_runs(fx: Fixtures) -> str:
    """All payments recorded in three runs, by the thirds of their dates' span."""
    path, payments = _scratch(fx, "payments"), _payments(fx)
    payment_store.open_credits(fx.spark, path, _totals(fx))
    low, high = payments.agg(F.min("payment_date"), F.max("payment_date")).first()
    cuts = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high + 1]
    for k in range(3):
        run = payments.where(f"payment_date >= {cuts[k]} and payment_date < {cuts[k + 1]}").drop("is_published")
        payment_store.record(fx.spark, path, run, f"run {k}")
    return path


@query
def payment_three_runs(fx: Fixtures) -> DataFrame:
    """Outcomes of three runs in a row; equal to one run over all payments."""
    return payment_store.outcomes(fx.spark, _paid_in_runs(fx))


@query
def credit_balances_kept(fx: Fixtures) -> DataFrame:
    """What the same runs left of each credit, from the stored balances."""
    return payment_store.balances(fx.spark, _paid_in_runs(fx)).withColumn("outstanding", F.expr("total_repayment - paid"))


def _folded(fx: Fixtures) -> str:
    """All route events folded in three increments of blocks."""
    path, log = _scratch(fx, "state"), _scratch(fx, "events")
    events = fx.route_events().select(
        F.lit("RouteRecorded").alias("event"), F.expr("seq div 10").alias("block"), "seq",
        F.struct("to", "token_id", "timestamp_start", "timestamp_end", "distance").alias("args"))
    writers.append_table(writers.by_block(events), log)
    top = events.agg(F.max("block")).first()[0]
    for upto in (top // 3, 2 * top // 3, None):
        newer = readers.read_events(fx.spark, log, "RouteRecorded", route_state.last_block(fx.spark, path) + 1, upto)
        route_state.fold(fx.spark, path, newer)
    return path


@query
def route_state_increments(fx: Fixtures) -> DataFrame:
    """Recorded routes after three folds of newer blocks; equal to the first write over all events."""
    return route_state.state(fx.spark, _folded(fx)).drop("block").withColumnRenamed("to", "owner")


@query
def routes_per_day_increments(fx: Fixtures) -> DataFrame:
    """Recorded routes per day, from the sums that the folds kept."""
    return _text(route_state.routes_per_day(fx.spark, _folded(fx)), "date")


@query
def route_events_emitted(fx: Fixtures) -> DataFrame:
    """The events that a publication run emits for the routes it sent."""
    finished = fx.route_events().selectExpr("seq + 1 as routeid", "to as celo_address", "timestamp_start as timestampstart",
                                          "timestamp_end as timestampend", "distance as measureddistance")
    completed = publication.reconcile(fx.attempts(), fx.ledger(), fx.attempts(), "staging").completed
    return publication.recorded_events(finished, completed).select("event", "block", "seq", "args.*").withColumnRenamed("to", "owner")


@query
def daily_metrics_increments(fx: Fixtures) -> DataFrame:
    """Daily figures kept up by four batches of routes, one of which is run twice."""
    path, params = _scratch(fx, "figures"), fx.params()
    trips = route_pipeline.segment(route_pipeline.clean(fx.routes_raw(), params).trips, params)
    owned = devices.attach(trips, _device_map(fx))
    for batch in (0, 1, 2, 1, 3):
        finished = routes.format_output(
            owned.where(f"k_ruta % 4 = {batch}"),
            [(routes.START, "timestampstart"), (routes.END, "timestampend"), (routes.DISTANCE, "measureddistance")], "unix", ["date"])
        daily_figures.add(fx.spark, path, finished, f"batch {batch}")
    daily_figures.compact(fx.spark, path, pieces=2)
    return _text(daily_figures.figures(fx.spark, path), "date")


def _by_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(
        F.count("*").alias("routes"), F.count_distinct("routeid").alias("ids"), F.sum("measureddistance").alias("distance"))


@query
def routes_landed_twice(fx: Fixtures) -> DataFrame:
    """All trips landed, and landed again under other names: the second landing adds no route."""
    landing, output, checkpoint = (_scratch(fx, n) for n in ("landing", "stream", "checkpoint"))
    for _ in range(2):
        writers.append_table(fx.routes_raw(), landing)
        incremental.run_available(fx.spark, landing, output, checkpoint, fx.params(), _device_map(fx), fx.known_unassigned(), fx.prototypes())
    return _by_source(incremental.routes(fx.spark, output))


@query
def routes_compacted(fx: Fixtures) -> DataFrame:
    """Trips landed in four batches, whose files are merged before the last one and read together."""
    landing, output, checkpoint = (_scratch(fx, n) for n in ("landing", "stream", "checkpoint"))
    # Every run of the stream reads the lists as they were stored, not the events they were made from.
    device_map, known, prototypes = (pin(t) for t in (_device_map(fx), fx.known_unassigned(), fx.prototypes()))
    for batch in range(4):
        if batch == 3:
            incremental.compact(fx.spark, output, files=1)
        writers.append_table(fx.routes_raw().where(f"k_ruta % 4 = {batch}"), landing)
        incremental.run_available(fx.spark, landing, output, checkpoint, fx.params(), device_map, known, prototypes)
    return _by_source(incremental.routes(fx.spark, output))


@query
def log_time_range_indexed(fx: Fixtures) -> DataFrame:
    """Lines of a time range from the files that the index names, of log files in ranges of time."""
    logs, index = _scratch(fx, "log"), _scratch(fx, "index")
    at = "timestamp_seconds(1704067200 + stream * 3600 + line_no)"
    shown = f"case when line_no % 10 = 3 then 'soon' else date_format({at}, 'yyyy-MM-dd HH:mm:ss') end"
    timed = fx.publish_log().selectExpr(f"{at} as at", f"concat({shown}, '|', stream, '|', line_no, ' ', line) as value")
    timed.repartitionByRange(12, "at").select("value").write.text(logs)
    log_index.update(fx.spark, logs, index, time_field=1)
    found = log_index.read_range(fx.spark, index, 1, "2024-01-01 02:00:00", "2024-01-02 00:00:50", field=3, stream_field=2)
    return found.select("stream", "line")


@query
def routes_by_date_list(fx: Fixtures) -> DataFrame:
    """Raw trips of the days on a list, from a table of the catalog whose partitions the join prunes."""
    path = _scratch(fx, "catalog")
    writers.write_partitioned(fx.routes_raw(), path)
    table = readers.declare_table(fx.spark, f"trips_{path.split('/')[-2].split('-')[-1]}", path, schemas.ROUTES_RAW)
    listed = fx.attempts().where("message = 'nonce too low'").select("date").distinct()
    return _text(table.join(listed, "date", "left_semi").select("k_ruta", "k_dispositivo", "source", "date"), "date")


@query
def record_view(fx: Fixtures) -> DataFrame:
    """Exported credit records read through a named view of a parameter document."""
    path, views = _scratch(fx, "credits"), _scratch(fx, "views")
    writers.write_table(fx.credits_raw(), path, "json")
    document = {"to publish": {"fields": ["credit_id", "term_text"], "formula": "not coalesce(fields.published_staging, false)"},
                "all terms": {"fields": ["term_text"]}}
    fx.spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(views)
    found = readers.read_view(fx.spark, path, schemas.CREDITS_RAW, readers.read_views(fx.spark, views), "to publish")
    return found.select("id", "fields.*")


@query
def delivery_extract_file(fx: Fixtures) -> DataFrame:
    """The delivery extract written as CSV and read back by its header."""
    path, rows = _scratch(fx, "extract"), registry.delivery_extract_rows(fx)
    delivery_extract.write(rows, path)
    return readers.read_csv(fx.spark, path, rows.schema)


@query
def landing_quarantine(fx: Fixtures) -> DataFrame:
    """Documents of which some are broken: the rows of the others, and how many were set aside."""
    path = _scratch(fx, "landing")
    record = T.StructType([f for f in schemas.ROUTES_RAW.fields if f.name not in ("date", "source")])
    row = F.to_json(F.struct(F.array(F.struct(*record.names)).alias("body")))
    broken = F.when(F.col("k_ruta") % 10 == 3, F.concat(F.lit("{\"body\": [{"), F.col("k_ruta").cast("string"))).otherwise(row)
    fx.routes_raw().select(broken.alias("value")).write.text(path)
    rows, bad = readers.land_envelope_or_quarantine(fx.spark, path, record)
    counted = bad.agg(F.count("*").alias("set_aside"))
    return rows.select("k_ruta", "k_dispositivo", "f_distancia").join(F.broadcast(counted))


@query
def publish_without_dates(fx: Fixtures) -> DataFrame:
    """A publication run in which some attempts have no date: they are a day of their own, and stop at their own failure."""
    undated = F.when(F.col("route_id") % 5 != 2, F.col("date"))
    attempts = fx.attempts().withColumn("date", undated)
    run = publication.reconcile(attempts, fx.ledger().withColumn("date", undated), attempts, "staging")
    counted = run.completed.groupBy("date").agg(F.count("*").alias("completed"))
    day = F.coalesce(F.col("date").cast("string"), F.lit("none"))
    return run.outcome.select(day.alias("date"), "total", "published", F.col("all_success").cast("int").alias("all_success")).join(
        counted.select(day.alias("date"), "completed"), "date", "left")


@query
def job_counts(fx: Fixtures) -> DataFrame:
    """What the route job of one day counted while it wrote its tables."""
    raw, counts = _scratch(fx, "raw"), _scratch(fx, "counts")
    paths = [_scratch(fx, n) for n in ("map", "ids", "routes", "known", "prototypes")]
    writers.write_partitioned(readers.on_date(fx.routes_raw(), registry.DAY), raw)
    store.replace_table(_device_map(fx), paths[0])
    writers.write_table(fx.known_unassigned(), paths[3])
    writers.write_table(fx.prototypes(), paths[4])
    daily.process(fx.spark, raw, paths[2], fx.params(), paths[0], paths[1], paths[3], paths[4], day=registry.DAY, counts_path=counts)
    return metrics.job_counts(fx.spark, counts).select("job", "step", "name", "value")


_LATER = ORACLE["credit_outstanding"]

ORACLE.update({
    "table_replaced": ORACLE["device_map_stored"],
    "records_updated": _with("""
select id, case when client_id % 100 = 7 then concat('0xnew', client_id) else celo_address end as celo_address, 1 as untouched
from contacts""", "contacts"),
    "payment_three_runs": ORACLE["payment_outcomes"],
    "credit_balances_kept": f"select credit_id, total_repayment, paid, outstanding from ({_LATER})",
    "route_state_increments": ORACLE["ledger_first_write"],
    "routes_per_day_increments": ORACLE["routes_per_day"],
    "route_events_emitted": _with("""
select 'RouteRecorded' as event, c.nonce as block, c.seq, owner, c.route_id as token_id, timestamp_start, timestamp_end, distance
from completed c join route_events e on e.seq + 1 = c.route_id where status = 'sent'""", "completed", "route_events"),
    "daily_metrics_increments": ORACLE["daily_driver_metrics"],
    "routes_landed_twice": ORACLE["routes_incremental"],
    "routes_compacted": ORACLE["routes_incremental"],
    "log_time_range_indexed": ORACLE["log_time_range"],
    "routes_by_date_list": _with("""
select k_ruta, k_dispositivo, source, date from routes_raw where date in (select date from attempts where message = 'nonce too low')""",
                                 "routes_raw", "attempts"),
    "record_view": ORACLE["record_scan"],
    "delivery_extract_file": ORACLE["delivery_extract_rows"],
    "landing_quarantine": _with("""
select k_ruta, k_dispositivo, f_distancia, (select count(*) from routes_raw where k_ruta % 10 = 3) as set_aside
from routes_raw where k_ruta % 10 <> 3""", "routes_raw"),
    "publish_without_dates": _with("""
, a as (select coalesce(case when route_id % 5 <> 2 then date end, 'none') as day, * from tried),
l as (select case when route_id % 5 <> 2 then date else 'none' end as day from ledger),
stops as (select day, min(seq) as stop from a where status = 'failed' group by day),
done as (select a.* from a left join stops using (day) where stop is null or seq < stop),
published as (select day, count(*) as n from (select day from l union all select day from done) group by day),
every as (select case when route_id % 5 <> 2 then date else 'none' end as day, count(*) as total from attempts group by 1)
select e.day as date, total, coalesce(n, 0) as published, (coalesce(n, 0) >= total)::int as all_success, completed
from every e left join published using (day) left join (select day, count(*) as completed from done group by day) using (day)""",
                                   "attempts", "ledger", "tried").replace("\n, a as", ",\na as", 1),
    "job_counts": _with("""
, mine as (select * from segments where date = '2024-01-15'),
trips as (select * from counted where date = '2024-01-15'),
addressed as (select f.* from final f where date = '2024-01-15')
select 'process' as job, step, name, cast(value as bigint) as value from (
  select 'trips' as step, 'rows' as name, (select count(*) from trips) as value
  union all select 'trips', 'segments', (select sum(n) from trips)
  union all select 'new_ids', 'rows', (select count(*) from mine)
  union all select 'routes', 'rows', (select count(*) from addressed)
  union all select 'routes', 'without_owner', (select count(*) from addressed where celo_address is null)
  union all select 'quarantine', 'rows', 0
  union all select 'unowned_devices', 'rows', (select count(*) from (select distinct source, gpsid from addressed where celo_address is null))
  union all select 'split_summary', 'rows', (select count(distinct source) from trips))""",
                        "segments", "counted", "final").replace("\n, mine as", ",\nmine as", 1),
})
