"""State that is folded run by run equals the same over everything at once."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import credits, ledger, metrics
from fleetledger.plans import daily, daily_figures, payment_store, publication, route_state
from fleetledger.sources import log_index, readers, store, writers
from fleetledger.sources.fixtures import Fixtures
from fleetledger.streaming import incremental
from test_streaming import land

PAYMENT = "id string, payment_id bigint, credit_id bigint, amount bigint, payment_date bigint"
D = datetime.date(2024, 1, 15)


def payments(seed, n=200):
    draw = random.Random(seed)
    rows = [(f"p{k}", draw.randrange(150), draw.choice([1, 1, 1, 2, 3, 9]), draw.randrange(-1, 40), k // 10) for k in range(n)]
    rows += [("x", None, 1, 5, 3), ("y", 900, None, 5, 3), ("z", 901, 1, None, 4)] + [rows[7]] * 3
    return rows


def shown(df):
    return sorted((tuple(r[c] for c in (*payment_store.RECORD, "outcome", "applied", "balance", "records")) for r in df.collect()), key=repr)


def test_payment_runs_in_a_row_equal_one_run(spark, tmp_path, seed=1):
    owed = spark.createDataFrame([(1, 900), (2, 100), (3, 0), (4, 50)], "credit_id bigint, total_repayment bigint")
    rows = spark.createDataFrame(payments(seed), PAYMENT)
    path = str(tmp_path / "store")
    payment_store.open_credits(spark, path, owed.where("credit_id < 3"), buckets=8)
    payment_store.open_credits(spark, path, owed)  # only the two that are new
    for low, high in ((0, 4), (4, 9), (9, 100)):  # by the order of payments
        payment_store.record(spark, path, rows.where(f"payment_date >= {low} and payment_date < {high}"))
    want = credits.payment_outcomes(owed, rows)
    assert shown(payment_store.outcomes(spark, path)) == shown(want.where("outcome <> 'error'"))
    left = {r.credit_id: r.total_repayment - r.paid for r in payment_store.balances(spark, path).collect()}
    applied = want.groupBy("credit_id").agg(F.sum("applied").alias("paid"))
    assert left == {r.credit_id: r.outstanding for r in credits.outstanding(owed, want.where("outcome in ('applied_full', 'clamped')")).collect()}
    assert applied.count() and len(left) == 4


def test_a_payment_run_that_is_repeated_records_nothing_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    owed = spark.createDataFrame([(1, 100)], "credit_id bigint, total_repayment bigint")
    payment_store.open_credits(spark, path, owed)
    rows = spark.createDataFrame([("a", 1, 1, 70, 0), ("b", 2, 1, 70, 1)], PAYMENT)
    with monkeypatch.context() as m:
        m.setattr(store.Store, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("broke off")))
        with pytest.raises(RuntimeError):
            payment_store.record(spark, path, rows)
    assert payment_store.outcomes(spark, path).count() == 0  # no part of the run shows
    payment_store.record(spark, path, rows)
    first = shown(payment_store.outcomes(spark, path))
    assert payment_store.record(spark, path, rows).count() == 0 and shown(payment_store.outcomes(spark, path)) == first
    other = payment_store.record(spark, path, spark.createDataFrame([("c", 2, 1, 70, 1)], PAYMENT)).collect()
    assert [r.outcome for r in other] == ["duplicate"]


def test_a_payment_run_opens_only_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "store")
    owed = spark.range(1, 500).select(F.col("id").alias("credit_id"), F.lit(100).cast("bigint").alias("total_repayment"))
    payment_store.open_credits(spark, path, owed, buckets=32)
    rows = spark.createDataFrame([("a", 1, 7, 70, 0)], PAYMENT)
    before = store.Store(spark, path).snapshot()
    payment_store.record(spark, path, rows)
    after = store.Store(spark, path).snapshot()
    changed = [p for p in before.parts["balances"] if before.parts["balances"][p] != after.parts["balances"][p]]
    assert changed == store.touched(rows, "credit_id", 32) and len(before.parts["balances"]) > 20
    assert len(payment_store.payable(spark, path, rows).inputFiles()) == 1
    payment_store.compact(spark, path, pieces=0)
    assert payment_store.balances(spark, path).agg(F.sum("paid")).first()[0] == 70


def test_payment_runs_in_a_row_equal_one_run_where_many_ids_are_shared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(credits, "BROADCAST_ROWS", 0)  # too many ids to send to every task
    test_payment_runs_in_a_row_equal_one_run(spark, tmp_path, seed=2)


def test_records_with_an_id_of_their_own_are_kept_once_on_the_way(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "store"), []
    pin = payment_store.pin
    monkeypatch.setattr(payment_store, "pin", lambda df, *more: kept.append(pin(df, *more)) or kept[-1])
    owed = spark.range(50).select(F.col("id").alias("credit_id"), F.lit(100).cast("bigint").alias("total_repayment"))
    payment_store.open_credits(spark, path, owed)
    kept.clear()
    rows = spark.createDataFrame([(f"p{k}", k, k % 60, 30, k // 10) for k in range(300)], PAYMENT)
    found = payment_store.record(spark, path, rows)
    assert sum(df.count() for df in kept) == 300 and found.count() == 300
    assert sum(r.paid for r in payment_store.balances(spark, path).collect()) == 50 * 100


def test_equal_digests_are_no_proof_of_equal_records(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    payment_store.open_credits(spark, path, spark.createDataFrame([(1, 100)], "credit_id bigint, total_repayment bigint"))
    payment_store.record(spark, path, spark.createDataFrame([("a", 1, 1, 70, None), ("b", 2, 1, 70, 1)], PAYMENT))
    plain = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("bigint") if len(columns) > 1 else plain(*columns))
    again = payment_store.record(spark, path, spark.createDataFrame([("a", 1, 1, 70, None), ("c", 2, 1, 70, 1)], PAYMENT))
    assert [(r.id, r.outcome, r.records) for r in again.collect()] == [("c", "duplicate", 1)]


def test_payments_of_a_credit_issued_later_wait(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    from test_credits import record
    contacts = spark.createDataFrame([("k1", (7, [], "0xA"))], schemas.CONTACTS)
    contacts.write.parquet(path("contacts"))
    spark.createDataFrame([record("c1", 1, ["k1"], None, True, debt=100.0), record("c2", 2, ["k1"], None, False, debt=50.0)],
                          schemas.CREDITS_RAW).write.parquet(path("credits"))
    paid = [(f"p{i}", (i, c, 30.0, "2024-02-01", None, None)) for i, c in ((1, 1), (2, 2))]
    spark.createDataFrame(paid, schemas.PAYMENTS_RAW).write.parquet(path("payments"))
    run = lambda: daily.publish_payments(spark, path("payments"), path("credits"), path("paid"), "staging", counts_path=path("counts"))
    run()
    flags = lambda: {r.id: r.fields.published_staging for r in store.read_table(spark, path("payments"), schemas.PAYMENTS_RAW).collect()}
    assert flags() == {"p1": True, "p2": None}
    daily.publish_credits(spark, path("credits"), path("contacts"), path("state"), "staging", balances_path=path("paid"), counts_path=path("counts"))
    run()
    run()  # finds nothing to do
    assert flags() == {"p1": True, "p2": True}
    assert {(r.credit_id, r.paid) for r in payment_store.balances(spark, path("paid")).collect()} == {(1, 30), (2, 30)}
    counted = metrics.job_counts(spark, path("counts"), "publish_payments").where("step = 'payments' and name = 'published'")
    assert sorted(r.value for r in counted.collect()) == [0, 1, 1]


def events(spark, n=300, seed=3):
    draw = random.Random(seed)
    return spark.createDataFrame([(k // 7, k, draw.randrange(90), f"0x{k}", 86_400 * (k % 5), 1, k) for k in range(n)],
                                 "block bigint, seq bigint, token_id bigint, to string, timestamp_start bigint, timestamp_end bigint, distance bigint")


def test_route_state_by_increments_equals_the_first_write(spark, tmp_path):
    path, rows = str(tmp_path / "state"), events(spark)
    assert route_state.last_block(spark, path) == -1
    for upto in (10, 10, 25, 100):  # a fold of the same blocks changes nothing
        route_state.fold(spark, path, rows.where(f"block <= {upto}"))
    want = ledger.first_write(rows)
    assert sorted(map(tuple, route_state.state(spark, path).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, route_state.routes_per_day(spark, path).collect())) == sorted(map(tuple, metrics.routes_per_day(want).collect()))
    route_state.compact(spark, path, pieces=1)
    assert route_state.state(spark, path).count() == want.count() and route_state.last_block(spark, path) == 42


def test_event_files_are_sorted_by_block(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = events(spark, 2_000).select(F.lit("RouteRecorded").alias("event"), "block", "seq", F.struct(
        "to", "token_id", "timestamp_start", "timestamp_end", "distance").alias("args"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one file
    try:
        writers.append_table(writers.by_block(rows.repartition(5)), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = sorted(tuple(r) for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("seq").alias("a"), F.max("seq").alias("b")).select("a", "b").collect())
    assert len(ranges) > 1 and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    found = readers.read_events(spark, path, "RouteRecorded", 100, 120)
    assert "GreaterThanOrEqual(block,100)" in found._jdf.queryExecution().toString()
    assert found.count() == 21 * 7


def test_the_publication_job_emits_events_that_fold_to_the_state(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    routes = spark.createDataFrame([(k, "G", 100 * k, 100 * k + 50, 10 + k, f"0x{k}", D, "m") for k in range(1, 7)], schemas.ROUTES_FINAL)
    writers.write_day(routes, path("routes"), "2024-01-15")

    def attempts(*rows):
        return spark.createDataFrame([(D, seq, key, message, 1, 70 + seq, 9, f"0x{key}") for seq, key, message in rows], schemas.ATTEMPTS)

    minted = "execution reverted: ERC721: token already minted"
    run = lambda rows: daily.record(spark, path("routes"), path("ledger"), "staging", rows, "2024-01-15", path("events"), path("counts"))
    with pytest.raises(daily.Incomplete):
        run(attempts((1, 1, "ok"), (2, 2, minted), (3, 3, "nonce too low"), (4, 4, "ok")))
    run(attempts((5, 3, "ok"), (6, 4, "ok"), (7, 5, "ok"), (8, 6, "ok")))
    route_state.fold(spark, path("state"), readers.read_events(spark, path("events"), "RouteRecorded"))
    found = {r.token_id: (r.block, r.to, r.distance) for r in route_state.state(spark, path("state")).collect()}
    assert found == {k: (70 + s, f"0x{k}", 10 + k) for s, k in ((1, 1), (5, 3), (6, 4), (7, 5), (8, 6))}
    counted = {(r.step, r.name): r.value for r in metrics.job_counts(spark, path("counts")).collect()}
    assert counted == {("events", "rows"): 4, ("routes", "total"): 6, ("routes", "published"): 6}


def test_daily_figures_by_batches(spark, tmp_path):
    path = str(tmp_path / "figures")
    rows = spark.createDataFrame([(f"0x{k % 3}" if k % 4 else None, D + datetime.timedelta(k % 2), 10 * k, 10 * k + k, k) for k in range(40)],
                                 "celo_address string, date date, timestampstart bigint, timestampend bigint, measureddistance bigint")
    for batch in (0, 1, 1, 2, 3, 0):
        daily_figures.add(spark, path, rows.where(f"measureddistance % 4 = {batch}"), f"b{batch}")
    told = lambda df: sorted(map(str, df.select("celo_address", "date", "routes", "total_seconds", "total_distance").collect()))
    want = metrics.daily_driver(rows)
    assert told(daily_figures.figures(spark, path)) == told(want)
    assert told(daily_figures.figures(spark, path, ["2024-01-16"])) == told(want.where("date = '2024-01-16'"))
    assert daily_figures.compact(spark, path, pieces=1)
    assert told(daily_figures.figures(spark, path)) == told(want)
    with pytest.raises(ValueError, match="merged"):
        daily_figures.add(spark, path, rows, "b1")


def stream(spark, tmp_path, **more):
    owners = spark.createDataFrame([("G0", "0x0"), ("G1", "0x1"), ("G2", "0x2")], schemas.DEVICE_MAP)
    incremental.run_available(spark, str(tmp_path / "landing"), str(tmp_path / "output"), str(tmp_path / "checkpoint"),
                              Fixtures.params(), owners, **more)
    return sorted(map(tuple, incremental.routes(spark, str(tmp_path / "output")).collect()), key=repr)


def test_a_batch_reads_the_device_map_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(address):
        read.add(1)
        return address

    land(spark, str(tmp_path / "landing"), range(10))
    owners = spark.createDataFrame([(f"G{k}", f"0x{k}") for k in range(5)], schemas.DEVICE_MAP)
    owners = owners.withColumn("celo_address", F.udf(counted, "string")("celo_address"))
    incremental.run_available(spark, str(tmp_path / "landing"), str(tmp_path / "output"), str(tmp_path / "checkpoint"),
                              Fixtures.params(), owners)
    assert read.value == 5


def test_trips_that_land_again_add_nothing(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing, range(10))
    first = stream(spark, tmp_path)
    land(spark, landing, range(10))  # the same trips in another file
    assert stream(spark, tmp_path) == first
    land(spark, landing, [*range(5, 15), 12, 12])  # some known, some new, one three times
    second = stream(spark, tmp_path)
    assert set(first) < set(second)
    assert len({r[0] for r in second}) == len(second)
    trips = spark.read.parquet(str(tmp_path / "output_trips"))
    assert sorted(r.k_ruta for r in trips.collect()) == list(range(15))


def test_a_new_checkpoint_overwrites_nothing_and_adds_nothing(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for k in range(3):
        land(spark, landing, range(10 * k, 10 * k + 10))
    rows = stream(spark, tmp_path, files_per_batch=1)
    (tmp_path / "checkpoint").rename(tmp_path / "lost")
    assert stream(spark, tmp_path) == rows  # all files are read again, in one batch
    land(spark, landing, range(25, 35))
    after = stream(spark, tmp_path)
    assert set(rows) < set(after) and {r[-1] for r in after} == {0, 1, 2, 4}


def test_a_trip_that_was_set_aside_may_come_again(spark, tmp_path):
    landing = str(tmp_path / "landing")
    bad = [(3, "G0", "soon", "2024-01-01 11:00:00", 1000.0, None, 0, 0, 0, 0, "motorbike", datetime.date(2024, 1, 1))]
    spark.createDataFrame(bad, schemas.ROUTES_RAW).write.mode("append").parquet(landing)
    assert stream(spark, tmp_path) == []
    land(spark, landing, [3])
    assert stream(spark, tmp_path)


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_path):
    landing, output = str(tmp_path / "landing"), str(tmp_path / "output")
    for k in range(4):
        land(spark, landing, range(10 * k, 10 * k + 10))
    rows = stream(spark, tmp_path, counts_path=str(tmp_path / "counts"), files_per_batch=1)
    count = lambda: len(incremental.routes(spark, output).inputFiles())
    before = count()
    assert incremental.compact(spark, output, files=2) == ["date=2024-01-01/source=motorbike"]
    assert stream(spark, tmp_path) == rows and count() < before
    assert incremental.compact(spark, output, files=2) == []  # deletes what was merged
    assert sorted(n for n in os.listdir(f"{output}/date=2024-01-01/source=motorbike") if n.startswith("batch")) == ["batch=3"]
    for k in range(4, 6):
        land(spark, landing, range(10 * k, 10 * k + 10))
    rows = stream(spark, tmp_path, files_per_batch=1)
    assert incremental.compact(spark, output, files=1) and stream(spark, tmp_path) == rows
    counted = metrics.job_counts(spark, str(tmp_path / "counts"), "stream").where("step = 'new_trips'").collect()
    assert sorted((r.run, r.value) for r in counted) == [(f"batch={k}", 10) for k in range(4)]


def test_no_pinned_table_is_left(spark, tmp_path):
    from fleetledger.session import work_dir
    folder = f"{work_dir(spark)}/fleetledger"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    land(spark, str(tmp_path / "landing"), range(10))
    stream(spark, tmp_path)
    after = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert after == before


def test_a_log_range_opens_the_files_of_its_times(spark, tmp_path):
    logs, index = str(tmp_path / "a log"), str(tmp_path / "index")

    def write(hour, *more):
        lines = [f"2024-01-01 {hour:02d}:{m:02d}:00|s|x|y|z|line {hour} {m}" for m in range(0, 60, 10)] + list(more)
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(logs)

    for hour in range(4):
        write(hour, "no time|s|x|y|z|lost")
    assert log_index.update(spark, logs, index, 1) == 4 and log_index.update(spark, logs, index, 1) == 0
    write(9)
    assert log_index.update(spark, logs, index, 1) == 1
    span = ("2024-01-01 01:30:00", "2024-01-01 03:00:00")
    assert len(log_index.files_in(spark, index, *span)) == 2
    found = log_index.read_range(spark, index, 1, *span)
    assert len(found.inputFiles()) == 2
    want = readers.read_log_lines(spark, logs, time_field=1, start=span[0], end=span[1])
    assert sorted(r.line for r in found.collect()) == sorted(r.line for r in want.collect()) and found.count() == 9
    assert log_index.read_range(spark, index, 1, "2025-01-01").count() == 0
    oldest = min((tmp_path / "a log").glob("part-*"), key=os.path.getmtime)
    os.utime(oldest, (1_700_000_000, 1_700_000_000))
    assert len(readers.read_log_lines(spark, logs, modified_after="2023-12-01T00:00:00").inputFiles()) == 4
    assert readers.read_log_lines(spark, logs, modified_before="2023-12-01T00:00:00").inputFiles()[0].endswith(oldest.name)


def test_a_list_of_dates_prunes_the_catalog_table(spark, tmp_path):
    rows = spark.createDataFrame([(k, D + datetime.timedelta(k % 6), "m") for k in range(60)], "k_ruta bigint, date date, source string")
    writers.write_partitioned(rows, str(tmp_path / "t"))
    table = readers.declare_table(spark, f"declared_{tmp_path.name.replace('-', '_')}", str(tmp_path / "t"), rows.schema)
    listed = rows.where("k_ruta = 7").select("date").distinct()
    joined = table.join(listed, "date", "left_semi")
    assert joined.count() == 10
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()


def test_broken_documents_are_kept_apart(spark, tmp_path):
    from test_daily import DAY, document
    path = lambda name: str(tmp_path / name)
    lines = [document(range(3), "A"), '{"body": [{"k_ruta": 1', '{"body": 7}', document(range(3, 5), "B"), "", "null"]
    (tmp_path / "d.json").write_text("\n".join(lines))
    with pytest.raises(Exception):
        daily.land(spark, path("d.json"), path("raw"), "motorbike", DAY)
    daily.land(spark, path("d.json"), path("raw2"), "motorbike", DAY, bad_root=path("bad"), counts_path=path("counts"))
    assert readers.read_partitioned(spark, path("raw2"), schemas.ROUTES_RAW, day=DAY).count() == 5
    assert sorted(r.document for r in spark.read.parquet(path("bad")).collect()) == sorted([lines[1], lines[2], "null"])
    counted = {r.step: r.value for r in metrics.job_counts(spark, path("counts")).collect()}
    assert counted == {"rows": 5, "bad_documents": 3}


def test_views_by_name(spark, tmp_path):
    path = str(tmp_path / "views.json")
    (tmp_path / "views.json").write_text('{"open": {"fields": ["celo_address"], "formula": "fields.client_id > 1"}, "all": {}}')
    views = readers.read_views(spark, path)
    spark.createDataFrame([("a", (1, [], "0x")), ("b", (2, [], None))], schemas.CONTACTS).write.json(str(tmp_path / "c"))
    read = lambda name: readers.read_view(spark, str(tmp_path / "c"), schemas.CONTACTS, views, name)
    assert [(r.id, r.fields.asDict()) for r in read("open").collect()] == [("b", {"celo_address": None})]
    assert read("all").count() == 2
    with pytest.raises(ValueError, match="no view other"):
        read("other")


def test_rows_without_a_date_are_a_day(spark):
    rows = [(None, 1, 1, "ok"), (None, 2, 2, "nonce too low"), (None, 3, 3, "ok"), (D, 1, 4, "ok"), (D, 2, 5, "ok")]
    tried = spark.createDataFrame(rows, "date date, seq bigint, route_id bigint, message string")
    run = publication.reconcile(tried, spark.createDataFrame([], schemas.LEDGER), tried, "staging")
    assert sorted(r.route_id for r in run.completed.collect()) == [1, 4, 5]
    assert {r.date: (r.total, r.published, r.all_success) for r in run.outcome.collect()} == {None: (3, 1, False), D: (2, 2, True)}
