import collections
import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetledger import ParamSet, Range, SourceParams, SplitRule
from fleetledger import schemas
from fleetledger.operators import devices, routes
from fleetledger.plans import delivery_extract, route_pipeline

DAY = datetime.date(2024, 1, 1)
SCHEMA = "k_ruta bigint, k_dispositivo string, o_fecha_inicial string, o_fecha_final string, f_distancia double, source string, date date"


def trip(k, device="G1", start="2024-01-01 10:00:00", end="2024-01-01 11:00:00", distance=1000.0, source="m"):
    return (k, device, start, end, distance, source, DAY)


def cut(spark, rows, top=4200.0, avg=2000.0, seed=0):
    df = routes.parse_times(spark.createDataFrame(rows, SCHEMA))
    return routes.split(routes.count_segments(df, top, avg), seed).select(
        "k_ruta", "segment", "segments", F.unix_micros(routes.START).alias("s"), F.unix_micros(routes.END).alias("e"), routes.DISTANCE)


def test_split_invariants(spark):
    rows = [trip(k, end=f"2024-01-01 1{1 + k % 4}:{k % 60:02d}:{k * 7 % 60:02d}", distance=137.5 * k) for k in range(1, 300)]
    source = {r[0]: r for r in rows}
    parts = collections.defaultdict(list)
    for r in cut(spark, rows).orderBy("k_ruta", "segment").collect():
        parts[r.k_ruta].append(r)
    assert set(parts) == set(source)
    shares = []
    for k, segs in parts.items():
        whole = routes_micros(source[k][2]), routes_micros(source[k][3])
        assert len(segs) == segs[0].segments == (1 if source[k][4] <= 4200 else -(-source[k][4] // 2000))
        assert (segs[0].s, segs[-1].e) == whole
        assert all(a.e == b.s for a, b in zip(segs, segs[1:]))
        assert sum(s.f_distancia for s in segs) == pytest.approx(source[k][4], rel=1e-9)
        longest, shortest = max(s.e - s.s for s in segs), min(s.e - s.s for s in segs)
        assert longest <= 1.5 * shortest + 2
        if len(segs) > 1:
            shares += [s.f_distancia * len(segs) / source[k][4] for s in segs]
    assert min(shares) < 0.85 and max(shares) > 1.15 and sum(shares) / len(shares) == pytest.approx(1, abs=0.01)
    assert len({round(s, 3) for s in shares}) > 200


def routes_micros(text):
    at = datetime.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=datetime.timezone.utc)
    return int(at.timestamp()) * 1_000_000


def test_split_is_repeatable_and_seeded(spark):
    rows = [trip(k, distance=50_000.0) for k in range(20)]
    first, again, other = (sorted(map(tuple, cut(spark, rows, seed=s).collect())) for s in (0, 0, 1))
    assert first == again != other


def test_split_of_extreme_trips(spark):
    # more segments than one generated run, and more than a bigint product could hold
    rows = [trip(1, distance=20_000.0 * 2000), trip(2, distance=400_000.0 * 2000)]
    got = cut(spark, rows).groupBy("k_ruta").agg(
        F.count("*").alias("n"), F.min("s").alias("s"), F.max("e").alias("e"), F.sum(F.expr("e - s")).alias("t"),
        F.min(F.expr("e - s")).alias("least")).orderBy("k_ruta").collect()
    assert [r.n for r in got] == [20_000, 400_000]
    for r in got:
        assert (r.s, r.e) == (routes_micros(rows[0][2]), routes_micros(rows[0][3]))
        assert r.t == r.e - r.s and r.least >= 0


def test_split_without_duration_or_distance(spark):
    rows = [trip(1, end="2024-01-01 10:00:00", distance=9000.0), trip(2, distance=None), trip(3, distance=float("nan"))]
    got = cut(spark, rows).orderBy("k_ruta", "segment").collect()
    assert [r.k_ruta for r in got] == [1] * 5 + [2, 3]
    assert all(r.s == r.e for r in got[:5]) and sum(r.f_distancia for r in got[:5]) == pytest.approx(9000)


def test_over_long_segments_are_counted(spark):
    df = spark.createDataFrame([trip(k, distance=8000.0) for k in range(200)], SCHEMA)
    segs = routes.split(routes.count_segments(routes.parse_times(df), 4200, 4000))
    assert routes.over_long_segments(segs, 4200).first()[0] > 0


def test_format_output(spark):
    df = routes.parse_times(spark.createDataFrame([trip(7, distance=2.5), trip(8, distance=3.5)], SCHEMA))
    df = df.withColumn("celo_address", F.lit("0xA"))
    out = routes.format_output(df, {"absent": "x", "f_distancia": "d", "k_ruta": "id", "o_fecha_inicial": "t"}, "%Y-%m-%d %H:%M")
    assert out.columns == ["d", "id", "t", "celo_address"]
    assert sorted(map(tuple, out.collect())) == [(2, 7, "2024-01-01 10:00", "0xA"), (4, 8, "2024-01-01 10:00", "0xA")]
    placed = routes.format_output(df, {"celo_address": "owner", "o_fecha_final": "t"}, "unix")
    assert placed.columns == ["owner", "t"] and placed.first().t == 1704106800


def test_filters(spark):
    rows = [trip(1, end="2024-01-01 10:02:00"), trip(2, end="2024-01-01 10:02:01"), trip(3, end="2024-01-01 11:30:00"),
            trip(4, end="2024-01-01 11:30:01"), trip(5, end="2024-01-01 09:00:00")]
    df = routes.parse_times(spark.createDataFrame(rows, SCHEMA))
    assert [r.k_ruta for r in routes.filter_duration(df, 2, 90).orderBy("k_ruta").collect()] == [2, 3]
    assert [r.k_ruta for r in routes.filter_duration(df, 2, 0).orderBy("k_ruta").collect()] == [2, 3, 4]
    capped = routes.cap_distance(df, 60_000).orderBy("k_ruta").collect()
    assert capped[4].f_distancia == capped[4].maxExpectedDistance == -60_000.0
    with pytest.raises(PySparkException):
        routes.parse_times(spark.createDataFrame([trip(1, start="soon")], SCHEMA)).collect()


def lists(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "k_dispositivo string")


@pytest.fixture(scope="module")
def job(spark):
    rows = [
        trip(1, "owned"), trip(2, "owned", distance=9000.0), trip(3, "unowned"), trip(4, "known"), trip(5, "healed"),
        trip(6, "proto", source="b"), trip(7, "proto", source="m"), trip(8, "ownedproto", source="b"),
        trip(9, "owned", start="never"), trip(10, "owned", distance=100.0), trip(11, "owned", source="?"),
        trip(12, "free", source="b", distance=None), trip(13, None), trip(14, "owned", distance=float("nan"))]
    params = ParamSet([
        SourceParams("m", output_datetime_format="unix", distance=Range(147), duration=Range(2, 90), max_per_hour=60_000,
                     split=SplitRule(4200, 2000)),
        SourceParams("b", output_datetime_format="unix", prototype_address="0xP")])
    owners = spark.createDataFrame(
        [("owned", "0x1"), ("healed", "0x2"), ("ownedproto", "0x3")], "k_dispositivo string, celo_address string")
    raw = spark.createDataFrame(rows, SCHEMA)
    return raw, params, owners, route_pipeline.process(
        raw, params, owners, lists(spark, "known", "healed", "nowhere"), lists(spark, "proto", "ownedproto"))


def test_process(spark, job):
    _, _, _, run = job
    got = run.final.orderBy("routeid").collect()
    assert run.final.columns == [
        "routeid", "gpsid", "timestampstart", "timestampend", "measureddistance", "celo_address", "date", "source"]
    found = collections.Counter((r.gpsid, r.celo_address) for r in got)
    assert found == {("owned", "0x1"): 6, ("unowned", None): 1, ("healed", "0x2"): 1, ("proto", "0xP"): 1,
                     ("proto", None): 1, ("ownedproto", "0x3"): 1, (None, None): 1}
    # ids follow date, source, trip and segment; the dropped device's id is used up
    assert [r.routeid for r in got] == [i for i in range(100_001, 100_014) if i != 100_010]
    assert sum(r.measureddistance for r in got if r.gpsid == "owned") == pytest.approx(10_000, abs=3)


def test_process_quarantine_alerts_summary(spark, job):
    _, _, _, run = job
    assert {(r.k_ruta, r.reason) for r in run.quarantine.collect()} == {
        (9, "bad_time"), (11, "unknown_source"), (12, "missing_distance")}
    assert [(r.source, r.part, r.devices, r.device_list) for r in run.alerts.collect()] == [("m", 0, 2, "proto, unowned")]
    summary = {r.source: (r.original_routes, r.new_routes, r.extra_routes) for r in run.summary.collect()}
    assert summary == {"m": (7, 11, 4), "b": (2, 2, 0)}


def test_process_equals_single_operators(spark, job):
    raw, params, owners, run = job
    trips = route_pipeline.segment(route_pipeline.clean(raw, params).trips, params).where("source = 'm'")
    owned = devices.attach(trips, owners)
    effective = devices.known_unassigned(owned, lists(spark, "known", "healed", "nowhere"))
    assert [r[0] for r in effective.collect()] == ["known"]
    left = devices.drop_devices(owned, effective).select("k_dispositivo", "celo_address").collect()
    piped = run.final.where("source = 'm'").select("gpsid", "celo_address").collect()
    assert collections.Counter(map(tuple, left)) == collections.Counter(map(tuple, piped))


def test_strict_processing_raises(spark, job):
    raw, params, _, _ = job
    with pytest.raises(PySparkException):
        route_pipeline.clean(raw, params, strict=True).trips.collect()


def test_stable_ids_in_the_job(spark, job):
    raw, params, owners, _ = job
    none = spark.createDataFrame([], schemas.ID_ASSIGNMENTS)
    first = route_pipeline.process(raw, params, owners, assignments=none)
    again = route_pipeline.process(raw, params, owners, assignments=first.new_assignments)
    assert sorted(map(tuple, first.final.collect()), key=str) == sorted(map(tuple, again.final.collect()), key=str)
    assert again.new_assignments.count() == 0


def test_empty_input_keeps_the_schema(spark, job):
    raw, params, owners, run = job
    out = route_pipeline.process(raw.where("k_ruta < 0"), params, owners).final
    assert out.count() == 0 and out.columns == run.final.columns


def test_missing_column_and_zone(spark, job):
    raw, params, owners, _ = job
    with pytest.raises(ValueError):
        route_pipeline.process(raw.drop("k_ruta"), params, owners)
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        with pytest.raises(ValueError):
            route_pipeline.process(raw, params, owners)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_distance_range_reaches_the_scan(spark, tmp_path, capsys, job):
    raw, params, _, _ = job
    raw.write.partitionBy("date", "source").parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    route_pipeline.clean(stored.where("source = 'm'"), ParamSet([params.params[0]])).trips.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(f_distancia,147.0)" in plan and "PartitionFilters: [isnotnull(source" in plan
    assert "Exchange" not in plan
    one = ParamSet([params.params[0], SourceParams("b", distance=Range(5))])
    route_pipeline.clean(stored, one).trips.explain("formatted")
    assert "GreaterThan(f_distancia,5.0)" in capsys.readouterr().out


def test_parsing_runs_once_per_row(spark, capsys):
    df = routes.filter_duration(routes.parse_times(spark.createDataFrame([trip(1)], SCHEMA), "%Y-%m-%d %H:%M:%S"))
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("gettimestamp(o_fecha_inicial") == 1


def test_parameters_from_documents(spark):
    doc = {"input_datetime_format": "%d/%m/%Y %H:%M", "column_rename_map": {"k_dispositivo": "gps"},
           "distance_filter": {"min": 147}, "duration_filter": {"min": 2, "max": 90},
           "distance_fix": {"expected_max_per_hour": 60000}, "split_big_routes": {"max_distance": 4200, "avg_distance": 2000},
           "proto_celo_address": {"address": "0x9"}}
    assert SourceParams.from_document("m", doc).prototype_address is None  # the section must be named
    p = SourceParams.from_document("m", doc, address_section="proto_celo_address")
    assert (p.distance, p.duration, p.max_per_hour, p.split, p.prototype_address) == (
        Range(147), Range(2, 90), 60000, SplitRule(4200, 2000), "0x9")
    bare = SourceParams.from_document("n", {})
    assert (bare.distance, bare.duration, bare.max_per_hour, bare.split, bare.prototype_address) == (None,) * 5
    table = ParamSet([p, bare]).to_frame(spark).orderBy("source").collect()
    assert [(r.source, r.dist_min, r.dist_max, r.split_avg) for r in table] == [("m", 147, None, 2000), ("n", None, None, None)]
    with pytest.raises(ValueError):
        ParamSet([p, p])
    with pytest.raises(ValueError):
        SplitRule(1, 0)


def test_delivery_extract(spark):
    raw = spark.createDataFrame(
        [("G1", "1/5/23 7:05", "1/5/23 7:35", 1200.0, "c", -7408000000, 471000000, -7409000000, 472000000),
         ("G2", "1/5/23 7:05", "1/5/23 7:35", 1200.0, None, 0, 0, 0, 0),
         ("G3", "1/5/23 7:05", "1/5/23 7:06", 1200.0, "c", 0, 0, 0, 0),
         ("G4", "1/5/23 7:05", "1/5/23 7:35", 9_000_001.0, "c", 0, 0, 0, 0)],
        "Dispositivo string, `Fecha Inicio` string, `Fecha Fin` string, Distancia double, Referencia string, "
        "`Lng. Inicial` bigint, `Lat. Inicial` bigint, `Lng. Final` bigint, `Lat. Final` bigint")
    out = delivery_extract.extract(raw)
    assert out.columns == ["gpsID", "timestampStart", "timestampEnd", "measuredDistance", "startLocation", "endLocation", "durationMinutes"]
    assert list(map(tuple, out.collect())) == [
        ("G1", "2023-01-05 07:05", "2023-01-05 07:35", 1200.0, "(-74.08, 4.71)", "(-74.09, 4.72)", 30.0)]


def test_segments_are_drawn_one_by_one(spark):
    """Shares spread over the whole range, and neighbours and halves of a pair don't follow each other."""
    trips = spark.range(1, 201).selectExpr(
        "id as k_ruta", "timestamp'2024-01-01 00:00:00' as o_fecha_inicial", "timestamp'2024-01-02 00:00:00' as o_fecha_final",
        "100000.0D as f_distancia", "22L as segments")
    rows = routes.split(trips).orderBy("k_ruta", "segment").collect()
    shares = [[r.f_distancia for r in rows[k:k + 22]] for k in range(0, len(rows), 22)]
    assert all(abs(sum(s) - 100_000) < 1e-6 for s in shares)
    steps = {round(b - a) for s in shares for a, b in zip(s, s[1:])}
    assert len(steps) > 500

    def correlation(a, b):
        ma, mb = sum(a) / len(a), sum(b) / len(b)
        top = sum((x - ma) * (y - mb) for x, y in zip(a, b))
        return top / (sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b)) ** 0.5

    for lag in (1, 2, 3):
        assert abs(correlation([x for s in shares for x in s[:-lag]], [x for s in shares for x in s[lag:]])) < 0.1
    assert abs(correlation([x for s in shares[:-1] for x in s], [x for s in shares[1:] for x in s])) < 0.06


def test_long_trips_are_summed_over_runs_and_null_trip_ids_are_cut(spark):
    trips = spark.sql("""select k_ruta, timestamp'2024-01-01 00:00:00' as o_fecha_inicial, timestamp'2024-02-01 00:00:00' as o_fecha_final,
        1e6D as f_distancia, n as segments from values (cast(null as bigint), 5L), (3L, 5000L), (4L, 1024L), (5L, 1025L), (6L, 1L) as t(k_ruta, n)""")
    found = {}
    for r in routes.split(trips).collect():
        found.setdefault(r.k_ruta, []).append(r)
    assert {k: len(v) for k, v in found.items()} == {None: 5, 3: 5000, 4: 1024, 5: 1025, 6: 1}
    for rows in found.values():
        rows.sort(key=lambda r: r.segment)
        assert [r.segment for r in rows] == list(range(len(rows)))
        assert all(a.o_fecha_final == b.o_fecha_inicial for a, b in zip(rows, rows[1:]))
        mean = 1e6 / len(rows)
        assert len(rows) == 1 or all(0.75 * mean < r.f_distancia < 1.3 * mean for r in rows)


def test_each_source_has_its_own_output_form(spark, job):
    raw, _, owners, _ = job
    params = ParamSet([
        SourceParams("m", output_datetime_format="unix"),
        SourceParams("b", output_datetime_format="%Y-%m-%d %H:%M", column_rename_map=(("newID", "id"), ("k_dispositivo", "gpsID"), ("o_fecha_inicial", "timestampStart")))])
    rows = route_pipeline.process(raw, params, owners).final.collect()
    m, b = ([r for r in rows if r.source == s] for s in "mb")
    assert m and b and all(r.timestampstart.isdigit() and r.id is None and r.routeid for r in m)
    assert all("-" in r.timestampstart and r.id and r.routeid is None and r.timestampend is None for r in b)
