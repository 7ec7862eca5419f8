import datetime

import pytest

from fleetledger import schemas
from fleetledger.operators import ids
from fleetledger.sources import marks
from fleetledger.sources.fixtures import Fixtures
from fleetledger.streaming import incremental

DAY = datetime.date(2024, 1, 1)
OUT = "routeid bigint, gpsid string, measureddistance bigint, celo_address string, date date, source string, batch bigint"


def land(spark, folder, keys):
    rows = [(k, f"G{k % 3}", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 1000.0 * (k % 9 + 1), None, 0, 0, 0, 0, "motorbike", DAY)
            for k in keys]
    spark.createDataFrame(rows, schemas.ROUTES_RAW).coalesce(1).write.mode("append").parquet(folder)


def test_each_file_has_one_effect(spark, tmp_path):
    landing, output, checkpoint = (str(tmp_path / n) for n in ("landing", "output", "checkpoint"))
    owners = spark.createDataFrame([("G0", "0x0"), ("G1", "0x1")], schemas.DEVICE_MAP)

    def run():
        incremental.run_available(spark, landing, output, checkpoint, Fixtures.params(), owners, files_per_batch=1)
        return spark.read.schema(OUT).parquet(output).collect()

    land(spark, landing, range(10))
    land(spark, landing, range(10, 20))
    first = run()
    assert len({r.batch for r in first}) == 2
    assert sorted(r.routeid for r in first) == list(range(100_001, 100_001 + len(first)))
    assert sorted(map(tuple, run())) == sorted(map(tuple, first))  # nothing new, nothing changes
    land(spark, landing, range(20, 30))
    second = run()
    assert sorted(r.routeid for r in second) == list(range(100_001, 100_001 + len(second)))
    assert {tuple(r) for r in first} < {tuple(r) for r in second}
    per_trip = len(first) / 20
    assert abs(len(second) - 30 * per_trip) < 15


def test_batch_that_is_retried_overwrites_itself(spark, tmp_path):
    landing, output = str(tmp_path / "landing"), str(tmp_path / "output")
    owners = spark.createDataFrame([("G0", "0x0")], schemas.DEVICE_MAP)
    land(spark, landing, range(10))
    for attempt in ("one", "two"):  # a fresh checkpoint replays batch 0
        incremental.run_available(spark, landing, output, str(tmp_path / attempt), Fixtures.params(), owners)
    got = spark.read.schema(OUT).parquet(output)
    assert got.count() == got.select("routeid").distinct().count()
    assert got.agg({"routeid": "min"}).first()[0] == 100_001
    assert len(marks.numbers(spark, output + "_marks")) == 1


def test_what_is_no_route_is_reported(spark, tmp_path):
    landing, output, shared = (str(tmp_path / n) for n in ("landing", "output", "marks"))
    owners = spark.createDataFrame([("G0", "0x0")], schemas.DEVICE_MAP)
    land(spark, landing, range(6))
    bad = [(7, "G0", "soon", "2024-01-01 11:00:00", 1000.0, None, 0, 0, 0, 0, "motorbike", DAY),
           (None, "G0", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 1000.0, None, 0, 0, 0, 0, "motorbike", DAY)]
    spark.createDataFrame(bad, schemas.ROUTES_RAW).write.mode("append").parquet(landing)
    incremental.run_available(spark, landing, output, str(tmp_path / "c"), Fixtures.params(), owners, marks_path=shared)
    report = lambda name: spark.read.parquet(f"{output}_reports/{name}")
    assert sorted((str(r.k_ruta), r.reason) for r in report("quarantine").collect()) == [("7", "bad_time"), ("None", "missing_trip_id")]
    assert {r.k_dispositivo for r in report("unowned_devices").collect()} == {"G1", "G2"}
    assert report("split_summary").first().original_routes == 6
    top = spark.read.schema(OUT).parquet(output).agg({"routeid": "max"}).first()[0]
    assert ids.reserve(spark, shared, "a daily run", 1) == top  # the two kinds of job share the marks
    with pytest.raises(Exception):
        incremental.run_available(spark, landing, output, str(tmp_path / "d"), Fixtures.params(), owners, strict=True)
