import datetime
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetledger.functions import scalars, times
from fleetledger.operators import routes

NAN = float("nan")


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_range_bounds(spark):
    rows = [(x,) for x in (147.0, 147.5, 200.0, 200.5, NAN, None, float("inf"))]
    got = values(spark, rows, "d double", scalars.in_range("d", 147, 200))
    assert [bool(r[0]) for r in got] == [False, True, True, False, False, False, False]
    for unbounded in (None, 0):
        got = values(spark, rows, "d double", scalars.in_range("d", 147, unbounded))
        assert [bool(r[0]) for r in got] == [False, True, True, True, False, False, True]


def test_cap_leaves_missing_values(spark):
    rows = [(10.0, 5.0), (5.0, 10.0), (NAN, 5.0), (None, 5.0), (5.0, None), (1.0, -2.0)]
    got = [r[0] for r in values(spark, rows, "d double, c double", scalars.capped("d", "c"))]
    assert got[0] == 5.0 and got[1] == 5.0 and math.isnan(got[2]) and got[3] is None
    assert got[4] == 5.0 and got[5] == -2.0


def test_segment_count_is_exact(spark):
    distances = [0.0, 4200.0, 4200.01, 6000.0, 8000.0, 8000.5, 0.3, 1e6 + 0.1, NAN, None]

    def expected(d, top=4200.0, avg=2000.0):
        if d is None or math.isnan(d) or d <= top:
            return 1
        return int(d // avg) + (1 if math.fmod(d, avg) else 0)

    got = [r[0] for r in values(spark, [(d,) for d in distances], "d double", scalars.segment_count("d", 4200, 2000))]
    assert got == [expected(d) for d in distances]
    # 0.3 is just under 3 * 0.1 in binary: a rounded-up quotient would miss the remainder
    fine = [r[0] for r in values(spark, [(0.3,), (0.7,), (1.1,)], "d double", scalars.segment_count("d", 0.2, 0.1))]
    assert fine == [int(d // 0.1) + (1 if d % 0.1 else 0) for d in (0.3, 0.7, 1.1)]


def test_rounding_and_truncation(spark):
    got = values(spark, [(2.5,), (3.5,), (-2.5,), (2.51,)], "d double", scalars.round_half_even("d"))
    assert [r[0] for r in got] == [2, 4, -2, 3]
    got = values(spark, [(2.9,), (-2.9,), (None,)], "d double", scalars.whole_number("d", strict=False))
    assert [r[0] for r in got] == [2, -2, None]
    assert [r[0] for r in values(spark, [(2.9,), (-2.9,)], "d double", scalars.whole_number("d"))] == [2, -2]
    with pytest.raises(PySparkException):  # a required number is missing
        values(spark, [(None,)], "d double", scalars.whole_number("d"))


def test_term_days(spark):
    rows = [("45 o bien 6 semanas",), ("semanas: 6",), (None,), ("12",)]
    assert [r[0] for r in values(spark, rows, "t string", scalars.term_days("t"))] == [315, 42, None, 84]
    assert values(spark, [("none",)], "t string", scalars.term_days("t", strict=False)) == [(None,)]
    with pytest.raises(PySparkException):
        values(spark, [("none",)], "t string", scalars.term_days("t"))


def test_outcome_texts(spark):
    rows = [("ok",), ("execution reverted: ERC721: token already minted",), ("nonce too low",),
            ("execution reverted: Panic error 0x11",), ("Reverted",)]
    got = values(spark, rows, "m string", scalars.route_status("m"), scalars.payment_status("m"))
    assert [r[0] for r in got] == ["sent", "already_minted", "failed", "failed", "failed"]
    assert [r[1] for r in got] == ["sent", "revert", "error", "overflow", "revert"]


def test_link_fields(spark):
    rows = [(["a", "b"],), ([],), (None,), ([""],)]
    got = values(spark, rows, "x array<string>", scalars.first_of("x"), scalars.non_empty("try_element_at(x, 1)"))
    assert got == [("a", "a"), (None, None), (None, None), ("", None)]


def test_patterns():
    assert times.to_pattern("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert times.to_pattern("%m/%d/%y %H:%M", parsing=True) == "M/d/yy H:m"
    assert times.to_pattern("%Y%m%d", parsing=True) == "yyyyMMdd"
    assert times.to_pattern("%Y-%m-%dT%H:%M:%S.%f") == "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    with pytest.raises(ValueError):
        times.to_pattern("%Q")


def parsed(spark, texts, fmt, strict=False):
    rows = values(spark, [(t,) for t in texts], "t string", F.unix_micros(times.parse_time("t", fmt, strict)))
    return [r[0] for r in rows]


def python_micros(text, fmt):
    try:
        at = datetime.datetime.strptime(text, fmt).replace(tzinfo=datetime.timezone.utc)
    except ValueError:
        return None
    return (at - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)) // datetime.timedelta(microseconds=1)


@pytest.mark.parametrize("fmt, texts", [
    ("%Y-%m-%d %H:%M:%S", ["2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-1-2 3:4:5", "2024-01-02", "2024-01-02T03:04:05",
                           "2024-01-02 03:04:5Z", "2024-13-01 00:00:00", "", "2024-01-02 03:04:05 x", "1969-12-31 23:59:59"]),
    ("%m/%d/%y %H:%M", ["1/5/23 7:05", "01/05/23 07:05", "12/31/70 23:59", "12/31/68 23:59", "13/1/23 00:00"]),
    ("%Y-%m-%dT%H:%M:%S.%f", ["2024-01-02T03:04:05.678", "2024-01-02T03:04:05.678901", "2024-01-02T03:04:05"]),
    ("%Y-%m-%d", ["2024-01-02", "2024-1-2", "2024-01-02 00:00:00"]),
])
def test_parsing_agrees_with_strptime(spark, fmt, texts):
    assert parsed(spark, texts, fmt) == [python_micros(t, fmt) for t in texts]


def test_strict_parsing_raises(spark):
    for text in ("2024-13-01 00:00:00", "yesterday"):
        with pytest.raises(PySparkException):
            parsed(spark, [text], "%Y-%m-%d %H:%M:%S", strict=True)


def test_epoch_and_zulu(spark):
    rows = [("2024-01-02T03:04:05.000Z",), ("2024-01-02T03:04:05.999",)]
    got = values(spark, rows, "t string", times.epoch_seconds(times.strip_zulu("t"), "%Y-%m-%dT%H:%M:%S.%f"))
    assert [r[0] for r in got] == [1704164645, 1704164645]
    half = values(spark, [(-500_000,)], "us bigint", times.format_time(F.timestamp_micros("us"), "unix"))
    assert half == [(-1,)]


def test_locations(spark):
    df = spark.createDataFrame([(-7408000000, 471000000, 0, 1)], "lng_inicial bigint, lat_inicial bigint, lng_final bigint, lat_final bigint")
    row = routes.gps_points(df).first()
    assert (row.startLocation.lng, row.startLocation.lat, row.endLocation.lat) == (-74.08, 4.71, 1e-08)
    assert row.lng_inicial == -74.08
