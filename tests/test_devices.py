import pytest
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import devices
from fleetledger.plans import device_sync

ROUTES = "k_ruta int, k_dispositivo string, celo_address string"


@pytest.fixture(scope="module")
def contacts(spark):
    rows = [("r1", (1, ["A", "B"], "0x1")), ("r2", (2, ["C"], None)), ("r3", (3, [], None)), ("r4", (4, None, None)),
            ("r5", (5, ["D"], ""))]
    return spark.createDataFrame(rows, schemas.CONTACTS)


def test_map_and_updates(contacts):
    derive = lambda c: F.concat(F.lit("d"), c.cast("string"))
    device_map, updates, conflicts = devices.build_map(contacts, derive)
    assert dict(map(tuple, device_map.collect())) == {"A": "0x1", "B": "0x1", "C": "d2", "D": "d5"}
    assert dict(map(tuple, updates.collect())) == {"r2": "d2", "r5": "d5"}
    assert conflicts.count() == 0
    after = device_sync.sync(contacts, derive)[1]
    assert {r.id: r.fields.celo_address for r in after.collect()} == {"r1": "0x1", "r2": "d2", "r3": None, "r4": None, "r5": "d5"}


@pytest.mark.parametrize("extra", [("r9", (9, ["A"], "0x9")), ("r9", (9, ["Z", "Z"], "0x9"))])
def test_device_claimed_twice(spark, contacts, extra):
    doubled = contacts.unionByName(spark.createDataFrame([extra], schemas.CONTACTS))
    device_map, _, conflicts = devices.build_map(doubled)
    claimed = extra[1][1][0]
    assert [tuple(r) for r in conflicts.collect()] == [(claimed, 2)]
    assert claimed not in [r[0] for r in device_map.select("k_dispositivo").collect()]
    with pytest.raises(devices.DeviceConflict):
        device_sync.sync(doubled)


def test_override_fills_only_missing(spark):
    df = spark.createDataFrame([(1, "P", None), (2, "P", "0x1"), (3, "Q", None), (4, None, None)], ROUTES)
    listed = spark.createDataFrame([("P",), ("P",)], "k_dispositivo string")
    got = {r.k_ruta: r.celo_address for r in devices.override(df, listed, "0xF").collect()}
    assert got == {1: "0xF", 2: "0x1", 3: None, 4: None}


def test_lists(spark):
    df = spark.createDataFrame([(1, "K", None), (2, "H", "0x1"), (3, "N", None), (4, None, None)], ROUTES)
    listed = spark.createDataFrame([("K",), ("H",), ("X",)], "k_dispositivo string")
    known = devices.known_unassigned(df, listed)
    assert [r[0] for r in known.collect()] == ["K"]
    assert sorted(r.k_ruta for r in devices.drop_devices(df, known).collect()) == [2, 3, 4]
    assert {r[0] for r in devices.unassigned(df, known).collect()} == {"N", None}


def test_alert_texts_hold_all_names(spark):
    df = spark.range(25).selectExpr("'s' as source", "format_string('G%02d', id) as k_dispositivo")
    got = devices.alert_texts(df.union(df), "source", per_text=10).orderBy("part").collect()
    assert [r.devices for r in got] == [10, 10, 5]
    assert ", ".join(r.device_list for r in got) == ", ".join(f"G{i:02d}" for i in range(25))


def test_device_table_has_one_row_per_device(spark):
    owners = spark.createDataFrame([("A", "0x1")], schemas.DEVICE_MAP)
    listed = spark.createDataFrame([("A",), ("B",), ("B",)], schemas.DEVICE_LIST)
    got = {r[0]: tuple(r[1:]) for r in devices.device_table(owners, listed, listed).collect()}
    assert got == {"A": ("0x1", True, True), "B": (None, True, True)}
