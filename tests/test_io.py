import datetime
import json
import types

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetledger import schemas, session
from fleetledger.sources import readers, writers

D1, D2 = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)


def final(spark, rows):
    return spark.createDataFrame(rows, schemas.ROUTES_FINAL)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_partition_overwrite_touches_only_its_partitions(spark, tmp_path, fmt):
    root = str(tmp_path / "routes")
    rows = [(1, "007", 0, 60, 5, "0x1", D1, "m"), (2, "008", 0, 60, 5, None, D1, "b"), (3, "009", 0, 60, 5, "0x1", D2, "m")]
    writers.write_partitioned(final(spark, rows), root, fmt=fmt)
    writers.write_partitioned(final(spark, [(9, "007", 1, 2, 3, "0x2", D1, "m")]), root, fmt=fmt)
    writers.write_partitioned(final(spark, [(9, "007", 1, 2, 3, "0x2", D1, "m")]), root, fmt=fmt)
    got = readers.read_partitioned(spark, root, schemas.ROUTES_FINAL, fmt, every_day=True)
    assert sorted(map(tuple, got.collect())) == sorted([(9, "007", 1, 2, 3, "0x2", D1, "m"), rows[1], rows[2]])
    day = readers.read_partitioned(spark, root, schemas.ROUTES_FINAL, fmt, day="2024-01-01")
    assert day.count() == 2
    assert all("date=2024-01-01" in f for f in day.inputFiles()) and day.columns == schemas.ROUTES_FINAL.names
    assert readers.read_partitioned(spark, root, schemas.ROUTES_FINAL, fmt, day="2024-01-05").count() == 0
    assert readers.read_partitioned(spark, root, schemas.ROUTES_FINAL, fmt, day=D2, source="m").first().gpsid == "009"


def test_empty_input_is_refused(spark, tmp_path):
    with pytest.raises(writers.EmptyInput):
        writers.write_partitioned(final(spark, []), str(tmp_path / "x"), non_empty=True)


def test_processing_date(spark):
    df = spark.sql("select date_sub(current_date(), 1) as date union all select date'2024-01-01'")
    assert readers.on_date(df).count() == 1 and readers.on_date(df, "2024-01-01").count() == 1
    with pytest.raises(ValueError):
        readers.on_date(df, "01/01/2024")


def test_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("k_dispositivo,f_distancia\n007,1.5\nx,\n")
    schema = T.StructType([T.StructField("k_dispositivo", T.StringType()), T.StructField("f_distancia", T.DoubleType())])
    assert list(map(tuple, readers.read_csv(spark, str(tmp_path / "r.csv"), schema).collect())) == [("007", 1.5), ("x", None)]
    (tmp_path / "bad.csv").write_text("k_dispositivo,f_distancia\n007,far\ny,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
    kept = readers.read_csv(spark, str(tmp_path / "bad.csv"), schema, strict=False).cache().collect()
    assert [r._corrupt_record for r in kept] == ["007,far", None]
    (tmp_path / "other.csv").write_text("f_distancia,k_dispositivo\n1,007\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv(spark, str(tmp_path / "other.csv"), schema).collect()


def test_ledger_before_and_after_the_first_run(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert readers.read_ledger(spark, path, "staging", every_day=True).count() == 0
    rows = [("staging", D1, 1, "sent", 5, 7, "0x"), ("production", D1, 1, "already_minted", None, None, None)]
    writers.write_ledger(spark.createDataFrame(rows, schemas.LEDGER), path)
    stored = readers.read_ledger(spark, path, "staging", D1)
    assert [r.route_id for r in stored.collect()] == [1]
    more = stored.unionByName(spark.createDataFrame([("staging", D1, 2, "sent", 6, 7, "0x")], schemas.LEDGER))
    writers.write_ledger(more, path)  # rewrites the partition it reads
    assert sorted(r.route_id for r in readers.read_ledger(spark, path, "staging", D1).collect()) == [1, 2]
    assert readers.read_ledger(spark, path, "production", D1).count() == 1


def test_envelope(spark, tmp_path):
    record = T.StructType([T.StructField("k_ruta", T.LongType()), T.StructField("k_dispositivo", T.StringType())])
    docs = [{"body": [{"k_ruta": 1, "k_dispositivo": "007", "more": 1}, {"k_ruta": 2}]}, {"body": []}]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d) for d in docs))
    assert sorted(map(tuple, readers.land_envelope(spark, str(tmp_path / "d.json"), record).collect())) == [(1, "007"), (2, None)]
    text = spark.createDataFrame([(json.dumps(docs[0]),)], "value string")
    assert readers.parse_envelope(text, record).count() == 2


def test_records_and_events(spark, tmp_path):
    rows = [{"id": "a", "fields": {"client_id": 1, "gps_id_list": ["G"]}}, {"id": "b", "fields": {}}]
    (tmp_path / "c.json").write_text("\n".join(json.dumps(r) for r in rows))
    got = readers.read_records(spark, str(tmp_path / "c.json"), schemas.CONTACTS, ["client_id"], "size(fields.gps_id_list) > 0")
    assert [(r.id, r.fields.asDict()) for r in got.collect()] == [("a", {"client_id": 1})]
    log = [("RouteRecorded", b, b, ("0x", b, 0, 1, 2)) for b in range(5)] + [("Transfer", 2, 9, ("0x", 9, 0, 1, 2))]
    spark.createDataFrame(log, schemas.LEDGER_EVENTS).write.parquet(str(tmp_path / "e"))
    found = readers.read_events(spark, str(tmp_path / "e"), "RouteRecorded", 1, 3)
    assert sorted(r.token_id for r in found.collect()) == [1, 2, 3]


def test_documents_and_lists(spark, tmp_path):
    (tmp_path / "p.yaml").write_text('{"distance_filter": {"min": 147}}')
    assert readers.read_document(spark, str(tmp_path / "p.yaml")) == {"distance_filter": {"min": 147}}
    (tmp_path / "l.csv").write_text("k_dispositivo\n007\n")
    assert [r[0] for r in readers.read_device_list(spark, str(tmp_path / "l.csv")).collect()] == ["007"]


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "z")], "id string, n int, v string")
    new = spark.createDataFrame([("a", "y"), ("c", None), ("q", "w")], "id string, v string")
    assert sorted(map(tuple, writers.upsert(base, new, "id", ["v"]).collect()), key=str) == [("a", 1, "y"), ("b", 2, None), ("c", 3, "z")]
    other = new.withColumnRenamed("v", "u")
    assert writers.upsert(base, other, "id", {"v": "u"}).where("id = 'a'").first().v == "y"


def test_pinned_table(spark):
    df = spark.range(10).withColumn("r", F.rand())
    pinned = session.pin(df)
    assert sorted(map(tuple, pinned.collect())) == sorted(map(tuple, pinned.collect()))


class Cluster:
    """Stands in for a session on a cluster."""

    def __init__(self, folder):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = types.SimpleNamespace(master="yarn", applicationId="app")


def test_shared_folder_setting():
    assert session.work_dir(Cluster("hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    with pytest.raises(ValueError):
        session.work_dir(Cluster(None))
