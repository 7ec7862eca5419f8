import random

import pytest
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import ids, ordering


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_numbering_is_dense_and_ordered_for_any_partitioning(spark, parts):
    rows = [("2024-01-0%d" % (i % 3 + 1), "ab"[i % 2], (i * 7919) % 1000, 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "date string, source string, k_ruta bigint, segment bigint").repartition(parts)
    got = {(r.date, r.source, r.k_ruta): r.newID for r in ids.assign(df).collect()}
    assert [got[k] for k in sorted(got)] == list(range(100_001, 101_001))


def test_numbering_with_a_third_of_rows_equal(spark):
    rows = [(1 if i % 3 == 0 else i, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, v string").repartition(6)
    numbered = ordering.number_rows(df, ["k"], "n")
    got = numbered.orderBy("n").collect()
    assert [r.n for r in got] == list(range(3000))
    assert [r.k for r in got] == sorted(r[0] for r in rows)


def test_numbering_without_order_and_of_nothing(spark):
    df = spark.range(100).repartition(5)
    assert sorted(r.n for r in ordering.number_rows(df, [], "n").collect()) == list(range(100))
    assert ordering.number_rows(df.where("id < 0"), ["id"], "n").count() == 0


@pytest.mark.parametrize("hot_rows", [5, 50, 10_000])
def test_running_total_equals_brute_force(spark, hot_rows):
    rng = random.Random(hot_rows)
    rows = []
    for i in range(900):
        group = 7 if i % 3 == 0 else rng.randrange(40)  # one group holds a third
        rows.append((group, rng.choice([10, 10, 10, 11, 12]), i * 13 % 9001, rng.randrange(100)))
    df = spark.createDataFrame(rows, "g int, day bigint, id bigint, v bigint")
    got = {r.id: r.total for r in ordering.running_total(
        df, "g", ["day", "id"], "v", "total", hot_rows=hot_rows).collect()}
    sums, expected = {}, {}
    for group, _, key, value in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[group] = sums.get(group, 0) + value
        expected[key] = sums[group]
    assert got == expected


def test_hot_group_is_spread_over_blocks(spark):
    df = spark.range(1000).selectExpr("1 as g", "0L as day", "id", "1L as v")
    out = ordering.running_total(df, "g", ["day", "id"], "v", "total", hot_rows=100)
    assert [r.total for r in out.orderBy("id").collect()] == list(range(1, 1001))
    assert "_slice" in out._jdf.queryExecution().optimizedPlan().toString()


def test_clustered_values_are_cut_by_rows(spark):
    """Nearly all of a hot group's order values lie together; its slices are even all the same."""
    df = spark.range(2_000).selectExpr("1 as g", "if(id = 0, -1000000000000L, id) as k", "1L as v")
    out = ordering.running_total(df, "g", ["k"], "v", "total", hot_rows=100)
    assert [r.total for r in out.orderBy("k").collect()] == list(range(1, 2_001))
    pinned = next(line for line in out.inputFiles())
    sizes = [r["count"] for r in spark.read.parquet(pinned.rsplit("/", 1)[0]).groupBy("_slice").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 400


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_the_size_of_a_group_changes_no_total(spark, hot_rows):
    rows = [(1, None, 5, 30), (1, None, 6, 20), (1, -90_000, 9, 20), (1, -1, 2, 7), (1, 0, 1, 1), (1, 86_400, 1, 2), (2, None, 1, 4), (None, 1, 1, 8)]
    df = spark.createDataFrame(rows, "g int, day bigint, id bigint, v bigint")
    owed = spark.createDataFrame([(1, 100), (3, 5)], "g int, owed bigint")
    got = sorted(map(str, ordering.running_total(df, "g", ["day", "id"], "v", "total", hot_rows=hot_rows, per_group=owed).collect()))
    want = [(1, None, 5, 30, 100, 30), (1, None, 6, 20, 100, 50), (1, -90_000, 9, 20, 100, 70), (1, -1, 2, 7, 100, 77), (1, 0, 1, 1, 100, 78),
            (1, 86_400, 1, 2, 100, 80), (2, None, 1, 4, None, 4), (None, 1, 1, 8, None, 8)]
    frame = spark.createDataFrame(want, "g int, day bigint, id bigint, v bigint, owed bigint, total bigint")
    assert got == sorted(map(str, frame.collect()))


def test_first_per_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), ("b", 5, None), ("b", 5, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert sorted(map(tuple, ordering.first_per_key(df, "k", ["o"]).collect())) == [("a", 1, "y"), ("b", 5, None)]


def test_stable_ids(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "m", k or None, s, "v1") for k in range(20) for s in range(2)],
        "date string, source string, k_ruta bigint, segment bigint, params_version string").withColumn("date", F.col("date").cast("date"))
    none = spark.createDataFrame([], schemas.ID_ASSIGNMENTS)
    first, added = ids.assign_stable(df.where("k_ruta is null or k_ruta < 10"), none)
    assert sorted(r.newID for r in first.collect()) == list(range(100_001, 100_021))
    again, more = ids.assign_stable(df, added)
    old = {(r.k_ruta, r.segment): r.newID for r in first.collect()}
    new = {(r.k_ruta, r.segment): r.newID for r in again.collect()}
    assert all(new[k] == v for k, v in old.items())
    assert sorted(r.route_id for r in more.collect()) == list(range(100_021, 100_041))
    rerun, nothing = ids.assign_stable(df, added.unionByName(more))
    assert {(r.k_ruta, r.segment): r.newID for r in rerun.collect()} == new and nothing.count() == 0
    other, _ = ids.assign_stable(df.withColumn("params_version", F.lit("v2")), added.unionByName(more))
    assert not set(new.values()) & {r.newID for r in other.collect()}  # cut by other rules, they are other segments


def test_runs_that_share_marks_share_no_id(spark, tmp_path):
    marks = str(tmp_path / "marks")
    assert [ids.reserve(spark, marks, run, n) for run, n in (("a", 5), ("b", 0), ("c", 7), ("a", 5), ("a", 6))] == [
        100_000, 100_005, 100_005, 100_000, 100_012]
    asked = []
    df = spark.range(4).withColumnRenamed("id", "k")
    got = ids.assign(df, ["k"], base=lambda count: asked.append(count) or 50).orderBy("k").collect()
    assert asked == [4] and [r.newID for r in got] == [51, 52, 53, 54]


def test_missing_order_column_raises(spark):
    with pytest.raises(ValueError):
        ids.assign(spark.range(3))
