"""The queries on tables where one key, or copies of one row, hold a third of all rows."""

import duckdb
import pytest

import __spark_entry__ as entry

SOURCE = "/root/testdata/sf0.001"
TABLES = ("customer", "events", "lineitem", "orders")
HOT = {
    "events": """select event_id, case when event_id % 3 = 0 then timestamp '2024-01-05 10:00:00.5' else ts end as ts,
        case when event_id % 3 = 0 then 8 else user_id end as user_id, event_type, value, props from t""",
    "lineitem": "select case when l_partkey % 3 = 0 then 77 else l_orderkey end as l_orderkey, * exclude l_orderkey from t",
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey) from t",
}
COPIES = {
    "events": "select * from t where event_id % 3 <> 0 union all select e.* from (select * from t where event_id = 501) e, range(333)",
    "lineitem": "select * from t where l_partkey % 3 <> 0 union all select e.* from (select * from t limit 1) e, range(2000)",
    "orders": "select * from t union all select e.* from (select * from t where o_orderkey = 10) e, range(500)",
}
QUERIES = [
    "daily_driver_metrics", "route_split", "route_ids", "route_ids_stable", "routes_final", "device_alert", "unassigned_devices",
    "ledger_merge", "publish_prefix", "publish_budget", "publish_nonces", "ledger_first_write", "credits_state", "credit_addresses",
    "payment_dedup", "payment_balances", "payment_outcomes", "credit_outstanding", "publish_log_stats", "publish_log_dates",
    "publish_log_files", "landing_envelope"]


@pytest.fixture(scope="module", params=[HOT, COPIES], ids=["hot", "copies"])
def tables(request, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for name in TABLES:
        sql = request.param.get(name, "select * from t")
        con.execute(f"copy (with t as (select * from '{SOURCE}/{name}.parquet') {sql}) to '{folder}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, name):
    folder, con = tables
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    cursor = con.execute(entry.oracle_sql()[name])
    places = [[c[0] for c in cursor.description].index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
