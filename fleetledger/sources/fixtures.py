"""Adapters: the library's input shapes from the benchmark tables.

Each function reads whole tables from one folder. The same definitions for DuckDB
are in ``fleetledger.queries.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetledger.params import ParamSet, Range, SourceParams, SplitRule
from fleetledger.session import configure

# Default parameters of both sources, and the prototype address.
DISTANCE = Range(147)
DURATION = Range(2, 90)
MAX_PER_HOUR = 60_000
SPLIT = SplitRule(max_distance=4_200, avg_distance=2_000)
PROTOTYPE_ADDRESS = "0x" + "9" * 40

# Declared, so that opening a table reads no file footers.
_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}

_ROUTES_RAW = """
select event_id as k_ruta, concat('GPS', lpad(cast(user_id as string), 5, '0')) as k_dispositivo,
  date_format(cast(ts as timestamp), 'yyyy-MM-dd HH:mm:ss') as o_fecha_inicial,
  date_format(timestamp_seconds(unix_seconds(cast(ts as timestamp)) + (event_id * 37) % 7200), 'yyyy-MM-dd HH:mm:ss') as o_fecha_final,
  value * 100.0D as f_distancia,
  case when user_id % 11 = 0 then null else concat('client-', cast(user_id as string)) end as Referencia,
  -7408000000 + event_id * 13 as lng_inicial, 471000000 + event_id * 7 as lat_inicial,
  -7408000000 + event_id * 13 + user_id * 1000 as lng_final, 471000000 + event_id * 7 - user_id * 1000 as lat_final,
  case when user_id % 2 = 0 then 'motorbike' else 'bicycle' end as source, cast(ts as date) as date
from {events}
"""

_CONTACTS = """
select concat('rec', cast(c_custkey as string)) as id,
  named_struct('client_id', c_custkey + 1,
    'gps_id_list', case when 2 * c_custkey + 1 <= (select cast(floor(max(user_id) * 14 / 15) as bigint) from {events})
       then array(concat('GPS', lpad(cast(2 * c_custkey as string), 5, '0')), concat('GPS', lpad(cast(2 * c_custkey + 1 as string), 5, '0')))
       else cast(array() as array<string>) end,
    'celo_address', case when c_custkey % 7 = 0 then null
       else concat('0x', md5(concat('a|', cast(c_custkey as string))), substr(md5(concat('b|', cast(c_custkey as string))), 1, 8)) end) as fields
from {customer}
"""

_KNOWN_UNASSIGNED = """
select distinct concat('GPS', lpad(cast(user_id as string), 5, '0')) as k_dispositivo
from {events}
where user_id = 10
  or (user_id > (select cast(floor(max(user_id) * 14 / 15) as bigint) from {events}) and user_id % 10 >= 5)
"""

_PROTOTYPES = """
select distinct concat('GPS', lpad(cast(user_id as string), 5, '0')) as k_dispositivo
from {events}
where user_id = 11
  or (user_id > (select cast(floor(max(user_id) * 14 / 15) as bigint) from {events}) and user_id % 2 = 1 and user_id % 10 < 5)
"""

_ATTEMPTS = """
select cast(ts as date) as date, event_id as seq, event_id + 1 as route_id,
  case when event_type = 'error' and event_id % 53 = 0 then 'nonce too low'
       when event_type = 'error' and event_id % 5 = 0 then 'execution reverted: ERC721: token already minted'
       else 'ok' end as message,
  2 + event_id % 11 as cost, 7000 + event_id as nonce, 100 + event_id % 5 as gas_price,
  concat('0x', md5(concat('sent', cast(event_id as string)))) as tx_hash
from {events}
"""

_LEDGER = """
select 'staging' as environment, cast(ts as date) as date, event_id + 1 as route_id,
  case when event_id % 6 = 0 then 'already_minted' else 'sent' end as status,
  case when event_id % 6 = 0 then null else event_id end as nonce,
  case when event_id % 6 = 0 then null else 90 + event_id % 3 end as gas_price,
  case when event_id % 6 = 0 then null else concat('0x', md5(cast(event_id as string))) end as tx_hash
from {events} where event_id % 3 = 0
"""

_ROUTE_EVENTS = """
select event_id as seq, cast(floor(event_id / 2) as bigint) + 1 as token_id,
  concat('0x', md5(cast(user_id as string)), '00000000') as to,
  unix_seconds(cast(ts as timestamp)) as timestamp_start,
  unix_seconds(cast(ts as timestamp)) + (event_id * 37) % 7200 as timestamp_end,
  cast(bround(value * 100.0D, 0) as bigint) as distance
from {events}
"""

_CREDITS_RAW = """
select concat('rec', cast(o_orderkey as string)) as id,
  named_struct('credit_id', o_orderkey + 1, 'client_link', array(concat('rec', cast(o_custkey as string))),
    'investment', o_totalprice * 0.8D, 'initial_debt', o_totalprice,
    'disbursed', concat(date_format(cast(o_orderdate as timestamp), "yyyy-MM-dd'T'HH:mm:ss.SSS"), case when o_orderkey % 2 = 0 then 'Z' else '' end),
    'term_text', concat(cast(4 + o_orderkey % 20 as string), ' semanas'),
    'client_address', case when o_orderkey % 3 = 0 then array(concat('0x', md5(cast(o_custkey as string)), '11111111')) end,
    'published_staging', case when o_orderstatus = 'F' then true when o_orderstatus = 'O' then false end) as fields
from {orders}
"""

_PAYMENTS_RAW = """
select concat('rec', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string)) as id,
  named_struct('payment_id', l_orderkey * 10 + l_linenumber + 1, 'credit_id', l_orderkey + 1, 'amount', l_extendedprice,
    'payment_date', date_format(cast(l_shipdate as timestamp), 'yyyy-MM-dd'), 'published_staging', l_returnflag = 'R') as fields
from {lineitem}
"""

_PUBLISH_LOG = """
select event_id div 100 as stream, event_id % 100 as line_no,
  case when event_id % 100 = 0 then concat('[INFO] t r Parameters: environment: staging, processing date: ', date_format(cast(ts as timestamp), 'yyyy-MM-dd'), ' 00:00:00')
       when event_type = 'view' then concat('[INFO] t r Publishing route id ', cast(event_id as string), ', with: nonce = 1')
       when event_type = 'click' then concat('[INFO] t r     -> Transaction successfully sent: route id ', cast(event_id as string))
       when event_type = 'purchase' then concat('[INFO] t r Token already minted for route id ', cast(event_id as string))
       when event_type = 'error' then concat('[ERROR] t r     -> Error publishing route id ', cast(event_id as string), ': ',
         case event_id % 4 when 0 then 'insufficient funds for gas' when 1 then 'method handler crashed' when 2 then 'nonce too low' else 'replacement transaction underpriced' end)
       else '[INFO] t r     -> no receipt yet' end as line
from {events}
"""


class Fixtures:
    """The adapted tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = self.spark.read.schema(_TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        return self.tables[name]

    def _adapt(self, sql: str, *tables: str) -> DataFrame:
        return self.spark.sql(sql, **{t: self.table(t) for t in tables})

    def routes_raw(self) -> DataFrame:
        return self._adapt(_ROUTES_RAW, "events")

    def contacts(self) -> DataFrame:
        return self._adapt(_CONTACTS, "customer", "events")

    def known_unassigned(self) -> DataFrame:
        return self._adapt(_KNOWN_UNASSIGNED, "events")

    def prototypes(self) -> DataFrame:
        return self._adapt(_PROTOTYPES, "events")

    def attempts(self) -> DataFrame:
        return self._adapt(_ATTEMPTS, "events")

    def ledger(self) -> DataFrame:
        return self._adapt(_LEDGER, "events")

    def route_events(self) -> DataFrame:
        return self._adapt(_ROUTE_EVENTS, "events")

    def credits_raw(self) -> DataFrame:
        return self._adapt(_CREDITS_RAW, "orders")

    def payments_raw(self) -> DataFrame:
        return self._adapt(_PAYMENTS_RAW, "lineitem")

    def publish_log(self) -> DataFrame:
        return self._adapt(_PUBLISH_LOG, "events")

    @staticmethod
    def params(output_datetime_format: str = "unix") -> ParamSet:
        return ParamSet(
            SourceParams(
                source=source, output_datetime_format=output_datetime_format, distance=DISTANCE, duration=DURATION,
                max_per_hour=MAX_PER_HOUR, split=SPLIT, prototype_address=address)
            for source, address in (("motorbike", None), ("bicycle", PROTOTYPE_ADDRESS)))
