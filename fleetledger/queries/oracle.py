"""The same results in ANSI SQL (DuckDB): own windows and sums, not the DataFrame plans'. Hashes are the same by need."""

from __future__ import annotations

_UB = "(select cast(floor(max(user_id) * 14 / 15) as bigint) from events)"
_GPS = "concat('GPS', lpad(cast({} as varchar), 5, '0'))"
_DERIVED = "concat('0x', substr(sha256(concat('client|', cast({} as varchar))), 1, 40))"
_PROTO = "'0x9999999999999999999999999999999999999999'"
# A segment's weight: 0.8 to 1.2 of the mean, in steps of 1/10000.
_X = "((k_ruta * 48271 + i * 69621 + 1) % 2147483647)"
_DRAW = f"(8000 + ({_X} * {_X} % 2147483647) * {_X} % 2147483647 % 4001)"
_BEFORE = "coalesce(sum(w) over (partition by k_ruta order by i rows between unbounded preceding and 1 preceding), 0)"


# name -> (names it reads, SQL)
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "routes_raw": ((), f"""
select event_id as k_ruta, {_GPS.format('user_id')} as k_dispositivo,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as o_fecha_inicial,
  strftime(make_timestamp((cast(floor(epoch(ts)) as bigint) + (event_id * 37) % 7200) * 1000000), '%Y-%m-%d %H:%M:%S') as o_fecha_final,
  value * 100.0::double as f_distancia,
  case when user_id % 11 = 0 then null else concat('client-', cast(user_id as varchar)) end as "Referencia",
  -7408000000 + event_id * 13 as lng_inicial, 471000000 + event_id * 7 as lat_inicial,
  -7408000000 + event_id * 13 + user_id * 1000 as lng_final, 471000000 + event_id * 7 - user_id * 1000 as lat_final,
  case when user_id % 2 = 0 then 'motorbike' else 'bicycle' end as source, strftime(ts, '%Y-%m-%d') as date
from events"""),
    "contacts": ((), f"""
select concat('rec', cast(c_custkey as varchar)) as id, c_custkey + 1 as client_id,
  case when 2 * c_custkey + 1 <= {_UB} then [{_GPS.format('2 * c_custkey')}, {_GPS.format('2 * c_custkey + 1')}]
    else cast([] as varchar[]) end as gps_id_list,
  case when c_custkey % 7 = 0 then null
    else concat('0x', md5(concat('a|', cast(c_custkey as varchar))), substr(md5(concat('b|', cast(c_custkey as varchar))), 1, 8)) end as celo_address
from customer"""),
    "known": ((), f"""
select distinct {_GPS.format('user_id')} as k_dispositivo from events
where user_id = 10 or (user_id > {_UB} and user_id % 10 >= 5)"""),
    "protos": ((), f"""
select distinct {_GPS.format('user_id')} as k_dispositivo from events
where user_id = 11 or (user_id > {_UB} and user_id % 2 = 1 and user_id % 10 < 5)"""),
    "attempts": ((), """
select strftime(ts, '%Y-%m-%d') as date, event_id as seq, event_id + 1 as route_id,
  case when event_type = 'error' and event_id % 53 = 0 then 'nonce too low'
       when event_type = 'error' and event_id % 5 = 0 then 'execution reverted: ERC721: token already minted'
       else 'ok' end as message,
  2 + event_id % 11 as cost, 7000 + event_id as nonce, 100 + event_id % 5 as gas_price,
  concat('0x', md5(concat('sent', cast(event_id as varchar)))) as tx_hash
from events"""),
    "ledger": ((), """
select 'staging' as environment, strftime(ts, '%Y-%m-%d') as date, event_id + 1 as route_id,
  case when event_id % 6 = 0 then 'already_minted' else 'sent' end as status,
  case when event_id % 6 = 0 then null else event_id end as nonce,
  case when event_id % 6 = 0 then null else 90 + event_id % 3 end as gas_price,
  case when event_id % 6 = 0 then null else concat('0x', md5(cast(event_id as varchar))) end as tx_hash
from events where event_id % 3 = 0"""),
    "route_events": ((), """
select event_id as seq, cast(floor(event_id / 2) as bigint) + 1 as token_id,
  concat('0x', md5(cast(user_id as varchar)), '00000000') as owner,
  cast(floor(epoch(ts)) as bigint) as timestamp_start,
  cast(floor(epoch(ts)) as bigint) + (event_id * 37) % 7200 as timestamp_end,
  cast(round_even(value * 100.0::double, 0) as bigint) as distance
from events"""),
    "credits": ((), """
select concat('rec', cast(o_orderkey as varchar)) as id, o_orderkey + 1 as credit_id,
  concat('rec', cast(o_custkey as varchar)) as client_record_id,
  cast(trunc(o_totalprice * 0.8::double) as bigint) as principal, cast(trunc(o_totalprice) as bigint) as total_repayment,
  cast(epoch(o_orderdate) as bigint) as issuance_date, (4 + o_orderkey % 20) * 7 as term_days,
  case when o_orderkey % 3 = 0 then concat('0x', md5(cast(o_custkey as varchar)), '11111111') end as own_address,
  o_orderstatus = 'F' as is_published
from orders"""),
    "totals": (("credits",), """
select credit_id, issuance_date, client_record_id, own_address, principal, total_repayment, term_days
from (select *, row_number() over (partition by credit_id order by issuance_date, id) as rn from credits) where rn = 1"""),
    "payments": ((), """
select concat('rec', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-', cast(l_partkey as varchar), '-', cast(l_suppkey as varchar)) as id,
  cast(l_orderkey * 10 + l_linenumber + 1 as bigint) as payment_id, l_orderkey + 1 as credit_id,
  cast(trunc(l_extendedprice) as bigint) as amount,
  cast(epoch(date_trunc('day', l_shipdate)) as bigint) as payment_date, l_returnflag = 'R' as is_published
from lineitem"""),
    "publish_log": ((), """
select event_id // 100 as stream, event_id % 100 as line_no,
  case when event_id % 100 = 0 then concat('[INFO] t r Parameters: environment: staging, processing date: ', strftime(ts, '%Y-%m-%d'), ' 00:00:00')
       when event_type = 'view' then concat('[INFO] t r Publishing route id ', cast(event_id as varchar), ', with: nonce = 1')
       when event_type = 'click' then concat('[INFO] t r     -> Transaction successfully sent: route id ', cast(event_id as varchar))
       when event_type = 'purchase' then concat('[INFO] t r Token already minted for route id ', cast(event_id as varchar))
       when event_type = 'error' then concat('[ERROR] t r     -> Error publishing route id ', cast(event_id as varchar), ': ',
         case event_id % 4 when 0 then 'insufficient funds for gas' when 1 then 'method handler crashed' when 2 then 'nonce too low' else 'replacement transaction underpriced' end)
       else '[INFO] t r     -> no receipt yet' end as line
from events"""),
    # routes
    "timed": (("routes_raw",), """
select *, (t1 - t0) / 1e6 / 60::double as minutes from (
  select *, epoch_us(strptime(o_fecha_inicial, '%Y-%m-%d %H:%M:%S')) as t0,
    epoch_us(strptime(o_fecha_final, '%Y-%m-%d %H:%M:%S')) as t1
  from routes_raw)"""),
    "capped": (("timed",), """
select *, case when f_distancia > minutes / 60::double * 60000::double then minutes / 60::double * 60000::double
  else f_distancia end as d
from timed where f_distancia > 147 and minutes > 2 and minutes <= 90"""),
    "counted": (("capped",), """
select *, case when d > 4200 then cast(round_even((d - d % 2000::double) / 2000::double, 0) as bigint)
  + case when d % 2000::double <> 0 then 1 else 0 end else 1 end as n
from capped"""),
    "weighted": (("counted",), f"""
select *, cast({_BEFORE} as hugeint) as before, cast(sum(w) over (partition by k_ruta) as hugeint) as whole
from (select *, case when n = 1 then 10000 else {_DRAW} end as w
  from (select *, unnest(range(0, n)) as i from counted))"""),
    "segments": (("weighted",), """
select *, case when n = 1 then t0 else t0 + (t1 - t0) * before // whole end as s_us,
  case when n = 1 then t1 else t0 + (t1 - t0) * (before + w) // whole end as e_us,
  case when n = 1 then d else d * w::double / whole::double end as seg_d
from weighted"""),
    "numbered": (("segments",), """
select *, row_number() over (order by date, source, k_ruta, i) as rn from segments"""),
    "device_map": (("contacts",), f"""
select gps as k_dispositivo, coalesce(celo_address, {_DERIVED.format('client_id')}) as celo_address
from (select *, unnest(gps_id_list) as gps from contacts)"""),
    "final": (("numbered", "device_map", "protos", "known"), f"""
select rn, k_dispositivo as gpsid, s_us // 1000000 as timestampstart, e_us // 1000000 as timestampend,
  cast(round_even(seg_d, 0) as bigint) as measureddistance, address as celo_address, date, source
from (select r.*, case when m.celo_address is null and source = 'bicycle' and k_dispositivo in (select k_dispositivo from protos)
    then {_PROTO} else m.celo_address end as address
  from numbered r left join device_map m using (k_dispositivo))
where not (address is null and k_dispositivo in (select k_dispositivo from known))"""),
    "owned": (("routes_raw", "device_map"), """
select k_ruta, k_dispositivo, celo_address from routes_raw left join device_map using (k_dispositivo)"""),
    "effective_known": (("owned", "known"), """
select k_dispositivo from known where k_dispositivo in (select k_dispositivo from owned where celo_address is null)"""),
    # publication
    "tried": (("attempts", "ledger"), """
select *, case when message like '%ERC721: token already minted%' then 'already_minted' when message = 'ok' then 'sent' else 'failed' end as status
from attempts where route_id not in (select route_id from ledger)"""),
    "completed": (("tried",), """
select t.* from tried t left join (select date, min(seq) as stop from tried where status = 'failed' group by date) s using (date)
where stop is null or seq < stop"""),
    "merged": (("ledger", "completed"), """
select environment, date, route_id, status, nonce, gas_price, tx_hash from ledger
union all
select 'staging', date, route_id, status, case when status = 'sent' then nonce end, case when status = 'sent' then gas_price end,
  case when status = 'sent' then tx_hash end
from completed where status <> 'failed'"""),
    # credits
    "accepted": (("payments",), """
select * from (select *, row_number() over (partition by payment_id order by payment_date, payment_id, amount, id) as rn from payments) where rn = 1"""),
    "summed": (("accepted",), """
select *, sum(amount) over (partition by credit_id order by payment_date, payment_id rows unbounded preceding) as paid from accepted"""),
    "applied": (("summed", "totals"), """
select s.id, s.payment_id, s.credit_id, s.amount, s.payment_date, cast(greatest(total_repayment - paid, 0) as bigint) as balance,
  cast(greatest(total_repayment - paid + amount, 0) - greatest(total_repayment - paid, 0) as bigint) as applied
from summed s join totals c using (credit_id)"""),
    "waiting": (("payments", "credits"), """
select * from payments where not is_published and credit_id in (select credit_id from credits where is_published)"""),
    "recorded": (("payments", "totals"), """
select payment_id, credit_id, greatest(total_repayment - paid + amount, 0) - greatest(total_repayment - paid, 0) as applied
from (select *, sum(amount) over (partition by credit_id order by payment_date, payment_id rows unbounded preceding) as paid
  from (select *, row_number() over (partition by payment_id order by payment_date, payment_id, amount, id) as rn
    from payments where is_published) where rn = 1) join totals using (credit_id)"""),
    "later": (("waiting", "recorded", "totals"), """
select *, greatest(owed - paid + amount, 0) - greatest(owed - paid, 0) as later_applied
from (select r.*, owed, case when rn = 1 then sum(case when rn = 1 then amount end)
    over (partition by r.credit_id order by payment_date, payment_id, rn rows unbounded preceding) end as paid
  from (select *, row_number() over (partition by payment_id order by payment_date, payment_id, amount, id) as rn
    from waiting where payment_id not in (select payment_id from recorded)) r
  join (select credit_id, total_repayment - coalesce(s, 0) as owed from totals
    left join (select credit_id, sum(applied) as s from recorded group by credit_id) using (credit_id)) t using (credit_id))"""),
    "dated": (("publish_log",), """
select *, coalesce(last_value(mark ignore nulls) over (partition by stream order by line_no rows between unbounded preceding and current row), '') as date
from (select *, case when line like '%Parameters:%' then string_split_regex(trim(line), '\\s+')[9] end as mark from publish_log)"""),
}


def _with(body: str, *views: str) -> str:
    """Put the named views, and those they read, before the query as CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _VIEWS[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        add(name)
    return "with " + ",\n".join(f"{n} as ({_VIEWS[n][1]})" for n in ordered) + "\n" + body.strip()


_STATS = """
select date,
  cast(sum(publishing) + sum(minted) as bigint) as routes, cast(sum(sent) + sum(minted) as bigint) as published,
  cast(sum(err) as bigint) as with_error, cast(sum(minted) as bigint) as already_minted, cast(sum(funds) as bigint) as insufficient_funds,
  cast(sum(crashed) as bigint) as handler_crashed, cast(sum(low) as bigint) as nonce_too_low, cast(sum(under) as bigint) as underpriced
from (select date, (line like '%Transaction successfully sent%')::int as sent, (line like '%Publishing route id%')::int as publishing,
    (line like '%Error publishing route id%')::int as err, (line like '%Token already minted%')::int as minted,
    (line like '%insufficient funds for gas%')::int as funds, (line like '%method handler crashed%')::int as crashed,
    (line like '%nonce too low%')::int as low, (line like '%replacement transaction underpriced%')::int as under
  from dated)
group by date having sum(publishing) > 0 order by date"""

_FINAL = """
select 100000 + rn as routeid, gpsid, timestampstart, timestampend, measureddistance, celo_address, date, source from final"""

_LEDGER = """select environment, date, route_id, status, cast(nonce as varchar) as nonce, cast(gas_price as varchar) as gas_price, tx_hash
from merged"""

_CONTACTS_AFTER = f"""
select id, case when {{}} then coalesce(celo_address, {_DERIVED.format('client_id')}) else celo_address end as celo_address from contacts"""

ORACLE: dict[str, str] = {
    "daily_driver_metrics": _with("""
select m.celo_address, date, count(*) as routes, cast(sum(e_us // 1000000 - s_us // 1000000) as bigint) as total_seconds,
  cast(sum(cast(round_even(seg_d, 0) as bigint)) as bigint) as total_distance
from segments left join device_map m using (k_dispositivo) group by m.celo_address, date""", "segments", "device_map"),
    "route_parse_duration": _with("select k_ruta, t0 // 1000000 as start_s, t1 // 1000000 as end_s, minutes from timed", "timed"),
    "route_distance_filter": _with("select k_ruta, f_distancia from routes_raw where f_distancia > 147 and f_distancia <= 20000", "routes_raw"),
    "route_duration_filter": _with('select k_ruta, minutes as "durationMinutes" from timed where minutes > 2 and minutes <= 90', "timed"),
    "route_reference_filter": _with('select k_ruta, "Referencia" from routes_raw where "Referencia" is not null', "routes_raw"),
    "route_distance_cap": _with("""
select k_ruta, case when f_distancia > bound then bound else f_distancia end as f_distancia, bound as "maxExpectedDistance"
from (select *, minutes / 60::double * 60000::double as bound from timed)""", "timed"),
    "route_segment_count": _with("""
select k_ruta, case when f_distancia > 4200 then cast(round_even((f_distancia - f_distancia % 2000::double) / 2000::double, 0) as bigint)
  + case when f_distancia % 2000::double <> 0 then 1 else 0 end else 1 end as segments from routes_raw""", "routes_raw"),
    "route_split_summary": _with("""
select date, source, count(*) as original_routes, cast(sum(n) as bigint) as new_routes, cast(sum(n) - count(*) as bigint) as extra_routes
from counted group by date, source""", "counted"),
    "route_split": _with("select k_ruta, i as segment, s_us as start_us, e_us as end_us, seg_d as f_distancia from segments", "segments"),
    "route_over_long_segments": _with("select count(*) as over_long_segments from segments where seg_d > 4200", "segments"),
    "route_ids": _with('select 100000 + rn as "newID", k_ruta, i as segment from numbered', "numbered"),
    "route_ids_stable": _with("""
select 100000 + dense_rank() over (order by case when source = 'motorbike' then 0 else 1 end, date, k_ruta, i) as "newID",
  source, k_ruta, i as segment from segments""", "segments"),
    "route_ids_two_days": _with("""
select 100000 + row_number() over (order by case when date <= '2024-01-15' then 0 else 1 end, date, source, k_ruta, i) as "newID",
  source, k_ruta, i as segment from segments""", "segments"),
    "route_accounting": _with("""
select date, source, count(*) as came_in,
  cast(sum(case when source = 'motorbike' and f_distancia > 147 and minutes > 2 and minutes <= 90 then 1 else 0 end) as bigint) as kept,
  cast(sum(case when source <> 'motorbike' then 1 else 0 end) as bigint) as set_aside,
  cast(sum(case when source = 'motorbike' and not (f_distancia > 147 and minutes > 2 and minutes <= 90) then 1 else 0 end) as bigint) as out_of_range
from timed group by date, source""", "timed"),
    "log_time_range": _with("""
select cast(stream as varchar) as stream, concat(line_no, ' ', line) as line from publish_log
where line_no % 10 <> 3 and 1704067200 + stream * 3600 + line_no >= epoch(timestamp '2024-01-01 02:00:00')
  and 1704067200 + stream * 3600 + line_no < epoch(timestamp '2024-01-02 00:00:50')""", "publish_log"),
    "log_multi_file": _with(_STATS, "dated"),
    "routes_csv_scan": _with("select k_ruta, k_dispositivo, o_fecha_inicial, f_distancia from routes_raw", "routes_raw"),
    "device_map_stored": _with("select k_dispositivo, celo_address from device_map", "device_map"),
    "parameter_table": _with("""
select source, count(*) as trips, max(case when source = 'motorbike' and f_distancia > minutes / 60::double * 60000::double
  then minutes / 60::double * 60000::double else f_distancia end) as longest
from timed where (source = 'motorbike' and f_distancia > 147 and minutes > 2 and minutes <= 90) or (source = 'bicycle' and minutes > 1)
group by source""", "timed"),
    "count_metrics": _with("""
select count(*) as written, count(*) as rows, cast(sum(case when "Referencia" is null then 1 else 0 end) as bigint) as no_client from routes_raw""", "routes_raw"),
    "routes_incremental": _with("""
select source, count(*) as routes, count(*) as ids, cast(sum(measureddistance) as bigint) as distance from final group by source""", "final"),
    "credit_run_outcome": _with("""
, open as (select * from credits where not is_published),
stop as (select coalesce(min(credit_id), 9223372036854775807) as s from open where credit_id % 1009 = 1000),
done as (select * from open, stop where credit_id < s),
first as (select * from (select *, row_number() over (partition by credit_id order by issuance_date, id) as rn from done) where rn = 1)
select (select count(*) from open) as total, (select count(*) from done) as published,
  case when (select count(*) from open) = (select count(*) from done) then 1 else 0 end as all_success,
  (select count(*) from credits where is_published) + (select count(*) from done) as flagged,
  (select count(*) from first) as issued, (select cast(sum(total_repayment) as bigint) from first) as outstanding""", "credits"),
    "route_gps_points": _with("""
select k_ruta, lng_inicial / 1e8 as start_lng, lat_inicial / 1e8 as start_lat, lng_final / 1e8 as end_lng, lat_final / 1e8 as end_lat
from routes_raw""", "routes_raw"),
    "routes_formatted": _with("""
select k_ruta as "routeID", k_dispositivo as "gpsID",
  case when format = 'unix' then cast(t0 // 1000000 as varchar) else strftime(make_timestamp(t0), '%Y-%m-%d %H:%M') end as "timestampStart",
  case when format = 'unix' then cast(t1 // 1000000 as varchar) else strftime(make_timestamp(t1), '%Y-%m-%d %H:%M') end as "timestampEnd",
  cast(round_even(d, 0) as bigint) as "measuredDistance", celo_address, format
from capped left join device_map using (k_dispositivo)
cross join (values ('unix'), ('%Y-%m-%d %H:%M')) f(format)""", "capped", "device_map"),
    "routes_on_date": _with("select k_ruta, k_dispositivo, source, date from routes_raw where date = '2024-01-15'", "routes_raw"),
    "routes_final": _with(_FINAL, "final"),
    "routes_two_sources": _with(f"""
, kept as (
  select *, case when source = 'motorbike' and f_distancia > minutes / 60::double * 60000::double then minutes / 60::double * 60000::double
    else f_distancia end as d
  from timed where (source = 'motorbike' and f_distancia > 147 and minutes > 2 and minutes <= 90)
    or (source = 'bicycle' and f_distancia > 0 and f_distancia <= 30000 and minutes > 1)),
parts as (select *, case when source = 'motorbike' and d > 4200 then cast(round_even((d - d % 2000::double) / 2000::double, 0) as bigint)
  + case when d % 2000::double <> 0 then 1 else 0 end else 1 end as n from kept),
cut as (select *, unnest(range(0, n)) as i from parts),
drawn as (select *, case when n = 1 then 10000 else {_DRAW} end as w from cut),
shares as (select *, cast({_BEFORE} as hugeint) as before, cast(sum(w) over (partition by k_ruta) as hugeint) as whole from drawn),
rows as (select *, row_number() over (order by date, source, k_ruta, i) as rn from shares),
addressed as (select r.*, case when m.celo_address is null and source = 'bicycle' and k_dispositivo in (select k_dispositivo from protos)
    then {_PROTO} else m.celo_address end as address from rows r left join device_map m using (k_dispositivo))
select 100000 + rn as routeid, k_dispositivo as gpsid,
  case when n = 1 then t0 else t0 + (t1 - t0) * before // whole end // 1000000 as timestampstart,
  case when n = 1 then t1 else t0 + (t1 - t0) * (before + w) // whole end // 1000000 as timestampend,
  cast(round_even(case when n = 1 then d else d * w::double / whole::double end, 0) as bigint) as measureddistance,
  address as celo_address, date, source
from addressed where not (address is null and k_dispositivo in (select k_dispositivo from known))""",
        "timed", "device_map", "protos", "known").replace("\n, kept as", ",\nkept as", 1),
    "routes_no_split": _with("""
select 100000 + row_number() over (order by date, source, k_ruta) as routeid, k_dispositivo as gpsid, t0 // 1000000 as timestampstart,
  t1 // 1000000 as timestampend, cast(round_even(f_distancia, 0) as bigint) as measureddistance, celo_address, date, source
from timed left join device_map using (k_dispositivo)""", "timed", "device_map"),
    "route_quarantine": _with("""
select k_ruta, source, case when source <> 'motorbike' then 'unknown_source' else 'bad_time' end as reason from routes_raw
where source <> 'motorbike' or o_fecha_inicial[12] <> '0' or o_fecha_final[12] <> '0'""", "routes_raw"),
    "delivery_extract_rows": _with("""
select k_ruta as "routeID", k_dispositivo as "gpsID", strftime(make_timestamp(t0), '%Y-%m-%d %H:%M') as "timestampStart",
  strftime(make_timestamp(t1), '%Y-%m-%d %H:%M') as "timestampEnd", f_distancia as "measuredDistance", minutes as "durationMinutes"
from timed where f_distancia > 0 and f_distancia <= 9000000 and "Referencia" is not null and minutes > 2 and minutes <= 90""", "timed"),
    "device_address_map": _with("select k_dispositivo, celo_address from device_map", "device_map"),
    "device_contact_updates": _with(_CONTACTS_AFTER.format("len(gps_id_list) > 0"), "contacts"),
    "device_conflicts": _with("""
select k_dispositivo, 2 as claims from (select unnest(gps_id_list) as k_dispositivo from contacts where celo_address is null)""", "contacts"),
    "route_addresses": _with("select k_ruta, k_dispositivo, celo_address from owned", "owned"),
    "route_prototype_override": _with(f"""
select k_ruta, k_dispositivo, case when celo_address is null and k_dispositivo in (select k_dispositivo from protos) then {_PROTO}
  else celo_address end as celo_address from owned""", "owned", "protos"),
    "unassigned_devices": _with("""
select k_dispositivo, 'known' as kind from effective_known
union all
select distinct k_dispositivo, 'alert' from owned where celo_address is null
  and k_dispositivo not in (select k_dispositivo from effective_known)""", "effective_known"),
    "routes_assigned_only": _with("""
select k_ruta, k_dispositivo, celo_address from owned where k_dispositivo not in (select k_dispositivo from effective_known)""", "effective_known"),
    "device_alert": _with("""
select date, source, cast(0 as bigint) as part, count(*) as devices, string_agg(k_dispositivo, ', ' order by k_dispositivo) as device_list
from (select distinct date, source, k_dispositivo from counted
  where k_dispositivo not in (select k_dispositivo from device_map) and k_dispositivo not in (select k_dispositivo from known)
    and not (source = 'bicycle' and k_dispositivo in (select k_dispositivo from protos)))
group by date, source""", "counted", "device_map", "known", "protos"),
    "routes_pending": _with("""
select rn as routeid, gpsid, celo_address, date, case when celo_address is null then 1 else 0 end as held
from final where rn not in (select route_id from ledger)""", "final", "ledger"),
    "attempt_status": _with("""
select seq, case when message like '%ERC721: token already minted%' then 'already_minted' when message = 'ok' then 'sent' else 'failed' end as status,
  case when message = 'ok' then 'sent' when message like '%Panic error 0x11%' then 'overflow' when lower(message) like '%revert%' then 'revert'
    else 'error' end as payment_status
from attempts""", "attempts"),
    "publish_prefix": _with("select date, seq, route_id, status from completed", "completed"),
    "ledger_merge": _with(_LEDGER, "merged"),
    "publish_outcome": _with("""
select date, count(*) as total, coalesce(max(published), 0) as published, (coalesce(max(published), 0) >= count(*))::int as all_success
from attempts left join (select date, count(*) as published from merged group by date) using (date) group by date""", "attempts", "merged"),
    "publish_budget": _with("""
select date, seq, route_id, spent from (
  select *, cast(coalesce(sum(cost) over (partition by date order by seq rows between unbounded preceding and 1 preceding), 0) as bigint) as spent
  from tried) where spent <= 0.9 * 900""", "tried"),
    "publish_nonces": _with("""
select date, seq, route_id, 4999 + row_number() over (order by date, seq) as nonce from completed where status = 'sent'""", "completed"),
    "ledger_first_write": _with("""
select seq, token_id, owner, timestamp_start, timestamp_end, distance
from (select *, row_number() over (partition by token_id order by seq) as rn from route_events) where rn = 1""", "route_events"),
    "routes_per_day": _with("""
select strftime(make_timestamp(timestamp_start * 1000000), '%Y-%m-%d') as date, count(*) as routes
from (select *, row_number() over (partition by token_id order by seq) as rn from route_events) where rn = 1 group by 1""", "route_events"),
    "credits_pending": _with("""
select id, credit_id, client_record_id, principal, total_repayment, own_address from credits where not is_published""", "credits"),
    "credit_terms": _with("select credit_id, term_days from credits", "credits"),
    "credit_dates": _with("select credit_id, issuance_date from credits", "credits"),
    "credit_addresses": _with(f"""
select credit_id, client_record_id, client_id, coalesce(own_address, celo_address, {_DERIVED.format('client_id')}) as address,
  (coalesce(own_address, celo_address) is null)::int as is_derived
from credits c left join contacts k on c.client_record_id = k.id""", "credits", "contacts"),
    "contact_updates": _with(_CONTACTS_AFTER.format(
        "id in (select client_record_id from credits where own_address is null)"), "contacts", "credits"),
    "credit_flags": "select concat('rec', cast(o_orderkey as varchar)) as id, 1 as published from orders",
    "credits_state": _with(f"""
select credit_id, issuance_date, coalesce(own_address, celo_address, {_DERIVED.format('client_id')}) as owner, principal,
  total_repayment as outstanding, term_days
from totals c left join contacts k on c.client_record_id = k.id""", "totals", "contacts"),
    "payments_pending": _with("""
select id, payment_id, credit_id, amount, payment_date from payments
where not is_published and credit_id in (select credit_id from credits where is_published)""", "payments", "credits"),
    "payment_dedup": _with("select id, payment_id, credit_id, amount, payment_date from accepted", "accepted"),
    "payment_balances": _with("select id, payment_id, credit_id, amount, payment_date, balance, applied from applied", "applied"),
    "payment_outcomes": _with("""
select id, payment_id, credit_id, amount, payment_date, outcome, applied, balance, count(*) as records from (
  select p.*, case when p.rn = 1 then a.balance end as balance, case when p.rn > 1 then 'duplicate' when a.applied = p.amount then 'applied_full' else 'clamped' end as outcome,
    case when p.rn > 1 then 0 else a.applied end as applied
  from (select *, row_number() over (partition by payment_id order by payment_date, payment_id, amount, id) as rn from payments) p
  left join applied a using (payment_id))
group by id, payment_id, credit_id, amount, payment_date, outcome, applied, balance""", "payments", "applied"),
    "payment_run_outcome": _with("""
, waiting as (select * from payments where not is_published and credit_id in (select credit_id from credits where is_published)),
ranked as (select *, row_number() over (partition by payment_id order by payment_date, payment_id, amount, id) as rn from waiting),
running as (select *, sum(amount) over (partition by credit_id order by payment_date, payment_id rows unbounded preceding) as paid
  from ranked where rn = 1),
results as (select case when greatest(total_repayment - paid + amount, 0) - greatest(total_repayment - paid, 0) = amount then 'applied_full'
    else 'clamped' end as outcome,
    greatest(total_repayment - paid + amount, 0) - greatest(total_repayment - paid, 0) as applied
  from running join totals using (credit_id)
  union all select 'duplicate', 0 from ranked where rn > 1)
select outcome, count(*) as records, cast(sum(applied) as bigint) as applied from results group by outcome""",
        "payments", "totals").replace("\n, waiting as", ",\nwaiting as", 1),
    "payment_run_total": _with(
        "select count(*) as total, count(*) filter (where amount >= 0) as published, (bool_and(amount >= 0))::int as all_success from waiting",
        "waiting"),
    "payment_later_run": _with("""
select id, payment_id, outcome, cast(applied as bigint) as applied, count(*) as records from (
  select id, payment_id, 'duplicate' as outcome, 0 as applied from waiting where payment_id in (select payment_id from recorded)
  union all
  select id, payment_id, case when rn > 1 then 'duplicate' when later_applied = amount then 'applied_full' else 'clamped' end,
    case when rn > 1 then 0 else later_applied end
  from later)
group by id, payment_id, outcome, applied""", "waiting", "recorded", "later"),
    "credit_outstanding": _with("""
select credit_id, total_repayment, coalesce(paid, 0) as paid, coalesce(payments, 0) as payments, total_repayment - coalesce(paid, 0) as outstanding
from totals left join (select credit_id, cast(sum(applied) as bigint) as paid, count(*) as payments from applied group by credit_id) using (credit_id)""",
        "totals", "applied"),
    "publish_log_stats": _with(_STATS, "dated"),
    "publish_log_dates": _with("select stream, line_no, date from dated", "dated"),
    "publish_log_files": _with(_STATS, "dated"),
    "routes_csv_roundtrip": _with(_FINAL, "final"),
    "landing_envelope": _with("""
select k_ruta, k_dispositivo, o_fecha_inicial, o_fecha_final, f_distancia, "Referencia", lng_inicial, lat_inicial, lng_final, lat_final
from routes_raw""", "routes_raw"),
    "ledger_roundtrip": _with(_LEDGER, "merged"),
    "record_scan": """
select concat('rec', cast(o_orderkey as varchar)) as id, o_orderkey + 1 as credit_id, concat(cast(4 + o_orderkey % 20 as varchar), ' semanas') as term_text
from orders where o_orderstatus <> 'F'""",
    "event_scan": _with("""
select strftime(make_timestamp(timestamp_start * 1000000), '%Y-%m-%d') as date, count(*) as routes from route_events group by 1""", "route_events"),
}
