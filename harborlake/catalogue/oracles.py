"""SQL over the driver's tables with the results of the queries of the same name."""

from __future__ import annotations

# Shared parts, written out as common table expressions.

PORTS = """ports as (
  select 'P' || n_nationkey as port_id, n_name || ', ' || n_nationkey as city_state,
         lower(n_name) as city, cast(n_nationkey as varchar) as state from nation
  union all
  select 'Q' || n_nationkey, n_name || ', X' || n_regionkey, lower(n_name), 'X' || n_regionkey from nation
  union all
  select 'R' || n_nationkey, 'NO CITY ' || n_nationkey, 'no city ' || n_nationkey, null from nation)"""

RAW_ARRIVALS = """arrivals_once as (
  select o_orderkey || '.0' as cicid, year(o_orderdate) || '.0' as i94yr,
         case when o_orderpriority <> '5-LOW' then 'P' || (o_custkey % 30) end as i94port,
         case when o_orderpriority <> '4-NOT SPECIFIED'
              then date_diff('day', date '1960-01-01', cast(o_orderdate as date)) || '.0' end as arrdate,
         o_orderstatus as status from orders),
raw_arrivals as (
  select cicid, i94yr, i94port, arrdate from arrivals_once
  union all
  select cicid, i94yr, i94port, arrdate from arrivals_once where status = 'F')"""

IMM = f"""{PORTS}, {RAW_ARRIVALS}, dated as (
  select distinct *, date '1960-01-01' + cast(floor(cast(arrdate as double)) as integer) as arrival_date
  from raw_arrivals),
imm as (
  select cicid, arrival_date, i94port, city as port_city, state as port_state,
         cast(month(arrival_date) as integer) as month, cast(year(arrival_date) as integer) as year
  from dated join ports on i94port = port_id)"""

RAW_DEMOGRAPHICS = """raw_demographics as (
  select 'Nation_' || c_nationkey as city, cast(c_custkey % 4 as integer) as g,
         (c_custkey % 4) * 5 + c_nationkey % 5 as code,
         c_mktsegment as segment, cast(floor(c_acctbal) as integer) as n from customer)"""

DATED_IMM = """select cicid, coalesce(arrival_date, date '1960-01-01') as arrival_date, i94port, port_city, port_state,
  coalesce(month, 0) as month, coalesce(year, 0) as year from imm"""

CITY_DEMO = f"""{PORTS}, {RAW_DEMOGRAPHICS}, wide as (
  select city, g, code,
         coalesce(max(n) filter (segment = 'AUTOMOBILE'), 0) as ai_an,
         coalesce(max(n) filter (segment = 'BUILDING'), 0) as "Asian",
         coalesce(max(n) filter (segment = 'FURNITURE'), 0) as black_aa,
         coalesce(max(n) filter (segment = 'HOUSEHOLD'), 0) as h_l,
         coalesce(max(n) filter (segment = 'MACHINERY'), 0) as "White"
  from raw_demographics group by city, g, code),
city_demo as (
  select port_id, lower(wide.city) as city_lower, g + 30.5::double as median_age,
         g * 1000 as male_pop, g * 1100 as female_pop, g * 2100 as total_pop,
         coalesce(nullif(g * 10, 10), 0) as veterans_num, g * 7 as "Foreign-Born",
         coalesce(nullif(g / 2.0::double, 0.5), 0) as avg_household, cast(code as varchar) as state_code,
         ai_an, "Asian", black_aa, h_l, "White", ports.state as port_state
  from wide join ports on lower(wide.city) = ports.city)"""

CITY_DEMO_COLUMNS = """port_id, city_lower, median_age, male_pop, female_pop, total_pop, veterans_num,
  "Foreign-Born", avg_household, state_code, ai_an, "Asian", black_aa, h_l, "White\""""

AIRPORT = """airports_once as (
  select cast(p_partkey as varchar) as ident, p_type as type, p_name as name,
         case when p_size < 5 then 'Brand'
              else replace(p_brand, '#', '-') || '-' || p_size end as iso_region
  from part),
airport as (
  select ident, type, iso_region, string_split(iso_region, '-')[2] as state from airports_once)"""

LAND_TEMP = f"""{PORTS}, raw_temperatures as (
  select cast(l_shipdate as date) as dt, case when l_returnflag <> 'N' then l_quantity end as temperature,
         l_discount as uncertainty, 'Nation_' || (l_suppkey % 30) as city, l_linestatus as country
  from lineitem),
land_temp as (
  select temperature as "AverageTemperature", lower(r.city) as city_lower, port_id, dt, country
  from (select distinct * from raw_temperatures where date_diff('day', dt, date '2001-12-01') < 900) r
  join ports on lower(r.city) = ports.city)"""

ORDERS_BY_NATION = """by_nation as (
  select c_nationkey, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month
  from orders join customer on o_custkey = c_custkey)"""


def _pivot(keys: str, pivot: str, value: str, values: list[str], tbl: str) -> str:
    cells = ", ".join(f"coalesce(max({value}) filter ({pivot} = '{v}'), 0) as \"{v}\"" for v in values)
    return f"select {keys}, {cells} from {tbl} group by {keys}"


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _exact_avg(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(18,2))) as double) / cast(nullif(count({value}), 0) as double)"


ORACLES: dict[str, str] = {
    # columns
    "split_second": "select event_id, string_split(event_type, 'u')[2] as tail from events",
    "label_text_functions": """select p_partkey, p_name as name, lower(p_type) as type, p_brand as brand,
        cast(p_size as varchar) as size from part""",
    "sas_days_to_date": """select o_orderkey, arrival_date, cast(year(arrival_date) as integer) as year,
        cast(month(arrival_date) as integer) as month
        from (select o_orderkey, date '1960-01-01' + cast(floor(cast(
                (cast(o_orderkey % 20000 + 1 as varchar) || '.0') as double)) as integer) as arrival_date
              from orders)""",
    "calendar_parts": """select event_id, cast(day(ts) as integer) as day,
        cast(hour(ts) as integer) as hour, cast(weekofyear(ts) as integer) as week,
        strftime(ts, '%Y-%m-%d %H') as hour_stamp from events""",
    "renamed_columns": f"""with {RAW_DEMOGRAPHICS} select city as "City", g + 30.5::double as median_age,
        coalesce(nullif(g * 10, 10), 0) as veterans_num, g * 7 as "Foreign-Born", cast(code as varchar) as state_code
        from raw_demographics""",
    "columns_named_by_position": """select p_partkey as id, string_split(p_name, ' ')[1] as colour,
        string_split(p_name, ' ')[2] as thing from part""",
    # filters
    "recent_days": """select l_orderkey, l_linenumber, cast(l_shipdate as date) as dt from lineitem
        where date_diff('day', cast(l_shipdate as date), date '2001-12-01') < 900""",
    "recent_day_differences": """select * from (select l_orderkey, l_linenumber,
          cast(date_diff('day', cast(l_shipdate as date), date '2001-12-01') as integer) as date_diff
        from lineitem) where date_diff < 900""",
    "matching_lines": """select * from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)
        where regexp_matches(line, '[0-9]=[0-9]|[a-z]@[a-z]|LICENSE|License')""",
    # de-duplication and pivots
    "dedupe_full_row": "select distinct user_id, event_type from events",
    "dedupe_by_key": """select * from lineitem qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus, l_shipdate) = 1""",
    "dedupe_then_project": "select o_orderstatus from (select distinct o_custkey, o_orderstatus from orders)",
    "pivot_max_fill": _pivot("user_id", "event_type", "value", _EVENT_TYPES, "events"),
    "pivot_discover": _pivot("user_id", "event_type", "value", _EVENT_TYPES, "events"),
    "pivot_multi_key": _pivot("o_custkey, o_orderstatus", "o_orderpriority", "o_totalprice", _PRIORITIES, "orders"),
    "fillna_numeric": """select event_id, coalesce(case when value > 5 then value end, 0) as v,
        case when value > 5 then event_type end as s from events""",
    # joins
    "lookup_port": """select c_custkey, c_nationkey, n_name as nation, n_regionkey as region
        from customer join nation on c_nationkey = n_nationkey""",
    "conform_lower_join": """select c_custkey, lower('Nation_' || c_nationkey) as city_lower, n_nationkey
        from customer join nation on lower('Nation_' || c_nationkey) = lower(n_name)""",
    "fanout_join": f"""with {PORTS} select c_custkey, 'Nation_' || c_nationkey as "City", port_id, state
        from customer join ports on lower('Nation_' || c_nationkey) = city""",
    "unmatched_keys": f"""with {PORTS}, {RAW_ARRIVALS} select cicid, i94port from raw_arrivals
        where i94port is null or i94port not in (select port_id from ports)""",
    # sources and sinks
    "csv_string_roundtrip": """select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment
        from customer""",
    "csv_glob_infer": "select cast(c_custkey as integer) as c_custkey, c_acctbal from customer",
    "csv_typed_by_name": "select * from supplier",
    "recursive_suffix_scan": "select c_custkey, c_name from customer",
    "format_scan": "select s_suppkey, s_name, s_nationkey from supplier",
    "whole_text_scan": "select c_name from customer",
    "flat_table_scan": "select p_partkey, p_type from part",
    "partitioned_roundtrip": """select o_orderkey, o_orderstatus, cast(year(o_orderdate) as integer) as year
        from orders""",
    "partitioned_by_date_roundtrip": "select event_id, value, cast(ts as date) as dt from events",
    "refreshed_partitions": """select o_orderkey, case when year(o_orderdate) >= 1999 then 'new' else 'old' end as load,
        cast(year(o_orderdate) as integer) as year from orders""",
    "saved_table": "select s_suppkey, s_name from supplier",
    "landed_extracts": f"with {RAW_ARRIVALS} select * from raw_arrivals",
    "sorted_dim_sample": "select s_suppkey, s_name from supplier order by s_name limit 1",
    # the five tables
    "label_lines": f"with {PORTS} select * from ports",
    "build_ports": """select 'C' || c_custkey as port_id, c_name || ', ' || c_mktsegment as city_state,
        lower(c_name) as city, c_mktsegment as state from customer""",
    "split_dim": """select distinct p_partkey as ident, p_type as type, replace(p_brand, '#', '-') as iso_region,
        string_split(p_brand, '#')[2] as state from part""",
    "build_airports": f"with {AIRPORT} select * from airport",
    "build_city_demographics": f"with {CITY_DEMO} select {CITY_DEMO_COLUMNS} from city_demo",
    "build_city_demographics_same_state": f"""with {CITY_DEMO} select {CITY_DEMO_COLUMNS} from city_demo
        where state_code = port_state""",
    "build_arrivals": f"with {IMM} {DATED_IMM}",
    "build_arrivals_by_key": f"with {IMM} {DATED_IMM}",
    "build_land_temperatures": f"""with {LAND_TEMP}
        select "AverageTemperature", city_lower, port_id, dt from land_temp""",
    "build_land_temperatures_one_country": f"""with {LAND_TEMP}
        select "AverageTemperature", city_lower, port_id, dt from land_temp where country = 'O'""",
    # quality
    "duplicate_report": """select n as rows, d as distinct_rows, n - d as removed from
        (select count(*) as n from orders),
        (select count(*) as d from (select distinct o_custkey, o_orderstatus from orders))""",
    "row_count_report": """select 'orders' as "table", count(*) as rows from orders
        union all select 'customer', count(*) from customer""",
    "unmatched_report": f"""with {PORTS}, {RAW_ARRIVALS}, lost as (
          select i94port from raw_arrivals where i94port is null or i94port not in (select port_id from ports))
        select count(*) as unmatched_rows,
          count(distinct i94port) + max(case when i94port is null then 1 else 0 end) as unmatched_keys,
          count(*) filter (i94port is null) as null_key_rows from lost""",
    "checked_write": """select 'lineitem' as "table", count(*) as rows, count(*) as sent from lineitem""",
    # analytics
    "arrivals_by_port_month": f"""with {ORDERS_BY_NATION} select c_nationkey, year, month, count(*) as arrivals
        from by_nation group by c_nationkey, year, month""",
    "top_ports": f"""with {ORDERS_BY_NATION} select c_nationkey, count(*) as arrivals from by_nation
        group by c_nationkey order by arrivals desc, c_nationkey limit 5""",
    "port_demographics": f"""with {ORDERS_BY_NATION}, population as (
          select c_nationkey, count(*) as total_pop,
            {", ".join(f"count(*) filter (c_mktsegment = '{s}') as {s.lower()}" for s in _SEGMENTS)}
          from customer group by c_nationkey)
        select c_nationkey, arrivals, total_pop, {", ".join(s.lower() for s in _SEGMENTS)},
          {", ".join(f"{s.lower()}::double / total_pop::double as {s.lower()}_share" for s in _SEGMENTS)}
        from (select c_nationkey, count(*) as arrivals from by_nation group by c_nationkey)
        join population using (c_nationkey)""",
    "popular_port_demographics": f"""with {IMM}, {CITY_DEMO.removeprefix(PORTS + ", ")},
        popular as (select i94port, count(*) as arrivals from imm
          group by i94port order by arrivals desc, i94port limit 5)
        select i94port, arrivals, {CITY_DEMO_COLUMNS.removeprefix("port_id, ")},
          {", ".join(f'"{m}"::double / nullif(total_pop, 0)::double as "{m}_share"'
                     for m in ("ai_an", "Asian", "black_aa", "h_l", "White", "Foreign-Born"))}
        from popular join city_demo on i94port = port_id""",
    "airport_types_by_state": """select state, type, airports, arrivals from
          (select string_split(p_brand, '#')[2] as state, p_type as type, count(*) as airports
           from part group by 1, 2)
        join (select string_split(p_brand, '#')[2] as state, cast(count(*) as bigint) as arrivals
              from lineitem join part on l_partkey = p_partkey group by 1) using (state)""",
    "airport_types_of_arrivals": f"""with {IMM}, {AIRPORT} select state, type, airports, arrivals from
          (select state, type, count(*) as airports from airport group by state, type)
        join (select port_state, count(*) as arrivals from imm group by port_state) on state = port_state""",
    "port_value_trend": f"""select event_type, cast(ts as date) as period, {_exact_avg("value")} as avg_temperature,
        count(value) as measurements from events group by event_type, cast(ts as date)""",
    "port_temperature_trend": f"""with {LAND_TEMP} select port_id, cast(date_trunc('month', dt) as date) as period,
          {_exact_avg('"AverageTemperature"')} as avg_temperature,
          count("AverageTemperature") as measurements
        from land_temp group by 1, 2""",
    "arrivals_with_temperature": f"""with {IMM}, {LAND_TEMP.removeprefix(PORTS + ", ")}
        select port_id, period, arrivals, avg_temperature, measurements from
          (select i94port as port_id, cast(date_trunc('month', arrival_date) as date) as period,
             count(*) as arrivals from imm group by 1, 2)
        join (select port_id, cast(date_trunc('month', dt) as date) as period,
             {_exact_avg('"AverageTemperature"')} as avg_temperature,
             count("AverageTemperature") as measurements
           from land_temp group by 1, 2) using (port_id, period)""",
    # runs and incremental loads
    "whole_run": f"""with {IMM}, {CITY_DEMO.removeprefix(PORTS + ", ")}, {AIRPORT},
        recent_rows as (select distinct * from (
          select cast(l_shipdate as date) as dt, case when l_returnflag <> 'N' then l_quantity end,
            l_discount, l_suppkey % 30 as city, l_linestatus from lineitem)
          where date_diff('day', dt, date '2001-12-01') < 900)
        select 'imm' as "table", count(*) as rows, cast(null as varchar) as error from imm
        union all select 'city_demo', count(*), null from city_demo
        union all select 'airport', count(*), null from airport
        union all select 'land_temp', count(*), null from recent_rows
          join ports on 'nation_' || recent_rows.city = ports.city""",
    "incremental_append": "select c_custkey, c_name, c_nationkey from customer",
    "incremental_arrivals": f"with {IMM} {DATED_IMM}",
    "table_versions": """select o_orderkey, cast(year(o_orderdate) as integer) as year, 1 as version from orders where year(o_orderdate) < 1996
        union all select o_orderkey, cast(year(o_orderdate) as integer), 3 from orders where year(o_orderdate) >= 1996""",
    "append_only_arrivals": f"with {IMM} {DATED_IMM}",
    "maintained_reports": f"""with {IMM}, {CITY_DEMO.removeprefix(PORTS + ", ")}, {AIRPORT}, {LAND_TEMP.removeprefix(PORTS + ", ")}
        select 'port and month' as report, i94port as key, coalesce(year, 0) || '-' || coalesce(month, 0) as part, count(*) as n, 0::double as value
        from imm group by all
        union all select 'airport types', state, type, arrivals, airports::double from
          (select state, type, count(*) as airports from airport group by state, type)
          join (select port_state, count(*) as arrivals from imm group by port_state) on state = port_state
        union all select 'temperatures', port_id, cast(cast(date_trunc('month', dt) as date) as varchar), count("AverageTemperature"),
          coalesce({_exact_avg('"AverageTemperature"')}, 0) from land_temp group by port_id, date_trunc('month', dt)
        union all select 'demographics', i94port, cast(total_pop as varchar), arrivals, coalesce("White"::double / nullif(total_pop, 0)::double, 0)
        from (select i94port, count(*) as arrivals from imm group by i94port) join city_demo on i94port = port_id""",
    "stream_without_copies": """select event_id, event_type, false as late from events
        union all select event_id, event_type, true from events
        where ts < timestamp '2024-01-08' and event_id % 3 = 0""",
    "dedupe_by_digest": "select doc_id, text, lang, source from documents",
    "side_by_side": """select coalesce(s.position, c.position) as position, s_suppkey, s_name, c_custkey, c_acctbal from
          (select *, row_number() over (order by s_name, s_suppkey) - 1 as position from supplier) s
        full join (select *, row_number() over (order by c_acctbal, c_custkey) - 1 as position from customer) c using (position)""",
    "pivot_of_many_values": """select l_suppkey, count(distinct l_partkey) as parts,
          coalesce(max(l_quantity) filter (l_partkey = 1), 0) as part_1, coalesce(max(l_quantity) filter (l_partkey = 2), 0) as part_2,
          coalesce(max(l_quantity) filter (l_partkey = 3), 0) as part_3 from lineitem group by l_suppkey""",
    "whole_numbers_with_fractions": """select 'key' as "column", cast(sum(c_custkey) as bigint) as total, cast(0 as bigint) as misfits from customer
        union all select 'nation', cast(sum(c_nationkey) filter (c_custkey % 7 <> 0) as bigint), count(*) filter (c_custkey % 7 = 0) from customer
        union all select 'half', cast(sum(c_nationkey) filter (c_custkey % 5 <> 0) as bigint), count(*) filter (c_custkey % 5 = 0) from customer""",
    "landed_bytes": """select cast(c_nationkey as integer) as nation, cast(length(bytes) as bigint) as length, sha256(bytes) as sha256,
          cast(greatest(1, ceil(length(bytes) / 1000)) as integer) as pieces from
          (select c_nationkey, string_agg('  "' || c_name || '",' || chr(9) || chr(13) || chr(10), '' order by c_custkey) as bytes
           from customer group by c_nationkey)""",
    "recent_until_today": """select l_orderkey, l_linenumber from lineitem where date_diff('day', cast(l_shipdate as date), current_date) < 11500""",
    "arrivals_with_temperature_overall": f"""with {IMM}, {LAND_TEMP.removeprefix(PORTS + ", ")}
        select port_id, arrivals, avg_temperature, measurements from
          (select i94port as port_id, count(*) as arrivals from imm group by 1)
        join (select port_id, {_exact_avg('"AverageTemperature"')} as avg_temperature,
             count("AverageTemperature") as measurements from land_temp group by 1) using (port_id)""",
    "arrivals_by_edition": f"""with {IMM}, named as (select cicid, arrival_date, i94port, port_state, month, year,
            coalesce(arrival_date, date '2000-01-01') as day, port_city from imm)
        select cicid, coalesce(arrival_date, date '1960-01-01') as arrival_date, i94port,
          case when i94port = 'P5' and day < date '1995-07-01' then 'old town'
               when i94port = 'P7' and day >= date '1997-02-15' then 'new town' else port_city end as port_city,
          port_state, coalesce(month, 0) as month, coalesce(year, 0) as year
        from named where not (i94port = 'P3' and day < date '1995-07-01')""",
    "point_of_clustered_table": """select l_orderkey, l_linenumber, l_quantity from lineitem
        where cast(l_shipdate as date) between date '1995-01-01' and date '1995-12-31' or l_suppkey = 7""",
    "bucketed_lookup": """select o_custkey as custkey, c_name, count(*) as orders, max(o_totalprice) as dearest
        from orders join customer on o_custkey = c_custkey group by 1, 2""",
    "whole_run_contents": f"""with {IMM}, {CITY_DEMO.removeprefix(PORTS + ", ")}, {AIRPORT},
        recent_rows as (select distinct * from (
          select cast(l_shipdate as date) as dt, case when l_returnflag <> 'N' then l_quantity end as t,
            l_discount, l_suppkey % 30 as city, l_linestatus from lineitem)
          where date_diff('day', dt, date '2001-12-01') < 900),
        measured as (select dt, t, port_id from recent_rows join ports on 'nation_' || recent_rows.city = ports.city)
        select 'imm' as "table", count(*) as rows, cast(sum(cast(cast(cicid as double) as bigint)) + sum(date_diff('day', date '1960-01-01', arrival_date))
          + sum(month) + sum(year) + sum(length(port_city)) + sum(length(port_state)) as bigint) as content from imm
        union all select 'city_demo', count(*), cast(sum(male_pop + female_pop + total_pop + veterans_num + "Foreign-Born" + ai_an + "Asian"
          + black_aa + h_l + "White" + length(port_id)) + sum(cast(avg_household * 2 as bigint)) as bigint) from city_demo
        union all select 'airport', count(*), cast(sum(length(ident)) + sum(length(type)) + sum(length(iso_region)) + sum(length(state)) as bigint) from airport
        union all select 'land_temp', count(*), cast(sum(cast(t as bigint)) + sum(length(port_id)) + sum(date_diff('day', date '1960-01-01', dt)) as bigint)
          from measured""",
    "measured_builds": f"""with {IMM}, {AIRPORT}, raw_items as (
          select cast(l_shipdate as date) as dt, case when l_returnflag <> 'N' then l_quantity end as t,
            l_discount, l_suppkey % 30 as city, l_linestatus, unnest(range(case when l_linenumber = 1 then 2 else 1 end)) as copy from lineitem),
        recent_items as (select dt, t, l_discount, city, l_linestatus from raw_items where date_diff('day', dt, date '2001-12-01') < 900),
        at_port as (select * from recent_items where 'nation_' || city in (select city from ports)),
        items as (select distinct * from at_port),
        known as (select * from raw_arrivals where i94port in (select port_id from ports)),
        raw_parts as (select p_partkey, p_type, p_name, p_brand, p_size, unnest(range(case when p_size > 25 then 2 else 1 end)) as copy from part)
        select 'imm' as "table", (select count(*) from raw_arrivals) as rows, (select count(*) from known) - (select count(*) from (select distinct * from known)) as copies,
          (select count(*) from raw_arrivals) - (select count(*) from known) as unmatched, (select count(*) from (select distinct * from known)) as distinct_rows,
          (select count(*) from imm) as written
        union all select 'airport', (select count(*) from raw_parts), (select count(*) from raw_parts) - count(*), 0, count(*), count(*) from airport
        union all select 'land_temp', (select count(*) from recent_items), (select count(*) from at_port) - (select count(*) from items),
          (select count(*) from recent_items) - (select count(*) from at_port), (select count(*) from items),
          (select count(*) from items join ports on 'nation_' || items.city = ports.city)""",
}
