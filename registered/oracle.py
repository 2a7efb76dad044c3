"""The same results in SQL, for a database that sees the provided tables as views."""

from __future__ import annotations

import re

FLIGHTS = """
flights as (
    select l_orderkey, l_linenumber,
        cast(o_orderdate as date) as flight_date,
        cast(l_suppkey as varchar) as carrier,
        cast(l_partkey as varchar) as tail_num,
        cast(c_nationkey as varchar) as origin_id,
        cast(s_nationkey as varchar) as dest_id,
        cast(cast(floor(l_extendedprice) as bigint) % 2401 as integer) as crs_dep_time,
        case when l_returnflag <> 'R' then cast((cast(floor(l_extendedprice) as bigint) * 7) % 2460 as integer) end
            as dep_time,
        case when l_returnflag = 'R' then 1.0::double else 0.0::double end as cancelled,
        case when l_returnflag = 'R' then o_orderpriority end as cancellation_code,
        case when l_linestatus = 'O' then 1.0::double else 0.0::double end as diverted,
        l_quantity * 10 as air_time,
        l_quantity as weather_delay,
        round(l_discount * 100) as nas_delay,
        case when l_returnflag <> 'N' then round(l_tax * 100) end as security_delay,
        cast(l_linenumber as double) as late_aircraft_delay,
        l_quantity + round(l_discount * 100)
            + case when l_returnflag <> 'N' then round(l_tax * 100) end + cast(l_linenumber as double) as total_delay,
        cast(l_linenumber as double) as taxi_in,
        cast(l_linenumber * 2 as double) as taxi_out,
        case when l_linestatus = 'O' then cast(c_nationkey as varchar) end as div1_id,
        case when l_linestatus = 'O' then cast(l_partkey as varchar) end as div1_tail,
        case when l_linestatus = 'O' and l_returnflag = 'R' then cast(l_linenumber as varchar) end as div2_id,
        case when l_linestatus = 'O' and l_returnflag = 'R' then cast(l_orderkey as varchar) end as div2_tail
    from lineitem
    left join orders on l_orderkey = o_orderkey
    left join customer on o_custkey = c_custkey
    left join supplier on l_suppkey = s_suppkey
)"""



def _key(table: str, number: str, divisor: int) -> str:
    """The key of a member's open version: that of the first load, or if the second changed it, one after all of them."""
    order = f"order by md5(cast({number} as varchar))"
    return f"""cast(case when {number} % {divisor} = 0
            then (select count(*) from {table}) + row_number() over (partition by {number} % {divisor} = 0 {order})
            else row_number() over ({order}) end as bigint)"""


AIRLINE = f"""
airline as (
    select cast(s_suppkey as varchar) as carrier, lower(s_name) as airline_name,
        {_key("supplier", "s_suppkey", 7)} as airline_key
    from supplier
)"""

AIRPORT = f"""
airport as (
    select cast(n_nationkey as varchar) as code, lower(n_name) || ' field, north' as airport_name,
        lower(n_name) as city,
        {_key("nation", "n_nationkey", 3)} as airport_key
    from nation
)"""

PLANE_STAGED = """
brand as (select p_brand, cast(max(p_size) * 10 as integer) as horsepower from part group by p_brand),
plane_staged as (
    select cast(p_partkey as varchar) as n_number, p_name as serial_number, lower(p_type) as aircraft_name,
        part.p_brand as aircraft_mfr_model, cast(1950 + nullif(p_size, 1) as integer) as year_mfr,
        coalesce(lower(nullif(p_type, 'ECONOMY')), 'undefined') as registrant_city,
        lower(part.p_brand) as registrant_state, lower(p_name) as registrant_street,
        cast(substr(part.p_brand, 7) as integer) as eng_mfr_model_code,
        lower('Maker ' || part.p_brand) as eng_mfr_name, lower(part.p_brand) as eng_model_name,
        horsepower as eng_horse_power
    from part left join brand on part.p_brand = brand.p_brand
)"""

PLANE = (
    PLANE_STAGED
    + f""",
plane as (
    select *, {_key("part", "cast(n_number as bigint)", 5)} as plane_key from plane_staged
)"""
)


def _calendar(name: str, first: str, last: str) -> str:
    return f"""
{name} as (
    select cast(date_diff('day', {first}, d) + 1 as integer) as date_key,
        strftime(d, '%B %-d, %Y') as full_date_description, d as date,
        cast(isodow(d) as integer) as day_of_week, cast(month(d) as integer) as calendar_month,
        cast(quarter(d) as integer) as calenda_quarter, cast(year(d) as integer) as calendar_year,
        case when (month(d), day(d)) in ((1, 1), (7, 4), (12, 25)) then 'Holiday' else 'Non-Holiday' end
            as holiday_indicator,
        case when isodow(d) <= 5 then '1' else '0' end as weekday_indicator
    from (select cast(unnest(generate_series({first}, {last}, interval 1 day)) as date) as d)
)"""


_FIRST_DAY = "(select cast(min(o_orderdate) as date) from orders)"
_LAST_DAY = "(select cast(max(o_orderdate) as date) from orders)"
DATES = _calendar("dates", _FIRST_DAY, _LAST_DAY)

MONTHS = (
    DATES
    + """,
months as (
    select month, quarter, year, cast(row_number() over (order by year, month) as bigint) as monthly_key
    from (select distinct calendar_month as month, calenda_quarter as quarter, calendar_year as year from dates)
)"""
)

_FACT_ROWS = """
clock as (
    select cast(s * 60 as integer) as time_key, cast(s // 60 as integer) as hour, cast(s % 60 as integer) as minute
    from range(1440) as r(s)
),
fact as (
    select al.airline_key, pl.plane_key, da.date_key as flight_date_key, ori.airport_key as origin_airport_key,
        des.airport_key as dest_airport_key, dep.time_key as actual_dep_time_key, crs.time_key as crs_dep_time_key,
        cancelled, diverted, air_time, weather_delay, nas_delay, security_delay, late_aircraft_delay, total_delay,
        taxi_in, taxi_out, d1.airport_key as div1_airport_key, p1.plane_key as div1_plane_key,
        d2.airport_key as div2_airport_key, p2.plane_key as div2_plane_key, cancellation_code
    from flights f
    join dates da on f.flight_date = da.date
    left join airline al on f.carrier = al.carrier
    left join airport ori on f.origin_id = ori.code
    left join airport des on f.dest_id = des.code
    left join airport d1 on f.div1_id = d1.code
    left join airport d2 on f.div2_id = d2.code
    left join plane pl on f.tail_num = pl.n_number
    left join plane p1 on f.div1_tail = p1.n_number
    left join plane p2 on f.div2_tail = p2.n_number
    left join clock dep on dep.minute = f.dep_time % 100
        and dep.hour = case when f.dep_time = 2400 then 0 when f.dep_time < 2400 then f.dep_time // 100 end
    left join clock crs on crs.minute = f.crs_dep_time % 100
        and crs.hour = case when f.crs_dep_time = 2400 then 0 when f.crs_dep_time < 2400 then f.crs_dep_time // 100 end
)"""

FACT = ",".join([FLIGHTS, AIRLINE, AIRPORT, PLANE, DATES, _FACT_ROWS])

MONTHLY = ",".join([AIRLINE, AIRPORT, MONTHS]) + """,
delivered as (
    select cast(l_suppkey as varchar) as carrier, cast(c_nationkey as varchar) as origin_id,
        cast(s_nationkey as varchar) as dest_id, year(o_orderdate) as year, month(o_orderdate) as month,
        l_quantity * l_linenumber as freight, l_quantity as passengers, cast(l_linenumber as double) as mail
    from lineitem
    left join orders on l_orderkey = o_orderkey
    left join customer on o_custkey = c_custkey
    left join supplier on l_suppkey = s_suppkey
),
summed as (
    select carrier, origin_id, dest_id, year, month, sum(freight) as freight, sum(passengers) as passengers,
        sum(mail) as mail
    from delivered group by all
)"""


def _monthly(rows: str) -> str:
    return f"""
    select airline_key, freight, passengers, mail, ori.airport_key as origin_airport_key,
        des.airport_key as dest_airport_key, monthly_key
    from {rows} d
    left join airline al on d.carrier = al.carrier
    left join airport ori on d.origin_id = ori.code
    left join airport des on d.dest_id = des.code
    left join months m on d.year = m.year and d.month = m.month"""


_HISTORY = ("1995-07-01", "1997-03-01", "1999-09-01")


def _versions(name: str, natural: str, table: str, number: str, divisor: int) -> str:
    """All versions after three loads, of which each changed the members whose number the divisor divides."""
    order, changes = f"order by md5(cast({number} as varchar))", f"({number} % {divisor} = 0)"
    return f"""
{name}_members as (
    select cast({number} as varchar) as {natural}, {changes} as changes, row_number() over ({order}) as first_key,
        row_number() over (partition by {changes} {order}) as nth, (select count(*) from {table}) as members,
        (select count(*) from {table} where {changes}) as changed
    from {table}
),
{name} as (
    select {natural}, date '{_HISTORY[0]}' as start_date,
        case when changes then date '{_HISTORY[1]}' else date '9999-12-31' end as end_date, first_key as {name}_key
    from {name}_members
    union all
    select {natural}, date '{_HISTORY[1]}', date '{_HISTORY[2]}', members + nth from {name}_members where changes
    union all
    select {natural}, date '{_HISTORY[2]}', date '9999-12-31', members + changed + nth from {name}_members where changes
)"""


VERSIONS = ",".join(
    [
        _versions("airline", "carrier", "supplier", "s_suppkey", 7),
        _versions("airport", "code", "nation", "n_nationkey", 3),
        _versions("plane", "n_number", "part", "p_partkey", 5),
    ]
)


def _valid_on(joins: str, day: str) -> str:
    """Joins with the dimensions that keep versions, each with the version of the day."""
    return re.sub(
        r"left join (airline|airport|plane) (\w+) on (.*)",
        rf"left join \1 \2 on \3 and {day} >= \2.start_date and {day} < \2.end_date",
        joins,
    )


_LOADS = ("1996-05-01", "1997-06-01", "2002-01-01")


def _delivery(number: int) -> str:
    since = f"o_orderdate >= date '{_LOADS[number - 1]}'" if number else "true"
    until = f"o_orderdate < date '{_LOADS[number]}'" if number < len(_LOADS) - 1 else "true"
    return f"""
delivery{number} as (
    select o_custkey as c_custkey, nullif(o_orderstatus, 'P') as last_status, o_orderpriority as last_priority
    from (
        select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n
        from orders where {since} and {until}
    ) where n = 1
)"""


def _steps(number: int) -> str:
    """What delivery ``number`` means for the dimension as the load before it left it."""
    dim, staged = f"dim{number - 1}", f"delivery{number}"
    return f"""
changed{number} as (
    select s.* from {staged} s join {dim} d on s.c_custkey = d.c_custkey and d.current_flag
    where s.last_status is distinct from d.last_status or s.last_priority is distinct from d.last_priority
),
added{number} as (select * from {staged} s where not exists (select 1 from {dim} d where d.c_custkey = s.c_custkey)),
again{number} as (select * from {staged} s where exists (select 1 from {dim} d where d.c_custkey = s.c_custkey))"""


def _merge(number: int, versioned: str) -> str:
    dim, day = f"dim{number - 1}", f"date '{_LOADS[number]}'"
    ends = f"(current_flag and c_custkey in (select c_custkey from {versioned}{number}))"
    return f"""
    select buyer_key, c_custkey, last_status, last_priority, start_date,
        case when {ends} then {day} else end_date end as end_date, current_flag and not {ends} as current_flag
    from {dim}
    union all
    select (select max(buyer_key) from {dim})
            + cast(row_number() over (order by md5(cast(c_custkey as varchar))) as bigint) as buyer_key,
        c_custkey, last_status, last_priority, {day}, date '9999-12-31', true
    from (select * from added{number} union all select * from {versioned}{number})"""


BUYERS = ",".join([_delivery(0), _delivery(1), _delivery(2)]) + f""",
dim0 as (
    select cast(row_number() over (order by md5(cast(c_custkey as varchar))) as bigint) as buyer_key,
        c_custkey, last_status, last_priority, date '{_LOADS[0]}' as start_date, date '9999-12-31' as end_date,
        true as current_flag
    from delivery0
),
{_steps(1)},
dim1 as ({_merge(1, "changed")}),
{_steps(2)}"""


# The versions that all deliveries give at once: what is seen of a customer in order of days, equal neighbours as one.
TIMELINE = ",".join([_delivery(0), _delivery(1), _delivery(2)]) + f""",
seen as (
    select date '{_LOADS[0]}' as day, * from delivery0
    union all select date '{_LOADS[1]}', * from delivery1
    union all select date '{_LOADS[2]}', * from delivery2
),
marked as (
    select *, lag(day) over w is null or last_status is distinct from lag(last_status) over w
        or last_priority is distinct from lag(last_priority) over w as starts
    from seen window w as (partition by c_custkey order by day)
),
placed as (select *, sum(starts::int) over (partition by c_custkey order by day) as nth from marked),
states as (
    select c_custkey, nth, any_value(last_status) as last_status, any_value(last_priority) as last_priority,
        min(day) as start_date, cast(count(*) as integer) as seen
    from placed group by c_custkey, nth
)"""


def _typed_counts(table: str, position: int, column: str, kind: str, source: str) -> str:
    """Values of one column by their least type: whole numbers by size, others as ``kind``."""
    small = f"count(*) filter ({column} between -2147483648 and 2147483647)"
    whole = kind == "whole"
    counts = {
        "n_empty": f"count(*) - count({column})",
        "n_int": small if whole else "0",
        "n_long": f"count({column}) - {small}" if whole else "0",
        **{f"n_{k}": f"count({column})" if kind == k else "0" for k in ("double", "date", "text")},
    }
    resolved = f"case when {counts['n_long']} > 0 then 'long' when count({column}) > 0 then 'int' else 'empty' end"
    kind = resolved if whole else f"case when count({column}) > 0 then '{kind}' else 'empty' end"
    values = ", ".join(f"cast({v} as bigint) as {k}" for k, v in counts.items())
    return f"""
    select '{table}' as table_name, {position} as position, '{column}' as column_name, {values}, {kind} as kind
    from {source}"""


_ORDER_TYPES = {
    "o_orderkey": "whole",
    "o_custkey": "whole",
    "o_orderstatus": "text",
    "o_totalprice": "double",
    "o_orderdate": "date",
    "o_orderpriority": "text",
}
_LINE_TYPES = {
    "l_orderkey": "whole",
    "l_partkey": "whole",
    "l_suppkey": "whole",
    "l_linenumber": "whole",
    **dict.fromkeys(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "double"),
    "l_returnflag": "text",
    "l_linestatus": "text",
    "l_shipdate": "date",
}
_TYPES = [
    *[_typed_counts("orders", n, c, kind, "orders") for n, (c, kind) in enumerate(_ORDER_TYPES.items())],
    *[_typed_counts("lineitem", n, c, kind, "lineitem") for n, (c, kind) in enumerate(_LINE_TYPES.items())],
    _typed_counts("orders", 7, "wide", "whole", """(
        select case when o_orderkey % 3 <> 0 then o_orderkey * 3000000000 end as wide from orders)"""),
    _typed_counts("orders", 9, "void", "text", "(select null::varchar as void from orders)"),
    """
    select 'orders', 6, 'mixed', count(*) filter (o_orderstatus <> 'P' and o_custkey is null),
        count(*) filter (o_orderstatus is distinct from 'P' and o_custkey is not null), 0, 0, 0,
        count(*) filter (o_orderstatus = 'P'), 'text'
    from orders""",
    """
    select 'orders', 8, 'number', 0, count(*) filter (o_orderkey % 2 = 0), 0, count(*) filter (o_orderkey % 2 <> 0), 0, 0,
        'double'
    from orders""",
]

_DELAYS = """cast(count(case when total_delay > 0 then 1 end) as bigint) as delayed_flights,
        coalesce(sum(total_delay), 0.0::double) as delay_minutes"""
_DIVERTED = "cast(coalesce(sum(diverted), 0) as bigint) as diverted_flights"
_CANCELLED = "cast(coalesce(sum(cancelled), 0) as bigint) as cancelled_flights"

_USES = """
        uses as (
            select origin_airport_key as airport_key, 1 as departures, cancelled, 0 as diverted, 0 as received from fact
            union all select dest_airport_key, 0, 0, diverted, 0 from fact
            union all select div1_airport_key, 0, 0, 0, 1 from fact where div1_airport_key is not null
            union all select div2_airport_key, 0, 0, 0, 1 from fact where div2_airport_key is not null
        )"""

_PROFILED = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
_PROFILED_TEXT = ("l_returnflag", "l_linestatus", "l_shipdate")


def _profile(column: str) -> str:
    number = "null::double" if column in _PROFILED_TEXT else f"cast({column} as double)"
    text = f"cast({column} as varchar)" if column in _PROFILED_TEXT else "null::varchar"
    return f"""
    select '{column}' as column_name, count(*) as row_count, count(*) - count({column}) as null_count,
        count(distinct {column}) as distinct_count, min({number}) as min_value, max({number}) as max_value,
        round(avg({number}), 4) as mean_value, min({text}) as min_text, max({text}) as max_text
    from lineitem"""


_PLACE = """
    select s_suppkey, case when s_nationkey = 3 then s_name
        else s_name || ', N' || cast(s_nationkey as varchar) || ': Port, gate: ' || s_name end as description
    from supplier"""

_DEPARTURES = "select event_id, cast(hour(ts) * 100 + minute(ts) as integer) as hhmm from events"

ORACLE: dict[str, str] = {
    "source_csv_roundtrip": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate,
            o_orderpriority
        from orders""",
    "source_csv_quoted": """
        select p_partkey, 'of "' || p_brand || '", ' || p_type || ', size ' || cast(p_size as varchar) as told,
            nullif(p_size, 1) as p_size, case when p_size > 2 then p_retailprice end as price,
            nullif(p_type, 'ECONOMY') as p_type
        from part""",
    "reject_bad_rows": """
        with sent as (
            select *, case o_orderkey % 50 when 3 then 'number of fields' when 1 then 'o_totalprice: not double'
                when 2 then 'o_orderdate: not date' when 4 then 'o_custkey: missing' end as reason
            from orders
        )
        select o_orderkey, case when reason is null then o_custkey end as o_custkey,
            case when reason is null then o_totalprice end as o_totalprice,
            case when reason is null then cast(o_orderdate as date) end as o_orderdate,
            case when reason is null then o_orderpriority end as o_orderpriority, reason
        from sent""",
    "infer_types": f"""
        select *, case kind when 'int' then 'int' when 'long' then 'bigint' when 'double' then 'double'
            when 'date' then 'date' else 'string' end as data_type
        from ({" union all ".join(_TYPES)})""",
    "sink_parquet_roundtrip": "select * from customer",
    "sink_swap": "select c_custkey, c_name, c_nationkey, c_acctbal * 2 as c_acctbal, c_mktsegment from customer",
    "load_audit": """
        with read as (select nullif(o_orderstatus, 'P') as status from orders)
        select count(*) as row_count, count(distinct l_orderkey) as distinct_keys,
            count(*) - count(l_orderkey) as null_keys, (select count(*) from read) as rows_read,
            (select count(*) from read where status is null) as rows_without_key,
            (select count(status) - count(distinct status) from read) as rows_repeated
        from lineitem""",
    "profile_table": " union all ".join(_profile(c) for c in _PROFILED),
    "fill_undefined": """
        select p_partkey, coalesce(nullif(p_type, 'ECONOMY'), 'undefined') as p_type, nullif(p_size, 1) as p_size
        from part""",
    "normalize_lower": """
        select p_partkey, p_name, lower(p_brand) as p_brand, lower(p_type) as p_type from part""",
    "parse_place_description": f"""
        select s_suppkey,
            case when strpos(description, ', ') > 0 then substr(description, 1, strpos(description, ', ') - 1)
                else description end as city,
            case when strpos(description, ', ') > 0 and strpos(description, ': ') > 0
                then substr(description, strpos(description, ': ') + 2) end as place_name
        from ({_PLACE})""",
    "hhmm_decode": f"""
        select event_id, hhmm, cast(hhmm // 100 as integer) as hour, cast(hhmm % 100 as integer) as minute,
            0 as second
        from ({_DEPARTURES})""",
    "time_key_lookup": f"""
        select event_id, hhmm, cast(hhmm // 100 * 3600 + hhmm % 100 * 60 as integer) as time_key
        from ({_DEPARTURES})""",
    "total_delay": f"""
        with {FLIGHTS}
        select l_orderkey, l_linenumber, weather_delay as WeatherDelay, nas_delay as NASDelay,
            security_delay as SecurityDelay, late_aircraft_delay as LateAircraftDelay, total_delay
        from flights""",
    "distinct_rows": "select distinct l_suppkey, l_linenumber, l_returnflag, l_linestatus from lineitem",
    "next_key": "select cast(coalesce(max(o_orderkey), 0) + 1 as bigint) as next_key from orders",
    "surrogate_key": """
        select c_custkey, c_name,
            cast(row_number() over (order by md5(cast(c_custkey as varchar))) as bigint) as customer_key
        from customer""",
    "surrogate_key_offset": """
        select c_custkey, c_name, (select max(o_orderkey) from orders)
            + cast(row_number() over (order by md5(cast(c_custkey as varchar))) as bigint) as customer_key
        from customer""",
    "stage_airline": """
        select distinct cast(s_suppkey as varchar) as carrier, lower(s_name) as airline_name from supplier""",
    "stage_airport": """
        with seen as (
            select distinct c_nationkey from lineitem join orders on l_orderkey = o_orderkey
            join customer on o_custkey = c_custkey
        )
        select cast(n_nationkey as varchar) as code, lower(n_name) || ' field, north' as airport_name,
            lower(n_name) as city,
            coalesce('s' || cast(c_nationkey as varchar), 'undefined') as state_code,
            coalesce('state ' || cast(c_nationkey as varchar), 'undefined') as state_name,
            cast(c_nationkey % 5 + 1 as integer) as wac,
            coalesce(lower(r_name), 'undefined') as country
        from nation
        left join seen on n_nationkey = c_nationkey
        left join region on c_nationkey % 5 = r_regionkey""",
    "stage_plane": f"with {PLANE_STAGED} select * from plane_staged",
    "scd2_initial": """
        select cast(row_number() over (order by md5(cast(c_custkey as varchar))) as bigint) as buyer_key,
            c_custkey, last_status, last_priority, date '1996-05-01' as start_date, date '9999-12-31' as end_date,
            true as current_flag
        from (
            select o_custkey as c_custkey, nullif(o_orderstatus, 'P') as last_status,
                o_orderpriority as last_priority,
                row_number() over (partition by o_custkey
                    order by nullif(o_orderstatus, 'P') nulls first, o_orderpriority nulls first) as n
            from orders
        ) where n = 1""",
    "scd2_new_members": f"with {BUYERS} select * from added2",
    "scd2_existing_members": f"with {BUYERS} select * from again2",
    "scd2_changed_members": f"with {BUYERS} select * from changed2",
    "scd2_closed_rows": f"""
        with {BUYERS}
        select buyer_key, c_custkey, last_status, last_priority, start_date, date '{_LOADS[2]}' as end_date,
            false as current_flag
        from dim1 where current_flag and c_custkey in (select c_custkey from changed2)""",
    "scd2_untouched_rows": f"""
        with {BUYERS}
        select * from dim1 where not current_flag or c_custkey not in (select c_custkey from changed2)""",
    "scd2_merge": f"with {BUYERS} {_merge(2, 'changed')}",
    "scd2_merge_digests": f"with {BUYERS} {_merge(2, 'changed')}",
    "scd2_merge_always": f"with {BUYERS} {_merge(2, 'again')}",
    "scd2_current": f"with {BUYERS} select * from ({_merge(2, 'changed')}) where current_flag",
    "scd2_late_delivery": f"""
        with {TIMELINE}
        select c_custkey, last_status, last_priority, start_date,
            coalesce(lead(start_date) over w, date '9999-12-31') as end_date, lead(start_date) over w is null as current_flag,
            seen
        from states window w as (partition by c_custkey order by start_date)""",
    "date_dimension": f"with {DATES} select * from dates",
    "time_dimension": """
        with seconds as (select cast(s as integer) as s from range(86400) as r(s)),
        seen as (
            select cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as integer) as s, count(*) as events
            from events group by 1
        ),
        parts as (
            select seconds.s, s // 3600 as h, s // 60 % 60 as m, s % 60 as sec, coalesce(events, 0) as events
            from seconds left join seen using (s)
        )
        select s as time_key, printf('%02d:%02d:%02d', h, m, sec) as time_24h, cast(h as integer) as hour,
            cast(m as integer) as minute, cast(sec as integer) as second,
            cast(case when h % 12 = 0 then 12 else h % 12 end as integer) as hour_12,
            printf('%02d:%02d:%02d ', case when h % 12 = 0 then 12 else h % 12 end, m, sec)
                || case when h < 12 then 'am' else 'pm' end as time_ampm,
            case when h < 12 then 'AM' else 'PM' end as meridian_indicator,
            case when h < 1 then 'Midnight' when h < 6 then 'Early morning' when h < 12 then 'Morning'
                when h < 18 then 'Afternoon' when h < 21 then 'Evening' else 'Night' end as period,
            events
        from parts""",
    "monthly_dimension": f"with {MONTHS} select * from months",
    "calendar_redelivery": """
        with days as (select cast(o_orderdate as date) as date, count(*) as n from orders group by 1),
        generated as (
            select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
            from days where date < date '1998-01-01'
        ),
        known as (
            select date from generated
            union select date from days where date >= date '1997-06-01' and day(date) % 3 <> 0
        )
        select date, cast(1 as bigint) as days_of_key, cast(coalesce(n, 0) as bigint) as flights
        from known left join days using (date)""",
    "holiday_calendar": """
        with years as (select distinct year(o_orderdate) as y from orders),
        days as (
            select y, cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), interval 1 day)) as date) as d
            from years
        ),
        ranked as (
            select *, isodow(d) as w, row_number() over (partition by y, month(d), isodow(d) order by d) as nth,
                row_number() over (partition by y, month(d), isodow(d) order by d desc) as from_last
            from days
        ),
        rules as (
            select * from (values ('Martin Luther King Jr. Day', 1, 1, 3), ('Washington''s Birthday', 2, 1, 3),
                ('Labor Day', 9, 1, 1), ('Columbus Day', 10, 1, 2), ('Thanksgiving Day', 11, 4, 4)) as r(name, m, w, nth)
        ),
        fixed as (
            select * from (values ('New Year''s Day', 1, 1, 0), ('Juneteenth', 6, 19, 2021), ('Independence Day', 7, 4, 0),
                ('Veterans Day', 11, 11, 0), ('Christmas Day', 12, 25, 0)) as r(name, m, dm, since)
        ),
        fixed_days as (
            select name, make_date(y, m, dm) as d, isodow(make_date(y, m, dm)) as w from years, fixed where y >= since
        ),
        easter as (
            select y, a, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 as h, b, c
            from (select y, y % 19 as a, y // 100 as b, y % 100 as c from years)
        ),
        sundays as (
            select make_date(y, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) // 31,
                (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) % 31 + 1) as d
            from (select *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 as l from easter)
        ),
        listed as (
            select d, name, false as is_observed from ranked join rules r
                on month(d) = r.m and ranked.w = r.w and ranked.nth = r.nth
            union all select d, 'Memorial Day', false from ranked where month(d) = 5 and w = 1 and from_last = 1
            union all select d, name, false from fixed_days
            union all select d + case w when 6 then -1 else 1 end, name, true from fixed_days where w >= 6
            union all select d, 'Easter Sunday', false from sundays
            union all select d - 2, 'Good Friday', false from sundays
        )
        select d as holiday_date, name as holiday_name, is_observed, (
            select count(*) from orders where cast(o_orderdate as date) = d) as orders
        from listed""",
    "fact_date_lookup": f"""
        with {_calendar("dates", "date '1996-01-01'", "date '2000-12-31'")}
        select date_key as flight_date_key, count(*) as flights
        from orders join dates on cast(o_orderdate as date) = dates.date group by 1""",
    "role_playing_lookup": f"""
        with {FACT}
        select origin_airport_key, dest_airport_key, div1_airport_key, div2_airport_key, air_time from fact""",
    "daily_fact": f"with {FACT} select * exclude (cancellation_code) from fact",
    "two_deliveries": """
        select cast(o_orderdate as date) as date, count(*) as flights, count(s_suppkey) as with_airline,
            sum(l_quantity * 10) as air_time
        from lineitem join orders on l_orderkey = o_orderkey left join supplier on l_suppkey = s_suppkey group by 1""",
    "point_in_time_fact": f"""
        with {",".join([FLIGHTS, VERSIONS, DATES, _valid_on(_FACT_ROWS, "f.flight_date")])}
        select * exclude (cancellation_code) from fact""",
    "point_in_time_monthly": f"""
        with {MONTHLY.replace(AIRLINE, VERSIONS).replace(AIRPORT + ",", "")}
        {_valid_on(_monthly("summed"), "make_date(d.year, d.month, 1)")}""",
    "fact_late_rows": f"""
        with {FLIGHTS},
        delivered as (
            select *, 0 as more, date '2002-01-01' as delivered_on from flights where l_orderkey % 10 <> 0
            union all
            select *, 1, date '2002-03-01' from flights
            where l_orderkey % 7 = 0 or (l_orderkey % 10 = 0 and l_linenumber % 2 = 1)
            union all
            select *, 2, date '2002-02-01' from flights where l_orderkey % 5 = 0
        )
        select l_orderkey, l_linenumber, flight_date as FlightDate, air_time + more as AirTime, delivered_on
        from delivered
        qualify delivered_on = max(delivered_on) over (partition by l_orderkey, l_linenumber)""",
    "monthly_fact": f"with {MONTHLY} {_monthly('summed')}",
    "monthly_fact_distinct": f"with {MONTHLY} select distinct * from ({_monthly('delivered')})",
    "least_delayed_month": f"""
        with {FACT}
        select calendar_month, {_DELAYS}
        from fact join dates on flight_date_key = date_key
        group by 1 order by delayed_flights, delay_minutes, calendar_month limit 1""",
    "cancellation_reasons": f"""
        with {FLIGHTS}
        select cancellation_code as reason, count(*) as flights from flights where cancelled = 1 group by 1""",
    "busiest_destinations": f"""
        with {FACT}
        select code, airport_name, city, cast(count(*) as bigint) as flights
        from fact left join airport on dest_airport_key = airport_key
        group by 1, 2, 3 order by flights desc, code limit 10""",
    "airline_dashboard": f"""
        with {FACT}
        select carrier, airline_name, count(*) as flights, {_DELAYS}, {_DIVERTED},
            avg(taxi_in) as avg_taxi_in, avg(taxi_out) as avg_taxi_out
        from fact left join airline on fact.airline_key = airline.airline_key group by 1, 2""",
    "airport_dashboard": f"""
        with {FACT}, {_USES}
        select code, airport_name, city, cast(sum(departures) as bigint) as departures, {_CANCELLED}, {_DIVERTED},
            cast(sum(received) as bigint) as diversions_received
        from uses left join airport on uses.airport_key = airport.airport_key group by 1, 2, 3""",
    "city_diversions": f"""
        with {FACT}, {_USES}
        select city, {_DIVERTED}, cast(sum(received) as bigint) as diversions_received
        from uses left join airport on uses.airport_key = airport.airport_key group by 1""",
    "plane_dashboard": f"""
        with {FACT}
        select eng_mfr_name, eng_model_name, year_mfr, registrant_city, count(distinct fact.plane_key) as planes,
            count(*) as flights, {_DIVERTED}, {_CANCELLED}, {_DELAYS}
        from fact left join plane on fact.plane_key = plane.plane_key group by 1, 2, 3, 4""",
    "holiday_trend": f"""
        with {FACT}
        select holiday_indicator, count(distinct flight_date_key) as days, cast(count(*) as bigint) as flights,
            {_CANCELLED}, {_DIVERTED}, {_DELAYS},
            cast(count(*) as double) / count(distinct flight_date_key) as flights_per_day
        from fact join dates on flight_date_key = date_key group by 1""",
    "route_dashboard": f"""
        with {FACT}
        select o.code as origin_code, o.city as origin_city, d.code as dest_code, d.city as dest_city,
            count(*) as flights, {_DIVERTED}, {_CANCELLED}, {_DELAYS}
        from fact left join airport o on origin_airport_key = o.airport_key
        left join airport d on dest_airport_key = d.airport_key group by 1, 2, 3, 4""",
    "monthly_dashboard": f"""
        with {MONTHLY}
        select m.year, quarter, m.month, sum(freight) as freight, sum(passengers) as passengers, sum(mail) as mail
        from delivered d left join months m on d.year = m.year and d.month = m.month group by 1, 2, 3""",
    "kept_up_dashboard": f"""
        with {FLIGHTS}, {AIRLINE}
        select al.carrier, airline_name, count(*) as flights, {_DELAYS}, {_DIVERTED},
            avg(taxi_in + case when l_orderkey % 7 = 0 and year(flight_date) = 1997 then 1 else 0 end) as avg_taxi_in,
            avg(taxi_out) as avg_taxi_out
        from flights left join airline al on flights.carrier = al.carrier
        where flight_date is not null
        group by 1, 2""",
}
