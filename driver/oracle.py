"""ANSI SQL that gives the same rows as each query, for another engine to run.

The building blocks below are plain WITH parts; ``_sql`` puts the ones a query
needs in front of its SELECT.
"""

from __future__ import annotations

# The fields of a trip.
FIELDS = [
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "passenger_count",
    "trip_distance_miles",
    "rate_code_id",
    "store_and_fwd_flag",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "fare_amount",
    "extra_amount",
    "mta_tax_amount",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge_amount",
    "total_amount",
    "congestion_surcharge_amount",
    "airport_fee_amount",
    "cbd_congestion_fee_amount",
]
DECIMALS = [c for c in FIELDS if c not in ("pickup_at", "dropoff_at", "store_and_fwd_flag")]

MAX_SECONDS = 365 * 86400


def _half_up(numerator: str, denominator: str) -> str:
    """Whole-number ratio rounded half away from zero, without any double."""
    return (
        f"(case when {numerator} < 0 then -1 else 1 end"
        f" * ((2 * abs({numerator}) + {denominator}) // (2 * {denominator})))"
    )


LINES = """lines as (
    select *,
        substr(cast(case when l_orderkey % 41 = 0 and copy = 0 then l_shipdate else o_orderdate end
            as varchar), 1, 7) as period,
        cast(l_extendedprice as decimal(14,2)) as fare,
        round(cast(l_extendedprice as decimal(14,2)) * cast(l_discount as decimal(4,2)), 2) as tip
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey
    cross join (values (0), (1)) as copies(copy)
    where copy = 0 or l_partkey % 53 = 0
)"""

RAW = """trips_raw as (
    select
        'trips_' || period || '.parquet' as source_file,
        period as source_period,
        cast((l_orderkey * 8 + l_linenumber) * 4194304
            + ((l_partkey * 1000003 + l_suppkey) % 2097152) * 2 + copy as bigint) as source_row_number,
        timestamp '2024-06-01' + to_seconds(l_orderkey % 1000) as loaded_at,
        case when l_suppkey % 13 = 0 then '' when l_suppkey % 17 = 0 then '1000'
            else cast(l_suppkey % 9 as varchar) end as vendor_id,
        case when l_partkey % 67 = 0 then 'not-a-time' when l_partkey % 97 = 0 then null
            else ' ' || cast(o_orderdate as varchar) end as pickup_at,
        cast(l_shipdate as varchar) as dropoff_at,
        case when l_partkey % 71 = 0 then '12' when l_partkey % 73 = 0 then '-1'
            when l_partkey % 79 = 0 then null when l_partkey % 7 = 0 then '  '
            else cast(l_linenumber as varchar) || '.0' end as passenger_count,
        case when l_partkey % 59 = 0 then '-1.5' when l_partkey % 61 = 0 then 'x'
            else cast(cast(l_quantity as integer) as varchar) || '.'
                || lpad(cast(l_partkey % 10000 as varchar), 4, '0') end as trip_distance_miles,
        case when l_orderkey % 9 = 0 then null when l_orderkey % 9 = 7 then '99'
            when l_orderkey % 9 = 8 then 'abc'
            else cast(l_orderkey % 9 as varchar) end as rate_code_id,
        case l_returnflag when 'A' then ' y' when 'N' then 'N ' else l_returnflag end
            as store_and_fwd_flag,
        cast(c_nationkey as varchar) as pickup_location_id,
        cast(s_nationkey as varchar) as dropoff_location_id,
        cast(l_orderkey % 10 as varchar) as payment_type,
        case when l_partkey % 83 = 0 then '-' else '' end || cast(fare as varchar) as fare_amount,
        cast(cast(l_tax as decimal(14,2)) as varchar) as extra_amount,
        case when l_partkey % 89 = 0 then '-0.50' else '0.50' end as mta_tax_amount,
        cast(tip as varchar) as tip_amount,
        case when l_linenumber % 3 = 0 then null else '6.94' end as tolls_amount,
        '1.00' as improvement_surcharge_amount,
        cast(fare + tip as varchar) as total_amount,
        case when l_orderkey % 2 = 0 then '2.50' end as congestion_surcharge_amount,
        case when l_suppkey % 5 = 0 then '1.75' end as airport_fee_amount,
        case when l_partkey % 4 = 0 then '' else '0.75' end as cbd_congestion_fee_amount
    from lines
)"""


def _typed_column(name: str) -> str:
    if name in ("pickup_at", "dropoff_at"):
        return f"try_cast(nullif(trim({name}), '') as timestamp) as {name}"
    if name == "store_and_fwd_flag":
        return f"case when upper(trim({name})) in ('Y', 'N') then upper(trim({name})) end as {name}"
    kind = {
        "vendor_id": "decimal(3,0)",
        "rate_code_id": "decimal(3,0)",
        "payment_type": "decimal(3,0)",
        "passenger_count": "decimal(5,0)",
        "pickup_location_id": "decimal(5,0)",
        "dropoff_location_id": "decimal(5,0)",
        "trip_distance_miles": "decimal(14,3)",
    }.get(name, "decimal(14,2)")
    return f"try_cast(nullif(trim({name}), '') as {kind}) as {name}"


TYPED = f"""typed as (
    select
        md5(source_file || '|' || cast(source_row_number as varchar)) as trip_sk,
        source_file, source_period, source_row_number, loaded_at,
        try_cast(source_period || '-01' as date) as source_period_start,
        {", ".join(_typed_column(c) for c in FIELDS)}
    from trips_raw
)"""

_SECONDS = "datediff('second', pickup_at, dropoff_at)"
_HASHED = ", ".join(f"coalesce(cast({c} as varchar), '<NULL>')" for c in FIELDS)
_NEGATIVE = " or ".join(
    f"coalesce({c} < 0, false)"
    for c in ("fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount", "total_amount")
)

DERIVED = f"""derived as (
    select *,
        {_half_up(f"(100 * {_SECONDS})", "60")} / 100.0 as trip_duration_minutes,
        pickup_at >= source_period_start and pickup_at < source_period_start + interval 1 month
            as is_source_period_match,
        passenger_count is not null and (passenger_count < 0 or passenger_count > 9)
            as has_passenger_count_anomaly,
        {_NEGATIVE} as has_financial_anomaly,
        md5(concat_ws('|', {_HASHED})) as record_hash
    from typed
)"""

STAGED = f"""staged as (
    select *,
        row_number() over (partition by record_hash
            order by source_period, source_file, source_row_number) as duplicate_rank
    from (
        select *,
            case when pickup_at is null or dropoff_at is null then 'MISSING_TIMESTAMP'
                when dropoff_at < pickup_at then 'INVALID_CHRONOLOGY'
                when {_SECONDS} > {MAX_SECONDS} then 'DURATION_OVER_24H'
                when trip_distance_miles is null or trip_distance_miles < 0 then 'INVALID_DISTANCE'
                when pickup_location_id is null or pickup_location_id <= 0
                  or dropoff_location_id is null or dropoff_location_id <= 0 then 'MISSING_LOCATION'
                when not is_source_period_match then 'PERIOD_MISMATCH'
                else 'PASS' end as dq_status
        from derived
    )
)"""

CLEAN = "clean as (select * from staged where dq_status = 'PASS' and duplicate_rank = 1)"

ZONES_RAW = """zones_raw as (
    select
        case when c_custkey % 19 = 0 then 'n/a' when c_custkey % 23 = 0 then ''
            else ' ' || cast(n_nationkey as varchar) end as location_id,
        '  ' || lower(r_name) || '   side ' as borough,
        n_name || ',   Zone ' || cast(c_custkey % 7 as varchar) as zone,
        case when c_custkey % 3 <> 0 then lower(c_mktsegment) || '  area' end as service_zone,
        'zones.csv' as source_file,
        c_custkey as source_row_number,
        timestamp '2024-01-01' + to_days(cast(c_custkey % 50 as integer)) as loaded_at
    from customer
    join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
    where c_nationkey < 20
)"""

ZONES = r"""zones as (
    select * from (
        select
            try_cast(nullif(trim(location_id), '') as decimal(5,0)) as location_id,
            upper(regexp_replace(trim(borough), '\s+', ' ', 'g')) as borough,
            regexp_replace(trim(zone), '\s+', ' ', 'g') as zone_name,
            upper(regexp_replace(trim(service_zone), '\s+', ' ', 'g')) as service_zone,
            source_file, source_row_number, loaded_at
        from zones_raw
    )
    where location_id is not null
    qualify row_number() over (partition by location_id
        order by loaded_at desc, source_row_number) = 1
)"""

LOCATIONS = """dim_location as (
    select -1 as location_key, 'UNKNOWN' as borough, 'Unknown or unmapped' as zone_name,
        'UNKNOWN' as service_zone
    union all
    select cast(location_id as integer), borough, zone_name, coalesce(service_zone, 'UNKNOWN')
    from zones
)"""


def _dates(name: str, first: str, last: str) -> str:
    return f"""{name} as (
    select
        cast(strftime(date_day, '%Y%m%d') as integer) as date_key,
        date_day,
        cast(year(date_day) as integer) as year_number,
        cast(quarter(date_day) as integer) as quarter_number,
        cast(month(date_day) as integer) as month_number,
        strftime(date_day, '%b') as month_name,
        cast(weekofyear(date_day) as integer) as iso_week_number,
        cast(day(date_day) as integer) as day_of_month,
        cast(isodow(date_day) as integer) as iso_day_of_week,
        strftime(date_day, '%a') as day_name,
        isodow(date_day) in (6, 7) as is_weekend
    from (select cast(unnest(generate_series(date '{first}', date '{last}', interval 1 day)) as date)
        as date_day)
)"""


DATES = _dates("dim_date", "1995-01-01", "2001-12-31")
SHORT_DATES = _dates("short_dates", "1996-01-01", "1999-12-31")


def _members(name: str, key: str, label: str, rows: list[tuple[int, str]]) -> str:
    body = ", ".join(f"({k}, '{v}')" for k, v in rows)
    return f"{name} as (select * from (values {body}) as t({key}, {label}))"


VENDORS = _members(
    "dim_vendor",
    "vendor_key",
    "vendor_name",
    [
        (-1, "Unknown or unmapped"),
        (1, "Creative Mobile Technologies, LLC"),
        (2, "Curb Mobility, LLC"),
        (6, "Myle Technologies Inc"),
        (7, "Helix"),
    ],
)
PAYMENTS = _members(
    "dim_payment_type",
    "payment_type_key",
    "payment_type_name",
    [
        (-1, "Unknown or unmapped"),
        (0, "Flex Fare trip"),
        (1, "Credit card"),
        (2, "Cash"),
        (3, "No charge"),
        (4, "Dispute"),
        (5, "Unknown"),
        (6, "Voided trip"),
    ],
)
RATES = _members(
    "dim_rate_code",
    "rate_code_key",
    "rate_code_name",
    [
        (-1, "Unknown or unmapped"),
        (1, "Standard rate"),
        (2, "JFK"),
        (3, "Newark"),
        (4, "Nassau or Westchester"),
        (5, "Negotiated fare"),
        (6, "Group ride"),
        (99, "Null or unknown"),
    ],
)

_TIP = _half_up("(10000 * cast(tip_amount * 100 as bigint))", "cast(fare_amount * 100 as bigint)")

FACT = f"""fact as (
    select c.*,
        cast(strftime(pickup_at, '%Y%m%d') as integer) as pickup_date_key,
        cast(strftime(dropoff_at, '%Y%m%d') as integer) as dropoff_date_key,
        cast(case when p.location_id is null then -1 else pickup_location_id end as integer)
            as pickup_location_key,
        cast(case when d.location_id is null then -1 else dropoff_location_id end as integer)
            as dropoff_location_key,
        cast(case when vendor_id in (1, 2, 6, 7) then vendor_id else -1 end as integer) as vendor_key,
        cast(case when payment_type in (0, 1, 2, 3, 4, 5, 6) then payment_type else -1 end as integer)
            as payment_type_key,
        cast(case when rate_code_id in (1, 2, 3, 4, 5, 6, 99) then rate_code_id else -1 end as integer)
            as rate_code_key,
        cast(hour(pickup_at) as integer) as pickup_hour,
        cast(hour(dropoff_at) as integer) as dropoff_hour,
        case when fare_amount > 0 then {_TIP} end as tip_hundredths,
        case when fare_amount > 0 then {_TIP} / 100.0 end as tip_percentage,
        cast(1 as bigint) as trip_count
    from clean c
    left join (select location_id from zones) p on c.pickup_location_id = p.location_id
    left join (select location_id from zones) d on c.dropoff_location_id = d.location_id
)"""

KPIS = f"""kpis as (
    select source_period,
        count(*) as trip_count,
        cast(sum(coalesce(passenger_count, 0)) as double) as reported_passenger_count,
        cast(round(sum(trip_distance_miles), 2) as double) as total_distance_miles,
        {_half_up("sum(cast(trip_distance_miles * 1000 as bigint))", "(10 * count(*))")} / 100.0
            as avg_distance_miles,
        {_half_up("sum(cast(round(trip_duration_minutes * 100) as bigint))", "count(*)")} / 100.0
            as avg_duration_minutes,
        cast(round(sum(total_amount), 2) as double) as total_revenue_amount,
        cast(round(sum(tip_amount), 2) as double) as total_tip_amount,
        {_half_up("sum(tip_hundredths)", "nullif(count(tip_hundredths), 0)")} / 100.0
            as avg_tip_percentage,
        count(*) filter (where payment_type_key = 1) as credit_card_trip_count,
        count(*) filter (where has_financial_anomaly) as financial_anomaly_count
    from fact
    group by source_period
)"""


def _counted(status: str, name: str) -> str:
    return f"count(*) filter (where dq_status = '{status}') as {name}"


SUMMARY = f"""summary as (
    select source_period,
        count(*) as raw_row_count,
        count(*) filter (where dq_status = 'PASS' and duplicate_rank = 1) as usable_row_count,
        count(*) filter (where duplicate_rank > 1) as exact_duplicate_count,
        {_counted("MISSING_TIMESTAMP", "missing_timestamp_count")},
        {_counted("INVALID_CHRONOLOGY", "invalid_chronology_count")},
        {_counted("DURATION_OVER_24H", "excessive_duration_count")},
        {_counted("INVALID_DISTANCE", "invalid_distance_count")},
        {_counted("MISSING_LOCATION", "missing_location_count")},
        {_counted("PERIOD_MISMATCH", "period_mismatch_count")},
        count(*) filter (where has_passenger_count_anomaly) as passenger_count_anomaly_count,
        count(*) filter (where has_financial_anomaly) as financial_anomaly_count,
        {_half_up("(10000 * count(*) filter (where dq_status = 'PASS' and duplicate_rank = 1))", "count(*)")}
            / 100.0 as usable_percentage,
        max(loaded_at) as latest_load_at
    from staged
    group by source_period
)"""

AUDIT = """audit as (
    select 'yellow_taxi' as dataset, source_period,
        'landing/' || source_period as source_url,
        'trips_' || source_period || '.parquet' as source_file,
        sha256(source_period) as file_sha256,
        count(*) * 100 as byte_count,
        count(*) + case when substr(source_period, 6, 2) = '06' then 1 else 0 end as row_count,
        max(loaded_at) as loaded_at,
        case when substr(source_period, 6, 2) = '03' then 'FAILED' else 'SUCCESS' end as status
    from trips_raw
    where substr(source_period, 6, 2) <> '12'
    group by source_period
    union all
    select 'taxi_zone_lookup', 'CURRENT', 'landing/zones', 'zones.csv', sha256('zones'),
        count(*) * 10, count(*), max(loaded_at), 'SUCCESS'
    from zones_raw
)"""

TO_RAW = [LINES, RAW]
TO_TYPED = [*TO_RAW, TYPED]
TO_DERIVED = [*TO_TYPED, DERIVED]
TO_STAGED = [*TO_DERIVED, STAGED]
TO_CLEAN = [*TO_STAGED, CLEAN]
TO_ZONES = [ZONES_RAW, ZONES]
TO_FACT = [*TO_CLEAN, *TO_ZONES, FACT]
TO_AUDIT = [*TO_RAW, ZONES_RAW, AUDIT]


def _sql(parts: list[str], select: str) -> str:
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select.strip()


def _doubles(columns: list[str]) -> str:
    return ", ".join(f"cast({c} as double) as {c}" if c in DECIMALS else c for c in columns)


_STAGED_COLUMNS = [
    "trip_sk",
    "source_file",
    "source_period",
    "source_row_number",
    "loaded_at",
    "source_period_start",
    *FIELDS,
    "trip_duration_minutes",
    "is_source_period_match",
    "has_passenger_count_anomaly",
    "has_financial_anomaly",
    "record_hash",
    "dq_status",
    "duplicate_rank",
]
_CLEAN_COLUMNS = [
    c
    for c in _STAGED_COLUMNS
    if c not in ("source_period_start", "is_source_period_match", "dq_status", "duplicate_rank")
]
_FACT_COLUMNS = [
    "trip_sk",
    "pickup_date_key",
    "dropoff_date_key",
    "pickup_location_key",
    "dropoff_location_key",
    "vendor_key",
    "payment_type_key",
    "rate_code_key",
    "pickup_hour",
    "dropoff_hour",
    "store_and_fwd_flag",
    "passenger_count",
    "trip_distance_miles",
    "trip_duration_minutes",
    *[c for c in FIELDS if c.endswith("_amount")],
    "tip_percentage",
    "trip_count",
    "has_passenger_count_anomaly",
    "has_financial_anomaly",
    "source_period",
    "source_file",
    "source_row_number",
    "loaded_at",
]


def _usage(dimension: str, key: str, fact_key: str, label: str) -> str:
    return f"""select {dimension}.{key}, {label}, count(fact.{fact_key}) as trips
        from {dimension} left join fact on {dimension}.{key} = fact.{fact_key} group by all"""


def _nulls(check: str, table: str, base: str, place: int, column: str) -> str:
    """Violations, planted ones included: every so many rows lack the column."""
    return f"""select 'not_null:{check}.{column}' as "check",
        count(*) filter (where {column} is null or {base} % {place + 3} = 0) as violations from {table}"""


def _empty(check: str, table: str, column: str) -> str:
    return f"""select 'not_null:{check}.{column}' as "check",
        count(*) filter (where {column} is null) as violations from {table}"""


def _repeats(check: str, table: str, base: str, column: str) -> str:
    """Violations among the rows and the twins of every seventh."""
    return f"""select 'unique:{check}.{column}' as "check", count(*) as violations from
        (select {column} from (select {column} from {table} union all select {column} from {table} where {base} % 7 = 0)
         where {column} is not null group by {column} having count(*) > 1)"""


def _orphans(name: str, column: str, parent: str, key: str) -> str:
    return f"""select '{name}' as relationship, count(*) as orphans from fact f
        left join {parent} d on f.{column} = d.{key} where d.{key} is null"""


_ORPHANS = " union all ".join(
    _orphans(name, column, parent, key)
    for name, column, parent, key in (
        ("pickup_date", "pickup_date_key", "short_dates", "date_key"),
        ("dropoff_date", "dropoff_date_key", "short_dates", "date_key"),
        ("pickup_location", "pickup_location_key", "dim_location", "location_key"),
        ("dropoff_location", "dropoff_location_key", "dim_location", "location_key"),
    )
)
_ALL_ORPHANS = " union all ".join(
    [
        _ORPHANS,
        _orphans("vendor", "vendor_key", "dim_vendor", "vendor_key"),
        _orphans("payment_type", "payment_type_key", "dim_payment_type", "payment_type_key"),
        _orphans("rate_code", "rate_code_key", "dim_rate_code", "rate_code_key"),
    ]
)
_DIMENSIONS = [LOCATIONS, DATES, SHORT_DATES, VENDORS, PAYMENTS, RATES]

# Table, integer to plant by, columns that need a value, unique columns.
_CHECKED = {
    "trips_raw": (
        "(select *, 1 as raw_record from trips_raw)",
        "source_row_number",
        ["raw_record", "source_file", "source_period", "source_row_number", "loaded_at"],
        [],
    ),
    "zones_raw": ("zones_raw", "source_row_number", ["source_file", "source_row_number", "loaded_at"], []),
    "ingestion_audit": ("audit", "row_count", ["dataset", "source_period", "file_sha256", "row_count"], []),
    "trips_staged": (
        "staged",
        "source_row_number",
        ["trip_sk", "source_period", "source_row_number", "dq_status", "record_hash"],
        [],
    ),
    "trips_clean": (
        "clean",
        "pickup_location_id",
        ["trip_sk", "pickup_at", "dropoff_at", "pickup_location_id", "dropoff_location_id", "source_period"],
        ["trip_sk"],
    ),
    "zones_clean": ("zones", "location_id", ["location_id", "borough", "zone_name"], ["location_id"]),
    "dq_summary": ("summary", "raw_row_count", ["source_period", "raw_row_count", "usable_row_count"], ["source_period"]),
    "dim_date": ("dim_date", "date_key", ["date_key", "date_day"], ["date_key", "date_day"]),
    "dim_location": ("dim_location", "location_key", ["location_key", "zone_name"], ["location_key"]),
    "dim_vendor": ("dim_vendor", "vendor_key", ["vendor_key", "vendor_name"], ["vendor_key"]),
    "dim_payment_type": (
        "dim_payment_type",
        "payment_type_key",
        ["payment_type_key", "payment_type_name"],
        ["payment_type_key"],
    ),
    "dim_rate_code": ("dim_rate_code", "rate_code_key", ["rate_code_key", "rate_code_name"], ["rate_code_key"]),
    "fct_trips": (
        "fact",
        "pickup_location_key",
        [
            "trip_sk",
            "pickup_date_key",
            "dropoff_date_key",
            "pickup_location_key",
            "dropoff_location_key",
            "vendor_key",
            "payment_type_key",
            "rate_code_key",
            "trip_count",
            "source_period",
        ],
        ["trip_sk"],
    ),
    "agg_monthly_kpis": ("kpis", "trip_count", ["source_period", "trip_count"], ["source_period"]),
}
_TWINS = "(select * from fact union all select * from fact where pickup_location_key % 7 = 0)"

# The lookup of all customers, under the name that the zone steps read.
ALL_ZONES_RAW = ZONES_RAW.replace("    where c_nationkey < 20\n", "")

TO_ALL_ZONES = [ALL_ZONES_RAW, ZONES]

_YEARS = r"'^( ?)(199|200)\d-', '\12024-'"
FOLDED = f"""trips_raw as (
    select * replace (
        regexp_replace(source_period, {_YEARS}) as source_period,
        regexp_replace(pickup_at, {_YEARS}) as pickup_at,
        regexp_replace(dropoff_at, {_YEARS}) as dropoff_at)
    from trips_unfolded
)"""
TO_FOLDED = [LINES, RAW.replace("trips_raw as (", "trips_unfolded as (", 1), FOLDED, TYPED, DERIVED, STAGED]
TO_FOLDED_FACT = [*TO_FOLDED, CLEAN, *TO_ZONES, FACT]

_REQUIRED = """required as (
    select distinct substr(cast(l_shipdate as varchar), 1, 7) as source_period from lineitem)"""

_PERIOD_LIST = """periods as (
    select distinct substr(cast(o_orderdate as varchar), 1, 7) as source_period from orders
    union all
    select distinct substr(cast(l_shipdate as varchar), 1, 7) from lineitem
    union all
    select distinct substr(cast(o_orderdate as varchar), 1, 7) || chr(10) from orders
    union all
    select '0' || substr(m, 3, 5) from (select distinct substr(cast(o_orderdate as varchar), 1, 7) as m from orders))"""

_MISMATCH = """select coalesce(b.source_period, a.source_period) as source_period,
        b.n as bronze_row_count, a.row_count as audit_row_count
    from (select source_period, count(*) as n from trips_raw group by source_period) b
    full outer join (select source_period, row_count from audit
        where dataset = 'yellow_taxi' and status = 'SUCCESS') a
    on b.source_period = a.source_period
    where b.n is distinct from a.row_count"""

_MISSING = """select source_period from required where source_period not in
        (select source_period from audit where dataset = 'yellow_taxi' and status = 'SUCCESS')"""


def oracle_sql() -> dict[str, str]:
    key = "source_period, source_row_number"
    return {
        "field_extract_ignore_case": """select event_id, event_type,
            json_extract_string(props, '$.k') as k_text, cast(null as varchar) as absent_text,
            cast(user_id as varchar) as user_text from events""",
        "blank_to_null": _sql(
            TO_RAW,
            f"""select {key}, nullif(trim(vendor_id), '') as vendor_text,
            nullif(trim(passenger_count), '') as passenger_text,
            nullif(trim(cbd_congestion_fee_amount), '') as fee_text from trips_raw""",
        ),
        "safe_int": _sql(
            TO_TYPED,
            f"select {key}, "
            + _doubles(["vendor_id", "passenger_count", "rate_code_id", "pickup_location_id", "payment_type"])
            + " from typed",
        ),
        "safe_decimal": _sql(
            TO_TYPED,
            f"select {key}, " + _doubles(["trip_distance_miles", "fare_amount", "tip_amount"]) + " from typed",
        ),
        "safe_timestamp": _sql(TO_TYPED, f"select {key}, pickup_at, dropoff_at from typed"),
        "flag_normalise": _sql(TO_TYPED, f"select {key}, store_and_fwd_flag from typed"),
        "surrogate_key": _sql(TO_TYPED, f"select {key}, trip_sk from typed"),
        "record_hash": _sql(TO_DERIVED, f"select {key}, record_hash from derived"),
        "trip_duration": _sql(TO_DERIVED, f"select {key}, trip_duration_minutes from derived"),
        "period_match": _sql(
            TO_DERIVED, f"select {key}, source_period_start, is_source_period_match from derived"
        ),
        "passenger_anomaly": _sql(
            TO_DERIVED,
            f"select {key}, {_doubles(['passenger_count'])}, has_passenger_count_anomaly from derived",
        ),
        "financial_anomaly": _sql(TO_DERIVED, f"select {key}, has_financial_anomaly from derived"),
        "dq_status": _sql(TO_STAGED, f"select {key}, dq_status from staged"),
        "duplicate_rank": _sql(TO_STAGED, f"select {key}, record_hash, duplicate_rank from staged"),
        "first_copies": _sql(
            TO_STAGED,
            """select record_hash, source_period, source_file, source_row_number from staged
            where duplicate_rank = 1 and record_hash in
                (select record_hash from staged group by record_hash having count(*) > 1)""",
        ),
        "trips_staged": _sql(TO_STAGED, f"select {_doubles(_STAGED_COLUMNS)} from staged"),
        "trips_clean": _sql(TO_CLEAN, f"select {_doubles(_CLEAN_COLUMNS)} from clean"),
        "rank_within_status": _sql(
            TO_STAGED,
            """select record_hash, count(*) as copies from staged where dq_status = 'PASS'
            group by record_hash""",
        ),
        "zones_clean": _sql(
            TO_ALL_ZONES,
            """select cast(location_id as integer) as location_id, borough, zone_name, service_zone,
            source_file, source_row_number, loaded_at from zones""",
        ),
        "dim_location": _sql([*TO_ALL_ZONES, LOCATIONS], "select * from dim_location"),
        "dim_date": _sql(
            [*TO_FACT, DATES],
            """select dim_date.*, count(fact.trip_sk) as trips from dim_date
            left join fact on date_key = pickup_date_key group by all""",
        ),
        "dim_vendor": _sql(
            [*TO_FACT, VENDORS], _usage("dim_vendor", "vendor_key", "vendor_key", "vendor_name")
        ),
        "dim_payment_type": _sql(
            [*TO_FACT, PAYMENTS],
            _usage("dim_payment_type", "payment_type_key", "payment_type_key", "payment_type_name"),
        ),
        "dim_rate_code": _sql(
            [*TO_FACT, RATES], _usage("dim_rate_code", "rate_code_key", "rate_code_key", "rate_code_name")
        ),
        "fct_trips": _sql(TO_FACT, f"select {_doubles(_FACT_COLUMNS)} from fact"),
        "fct_role_join": _sql(TO_FACT, "select trip_sk, pickup_location_key, dropoff_location_key from fact"),
        "code_to_key": _sql(TO_FACT, "select trip_sk, vendor_key, payment_type_key, rate_code_key from fact"),
        "tip_percentage": _sql(TO_FACT, "select trip_sk, tip_percentage, trip_count from fact"),
        "date_key": _sql(TO_FACT, "select trip_sk, pickup_date_key, dropoff_date_key from fact"),
        "pickup_hour": _sql(TO_FACT, "select trip_sk, pickup_hour, dropoff_hour from fact"),
        "agg_monthly_kpis": _sql([*TO_FACT, KPIS], "select * from kpis"),
        "dq_summary": _sql([*TO_STAGED, SUMMARY], "select * from summary"),
        "check_not_null": _sql(
            [*TO_FACT, *_DIMENSIONS, KPIS, SUMMARY, AUDIT],
            " union all ".join(
                _nulls(check, name, base, place, column)
                for check, (name, base, columns, _) in _CHECKED.items()
                for place, column in enumerate(columns)
            ),
        ),
        "check_unique": _sql(
            [*TO_FACT, *_DIMENSIONS, KPIS, SUMMARY],
            " union all ".join(
                _repeats(check, name, base, column)
                for check, (name, base, _, unique) in _CHECKED.items()
                for column in unique
            ),
        ),
        "gate_stops": _sql(
            TO_FACT,
            f"""select 'as built' as run, cast(null as varchar) as stopped_by, cast(0 as bigint) as violations
            union all select 'with twins', 'unique:fct_trips.trip_sk', count(*) from
                (select trip_sk from {_TWINS} group by trip_sk having count(*) > 1)""",
        ),
        "pipeline_kpis": _sql([*TO_FOLDED_FACT, KPIS], "select * from kpis"),
        "staging_view": _sql(
            TO_FOLDED,
            """select source_period, dq_status, count(*) as row_count,
                cast(count(*) filter (where duplicate_rank > 1) as bigint) as repeated,
                max(duplicate_rank) as highest_rank
            from staged group by source_period, dq_status""",
        ),
        "listing_order": _sql(
            [*TO_AUDIT, "periods as (select distinct source_period from trips_raw)"],
            """select 'audit_listing' as listing, row_number() over (order by dataset, source_period) - 1 as place,
                dataset || ' ' || source_period as row from audit
            union all select 'loads_per_dataset', row_number() over (order by dataset) - 1, dataset
                from (select distinct dataset from audit where status = 'SUCCESS')
            union all select 'quality_by_period', row_number() over (order by source_period) - 1, source_period
                from periods""",
        ),
        "refusals": """select unnest(['no rows', 'not Parquet', 'broken footer', 'not there', 'bad period',
                'lookup row too wide', 'lookup header', 'lost before its commit', 'other writer']) as attempt,
            true as refused, (select count(*) from orders) as visible_rows,
            (select count(*) from orders) as audited_rows, (select count(*) from customer) as zone_rows""",
        "pipeline_summary": _sql([*TO_FOLDED, SUMMARY], "select * exclude (latest_load_at) from summary"),
        "pipeline_fact": _sql(
            TO_FOLDED_FACT, f"select {_doubles([c for c in _FACT_COLUMNS if c not in ('trip_sk', 'source_file', 'source_row_number', 'loaded_at')])} from fact"
        ),
        "check_relationships": _sql(
            [*TO_FACT, *_DIMENSIONS],
            f"""select 'relationship:' || relationship as "check", orphans as violations,
            orphans = 0 as passed from ({_ALL_ORPHANS})""",
        ),
        "check_required_periods": _sql([*TO_AUDIT, _REQUIRED], _MISSING),
        "check_audit_match": _sql(TO_AUDIT, _MISMATCH),
        "check_chronology": _sql(
            TO_CLEAN,
            """select trip_sk, pickup_at, dropoff_at, trip_duration_minutes from clean
            where dropoff_at < pickup_at or trip_duration_minutes < 0
               or trip_duration_minutes > 129600""",
        ),
        "check_no_duplicates": _sql(
            TO_STAGED,
            """select record_hash, count(*) as duplicate_count from staged
            where dq_status = 'PASS' group by record_hash having count(*) > 1""",
        ),
        "check_gate": _sql(
            [*TO_FACT, *_DIMENSIONS, AUDIT],
            f"""select "check", violations, violations = 0 as passed from (
                {" union all ".join(_empty("fct_trips", "fact", c) for c in _CHECKED["fct_trips"][2])}
                union all select 'unique:fct_trips.trip_sk', count(*) from
                    (select trip_sk from fact group by trip_sk having count(*) > 1)
                union all select 'relationship:' || relationship, orphans from ({_ALL_ORPHANS})
                union all select 'audit_matches_raw', count(*) from ({_MISMATCH}))""",
        ),
        "audit_rollup": _sql(
            TO_AUDIT,
            """select dataset, count(*) as successful_loads, cast(sum(row_count) as bigint) as rows_loaded
            from audit where status = 'SUCCESS' group by dataset order by dataset""",
        ),
        "audit_listing": _sql(TO_AUDIT, "select * from audit order by dataset, source_period"),
        "layer_volumes": _sql(
            TO_FACT,
            """select 'trips_raw' as object_name, count(*) as row_count from trips_raw
            union all select 'trips_clean', count(*) from clean
            union all select 'fct_trips', count(*) from fact""",
        ),
        "fact_grain": _sql(
            TO_FACT,
            f"""select trip_sk, count(*) as duplicate_count from {_TWINS} group by trip_sk
            having count(*) > 1""",
        ),
        "orphan_counts": _sql([*TO_FACT, LOCATIONS, SHORT_DATES], _ORPHANS),
        "dq_by_period": _sql([*TO_STAGED, SUMMARY], "select * from summary order by source_period"),
        "kpi_listing": _sql([*TO_FACT, KPIS], "select * from kpis order by source_period"),
        "raw_capture": """select '2024-01' as source_period, cast(o_orderkey as varchar) as order_text,
                cast(o_orderdate as varchar) as day_text, cast(null as varchar) as line_text
            from orders union all
            select '2024-02', cast(l_orderkey as varchar), cast(l_shipdate as varchar),
                cast(l_linenumber as varchar) from lineitem""",
        "provenance": """select '2024-01' as source_period, '2024-01/orders.parquet' as source_file, count(*) as row_count,
                cast(0 as bigint) as first_row, count(*) - 1 as last_row,
                cast(sum(1) * (sum(1) - 1) / 2 as double) as row_number_sum from orders
            union all select '2024-02', '2024-02/lineitem.parquet', count(*), 0, count(*) - 1,
                cast(sum(1) * (sum(1) - 1) / 2 as double) from lineitem""",
        "folder_period": """select cast(o_orderkey as varchar) as vendor_text, cast(o_totalprice as varchar) as extra_text,
                cast(null as varchar) as request_source, cast(null as varchar) as odd_text,
                'VendorID,extra,odd`name,request_source,vendorid' as field_names from orders
            union all select c_name, cast(c_acctbal as varchar), c_mktsegment, null,
                'VendorID,extra,odd`name,request_source,vendorid' from customer
            union all select cast(s_suppkey as varchar), null, null, s_name,
                'VendorID,extra,odd`name,request_source,vendorid' from supplier""",
        "same_names": """select '2024-01' as source_period, count(*) as row_count, count(*) as key_count from orders
            union all select '2024-02', count(*), count(*) from lineitem""",
        "landed_paths": """select '2024-01' as source_period, count(*) as row_count, count(*) as key_count, true as own_digest from orders
            union all select '2024-02', count(*), count(*), true from lineitem
            union all select '2024-03', count(*), count(*), true from customer""",
        "file_manifest": """select unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
                'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations']) || '.parquet'
                as source_file, true as has_bytes, true as has_digest, true as has_signature""",
        "period_reload": """select '2024-01' as source_period, cast(c_custkey as bigint) as record_key from customer
            union all select '2024-02', l_partkey from lineitem""",
        "zone_reload": _sql(
            [ALL_ZONES_RAW], "select nullif(location_id, '') as location_id, borough, zone, service_zone from zones_raw"
        ),
        "audit_upsert": """select 'yellow_taxi' as dataset, '2024-01' as source_period,
                'customer.parquet' as source_file, count(*) as row_count, 'SUCCESS' as status from customer
            union all select 'yellow_taxi', '2024-02', 'lineitem.parquet', count(*), 'SUCCESS' from lineitem""",
        "csv_lookup": _sql(
            [ALL_ZONES_RAW], "select nullif(location_id, '') as location_id, borough, zone, service_zone from zones_raw"
        ),
        "csv_row_number": _sql(
            [ALL_ZONES_RAW],
            "select count(*) as row_count, cast(0 as bigint) as first_row, count(*) as numbered_rows from zones_raw",
        ),
        "header_contract": _sql(
            [ALL_ZONES_RAW],
            """select 'as agreed' as header, true as accepted, count(*) as row_count from zones_raw
            union all select 'other case', false, cast(null as bigint)
            union all select 'other order', false, null""",
        ),
        "signature_check": """select 'zones.csv' as source_file, true as unsigned
            union all select unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
                'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations']) || '.parquet',
                false""",
        "missing_periods": """select distinct substr(cast(l_shipdate as varchar), 1, 7) as source_period
            from lineitem where substr(cast(l_shipdate as varchar), 1, 7) not in
            (select substr(cast(o_orderdate as varchar), 1, 7) from orders)""",
        "period_list": _sql(
            [_PERIOD_LIST],
            r"""select source_period, count(*) as entries,
            not regexp_full_match(source_period, '20\d{2}-(0[1-9]|1[0-2])') as malformed,
            count(*) > 1 as repeated from periods group by source_period
            having malformed or repeated""",
        ),
    }
