from datetime import date, datetime, timedelta
from decimal import Decimal

from helpers import texts
from pyspark.sql import functions as F

from tripmart.operators import lookup
from tripmart.plans import dims, facts, trips

ZONE_SCHEMA = (
    "location_id string, borough string, zone string, service_zone string, source_file string, "
    "source_row_number long, loaded_at timestamp"
)


def raw_zones(spark, *rows):
    at = datetime(2025, 1, 1)
    full = [(*row[:4], "z.csv", n, row[4] if len(row) > 4 else at) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, ZONE_SCHEMA)


def zones(spark):
    return dims.zones_clean(raw_zones(spark, ("10", "Queens", "A", "x"), ("20", "Bronx", "B", None)))


def test_zones_are_normalised_and_the_latest_wins(spark):
    new = datetime(2025, 6, 1)
    rows = dims.zones_clean(
        raw_zones(
            spark,
            ("1", " staten   island", "Old  name ", "boro  zone"),
            (" 1 ", "new\tside", "New  Name", None, new),
            ("1", "later row", "same load", None, new),
            ("x", "b", "z", "s"),
            (None, "b", "z", "s"),
            ("100000", "b", "too many digits", "s"),
        )
    ).collect()
    assert [(int(r.location_id), r.borough, r.zone_name, r.service_zone, r.source_row_number) for r in rows] == [
        (1, "NEW SIDE", "New Name", None, 1)
    ]


def test_location_has_an_unknown_member(spark):
    got = {r.location_key: (r.borough, r.zone_name, r.service_zone) for r in dims.dim_location(zones(spark)).collect()}
    assert got == {
        -1: ("UNKNOWN", "Unknown or unmapped", "UNKNOWN"),
        10: ("QUEENS", "A", "X"),
        20: ("BRONX", "B", "UNKNOWN"),
    }


def test_calendar(spark):
    rows = {r.date_day: r for r in dims.dim_date(spark).collect()}
    assert len(rows) == 1461
    day = date(2024, 1, 1)
    while day <= date(2027, 12, 31):
        r, iso = rows[day], day.isocalendar()
        assert (r.date_key, r.year_number, r.quarter_number, r.month_number, r.day_of_month) == (
            int(day.strftime("%Y%m%d")),
            day.year,
            (day.month + 2) // 3,
            day.month,
            day.day,
        )
        assert (r.iso_week_number, r.iso_day_of_week, r.is_weekend) == (iso.week, iso.weekday, iso.weekday > 5)
        assert (r.month_name, r.day_name) == (day.strftime("%b"), day.strftime("%a"))
        day += timedelta(days=1)


def test_code_dimensions(spark):
    assert [dims.dim_vendor(spark).count(), dims.dim_payment_type(spark).count(), dims.dim_rate_code(spark).count()] == [
        5,
        8,
        8,
    ]
    assert "LocalTableScan" in dims.dim_vendor(spark)._jdf.queryExecution().executedPlan().toString()


def fact_rows(spark, *changes):
    clean = trips.clean(trips.labelled(texts(spark, list(changes))))
    return facts.fct_trips(clean, zones(spark))


def test_fact_keys(spark):
    rows = fact_rows(
        spark,
        {},
        {"pickup_location_id": "77", "vendor_id": "3", "payment_type": "9", "rate_code_id": "7"},
        {"dropoff_location_id": "99999", "vendor_id": None, "payment_type": "0", "rate_code_id": "99"},
    ).orderBy("source_row_number")
    got = [
        (r.pickup_location_key, r.dropoff_location_key, r.vendor_key, r.payment_type_key, r.rate_code_key)
        for r in rows.collect()
    ]
    assert got == [(10, 20, 1, 1, 1), (-1, 20, -1, -1, -1), (10, -1, -1, 0, 99)]


def test_fact_measures(spark):
    rows = fact_rows(
        spark,
        {"pickup_at": "2025-01-31 23:59:00", "dropoff_at": "2025-02-01 00:09:10"},
        {"fare_amount": "0"},
        {"fare_amount": "-3"},
        {"tip_amount": None},
    ).orderBy("source_row_number").collect()
    first = rows[0]
    assert (first.pickup_date_key, first.dropoff_date_key, first.pickup_hour, first.dropoff_hour) == (
        20250131,
        20250201,
        23,
        0,
    )
    assert (first.trip_duration_minutes, first.tip_percentage, first.trip_count) == (Decimal("10.17"), Decimal(25), 1)
    assert [r.tip_percentage for r in rows[1:]] == [None, None, None]
    assert len(rows[0]) == 32


def test_fact_keeps_every_trip_and_shuffles_none(spark):
    labels = trips.labelled(texts(spark, [{"fare_amount": str(i)} for i in range(50)]))
    clean = labels.select(*trips.CLEAN_COLUMNS)
    fact = facts.fct_trips(clean, zones(spark))
    assert fact.count() == clean.count() == 50
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_kpis(spark):
    rows = {
        r.source_period: r
        for r in facts.agg_monthly_kpis(
            fact_rows(
                spark,
                {"trip_distance_miles": "1.111"},
                {"trip_distance_miles": "2.222", "passenger_count": None, "payment_type": "2", "tip_amount": "-1"},
                {"fare_amount": "0", "trip_distance_miles": "0"},
                {"source_period": "2025-02", "pickup_at": "2025-02-01", "dropoff_at": "2025-02-01", "fare_amount": "0"},
            )
        ).collect()
    }
    january, february = rows["2025-01"], rows["2025-02"]
    assert (january.trip_count, january.reported_passenger_count) == (3, 4)
    assert (january.total_distance_miles, january.avg_distance_miles) == (Decimal("3.33"), Decimal("1.11"))
    assert (january.total_tip_amount, january.avg_tip_percentage) == (Decimal("9.00"), Decimal("10.00"))
    assert (january.credit_card_trip_count, january.financial_anomaly_count) == (2, 1)
    assert january.avg_duration_minutes == Decimal("30.00")
    assert february.avg_tip_percentage is None and february.avg_duration_minutes == 0


def test_orphans_are_counted_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([(1, 1), (1, 9), (9, 9), (None, 2)], "a int, b int").coalesce(1).write.parquet(path)
    fact = spark.read.parquet(path)
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    refs = [lookup.Reference("a", "a", parent, "k"), lookup.Reference("b", "b", parent, "k")]
    result = lookup.orphan_counts(fact, refs)
    assert {r.relationship: r.orphans for r in result.collect()} == {"a": 1, "b": 2}
    assert {r.relationship: r.orphans for r in lookup.orphan_counts(fact, refs, True).collect()} == {"a": 2, "b": 2}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = result.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 1


def test_text_keys(spark):
    fact = spark.createDataFrame([("x", 1), ("y", 5)], "k string, n int")
    parents = spark.createDataFrame([("x", 1)], "id string, n int")
    refs = [lookup.Reference("k", "k", parents, "id"), lookup.Reference("n", "n", parents, "n")]
    assert {r.relationship: r.orphans for r in lookup.orphan_counts(fact, refs).collect()} == {"k": 1, "n": 1}


def test_keys_of_another_type_still_match(spark):
    fact = spark.createDataFrame([("7",), ("8",)], "k string").select(F.col("k").cast("decimal(5,0)").alias("k"))
    refs = [lookup.Reference("k", "k", spark.createDataFrame([(7,)], "id int"), "id")]
    assert lookup.orphan_counts(fact, refs).first().orphans == 1
