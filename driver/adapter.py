"""Messy trip records made from the test tables.

Order lines stand in for trips: order date is the pickup, ship date the
dropoff, customer and supplier nations are the locations. Some values are
spoiled on purpose so that every quality rule has rows. Everything is text, as
it comes out of a raw record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans.trips import FIELDS, Limits

# Most order lines ship long after the order, so the limit is a year here.
LIMITS = Limits(max_duration_seconds=365 * 86_400)
MAX_MINUTES = LIMITS.max_duration_seconds // 60

# More suppliers than these, two numbers each, are not broadcast.
BROADCAST_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _money(column: str) -> Column:
    """Stored two-digit double as an exact decimal."""
    return F.col(column).cast("decimal(14,2)")


def _text(column: Column) -> Column:
    return column.cast("string")


def _if_small(rows: DataFrame) -> DataFrame:
    """Rows to be broadcast unless there are very many."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text column per trip field, plus provenance."""
    lines = table(spark, sf_dir, "lineitem")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers before their lines, so that the many lines are shuffled once.
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    # A moment's text is made once: of an order before its lines meet it, of a line below.
    orders = orders.select("o_orderkey", "c_nationkey", _text(F.col("o_orderdate")).alias("o_orderdate"))
    joined = (
        # Both sides grow with the data, so they meet by a shuffle.
        lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_if_small(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # Some lines occur twice, as exact copies of the business record.
    copied = joined.withColumn("l_shipdate", _text(F.col("l_shipdate"))).withColumn(
        "copy", F.explode(F.when(_every("l_partkey", 53), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    fare = _money("l_extendedprice")
    tip = F.round(fare * F.col("l_discount").cast("decimal(4,2)"), 2)
    misfiled = _every("l_orderkey", 41) & (F.col("copy") == 0)
    period = F.substring(F.when(misfiled, F.col("l_shipdate")).otherwise(F.col("o_orderdate")), 1, 7)
    # A stand-in row number: the line in the high bits, part, supplier and copy below.
    row = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * (1 << 22) + (
        F.pmod(F.col("l_partkey") * 1_000_003 + F.col("l_suppkey"), F.lit(1 << 21)) * 2 + F.col("copy")
    )
    texts = {
        "vendor_id": F.when(_every("l_suppkey", 13), "")
        .when(_every("l_suppkey", 17), "1000")
        .otherwise(_text(F.col("l_suppkey") % 9)),
        "pickup_at": F.when(_every("l_partkey", 67), "not-a-time")
        .when(_every("l_partkey", 97), F.lit(None))
        .otherwise(F.concat(F.lit(" "), F.col("o_orderdate"))),
        "dropoff_at": F.col("l_shipdate"),
        "passenger_count": F.when(_every("l_partkey", 71), "12")
        .when(_every("l_partkey", 73), "-1")
        .when(_every("l_partkey", 79), F.lit(None))
        .when(_every("l_partkey", 7), "  ")
        .otherwise(F.concat(_text(F.col("l_linenumber")), F.lit(".0"))),
        "trip_distance_miles": F.when(_every("l_partkey", 59), "-1.5")
        .when(_every("l_partkey", 61), "x")
        .otherwise(
            F.concat(
                _text(F.col("l_quantity").cast("int")), F.lit("."), F.lpad(_text(F.col("l_partkey") % 10_000), 4, "0")
            )
        ),
        "rate_code_id": F.when(_every("l_orderkey", 9), F.lit(None))
        .when(F.col("l_orderkey") % 9 == 7, "99")
        .when(F.col("l_orderkey") % 9 == 8, "abc")
        .otherwise(_text(F.col("l_orderkey") % 9)),
        "store_and_fwd_flag": F.when(F.col("l_returnflag") == "A", " y")
        .when(F.col("l_returnflag") == "N", "N ")
        .otherwise(F.col("l_returnflag")),
        "pickup_location_id": _text(F.col("c_nationkey")),
        "dropoff_location_id": _text(F.col("s_nationkey")),
        "payment_type": _text(F.col("l_orderkey") % 10),
        "fare_amount": F.concat(F.when(_every("l_partkey", 83), "-").otherwise(""), _text(fare)),
        "extra_amount": _text(_money("l_tax")),
        "mta_tax_amount": F.when(_every("l_partkey", 89), "-0.50").otherwise("0.50"),
        "tip_amount": _text(tip),
        "tolls_amount": F.when(_every("l_linenumber", 3), F.lit(None)).otherwise("6.94"),
        "improvement_surcharge_amount": F.lit("1.00"),
        "total_amount": _text(fare + tip),
        "congestion_surcharge_amount": F.when(_every("l_orderkey", 2), "2.50"),
        "airport_fee_amount": F.when(_every("l_suppkey", 5), "1.75"),
        "cbd_congestion_fee_amount": F.when(_every("l_partkey", 4), "").otherwise("0.75"),
    }
    return copied.select(
        F.concat(F.lit("trips_"), period, F.lit(".parquet")).alias("source_file"),
        period.alias("source_period"),
        row.alias("source_row_number"),
        F.timestamp_add("SECOND", (F.col("l_orderkey") % 1000).cast("int"), F.lit("2024-06-01").cast("timestamp_ntz")).alias(
            "loaded_at"
        ),
        *(texts[name].alias(name) for name in FIELDS),
    )


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips as raw records; even orders spell their keys in lower case."""
    texts = trips_raw(spark, sf_dir)

    def record(spell) -> Column:
        return F.to_variant_object(F.struct(*(F.col(c).alias(spell(key)) for c, key in FIELDS.items())))

    even = F.shiftright("source_row_number", 25) % 2 == 0
    return texts.select(
        F.when(even, record(str.lower)).otherwise(record(str)).alias("raw_record"),
        "source_file",
        "source_period",
        "source_row_number",
        "loaded_at",
    )


def observed_keys() -> list[str]:
    return sorted({*FIELDS.values(), *(key.lower() for key in FIELDS.values())})


def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup of the facts, which lacks the zones of some nations on purpose."""
    return lookup_raw(spark, sf_dir).filter(F.col("__nation") < 20).drop("__nation")


def lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup rows from all customers: many rows per zone id, some ids unusable."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    return (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.when(key % 19 == 0, "n/a")
            .when(key % 23 == 0, "")
            .otherwise(F.concat(F.lit(" "), _text(F.col("n_nationkey"))))
            .alias("location_id"),
            F.concat(F.lit("  "), F.lower("r_name"), F.lit("   side ")).alias("borough"),
            F.concat(F.col("n_name"), F.lit(",   Zone "), _text(key % 7)).alias("zone"),
            F.when(key % 3 != 0, F.concat(F.lower("c_mktsegment"), F.lit("  area"))).alias("service_zone"),
            F.lit("zones.csv").alias("source_file"),
            key.cast("long").alias("source_row_number"),
            F.timestamp_add("DAY", (key % 50).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias(
                "loaded_at"
            ),
            F.col("n_nationkey").alias("__nation"),
        )
    )


FOLDED_YEAR = "2024"


def folded_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with every year written as one leap year: twelve periods hold them all."""

    def fold(column: str) -> Column:
        return F.regexp_replace(column, r"^( ?)(199|200)\d-", f"$1{FOLDED_YEAR}-")

    rows = trips_raw(spark, sf_dir)
    return rows.withColumns({c: fold(c) for c in ("source_period", "pickup_at", "dropoff_at")})


def audit(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """An audit of the trips: some periods are counted wrong, failed or missing."""
    raw = trips_raw(spark, sf_dir) if raw is None else raw
    counted = raw.groupBy("source_period").agg(
        F.count(F.lit(1)).alias("rows"), F.max("loaded_at").alias("loaded_at")
    )
    month = F.substring("source_period", 6, 2).cast("int")
    trips = counted.filter(month != 12).select(
        F.lit("yellow_taxi").alias("dataset"),
        "source_period",
        F.concat(F.lit("landing/"), "source_period").alias("source_url"),
        F.concat(F.lit("trips_"), "source_period", F.lit(".parquet")).alias("source_file"),
        F.sha2("source_period", 256).alias("file_sha256"),
        (F.col("rows") * 100).alias("byte_count"),
        F.when(month == 6, F.col("rows") + 1).otherwise(F.col("rows")).alias("row_count"),
        "loaded_at",
        F.when(month == 3, "FAILED").otherwise("SUCCESS").alias("status"),
    )
    zones = zones_raw(spark, sf_dir).agg(
        F.lit("taxi_zone_lookup").alias("dataset"),
        F.lit("CURRENT").alias("source_period"),
        F.lit("landing/zones").alias("source_url"),
        F.lit("zones.csv").alias("source_file"),
        F.sha2(F.lit("zones"), 256).alias("file_sha256"),
        (F.count(F.lit(1)) * 10).alias("byte_count"),
        F.count(F.lit(1)).alias("row_count"),
        F.max("loaded_at").alias("loaded_at"),
        F.lit("SUCCESS").alias("status"),
    )
    return trips.unionByName(zones)
