"""Zones and the dimensions of the trip star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import fields as fx
from tripmart.functions import keys, measures
from tripmart.operators.dedup import keep_first
from tripmart.operators.lookup import UNKNOWN
from tripmart.sources.inline import days, values

# Members of the code dimensions.
UNMAPPED = "Unknown or unmapped"
VENDORS = [
    (-1, UNMAPPED),
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]
PAYMENT_TYPES = [
    (-1, UNMAPPED),
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES = [
    (-1, UNMAPPED),
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null or unknown"),
]

# The calendar span.
FIRST_DAY = "2024-01-01"
LAST_DAY = "2027-12-31"


def zones_clean(raw_zones: DataFrame) -> DataFrame:
    """Typed and normalised zones, the latest row per id.

    The id has five digits, so there are fewer than 200,000 zones.
    """
    tidy = raw_zones.select(
        fx.safe_integer(F.col("location_id"), 5).alias("location_id"),
        F.upper(fx.squeeze(F.col("borough"))).alias("borough"),
        fx.squeeze(F.col("zone")).alias("zone_name"),
        F.upper(fx.squeeze(F.col("service_zone"))).alias("service_zone"),
        "source_file",
        "source_row_number",
        "loaded_at",
    ).filter(F.col("location_id").isNotNull())
    latest = [F.col("loaded_at").desc_nulls_last(), F.col("source_row_number").asc_nulls_last()]
    return keep_first(tidy, ["location_id"], latest)


def dim_location(zones: DataFrame) -> DataFrame:
    """Zones and the unknown member."""
    unknown = values(
        zones.sparkSession,
        [(UNKNOWN, "UNKNOWN", UNMAPPED, "UNKNOWN")],
        "location_key int, borough string, zone_name string, service_zone string",
    )
    members = zones.select(
        F.col("location_id").cast("int").alias("location_key"),
        "borough",
        "zone_name",
        F.coalesce("service_zone", F.lit("UNKNOWN")).alias("service_zone"),
    )
    return unknown.unionByName(members)


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row per calendar day."""
    count = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    return calendar(days(spark, first, count))


def calendar(dates: DataFrame) -> DataFrame:
    """Calendar attributes of ``date_day``."""
    day = F.col("date_day")
    weekday = measures.iso_weekday(day)
    return dates.select(
        keys.date_key(day).alias("date_key"),
        "date_day",
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).alias("iso_week_number"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("iso_day_of_week"),
        F.dayname(day).alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def dim_vendor(spark: SparkSession) -> DataFrame:
    return values(spark, VENDORS, "vendor_key int, vendor_name string")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return values(spark, PAYMENT_TYPES, "payment_type_key int, payment_type_name string")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return values(spark, RATE_CODES, "rate_code_key int, rate_code_name string")
