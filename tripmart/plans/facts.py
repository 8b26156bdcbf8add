"""The trip fact and its monthly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import keys, measures
from tripmart.operators.lookup import known_or_unknown, resolve_key
from tripmart.plans import dims
from tripmart.plans.trips import AMOUNTS

# Columns of the fact.
FACT_COLUMNS = [
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
    *AMOUNTS,
    "tip_percentage",
    "trip_count",
    "has_passenger_count_anomaly",
    "has_financial_anomaly",
    "source_period",
    "source_file",
    "source_row_number",
    "loaded_at",
]


def _members(rows: list[tuple]) -> list[int]:
    return [key for key, _ in rows]


def fct_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per accepted trip with all keys resolved; no trip is shuffled.

    Only the zone id is broadcast. It has five digits and is unique, so it can
    never exceed 200,000 values. Code lists are the dimensions' own members.
    """
    zone_ids = F.broadcast(zones.select("location_id"))
    located = resolve_key(
        resolve_key(trips, "pickup_location_id", zone_ids, "location_id", "pickup_location_key"),
        "dropoff_location_id",
        zone_ids,
        "location_id",
        "dropoff_location_key",
    )
    code_keys = {
        "vendor_key": ("vendor_id", dims.VENDORS),
        "payment_type_key": ("payment_type", dims.PAYMENT_TYPES),
        "rate_code_key": ("rate_code_id", dims.RATE_CODES),
    }
    return located.withColumns(
        {
            "pickup_date_key": keys.date_key(F.col("pickup_at")),
            "dropoff_date_key": keys.date_key(F.col("dropoff_at")),
            "pickup_location_key": F.col("pickup_location_key").cast("int"),
            "dropoff_location_key": F.col("dropoff_location_key").cast("int"),
            **{
                key: known_or_unknown(F.col(code), _members(rows)).cast("int")
                for key, (code, rows) in code_keys.items()
            },
            "pickup_hour": F.hour("pickup_at"),
            "dropoff_hour": F.hour("dropoff_at"),
            "tip_percentage": measures.percentage(F.col("tip_amount"), F.col("fare_amount")),
            "trip_count": F.lit(1).cast("long"),
        }
    ).select(*FACT_COLUMNS)


def agg_monthly_kpis(facts: DataFrame) -> DataFrame:
    """Business measures per period."""
    return facts.groupBy("source_period").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(F.coalesce("passenger_count", F.lit(0).cast("decimal(5,0)"))).alias(
            "reported_passenger_count"
        ),
        F.round(F.sum("trip_distance_miles"), 2).alias("total_distance_miles"),
        F.round(F.avg("trip_distance_miles"), 2).alias("avg_distance_miles"),
        F.round(F.avg("trip_duration_minutes"), 2).alias("avg_duration_minutes"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue_amount"),
        F.round(F.sum("tip_amount"), 2).alias("total_tip_amount"),
        F.round(F.avg("tip_percentage"), 2).alias("avg_tip_percentage"),
        F.count_if(F.col("payment_type_key") == 1).alias("credit_card_trip_count"),
        F.count_if("has_financial_anomaly").alias("financial_anomaly_count"),
    )
