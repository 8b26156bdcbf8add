"""Small hand-made trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.plans.trips import FIELDS

GOOD = {
    "vendor_id": "1",
    "pickup_at": "2025-01-10 08:00:00",
    "dropoff_at": "2025-01-10 08:30:00",
    "passenger_count": "2",
    "trip_distance_miles": "3.5",
    "rate_code_id": "1",
    "store_and_fwd_flag": "N",
    "pickup_location_id": "10",
    "dropoff_location_id": "20",
    "payment_type": "1",
    "fare_amount": "20.00",
    "tip_amount": "5.00",
    "total_amount": "25.00",
}


def texts(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Text trips: each row is GOOD with some changes, numbered in order."""
    columns = ["source_period", "source_file", "source_row_number", *FIELDS]
    values = []
    for number, change in enumerate(rows):
        row = {
            "source_period": "2025-01",
            "source_file": "a.parquet",
            "source_row_number": number,
            **GOOD,
            **change,
        }
        values.append(tuple(row.get(c) for c in columns))
    schema = "source_period string, source_file string, source_row_number long, " + ", ".join(
        f"{c} string" for c in FIELDS
    )
    return spark.createDataFrame(values, schema).selectExpr(
        "*", "timestamp_ntz'2025-02-01 00:00:00' AS loaded_at"
    )
