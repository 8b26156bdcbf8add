"""The checks declared on each layer of the trip star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import checks as ck
from tripmart.operators.lookup import Reference
from tripmart.sources.lake import SUCCESS, TRIPS

REQUIRED_PERIODS_CHECK = "required_periods_loaded"

# The default list of periods.
REQUIRED_PERIODS = [f"2025-{m:02d}" for m in range(1, 13)] + [f"2026-{m:02d}" for m in range(1, 9)]

# Columns that must have a value, per table.
NOT_NULL = {
    "trips_raw": ["raw_record", "source_file", "source_period", "source_row_number", "loaded_at"],
    "zones_raw": ["source_file", "source_row_number", "loaded_at"],
    "ingestion_audit": ["dataset", "source_period", "file_sha256", "row_count"],
    "trips_staged": ["trip_sk", "source_period", "source_row_number", "dq_status", "record_hash"],
    "trips_clean": [
        "trip_sk",
        "pickup_at",
        "dropoff_at",
        "pickup_location_id",
        "dropoff_location_id",
        "source_period",
    ],
    "zones_clean": ["location_id", "borough", "zone_name"],
    "dq_summary": ["source_period", "raw_row_count", "usable_row_count"],
    "dim_date": ["date_key", "date_day"],
    "dim_location": ["location_key", "zone_name"],
    "dim_vendor": ["vendor_key", "vendor_name"],
    "dim_payment_type": ["payment_type_key", "payment_type_name"],
    "dim_rate_code": ["rate_code_key", "rate_code_name"],
    "fct_trips": [
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
    "agg_monthly_kpis": ["source_period", "trip_count"],
}

# Columns that must be unique, per table.
UNIQUE = {
    "trips_clean": ["trip_sk"],
    "zones_clean": ["location_id"],
    "dq_summary": ["source_period"],
    "dim_date": ["date_key", "date_day"],
    "dim_location": ["location_key"],
    "dim_vendor": ["vendor_key"],
    "dim_payment_type": ["payment_type_key"],
    "dim_rate_code": ["rate_code_key"],
    "fct_trips": ["trip_sk"],
    "agg_monthly_kpis": ["source_period"],
}

# Tables that have a row per trip.
LARGE = {"trips_clean", "fct_trips"}

# Fact key, dimension, dimension key.
REFERENCES = [
    ("pickup_date", "pickup_date_key", "dim_date", "date_key"),
    ("dropoff_date", "dropoff_date_key", "dim_date", "date_key"),
    ("pickup_location", "pickup_location_key", "dim_location", "location_key"),
    ("dropoff_location", "dropoff_location_key", "dim_location", "location_key"),
    ("vendor", "vendor_key", "dim_vendor", "vendor_key"),
    ("payment_type", "payment_type_key", "dim_payment_type", "payment_type_key"),
    ("rate_code", "rate_code_key", "dim_rate_code", "rate_code_key"),
]


def column_checks(tables: dict[str, DataFrame]) -> list:
    """Not-null and unique checks of the given tables."""
    found = [ck.not_null(df, name, NOT_NULL[name]) for name, df in tables.items() if name in NOT_NULL]
    found += [
        ck.unique(df, name, column, name in LARGE) for name, df in tables.items() for column in UNIQUE.get(name, [])
    ]
    return found


def references(dimensions: dict[str, DataFrame], names: Sequence[str] | None = None) -> list[Reference]:
    return [
        Reference(name, column, dimensions[table], key)
        for name, column, table, key in REFERENCES
        if names is None or name in names
    ]


def _loaded(audit: DataFrame, dataset: str) -> DataFrame:
    return audit.filter((F.col("dataset") == dataset) & (F.col("status") == SUCCESS))


def required_periods_loaded(audit: DataFrame, required: DataFrame, dataset: str = TRIPS) -> DataFrame:
    """Required periods without a successful load. Extra periods are fine."""
    return required.select("source_period").join(
        _loaded(audit, dataset).select("source_period"), "source_period", "left_anti"
    )


def audit_matches_raw(raw: DataFrame, audit: DataFrame, dataset: str = TRIPS) -> DataFrame:
    """Periods whose raw rows and audited rows differ."""
    counted = raw.groupBy("source_period").agg(F.count(F.lit(1)).alias("bronze_row_count"))
    audited = _loaded(audit, dataset).select(
        "source_period", F.col("row_count").alias("audit_row_count")
    )
    return ck.count_mismatches(
        counted, audited, "source_period", "bronze_row_count", "audit_row_count"
    )


def chronology_condition(max_minutes: int = 1440):
    minutes = F.col("trip_duration_minutes")
    return (F.col("dropoff_at") < F.col("pickup_at")) | (minutes < 0) | (minutes > max_minutes)


def chronology(clean: DataFrame, max_minutes: int = 1440) -> DataFrame:
    """Accepted trips that end before they start or last too long."""
    return clean.filter(chronology_condition(max_minutes)).select(
        "trip_sk", "pickup_at", "dropoff_at", "trip_duration_minutes"
    )


def record_duplicates(clean: DataFrame) -> DataFrame:
    """Records that were accepted more than once."""
    return ck.duplicates(clean, ["record_hash"])


def raw_checks(raw: DataFrame, zones: DataFrame) -> list:
    return column_checks({"trips_raw": raw, "zones_raw": zones})


def audit_checks(
    raw: DataFrame, audit: DataFrame, required: DataFrame, dataset: str = TRIPS
) -> list:
    return [
        *column_checks({"ingestion_audit": audit}),
        ck.NoRows(REQUIRED_PERIODS_CHECK, required_periods_loaded(audit, required, dataset)),
        ck.NoRows("audit_matches_raw", audit_matches_raw(raw, audit, dataset)),
    ]


def staged_checks(staged: DataFrame) -> list:
    return column_checks({"trips_staged": staged})


def clean_checks(clean: DataFrame, zones: DataFrame, max_minutes: int = 1440) -> list:
    return [
        *column_checks({"trips_clean": clean, "zones_clean": zones}),
        ck.RowChecks(clean, {"clean_trip_chronology": chronology_condition(max_minutes)}),
        ck.NoRows("no_clean_record_duplicates", ck.rare_duplicates(clean, ["record_hash"])),
    ]


def summary_checks(summary: DataFrame) -> list:
    return column_checks({"dq_summary": summary})


def gold_checks(facts: DataFrame, dimensions: dict[str, DataFrame], kpis: DataFrame) -> list:
    return [
        *column_checks({**dimensions, "fct_trips": facts, "agg_monthly_kpis": kpis}),
        ck.References(facts, references(dimensions)),
    ]
