"""Acceptance reports over the built layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.checks import duplicates
from tripmart.operators.lookup import orphan_counts
from tripmart.plans.trip_checks import references
from tripmart.sources.lake import SUCCESS

# The relationships of the integrity report.
REPORTED = ["pickup_date", "dropoff_date", "pickup_location", "dropoff_location"]


def loads_per_dataset(audit: DataFrame) -> DataFrame:
    return (
        audit.filter(F.col("status") == SUCCESS)
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("successful_loads"),
            F.sum("row_count").alias("rows_loaded"),
        )
        .orderBy("dataset")
    )


def audit_listing(audit: DataFrame) -> DataFrame:
    return audit.orderBy("dataset", "source_period")


def layer_volumes(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows of each named table."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("object_name"), "row_count"
            )
            for name, df in layers.items()
        ),
    )


def quality_by_period(summary: DataFrame) -> DataFrame:
    return summary.orderBy("source_period")


def repeated_trip_keys(facts: DataFrame) -> DataFrame:
    """Keys that break the grain of the fact."""
    return duplicates(facts, ["trip_sk"])


def orphans(facts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Facts without a calendar day or a location, per relationship."""
    return orphan_counts(facts, references(dimensions, REPORTED), count_null=True)


def kpi_listing(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy("source_period")
