"""Literal rows and generated days as relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows as a local relation, so the planner knows their size."""
    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in fields)
    typed = [F.col(name).cast(kind).alias(name) for name, kind in fields]
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})").select(*typed)


def days(spark: SparkSession, start: str, count: int) -> DataFrame:
    """``count`` consecutive days from ``start``."""
    first = F.lit(start).cast("date")
    return spark.range(count).select(
        F.date_add(first, F.col("id").cast("int")).alias("date_day")
    )
