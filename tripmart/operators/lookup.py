"""Joins to small relations, and rows that have no partner."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

from tripmart.sources.inline import values

UNKNOWN = -1


def known_or_unknown(code: Column, members: Sequence[int]) -> Column:
    """The code itself if it is a listed member, else the unknown member."""
    listed = [m for m in members if m != UNKNOWN]
    return F.when(code.isin(*listed), code).otherwise(F.lit(UNKNOWN))


def resolve_key(
    facts: DataFrame, column: str, members: DataFrame, member_key: str, into: str
) -> DataFrame:
    """Add ``into``: the value of ``column`` if it is a member, else unknown.

    ``members`` must be unique on ``member_key``; facts keep their row count.
    """
    role = f"__{into}"
    known = members.select(F.col(member_key).alias(role))
    return (
        facts.join(known, facts[column] == F.col(role), "left")
        .withColumn(into, F.when(F.col(role).isNull(), F.lit(UNKNOWN)).otherwise(F.col(column)))
        .drop(role)
    )


@dataclass(frozen=True)
class Reference:
    """``column`` of the facts points to ``key`` of ``parent``."""

    name: str
    column: str
    parent: DataFrame
    key: str


def _whole(kind: DataType) -> bool:
    """Does every value of this type fit a long?"""
    if isinstance(kind, DecimalType):
        return kind.scale == 0 and kind.precision <= 18
    return isinstance(kind, IntegralType)


def orphan_counts(
    facts: DataFrame, references: Sequence[Reference], count_null: bool = False
) -> DataFrame:
    """Rows per reference whose key has no partner, one row per reference.

    All references are counted in one scan: each row yields its keys, equal
    keys are counted before the shuffle, and only the distinct keys are joined.
    Whole-number keys stay numbers, which keeps that counting cheap. NULL keys
    are left out unless ``count_null`` is set.
    """
    kinds = [facts.schema[r.column].dataType for r in references]
    kinds += [r.parent.schema[r.key].dataType for r in references]
    common = "long" if all(map(_whole, kinds)) else "string"

    def keyed(position: int, key: str) -> list[Column]:
        return [F.lit(position).alias("reference"), F.col(key).cast(common).alias("value")]

    pairs = F.array(*(F.struct(*keyed(i, r.column)) for i, r in enumerate(references)))
    used = (
        facts.select(F.explode(pairs).alias("pair"))
        .select("pair.reference", "pair.value")
        .groupBy("reference", "value")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    if not count_null:
        used = used.filter(F.col("value").isNotNull())
    members = reduce(
        DataFrame.unionByName, (r.parent.select(*keyed(i, r.key)) for i, r in enumerate(references))
    )
    missing = (
        used.join(members, ["reference", "value"], "left_anti")
        .groupBy("reference")
        .agg(F.sum("uses").alias("missing"))
    )
    listed = values(
        facts.sparkSession,
        [(i, r.name) for i, r in enumerate(references)],
        "reference int, relationship string",
    )
    return listed.join(missing, "reference", "left").select(
        "relationship", F.coalesce("missing", F.lit(0)).cast("long").alias("orphans")
    )
