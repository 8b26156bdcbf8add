"""Ordered rules that give every row exactly one status."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Rows for which ``when`` is true get ``status``.

    ``reads_source`` tells that the condition also reads where the row came
    from. Rows with equal attributes can then still differ in this status.
    """

    status: str
    when: Column
    reads_source: bool = False


def status_of(rules: Sequence[Rule], default: str) -> Column:
    """Status of the first rule that is true; NULL is not true."""
    chain = F.when(rules[0].when, F.lit(rules[0].status))
    for rule in rules[1:]:
        chain = chain.when(rule.when, F.lit(rule.status))
    return chain.otherwise(F.lit(default))


def classify(df: DataFrame, rules: Sequence[Rule], default: str, into: str) -> DataFrame:
    return df.withColumn(into, status_of(rules, default))


def twin_statuses(rules: Sequence[Rule], default: str) -> list[str]:
    """Statuses that a copy of a row with status ``default`` can have.

    Copies share all attributes, so every attribute-only rule is false for all
    of them. Only the rules that read the source can tell them apart.
    """
    return [default, *(rule.status for rule in rules if rule.reads_source)]
