"""Fields of a raw record and their safe typing.

Every cast here turns bad text into NULL, so a malformed value can be counted
by the quality rules and never stops a run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _path(key: str) -> str | None:
    """Variant path of one top-level key, or None if it cannot be written."""
    for quote in ("'", '"'):
        if quote not in key:
            return f"$[{quote}{key}{quote}]"
    return None


def casings(name: str, observed: Iterable[str]) -> list[str]:
    """Keys that mean ``name``: the exact spelling, then the others in order."""
    others = {key for key in observed if key.lower() == name.lower()} - {name}
    return [name, *sorted(others)]


def extract_fields(
    df: DataFrame,
    raw: str,
    fields: Mapping[str, str],
    observed: Iterable[str] | None = None,
) -> DataFrame:
    """Replace the record column ``raw`` by one text column per field.

    ``fields`` maps an output column to a source name. Names match in any
    casing: the exact spelling wins, then the first other spelling with a value.
    An absent field is NULL.

    ``observed`` lists the keys that occur in the records. The lake keeps them
    per load, and with them each field is a plain ``variant_get``: the Parquet
    scan then reads only the shredded chunks of these fields. Without it the
    record becomes a map first, which reads and decodes whole records.
    """
    kept = [F.col(c) for c in df.columns if c != raw]
    if observed is not None:
        spellings = {out: casings(name, observed) for out, name in fields.items()}
        paths = {out: [_path(key) for key in keys] for out, keys in spellings.items()}
        if all(path for keys in paths.values() for path in keys):
            return df.select(
                *kept,
                *(
                    F.coalesce(*(F.try_variant_get(raw, path, "string") for path in keys)).alias(out)
                    for out, keys in paths.items()
                ),
            )
    record = "__record"
    as_map = df.select(*kept, F.col(raw).try_cast("map<string,string>").alias(record))

    def any_casing(name: str) -> Column:
        entries = F.filter(
            F.map_entries(record),
            lambda e: (F.lower(e["key"]) == name.lower()) & e["value"].isNotNull(),
        )
        return F.coalesce(F.col(record)[name], F.get(entries, F.lit(0))["value"])

    return as_map.select(*kept, *(any_casing(name).alias(out) for out, name in fields.items()))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def safe_integer(text: Column, precision: int) -> Column:
    """Whole number of at most ``precision`` digits; halves round away from zero.

    The casts here ignore space around a value and give NULL for a blank, so
    they need no ``blank_to_null`` first.
    """
    return text.try_cast(f"decimal({precision},0)")


def safe_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal rounded to ``scale``; NULL when it does not fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def safe_timestamp(text: Column) -> Column:
    """Zone-less timestamp."""
    return text.try_cast("timestamp_ntz")


def period_start(period: Column) -> Column:
    """First day of a ``YYYY-MM`` period."""
    return F.concat(period, F.lit("-01")).try_cast("date")


def flag(text: Column, allowed: tuple[str, ...] = ("Y", "N")) -> Column:
    """Upper-cased flag, NULL when it is not an allowed one."""
    value = F.upper(F.trim(text))
    return F.when(value.isin(*allowed), value)


def squeeze(text: Column) -> Column:
    """Trimmed text with every run of whitespace made one space."""
    return F.regexp_replace(F.trim(text), r"\s+", " ")
