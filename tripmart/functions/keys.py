"""Hash keys and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "<NULL>"


def surrogate_key(file: Column, row: Column) -> Column:
    """md5 of ``file|row``: the identity of one landed row."""
    return F.md5(F.concat(file, F.lit("|"), row.cast("string")))


def surrogate_key_sql(file: str, row: str) -> str:
    """The same as SQL over two column names, for a column that is not stored."""
    return f"md5(concat({file}, '|', cast({row} as string)))"


def record_hash(*attributes: Column) -> Column:
    """md5 over the text of typed attributes; NULL counts as a value."""
    return F.md5(
        F.concat_ws("|", *(F.coalesce(a.cast("string"), F.lit(ABSENT)) for a in attributes))
    )


def record_hash_sql(*attributes: str) -> str:
    """The same as SQL over column names."""
    return f"md5(concat_ws('|', {', '.join(f"coalesce(cast({a} as string), '{ABSENT}')" for a in attributes)}))"


def date_key(moment: Column) -> Column:
    """``YYYYMMDD`` as an integer.

    Built from calendar parts of the date: formatting a zone-less timestamp
    would shift it through the session zone.
    """
    day = F.to_date(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
