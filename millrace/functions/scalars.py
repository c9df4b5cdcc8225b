"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def single_row(stats: DataFrame) -> Column:
    """A one-row table as a struct-valued scalar subquery: read the fields by name.
    No join is planned; Spark evaluates the subquery once and reuses it."""
    return stats.select(F.struct("*")).scalar()


def literal_map(values: Mapping) -> Column:
    """Fixed mapping as a map literal, for short parameter tables."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def lookup(values: Mapping, key: Column) -> Column:
    """Value for `key`, null when it is not mapped."""
    return F.try_element_at(literal_map(values), key)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, read in UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def any_of(text: Column, needles: Iterable[str]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle)
    return found


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))
