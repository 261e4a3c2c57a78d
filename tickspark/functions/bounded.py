"""Results that are small by contract."""

from __future__ import annotations

from pyspark.sql import DataFrame


class TooManyRows(ValueError):
    """A result is larger than its caller allows."""


def collect_bounded(df: DataFrame, most: int):
    """The rows as a pandas frame, in one job; never more than ``most`` of them."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise TooManyRows(f"more than {most} rows")
    return rows
