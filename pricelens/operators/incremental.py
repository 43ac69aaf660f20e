"""Which products are new, and whether a full run is due."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
FULL_RUN_EVERY_MONTHS = 1


def new_products(catalog: DataFrame, last_full_run: dt.datetime) -> DataFrame:
    """Products created strictly after the last full run (both UTC without zone)."""
    return catalog.filter(F.col("create_date") > F.lit(last_full_run).cast("timestamp_ntz"))


def months_before(moment: dt.datetime, months: int = FULL_RUN_EVERY_MONTHS) -> dt.datetime:
    """Same day and time some months earlier; a day the month lacks runs into the next."""
    index = moment.year * 12 + moment.month - 1 - months
    first = moment.replace(year=index // 12, month=index % 12 + 1, day=1)
    return first + dt.timedelta(days=moment.day - 1)


def run_mode(last_full_run: dt.datetime | None, now: dt.datetime) -> str:
    """'full' without a known last full run or when it is over a month old."""
    if last_full_run is None or last_full_run < months_before(now):
        return "full"
    return "partial"
