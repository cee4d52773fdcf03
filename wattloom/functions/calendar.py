"""Hours, years and seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUMMER_MONTHS = (5, 6, 7, 8, 9)
WINTER_MONTHS = (11, 12, 1, 2)


def epoch_nanos_to_timestamp(nanos: Column) -> Column:
    """Whole seconds of a bigint count of nanoseconds since 1970."""
    per_second = F.lit(1_000_000_000)
    whole = nanos - F.pmod(nanos, per_second)
    return F.timestamp_seconds((whole / per_second).cast("bigint"))


def wrap_year(ts: Column, spill_year: int = 2019) -> Column:
    """Move stamps that spilled into ``spill_year`` one year back."""
    return F.when(
        F.year(ts) == spill_year, ts - F.expr("INTERVAL '1' YEAR")
    ).otherwise(ts)


def align_hour(ts: Column, spill_year: int | None = 2019) -> Column:
    """Hour-ending stamp of a reading.

    The reading at 07:15 belongs to the hour that ends at 08:00.  The last hour
    of the base year would fall into ``spill_year`` and is wrapped back.
    """
    ending = F.date_trunc("hour", ts) + F.expr("INTERVAL '1' HOUR")
    return ending if spill_year is None else wrap_year(ending, spill_year)


def hour_of_day(ts: Column) -> Column:
    """Hour counted from 1 to 24."""
    return F.hour(ts) + F.lit(1)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(*SUMMER_MONTHS), F.lit("Summer"))
        .when(month.isin(*WINTER_MONTHS), F.lit("Winter"))
        .otherwise(F.lit("Shoulder"))
    )


def restamp_year(ts: Column, year: Column) -> Column:
    """Same month, day and time in another year; NULL if that day does not exist."""
    seconds = F.second(ts) + F.date_format(ts, "SSSSSS").cast("int") / F.lit(1e6)
    return F.try_make_timestamp(
        year, F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), seconds
    )
