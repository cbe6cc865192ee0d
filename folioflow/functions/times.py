"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(at: dt.datetime) -> Column:
    """Zoneless timestamp literal. A plain literal would be shifted by the session's time zone."""
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def seconds_of(ts: Column) -> Column:
    """Whole seconds since 1970 of a zoneless timestamp."""
    return F.timestamp_diff("SECOND", _epoch(), F.date_trunc("SECOND", ts).cast("timestamp_ntz"))


def at_second(second: Column) -> Column:
    """Zoneless timestamp of whole seconds since 1970."""
    return F.timestamp_add("SECOND", second, _epoch())
