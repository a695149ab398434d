"""Wall-clock time of cities, independent of the session time zone.

All times are ``timestamp_ntz``. The instant is read as UTC seconds since 1970, moved by the
zone's offset at that instant, and kept as a long; dates and hours follow by integer arithmetic.

``convert_timezone`` parses both zone ids for every row. With the zone as a literal, the zone is
resolved once for each task, which is several times faster; so a known, short list of zones
becomes one CASE. Longer lists are looked up in a table (``operators.zones``), and what neither
knows uses the zone column itself. All give the same instants.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

DAY_SECONDS = 86400
EPOCH = "1970-01-01 00:00:00"

#: Longest zone list written as a CASE. A longer one makes the generated method too large
#: for the JVM to compile (measured: 64 zones run at full speed, 200 do not).
MAX_INLINE_ZONES = 64

# Fixed value: shape of a time cell, yyyy-MM-dd HH:mm:ss with nothing around it.
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_time(cell: Column) -> Column:
    """Strict reading of a time cell; month 13, hour 25 and trailing text give null."""
    return F.when(cell.rlike(TIME_SHAPE), cell.try_cast("timestamp_ntz"))


def as_time(column: Column, data_type: DataType) -> Column:
    """Time column as ``timestamp_ntz``, decided by its type in the schema."""
    if isinstance(data_type, StringType):
        return parse_time(column)
    if isinstance(data_type, TimestampType):
        # The instant itself: a cast would go through the session zone.
        return F.timestamp_add("MICROSECOND", F.unix_micros(column), F.lit(EPOCH).cast("timestamp_ntz"))
    return column if isinstance(data_type, TimestampNTZType) else column.cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds from 1970-01-01 to ``ts``, both without a zone."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * DAY_SECONDS
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def local_seconds(seconds: Column, zone: Column, zones: Sequence[str] | None) -> Column:
    """Wall-clock seconds in ``zone`` at the instant ``seconds``; null for a null zone.

    A zone that ``zones`` lacks is shifted as well, by the column.
    """
    instant = F.timestamp_seconds(seconds)
    by_column = F.unix_seconds(F.from_utc_timestamp(instant, zone))
    if not zones or len(zones) > MAX_INLINE_ZONES:
        return by_column
    first, *rest = sorted(zones)
    local = F.when(zone == first, F.unix_seconds(F.from_utc_timestamp(instant, first)))
    for name in rest:
        local = local.when(zone == name, F.unix_seconds(F.from_utc_timestamp(instant, name)))
    return local.otherwise(by_column)


def seconds_to_date(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / DAY_SECONDS).cast("int"))


def seconds_to_hour(seconds: Column) -> Column:
    return F.floor(F.pmod(seconds, F.lit(DAY_SECONDS)) / 3600).cast("int")


def in_local_years(ts: Column, first: int, last: int) -> Column:
    """Wider range on the UTC time that holds whenever the local year is in [first, last].

    No zone is a full day away from UTC, so one day on each side is enough. The bound is on the
    stored column and therefore reaches the scan.
    """
    low = F.lit(f"{first - 1}-12-31 00:00:00").cast("timestamp_ntz")
    high = F.lit(f"{last + 1}-01-02 00:00:00").cast("timestamp_ntz")
    return (ts >= low) & (ts < high)


def near_local_months(ts: Column, months: Sequence[int]) -> Column:
    """Wider filter on the UTC time that holds whenever the local month is one of ``months``."""
    day = ts.cast("date")
    return F.month(F.date_sub(day, 1)).isin(*months) | F.month(F.date_add(day, 1)).isin(*months)
