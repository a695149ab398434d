"""The city dimension: one row per city with its country and time zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityobs.functions.localtime import (
    MAX_INLINE_ZONES,
    as_time,
    epoch_seconds,
    local_seconds,
    seconds_to_date,
    seconds_to_hour,
)
from cityobs.functions.names import quoted
from cityobs.operators.joins import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    broadcast_join,
    salted_join,
)
from cityobs.operators.zones import MAX_ZONES, ZoneTable, with_offset, zone_table


#: A dimension of at most this many rows is checked on the driver, in one short job.
DRIVER_ROWS = 2000


@dataclass(frozen=True)
class CityDimension:
    """A dimension whose key has been checked and whose size has been counted.

    ``zones`` lists the distinct zones when there are few enough to be written into the plan.
    Beyond, ``table`` has the changes of their clocks.
    """

    df: DataFrame
    fits: bool
    zones: tuple[str, ...] | None
    table: ZoneTable | None = None


class DuplicateCity(ValueError):
    """A city occurs twice, which would count its observations twice."""


def city_dimension(
    df: DataFrame | CityDimension,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> CityDimension:
    """Check and count a dimension with columns ``City, Country, TimeUTC``.

    At most ``max_rows + 1`` rows are looked at to decide whether it fits a broadcast; beyond
    that, the check for duplicates and the list of zones are distributed jobs. Pass the result to
    several queries to check once.
    """
    if isinstance(df, CityDimension):
        return df
    dim = df.select("City", "Country", "TimeUTC").where(F.col("City").isNotNull())
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) + 16 for c in dim.columns), F.lit(0))
    sized = dim.select("City", "TimeUTC", width.cast("long").alias("bytes"))

    few = sized.limit(min(max_rows, DRIVER_ROWS) + 1).collect()
    if len(few) <= min(max_rows, DRIVER_ROWS):
        twice = len({r["City"] for r in few}) < len(few)
        names = {r["TimeUTC"] for r in few} - {None}
        rows, size = len(few), sum(r["bytes"] for r in few)
    else:
        seen = sized.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
        rows, size = seen.first()
        twice = sized.groupBy("City").count().where("count > 1").limit(1).collect()
        zones = sized.select("TimeUTC").where("TimeUTC is not null").distinct()
        names = {r[0] for r in zones.limit(MAX_ZONES + 1).collect()}
    if twice:
        raise DuplicateCity("the city dimension holds a city more than once")
    few_zones = len(names) <= MAX_INLINE_ZONES
    return CityDimension(
        dim,
        fits=rows <= max_rows and size <= max_bytes,
        zones=tuple(sorted(names)) if few_zones else None,
        table=zone_table(dim.sparkSession, sorted(names)) if not few_zones and len(names) <= MAX_ZONES else None,
    )


def attach_city(
    obs: DataFrame, dim: DataFrame | CityDimension, columns: tuple[str, ...] = ("Country", "TimeUTC")
) -> DataFrame:
    """Add dimension columns to observations; cities that the dimension lacks drop out.

    ``zone_number`` may be asked for if the dimension has a table of its zones.
    """
    dim = city_dimension(dim)
    df = dim.df.join(F.broadcast(dim.table.numbers), "TimeUTC", "left") if "zone_number" in columns else dim.df
    few = df.select("City", *columns)
    return broadcast_join(obs, few, ["City"]) if dim.fits else salted_join(obs, few, ["City"])


def localize(
    obs: DataFrame, dim: DataFrame | CityDimension, time_col: str = "ts", country: bool = True
) -> DataFrame:
    """Observations with their city's wall clock: ``local_ts``, ``local_date``, ``local_hour``.

    The three are null where the zone is null. A query that uses only the date or the hour never
    computes ``local_ts``.
    """
    dim = city_dimension(dim)
    columns = ("Country", "TimeUTC") if country else ("TimeUTC",)
    ts = as_time(quoted(time_col), obs.schema[time_col].dataType)
    seconds = epoch_seconds(ts)
    if dim.table is None:
        joined = attach_city(obs, dim, columns)
        local = local_seconds(seconds, F.col("TimeUTC"), dim.zones)
    else:
        met = attach_city(obs, dim, (*columns, "zone_number"))
        joined = with_offset(met, dim.table, seconds, "__offset")
        local = F.coalesce(seconds + F.col("__offset"), local_seconds(seconds, F.col("TimeUTC"), None))
    # The optimizer copies a projected expression into every filter and condition above it, and
    # the zone shift is the one expensive expression here. It does not do so with the output of
    # a generator, so the shift passes through one and is computed once per row.
    once = joined.select("*", F.explode(F.array(local)).alias("__local"))
    return once.withColumns(
        {
            "local_ts": F.timestamp_add("SECOND", F.col("__local") - epoch_seconds(ts), ts),
            "local_date": seconds_to_date(F.col("__local")),
            "local_hour": seconds_to_hour(F.col("__local")),
        }
    ).drop("__local", "__offset")
