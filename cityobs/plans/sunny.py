"""Cities with enough clear days in each of some months of a year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityobs.functions.localtime import near_local_months
from cityobs.operators.dimension import CityDimension, localize

# The text that counts as clear sky, the months asked about, the hours that a sunny day
# exceeds, and the days that a sunny month needs.
CLEAR = "sky is clear"
MONTHS = (3, 4, 5)
MIN_HOURS = 16
MIN_DAYS = 15


def clear_days(
    obs: DataFrame,
    dim: DataFrame | CityDimension,
    months: Sequence[int],
    min_hours: int,
    condition: str = "description",
    clear: str = CLEAR,
) -> DataFrame:
    """Local days with strictly more than ``min_hours`` clear readings: ``City, local_date, n``."""
    readings = (
        obs.where(F.col(condition) == clear)
        .where(near_local_months(F.col("ts"), months))
        .select("ts", "City")
    )
    return (
        localize(readings, dim, country=False)
        .where(F.month("local_date").isin(*months))
        .groupBy("City", "local_date")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > min_hours)
    )


def sunny_periods(
    obs: DataFrame,
    dim: DataFrame | CityDimension,
    months: Sequence[int] = MONTHS,
    min_hours: int = MIN_HOURS,
    min_days: int = MIN_DAYS,
    how: str = "direct",
    condition: str = "description",
    clear: str = CLEAR,
) -> DataFrame:
    """``Year, City`` with at least ``min_days`` clear days in each of ``months``, by year.

    ``direct`` counts the days of all months of a city's year in one aggregation. ``cascade``
    counts days per month, then months per year; it gives the same rows with one shuffle more.
    """
    months = sorted(set(months))
    days = clear_days(obs, dim, months, min_hours, condition, clear)
    year = F.year("local_date").alias("Year")
    month = F.month("local_date").alias("Month")
    if how == "direct":
        counts = days.groupBy(year, "City").agg(
            *[F.count_if(F.month("local_date") == m).alias(f"days_{m}") for m in months]
        )
        enough = F.lit(True)
        for m in months:
            enough = enough & (F.col(f"days_{m}") >= min_days)
    elif how == "cascade":
        sunny_months = days.groupBy(year, month, "City").count().where(F.col("count") >= min_days)
        counts = sunny_months.groupBy("Year", "City").count()
        enough = F.col("count") == len(months)
    else:
        raise ValueError(f"how is 'direct' or 'cascade', not {how!r}")
    return counts.where(enough).select("Year", "City").orderBy("Year", "City")
