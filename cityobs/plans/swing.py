"""Cities with the widest gap between two seasons, and their place in another year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityobs.functions.localtime import in_local_years
from cityobs.operators.dimension import CityDimension, city_dimension, localize
from cityobs.operators.ranking import rank_of_picks, rank_within, top_within
from cityobs.scratch import materialise
from cityobs.sources.tables import YEAR_COLUMN

# The two seasons, first and last month, and the local hours looked at.
SLOTS = {"jan-apr": (1, 4), "jun-sep": (6, 9)}
HOURS = (12, 15)


def month_slot(month: Column, slots: Mapping[str, tuple[int, int]]) -> Column:
    """Label of the season a month belongs to, null outside all of them."""
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, (first, last) in slots.items():
        label = label.when(month.between(first, last), F.lit(name))
    return label


def near_years(obs: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """Observations that can lie in one of the local ``years``.

    The bounds on the stored time reach the scan; on a table partitioned by year, the other years
    are not even listed.
    """
    near = F.lit(False)
    for year in sorted(set(years)):
        near = near | in_local_years(F.col("ts"), year, year)
    if YEAR_COLUMN in obs.columns:
        neighbours = sorted({y + d for y in years for d in (-1, 0, 1)})
        obs = obs.where(F.col(YEAR_COLUMN).isin(neighbours))
    return obs.where(near)


def season_readings(
    obs: DataFrame,
    dim: DataFrame | CityDimension,
    years: tuple[int, ...],
    measure: str = "temperature",
    hours: tuple[int, int] = HOURS,
    slots: Mapping[str, tuple[int, int]] = SLOTS,
) -> DataFrame:
    """Readings of ``years`` at the wanted local hours, labelled with their season."""
    near = near_years(obs, years)
    readings = near.select("ts", "City", F.col(measure).cast("double").alias("value"))
    return (
        localize(readings, dim)
        .where(F.col("Country").isNotNull() & F.col("local_hour").between(*hours))
        .withColumn("year", F.year("local_date"))
        .where(F.col("year").isin(*years))
        .withColumn("slot", month_slot(F.month("local_date"), slots))
        .where(F.col("slot").isNotNull())
        .select("Country", "City", "year", "slot", "value")
    )


def yearly_swing(readings: DataFrame, slots: Mapping[str, tuple[int, int]] = SLOTS) -> DataFrame:
    """``Country, City, year, difference``; a city that lacks a season in a year has no row."""
    one, other = slots
    means = readings.groupBy("Country", "City", "year").agg(
        F.avg(F.when(F.col("slot") == one, F.col("value"))).alias("one"),
        F.avg(F.when(F.col("slot") == other, F.col("value"))).alias("other"),
    )
    return means.select(
        "Country", "City", "year", F.abs(F.col("one") - F.col("other")).alias("difference")
    ).where(F.col("difference").isNotNull())


def _by_city(readings: DataFrame, slots: Mapping[str, tuple[int, int]], years: dict) -> DataFrame:
    """One row per city with the difference of every year, in one aggregation."""
    one, other = slots

    def mean(year: int, slot: str) -> Column:
        return F.avg(F.when((F.col("year") == year) & (F.col("slot") == slot), F.col("value")))

    gaps = [
        F.abs(mean(year, one) - mean(year, other)).alias(name) for name, year in years.items()
    ]
    return readings.groupBy("Country", "City").agg(*gaps)


def seasonal_swing(
    obs: DataFrame,
    dim: DataFrame | CityDimension,
    year: int = 2017,
    base_year: int = 2016,
    measure: str = "temperature",
    hours: tuple[int, int] = HOURS,
    slots: Mapping[str, tuple[int, int]] = SLOTS,
    k: int = 3,
    rerank_after_join: bool = False,
    method: str = "direct",
) -> DataFrame:
    """Per country, the ``k`` cities with the widest swing in ``year`` and their place in
    ``base_year``: ``Country, City, difference, rank_base, rank_year``.

    Cities without a swing in the base year drop out; the others keep their place of ``year``,
    or are numbered again with ``rerank_after_join``. Equal swings are ordered by city.

    Every method makes one pass and one aggregation for both years. ``direct`` then sorts the cities
    of a country, if the dimension is small enough for that; ``counting``, and ``direct`` with a
    larger dimension, takes the top cities in each task first and counts who comes before them.
    """
    dim = city_dimension(dim)
    if len(slots) != 2:
        raise ValueError("a swing needs two seasons")
    if method not in ("direct", "counting"):
        raise ValueError(f"method is 'direct' or 'counting', not {method!r}")
    readings = season_readings(obs, dim, (year, base_year), measure, hours, slots)
    cities = _by_city(readings, slots, {"difference": year, "base": base_year})
    picked = _pick_small(cities, k) if dim.fits and method == "direct" else _pick_large(cities, k)
    if rerank_after_join:
        order = Window.partitionBy("Country").orderBy(F.desc("difference"), "City")
        picked = picked.withColumn("rank_year", F.row_number().over(order))
    return picked.select("Country", "City", "difference", "rank_base", "rank_year").orderBy(
        F.desc("Country"), F.desc("difference"), "City"
    )


def _pick_small(cities: DataFrame, k: int) -> DataFrame:
    """Both places from one shuffle. The rows are cities, whose number has been checked."""
    ranked = rank_within(cities, ["Country"], "base", "rank_base")
    ranked = rank_within(ranked, ["Country"], "difference", "rank_year")
    return ranked.where((F.col("rank_year") <= k) & F.col("rank_base").isNotNull())


def _pick_large(cities: DataFrame, k: int) -> DataFrame:
    """No group is sorted: top-k before the shuffle, then places by counting."""
    cities = materialise(cities, "swing")
    top = top_within(cities, ["Country"], "difference", k, "rank_year")
    return rank_of_picks(cities, top, ["Country"], "base", "rank_base")
