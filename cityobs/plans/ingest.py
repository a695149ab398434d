"""From raw text tables to published ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from cityobs.functions.cells import RULES
from cityobs.operators.clean import clean_city, clean_description, clean_measure
from cityobs.operators.geo import nearest_place
from cityobs.sources.layout import Layout
from cityobs.sources.tables import publish, read_table

DESCRIPTION = "weather_description"
CITIES = "city_attributes"


def clean_table(raw: DataFrame, name: str, on_bad_cell: str = "drop_row") -> DataFrame:
    """Clean one wide table by the rule that goes with its name."""
    if name in RULES:
        return clean_measure(raw, name, on_bad_cell=on_bad_cell)
    if name == DESCRIPTION:
        return clean_description(raw)
    raise ValueError(f"no cleaning rule for a table named {name!r}")


def clean_cities(raw: DataFrame, places: DataFrame, max_km: float | None = None) -> DataFrame:
    """Valid cities with the country and zone of the nearest place."""
    lat_col, lon_col = raw.columns[1], raw.columns[2]
    valid = clean_city(raw, lat_col=lat_col, lon_col=lon_col)
    found = nearest_place(valid, places, lat_col=lat_col, lon_col=lon_col, max_km=max_km)
    return found.select(*raw.columns, "Country", "TimeUTC")


def ingest(
    spark: SparkSession,
    raw_dir: str,
    layout: Layout,
    formats: Iterable[str] = ("csv", "parquet"),
    names: Iterable[str] = (*RULES, DESCRIPTION),
    places: DataFrame | None = None,
    by_year: bool = False,
    files_per_year: int | None = None,
) -> dict[str, dict[str, str]]:
    """Clean ``<raw_dir>/<name>.csv`` for every name, and the cities when ``places`` are given,
    and publish them below ``layout``. Returns the path of each table and format.

    ``by_year`` partitions the Parquet tree of each measure, so that questions about some years read
    only those; ``files_per_year`` spreads a year over that many tasks.
    """
    formats = list(formats)
    raw_dir = raw_dir.rstrip("/")
    published = {}
    for name in names:
        raw = read_table(spark, f"{raw_dir}/{name}.csv", "csv")
        cleaned = clean_table(raw, name)
        published[name] = publish(
            cleaned, layout, name, formats, by_year=by_year, files_per_year=files_per_year
        )
    if places is not None:
        raw = read_table(spark, f"{raw_dir}/{CITIES}.csv", "csv")
        published[CITIES] = publish(clean_cities(raw, places), layout, CITIES, formats)
    return published
