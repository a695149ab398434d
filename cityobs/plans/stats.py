"""Monthly statistics of measures for each country."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityobs.functions.names import quoted
from cityobs.operators.dimension import CityDimension, city_dimension, localize

KEYS = ["Year", "Month", "Country"]
STATISTICS = ("max", "min", "avg", "std_samp", "std_pop")


def month_rows(obs: DataFrame, dim: CityDimension, measures: Sequence[str]) -> DataFrame:
    values = [F.col(m).cast("double").alias(f"value_{i}") for i, m in enumerate(measures)]
    return (
        localize(obs.select("ts", "City", *values), dim)
        .where(F.col("local_date").isNotNull())
        .select(
            F.year("local_date").alias("Year"),
            F.month("local_date").alias("Month"),
            "Country",
            *[f"value_{i}" for i in range(len(measures))],
        )
    )


def _moments(value: str, measure: str) -> list[Column]:
    """What one pass must carry; the sample deviation follows from the others."""
    return [
        F.max(value).alias(f"max_{measure}"),
        F.min(value).alias(f"min_{measure}"),
        F.avg(value).alias(f"avg_{measure}"),
        F.stddev_pop(value).alias(f"std_pop_{measure}"),
        F.count(value).alias(f"__n_{measure}"),
    ]


def _table_stats(obs: DataFrame, dim: CityDimension, measures: Sequence[str]) -> DataFrame:
    """Statistics of several measures of one table: one scan, one zone shift, one aggregation."""
    rows = month_rows(obs, dim, measures)
    moments = [c for i, m in enumerate(measures) for c in _moments(f"value_{i}", m)]
    seen = sum((quoted(f"__n_{m}") for m in measures), F.lit(0))
    stats = rows.groupBy(*KEYS).agg(*moments).where(seen > 0)
    samples = {}
    for m in measures:
        n = quoted(f"__n_{m}")
        samples[f"std_samp_{m}"] = F.when(n > 1, quoted(f"std_pop_{m}") * F.sqrt(n / (n - 1)))
    return stats.withColumns(samples)


def measure_stats(obs: DataFrame, dim: DataFrame | CityDimension, measure: str) -> DataFrame:
    """``Year, Month, Country`` and ``<statistic>_<measure>`` for one measure."""
    stats = _table_stats(obs, city_dimension(dim), [measure])
    return stats.select(*KEYS, *[quoted(f"{s}_{measure}") for s in STATISTICS])


def monthly_stats(
    tables: Mapping[str, DataFrame],
    dim: DataFrame | CityDimension,
    how: str = "full_outer",
    method: str = "direct",
) -> DataFrame:
    """Maximum, minimum, mean and both deviations of each measure per country and month.

    ``tables`` maps a measure's name to a long table with columns ``ts, City, <measure>``.
    ``how="full_outer"`` keeps months that some measure lacks, with nulls, and cities without a
    country as a group of their own; ``"inner"`` drops both.

    Measures may share a table: those given with the same ``DataFrame`` are aggregated in one pass
    over it. ``direct`` lays the few result rows of all tables on top of each other and aggregates
    them again. ``joined`` aggregates each measure by itself and joins the results on their keys; it
    gives the same rows with a shuffle for each measure and join.
    """
    if not tables or any(not name for name in tables):
        raise ValueError("every measure needs a name")
    if how not in ("full_outer", "inner"):
        raise ValueError(f"how is 'full_outer' or 'inner', not {how!r}")
    dim = city_dimension(dim)
    if method == "joined":
        wide = _one_by_one(tables, dim, how)
    elif method == "direct":
        wide = _together(tables, dim, how)
    else:
        raise ValueError(f"method is 'direct' or 'joined', not {method!r}")
    columns = [quoted(f"{s}_{name}") for name in tables for s in STATISTICS]
    return wide.select(*KEYS, *columns).orderBy(*KEYS)


def _one_by_one(tables: Mapping[str, DataFrame], dim: CityDimension, how: str) -> DataFrame:
    # The keys are joined as one struct: fields that are null on both sides are then equal,
    # as they are to the aggregation.
    parts = [
        measure_stats(obs, dim, name).withColumn("key", F.struct(*KEYS)).drop(*KEYS)
        for name, obs in tables.items()
    ]
    wide = reduce(lambda a, b: a.join(b, "key", how), parts)
    wide = wide.select("key.*", *[c for c in wide.columns if c != "key"])
    return wide.where(F.col("Country").isNotNull()) if how == "inner" else wide


def _together(tables: Mapping[str, DataFrame], dim: CityDimension, how: str) -> DataFrame:
    shared: dict[int, tuple[DataFrame, list[str]]] = {}
    for name, obs in tables.items():
        shared.setdefault(id(obs), (obs, []))[1].append(name)
    parts = [_table_stats(obs, dim, names) for obs, names in shared.values()]
    wide = parts[0]
    if len(parts) > 1:
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        rest = [c for c in union.columns if c not in KEYS]
        wide = union.groupBy(*KEYS).agg(*[F.max(quoted(c)).alias(c) for c in rest])
    if how == "inner":
        for name in tables:
            wide = wide.where(quoted(f"__n_{name}") > 0)
        wide = wide.where(F.col("Country").isNotNull())
    return wide
