"""Country and time zone of a city from the nearest known place.

Points are taken as unit vectors, so that neither the poles nor the 180th meridian are special,
and space is cut into cubes that halve their side at each level. A search goes down the levels:
each target keeps the cubes that can still hold its nearest place and drops those farther away
than a place already seen. Every occupied cube carries one of its places, so the bound is tight
and a target keeps a handful of cubes however crowded they are. At the last level no cube holds
more than a few places, and only those are measured. The answer is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityobs.functions.cells import LATITUDE_RANGE, LONGITUDE_RANGE
from cityobs.functions.names import quoted
from cityobs.operators.joins import checked_join
from cityobs.scratch import materialise

EARTH_RADIUS_KM = 6371.0

#: Levels of one step down, and the deepest level (a cube side of about 6 m on the ground).
STEP = 3
DEEPEST = 21

#: Places per cube at which the search stops going down.
LEAF_PLACES = 32

_AXES = ("x", "y", "z")


def _vector(lat: Column, lon: Column) -> dict[str, Column]:
    phi, lam = F.radians(lat), F.radians(lon)
    return {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}


def _axis_index(v: Column, level: int) -> Column:
    cells = 1 << level
    return F.least(F.floor((v + 1) * (cells / 2)), F.lit(cells - 1)).cast("long")


def _cube(level: int) -> Column:
    """Number of the cube a vector lies in, three axis indices packed into one long."""
    packed = F.lit(0).cast("long")
    for axis in _AXES:
        packed = packed * (1 << level) + _axis_index(F.col(axis), level)
    return packed


def _square(a: str, b: str) -> Column:
    """Squared straight-line distance of two vectors."""
    return sum(((F.col(f"{a}{i}") - F.col(f"{b}{i}")) ** 2 for i in _AXES), F.lit(0.0))


def _gap(level: int) -> Column:
    """Squared distance from a target to the cube whose low corner is given, never too large."""
    side = 2.0 / (1 << level)
    total = F.lit(0.0)
    for axis in _AXES:
        low, v = F.col(f"low_{axis}"), F.col(axis)
        outside = F.greatest(low - v, v - (low + side)) - 1e-15
        total = total + F.greatest(outside, F.lit(0.0)) ** 2
    return total


def _valid(lat: Column, lon: Column) -> Column:
    return lat.between(*LATITUDE_RANGE) & lon.between(*LONGITUDE_RANGE)


def _cube_counts(points: DataFrame, leaf: int) -> tuple[int, dict[int, int], int]:
    """The first level whose cubes hold at most ``leaf`` places, the number of cubes of each
    level, and the number of places."""
    levels = range(0, DEEPEST + 1, STEP)
    cubes = F.explode(
        F.array(*[F.struct(F.lit(n).alias("level"), _cube(n).alias("cube")) for n in levels])
    )
    counted = (
        points.select(cubes.alias("c"))
        .groupBy("c.level", "c.cube")
        .count()
        .groupBy("level")
        .agg(F.max("count").alias("most"), F.count("*").alias("cubes"))
        .collect()
    )
    most = {r["level"]: r["most"] for r in counted}
    number = {r["level"]: r["cubes"] for r in counted}
    depth = next((n for n in levels if most.get(n, 0) <= leaf), DEEPEST)
    return depth, number, most.get(0, 0)


def nearest_place(
    cities: DataFrame,
    places: DataFrame,
    *,
    lat_col: str = "Latitude",
    lon_col: str = "Longitude",
    max_km: float | None = None,
    leaf_places: int = LEAF_PLACES,
) -> DataFrame:
    """Add ``Country, TimeUTC, distance_km`` of the nearest place to every city.

    ``places`` has columns ``Latitude, Longitude, Country, TimeUTC``. Cities without valid
    coordinates, or with no place within ``max_km``, get nulls. Of places equally near, the
    first by country and zone counts.
    """
    lat, lon = quoted(lat_col), quoted(lon_col)
    targets = (
        cities.where(_valid(lat, lon))
        .select(lat.cast("double").alias("__lat"), lon.cast("double").alias("__lon"))
        .distinct()
        .withColumns(_vector(F.col("__lat"), F.col("__lon")))
    )
    here = F.col("Latitude"), F.col("Longitude")
    points = (
        places.where(_valid(*here))
        .groupBy(*[c.cast("double").alias(n) for c, n in zip(here, ("lat", "lon"), strict=True)])
        .agg(F.min(F.struct("Country", "TimeUTC")).alias("answer"))
        .withColumns(_vector(F.col("lat"), F.col("lon")))
    )
    depth, cubes, total = _cube_counts(points, leaf_places)
    if depth > 0:
        points = materialise(points, "places")

    # The targets are already distributed by their coordinates, so no round shuffles them while the
    # cubes of its level fit a broadcast.
    frontier = targets.withColumns({"cube": _cube(0), "bound": F.lit(4.0)})
    if depth > 0:
        frontier = _first_step(targets, points, cubes.get(STEP, 0))
    for level in range(2 * STEP, depth + 1, STEP):
        frontier = _descend(frontier, points, level, cubes.get(level, 0))

    candidates = points.select(
        _cube(depth).alias("cube"), "answer", *[F.col(a).alias(f"p_{a}") for a in _AXES]
    )
    square = _square("", "p_")
    nearest = (
        checked_join(frontier, candidates, ["cube"], total)
        .groupBy("__lat", "__lon")
        .agg(F.min(F.struct(square.alias("square"), F.col("answer"))).alias("best"))
    )
    chord = F.least(F.sqrt("best.square") / 2, F.lit(1.0))
    found = nearest.select(
        "__lat",
        "__lon",
        F.col("best.answer.Country").alias("Country"),
        F.col("best.answer.TimeUTC").alias("TimeUTC"),
        (F.asin(chord) * (2 * EARTH_RADIUS_KM)).alias("distance_km"),
    )
    if max_km is not None:
        found = found.where(F.col("distance_km") <= max_km)
    keyed = cities.withColumns({"__lat": lat.cast("double"), "__lon": lon.cast("double")})
    return checked_join(
        keyed, found, ["__lat", "__lon"], targets.count(), how="left"
    ).drop("__lat", "__lon")


def _parts(points: DataFrame, level: int) -> DataFrame:
    """The occupied parts of every cube of the level above, with a place and the low corner of each."""
    side = 2.0 / (1 << level)
    parts = points.groupBy(_cube(level - STEP).alias("cube"), _cube(level).alias("part")).agg(
        F.min(F.struct(*_AXES)).alias("seen")
    )
    parts = parts.select("cube", "part", "seen.*")
    return parts.select(
        "cube",
        "part",
        *[F.col(a).alias(f"s_{a}") for a in _AXES],
        *[(_axis_index(F.col(a), level) * side - 1).alias(f"low_{a}") for a in _AXES],
    )


def _first_step(targets: DataFrame, points: DataFrame, cubes: int) -> DataFrame:
    """The parts of the whole that targets go on with, chosen for cubes of targets first.

    There are at most 8 ** STEP cubes of either kind. A cube of targets keeps the parts that are no
    farther from it than the place of some part is from its farthest corner; its targets meet only
    those.
    """
    side = 2.0 / (1 << STEP)
    home = [_axis_index(F.col(a), STEP).alias(f"h_{a}") for a in _AXES]
    homes = targets.select(_cube(STEP).alias("home"), *home).distinct()
    near = F.lit(0.0)
    far = F.lit(0.0)
    for a in _AXES:
        low = F.col(f"h_{a}") * side - 1
        apart = F.greatest(F.abs(low - F.col(f"low_{a}")) - side - 1e-12, F.lit(0.0))
        near = near + apart**2
        far = far + F.greatest(F.abs(F.col(f"s_{a}") - low), F.abs(F.col(f"s_{a}") - low - side)) ** 2
    # The one cube of the whole, which the optimizer must not fold: a constant key leaves no key.
    whole = F.least(F.col(f"h_{_AXES[0]}"), F.lit(0)).cast("long")
    kept = (
        homes.withColumn("cube", whole)
        .join(_parts(points, STEP), "cube")
        .withColumns({"near": near, "far": F.min(far).over(Window.partitionBy("home"))})
        .where(F.col("near") <= F.col("far"))
        .drop("cube", "near", "far", *[f"h_{a}" for a in _AXES])
    )
    at_home = targets.withColumns({"home": _cube(STEP), "bound": F.lit(4.0)})
    return _closer(checked_join(at_home, kept, ["home"], cubes << 3 * STEP, row_bytes=96), STEP)


def _descend(frontier: DataFrame, points: DataFrame, level: int, cubes: int) -> DataFrame:
    """Replace each kept cube by its occupied parts, and drop the parts that are too far."""
    return _closer(checked_join(frontier, _parts(points, level), ["cube"], cubes), level)


def _closer(met: DataFrame, level: int) -> DataFrame:
    """The parts that can still hold a target's nearest place."""
    per_target = Window.partitionBy("__lat", "__lon")
    return (
        met.withColumns({"gap": _gap(level), "square": _square("", "s_")})
        .where(F.col("gap") <= F.col("bound"))
        .withColumn("bound", F.least("bound", F.min("square").over(per_target)))
        .where(F.col("gap") <= F.col("bound"))
        .select("__lat", "__lon", *_AXES, F.col("part").alias("cube"), "bound")
    )
