import math
import random

import pytest

from cityobs.operators.geo import nearest_place

CITY = "City string, Latitude double, Longitude double"
PLACE = "Latitude double, Longitude double, Country string, TimeUTC string"


def vector(lat, lon):
    a, b = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)


def brute(cities, places):
    answer = {}
    for name, lat, lon in cities:
        v = vector(lat, lon)
        answer[name] = min(
            (sum((p - q) ** 2 for p, q in zip(v, vector(a, b))), country, tz) for a, b, country, tz in places
        )[1]
    return answer


@pytest.mark.parametrize("leaf_places", [1, 4, 10_000])
def test_equals_brute_force_with_crowds_poles_and_wrap(spark, leaf_places):
    rng = random.Random(7)
    places = [
        (math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180), f"p{i}", "UTC") for i in range(150)
    ]
    # A third of the places in one spot, some on the same point.
    places += [(45 + rng.gauss(0, 0.01), 9 + rng.gauss(0, 0.01), f"q{i:02d}", "UTC") for i in range(70)]
    places += [(45.0, 9.0, "same b", "UTC"), (45.0, 9.0, "same a", "UTC")]
    cities = [
        ("north", 90.0, 0.0), ("south", -90.0, 120.0), ("east", 10.0, 180.0), ("west", 10.0, -180.0),
        ("centre", 45.0, 9.0), ("near", 45.02, 9.01), ("origin", 0.0, 0.0),
    ]
    cities += [
        (f"c{i}", math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(60)
    ]
    found = nearest_place(
        spark.createDataFrame(cities, CITY), spark.createDataFrame(places, PLACE), leaf_places=leaf_places
    )
    got = {r["City"]: r["Country"] for r in found.collect()}
    assert got == brute(cities, places)
    assert got["centre"] == "same a"


def test_distance_limit_and_missing_coordinates(spark):
    cities = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 5.0), ("c", None, 0.0), ("d", 95.0, 0.0)], CITY)
    places = spark.createDataFrame([(0.0, 1.0, "x", "UTC")], PLACE)
    got = {r["City"]: (r["Country"], r["distance_km"]) for r in nearest_place(cities, places, max_km=200).collect()}
    assert got["a"][0] == "x" and got["a"][1] == pytest.approx(6371 * math.radians(1))
    assert got["b"] == got["c"] == got["d"] == (None, None)


def test_no_places(spark):
    cities = spark.createDataFrame([("a", 0.0, 0.0)], CITY)
    assert nearest_place(cities, spark.createDataFrame([], PLACE)).first()["Country"] is None
