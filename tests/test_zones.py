import zoneinfo

import pytest
from conftest import plan
from pyspark.sql import functions as F

from cityobs.operators import dimension as dimension_module
from cityobs.operators.dimension import city_dimension, localize
from cityobs.operators.zones import FIRST, LAST, _second, with_offset, zone_changes, zone_table

DIM = "City string, Country string, TimeUTC string"
NAMES = sorted(z for z in zoneinfo.available_timezones() if z.startswith(("A", "E", "Pacific/", "Indian/")))


def test_every_change_of_clocks_equals_the_column_form(spark):
    """One second before, at and after each change of some 400 zones, and at both ends of the table."""
    table = zone_table(spark, NAMES)
    assert len(NAMES) > 400 and table.numbers.count() == len(NAMES)
    numbers = {r["TimeUTC"]: r["zone_number"] for r in table.numbers.collect()}
    rows = []
    for name in NAMES:
        instants = [at for at, _ in zone_changes(spark, name)[1]]
        instants += [_second(FIRST), _second(1970), _second(2024), _second(LAST) - 1]
        rows += [(name, numbers[name], at + d) for at in instants for d in (-1, 0, 1) if _second(FIRST) <= at + d < _second(LAST)]
    given = spark.createDataFrame(rows, "zone string, zone_number long, s long")
    by_column = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds("s"), F.col("zone"))) - F.col("s")
    got = with_offset(given, table, F.col("s")).withColumn("wanted", by_column)
    assert given.count() > 100_000
    assert got.where(~F.col("zone_offset").eqNullSafe(F.col("wanted"))).count() == 0


@pytest.fixture
def no_case(monkeypatch):
    monkeypatch.setattr(dimension_module, "MAX_INLINE_ZONES", 0)


def test_unknown_null_and_far_away(spark, no_case):
    """Instants beyond the table go by the zone's name; a null zone has no local time."""
    dim = city_dimension(spark.createDataFrame([("A", "x", "Europe/Rome"), ("B", "x", None), ("C", "x", "+05:30")], DIM))
    times = ["1750-06-01 00:00:00", "2010-07-01 12:00:00", "2500-07-01 12:00:00"]
    obs = spark.createDataFrame([(c, t) for c in "ABC" for t in times], "City string, t string").selectExpr("City", "cast(t as timestamp_ntz) ts")
    got = {(r["City"], str(r["ts"])): str(r["local_ts"]) for r in localize(obs, dim).collect()}
    assert got["A", times[1]] == "2010-07-01 14:00:00" and got["A", times[2]] == "2500-07-01 14:00:00"
    assert got["A", times[0]].startswith("1750-06-01 00:49")
    assert {got["B", t] for t in times} == {"None"}
    assert got["C", times[1]] == "2010-07-01 17:30:00"


def test_names_that_are_no_zones_are_left_out(spark):
    table = zone_table(spark, ["Europe/Rome", "Nowhere/Town"])
    assert [r["TimeUTC"] for r in table.numbers.collect()] == ["Europe/Rome"]
    assert zone_table(spark, []).changes.count() == 0


def test_the_lookup_is_one_broadcast_join_without_python(spark, no_case):
    dim = city_dimension(spark.createDataFrame([("A", "x", "Europe/Rome"), ("B", "x", "Asia/Tokyo")], DIM))
    obs = spark.range(100).selectExpr("timestampadd(HOUR, id, timestamp_ntz'2010-03-27 00:00:00') ts", "substr('AB', id % 2 + 1, 1) City")
    text = plan(localize(obs, dim).groupBy("local_date").count())
    assert "Python" not in text and "NestedLoop" not in text and "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") == 3  # the city, its zone's number, the changes
