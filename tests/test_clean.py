import math

import pytest
from conftest import rows

from cityobs.functions.localtime import parse_time
from cityobs.functions.names import to_underscores
from cityobs.operators.clean import clean_city, clean_description, clean_measure
from cityobs.operators.reshape import to_long
from pyspark.sql import functions as F

NOON = "2016-05-01 12:00:00"


def cells(spark, values):
    schema = "datetime string, A string, B string"
    return spark.createDataFrame([(NOON, v, "250") for v in values], schema)


@pytest.mark.parametrize(
    "rule, given, kept",
    [
        (
            "temperature",
            ["289.5", "289500", "100000", "100000.5", "184", "343", "183.99", "343.01", "", None],
            [289.5, 289.5, None, None, 184.0, 343.0, None, None, None, None],
        ),
        ("humidity", ["0", "100", "-0.1", "100.1", "NaN"], [0.0, 100.0, None, None, None]),
        ("pressure", ["870", "1085.6", "869.9", "1085.7"], [870.0, 1085.6, None, None]),
        ("temperature", ["NaN", "Infinity", "-Infinity"], [None, None, None]),
    ],
)
def test_cell_rules(spark, rule, given, kept):
    cleaned = clean_measure(cells(spark, given), rule)
    assert sorted((r["A"] for r in cleaned.collect()), key=repr) == sorted(kept, key=repr)


def test_lost_point_is_restored_only_above_the_bound(spark):
    cleaned = clean_measure(cells(spark, ["200001", "343000"]), "temperature").collect()
    assert sorted(r["A"] for r in cleaned) == [pytest.approx(200.001), 343.0]


@pytest.mark.parametrize(
    "text", ["not a date", "2012-13-45 25:00:00", "2012-10-01 12:00:00 x", "2012-10-01", "", None]
)
def test_unreadable_time_drops_the_row(spark, text):
    schema = "datetime string, A string"
    raw = spark.createDataFrame([(text, "250"), (NOON, "260")], schema)
    assert [r["A"] for r in clean_measure(raw, "temperature").collect()] == [260.0]
    assert clean_description(raw).count() == 1


def test_time_in_the_session_zones_gap_is_kept(spark):
    df = spark.createDataFrame([("2016-03-13 02:30:00",)], "t string")
    assert str(df.select(parse_time(F.col("t"))).first()[0]) == "2016-03-13 02:30:00"


def test_bad_cell_drops_the_row_or_only_itself(spark):
    raw = cells(spark, ["abc", "251"])
    assert [(r["A"], r["B"]) for r in clean_measure(raw, "temperature").collect()] == [(251.0, 250.0)]
    blanked = clean_measure(raw, "temperature", on_bad_cell="blank")
    assert [r[1:] for r in rows(blanked)] == [(251.0, 250.0), (None, 250.0)]
    with pytest.raises(ValueError):
        clean_measure(raw, "temperature", on_bad_cell="keep")


def test_single_city_and_no_city(spark):
    one = spark.createDataFrame([(NOON, "x"), (NOON, "300")], "datetime string, A string")
    assert clean_measure(one, "temperature").count() == 1
    none = spark.createDataFrame([(NOON,)], "datetime string")
    assert clean_measure(none, "temperature").count() == 1


def test_many_cities(spark):
    names = [f"City {i}" for i in range(250)]
    raw = spark.createDataFrame(
        [(NOON, *["250"] * 250), (NOON, *["250"] * 249, "x")],
        ", ".join(["datetime string", *[f"`{n}` string" for n in names]]),
    )
    assert clean_measure(raw, "temperature").count() == 1


def test_coordinates_with_ends(spark):
    given = [("a", "90", "180"), ("b", "-90", "-180"), ("c", "90.1", "0"), ("d", "0", "-180.1"), ("e", "x", "0")]
    cities = spark.createDataFrame(given, "City string, Latitude string, Longitude string")
    kept = clean_city(cities).collect()
    assert sorted(r["City"] for r in kept) == ["a", "b"]
    assert all(math.fabs(r["Latitude"]) == 90 for r in kept)


def test_header_loses_spaces_and_rows_keep_them(spark):
    df = spark.createDataFrame([("San Example",)], "`City Name` string")
    assert to_underscores(df).columns == ["City_Name"]
    assert to_underscores(df).first()[0] == "San Example"


def test_cleaning_many_cities_and_reshaping_them_is_planned_quickly(spark):
    names = [f"City {i}" for i in range(120)]
    raw = spark.createDataFrame(
        [(NOON, *["250000"] * 120), (NOON, *["250"] * 119, "x")],
        ", ".join(["datetime string", *[f"`{n}` string" for n in names]]),
    )
    long = to_long(clean_measure(raw, "temperature"), "temperature")
    assert long.where("temperature = 250").count() == 120
