import math

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cityobs.operators.dimension import city_dimension
from cityobs.operators.parity import parity
from cityobs.operators.ranking import rank_of_picks, rank_spread, rank_within
from cityobs.plans import monthly_stats, seasonal_swing, sunny_periods

DIM = "City string, Country string, TimeUTC string"


def dim_of(spark, *cities, zone="UTC"):
    return spark.createDataFrame([(c, country, zone) for c, country in cities], DIM)


def clear_hours(spark, given):
    """(city, month, days, hours per day) as hourly descriptions of 2016."""
    data = [
        (city, f"2016-{month:02d}-{day:02d} {hour:02d}:00:00", "sky is clear")
        for city, month, days, hours in given
        for day in range(1, days + 1)
        for hour in range(hours)
    ]
    df = spark.createDataFrame(data, "City string, ts string, description string")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.mark.parametrize("how", ["direct", "cascade"])
def test_sunny_bounds(spark, how):
    given = clear_hours(
        spark,
        [("enough", m, 15, 17) for m in (3, 4, 5)]
        + [("16 hours", m, 15, 16) for m in (3, 4, 5)]
        + [("14 days", 3, 14, 17), ("14 days", 4, 15, 17), ("14 days", 5, 15, 17)]
        + [("two months", 3, 20, 24), ("two months", 4, 20, 24), ("two months", 6, 20, 24)],
    )
    dim = dim_of(spark, *[(c, "x") for c in ("enough", "16 hours", "14 days", "two months")])
    assert rows(sunny_periods(given, dim, how=how)) == [(2016, "enough")]
    cloudy = given.withColumn("description", F.lit("overcast clouds"))
    assert rows(sunny_periods(cloudy, dim, how=how)) == []


def test_sunny_days_are_local_days(spark):
    """17 clear hours of every other local day, spread over two UTC days."""
    data = [
        ("T", f"2016-{m:02d}-{d:02d} 15:00:00", h) for m in (3, 4, 5) for d in range(1, 30, 2) for h in range(17)
    ]
    df = spark.createDataFrame(data, "City string, start string, h int")
    start = F.col("start").cast("timestamp_ntz")
    given = df.select("City", F.timestamp_add("HOUR", F.col("h"), start).alias("ts"), F.lit("sky is clear").alias("description"))
    assert rows(sunny_periods(given, dim_of(spark, ("T", "JP"), zone="Asia/Tokyo"))) == [(2016, "T")]
    assert rows(sunny_periods(given, dim_of(spark, ("T", "JP"), zone="UTC"))) == []


def test_sunny_shuffles(spark, small):
    from cityobs.registry.queries import q1_sunny, q1_sunny_cascade

    # One per aggregation and one for the final order; the joins with the tables are broadcast.
    assert plan(q1_sunny(spark, small)).count("Exchange hashpartitioning") == 2
    assert plan(q1_sunny_cascade(spark, small)).count("Exchange hashpartitioning") == 3


def readings(spark, measure, given):
    df = spark.createDataFrame(given, f"City string, ts string, {measure} double")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.mark.parametrize("method", ["direct", "joined"])
def test_stats_of_one_reading_and_missing_measures(spark, method):
    a = readings(spark, "a", [("X", "2016-01-01 00:00:00", 1.0), ("X", "2016-02-01 00:00:00", 1.0), ("X", "2016-02-02 00:00:00", 3.0)])
    b = readings(spark, "b", [("X", "2016-02-01 00:00:00", 7.0), ("N", "2016-02-01 00:00:00", 9.0)])
    dim = dim_of(spark, ("X", "land"), ("N", None))
    outer = monthly_stats({"a": a, "b": b}, dim, method=method)
    got = {(r["Month"], r["Country"]): r.asDict() for r in outer.collect()}
    assert set(got) == {(1, "land"), (2, "land"), (2, None)}
    january, february = got[1, "land"], got[2, "land"]
    assert (january["std_samp_a"], january["std_pop_a"]) == (None, 0.0)
    assert all(january[c] is None for c in january if c.endswith("_b"))
    assert (february["max_a"], february["min_a"], february["avg_a"]) == (3.0, 1.0, 2.0)
    assert february["std_samp_a"] == pytest.approx(math.sqrt(2)) and february["std_pop_a"] == 1.0
    inner = monthly_stats({"a": a, "b": b}, dim, how="inner", method=method)
    assert [(r["Month"], r["Country"]) for r in inner.collect()] == [(2, "land")]


def test_stats_arguments(spark):
    with pytest.raises(ValueError):
        monthly_stats({}, dim_of(spark, ("X", "l")))
    with pytest.raises(ValueError):
        monthly_stats({None: None}, dim_of(spark, ("X", "l")))
    with pytest.raises(ValueError):
        monthly_stats({"a": None}, dim_of(spark, ("X", "l")), how="left")


def test_stats_leave_out_cities_without_a_zone(spark):
    a = readings(spark, "a", [("X", "2016-01-01 00:00:00", 1.0)])
    assert monthly_stats({"a": a}, dim_of(spark, ("X", "land"), zone=None)).count() == 0


def seasons(spark, given):
    """(city, year, winter mean, summer mean), either season may be missing."""
    data = []
    for city, year, winter, summer in given:
        for month, value in ((2, winter), (7, summer)):
            if value is not None:
                data.append((city, f"{year}-{month:02d}-03 12:00:00", value))
                data.append((city, f"{year}-{month:02d}-03 15:59:59", value))
        # Outside the hours, the seasons and the years.
        data += [(city, f"{year}-02-03 11:59:59", -1e6), (city, f"{year}-05-03 12:00:00", -1e6)]
        data += [(city, f"{year}-02-03 16:00:00", -1e6), (city, f"{year + 40}-02-03 12:00:00", -1e6)]
    return readings(spark, "temperature", data)


SWINGS = [
    ("A", 2017, 0.0, 10.0), ("A", 2016, 0.0, 1.0),
    ("B", 2017, 0.0, 30.0), ("B", 2016, 0.0, 2.0),
    ("C", 2017, 20.0, 0.0), ("C", 2016, 0.0, 2.0),
    ("D", 2017, 0.0, 20.0), ("D", 2016, 0.0, 4.0),
    ("one season", 2017, 0.0, None), ("one season", 2016, 0.0, 9.0),
    ("new", 2017, 0.0, 25.0),
    ("pair 1", 2017, 0.0, 1.0), ("pair 1", 2016, 0.0, 1.0),
    ("pair 2", 2017, 0.0, 2.0), ("pair 2", 2016, 0.0, 0.5),
]
LANDS = [(c, "big") for c in ("A", "B", "C", "D", "one season", "new")] + [("pair 1", "two"), ("pair 2", "two")]


@pytest.mark.parametrize("max_rows", [200_000, 1])
@pytest.mark.parametrize("method", ["direct", "counting"])
def test_swing_ranks_ties_and_gaps(spark, method, max_rows):
    dim = city_dimension(dim_of(spark, *LANDS), max_rows=max_rows)
    given = seasons(spark, SWINGS)
    got = [tuple(r) for r in seasonal_swing(given, dim, method=method).collect()]
    # "new" is second in 2017 and drops out; C and D tie for third, C comes first.
    assert got == [
        ("two", "pair 2", 2.0, 2, 1),
        ("two", "pair 1", 1.0, 1, 2),
        ("big", "B", 30.0, 3, 1),
        ("big", "C", 20.0, 4, 3),
    ]
    again = seasonal_swing(given, dim, method=method, rerank_after_join=True)
    assert [r["rank_year"] for r in again.collect()] == [1, 2, 1, 2]


def test_swing_plan(spark, small):
    from cityobs.registry.queries import q3_swing

    text = plan(q3_swing(spark, small))
    assert "BroadcastHashJoin" in text and "Python" not in text and "Cartesian" not in text
    assert text.count("from_utc_timestamp") == 6  # one per zone, and one for zones not known beforehand
    assert "l_shipdate" in text


def test_top_k_is_cut_before_the_shuffle(spark, small):
    from cityobs.registry.queries import top3_per_country

    text = plan(top3_per_country(spark, small))
    assert text.count("WindowGroupLimit") == 2


def test_parity_finds_every_kind_of_difference(spark):
    schema = "k int, x double, s string"
    a = spark.createDataFrame([(1, 1.0, "p"), (2, 1.0, "p"), (3, 1.0, "p"), (4, None, "p"), (5, 1.0, "p"), (5, 1.0, "p"), (6, 1.0, "p")], schema)
    b = spark.createDataFrame([(1, 1.004, "p"), (2, 1.006, "p"), (3, 1.0, "q"), (4, 1.0, "p"), (5, 1.0, "p"), (7, 1.0, "p")], schema)
    found = parity(a, b, ["k"], {"x": 0.005})
    assert [(r["k"], r["rows_a"], r["rows_b"]) for r in found.orderBy("k").collect()] == [
        (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 2, 1), (6, 1, 0), (7, 0, 1)
    ]
    assert parity(a, a, ["k"]).count() == 0
    assert parity(a, b, ["k"]).where("k = 1").count() == 1
    assert "Join" not in plan(found)
    with pytest.raises(ValueError):
        parity(a, b.drop("s"), ["k"])


def test_spread_ranks_equal_sorted_ones(spark):
    n = F.col("id")
    given = spark.range(3000).select(
        F.when(n % 3 > 0, "big").when(n % 2 == 0, "small").alias("g"),
        F.when(n % 17 > 0, (n * 7919 % 101).cast("double")).alias("v"),
        n.cast("string").alias("City"),
    )
    got = rank_spread(given.repartition(5), ["g"], "v", "place")
    assert rows(got) == rows(rank_within(given, ["g"], "v", "place"))
    assert rank_spread(given.limit(0), ["g"], "v", "place").count() == 0


def test_places_of_picks_in_a_null_group(spark):
    given = spark.createDataFrame([(None, 3.0, "a"), (None, 2.0, "b"), ("x", 1.0, "c")], "g string, v double, City string")
    for bound in (None, 3, 10**9):
        got = rank_of_picks(given, given, ["g"], "v", "place", picks_bound=bound)
        assert rows(got) == rows(rank_within(given, ["g"], "v", "place"))
