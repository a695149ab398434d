import datetime as dt
import zoneinfo
from dataclasses import replace

import duckdb
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cityobs.operators import dimension as dimension_module
from cityobs.operators.dimension import DuplicateCity, attach_city, city_dimension, localize
from cityobs.operators.clean import clean_measure
from cityobs.operators.reshape import to_long, to_wide
from cityobs.functions.localtime import in_local_years, near_local_months

DIM = "City string, Country string, TimeUTC string"
ZONES = ["Africa/Johannesburg", "America/New_York", "Asia/Tokyo", "Europe/Rome", "Asia/Jerusalem"]


def obs(spark, *given):
    df = spark.createDataFrame([(c, t) for c, t in given], "City string, t string")
    return df.select(F.col("t").cast("timestamp_ntz").alias("ts"), "City")


def local(df):
    return sorted((r["City"], str(r["local_ts"]), str(r["local_date"]), r["local_hour"]) for r in df.collect())


def test_daylight_saving_and_session_zone(spark):
    dim = spark.createDataFrame([("N", "US", "America/New_York")], DIM)
    given = obs(spark, ("N", "2016-03-13 06:30:00"), ("N", "2016-03-13 07:30:00"), ("N", "2016-01-13 10:30:00"))
    wanted = [
        ("N", "2016-01-13 05:30:00", "2016-01-13", 5),
        ("N", "2016-03-13 01:30:00", "2016-03-13", 1),
        ("N", "2016-03-13 03:30:00", "2016-03-13", 3),
    ]
    for zone in ("America/New_York", "UTC", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert local(localize(given, dim)) == wanted
        finally:
            spark.conf.set("spark.sql.session.timeZone", "America/New_York")


def test_times_before_1970_and_fractions(spark):
    dim = spark.createDataFrame([("R", "IT", "UTC")], DIM)
    got = localize(obs(spark, ("R", "1969-12-31 23:59:58.300000")), dim).first()
    assert str(got["local_ts"]) == "1969-12-31 23:59:58.300000"
    assert (str(got["local_date"]), got["local_hour"]) == ("1969-12-31", 23)


@pytest.mark.parametrize("inline", [True, False])
def test_every_hour_around_changes_equals_sql(spark, monkeypatch, inline):
    """Zone lists short enough for a CASE, and longer ones read from the column."""
    if not inline:
        monkeypatch.setattr(dimension_module, "MAX_INLINE_ZONES", 2)
    dim = spark.createDataFrame([(z, "c", z) for z in ZONES], DIM)
    start = F.lit("1999-01-01 00:30:00").cast("timestamp_ntz")
    hours = spark.range(0, 24 * 366 * 2).select(
        F.timestamp_add("HOUR", F.col("id"), start).alias("ts")
    )
    given = hours.crossJoin(spark.createDataFrame([(z,) for z in ZONES], "City string"))
    assert (city_dimension(dim).zones is not None) == inline
    got = localize(given, dim).select("City", F.col("ts").cast("string"), F.col("local_ts").cast("string"), "local_hour")
    sql = """SELECT z, CAST(ts AS VARCHAR), CAST(timezone(z, timezone('UTC', ts)) AS VARCHAR),
        hour(timezone(z, timezone('UTC', ts)))
      FROM (SELECT unnest(?) AS z), (SELECT TIMESTAMP '1999-01-01 00:30:00' + to_hours(CAST(i AS INTEGER)) AS ts FROM range(17568) t(i))"""
    assert rows(got) == sorted(duckdb.execute(sql, [ZONES]).fetchall(), key=repr)


def test_more_zones_than_a_case_may_hold(spark):
    names = sorted(z for z in zoneinfo.available_timezones() if z.startswith(("America/", "Europe/")))[:80]
    dim = city_dimension(spark.createDataFrame([(z, "c", z) for z in names], DIM))
    assert dim.zones is None
    got = localize(obs(spark, *[(z, "2010-07-01 12:00:00") for z in names]), dim).collect()
    utc = dt.datetime(2010, 7, 1, 12, tzinfo=dt.UTC)
    for r in got:
        assert r["local_hour"] == utc.astimezone(zoneinfo.ZoneInfo(r["City"])).hour, r["City"]


def test_null_zone_gives_null_time_and_unknown_city_drops_out(spark):
    dim = spark.createDataFrame([("A", "x", None)], DIM)
    got = localize(obs(spark, ("A", "2010-07-01 12:00:00"), ("B", "2010-07-01 12:00:00")), dim).collect()
    assert [(r["City"], r["local_ts"], r["local_date"], r["local_hour"]) for r in got] == [("A", None, None, None)]


@pytest.mark.parametrize("max_rows", [200_000, 1])
def test_duplicate_city_is_an_error(spark, max_rows):
    dim = spark.createDataFrame([("A", "x", "UTC"), ("A", "y", "UTC"), ("B", "y", "UTC")], DIM)
    with pytest.raises(DuplicateCity):
        city_dimension(dim, max_rows=max_rows)


def test_join_is_a_broadcast_within_the_bound_and_salted_beyond(spark):
    dim = spark.createDataFrame([(f"C{i}", "x", "UTC") for i in range(10)], DIM)
    given = obs(spark, *[(f"C{i % 12}", f"2010-07-01 12:00:{i:02d}") for i in range(40)])
    small, large = city_dimension(dim), city_dimension(dim, max_rows=3)
    assert small.fits and not large.fits
    assert "BroadcastHashJoin" in plan(attach_city(given, small))
    assert "__salt" in plan(attach_city(given, large))
    assert rows(attach_city(given, small)) == rows(attach_city(given, large))
    heavy = city_dimension(dim, max_bytes=10)
    assert not heavy.fits


def test_zone_shift_is_computed_once_and_without_python(spark):
    dim = spark.createDataFrame([("A", "x", "Europe/Rome")], DIM)
    shifted = localize(obs(spark, ("A", "2010-07-01 12:00:00")), dim)
    text = plan(shifted.where("local_hour > 3 and year(local_date) = 2010").groupBy("local_date").count())
    assert text.count("from_utc_timestamp") == 2  # the known zone, and any other
    assert "Python" not in text and "MapPartitions" not in text


def test_zone_unknown_when_the_dimension_was_checked_keeps_its_readings(spark, tmp_path):
    known = city_dimension(spark.createDataFrame([("A", "x", "Europe/Rome")], DIM))
    grown = spark.createDataFrame([("A", "x", "Europe/Rome"), ("B", "y", "Asia/Tokyo")], DIM)
    dim = replace(known, df=grown)
    got = localize(obs(spark, ("A", "2010-07-01 12:00:00"), ("B", "2010-07-01 12:00:00")), dim)
    assert [(r["City"], r["local_hour"]) for r in got.orderBy("City").collect()] == [("A", 14), ("B", 21)]


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Tokyo"])
def test_instants_do_not_pass_through_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        dim = spark.createDataFrame([("A", "x", "Europe/Rome")], DIM)
        # The second instant is inside the hour that New York has twice.
        times = spark.createDataFrame([("A", 1468405800), ("A", 1478411400)], "City string, s long")
        given = times.select(F.timestamp_seconds("s").alias("ts"), "City")
        got = localize(given, dim).select(F.col("local_ts").cast("string")).collect()
        assert sorted(r[0] for r in got) == ["2016-07-13 12:30:00", "2016-11-06 06:50:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_cell_that_is_no_number_is_an_error_or_null(spark):
    wide = spark.createDataFrame([("2016-01-01 00:00:00", "1", "abc"), ("2016-01-01 01:00:00", " ", None)], "datetime string, A string, B string")
    with pytest.raises(Exception, match="is no number: abc"):
        to_long(wide, "t").collect()
    assert [(r["City"], r["t"]) for r in to_long(wide, "t", on_bad_cell="null").collect()] == [("A", 1.0)]
    with pytest.raises(ValueError):
        to_long(wide, "t", on_bad_cell="skip")


def wide_table(spark):
    schema = "datetime string, New_Example string, `St._Dot` double, Empty string"
    given = [
        ("2016-01-01 00:00:00", "1", 2.0, None),
        ("2016-01-01 01:00:00", "", None, None),
        ("nonsense", "5", 6.0, None),
    ]
    return spark.createDataFrame(given, schema)


def test_to_long_names_types_and_empty_cells(spark):
    got = to_long(wide_table(spark), "t")
    assert dict(got.dtypes) == {"ts": "timestamp_ntz", "City": "string", "t": "double"}
    midnight = dt.datetime(2016, 1, 1)
    assert rows(got) == [(midnight, "New Example", 1.0), (midnight, "St. Dot", 2.0)]


def test_to_long_picks_cities_before_the_scan(spark, tmp_path):
    wide_table(spark).write.parquet(str(tmp_path / "w"))
    got = to_long(spark.read.parquet(str(tmp_path / "w")), "t", cities=["St. Dot"])
    assert {r["City"] for r in got.collect()} == {"St. Dot"}
    assert "ReadSchema: struct<datetime:string,St._Dot:double>" in plan(got)
    assert to_long(wide_table(spark), "t", cities=["nowhere"]).count() == 0


def test_to_long_reads_timestamps_as_they_are(spark):
    typed = wide_table(spark).withColumn("datetime", F.expr("try_cast(datetime as timestamp_ntz)"))
    assert rows(to_long(typed, "t")) == rows(to_long(wide_table(spark), "t"))


def test_time_filter_reaches_the_scan(spark, tmp_path):
    typed = wide_table(spark).withColumn("datetime", F.expr("try_cast(datetime as timestamp_ntz)"))
    typed.write.parquet(str(tmp_path / "w"))
    long = to_long(spark.read.parquet(str(tmp_path / "w")), "t")
    text = plan(long.where(in_local_years(F.col("ts"), 2016, 2016)))
    assert "GreaterThanOrEqual(datetime,2015-12-31T00:00)" in text
    assert "LessThan(datetime,2017-01-02T00:00)" in text


def test_wider_filters_lose_nothing(spark):
    given = ZONES + ["Pacific/Kiritimati", "Etc/GMT+12", "Pacific/Apia"]
    dim = spark.createDataFrame([(z, "c", z) for z in given], DIM)
    start = F.lit("2015-11-01 00:00:00").cast("timestamp_ntz")
    hours = spark.range(0, 24 * 500).select(F.timestamp_add("HOUR", F.col("id"), start).alias("ts"))
    shifted = localize(hours.crossJoin(spark.createDataFrame([(z,) for z in given], "City string")), dim)
    months = [3, 4, 12]
    in_months = shifted.where(F.month("local_date").isin(months))
    assert in_months.where(~near_local_months(F.col("ts"), months)).count() == 0
    in_year = shifted.where(F.year("local_date") == 2016)
    assert in_year.where(~in_local_years(F.col("ts"), 2016, 2016)).count() == 0


def test_wide_and_back_is_the_identity_on_means(spark):
    given = spark.createDataFrame(
        [("2016-01-01 00:00:00", "A", 1.0), ("2016-01-01 00:00:00", "A", 3.0), ("2016-01-01 01:00:00", "B", 5.0)],
        "ts string, City string, t double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    back = to_long(to_wide(given, "t", ["A", "B"]), "t")
    assert rows(back) == rows(given.groupBy("ts", "City").agg(F.avg("t").alias("t")))


def test_city_names_with_quotes_and_backslashes(spark):
    names = ["Cote d'Or", "a\\b", 'say "hi"', "tick`s", "semi;colon"]
    wide = spark.createDataFrame([("2016-01-01 00:00:00", *["250"] * 5)], ["datetime", *names])
    cleaned = clean_measure(wide, "temperature")
    assert cleaned.columns == ["datetime", *names]
    assert {r["City"] for r in to_long(cleaned, "t").collect()} == set(names)
