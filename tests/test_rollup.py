import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityobs.plans import rollup
from cityobs.plans.stats import monthly_stats
from cityobs.sources import snapshots

DIM = "City string, Country string, TimeUTC string"
MEASURES = ["temperature", "pressure"]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("A", "x", "Europe/Rome"), ("B", "x", "UTC"), ("C", None, "UTC")], DIM)


def readings(spark, seed, n=200, offset=0.0):
    pick = random.Random(seed)
    given = [
        (pick.randrange(24 * 150), pick.choice("ABCD"), pick.choice([None, offset + pick.random() * 40]), float(pick.randrange(1000)))
        for _ in range(n)
    ]
    df = spark.createDataFrame(given, "h int, City string, temperature double, pressure double")
    return df.select(F.expr("timestampadd(HOUR, h, timestamp_ntz'2015-11-01 00:00:00')").alias("ts"), "City", *MEASURES)


def same(got, wanted):
    values = [c for c in wanted.columns if c not in ("Year", "Month", "Country")]
    shown = [F.round(c, 6).alias(c) for c in values]
    assert rows(got.select("Year", "Month", "Country", *shown)) == rows(wanted.select("Year", "Month", "Country", *shown))


def test_states_of_batches_equal_one_aggregation(spark, dim, tmp_path):
    root, parts = str(tmp_path / "r"), [readings(spark, k) for k in range(4)]
    for number in (0, 1, 1, 2):
        assert rollup.add_batch(dict.fromkeys(MEASURES, parts[number]), dim, root, number)
    wanted = lambda k: monthly_stats(dict.fromkeys(MEASURES, parts[0].union(parts[1]).union(parts[2]).union(parts[3].limit(k))), dim)
    same(rollup.rolled_up_stats(spark, root, MEASURES), wanted(0))
    assert rollup.compact(spark, root, MEASURES, 1) == 1
    assert not rollup.add_batch(dict.fromkeys(MEASURES, parts[1]), dim, root, 1)  # merged already
    same(rollup.rolled_up_stats(spark, root, MEASURES), wanted(0))
    assert rollup.compact(spark, root, MEASURES, 2) == 2 and rollup.compact(spark, root, MEASURES, 2) == 2
    rollup.add_batch(dict.fromkeys(MEASURES, parts[3]), dim, root, 3)
    same(rollup.rolled_up_stats(spark, root, MEASURES), wanted(200))


def test_small_spread_around_a_large_mean(spark, dim, tmp_path):
    root, parts = str(tmp_path / "r"), [readings(spark, k, offset=1e8) for k in range(3)]
    for number, part in enumerate(parts):
        rollup.add_batch({"temperature": part}, dim, root, number)
    wanted = monthly_stats({"temperature": parts[0].union(parts[1]).union(parts[2])}, dim)
    got = {tuple(r[:3]): r["std_pop_temperature"] for r in rollup.rolled_up_stats(spark, root, ["temperature"]).collect()}
    for r in wanted.collect():
        assert got[tuple(r[:3])] == pytest.approx(r["std_pop_temperature"], abs=1e-4)


def test_a_batch_that_lacks_a_measure(spark, dim, tmp_path):
    root, a, b = str(tmp_path / "r"), readings(spark, 1), readings(spark, 2)
    rollup.add_batch({"temperature": a}, dim, root, 0)
    rollup.add_batch({"pressure": b}, dim, root, 1)
    rollup.add_batch({"pressure": b.limit(0)}, dim, root, 2)
    same(rollup.rolled_up_stats(spark, root, MEASURES), monthly_stats({"temperature": a, "pressure": b}, dim))
    with pytest.raises(FileNotFoundError):
        rollup.rolled_up_stats(spark, str(tmp_path / "none"), MEASURES)


def test_arriving_readings(spark, dim, tmp_path):
    folder, root, progress = (str(tmp_path / x) for x in ("in", "r", "cp"))
    for k in range(3):
        readings(spark, k).write.parquet(f"{folder}/{k}")
        schema = spark.read.parquet(f"{folder}/0").schema
        rows_ = spark.readStream.schema(schema).parquet(f"{folder}/*")
        rollup.roll_up_arrivals(rows_, MEASURES, dim, root, progress).awaitTermination()
        so_far = spark.read.parquet(f"{folder}/*")
        same(rollup.rolled_up_stats(spark, root, MEASURES), monthly_stats(dict.fromkeys(MEASURES, so_far), dim))


def test_a_failed_write_leaves_the_earlier_snapshot(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, root)
    first = snapshots.write_snapshot(spark.range(3).toDF("a"), root, {"by": "me"})
    assert (first.number, first.note) == (1, {"by": "me"})
    with pytest.raises(Exception, match="broken"):
        snapshots.write_snapshot(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("a")), root)
    assert rows(snapshots.read_snapshot(spark, root)) == [(0,), (1,), (2,)]
    assert snapshots.latest_snapshot(spark, root) == first


def test_snapshots_follow_each_other_and_conflicts_are_told(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(1, 4):
        snapshots.write_snapshot(spark.range(k).toDF("a"), root, after=k - 1)
    reading = snapshots.read_snapshot(spark, root)
    with pytest.raises(snapshots.SnapshotConflict):
        snapshots.write_snapshot(spark.range(9).toDF("a"), root, after=2)
    assert reading.count() == 3 and snapshots.read_snapshot(spark, root, 1).count() == 1
    snapshots.write_snapshot(spark.range(4).selectExpr("id AS b", "'x' AS c"), root)
    assert reading.count() == 3  # a reader keeps what it began with
    assert snapshots.drop_old_snapshots(spark, root, keep=2) == 2
    assert snapshots.read_snapshot(spark, root).columns == ["b", "c"] and reading.count() == 3
