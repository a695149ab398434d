import json
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityobs.operators.latency import ingest_latency, latency_by_file, pair_events
from cityobs.operators.runs import RUN_SCHEMA, summarize_runs
from cityobs.operators.joins import hot_keys, salted_join, split_hot_join
from cityobs.registry import queries
from cityobs.sources.elapsed import read_elapsed, write_elapsed

EVENTS = "event_type string, flow_uuid string, event_time_ms long, duration_ms long, attr_uuid string, filename string"


def events(spark):
    return spark.createDataFrame(
        [
            ("RECEIVE", "u1", 1_000, 50, None, "raw"),
            ("SEND", "v1", 3_000, 500, "u1", "f"),
            ("SEND", "v2", 5_000, 0, "u1", "f"),
            ("SEND", "v3", 5_000, 0, "unknown", "f"),
            ("SEND", "v4", 5_000, 0, None, "f"),
            ("RECEIVE", "u2", 61_000, 0, None, "raw"),
            ("DROP", "u1", 9_000, 0, "u1", "f"),
        ],
        EVENTS,
    )


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_pairs(spark, hot_rows):
    got = pair_events(events(spark), hot_rows=hot_rows)
    assert rows(got) == [("f", "1970-01-01 00:00:01", 2.5), ("f", "1970-01-01 00:00:01", 4.0)]


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_report_without_pairs_equals_report_of_pairs(spark, hot_rows):
    n = F.col("id")
    given = spark.range(3000).select(
        F.when(n % 3 == 0, "RECEIVE").otherwise("SEND").alias("event_type"),
        F.when(n % 2 == 0, F.lit("hot")).otherwise((n % 17).cast("string")).alias("flow_uuid"),
        (n * 977 % 100_000 + 1_700_000_000_000).alias("event_time_ms"),
        (n % 50).alias("duration_ms"),
        F.when(n % 2 == 0, F.lit("hot")).otherwise((n % 17).cast("string")).alias("attr_uuid"),
        (n % 5).cast("string").alias("filename"),
    )
    direct = {r["filename"]: r for r in ingest_latency(given, hot_rows=hot_rows).collect()}
    paired = {r["filename"]: r for r in latency_by_file(pair_events(given)).collect()}
    assert set(direct) == set(paired) and len(direct) == 5
    for name, r in paired.items():
        assert direct[name]["count"] == r["count"]
        assert direct[name]["avg"] == pytest.approx(r["avg"], abs=1e-6)
        assert direct[name]["stddev"] == pytest.approx(r["stddev"], abs=1e-6)


def test_hot_keys_and_salted_join(spark):
    many = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    n = many.where("k = 0").count()
    once = spark.range(7).select(F.col("id").alias("o"))
    assert rows(hot_keys(many, once, "k", "o", 300)) == [(0, -(-n // 300), 1)]
    few = spark.createDataFrame([(0, "z"), (1, "a"), (9, "n")], "k long, name string")
    for how in ("inner", "left"):
        assert rows(salted_join(many, few, ["k"], how, salts=5)) == rows(many.join(few, ["k"], how))
    with pytest.raises(ValueError):
        salted_join(many, few, ["k"], "full_outer")


@pytest.mark.parametrize("hot_rows", [None, 1, 3, 50])
def test_split_join_cuts_both_sides(spark, hot_rows):
    many = spark.range(400).select((F.col("id") % 9).alias("k"), F.when(F.col("id") % 9 == 8, None).otherwise(F.col("id")).alias("x"))
    few = spark.range(60).select(F.when(F.col("id") < 40, 3).otherwise(F.col("id") % 12).alias("o"), F.col("id").alias("y"))
    got = split_hot_join(many, few, "k", "o", hot_rows)
    assert rows(got) == rows(many.join(few, F.col("k") == F.col("o")))
    assert got.columns == ["k", "x", "o", "y"]


def test_deviation_survives_long_delays(spark):
    n = F.col("id")
    start, took = n * 61_000, F.lit(30 * 86_400_000) + n % 3
    both = spark.range(20_000).select(F.concat(F.lit("u"), n.cast("string")).alias("u"), start.alias("s"), (start + took).alias("e"))
    given = both.selectExpr(
        "'RECEIVE' event_type", "u flow_uuid", "s event_time_ms", "0L duration_ms", "CAST(null AS string) attr_uuid", "'f' filename"
    ).unionByName(both.selectExpr("'SEND' event_type", "'x' flow_uuid", "e event_time_ms", "0L duration_ms", "u attr_uuid", "'f' filename"))
    (got,), (want,) = ingest_latency(given).collect(), latency_by_file(pair_events(given)).collect()
    assert got["stddev"] == pytest.approx(want["stddev"], abs=1e-9) and want["stddev"] < 0.001
    assert got["avg"] == pytest.approx(want["avg"], abs=1e-6) and got["count"] == 20_000


def test_records_as_json_lines_and_as_a_list(spark, tmp_path):
    records = pair_events(events(spark))
    write_elapsed(records, str(tmp_path / "lines"))
    assert rows(read_elapsed(spark, str(tmp_path / "lines"))) == rows(records)
    (tmp_path / "list.json").write_text(
        '[\n {"filename": "f", "timestamp": "2019-01-01 00:00:00", "elapsed": 1.5},\n'
        ' {"filename": "g", "timestamp": "2019-01-01 00:00:00", "elapsed": 2}\n]'
    )
    listed = read_elapsed(spark, str(tmp_path / "list.json"), json_list=True)
    assert [(r["filename"], r["elapsed"]) for r in listed.orderBy("filename").collect()] == [("f", 1.5), ("g", 2.0)]


def test_warm_up_runs_do_not_count(spark):
    log = [("query1", "csv", "direct", i + 1, s) for i, s in enumerate([9.0, 9.0, 1.0, 2.0, 3.0])]
    got = summarize_runs(spark.createDataFrame(log, RUN_SCHEMA)).first()
    assert (got["runs"], got["avg"]) == (3, 2.0)
    assert got["stddev"] == pytest.approx(math.sqrt(2 / 3))


def test_lists_hold_a_bounded_number_of_records(spark, tmp_path, monkeypatch):
    records = spark.sql(
        "SELECT if(id < 90, 'f', 'g') AS filename, '2019-01-01 00:00:00' AS timestamp,"
        " CAST(if(id < 40, 0, id) AS DOUBLE) AS elapsed FROM range(100)"
    )
    monkeypatch.setattr(queries, "pair_events", lambda events: records)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr("cityobs.sources.elapsed.LIST_RECORDS", 7, raising=False)
    got = queries.latency_report_list(spark, "/root/testdata/sf0.001")
    assert {r["filename"]: r["count"] for r in got.collect()} == {"f": 90, "g": 10}
    sizes = [len(json.loads(p.read_text())) for p in (tmp_path / "lists").rglob("part-*.txt")]
    assert sum(sizes) == 100 and max(sizes) <= 7
