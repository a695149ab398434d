import pytest
from conftest import rows
from pyspark.sql import functions as F

from cityobs.operators.latency import latency_by_file, pair_events
from cityobs.registry import adapters as data
from cityobs.registry import queries
from cityobs.streaming import (
    arriving_events,
    dropped_as_late,
    pair_arrivals,
    read_running_latency,
    running_latency,
)
from cityobs.streaming.latency import EVENT_SCHEMA

HOUR = 3_600_000


def received(uuid, at):
    return "RECEIVE", uuid, at, 0, None, "f"


def sent(uuid, at, took=0, name="f"):
    return "SEND", "s", at, took, uuid, name


@pytest.fixture
def flow(spark, tmp_path):
    """Writes a file of events and runs the stream on what there is, from its checkpoint."""

    class Flow:
        folder, out, progress, files = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), 0

        def add(self, *events):
            self.files += 1
            spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1).write.parquet(f"{self.folder}/{self.files}")

        def run(self):
            query = pair_arrivals(arriving_events(spark, f"{self.folder}/*", 1), self.out, self.progress, "1 hour", "6 hours")
            query.awaitTermination()
            return dropped_as_late(query)

        def all(self):
            return spark.read.schema(EVENT_SCHEMA).parquet(f"{self.folder}/*")

        def pairs(self):
            return spark.read.parquet(self.out)

    return Flow()


def test_pairs_over_restarts_equal_those_of_a_batch(flow):
    flow.add(received("a", HOUR), received("b", HOUR), sent("c", 2 * HOUR), sent("a", HOUR + 500, 250), received(None, 0))
    assert flow.run() == 0
    flow.add(sent("b", 5 * HOUR, 10), sent("b", 5 * HOUR, 10), received("c", 2 * HOUR), sent(None, 3 * HOUR))
    assert flow.run() == 0
    flow.add(sent("a", 6 * HOUR, 1, "g"), received("d", 6 * HOUR), sent("d", 6 * HOUR))
    assert flow.run() == 0
    assert rows(flow.pairs()) == rows(pair_events(flow.all()))
    assert flow.pairs().count() == 6


def test_late_events_are_left_out_and_counted(flow):
    flow.add(received("a", HOUR), received("b", 20 * HOUR))
    flow.run()
    flow.add(received("x", 21 * HOUR), sent("y", 21 * HOUR))
    flow.run()
    flow.add(sent("a", HOUR + 1), sent("b", 20 * HOUR + 1))  # the first is 20 hours late
    assert flow.run() == 1
    assert [r["elapsed"] for r in flow.pairs().collect()] == [0.001]
    assert pair_events(flow.all()).count() == 2


def test_deliveries_outside_the_time_waited_for_make_no_pair(flow):
    flow.add(received("a", HOUR), sent("a", HOUR - 1), sent("a", 7 * HOUR), sent("a", 7 * HOUR + 1))
    flow.run()
    assert [r["elapsed"] for r in flow.pairs().collect()] == [6 * 3600.0]


def test_state_does_not_keep_what_can_have_no_partner(spark, flow):
    for k in range(1, 7):
        flow.add(received(f"u{k}", 10 * k * HOUR), sent(f"u{k}", 10 * k * HOUR + 1))
    query = pair_arrivals(arriving_events(spark, f"{flow.folder}/*", 1), flow.out, flow.progress, "1 hour", "6 hours")
    query.awaitTermination()
    kept = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]
    assert flow.pairs().count() == 6 and kept[-1] <= 4 < 12


def test_report_after_each_batch_equals_all_so_far(spark, tmp_path):
    folder, out, progress = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "filename string, timestamp string, elapsed double"
    batches = [
        [("f", "t", 1.0), ("f", "t", 3.0), ("g", "t", 1e9), (None, "t", 2.0)],
        [("f", "t", 2.5), ("h", "t", 7.0), ("h", "t", None)],
        [("g", "t", 1e9 + 1), ("g", "t", 1e9 + 2), (None, "t", 5.0)],
    ]
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).write.parquet(f"{folder}/{k}")
        arriving = spark.readStream.schema(schema).parquet(f"{folder}/*")
        running_latency(arriving, out, progress).awaitTermination()  # from the checkpoint of the run before
        wanted = latency_by_file(spark.read.parquet(f"{folder}/*"))
        got = read_running_latency(spark, out)
        shown = [F.round(c, 6).alias(c) for c in ("avg", "stddev")]
        assert rows(got.select("filename", "count", *shown)) == rows(wanted.select("filename", "count", *shown))


def test_a_repeated_batch_replaces_what_it_wrote(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = "filename string, avg double, stddev double, count long"
    for number, values in ((0, (1.0, 0.0, 1)), (1, (2.0, 1.0, 2)), (1, (2.5, 1.5, 2))):
        spark.createDataFrame([("f", *values)], schema).write.mode("overwrite").parquet(f"{out}/batch={number}")
    assert rows(read_running_latency(spark, out)) == [("f", 2.5, 1.5, 2)]


def test_state_has_the_parts_asked_for_and_the_session_keeps_its_own(spark, flow, tmp_path):
    flow.add(received("a", HOUR), sent("a", HOUR + 500))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (2, 3):  # the checkpoint's first run decides
        events = arriving_events(spark, f"{flow.folder}/*")
        pairs = pair_arrivals(events, flow.out, flow.progress, "1 hour", "6 hours", state_partitions=parts)
        pairs.awaitTermination()
        arriving = spark.readStream.schema("filename string, timestamp string, elapsed double").parquet(flow.out)
        report = running_latency(arriving, str(tmp_path / "report"), str(tmp_path / "progress"), state_partitions=parts)
        report.awaitTermination()
        state = [op["numShufflePartitions"] for q in (pairs, report) for p in q.recentProgress for op in p["stateOperators"]]
        assert state and set(state) == {2}
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        flow.add(received("b", 2 * HOUR), sent("b", 2 * HOUR + 500))
    assert rows(read_running_latency(spark, str(tmp_path / "report"))) == [("f", 0.5, 0.0, 2)]


def test_batches_of_the_running_report_do_not_grow_with_shuffle_partitions(spark, small, monkeypatch):
    started = []
    monkeypatch.setattr(queries, "running_latency", lambda *a, **b: started.append(running_latency(*a, **b)) or started[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    try:
        got = rows(queries.latency_running(spark, small))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    batches = [p for query in started for p in query.recentProgress]
    assert len(batches) == queries.ARRIVALS
    parts = {op["numShufflePartitions"] for p in batches for op in p["stateOperators"]}
    assert parts == {spark.sparkContext.defaultParallelism}
    wanted = latency_by_file(pair_events(data.file_events(spark, small)))
    shown = [F.round(c, 4).alias(c) for c in ("avg", "stddev")]
    assert got == rows(wanted.select("filename", *shown, "count"))
