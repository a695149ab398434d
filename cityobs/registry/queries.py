"""Registered queries: the library's operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityobs.functions.localtime import as_time, epoch_seconds
from cityobs.functions.names import identifier, quoted, to_underscores
from cityobs.operators.checksums import parity_by_ranges
from cityobs.operators.clean import clean_city, clean_description, clean_measure
from cityobs.operators.dimension import city_dimension, localize
from cityobs.operators.geo import nearest_place
from cityobs.operators.latency import ELAPSED_SCHEMA, ingest_latency, latency_by_file, pair_events
from cityobs.operators.parity import TOLERANCE, parity
from cityobs.operators.ranking import rank_of_picks, rank_spread, rank_within, top_within
from cityobs.operators.reshape import to_long, to_wide
from cityobs.operators.runs import summarize_runs
from cityobs.plans import rollup
from cityobs.plans.ingest import clean_cities
from cityobs.plans.stats import measure_stats, monthly_stats
from cityobs.plans.sunny import clear_days, sunny_periods
from cityobs.plans.swing import season_readings, seasonal_swing, yearly_swing
from cityobs.registry import adapters as data
from cityobs.scratch import scratch_path
from cityobs.sources.elapsed import read_elapsed, write_elapsed, write_elapsed_lists, write_latency
from cityobs.sources.layout import Layout
from cityobs.sources.results import load_result, save_result
from cityobs.sources.tables import YEAR_COLUMN, publish, read_table, write_table
from cityobs.streaming import (
    arriving_events,
    arriving_rows,
    clean_arrivals,
    clean_arriving_files,
    pair_arrivals,
    read_cleaned,
    read_running_latency,
    running_latency,
)

Query = Callable[[SparkSession, str], DataFrame]

# Settings under which the driver's tables give answers to all three questions.
SUNNY = {"months": (3, 4, 5), "min_hours": 0, "min_days": 8}
SWING = {"year": 2000, "base_year": 1999}


def _rounded(df: DataFrame, places: int, *prefixes: str) -> DataFrame:
    """Round the columns whose last digits depend on the order of addition."""
    return df.select(
        *[F.round(c, places).alias(c) if c.startswith(prefixes) else c for c in df.columns]
    )


def _text_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _in_order(df: DataFrame) -> DataFrame:
    """The few rows of a sorted result with their place in it."""
    placed = df.withColumn("at", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("at"))).drop("at")


#: Columns of a wide table, at most.
MAX_CITIES = 10_000


def _city_names(spark: SparkSession, sf: str) -> list[str]:
    names = data.table(spark, sf, "nation").orderBy("n_nationkey").select("n_name").limit(MAX_CITIES + 1)
    cities = [r[0] for r in names.collect()]
    if len(cities) > MAX_CITIES:
        raise ValueError(f"more than {MAX_CITIES} cities do not go into the columns of one table")
    return cities


def _wide(spark: SparkSession, sf: str, measure: str) -> DataFrame:
    """One row per hour, one column per city, city names with spaces in them."""
    cities = _city_names(spark, sf)
    wide = to_wide(data.observations(spark, sf), measure, cities)
    return wide.toDF("datetime", *[c.replace("_", " ") for c in cities])


def _spaced_cities(spark: SparkSession, sf: str) -> DataFrame:
    return data.cities(spark, sf).withColumn("City", F.replace("City", F.lit("_"), F.lit(" ")))


# --- the three questions ------------------------------------------------------------------


def q1_sunny(spark: SparkSession, sf: str) -> DataFrame:
    return sunny_periods(data.observations(spark, sf), data.cities(spark, sf), **SUNNY)


def q1_sunny_order(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(q1_sunny(spark, sf))


def q1_sunny_cascade(spark: SparkSession, sf: str) -> DataFrame:
    obs = data.observations(spark, sf)
    return sunny_periods(obs, data.cities(spark, sf), how="cascade", **SUNNY)


def q1_sunny_wide(spark: SparkSession, sf: str) -> DataFrame:
    """From a wide text table; a cell holds the hour's last description in the alphabet."""
    cities = _city_names(spark, sf)
    obs = data.observations(spark, sf)
    wide = obs.groupBy("ts").pivot("City", cities).agg(F.max("description"))
    wide = wide.toDF("datetime", *[c.replace("_", " ") for c in cities])
    long = to_long(to_underscores(wide), "description", text=True)
    return sunny_periods(long, _spaced_cities(spark, sf), **SUNNY)


def _stats(spark: SparkSession, sf: str, how: str, method: str) -> DataFrame:
    tables = data.measure_tables(spark, sf)
    result = monthly_stats(tables, data.cities(spark, sf), how=how, method=method)
    return _rounded(result, 4, "std_")


def q2_stats_outer(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf, "full_outer", "direct")


def q2_stats_order(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(q2_stats_outer(spark, sf)).select("Year", "Month", "Country", "place")


def q2_stats_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf, "inner", "direct")


def q2_stats_joined_outer(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf, "full_outer", "joined")


def q2_stats_joined_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf, "inner", "joined")


def q2_stats_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """As ``q2_stats_outer``, from states of three batches, one of them added again, two of them compacted."""
    tables, dim = data.measure_tables(spark, sf), city_dimension(data.cities(spark, sf))
    root, measures = scratch_path(spark, "rollup"), list(tables)
    cuts = [F.lit(f"{year}-06-15 00:00:00").cast("timestamp_ntz") for year in (1998, 2000)]
    parts = (F.col("ts") < cuts[0], (F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1]), F.col("ts") >= cuts[1])
    for number in (0, 1, 1, 2):
        shared = {id(df): df.where(parts[number]) for df in tables.values()}
        rollup.add_batch({m: shared[id(df)] for m, df in tables.items()}, dim, root, number)
        if number == 1:
            rollup.compact(spark, root, measures, 0)
    rollup.compact(spark, root, measures, 1)
    return _rounded(rollup.rolled_up_stats(spark, root, measures), 4, "std_")


def q2_stats_wide(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        m: to_long(to_underscores(_wide(spark, sf, m)), m) for m in ("temperature", "pressure")
    }
    result = monthly_stats(tables, _spaced_cities(spark, sf))
    return _rounded(result, 4, "max_", "min_", "avg_", "std_")


def q3_swing(spark: SparkSession, sf: str) -> DataFrame:
    result = seasonal_swing(data.observations(spark, sf), data.cities(spark, sf), **SWING)
    return _rounded(result, 6, "difference")


def q3_swing_order(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(q3_swing(spark, sf))


def q3_swing_joined(spark: SparkSession, sf: str) -> DataFrame:
    """As ``q3_swing``, with places found by counting."""
    obs, dim = data.observations(spark, sf), data.cities(spark, sf)
    return _rounded(seasonal_swing(obs, dim, method="counting", **SWING), 6, "difference")


def q3_swing_rerank(spark: SparkSession, sf: str) -> DataFrame:
    """Of many cities at noon, some of the top ones lack the base year and drop out; the others move up."""
    obs, dim = data.supplier_readings(spark, sf), data.many_zones(spark, sf)
    return _rounded(seasonal_swing(obs, dim, hours=(12, 12), rerank_after_join=True, **SWING), 6, "difference")


def q3_swing_large_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """As ``q3_swing`` with a dimension that may not be broadcast."""
    dim = city_dimension(data.cities(spark, sf), max_rows=5)
    return _rounded(seasonal_swing(data.observations(spark, sf), dim, **SWING), 6, "difference")


def q3_swing_wide(spark: SparkSession, sf: str) -> DataFrame:
    long = to_long(to_underscores(_wide(spark, sf, "temperature")), "temperature")
    return _rounded(seasonal_swing(long, _spaced_cities(spark, sf), **SWING), 4, "difference")


# --- parts of the questions ---------------------------------------------------------------


def local_time(spark: SparkSession, sf: str) -> DataFrame:
    obs = data.observations(spark, sf).select("ts", "City")
    return _text_time(localize(obs, data.cities(spark, sf)), "ts", "local_ts")


def local_time_zoned(spark: SparkSession, sf: str) -> DataFrame:
    """From a Parquet table whose times are instants; the session zone has no say."""
    path = scratch_path(spark, "zoned")
    obs = data.observations(spark, sf).select(F.timestamp_seconds(epoch_seconds(F.col("ts"))).alias("ts"), "City")
    write_table(obs, path, "parquet")
    back = read_table(spark, path, "parquet")
    local = localize(back, data.cities(spark, sf))
    return _text_time(local.withColumn("ts", as_time(F.col("ts"), back.schema["ts"].dataType)), "ts", "local_ts")


def local_time_large_dimension(spark: SparkSession, sf: str) -> DataFrame:
    dim = city_dimension(data.cities(spark, sf), max_rows=5)
    obs = data.observations(spark, sf).select("ts", "City")
    return _text_time(localize(obs, dim), "ts", "local_ts")


def local_time_many_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Cities in more zones than a plan may name; changes of clocks are looked up in a table."""
    return _text_time(localize(data.supplier_readings(spark, sf).select("ts", "City"), data.many_zones(spark, sf)), "ts", "local_ts")


def clear_hours(spark: SparkSession, sf: str) -> DataFrame:
    return clear_days(data.observations(spark, sf), data.cities(spark, sf), (3, 4, 5), 1)


def measure_stats_pressure(spark: SparkSession, sf: str) -> DataFrame:
    obs = data.observations(spark, sf)
    return _rounded(measure_stats(obs, data.cities(spark, sf), "pressure"), 4, "std_")


def season_means(spark: SparkSession, sf: str) -> DataFrame:
    obs, dim = data.observations(spark, sf), data.cities(spark, sf)
    readings = season_readings(obs, dim, (1999, 2000))
    means = readings.groupBy("Country", "City", "year", "slot").agg(
        F.avg("value").alias("mean"), F.count("*").alias("n")
    )
    return means


def yearly_swings(spark: SparkSession, sf: str) -> DataFrame:
    obs, dim = data.observations(spark, sf), data.cities(spark, sf)
    return _rounded(yearly_swing(season_readings(obs, dim, (1999, 2000))), 6, "difference")


def top3_per_country(spark: SparkSession, sf: str) -> DataFrame:
    customers = data.table(spark, sf, "customer")
    return top_within(customers, ["c_nationkey"], "c_acctbal", 3, tie="c_custkey").select(
        "c_nationkey", "c_custkey", "c_acctbal", "place"
    )


def rank_of_top3(spark: SparkSession, sf: str) -> DataFrame:
    """The three customers of a nation with the longest names in the alphabet, and their place by
    balance, found by counting."""
    customers = data.table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    picks = top_within(customers, ["c_nationkey"], "c_custkey", 3, tie="c_custkey").drop("place")
    return rank_of_picks(
        customers, picks, ["c_nationkey"], "c_acctbal", "place", tie="c_custkey"
    )


def rank_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every customer in its nation by balance, a nation being spread over tasks."""
    customers = data.table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return rank_spread(customers, ["c_nationkey"], "c_acctbal", "place", tie="c_custkey")


def rank_cities(spark: SparkSession, sf: str) -> DataFrame:
    obs, dim = data.observations(spark, sf), data.cities(spark, sf)
    swings = yearly_swing(season_readings(obs, dim, (1999,)))
    ranked = rank_within(swings, ["Country", "year"], "difference", "place")
    return ranked.select("Country", "City", "year", "place")


# --- reshape ------------------------------------------------------------------------------


def to_long_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Long to wide, spaces to underscores, and back."""
    long = to_long(to_underscores(_wide(spark, sf, "temperature")), "temperature")
    return _text_time(_rounded(long, 4, "temperature"), "ts")


def to_long_some_cities(spark: SparkSession, sf: str) -> DataFrame:
    wide = to_underscores(_wide(spark, sf, "pressure"))
    long = to_long(wide, "pressure", cities=["NATION 3", "NATION 12"])
    return _text_time(_rounded(long, 4, "pressure"), "ts")


def to_long_text(spark: SparkSession, sf: str) -> DataFrame:
    wide = clean_description(data.raw_descriptions(spark, sf))
    return _text_time(to_long(wide, "description", text=True), "ts")


# --- cleaning -----------------------------------------------------------------------------


def _clean(spark: SparkSession, sf: str, rule: str, on_bad_cell: str = "drop_row") -> DataFrame:
    cleaned = clean_measure(data.raw_cells(spark, sf), rule, on_bad_cell=on_bad_cell)
    return _text_time(cleaned, "datetime")


def clean_temperature(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf, "temperature")


def clean_temperature_blank(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf, "temperature", "blank")


def clean_pressure(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf, "pressure")


def clean_humidity(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf, "humidity")


def clean_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    return _text_time(clean_description(data.raw_descriptions(spark, sf)), "datetime")


def clean_city_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean_city(data.raw_cities(spark, sf))


def geo_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest_place(data.raw_cities(spark, sf), data.places(spark, sf))
    return _rounded(found, 3, "distance_km")


def geo_lookup_within(spark: SparkSession, sf: str) -> DataFrame:
    cities, places = data.raw_cities(spark, sf), data.places(spark, sf)
    return _rounded(nearest_place(cities, places, max_km=300.0), 3, "distance_km")


def clean_city_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return clean_cities(data.raw_cities(spark, sf), data.places(spark, sf))


# --- ingest, formats and streams ----------------------------------------------------------


def ingest_long(spark: SparkSession, sf: str) -> DataFrame:
    """Raw CSV, cleaned, published as CSV and Parquet, and both read back as long tables."""
    layout = Layout(scratch_path(spark, "ingest"))
    raw = layout.root + "/raw.csv"
    write_table(data.raw_cells(spark, sf), raw, "csv")
    cleaned = clean_measure(read_table(spark, raw, "csv"), "temperature")
    paths = publish(cleaned, layout, "temperature", ("csv", "parquet"))
    both = [
        to_long(read_table(spark, path, fmt), "temperature").withColumn("format", F.lit(fmt))
        for fmt, path in paths.items()
    ]
    return _text_time(both[0].unionByName(both[1]), "ts")


def csv_headers_differ(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV files whose columns differ in order and set, cleaned in one batch and by a stream."""
    folder = scratch_path(spark, "headers")
    raw = data.raw_cells(spark, sf)
    first, second, third = (identifier(c) for c in data.RAW_CITIES)
    full = F.expr(f"{second} <> ''")
    write_table(raw.where(full).selectExpr("datetime", first, second), f"{folder}/one", "csv")
    write_table(raw.where(~full).selectExpr("datetime", third, second, first), f"{folder}/two", "csv")
    both = f"{folder}/*"
    batch = clean_measure(read_table(spark, both, "csv").select("datetime", *map(quoted, data.RAW_CITIES)), "temperature")
    out = scratch_path(spark, "headers-out")
    done = clean_arriving_files(
        spark, both, lambda rows: clean_measure(rows, "temperature"), out, scratch_path(spark, "progress"), files_per_batch=3
    )
    done.awaitTermination()
    parts = {"batch": batch, "stream": read_cleaned(spark, out)}
    long = [to_long(df, "temperature").withColumn("way", F.lit(way)) for way, df in parts.items()]
    return _text_time(long[0].unionByName(long[1]), "ts")


def roundtrip_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    write_table(data.observations(spark, sf), path, "csv")
    back = read_table(spark, path, "csv")
    numbers = ("temperature", "pressure", "humidity")
    return back.withColumns({c: F.col(c).cast("double") for c in numbers})


def roundtrip_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    write_table(data.observations(spark, sf), path, "parquet")
    return _text_time(read_table(spark, path, "parquet"), "ts")


def roundtrip_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by year, of which one year is read."""
    path = scratch_path(spark, "roundtrip")
    write_table(data.observations(spark, sf), path, "parquet", by_year=True, files_per_year=4)
    back = read_table(spark, path, "parquet").where(F.col(YEAR_COLUMN) == 1999)
    return _text_time(back.drop(YEAR_COLUMN), "ts")


def result_table(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(scratch_path(spark, "results"))
    save_result(q1_sunny(spark, sf), layout, "query1", "direct")
    save_result(q1_sunny_cascade(spark, sf), layout, "query1", "cascade")
    both = load_result(spark, layout, "query1")
    return both.groupBy("Year", "City").agg(F.count("*").alias("variants"))


def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Raw CSV files cleaned by a stream that takes up what is there and stops."""
    raw, out = scratch_path(spark, "arrivals"), scratch_path(spark, "cleaned")
    write_table(data.raw_cells(spark, sf), raw, "csv")
    done = clean_arrivals(
        arriving_rows(spark, raw),
        lambda rows: clean_measure(rows, "temperature"),
        out,
        scratch_path(spark, "progress"),
    )
    done.awaitTermination()
    return _text_time(read_table(spark, out, "parquet"), "datetime")


# --- latency and runs ---------------------------------------------------------------------


def elapsed_records(spark: SparkSession, sf: str) -> DataFrame:
    return pair_events(data.file_events(spark, sf))


def elapsed_records_split(spark: SparkSession, sf: str) -> DataFrame:
    """As ``elapsed_records``, every file that was delivered twice being split."""
    return pair_events(data.file_events(spark, sf), hot_rows=1)


def latency_report(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs to JSON records, and from there to the report and its CSV."""
    records, report = scratch_path(spark, "elapsed"), scratch_path(spark, "latency")
    write_elapsed(pair_events(data.file_events(spark, sf)), records)
    write_latency(latency_by_file(read_elapsed(spark, records)), report)
    back = read_table(spark, report, "csv").select(
        "filename",
        F.col("avg").cast("double").alias("avg"),
        F.col("stddev").cast("double").alias("stddev"),
        F.col("count").cast("long").alias("count"),
    )
    return _rounded(back, 4, "avg", "stddev")


def latency_report_list(spark: SparkSession, sf: str) -> DataFrame:
    """As ``latency_report``, from files that hold one JSON list each."""
    folder = scratch_path(spark, "lists")
    write_elapsed_lists(pair_events(data.file_events(spark, sf)), folder)
    report = latency_by_file(read_elapsed(spark, folder, json_list=True).select("filename", "timestamp", "elapsed"))
    return _rounded(report, 4, "avg", "stddev")


#: Steps in which events arrive.
ARRIVALS = 4
#: Events of a step for each part of the state, at most.
STATE_ROWS = 100_000


def _paired_on_arrival(spark: SparkSession, sf: str) -> Iterator[tuple[str, int]]:
    """All events dealt into steps by their time; every step is paired by a stream that starts again and sees the
    files of that step and those before. Gives, after each step, the folder of the records and in how many parts
    the state is kept."""
    events = data.file_events(spark, sf)
    shares = [k / ARRIVALS for k in range(1, ARRIVALS)]
    found = F.percentile_approx("event_time_ms", F.array(*map(F.lit, shares)))
    bounds, n = events.agg(found, F.count("*")).first()
    cores = spark.sparkContext.defaultParallelism
    parts = cores * max(1, ceil(n / ARRIVALS / STATE_ROWS / cores))
    step = sum((F.when(F.col("event_time_ms") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    folder, records = scratch_path(spark, "events-arriving"), scratch_path(spark, "records")
    progress = scratch_path(spark, "progress")
    events.withColumn("step", step).write.partitionBy("step").parquet(folder)
    for k in range(ARRIVALS):
        arriving = arriving_events(spark, f"{folder}/step={{{','.join(map(str, range(k + 1)))}}}")
        pair_arrivals(arriving, records, progress, state_partitions=parts).awaitTermination()
        yield records, parts


def elapsed_records_stream(spark: SparkSession, sf: str) -> DataFrame:
    """As ``elapsed_records``, from two streams that are joined as the events arrive."""
    *_, (records, _) = _paired_on_arrival(spark, sf)
    return spark.read.parquet(records)


def latency_running(spark: SparkSession, sf: str) -> DataFrame:
    """As ``latency_report``, from moments that the records of every step merge into, all files of a step in one
    batch: a batch costs a task and a commit for each state partition, however few records it has."""
    report, progress = scratch_path(spark, "running"), scratch_path(spark, "progress")
    for records, parts in _paired_on_arrival(spark, sf):
        arriving = spark.readStream.schema(ELAPSED_SCHEMA).parquet(records)
        running_latency(arriving, report, progress, state_partitions=parts).awaitTermination()
    return _rounded(read_running_latency(spark, report), 4, "avg", "stddev")


def elapsed_of_users(spark: SparkSession, sf: str) -> DataFrame:
    """Every view of a user with every purchase, pair by pair, with heavy users split on both sides."""
    pairs = pair_events(data.user_events(spark, sf), hot_rows=3)
    return pairs.groupBy("filename").agg(
        F.count("*").alias("count"), F.sum(F.round(F.col("elapsed") * 1000).cast("long")).alias("total_ms")
    )


def ingest_latency_long_delays(spark: SparkSession, sf: str) -> DataFrame:
    """Delays of 30 days that differ by milliseconds."""
    report = ingest_latency(data.delayed_events(spark, sf))
    return report.select("filename", "count", F.round("avg", 6).alias("avg"), F.round("stddev", 6).alias("stddev"))


def ingest_latency_by_user(spark: SparkSession, sf: str) -> DataFrame:
    """Every view of a user with every purchase, without making the pairs. The mean is shown as
    the total in milliseconds, a whole number, which no rounding can split."""
    report = ingest_latency(data.user_events(spark, sf))
    total = F.round(F.col("avg") * F.col("count") * 1000).cast("long")
    report = report.select("filename", "count", total.alias("total_ms"), "stddev")
    return _rounded(report, 3, "stddev")


def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(summarize_runs(data.run_log(spark, sf)), 4, "avg", "stddev")


# --- parity -------------------------------------------------------------------------------


def parity_q1(spark: SparkSession, sf: str) -> DataFrame:
    """The second result gives the even years a century late."""
    late = F.when(F.col("Year") % 2 == 0, F.col("Year") + 100).otherwise(F.col("Year"))
    other = q1_sunny_cascade(spark, sf).withColumn("Year", late)
    return parity(q1_sunny(spark, sf), other, ["Year", "City"])


def parity_q2(spark: SparkSession, sf: str) -> DataFrame:
    """The second result is off in June."""
    tables, dim = data.measure_tables(spark, sf), city_dimension(data.cities(spark, sf))
    direct = monthly_stats(tables, dim)
    joined = monthly_stats(tables, dim, method="joined")
    off = F.when(F.col("Month") == 6, F.col("avg_pressure") + 1).otherwise(F.col("avg_pressure"))
    loose = {c: TOLERANCE for c in direct.columns if c.startswith(("avg_", "std_"))}
    keys = ["Year", "Month", "Country"]
    return parity(direct, joined.withColumn("avg_pressure", off), keys, loose).select(*keys, "rows_a", "rows_b")


def parity_q3(spark: SparkSession, sf: str) -> DataFrame:
    """The second result ranks the first cities wrongly."""
    obs, dim = data.observations(spark, sf), data.cities(spark, sf)
    a = seasonal_swing(obs, dim, **SWING)
    b = seasonal_swing(obs, dim, method="counting", **SWING)
    off = F.when(F.col("rank_year") == 1, F.col("rank_base") + 1).otherwise(F.col("rank_base"))
    return parity(a, b.withColumn("rank_base", off), ["Country", "City"], {"difference": TOLERANCE}).select(
        "Country", "City", "rows_a", "rows_b"
    )


def parity_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities of an order against the same with each 49 taken for 50: keys occur several times."""
    a = data.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    changed = F.when(F.col("l_quantity") == 49, 50.0).otherwise(F.col("l_quantity"))
    return parity(a, a.withColumn("l_quantity", changed), ["l_orderkey"])


def parity_by_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """As ``parity_repeated_keys``, by checksums of ranges of keys first."""
    a = data.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    changed = F.when(F.col("l_quantity") == 49, 50.0).otherwise(F.col("l_quantity"))
    return parity_by_ranges(a, a.withColumn("l_quantity", changed), ["l_orderkey"])


def parity_few_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against the same with the cheapest ones a cent dearer: few ranges of keys are looked into."""
    a = data.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dearer = F.when(F.col("o_totalprice") < 2000, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    found = parity_by_ranges(a, a.withColumn("o_totalprice", dearer), ["o_orderkey", "o_custkey"])
    return found.select("o_orderkey", "o_custkey", "rows_a", "rows_b", F.round("o_totalprice_a", 2).alias("price"))


def parity_report(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables that do differ: mean pressure per city and day, all readings or clear ones."""
    obs = data.observations(spark, sf).withColumn("day", F.col("ts").cast("date"))
    keys = ["City", "day"]
    a = obs.groupBy(*keys).agg(F.avg("pressure").alias("mean"))
    clear = obs.where(F.col("description") == "sky is clear")
    b = clear.groupBy(*keys).agg(F.avg("pressure").alias("mean"))
    return parity(a, b, keys, {"mean": 1.5})


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        q3_swing,
        q3_swing_joined,
        q3_swing_rerank,
        q3_swing_large_dimension,
        q3_swing_wide,
        q3_swing_order,
        q1_sunny,
        q1_sunny_cascade,
        q1_sunny_wide,
        q1_sunny_order,
        q2_stats_outer,
        q2_stats_inner,
        q2_stats_joined_outer,
        q2_stats_joined_inner,
        q2_stats_rollup,
        q2_stats_wide,
        q2_stats_order,
        local_time,
        local_time_large_dimension,
        local_time_zoned,
        local_time_many_zones,
        clear_hours,
        measure_stats_pressure,
        season_means,
        yearly_swings,
        top3_per_country,
        rank_of_top3,
        rank_customers,
        rank_cities,
        to_long_identity,
        to_long_some_cities,
        to_long_text,
        clean_temperature,
        clean_temperature_blank,
        clean_pressure,
        clean_humidity,
        clean_descriptions,
        clean_city_rows,
        geo_lookup,
        geo_lookup_within,
        clean_city_dimension,
        ingest_long,
        csv_headers_differ,
        roundtrip_csv,
        roundtrip_parquet,
        roundtrip_by_year,
        result_table,
        stream_clean,
        elapsed_records,
        elapsed_records_split,
        elapsed_of_users,
        elapsed_records_stream,
        latency_running,
        latency_report,
        latency_report_list,
        ingest_latency_by_user,
        ingest_latency_long_delays,
        run_stats,
        parity_q1,
        parity_q2,
        parity_q3,
        parity_repeated_keys,
        parity_by_checksums,
        parity_few_changes,
        parity_report,
    )
}
