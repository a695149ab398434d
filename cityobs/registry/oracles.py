"""The registered queries in SQL, for DuckDB over the same tables."""

from __future__ import annotations

from cityobs.registry.adapters import MANY_ZONES, ZONES

_ZONE_CASES = " ".join(f"WHEN {key} THEN '{name}'" for key, name in ZONES.items())

_READING_TIME = "l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER))"

_BASE = f"""
WITH dim AS (
  SELECT n_name AS City, r_name AS Country, CASE r_regionkey {_ZONE_CASES} END AS TimeUTC
  FROM nation JOIN region ON n_regionkey = r_regionkey
), obs AS (
  SELECT {_READING_TIME} AS ts, n_name AS City,
         round(l_extendedprice * 100) AS temperature, l_quantity AS pressure,
         round(l_discount * 100) AS humidity,
         CASE WHEN l_returnflag = 'N' THEN 'sky is clear' ELSE 'overcast clouds' END AS description
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), loc AS (
  SELECT obs.*, Country, TimeUTC, timezone(TimeUTC, timezone('UTC', ts)) AS local_ts
  FROM obs JOIN dim USING (City)
)"""


def _sunny(source: str) -> str:
    return f"""{_BASE}, days AS (
  SELECT City, year(local_ts) AS y, month(local_ts) AS m, day(local_ts) AS d, count(*) AS n
  FROM {source} WHERE month(local_ts) BETWEEN 3 AND 5 AND description = 'sky is clear'
  GROUP BY ALL HAVING count(*) > 0
), months AS (SELECT City, y, m FROM days GROUP BY ALL HAVING count(*) >= 8)
SELECT CAST(y AS INTEGER) AS "Year", City FROM months GROUP BY ALL HAVING count(*) = 3"""


_HOURLY_TEXT = """(
  SELECT replace(City, '_', ' ') AS City, TimeUTC, ts, local_ts, max(description) AS description
  FROM loc GROUP BY ALL)"""


def _stat(measure: str, value: str, rounded: bool = False) -> str:
    def exact(e: str) -> str:
        return f"round({e}, 4)" if rounded else e

    return f"""{exact(f"max({value})")} AS max_{measure}, {exact(f"min({value})")} AS min_{measure},
  {exact(f"avg({value})")} AS avg_{measure},
  round(stddev_samp({value}), 4) AS std_samp_{measure},
  round(stddev_pop({value}), 4) AS std_pop_{measure}"""


_MONTH_KEYS = 'CAST(year(local_ts) AS INTEGER) AS "Year", CAST(month(local_ts) AS INTEGER) AS "Month"'

_BY_TABLE = f"""{_BASE}, hum AS (
  SELECT o_orderdate + to_hours(CAST((o_orderkey * 5) % 24 AS INTEGER)) AS ts, n_name AS City,
    CAST((o_orderkey * 31) % 101 AS DOUBLE) AS humidity
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), humloc AS (
  SELECT humidity, Country, timezone(TimeUTC, timezone('UTC', ts)) AS local_ts FROM hum JOIN dim USING (City)
), items AS (
  SELECT {_MONTH_KEYS}, Country, {_stat("temperature", "temperature")}, {_stat("pressure", "pressure")}
  FROM loc GROUP BY ALL
), humid AS (
  SELECT {_MONTH_KEYS}, Country, {_stat("humidity", "humidity")} FROM humloc GROUP BY ALL
)"""

_STATS_OUTER = f'{_BY_TABLE} SELECT * FROM items FULL JOIN humid USING ("Year", "Month", Country)'

_STATS_INNER = f'{_BY_TABLE} SELECT * FROM items JOIN humid USING ("Year", "Month", Country)'

_HOURLY_MEANS = """(
  SELECT City, Country, local_ts, ts, avg(temperature) AS temperature, avg(pressure) AS pressure
  FROM loc GROUP BY ALL)"""

_STATS_WIDE = f"""{_BASE}
SELECT {_MONTH_KEYS}, Country, {_stat("temperature", "temperature", True)},
  {_stat("pressure", "pressure", True)}
FROM {_HOURLY_MEANS} GROUP BY ALL"""


_SUPPLIERS = f"""
WITH dim AS (
  SELECT s_suppkey, s_name AS City, CAST(s_nationkey AS VARCHAR) AS Country,
    list_extract({list(MANY_ZONES)}, CAST(s_suppkey * 7 % {len(MANY_ZONES)} AS BIGINT) + 1) AS TimeUTC FROM supplier
), loc AS (
  SELECT {_READING_TIME} AS ts, City, Country, TimeUTC, round(l_extendedprice * 100) AS temperature,
    timezone(TimeUTC, timezone('UTC', {_READING_TIME})) AS local_ts
  FROM lineitem JOIN dim ON l_suppkey = s_suppkey
)"""

_MANY_ZONES = f"""{_SUPPLIERS}
SELECT CAST(ts AS VARCHAR) AS ts, City, Country, TimeUTC, CAST(local_ts AS VARCHAR) AS local_ts,
  CAST(local_ts AS DATE) AS local_date, CAST(hour(local_ts) AS INTEGER) AS local_hour
FROM loc"""


def _swings(source: str, base: str = _BASE, last_hour: int = 15) -> str:
    return f"""{base}, readings AS (
  SELECT Country, City, CAST(year(local_ts) AS INTEGER) AS y, month(local_ts) AS m, temperature
  FROM {source}
  WHERE year(local_ts) IN (1999, 2000) AND hour(local_ts) BETWEEN 12 AND {last_hour}
    AND (month(local_ts) BETWEEN 1 AND 4 OR month(local_ts) BETWEEN 6 AND 9)
), swings AS (
  SELECT Country, City, y, abs(avg(temperature) FILTER (m <= 4) - avg(temperature) FILTER (m >= 6)) AS difference
  FROM readings GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Country, y ORDER BY difference DESC, City) AS place
  FROM swings WHERE difference IS NOT NULL
)"""


def _swing(
    source: str, city: str = "City", digits: int = 6, rerank: bool = False, base: str = _BASE, last_hour: int = 15
) -> str:
    place = (
        "row_number() OVER (PARTITION BY a.Country ORDER BY a.difference DESC, a.City)"
        if rerank
        else "a.place"
    )
    return f"""{_swings(source, base, last_hour)}
SELECT a.Country, replace(a.City, '_', '{"_" if city == "City" else " "}') AS City,
  round(a.difference, {digits}) AS difference,
  CAST(b.place AS INTEGER) AS rank_base, CAST({place} AS INTEGER) AS rank_year
FROM ranked a JOIN ranked b ON a.Country = b.Country AND a.City = b.City
WHERE a.y = 2000 AND b.y = 1999 AND a.place <= 3"""


_LOCAL_TIME = f"""{_BASE}
SELECT CAST(ts AS VARCHAR) AS ts, City, Country, TimeUTC, CAST(local_ts AS VARCHAR) AS local_ts,
  CAST(local_ts AS DATE) AS local_date, CAST(hour(local_ts) AS INTEGER) AS local_hour
FROM loc"""

_RAW = f"""
WITH raw AS (
  SELECT l_linenumber AS n, {_READING_TIME} AS ts, l_quantity AS q,
    l_returnflag AS flag, l_linestatus AS status
  FROM lineitem
)"""

_FIRST = """CASE WHEN n = 6 THEN NULL WHEN n = 5 THEN NULL WHEN n = 4 THEN (q + 250) * 1000
  WHEN n = 3 THEN 99999.0 ELSE q * 3 + 200 END"""
_SECOND = "CASE WHEN flag <> 'A' THEN q END"
_THIRD = "q * 10 + 700"


def _valid(value: str, low: float, high: float, lost_point: bool) -> str:
    if lost_point:
        value = f"CASE WHEN ({value}) > 100000 THEN ({value}) / 1000 ELSE ({value}) END"
    return f"CASE WHEN ({value}) BETWEEN {low} AND {high} THEN ({value}) END"


def _cleaned(low: float, high: float, lost_point: bool = False, blank: bool = False) -> str:
    cells = ", ".join(
        f'CAST({_valid(v, low, high, lost_point)} AS DOUBLE) AS "{name}"'
        for v, name in ((_FIRST, "Port_A"), (_SECOND, "St._B"), (_THIRD, "New_C"))
    )
    kept = "n <> 7" if blank else "n <> 7 AND n <> 6"
    return f"{_RAW} SELECT CAST(ts AS VARCHAR) AS datetime, {cells} FROM raw WHERE {kept}"


_CLEAN_TEMPERATURE = _cleaned(184, 343, lost_point=True)

_INGEST_LONG = f"""WITH cleaned AS ({_CLEAN_TEMPERATURE}), formats AS (
  SELECT unnest(['csv', 'parquet']) AS format)
SELECT datetime AS ts, 'Port A' AS City, "Port_A" AS temperature, format
FROM cleaned, formats WHERE "Port_A" IS NOT NULL
UNION ALL SELECT datetime, 'St. B', "St._B", format FROM cleaned, formats WHERE "St._B" IS NOT NULL
UNION ALL SELECT datetime, 'New C', "New_C", format FROM cleaned, formats WHERE "New_C" IS NOT NULL"""

_OBS_TEXT_TIME = (
    f"{_BASE} SELECT CAST(ts AS VARCHAR) AS ts, City, temperature, pressure, humidity, description FROM obs"
)

_CITIES = """
cities AS (
  SELECT s_name AS City, CAST((s_suppkey * 37) % 1901 / 10.0::DOUBLE - 95 AS DOUBLE) AS Latitude,
    CAST((s_suppkey * 53) % 3701 / 10.0::DOUBLE - 185 AS DOUBLE) AS Longitude FROM supplier
)"""

_VALID_CITY = "Latitude BETWEEN -90 AND 90 AND Longitude BETWEEN -180 AND 180"

_PLACES = f"""
places AS (
  SELECT
    CASE WHEN c_nationkey < 8 THEN 40 + (c_custkey * 71) % 1009 / 100000.0::DOUBLE
      ELSE (c_custkey * 71) % 1777 / 10.0::DOUBLE - 88.85::DOUBLE END AS lat,
    CASE WHEN c_nationkey < 8 THEN 9 + (c_custkey * 43) % 997 / 100000.0::DOUBLE
      ELSE (c_custkey * 43) % 3583 / 10.0::DOUBLE - 179.15::DOUBLE END AS lon,
    c_name AS Country, CASE c_nationkey % 5 {_ZONE_CASES} END AS TimeUTC
  FROM customer
)"""

_VECTORS = ", ".join(
    f"""cos(radians({lat})) * cos(radians({lon})) AS {p}x, cos(radians({lat})) * sin(radians({lon})) AS {p}y,
  sin(radians({lat})) AS {p}z"""
    for p, lat, lon in (("c", "Latitude", "Longitude"), ("p", "lat", "lon"))
)

_NEAREST = f"""
pairs AS (
  SELECT City, Country, TimeUTC, {_VECTORS} FROM cities, places
  WHERE {_VALID_CITY} AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
), measured AS (
  SELECT City, Country, TimeUTC,
    (cx - px) * (cx - px) + (cy - py) * (cy - py) + (cz - pz) * (cz - pz) AS square FROM pairs
), nearest AS (
  SELECT City, Country, TimeUTC, 2 * 6371.0::DOUBLE * asin(least(sqrt(square) / 2, 1)) AS km
  FROM measured
  QUALIFY row_number() OVER (PARTITION BY City ORDER BY square, Country, TimeUTC) = 1
)"""


def _geo(within: str) -> str:
    return f"""WITH {_CITIES}, {_PLACES}, {_NEAREST}
SELECT c.City, Latitude, Longitude, Country, TimeUTC, round(km, 3) AS distance_km
FROM cities c LEFT JOIN (SELECT * FROM nearest WHERE {within}) USING (City)"""


_ELAPSED = """
WITH deliveries AS (
  SELECT event_id, event_type, ts, unnest(CASE WHEN event_type = 'error' THEN [0, 5000] ELSE [0] END) AS late,
    CAST(trunc(value * 1000) AS BIGINT) AS took FROM events
)
SELECT event_type AS filename, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
  CAST(late + took AS DOUBLE) / 1000 AS elapsed FROM deliveries"""


def _rows(a: int, b: int) -> str:
    return f"CAST({a} AS BIGINT) AS rows_a, CAST({b} AS BIGINT) AS rows_b"


def _placed(sql: str, columns: str, order: str) -> str:
    return f"SELECT {columns}, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place FROM ({sql})"


_HEADERS = f"""{_RAW}, cells AS (
  SELECT CAST(ts AS VARCHAR) AS ts, CAST({_valid(_FIRST, 184, 343, True)} AS DOUBLE) AS a,
    CAST({_valid(_SECOND, 184, 343, True)} AS DOUBLE) AS b, CAST({_valid(_THIRD, 184, 343, True)} AS DOUBLE) AS c,
    flag <> 'A' AS filled FROM raw WHERE n <> 7 AND n <> 6
), ways AS (SELECT unnest(['batch', 'stream']) AS way)
SELECT ts, 'Port A' AS City, a AS temperature, way FROM cells, ways WHERE a IS NOT NULL
UNION ALL SELECT ts, 'St. B', b, way FROM cells, ways WHERE b IS NOT NULL
UNION ALL SELECT ts, 'New C', c, way FROM cells, ways WHERE c IS NOT NULL AND NOT filled"""

_CHANGED = """
WITH items AS (SELECT l_orderkey, l_quantity AS q FROM lineitem),
  a AS (SELECT l_orderkey, q, count(*) AS n FROM items GROUP BY ALL),
  b AS (SELECT l_orderkey, CASE WHEN q = 49 THEN 50.0 ELSE q END AS q, count(*) AS n FROM items GROUP BY ALL),
  differ AS (
    SELECT l_orderkey, q, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM a FULL JOIN b USING (l_orderkey, q)
    WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)),
  left_a AS (
    SELECT l_orderkey, q, row_number() OVER (PARTITION BY l_orderkey ORDER BY q) AS k
    FROM (SELECT l_orderkey, q, unnest(range(na - nb)) FROM differ WHERE na > nb)),
  left_b AS (
    SELECT l_orderkey, q, row_number() OVER (PARTITION BY l_orderkey ORDER BY q) AS k
    FROM (SELECT l_orderkey, q, unnest(range(nb - na)) FROM differ WHERE nb > na)),
  whole AS (SELECT l_orderkey, count(*) AS n FROM items GROUP BY 1)
SELECT l_orderkey, n AS rows_a, n AS rows_b, left_a.q AS l_quantity_a, left_b.q AS l_quantity_b
FROM left_a FULL JOIN left_b USING (l_orderkey, k) JOIN whole USING (l_orderkey)"""

ORACLES: dict[str, str] = {
    "q3_swing": _swing("loc"),
    "q3_swing_joined": _swing("loc"),
    "q3_swing_rerank": _swing("loc", rerank=True, base=_SUPPLIERS, last_hour=12),
    "q3_swing_large_dimension": _swing("loc"),
    "q3_swing_wide": _swing(_HOURLY_MEANS, city="spaced", digits=4),
    "q1_sunny": _sunny("loc"),
    "q1_sunny_cascade": _sunny("loc"),
    "q1_sunny_wide": _sunny(_HOURLY_TEXT),
    "q2_stats_outer": _STATS_OUTER,
    "q2_stats_inner": _STATS_INNER,
    "q2_stats_joined_outer": _STATS_OUTER,
    "q2_stats_joined_inner": _STATS_INNER,
    "q2_stats_rollup": _STATS_OUTER,
    "q2_stats_wide": _STATS_WIDE,
    "local_time": _LOCAL_TIME,
    "local_time_large_dimension": _LOCAL_TIME,
    "clear_hours": f"""{_BASE}
SELECT City, CAST(local_ts AS DATE) AS local_date, count(*) AS n FROM loc
WHERE month(local_ts) BETWEEN 3 AND 5 AND description = 'sky is clear'
GROUP BY ALL HAVING count(*) > 1""",
    "measure_stats_pressure": f"""{_BASE}
SELECT {_MONTH_KEYS}, Country, {_stat("pressure", "pressure")} FROM loc GROUP BY ALL""",
    "season_means": f"""{_swings("loc")}
SELECT Country, City, y AS year, CASE WHEN m <= 4 THEN 'jan-apr' ELSE 'jun-sep' END AS slot,
  avg(temperature) AS mean, count(*) AS n FROM readings GROUP BY ALL""",
    "yearly_swings": f"""{_swings("loc")}
SELECT Country, City, y AS year, round(difference, 6) AS difference FROM swings
WHERE difference IS NOT NULL""",
    "top3_per_country": """
SELECT c_nationkey, c_custkey, c_acctbal, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place
  FROM customer) WHERE place <= 3""",
    "rank_of_top3": """
SELECT c_nationkey, c_custkey, c_acctbal, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS pick
  FROM customer) WHERE pick <= 3""",
    "rank_customers": """
SELECT c_nationkey, c_custkey, c_acctbal,
  CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS place FROM customer""",
    "rank_cities": f"""{_swings("loc")}
SELECT Country, City, y AS year, CAST(place AS INTEGER) AS place FROM ranked WHERE y = 1999""",
    "to_long_identity": f"""{_BASE}
SELECT CAST(ts AS VARCHAR) AS ts, replace(City, '_', ' ') AS City,
  round(avg(temperature), 4) AS temperature FROM obs GROUP BY ALL""",
    "to_long_some_cities": f"""{_BASE}
SELECT CAST(ts AS VARCHAR) AS ts, replace(City, '_', ' ') AS City, round(avg(pressure), 4) AS pressure
FROM obs WHERE City IN ('NATION_3', 'NATION_12') GROUP BY ALL""",
    "to_long_text": f"""{_RAW}
SELECT CAST(ts AS VARCHAR) AS ts, 'Port A' AS City, flag AS description FROM raw WHERE n <> 7
UNION ALL
SELECT CAST(ts AS VARCHAR), 'New C', 'sky is clear' FROM raw WHERE n <> 7 AND status = 'O'""",
    "clean_temperature": _CLEAN_TEMPERATURE,
    "clean_temperature_blank": _cleaned(184, 343, lost_point=True, blank=True),
    "clean_pressure": _cleaned(870, 1085.6),
    "clean_humidity": _cleaned(0, 100),
    "clean_descriptions": f"""{_RAW}
SELECT CAST(ts AS VARCHAR) AS datetime, flag AS "Port_A",
  CASE WHEN status = 'O' THEN 'sky is clear' END AS "New_C" FROM raw WHERE n <> 7""",
    "clean_city_rows": f"WITH {_CITIES} SELECT * FROM cities WHERE {_VALID_CITY}",
    "geo_lookup": _geo("true"),
    "geo_lookup_within": _geo("km <= 300"),
    "clean_city_dimension": f"""WITH {_CITIES}, {_PLACES}, {_NEAREST}
SELECT City, Latitude, Longitude, Country, TimeUTC FROM cities JOIN nearest USING (City)""",
    "ingest_long": _INGEST_LONG,
    "roundtrip_csv": _OBS_TEXT_TIME,
    "roundtrip_parquet": _OBS_TEXT_TIME,
    "roundtrip_by_year": f"{_OBS_TEXT_TIME} WHERE year(ts) = 1999",
    "result_table": f'SELECT "Year", City, CAST(2 AS BIGINT) AS variants FROM ({_sunny("loc")})',
    "stream_clean": _CLEAN_TEMPERATURE,
    "elapsed_records": _ELAPSED,
    "elapsed_records_split": _ELAPSED,
    "elapsed_records_stream": _ELAPSED,
    "latency_running": f"""
SELECT filename, round(avg(elapsed), 4) AS avg, round(stddev_pop(elapsed), 4) AS stddev,
  count(*) AS count FROM ({_ELAPSED}) GROUP BY ALL""",
    "latency_report": f"""
SELECT filename, round(avg(elapsed), 4) AS avg, round(stddev_pop(elapsed), 4) AS stddev,
  count(*) AS count FROM ({_ELAPSED}) GROUP BY ALL""",
    "ingest_latency_by_user": """
SELECT CAST(v.user_id AS VARCHAR) AS filename, CAST(sum(elapsed) AS BIGINT) AS total_ms,
  round(stddev_pop(elapsed / 1000), 3) AS stddev, count(*) AS count
FROM (SELECT a.user_id, epoch_us(p.ts) // 1000 - epoch_us(a.ts) // 1000 AS elapsed
      FROM events a JOIN events p ON a.user_id = p.user_id
      WHERE a.event_type = 'view' AND p.event_type = 'purchase') v GROUP BY ALL""",
    "run_stats": """
SELECT event_type AS query, 'parquet' AS format, 'direct' AS variant,
  CAST(count(*) AS INTEGER) AS runs, round(avg(value), 4) AS avg, round(stddev_pop(value), 4) AS stddev
FROM events WHERE hour(ts) + 1 > 2 GROUP BY ALL""",
    "parity_q1": f"""SELECT *, {_rows(1, 0)} FROM ({_sunny("loc")}) WHERE "Year" % 2 = 0
UNION ALL
SELECT CAST("Year" + 100 AS INTEGER), City, {_rows(0, 1)} FROM ({_sunny("loc")}) WHERE "Year" % 2 = 0""",
    "parity_q2": f'SELECT "Year", "Month", Country, {_rows(1, 1)} FROM ({_STATS_OUTER}) WHERE "Month" = 6 AND avg_pressure IS NOT NULL',
    "parity_q3": f'SELECT Country, City, {_rows(1, 1)} FROM ({_swing("loc")}) WHERE rank_year = 1',
    "q1_sunny_order": _placed(_sunny("loc"), "*", '"Year", City'),
    "q2_stats_order": _placed(_STATS_OUTER, '"Year", "Month", Country', '"Year", "Month", Country'),
    "q3_swing_order": _placed(_swing("loc"), "*", "Country DESC, difference DESC, City"),
    "local_time_zoned": _LOCAL_TIME,
    "local_time_many_zones": _MANY_ZONES,
    "csv_headers_differ": _HEADERS,
    "latency_report_list": f"""
SELECT filename, round(avg(elapsed), 4) AS avg, round(stddev_pop(elapsed), 4) AS stddev,
  count(*) AS count FROM ({_ELAPSED}) GROUP BY ALL""",
    "elapsed_of_users": """
SELECT CAST(a.user_id AS VARCHAR) AS filename, count(*) AS count,
  CAST(sum(epoch_us(p.ts) // 1000 - epoch_us(a.ts) // 1000) AS BIGINT) AS total_ms
FROM events a JOIN events p ON a.user_id = p.user_id
WHERE a.event_type = 'view' AND p.event_type = 'purchase' GROUP BY ALL""",
    "ingest_latency_long_delays": """
SELECT event_type AS filename, count(*) AS count, round(2592000 + avg(event_id % 3) / 1000, 6) AS avg,
  round(stddev_pop((event_id % 3) / 1000), 6) AS stddev FROM events GROUP BY ALL""",
    "parity_repeated_keys": _CHANGED,
    "parity_by_checksums": _CHANGED,
    "parity_few_changes": f"""
SELECT o_orderkey, o_custkey, {_rows(1, 1)}, round(o_totalprice, 2) AS price FROM orders WHERE o_totalprice < 2000""",
    "parity_report": f"""{_BASE}, a AS (
  SELECT City, CAST(ts AS DATE) AS day, avg(pressure) AS mean FROM obs GROUP BY ALL
), b AS (
  SELECT City, CAST(ts AS DATE) AS day, avg(pressure) AS mean FROM obs
  WHERE description = 'sky is clear' GROUP BY ALL
)
SELECT City, day, CAST(a.mean IS NOT NULL AS BIGINT) AS rows_a, CAST(b.mean IS NOT NULL AS BIGINT) AS rows_b,
  a.mean AS mean_a, b.mean AS mean_b
FROM a FULL JOIN b USING (City, day)
WHERE a.mean IS NULL OR b.mean IS NULL OR abs(a.mean - b.mean) > 1.5""",
}
