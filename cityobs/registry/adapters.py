"""The driver's tables read as weather data.

A supplier's nation stands for the city of a line item and its region for the country. Readings
are whole numbers, so that their sums are exact and means agree in any order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityobs.operators.latency import millis

# Zone of each region, by region key.
ZONES = {
    0: "Africa/Johannesburg",
    1: "America/New_York",
    2: "Asia/Tokyo",
    3: "Europe/Rome",
    4: "Asia/Jerusalem",
}


# Zones of the dimension with many zones, by city number.
MANY_ZONES = (
    "Africa/Cairo", "Africa/Casablanca", "Africa/Johannesburg", "Africa/Lagos", "Africa/Nairobi", "Africa/Tunis",
    "Africa/Windhoek", "America/Anchorage", "America/Argentina/Buenos_Aires", "America/Asuncion", "America/Bogota",
    "America/Caracas", "America/Chicago", "America/Denver", "America/Guatemala", "America/Halifax", "America/Havana",
    "America/La_Paz", "America/Lima", "America/Los_Angeles", "America/Managua", "America/Mexico_City",
    "America/Montevideo", "America/New_York", "America/Panama", "America/Phoenix", "America/Port-au-Prince",
    "America/Puerto_Rico", "America/Santiago", "America/Sao_Paulo", "America/St_Johns", "America/Toronto",
    "America/Vancouver", "Asia/Almaty", "Asia/Amman", "Asia/Baghdad", "Asia/Baku", "Asia/Bangkok", "Asia/Beirut",
    "Asia/Damascus", "Asia/Dhaka", "Asia/Dubai", "Asia/Hong_Kong", "Asia/Jakarta", "Asia/Jerusalem", "Asia/Kabul",
    "Asia/Karachi", "Asia/Kathmandu", "Asia/Kolkata", "Asia/Manila", "Asia/Riyadh", "Asia/Seoul", "Asia/Shanghai",
    "Asia/Singapore", "Asia/Tashkent", "Asia/Tbilisi", "Asia/Tehran", "Asia/Tokyo", "Asia/Vladivostok",
    "Asia/Yerevan", "Atlantic/Azores", "Atlantic/Reykjavik", "Australia/Adelaide", "Australia/Brisbane",
    "Australia/Darwin", "Australia/Perth", "Australia/Sydney", "Europe/Athens", "Europe/Bucharest", "Europe/Dublin",
    "Europe/Helsinki", "Europe/Istanbul", "Europe/Kiev", "Europe/Lisbon", "Europe/London", "Europe/Moscow",
    "Europe/Rome", "Pacific/Auckland", "Pacific/Fiji", "Pacific/Honolulu", "Pacific/Tongatapu",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zone_of(key: Column) -> Column:
    zone = F.when(F.lit(False), F.lit(None).cast("string"))
    for region, name in ZONES.items():
        zone = zone.when(key == region, F.lit(name))
    return zone


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``City, Country, TimeUTC``."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("City"),
        F.col("r_name").alias("Country"),
        zone_of(F.col("r_regionkey")).alias("TimeUTC"),
    )


def reading_time() -> Column:
    hours = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("int")
    return F.col("l_shipdate") + F.make_dt_interval(hours=hours)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ts, City, temperature, pressure, humidity, description``, one row per line item."""
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            reading_time().alias("ts"),
            F.col("n_name").alias("City"),
            F.round(F.col("l_extendedprice") * 100).alias("temperature"),
            F.col("l_quantity").alias("pressure"),
            F.round(F.col("l_discount") * 100).alias("humidity"),
            F.when(F.col("l_returnflag") == "N", "sky is clear")
            .otherwise("overcast clouds")
            .alias("description"),
        )
    )


def supplier_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ts, City, temperature``, one row per line item; the supplier is the city."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    met = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    temperature = F.round(F.col("l_extendedprice") * 100).alias("temperature")
    return met.select(reading_time().alias("ts"), F.col("s_name").alias("City"), temperature)


def many_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as cities, in all of ``MANY_ZONES`` that their number allows."""
    zones = F.array(*map(F.lit, MANY_ZONES))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("City"),
        F.col("s_nationkey").cast("string").alias("Country"),
        F.get(zones, (F.col("s_suppkey") * 7 % len(MANY_ZONES)).cast("int")).alias("TimeUTC"),
    )


def measure_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two measures of line items and one of orders, which end some months earlier."""
    obs = observations(spark, sf_dir).select("ts", "City", "temperature", "pressure")
    return {"temperature": obs, "humidity": order_readings(spark, sf_dir), "pressure": obs}


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ts, City, humidity``, one row per order; the customer's nation is the city."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    hours = (F.col("o_orderkey") * 5 % 24).cast("int")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("o_orderdate") + F.make_dt_interval(hours=hours)).alias("ts"),
            F.col("n_name").alias("City"),
            (F.col("o_orderkey") * 31 % 101).cast("double").alias("humidity"),
        )
    )


#: Names of the three city columns of a raw table.
RAW_CITIES = ("Port_A", "St._B", "New_C")


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw wide table: a text time and three text cells per line item, some of them unfit.

    The first city gets the unfit cells, the others valid or empty ones.
    """
    n, quantity = F.col("l_linenumber"), F.col("l_quantity")
    time = F.when(n == 7, F.lit("not a date")).otherwise(reading_time().cast("string"))
    first = (
        F.when(n == 6, F.lit("abc"))
        .when(n == 5, F.lit(""))
        .when(n == 4, ((quantity + 250) * 1000).cast("string"))
        .when(n == 3, F.lit("99999"))
        .otherwise((quantity * 3 + 200).cast("string"))
    )
    second = F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(quantity.cast("string"))
    third = (quantity * 10 + 700).cast("string")
    cells = [c.alias(name) for c, name in zip((first, second, third), RAW_CITIES, strict=True)]
    return table(spark, sf_dir, "lineitem").select(time.alias("datetime"), *cells)


def raw_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.when(F.col("l_linenumber") == 7, F.lit("2001-13-45 25:00:00")).otherwise(
        reading_time().cast("string")
    )
    return table(spark, sf_dir, "lineitem").select(
        time.alias("datetime"),
        F.col("l_returnflag").alias("Port_A"),
        F.when(F.col("l_linestatus") == "O", F.lit("sky is clear")).alias("New_C"),
    )


def raw_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as cities; some coordinates lie outside the globe."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("City"),
        ((key * 37) % 1901 / 10 - 95).alias("Latitude"),
        ((key * 53) % 3701 / 10 - 185).alias("Longitude"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as known places; a third of them crowd one small area."""
    key = F.col("c_custkey")
    crowded = F.col("c_nationkey") < 8
    latitude = F.when(crowded, 40 + (key * 71) % 1009 / 100000).otherwise((key * 71) % 1777 / 10 - 88.85)
    longitude = F.when(crowded, 9 + (key * 43) % 997 / 100000).otherwise((key * 43) % 3583 / 10 - 179.15)
    return table(spark, sf_dir, "customer").select(
        latitude.alias("Latitude"),
        longitude.alias("Longitude"),
        F.col("c_name").alias("Country"),
        zone_of(F.col("c_nationkey") % 5).alias("TimeUTC"),
    )


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a file: received when it happened, delivered ``value`` seconds later, and
    delivered a second time when it was an error."""
    events = table(spark, sf_dir, "events")
    uuid = F.col("event_id").cast("string")
    start = millis(F.col("ts"))
    took = (F.col("value") * 1000).cast("long")
    none = F.lit(None).cast("string")
    received = events.select(
        F.lit("RECEIVE").alias("event_type"),
        uuid.alias("flow_uuid"),
        start.alias("event_time_ms"),
        F.lit(0).cast("long").alias("duration_ms"),
        none.alias("attr_uuid"),
        F.col("event_type").alias("filename"),
    )
    again = F.when(F.col("event_type") == "error", F.array(F.lit(0), F.lit(5000)))
    sent = events.withColumn("late", F.explode(F.coalesce(again, F.array(F.lit(0))))).select(
        F.lit("SEND").alias("event_type"),
        F.concat(F.lit("s"), uuid).alias("flow_uuid"),
        (start + F.col("late")).alias("event_time_ms"),
        took.alias("duration_ms"),
        uuid.alias("attr_uuid"),
        F.col("event_type").alias("filename"),
    )
    return received.unionByName(sent)


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user stands for a file: views are its arrivals, purchases its deliveries."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.when(kind == "view", "RECEIVE").when(kind == "purchase", "SEND").alias("event_type"),
        user.alias("flow_uuid"),
        millis(F.col("ts")).alias("event_time_ms"),
        F.lit(0).cast("long").alias("duration_ms"),
        user.alias("attr_uuid"),
        user.alias("filename"),
    )


def delayed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a file that is delivered 30 days and up to 2 ms later."""
    events = table(spark, sf_dir, "events")
    uuid, start = F.col("event_id").cast("string"), millis(F.col("ts"))
    sides = {
        "RECEIVE": (uuid, start, F.lit(None).cast("string")),
        "SEND": (F.lit("sent"), start + 30 * 86_400_000 + F.col("event_id") % 3, uuid),
    }
    parts = [
        events.select(
            F.lit(kind).alias("event_type"),
            flow.alias("flow_uuid"),
            at.alias("event_time_ms"),
            F.lit(0).cast("long").alias("duration_ms"),
            attr.alias("attr_uuid"),
            F.col("event_type").alias("filename"),
        )
        for kind, (flow, at, attr) in sides.items()
    ]
    return parts[0].unionByName(parts[1])


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed runs: the kind is the query, the hour of day the number of the run."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("query"),
        F.lit("parquet").alias("format"),
        F.lit("direct").alias("variant"),
        (F.hour("ts") + 1).alias("run"),
        F.col("value").alias("seconds"),
    )
