"""Raw road-safety tables derived from an order/line-item schema by integer arithmetic.

Gives the registered queries and the bench realistic inputs at any scale: the
columns are computed by Spark from ``supplier``, ``orders`` and ``lineitem``.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_JOURNEYS = 80  # pairs are spread evenly here; this leaves a few hundred corridors at scale 0.01


def stations(spark: SparkSession, folder: str, lattice: bool = False) -> DataFrame:
    """Suppliers as stations: scattered, or on a lattice where most pairs are neighbours."""
    key = F.col("s_suppkey")
    if lattice:
        lon = F.lit(-0.20) + (key % 50) * F.lit(0.004)
        lat = F.lit(51.46) + F.floor(key / 50) * F.lit(0.004)
    else:
        lon = F.lit(-0.20) + ((key * 7919) % 1501) / F.lit(10000.0)
        lat = F.lit(51.46) + ((key * 104729) % 901) / F.lit(10000.0)
    return spark.read.parquet(f"{folder}/supplier.parquet").select(
        key.alias("station_id"), F.col("s_name").alias("station_name"), lon.alias("longitude"), lat.alias("latitude")
    )


def accidents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as collisions, with some points outside the area and some null ones."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    lon = (
        F.when(order % 97 == 0, F.lit(2.0))
        .when(order % 101 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(-0.20) + ((order * 31 + customer * 17) % 1501) / F.lit(10000.0))
    )
    severity = F.when(order % 53 == 0, F.lit(1)).when(order % 6 == 0, F.lit(2)).otherwise(F.lit(3))
    hour = F.when(order % 211 == 0, F.lit(None)).otherwise((order * 7 + customer) % 24)
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        order.cast("string").alias("collision_index"),
        day.alias("date"),
        F.year(day).cast("bigint").alias("collision_year"),
        F.year(day).cast("bigint").alias("year"),
        hour.cast("bigint").alias("hour_of_day"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        severity.cast("bigint").alias("collision_severity"),
        (F.lit(1) + customer % 3).cast("bigint").alias("number_of_casualties"),
        (F.lit(1) + customer % 2).cast("bigint").alias("number_of_vehicles"),
        (order % 7).cast("bigint").alias("road_type"),
        (F.lit(20) + (order % 5) * 10).cast("bigint").alias("speed_limit"),
        (order % 4).cast("bigint").alias("light_conditions"),
        (order % 9).cast("bigint").alias("weather_conditions"),
        lon.alias("longitude"),
        (F.lit(51.46) + ((order * 13 + customer * 29) % 901) / F.lit(10000.0)).alias("latitude"),
    )


def journeys(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as journeys between suppliers with near keys."""
    near, far = F.col("l_suppkey"), F.col("l_suppkey") + F.col("l_partkey") % 6
    even = F.col("l_linenumber") % 2 == 0
    start, end = F.when(even, far).otherwise(near), F.when(even, near).otherwise(far)
    begin = F.col("l_shipdate").cast("timestamp")

    def name(station):
        return F.concat(F.lit(" Supplier#"), F.lpad(station.cast("string"), 9, "0"), F.lit(" "))

    return spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("rental_id"),
        F.col("l_partkey").cast("string").alias("bike_id"),
        F.col("l_returnflag").alias("bike_model"),
        begin.alias("start_date"),
        F.timestamp_add("SECOND", F.floor(F.col("l_extendedprice") + F.lit(0.5)), begin).alias("end_date"),
        start.cast("double").alias("start_station_id"),
        name(start).alias("start_station_name"),
        end.cast("double").alias("end_station_id"),
        name(end).alias("end_station_name"),
        F.col("l_extendedprice").alias("duration_seconds"),
        F.lit(None).cast("double").alias("duration_ms"),
        F.concat(F.col("l_linestatus"), F.lit("JourneyDataExtract.csv")).alias("source_file"),
    )


@dataclass(frozen=True)
class RawTables:
    stations: DataFrame
    accidents: DataFrame
    journeys: DataFrame


def raw_tables(spark: SparkSession, folder: str, lattice: bool = False) -> RawTables:
    return RawTables(stations(spark, folder, lattice), accidents(spark, folder), journeys(spark, folder))
