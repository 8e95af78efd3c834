"""Station tables: from journey rows, or from the JSON station feed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk import schemas
from velorisk.functions.geo import in_box
from velorisk.session import materialise


def stations_from_journeys(journeys: DataFrame) -> DataFrame:
    """Every station met in the journeys, at its first appearance.

    Newest file first, starts before ends, then by rental id. Rows without an
    id or a coordinate are passed over; the area filter applies to the row kept.
    Journeys collapse to one row per file, role and spelling before the first
    appearance is picked, so a station in a third of all journeys costs no more
    than any other.
    """
    number = F.regexp_extract("source_file", r"^(\d+)JourneyDataExtract", 1).try_cast("bigint")
    age = -F.coalesce(number, F.lit(0).cast("bigint"))

    def side(prefix: str, role: int) -> DataFrame:
        return journeys.select(
            F.col(f"{prefix}_station_id").try_cast("bigint").alias("station_id"),
            "source_file",
            F.lit(role).alias("role"),
            F.col(f"{prefix}_station_name").alias("station_name"),
            F.col(f"{prefix}_lon").alias("longitude"),
            F.col(f"{prefix}_lat").alias("latitude"),
            "rental_id",
        )

    met = (
        side("start", 0)
        .unionByName(side("end", 1))
        .dropna(subset=["station_id", "longitude", "latitude"])
        .groupBy("station_id", "source_file", "role", "station_name", "longitude", "latitude")
        .agg(F.min("rental_id").alias("rental_id"))
    )
    seen = F.struct(age.alias("age"), "source_file", "role", "rental_id", "station_name", "longitude", "latitude")
    return (
        met.groupBy("station_id")
        .agg(F.min(seen).alias("first"))
        .select("station_id", "first.station_name", "first.longitude", "first.latitude")
        .where(in_box(F.col("longitude"), F.col("latitude")))
    )


def parse_station_feed(feed: DataFrame) -> DataFrame:
    """``BikePoints_1`` is station 1; an id without trailing digits is dropped."""
    number = F.regexp_extract("id", r"(\d+)$", 1).try_cast("bigint")
    return feed.select(
        number.alias("station_id"),
        F.trim("commonName").alias("station_name"),
        F.coalesce("lon", F.lit(0.0)).alias("longitude"),
        F.coalesce("lat", F.lit(0.0)).alias("latitude"),
    ).where("station_id IS NOT NULL")


def read_station_feed(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A JSON array of stations or, without ``multi_line``, one JSON object per line, which Spark can split."""
    feed = spark.read.schema(schemas.STATION_FEED).option("multiLine", multi_line).json(path)
    return parse_station_feed(feed)


def stations_or_feed(stations: DataFrame, feed: DataFrame) -> DataFrame:
    """The stations met in the journeys or, if there are none, those of the feed.

    The stations are stored, one row each, so the journeys behind them are read once.
    """
    met = materialise(stations, "stations-met")
    return feed if met.isEmpty() else met
