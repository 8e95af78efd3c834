"""Raw tables to clean, typed ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions.casts import clean_text, round_half_up, safe_cast, to_long, to_number
from velorisk.functions.geo import in_box
from velorisk.functions.labels import day_type, period_of_day, severity_label, severity_weight, weekday_name

ACCIDENT_COLUMNS = [
    "accident_index",
    "accident_date",
    "year",
    "hour_of_day",
    "day_of_week",
    "accident_severity",
    "severity_label",
    "number_of_casualties",
    "number_of_vehicles",
    "road_type",
    "speed_limit",
    "light_conditions",
    "weather_conditions",
    "longitude",
    "latitude",
    "time_of_day_period",
    "weekday_name",
    "day_type",
    "severity_weight",
]


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def whole_seconds(df: DataFrame) -> Column:
    """Duration in whole seconds: seconds if given, else milliseconds, rounded half up."""
    seconds = to_number(_optional(df, "duration_seconds"))
    from_ms = to_number(_optional(df, "duration_ms")) / F.lit(1000.0)
    return round_half_up(F.coalesce(seconds, from_ms))


def is_valid_journey(seconds: Column) -> Column:
    return (
        F.col("rental_id").isNotNull()
        & F.col("start_station_id").isNotNull()
        & F.col("end_station_id").isNotNull()
        & (F.col("start_station_id") != F.col("end_station_id"))
        & seconds.between(C.MIN_DURATION_S, C.MAX_DURATION_S)
    )


def stage_journeys(raw: DataFrame) -> DataFrame:
    seconds = whole_seconds(raw)
    return raw.where(is_valid_journey(seconds)).select(
        to_long(F.col("rental_id")).alias("rental_id"),
        seconds.alias("duration_seconds"),
        round_half_up(seconds / F.lit(60.0), 1).alias("duration_minutes"),
        safe_cast(_optional(raw, "bike_id"), "string").alias("bike_id"),
        safe_cast(_optional(raw, "bike_model"), "string").alias("bike_model"),
        safe_cast(F.col("start_date"), "timestamp").alias("start_at"),
        to_long(F.col("start_station_id")).alias("start_station_id"),
        clean_text(F.col("start_station_name")).alias("start_station_name"),
        safe_cast(F.col("end_date"), "timestamp").alias("end_at"),
        to_long(F.col("end_station_id")).alias("end_station_id"),
        clean_text(F.col("end_station_name")).alias("end_station_name"),
        _optional(raw, "source_file").alias("source_file"),
    )


def first_per_station(stations: DataFrame) -> DataFrame:
    """One row per station id: the least by name, longitude and latitude."""
    return (
        stations.groupBy("station_id")
        .agg(F.min(F.struct("station_name", "longitude", "latitude")).alias("first"))
        .select("station_id", "first.*")
    )


def stage_stations(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        to_long(F.col("station_id")).alias("station_id"),
        clean_text(F.col("station_name")).alias("station_name"),
        to_number(F.col("longitude")).alias("longitude"),
        to_number(F.col("latitude")).alias("latitude"),
    )
    valid = typed.where(F.col("station_id").isNotNull() & in_box(F.col("longitude"), F.col("latitude")))
    return first_per_station(valid)


def has_valid_point() -> Column:
    """Numeric coordinates inside the area of interest; a null fails the range test."""
    return in_box(to_number(F.col("longitude")), to_number(F.col("latitude")))


def stage_accidents(raw: DataFrame) -> DataFrame:
    """Current column names back to the long-standing ones, whole numbers, and the derived labels."""
    return _typed_accidents(raw.where(F.col("collision_index").isNotNull() & has_valid_point()))


def _typed_accidents(raw: DataFrame) -> DataFrame:

    def whole(name: str) -> Column:
        return to_long(_optional(raw, name))

    severity, day, hour = whole("collision_severity"), whole("day_of_week"), whole("hour_of_day")
    return (
        raw.select(
            F.col("collision_index").alias("accident_index"),
            safe_cast(_optional(raw, "date"), "date").alias("accident_date"),
            F.coalesce(whole("collision_year"), whole("year")).alias("year"),
            hour.alias("hour_of_day"),
            day.alias("day_of_week"),
            severity.alias("accident_severity"),
            severity_label(severity).alias("severity_label"),
            *[
                whole(name).alias(name)
                for name in (
                    "number_of_casualties",
                    "number_of_vehicles",
                    "road_type",
                    "speed_limit",
                    "light_conditions",
                    "weather_conditions",
                )
            ],
            to_number(F.col("longitude")).alias("longitude"),
            to_number(F.col("latitude")).alias("latitude"),
            period_of_day(hour).alias("time_of_day_period"),
            weekday_name(day).alias("weekday_name"),
            day_type(day).alias("day_type"),
            severity_weight(severity).alias("severity_weight"),
        )
        .select(*ACCIDENT_COLUMNS)
    )


def accidents_geo(raw: DataFrame) -> DataFrame:
    """Accident points with labels; unlike staging it keeps points without an index."""
    typed = _typed_accidents(raw.where(has_valid_point()))
    return typed.withColumnRenamed("accident_date", "date").drop(
        "time_of_day_period", "weekday_name", "day_type", "severity_weight"
    )


def stations_geo(raw: DataFrame) -> DataFrame:
    """Stations that have coordinates, wherever they are."""
    return raw.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).select(
        to_long(F.col("station_id")).alias("station_id"),
        F.col("station_name"),
        to_number(F.col("longitude")).alias("longitude"),
        to_number(F.col("latitude")).alias("latitude"),
    )
