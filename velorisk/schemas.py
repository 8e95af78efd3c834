"""Column types of the raw tables and the header spellings of the feeds."""

from pyspark.sql import types as T

# Names and types of the raw columns.
JOURNEYS = T.StructType(
    [
        T.StructField("rental_id", T.LongType()),
        T.StructField("bike_id", T.StringType()),
        T.StructField("bike_model", T.StringType()),
        T.StructField("start_date", T.TimestampType()),
        T.StructField("end_date", T.TimestampType()),
        T.StructField("start_station_id", T.DoubleType()),
        T.StructField("start_station_name", T.StringType()),
        T.StructField("start_lon", T.DoubleType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("end_station_id", T.DoubleType()),
        T.StructField("end_station_name", T.StringType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("duration_text", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ]
)

STATION_FEED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("commonName", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ]
)

BOROUGHS = T.StructType(
    [
        T.StructField("borough_code", T.StringType()),
        T.StructField("borough_name", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

# Header spelling in a journey file -> column name. Three vintages:
# title case (before 2025), snake case, and July 2025 onwards. Other headers are
# lower-cased with spaces turned into underscores.
JOURNEY_HEADERS = {
    "Rental Id": "rental_id",
    "Duration": "duration_seconds",
    "Bike Id": "bike_id",
    "End Date": "end_date",
    "EndStation Id": "end_station_id",
    "EndStation Name": "end_station_name",
    "EndStation Longitude": "end_lon",
    "EndStation Latitude": "end_lat",
    "Start Date": "start_date",
    "StartStation Id": "start_station_id",
    "StartStation Name": "start_station_name",
    "StartStation Longitude": "start_lon",
    "StartStation Latitude": "start_lat",
    "Bike model": "bike_model",
    "duration": "duration_seconds",
    "start_station_longitude": "start_lon",
    "start_station_latitude": "start_lat",
    "end_station_longitude": "end_lon",
    "end_station_latitude": "end_lat",
    "Number": "rental_id",
    "Start date": "start_date",
    "Start station": "start_station_name",
    "Start station number": "start_station_id",
    "End date": "end_date",
    "End station": "end_station_name",
    "End station number": "end_station_id",
    "Bike number": "bike_id",
    "Total duration": "duration_text",
    "Total duration (ms)": "duration_ms",
}

# Columns that a journey file must have.
REQUIRED_JOURNEY_COLUMNS = {
    "rental_id",
    "duration_seconds",
    "bike_id",
    "start_date",
    "start_station_id",
    "start_station_name",
    "end_date",
    "end_station_id",
    "end_station_name",
}

# New name of a collision column and the older names that stand in for it, best first.
COLLISION_RENAMES = [
    ("collision_index", ["accident_reference", "accident_index"]),
    ("collision_severity", ["accident_severity"]),
    ("collision_year", ["accident_year"]),
]
