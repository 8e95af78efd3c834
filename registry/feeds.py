"""Feed files that Spark writes from the given tables, for the queries on file readers."""

import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk import derived
from velorisk.session import scratch_path


def with_coordinates(journeys: DataFrame) -> DataFrame:
    def lon(key):
        return F.lit(-0.20) + ((key * 7919) % 1501) / F.lit(10000.0)

    def lat(key):
        return F.lit(51.46) + ((key * 104729) % 901) / F.lit(10000.0)

    start, end = F.col("start_station_id").cast("bigint"), F.col("end_station_id").cast("bigint")
    outside = F.col("rental_id") % 97 == 0
    return journeys.withColumns(
        {
            "start_lon": F.when(outside, F.lit(2.0)).otherwise(lon(start)),
            "start_lat": lat(start),
            "end_lon": lon(end),
            "end_lat": lat(end),
        }
    )


def journey_feeds(spark: SparkSession, folder: str) -> list[str]:
    """Journeys as CSV in three header vintages, one folder each."""
    root = scratch_path(spark, "feeds")
    paths = []
    for number, part, _ in vintages(spark, folder):
        path = f"{root}/{number}JourneyDataExtract.csv"
        part.write.option("header", True).option("escape", '"').csv(path)
        paths.append(path)
    return paths


def named_journey_files(spark: SparkSession, folder: str) -> list[str]:
    """The same as four files a vintage, ``500JourneyDataExtract0.csv`` and so on, by the id's remainder."""
    root = scratch_path(spark, "named-feeds")
    system, place = fs.FileSystem.from_uri(root if ":" in root else f"file://{root}")
    paths = []
    for number, part, key in vintages(spark, folder):
        quarter = F.col(key) % 4
        # One file per quarter, written by the one task that gets its rows, as they come: a write by partition
        # columns would sort them first, and hold them in memory for it.
        dealt = part.where(quarter.between(0, 3)).repartitionById(4, quarter.cast("int"))
        dealt.write.option("header", True).option("escape", '"').csv(f"{root}/{number}")
        for file in sorted(system.get_file_info(fs.FileSelector(f"{place}/{number}")), key=lambda f: f.base_name):
            numbered = re.match(r"part-(\d+)-.*\.csv$", file.base_name)
            if numbered and _has_rows(system, file.path):
                name = f"{number}JourneyDataExtract{int(numbered[1])}.csv"
                system.create_dir(f"{place}/named")
                system.move(file.path, f"{place}/named/{name}")
                paths.append(f"{root}/named/{name}")
    return paths


def _has_rows(system: fs.FileSystem, path: str) -> bool:
    """Whether a line follows the header: the first task writes its file even without rows."""
    with system.open_input_stream(path) as file:
        return bool(file.read(4096).partition(b"\n")[2])


def folder_of(paths: list[str]) -> str:
    return paths[0].rpartition("/")[0]


def write_text(path: str, text: str) -> None:
    system, place = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    with system.open_output_stream(place) as file:
        file.write(text.encode())


def vintages(spark: SparkSession, folder: str) -> list[tuple[int, DataFrame, str]]:
    """Number, rows and id column of each header vintage.

    A third of the rental ids goes to each. Times are minutes in text, and one in
    13 is unreadable.
    """
    rows = with_coordinates(derived.journeys(spark, folder))

    def minute(column: str):
        return F.when(F.col("rental_id") % 13 == 0, F.lit("n/a")).otherwise(F.date_format(column, "yyyy-MM-dd HH:mm"))

    title = rows.where("rental_id % 3 = 0").select(
        F.col("rental_id").alias("Rental Id"),
        F.col("duration_seconds").alias("Duration"),
        F.col("bike_id").alias("Bike Id"),
        minute("end_date").alias("End Date"),
        F.col("end_station_id").alias("EndStation Id"),
        F.col("end_station_name").alias("EndStation Name"),
        F.col("end_lon").alias("EndStation Longitude"),
        F.col("end_lat").alias("EndStation Latitude"),
        minute("start_date").alias("Start Date"),
        F.col("start_station_id").alias("StartStation Id"),
        F.col("start_station_name").alias("StartStation Name"),
        F.col("start_lon").alias("StartStation Longitude"),
        F.col("start_lat").alias("StartStation Latitude"),
    )
    snake = rows.where("rental_id % 3 = 1").select(
        "rental_id",
        F.col("duration_seconds").alias("duration"),
        "bike_id",
        minute("end_date").alias("end_date"),
        "end_station_id",
        "end_station_name",
        minute("start_date").alias("start_date"),
        "start_station_id",
        "start_station_name",
        "bike_model",
    )
    recent = rows.where("rental_id % 3 = 2").select(
        F.col("rental_id").alias("Number"),
        minute("start_date").alias("Start date"),
        F.col("start_station_id").alias("Start station number"),
        F.col("start_station_name").alias("Start station"),
        minute("end_date").alias("End date"),
        F.col("end_station_id").alias("End station number"),
        F.col("end_station_name").alias("End station"),
        F.col("bike_id").alias("Bike number"),
        F.col("bike_model").alias("Bike model"),
        F.concat(F.floor(F.col("duration_seconds") / 60).cast("string"), F.lit("m")).alias("Total duration"),
        (F.col("duration_seconds") * 1000).alias("Total duration (ms)"),
    )
    return [(500, title, "Rental Id"), (501, snake, "rental_id"), (502, recent, "Number")]


def collision_feed(spark: SparkSession, folder: str, older_names: bool = False) -> str:
    """Collisions as CSV with day-first dates and clock times; a few of either are unreadable."""
    key = F.col("collision_index").cast("bigint")
    rows = derived.accidents(spark, folder).select(
        F.col("collision_index").alias("accident_reference" if older_names else "collision_index"),
        F.col("collision_severity").alias(" Accident Severity " if older_names else "collision_severity"),
        "longitude",
        "latitude",
        F.when(key % 17 == 0, F.lit("unknown")).otherwise(F.date_format("date", "dd/MM/yyyy")).alias("Date"),
        F.when(F.col("hour_of_day").isNull(), F.lit("--"))
        .otherwise(F.concat(F.lpad(F.col("hour_of_day").cast("string"), 2, "0"), F.lit(":30")))
        .alias("Time"),
        "number_of_casualties",
    )
    path = scratch_path(spark, "collisions")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


def station_feed(spark: SparkSession, folder: str) -> str:
    """Suppliers as JSON lines; every seventh id has no digits, every eleventh no coordinates."""
    key = F.col("station_id")
    rows = derived.stations(spark, folder).select(
        F.when(key % 7 == 0, F.lit("BikePoints_x"))
        .otherwise(F.concat(F.lit("BikePoints_"), key.cast("string")))
        .alias("id"),
        F.concat(F.lit(" "), "station_name", F.lit(" ")).alias("commonName"),
        F.when(key % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("longitude")).alias("lon"),
        F.when(key % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("latitude")).alias("lat"),
    )
    path = scratch_path(spark, "station-feed")
    rows.write.json(path)
    return path


def casualty_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as casualties of the order's collision."""
    return spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_orderkey").cast("string").alias("collision_index"),
        F.col("l_linenumber").cast("bigint").alias("vehicle_reference"),
        F.col("l_partkey").alias("casualty_reference"),
        F.year("l_shipdate").cast("string").alias("accident_year"),
    )


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a file listing: extracts with growing numbers among other files."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        F.when(key % 5 == 0, F.concat(F.lit("usage-stats/"), text, F.lit("-notes.pdf")))
        .when(key % 5 == 1, F.concat(F.lit("usage-stats/"), text, F.lit("journeydataextract.CSV")))
        .when(key % 5 == 2, F.concat(F.lit("usage-stats/JourneyDataExtract"), text, F.lit(".csv")))
        .otherwise(F.concat(F.lit("usage-stats/"), text, F.lit("JourneyDataExtract.csv")))
        .alias("path")
    )
