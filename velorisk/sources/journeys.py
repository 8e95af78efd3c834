"""Journey files of three header vintages, read into one schema."""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk import schemas
from velorisk.functions.casts import iso_minute_timestamp, to_long, to_number
from velorisk.functions.geo import in_box
from velorisk.sources.listing import journey_files, list_files, newest_files

_NUMERIC = [
    "start_lon",
    "start_lat",
    "end_lon",
    "end_lat",
    "duration_seconds",
    "duration_ms",
    "start_station_id",
    "end_station_id",
]


def rename_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[schemas.JOURNEY_HEADERS.get(c, c.lower().replace(" ", "_")) for c in df.columns])


def with_duration_seconds(df: DataFrame) -> DataFrame:
    """Seconds from milliseconds, for files that only carry the latter."""
    if "duration_ms" in df.columns and "duration_seconds" not in df.columns:
        return df.withColumn("duration_seconds", to_number(F.col("duration_ms")) / F.lit(1000.0))
    return df


def missing_columns(df: DataFrame) -> set[str]:
    return schemas.REQUIRED_JOURNEY_COLUMNS - set(df.columns)


def in_area_at_start(df: DataFrame) -> DataFrame:
    """Keep journeys that start in the area. Files without coordinates pass."""
    if {"start_lon", "start_lat"} <= set(df.columns):
        return df.where(in_box(F.col("start_lon"), F.col("start_lat")))
    return df


def conform(df: DataFrame, day_first_times: bool = False) -> DataFrame | None:
    """One header vintage, as text, to the raw journey schema; None if a required column is missing."""
    df = with_duration_seconds(rename_headers(df))
    if missing_columns(df):
        return None
    casts: dict[str, Column] = {c: to_number(F.col(c)) for c in _NUMERIC if c in df.columns}
    casts |= {c: iso_minute_timestamp(F.col(c), day_first_times) for c in ("start_date", "end_date")}
    casts |= {"rental_id": to_long(F.col("rental_id")), "bike_id": F.col("bike_id").cast("string")}
    df = in_area_at_start(df.withColumns(casts).dropna(subset=["rental_id"]))
    return to_journey_schema(df)


def to_journey_schema(df: DataFrame) -> DataFrame:
    """The 17 raw columns in order; an absent one becomes a typed null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.JOURNEYS
        ]
    )


#: Files whose first lines one job reads.
_HEADERS_AT_ONCE = 64


def header_lines(spark: SparkSession, paths: Sequence[str]) -> tuple[dict[str, str], list[str]]:
    """First line of each readable file, and the files that can't be read.

    One job for many files; only where it fails are they tried one by one.
    """

    def first_lines(some: Sequence[str]) -> dict[str, str]:
        parts = [spark.read.text(p).limit(1).select(F.lit(p).alias("path"), "value") for p in some]
        return {row.path: row.value for row in reduce(DataFrame.unionAll, parts).collect()}

    found: dict[str, str] = {}
    unreadable = []
    for at in range(0, len(paths), _HEADERS_AT_ONCE):
        some = paths[at : at + _HEADERS_AT_ONCE]
        try:
            found |= first_lines(some)
        except PySparkException:
            for path in some:
                try:
                    found |= first_lines([path])
                except PySparkException:
                    unreadable.append(path)
    return found, unreadable


def read_journeys(
    spark: SparkSession, paths: Sequence[str], day_first_times: bool = False, skipped: list[str] | None = None
) -> DataFrame:
    """Read journey CSVs. Files are grouped by header line, since Spark applies one header per read.

    A file that can't be read, is empty or lacks a required column is passed over, and named in ``skipped``.
    """
    headers, passed_over = header_lines(spark, paths)
    groups: dict[str, list[str]] = {}
    for path in paths:
        if headers.get(path):
            groups.setdefault(headers[path], []).append(path)
        elif path not in passed_over:
            passed_over.append(path)

    combined = spark.createDataFrame([], schemas.JOURNEYS)
    for members in groups.values():
        rows = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(members)
        conformed = conform(rows.withColumn("source_file", F.col("_metadata.file_name")), day_first_times)
        if conformed is None:
            passed_over += members
        else:
            combined = combined.unionByName(conformed)
    if skipped is not None:
        skipped += passed_over
    return combined


def read_newest_journeys(
    spark: SparkSession,
    folder: str,
    n_files: int | None = None,
    day_first_times: bool = False,
    skipped: list[str] | None = None,
) -> DataFrame:
    """The N newest files of a folder, or all; the path list that reaches the driver has an entry per file."""
    chosen = newest_files(journey_files(list_files(spark, folder)), n_files)
    return read_journeys(spark, [row.path for row in chosen.collect()], day_first_times, skipped)
