"""Collision, casualty and vehicle files."""

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk import schemas
from velorisk.functions.casts import day_first_date, hour_of_clock, to_long, to_number
from velorisk.functions.geo import in_box


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def rename_collision_columns(df: DataFrame) -> DataFrame:
    """Bring older column names to today's, unless today's is there already."""
    for new, olds in schemas.COLLISION_RENAMES:
        for old in olds:
            if old in df.columns and new not in df.columns:
                df = df.withColumnRenamed(old, new)
    return df


def read_first_available(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The first candidate that can be read, with today's column names; None if there is none."""
    for path in paths:
        try:
            rows = spark.read.option("header", True).option("escape", '"').csv(path)
            rows.head(1)  # a file that opens may still fail to parse
        except PySparkException:
            continue
        if rows.columns:
            return rename_collision_columns(normalise_headers(rows))
    return None


def parse_dates(df: DataFrame) -> DataFrame:
    """Day-first dates, and a year taken from them where the file has none."""
    if "date" in df.columns:
        df = df.withColumn("date", day_first_date(F.col("date")))
        if "year" not in df.columns:
            df = df.withColumn("year", F.year("date").cast("bigint"))
    return df


def filter_years(
    df: DataFrame,
    years: Sequence[int | str] | None,
    candidates: Sequence[str] = ("year", "collision_year", "accident_year"),
) -> DataFrame:
    """Rows of the given years, by the first year column present. No years, or no such column: all rows."""
    column = next((c for c in candidates if c in df.columns), None)
    if not years or column is None:
        return df
    wanted = [int(y) for y in years if str(y).strip().isdigit()]
    return df.where(to_long(F.col(column)).isin(wanted))


def filter_related_years(df: DataFrame, years: Sequence[int | str] | None) -> DataFrame:
    """Year filter of casualties and vehicles, which carry neither a date nor coordinates.

    None takes all years. Unlike for collisions, an empty list of years leaves no row.
    """
    if years is None:
        return df
    column = next((c for c in ("collision_year", "accident_year") if c in df.columns), None)
    if column is None:
        return df
    wanted = [int(y) for y in years if str(y).strip().isdigit()]
    return df.where(to_long(F.col(column)).isin(wanted))


def filter_area(df: DataFrame) -> DataFrame:
    """Rows inside the area of interest; text coordinates are read as numbers."""
    if not {"longitude", "latitude"} <= set(df.columns):
        return df
    df = df.withColumns({c: to_number(F.col(c)) for c in ("longitude", "latitude")})
    return df.where(in_box(F.col("longitude"), F.col("latitude")))


def with_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("hour_of_day", hour_of_clock(F.col("time"))) if "time" in df.columns else df


def clean_collisions(df: DataFrame, years: Sequence[int | str] | None = None) -> DataFrame:
    return with_hour(filter_area(filter_years(parse_dates(df), years)))


def read_collisions(spark: SparkSession, paths: Sequence[str], years: Sequence[int | str] | None = None) -> DataFrame | None:
    rows = read_first_available(spark, paths)
    return None if rows is None else clean_collisions(rows, years)


def read_related(spark: SparkSession, paths: Sequence[str], years: Sequence[int | str] | None = None) -> DataFrame | None:
    """Casualties or vehicles."""
    rows = read_first_available(spark, paths)
    return None if rows is None else filter_related_years(rows, years)
