"""Temporal patterns: by hour, by period of the day and by month."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velorisk.functions.casts import month_key, round_half_up
from velorisk.session import materialise

HOURLY_KEYS = ["hour_of_day", "day_type", "time_of_day_period", "year"]
_MEASURES = ["accident_count", "casualty_count", "total_severity_weight", "fatal_count", "serious_count"]


def _is(code: int) -> Column:
    return F.when(F.col("accident_severity") == F.lit(code), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def time_cube(accidents: DataFrame) -> DataFrame:
    """Accidents summed to hour × day type × month: one scan feeds all three grains.

    At most 25 hours × 2 day types × 12 months per year, whatever the input.
    """
    return accidents.groupBy(
        *HOURLY_KEYS,
        month_key(F.col("accident_date")).alias("year_month"),
        F.year("accident_date").cast("bigint").alias("date_year"),
    ).agg(
        F.count(F.lit(1)).alias("accident_count"),
        F.sum("number_of_casualties").alias("casualty_count"),
        F.sum("severity_weight").alias("total_severity_weight"),
        F.sum(_is(1)).alias("fatal_count"),
        F.sum(_is(2)).alias("serious_count"),
    )


def hourly_counts(cube: DataFrame) -> DataFrame:
    """One row per hour, day type, period and year; accidents without an hour are left out."""
    return cube.where(F.col("hour_of_day").isNotNull()).groupBy(*HOURLY_KEYS).agg(*[F.sum(m).alias(m) for m in _MEASURES])


def with_share_of_year(hourly: DataFrame) -> DataFrame:
    """Per cent of the year's accidents; a year has at most 48 rows here."""
    whole_year = F.sum("accident_count").over(Window.partitionBy("year"))
    share = F.col("accident_count") * F.lit(100.0) / whole_year
    return hourly.withColumn("pct_of_year_accidents", round_half_up(share, 2))


def temporal_hourly(accidents: DataFrame) -> DataFrame:
    return with_share_of_year(hourly_counts(time_cube(accidents)))


def period_summary(hourly: DataFrame) -> DataFrame:
    """Sums per period; the average weight is over the hourly rows, not over accidents."""
    return hourly.groupBy("time_of_day_period", "day_type", "year").agg(
        F.sum("accident_count").alias("accident_count"),
        F.sum("casualty_count").alias("casualty_count"),
        F.sum("fatal_count").alias("fatal_count"),
        F.sum("serious_count").alias("serious_count"),
        round_half_up(F.avg("total_severity_weight"), 2).alias("avg_severity_weight"),
    )


def monthly_totals(cube: DataFrame) -> DataFrame:
    """Totals per month of the accident date; accidents without an hour count too."""
    return (
        cube.where(F.col("year_month").isNotNull())
        .groupBy("year_month", F.col("date_year").alias("year"))
        .agg(F.sum("accident_count").alias("accident_count"), F.sum("casualty_count").alias("casualty_count"))
    )


def monthly_trend(points: DataFrame) -> DataFrame:
    """Accidents and casualties per month, with the average per accident."""
    return (
        points.where(F.col("date").isNotNull())
        .groupBy(
            F.year("date").cast("bigint").alias("year"),
            F.month("date").cast("bigint").alias("month"),
            month_key(F.col("date")).alias("year_month"),
        )
        .agg(
            F.count(F.lit(1)).alias("accident_count"),
            F.sum("number_of_casualties").alias("casualty_count"),
            F.avg("number_of_casualties").alias("avg_casualties_per_accident"),
        )
    )


def union_grains(hourly: DataFrame, periods: DataFrame, monthly: DataFrame) -> DataFrame:
    """The three grains in one table, with typed nulls for what a grain does not measure."""

    def grain(name: str, df: DataFrame, dimension: Column) -> DataFrame:
        def measure(column: str, type_name: str) -> Column:
            value = F.col(column) if column in df.columns else F.lit(None)
            return value.cast(type_name).alias(column)

        return df.select(
            F.lit(name).alias("grain"),
            dimension.cast("string").alias("dimension"),
            measure("day_type", "string"),
            measure("time_of_day_period", "string"),
            measure("year", "bigint"),
            measure("accident_count", "bigint"),
            measure("casualty_count", "bigint"),
            measure("fatal_count", "bigint"),
            measure("serious_count", "bigint"),
            measure("pct_of_year_accidents", "double"),
            measure("avg_severity_weight", "double"),
        )

    return (
        grain("hourly", hourly, F.col("hour_of_day"))
        .unionByName(grain("time_period", periods, F.col("time_of_day_period")))
        .unionByName(grain("monthly", monthly, F.col("year_month")))
    )


def temporal_mart(accidents: DataFrame) -> DataFrame:
    """Staged accidents to the three-grain mart. The cube is stored, so the accidents are read once."""
    cube = materialise(time_cube(accidents), "time_cube")
    hourly = with_share_of_year(hourly_counts(cube))
    return union_grains(hourly, period_summary(hourly), monthly_totals(cube))
