"""Queries that reports run on the marts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions.labels import (
    line_opacity,
    line_weight,
    period_position,
    severity_weight,
    title_label,
    weekday_name,
)
from velorisk.operators.grid import Grid
from velorisk.operators.positions import smallest_by_hash
from velorisk.sources.tables import RAW, TableStore

SAMPLE_COLUMNS = [
    "accident_index",
    "longitude",
    "latitude",
    "accident_severity",
    "severity_label",
    "number_of_casualties",
    "hour_of_day",
    "day_of_week",
    "day_type",
    "year",
]


# ---------------------------------------------------------------- filters


def filter_severity(accidents: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Accidents of the chosen severities; no choice means all."""
    return accidents.where(F.col("severity_label").isin(*labels)) if labels else accidents


def severe_only(accidents: DataFrame) -> DataFrame:
    return filter_severity(accidents, ["Fatal", "Serious"])


def filter_stations(stations: DataFrame, blackspots_only: bool = False, min_score: float = 0) -> DataFrame:
    if blackspots_only:
        stations = stations.where(F.col("is_blackspot"))
    return stations.where(F.col("weighted_risk_score") >= F.lit(min_score))


def filter_corridors(corridors: DataFrame, categories: Sequence[str] = (), min_journeys: int = 50) -> DataFrame:
    if categories:
        corridors = corridors.where(F.col("risk_category").isin(*categories))
    return corridors.where(F.col("journey_count") >= F.lit(min_journeys))


def filter_selected_years(mart: DataFrame, years: Sequence[int]) -> DataFrame:
    """Rows of the selected years, for any grain; no selection means all."""
    return mart.where(F.col("year").isin(*years)) if years else mart


def of_grain(mart: DataFrame, grain: str) -> DataFrame:
    return mart.where(F.col("grain") == F.lit(grain))


def available_years(mart: DataFrame) -> DataFrame:
    return mart.select("year").dropna().distinct().orderBy("year")


# ---------------------------------------------------------------- order and top N


def stations_by_score(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc("weighted_risk_score"), "station_id")


def corridors_by_rank(mart: DataFrame) -> DataFrame:
    return mart.orderBy("risk_rank", "station_a_id", "station_b_id")


def temporal_in_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy("grain", F.asc_nulls_last("year"), "dimension", F.asc_nulls_last("day_type"))


def hourly_in_order(mart: DataFrame) -> DataFrame:
    """Hourly rows with the text dimension sorted as a number: 9 before 10."""
    hour = F.col("dimension").try_cast("int")
    return of_grain(mart, "hourly").orderBy(F.asc_nulls_last("year"), F.asc_nulls_last(hour), "day_type")


def period_in_order(mart: DataFrame) -> DataFrame:
    return of_grain(mart, "time_period").orderBy(F.asc_nulls_last("year"), "dimension", "day_type")


def monthly_in_order(mart: DataFrame) -> DataFrame:
    return of_grain(mart, "monthly").orderBy("year", "dimension")


def top_corridors(mart: DataFrame, n: int = 50) -> DataFrame:
    """The N best-ranked corridors, N at least 1. Filters applied afterwards may leave fewer."""
    return corridors_by_rank(mart).limit(max(1, int(n)))


def top_stations(stations: DataFrame, n: int = 10) -> DataFrame:
    return stations_by_score(stations).limit(n)


def top_corridors_by_score(corridors: DataFrame, n: int = 35) -> DataFrame:
    return corridors.orderBy(F.desc("composite_risk_score"), "station_a_id", "station_b_id").limit(n)


def accident_sample(accidents: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` accident points for a map, evenly drawn and the same on every run.

    :func:`density_layer` shows all of them, summed per cell.
    """
    points = accidents.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    return smallest_by_hash(points.select(*SAMPLE_COLUMNS), "accident_index", rows)


# ---------------------------------------------------------------- key figures


def blackspot_kpis(stations: DataFrame, accidents: DataFrame) -> DataFrame:
    by_station = stations.agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if("is_blackspot").alias("blackspots"),
        F.max("weighted_risk_score").alias("max_score"),
    )
    in_view = accidents.agg(F.count(F.lit(1)).alias("accidents_in_view"))
    return by_station.crossJoin(F.broadcast(in_view)).select("stations", "accidents_in_view", "blackspots", "max_score")


def corridor_kpis(corridors: DataFrame) -> DataFrame:
    return corridors.agg(
        F.count(F.lit(1)).alias("corridors"),
        F.count_if(F.col("risk_category") == F.lit("Very High")).alias("very_high"),
        F.coalesce(F.sum("journey_count"), F.lit(0)).alias("total_journeys"),
        F.avg("corridor_accident_count").alias("avg_accidents"),
    )


def temporal_kpis(hourly: DataFrame) -> DataFrame:
    """Totals and their shares in per cent; a share of nothing is null."""

    def total(condition: Column | None = None) -> Column:
        counted = F.col("accident_count") if condition is None else F.when(condition, F.col("accident_count"))
        return F.coalesce(F.sum(counted), F.lit(0))

    period = F.col("time_of_day_period")
    sums = hourly.agg(
        total().alias("total_accidents"),
        total(period.isin(*C.RUSH_PERIODS)).alias("rush_accidents"),
        total(period == F.lit(C.NIGHT_PERIOD)).alias("night_accidents"),
        total(F.col("day_type") == F.lit("Weekend")).alias("weekend_accidents"),
        total(F.col("day_type") == F.lit("Weekday")).alias("weekday_accidents"),
    )
    parts = ["rush", "night", "weekend", "weekday"]
    return sums.select(
        "*",
        *[
            F.try_divide(F.col(f"{p}_accidents") * F.lit(100.0), F.col("total_accidents").cast("double")).alias(
                f"{p}_pct"
            )
            for p in parts
        ],
    )


def category_counts(corridors: DataFrame) -> DataFrame:
    return corridors.groupBy("risk_category").agg(F.count(F.lit(1)).alias("corridors"))


def record_counts(store: TableStore, tables: dict[str, str]) -> DataFrame:
    """Rows of each raw table under its display name; null for a table that does not exist."""
    return counts_of(store.spark, {label: store.read(RAW, t) if store.exists(RAW, t) else None for label, t in tables.items()})


def counts_of(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows of each table under its display name, null for none; no column is read."""
    combined = None
    for label, table in tables.items():
        if table is None:
            row = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        else:
            row = table.agg(F.count(F.lit(1)).alias("rows"))
        row = row.select(F.lit(label).alias("table_name"), "rows")
        combined = row if combined is None else combined.unionByName(row)
    return combined


# ---------------------------------------------------------------- chart series


def hour_by_day_type(hourly: DataFrame) -> DataFrame:
    hour = F.col("dimension").try_cast("bigint")
    return (
        hourly.groupBy(hour.alias("hour"), "day_type")
        .agg(F.sum("accident_count").alias("accident_count"))
        .where(F.col("hour").isNotNull())
        .orderBy("hour", "day_type")
    )


def period_by_day_type(periods: DataFrame) -> DataFrame:
    return (
        periods.groupBy(F.col("dimension").alias("time_period"), "day_type")
        .agg(*[F.sum(c).alias(c) for c in ("accident_count", "fatal_count", "serious_count")])
        .orderBy(period_position(F.col("time_period")), "day_type")
    )


def month_by_year(monthly: DataFrame) -> DataFrame:
    return (
        monthly.groupBy(F.col("dimension").alias("year_month"), "year")
        .agg(F.sum("accident_count").alias("accident_count"))
        .orderBy("year_month")
    )


def hour_by_weekday(accidents: DataFrame) -> DataFrame:
    """Matrix of weekday rows, Monday first, and hour columns; 0 where nothing happened.

    The hours are listed, so no extra job looks for them, and the result has at most 7 rows.
    """
    hours = list(range(24))
    monday_first = (F.col("day_of_week") + F.lit(5)) % F.lit(7)
    return (
        accidents.where(F.col("hour_of_day").isNotNull() & F.col("day_of_week").between(1, 7))
        .groupBy("day_of_week")
        .pivot("hour_of_day", hours)
        .agg(F.count(F.lit(1)))
        .fillna(0)
        .orderBy(monday_first)
        .select(weekday_name(F.col("day_of_week")).alias("weekday_name"), *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    )


def score_histogram(stations: DataFrame, bins: int = 40) -> DataFrame:
    """Stations per equal-width score bin and decile; the top edge belongs to the last bin."""
    score = F.col("weighted_risk_score").cast("double")
    limits = stations.agg(F.min(score).alias("lowest"), F.max(score).alias("highest"))
    width = F.col("highest") - F.col("lowest")
    place = F.when(
        width > F.lit(0.0), F.floor((score - F.col("lowest")) * F.lit(float(bins)) / width) + F.lit(1)
    ).otherwise(F.lit(1))
    return (
        stations.crossJoin(F.broadcast(limits))  # one row
        .groupBy(F.least(F.lit(bins), place).cast("bigint").alias("bin"), "risk_decile")
        .agg(F.count(F.lit(1)).alias("stations"))
    )


def density_layer(accidents: DataFrame, grid: Grid, weight: Column | None = None) -> DataFrame:
    """Weight per grid cell, at the cell's centre: a heat layer whose size is set by the grid."""
    weight = F.lit(1) if weight is None else weight
    points = accidents.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    return (
        grid.locate(points)
        .groupBy("cell_x", "cell_y")
        .agg(F.sum(weight.cast("bigint")).alias("weight"))
        .select(
            "cell_x",
            "cell_y",
            grid.centre_lat(F.col("cell_y")).alias("latitude"),
            grid.centre_lon(F.col("cell_x")).alias("longitude"),
            "weight",
        )
    )


def label_weight() -> Column:
    """10, 3 or 1 by severity label; an unknown label weighs 1."""
    label = F.col("severity_label")
    return severity_weight(F.when(label == "Fatal", 1).when(label == "Serious", 2))


# ---------------------------------------------------------------- map-ready views


def station_markers(stations: DataFrame) -> DataFrame:
    """Marker position, colour, short label and popup text of each station."""
    shown = [
        "station_name",
        "weighted_risk_score",
        "nearby_accident_count",
        "nearby_fatal_count",
        "nearby_serious_count",
        "total_trips",
        "risk_per_1000_trips",
        "risk_decile",
    ]
    lines = [F.concat(F.lit(f"{title_label(c)}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in shown]
    return stations.select(
        "station_id",
        "latitude",
        "longitude",
        "risk_colour",
        F.substring("station_name", 1, 38).alias("station_label"),
        F.concat_ws("\n", *lines).alias("popup"),
    )


def corridor_lines(corridors: DataFrame) -> DataFrame:
    """Line ends, colour, weight, opacity and short label of each corridor."""
    category = F.col("risk_category")
    return corridors.select(
        "station_a_id",
        "station_b_id",
        "lat_a",
        "lon_a",
        "lat_b",
        "lon_b",
        "mid_lat",
        "mid_lon",
        "corridor_colour",
        line_weight(category).alias("line_weight"),
        line_opacity(category).alias("line_opacity"),
        F.substring("corridor_label", 1, 40).alias("corridor_label"),
    )
