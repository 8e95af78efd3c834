"""Blackspot scores: severity-weighted accidents around each station."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions.labels import decile_colour, is_blackspot, scoring_weight
from velorisk.functions.rates import risk_per_1000_trips
from velorisk.operators.positions import ntile, with_positions
from velorisk.operators.spatial import radius_totals


def accident_measures() -> dict[str, Column]:
    severity = F.col("accident_severity")

    def of(code: int) -> Column:
        return F.when(severity == F.lit(code), F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    return {
        "accident_count": F.when(F.col("accident_index").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        "total_casualties": F.coalesce(F.col("number_of_casualties"), F.lit(0)).cast("bigint"),
        "fatal_count": of(1),
        "serious_count": of(2),
        "slight_count": of(3),
        "weighted_risk_score": scoring_weight(severity),
    }


def station_scores(
    stations: DataFrame,
    accidents: DataFrame,
    radius_m: float = C.BLACKSPOT_RADIUS_M,
    metric: str = "great_circle",
) -> DataFrame:
    """Accident totals within the radius of each station; a station without any scores 0."""
    measures = accident_measures()
    totals = radius_totals(stations, accidents, measures, radius_m, metric)
    return (
        stations.join(totals, ["longitude", "latitude"], "left")
        .fillna(0, list(measures))
        .select(
            "station_id",
            "station_name",
            "longitude",
            "latitude",
            *measures,
            F.lit(float(radius_m)).alias("search_radius_m"),
        )
    )


def trips_by_end(journeys: DataFrame) -> DataFrame:
    """Trips started and trips ended at each station, as separate rows."""
    starts = journeys.groupBy(F.col("start_station_id").alias("station_id")).agg(F.count(F.lit(1)).alias("trip_count"))
    ends = journeys.groupBy(F.col("end_station_id").alias("station_id")).agg(F.count(F.lit(1)).alias("trip_count"))
    return starts.unionAll(ends)


def volumes_of_trips(trips: DataFrame) -> DataFrame:
    """As :func:`station_volumes`, from journeys counted by direction."""
    ends = F.explode(F.array("start_station_id", "end_station_id"))
    return trips.select(ends.alias("station_id"), "trips").groupBy("station_id").agg(F.sum("trips").alias("total_trips"))


def station_volumes(journeys: DataFrame) -> DataFrame:
    """Trips started plus trips ended, in one pass over the journeys."""
    return (
        journeys.select(F.explode(F.array("start_station_id", "end_station_id")).alias("station_id"))
        .groupBy("station_id")
        .agg(F.count(F.lit(1)).alias("total_trips"))
    )


def with_decile(df: DataFrame, score: str, key: str) -> DataFrame:
    """NTILE(10) over the score, ties broken by key. Stores the sorted input once."""
    positioned = with_positions(df, F.asc(score), F.asc(key))
    return positioned.withColumn("risk_decile", ntile(10)).drop("position", "row_total", "range_no")


def blackspot_scores(
    stations: DataFrame,
    accidents: DataFrame,
    journeys: DataFrame,
    radius_m: float = C.BLACKSPOT_RADIUS_M,
    metric: str = "great_circle",
) -> DataFrame:
    """Staged tables to one scored row per station."""
    return score_stations(station_scores(stations, accidents, radius_m, metric), station_volumes(journeys))


def score_stations(scores: DataFrame, volumes: DataFrame) -> DataFrame:
    """Scores and trip volumes to rates and deciles."""
    scored = scores.join(volumes, "station_id", "left").select(
        "station_id",
        "station_name",
        "longitude",
        "latitude",
        F.col("accident_count").alias("nearby_accident_count"),
        F.col("total_casualties").alias("nearby_casualties"),
        F.col("fatal_count").alias("nearby_fatal_count"),
        F.col("serious_count").alias("nearby_serious_count"),
        F.col("slight_count").alias("nearby_slight_count"),
        "weighted_risk_score",
        "search_radius_m",
        F.coalesce("total_trips", F.lit(0)).cast("bigint").alias("total_trips"),
        risk_per_1000_trips(F.col("weighted_risk_score"), F.col("total_trips")).alias("risk_per_1000_trips"),
    )
    return with_decile(scored, "weighted_risk_score", "station_id")


def blackspot_mart(scored: DataFrame) -> DataFrame:
    return scored.select(
        "station_id",
        "station_name",
        "longitude",
        "latitude",
        "nearby_accident_count",
        "nearby_casualties",
        "nearby_fatal_count",
        "nearby_serious_count",
        "nearby_slight_count",
        "weighted_risk_score",
        "risk_per_1000_trips",
        "total_trips",
        "search_radius_m",
        "risk_decile",
        decile_colour(F.col("risk_decile")).alias("risk_colour"),
        is_blackspot(F.col("risk_decile")).alias("is_blackspot"),
    )
