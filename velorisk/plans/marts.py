"""Raw tables to marts."""

from pyspark.sql import DataFrame

from velorisk import constants as C
from velorisk.operators import blackspot, corridor, staging, temporal


def blackspots(
    stations: DataFrame,
    accidents: DataFrame,
    journeys: DataFrame,
    radius_m: float = C.BLACKSPOT_RADIUS_M,
    metric: str = "great_circle",
) -> DataFrame:
    scored = blackspot.blackspot_scores(
        staging.stage_stations(stations),
        staging.stage_accidents(accidents),
        staging.stage_journeys(journeys),
        radius_m,
        metric,
    )
    return blackspot.blackspot_mart(scored)


def corridors(stations: DataFrame, accidents: DataFrame, journeys: DataFrame, **options) -> DataFrame:
    ranked = corridor.corridor_risk(
        staging.stage_stations(stations),
        staging.stage_accidents(accidents),
        staging.stage_journeys(journeys),
        **options,
    )
    return corridor.corridor_mart(ranked)


def temporal_patterns(accidents: DataFrame) -> DataFrame:
    return temporal.temporal_mart(staging.stage_accidents(accidents))
