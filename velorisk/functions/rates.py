"""Risk rates. A rate without exposure is 0."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from velorisk.functions.casts import round_half_up


def risk_per_km(weight: Column, length_m: Column) -> Column:
    return F.when(length_m > F.lit(0.0), weight / (length_m / F.lit(1000.0))).otherwise(F.lit(0.0))


def composite_risk(weight: Column, length_m: Column, journeys: Column) -> Column:
    """Severity-weighted accidents per million journey-kilometres."""
    return F.when(
        (length_m > F.lit(0.0)) & (journeys > F.lit(0)),
        weight / (length_m / F.lit(1000.0) * journeys) * F.lit(1000000.0),
    ).otherwise(F.lit(0.0))


def risk_per_1000_trips(score: Column, trips: Column) -> Column:
    return F.when(
        F.coalesce(trips, F.lit(0)) > F.lit(0),
        round_half_up(score * F.lit(1000.0) / trips, 2),
    ).otherwise(F.lit(0.0))


def low_end(first: Column, second: Column) -> Column:
    """First key of an undirected pair."""
    return F.least(first, second)


def high_end(first: Column, second: Column) -> Column:
    return F.greatest(first, second)
