"""Corridor risk: accidents near the line between two stations, per exposure."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions.casts import round_half_up
from velorisk.functions.geo import METRICS, midpoint
from velorisk.functions.labels import category_colour, corridor_label, risk_category, scoring_weight
from velorisk.functions.rates import composite_risk, high_end, low_end, risk_per_km
from velorisk.operators.positions import approximate_quantiles, exact_quantiles, with_positions, with_rank
from velorisk.operators.spatial import box_totals, buffer_totals
from velorisk.session import materialise

PAIR = ["station_a_id", "station_b_id"]
QUANTILES = [0.4, 0.7, 0.9]


def _between_two_stations() -> Column:
    return (
        F.col("start_station_id").isNotNull()
        & F.col("end_station_id").isNotNull()
        & (F.col("start_station_id") != F.col("end_station_id"))
    )


def corridor_journeys(journeys: DataFrame, min_journeys: int = C.MIN_CORRIDOR_JOURNEYS) -> DataFrame:
    """Journeys per undirected station pair with enough of them."""
    start, end = F.col("start_station_id"), F.col("end_station_id")
    return (
        journeys.where(_between_two_stations())
        .groupBy(low_end(start, end).alias("station_a_id"), high_end(start, end).alias("station_b_id"))
        .agg(F.count(F.lit(1)).alias("journey_count"))
        .where(F.col("journey_count") >= F.lit(min_journeys))
    )


def directed_trips(journeys: DataFrame) -> DataFrame:
    """Journeys counted per start and end station: all that corridors and station volumes need of them."""
    return journeys.groupBy("start_station_id", "end_station_id").agg(F.count(F.lit(1)).alias("trips"))


def corridors_of_trips(trips: DataFrame, min_journeys: int = C.MIN_CORRIDOR_JOURNEYS) -> DataFrame:
    """As :func:`corridor_journeys`, from journeys counted by direction."""
    start, end = F.col("start_station_id"), F.col("end_station_id")
    return (
        trips.where(_between_two_stations())
        .groupBy(low_end(start, end).alias("station_a_id"), high_end(start, end).alias("station_b_id"))
        .agg(F.sum("trips").alias("journey_count"))
        .where(F.col("journey_count") >= F.lit(min_journeys))
    )


def named_corridor_journeys(journeys: DataFrame, min_journeys: int = C.MIN_CORRIDOR_JOURNEYS) -> DataFrame:
    """As :func:`corridor_journeys`, with a name for each end: the least one met, so that reruns agree.

    Counted per spelling first: a count hashes, whereas the least of a text
    would make Spark sort every journey.
    """
    start, end = F.col("start_station_id"), F.col("end_station_id")
    start_name, end_name = F.trim("start_station_name"), F.trim("end_station_name")
    forward = start <= end
    return (
        journeys.where(_between_two_stations() & start_name.isNotNull() & end_name.isNotNull())
        .groupBy(
            low_end(start, end).alias("station_a_id"),
            high_end(start, end).alias("station_b_id"),
            F.when(forward, start_name).otherwise(end_name).alias("name_a"),
            F.when(forward, end_name).otherwise(start_name).alias("name_b"),
        )
        .agg(F.count(F.lit(1)).alias("spelled"))
        .groupBy(*PAIR)
        .agg(
            F.min("name_a").alias("station_a_name_raw"),
            F.min("name_b").alias("station_b_name_raw"),
            F.sum("spelled").alias("journey_count"),
        )
        .where(F.col("journey_count") >= F.lit(min_journeys))
    )


def locate_corridors(
    pairs: DataFrame,
    stations: DataFrame,
    join_on: str = "id",
    length: str = "great_circle",
) -> DataFrame:
    """Names and coordinates of both ends, midpoint and length.

    ``join_on="name"`` serves feeds whose ids differ between journeys and
    stations; it needs :func:`named_corridor_journeys`, and a name that two
    stations share multiplies the corridor. Spark broadcasts the stations while
    they are below its size threshold and shuffles them beyond it.
    """

    def end(letter: str) -> DataFrame:
        return stations.select(
            F.col("station_id").alias(f"_{letter}_id"),
            F.col("station_name").alias(f"station_{letter}_name"),
            F.col("longitude").alias(f"lon_{letter}"),
            F.col("latitude").alias(f"lat_{letter}"),
        )

    located = pairs
    for letter in "ab":
        match = {
            "id": lambda x: F.col(f"station_{x}_id") == F.col(f"_{x}_id"),
            "name": lambda x: F.col(f"station_{x}_name_raw") == F.trim(F.col(f"station_{x}_name")),
        }[join_on](letter)
        located = located.join(end(letter), match)
    lon_a, lat_a, lon_b, lat_b = (F.col(c) for c in ("lon_a", "lat_a", "lon_b", "lat_b"))
    return located.select(
        *PAIR,
        "station_a_name",
        "station_b_name",
        "journey_count",
        "lon_a",
        "lat_a",
        "lon_b",
        "lat_b",
        midpoint(lon_a, lon_b).alias("mid_lon"),
        midpoint(lat_a, lat_b).alias("mid_lat"),
        METRICS[length](lon_a, lat_a, lon_b, lat_b).alias("length_m"),
    )


def corridor_measures() -> dict[str, Column]:
    return {
        "corridor_accident_count": F.when(F.col("accident_index").isNotNull(), F.lit(1))
        .otherwise(F.lit(0))
        .cast("bigint"),
        "corridor_risk_raw": scoring_weight(F.col("accident_severity")),
    }


def corridor_accidents(
    corridors: DataFrame,
    accidents: DataFrame,
    near: str = "buffer",
    buffer_m: float = C.CORRIDOR_BUFFER_M,
    pad_deg: float = C.CORRIDOR_PAD_DEG,
) -> DataFrame:
    """Accident count and weight per corridor; corridors without any are absent.

    ``near="buffer"`` counts accidents within ``buffer_m`` of the line,
    ``near="box"`` those in the end points' box widened by ``pad_deg``.
    """
    if near == "buffer":
        return buffer_totals(corridors, accidents, corridor_measures(), buffer_m, PAIR)
    if near == "box":
        return box_totals(corridors, accidents, corridor_measures(), pad_deg, PAIR)
    raise ValueError(f"near must be 'buffer' or 'box', not {near!r}")


def corridors_with_scores(corridors: DataFrame, scores: DataFrame) -> DataFrame:
    """Corridors joined to a table that scores each of them, those without accidents with 0, as :func:`with_risk` makes it."""
    return corridors.select(*PAIR, "journey_count").join(scores.select(*PAIR, *corridor_measures()), PAIR)


def with_risk(corridors: DataFrame, accident_totals: DataFrame) -> DataFrame:
    """Unrounded risk per kilometre and composite score."""
    joined = corridors.join(accident_totals, PAIR, "left").fillna(0, list(corridor_measures()))
    weight, length = F.col("corridor_risk_raw"), F.col("length_m")
    return joined.withColumns(
        {
            "risk_per_km": risk_per_km(weight, length),
            "composite_risk_score": composite_risk(weight, length, F.col("journey_count")),
        }
    )


def score_corridors(
    corridors: DataFrame,
    accidents: DataFrame,
    near: str = "buffer",
    buffer_m: float = C.CORRIDOR_BUFFER_M,
    pad_deg: float = C.CORRIDOR_PAD_DEG,
) -> DataFrame:
    """Located corridors to unrounded risk.

    The corridors are stored: they are read twice, and counting the journeys
    behind them is the largest scan of all.
    """
    corridors = materialise(corridors, "corridors")
    return with_risk(corridors, corridor_accidents(corridors, accidents, near, buffer_m, pad_deg))


def rank_corridors(risk: DataFrame, quantiles: str = "exact", round_first: bool = False) -> DataFrame:
    """Rank by composite score and band by its quantiles.

    Both use the unrounded score unless ``round_first`` is set. The sorted input
    is stored once and serves the rank, the quantiles and the result.
    """
    score = "composite_risk_score"
    if round_first:
        risk = risk.withColumn(score, round_half_up(F.col(score), 2))
    positioned = with_positions(risk, F.desc(score), *[F.asc(c) for c in PAIR])
    if quantiles == "exact":
        thresholds = exact_quantiles(positioned, score, QUANTILES, descending=True)
    else:
        thresholds = approximate_quantiles(positioned, score, QUANTILES)
    banded = with_rank(positioned, score).crossJoin(F.broadcast(thresholds))  # one row
    return banded.select(
        *PAIR,
        "station_a_name",
        "station_b_name",
        "journey_count",
        "lon_a",
        "lat_a",
        "lon_b",
        "lat_b",
        "mid_lon",
        "mid_lat",
        round_half_up(F.col("length_m")).cast("double").alias("length_m"),
        "corridor_accident_count",
        "corridor_risk_raw",
        round_half_up(F.col("risk_per_km"), 2).alias("risk_per_km"),
        round_half_up(F.col(score), 2).alias(score),
        "risk_rank",
        risk_category(F.col(score), {q: F.col(f"p{round(q * 100)}") for q in QUANTILES}).alias("risk_category"),
    )


def corridor_risk(
    stations: DataFrame,
    accidents: DataFrame,
    journeys: DataFrame,
    min_journeys: int = C.MIN_CORRIDOR_JOURNEYS,
    near: str = "buffer",
    join_on: str = "id",
    length: str = "great_circle",
    quantiles: str = "exact",
    round_first: bool = False,
) -> DataFrame:
    """Staged tables to ranked and banded corridors."""
    count = named_corridor_journeys if join_on == "name" else corridor_journeys
    corridors = locate_corridors(count(journeys, min_journeys), stations, join_on, length)
    return rank_corridors(score_corridors(corridors, accidents, near), quantiles, round_first)


def corridor_mart(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "risk_rank",
        *PAIR,
        "station_a_name",
        "station_b_name",
        corridor_label(F.col("station_a_name"), F.col("station_b_name")).alias("corridor_label"),
        "journey_count",
        "length_m",
        "corridor_accident_count",
        "risk_per_km",
        "composite_risk_score",
        "risk_category",
        "lon_a",
        "lat_a",
        "lon_b",
        "lat_b",
        "mid_lon",
        "mid_lat",
        category_colour(F.col("risk_category")).alias("corridor_colour"),
    )
