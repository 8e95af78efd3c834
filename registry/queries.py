"""One query per operator, each over the whole of the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import feeds
from velorisk import constants as C
from velorisk import derived
from velorisk.functions import casts, geo, labels, rates
from velorisk.operators import blackspot, corridor, positions, quality, serving, spatial, staging, temporal
from velorisk.operators.grid import Grid
from velorisk.plans import build, marts
from velorisk.session import materialise, scratch_path
from velorisk.sources import boroughs, collisions, journeys, listing, stations, tables
from velorisk.sources.tables import TableStore
from velorisk.streaming import increments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN = derived.MIN_JOURNEYS
SERVING_GRID = Grid(0.0075, 0.005)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(column, pattern).alias(column)


# Staged inputs. Lazy: every query scans the files itself.


def stg_stations(spark, sf):
    return staging.stage_stations(derived.stations(spark, sf))


def stg_accidents(spark, sf):
    return staging.stage_accidents(derived.accidents(spark, sf))


def stg_journeys(spark, sf):
    return staging.stage_journeys(derived.journeys(spark, sf))


def located(spark, sf):
    return corridor.locate_corridors(corridor.corridor_journeys(stg_journeys(spark, sf), MIN), stg_stations(spark, sf))


def risk(spark, sf, near="buffer"):
    return corridor.score_corridors(located(spark, sf), stg_accidents(spark, sf), near)


# Marts are stored once per session and folder, as a report finds them.

_stored: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf: str, name: str, build_mart: Query) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored:
        _stored[key] = materialise(build_mart(spark, sf), name)
    return _stored[key]


def blackspot_mart(spark, sf):
    return stored(spark, sf, "mart_blackspot_analysis", pip1_blackspot_mart)


def corridor_mart(spark, sf):
    return stored(spark, sf, "mart_corridor_risk_score", pip2_corridor_mart)


def temporal_mart(spark, sf):
    return stored(spark, sf, "mart_temporal_safety", pip3_temporal_mart)


# ---------------------------------------------------------------- whole marts


@query
def pip1_blackspot_mart(spark, sf):
    return marts.blackspots(derived.stations(spark, sf), derived.accidents(spark, sf), derived.journeys(spark, sf))


@query
def pip2_corridor_mart(spark, sf):
    return marts.corridors(
        derived.stations(spark, sf), derived.accidents(spark, sf), derived.journeys(spark, sf), min_journeys=MIN
    )


@query
def pip2_corridor_mart_box(spark, sf):
    return marts.corridors(
        derived.stations(spark, sf),
        derived.accidents(spark, sf),
        derived.journeys(spark, sf),
        min_journeys=MIN,
        near="box",
        length="equirectangular",
    )


@query
def pip2_corridor_mart_rounded_first(spark, sf):
    return marts.corridors(
        derived.stations(spark, sf),
        derived.accidents(spark, sf),
        derived.journeys(spark, sf),
        min_journeys=MIN,
        join_on="name",
        round_first=True,
    )


@query
def pip3_temporal_mart(spark, sf):
    return marts.temporal_patterns(derived.accidents(spark, sf))


def _store_with_raw(spark, sf) -> TableStore:
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace("raw", "tfl_stations", derived.stations(spark, sf))
    store.replace("raw", "uk_accidents", derived.accidents(spark, sf))
    store.replace("raw", "tfl_journeys", derived.journeys(spark, sf))
    return store


def _status(status: DataFrame) -> DataFrame:
    return status.select("step", "ok", "rows")


@query
def pip4_ordered_run(spark, sf):
    """Rental ids repeat here, which fails a test; the models are built all the same."""
    store = _store_with_raw(spark, sf)
    config = build.BuildConfig(root=store.root, min_journeys=MIN, on_failed_test="continue")
    return _status(build.run(spark, config))


@query
def pip4_damaged_run(spark, sf):
    """Journeys without some stations: their tests fail and warn, and whatever needs them is skipped."""
    store = _store_with_raw(spark, sf)
    store.replace("raw", "tfl_journeys", _damaged_journeys(spark, sf))
    status = build.run(spark, build.BuildConfig(root=store.root, min_journeys=MIN))
    skipped = F.col("message").startswith("skipped: ")
    state = F.when(F.col("ok"), "built").when(skipped, "skipped").otherwise("failed").alias("state")
    warned = F.col("message").contains("warn not_null:end_station_id").alias("warned")
    return status.select("step", state, warned, "rows")


@query
def pip5_backfill_run(spark, sf):
    """The wide selection: twelve journey files of three vintages and one that is none, and the second of two
    accident files, since the first is missing. The years are those of the given tables."""
    store = _store_with_raw(spark, sf)
    folder = feeds.folder_of(feeds.named_journey_files(spark, sf))
    feeds.write_text(f"{folder}/999JourneyDataExtract.csv", "no,journey\n1,2\n")
    config = build.backfill(
        build.BuildConfig(
            root=store.root,
            journey_folder=folder,
            accident_paths=[f"{folder}/missing.csv", feeds.collision_feed(spark, sf)],
            min_journeys=MIN,
            on_failed_test="continue",
            select="staging",
        )
    )
    status = build.run(spark, build.replace(config, years=[1996, 1997, 1998]))
    return status.where(F.col("step").startswith("ingest_")).select("step", "ok", "rows", "message")


@query
def pip6_partial_rebuild(spark, sf):
    store = _store_with_raw(spark, sf)
    config = build.BuildConfig(root=store.root, min_journeys=MIN, on_failed_test="continue", select="spatial_layer")
    return _status(build.run(spark, config))


# ---------------------------------------------------------------- sources and sinks


@query
def src1_read_journey_csv(spark, sf):
    df = journeys.read_journeys(spark, feeds.journey_feeds(spark, sf))
    return df.select(
        "rental_id", "bike_id", "bike_model", text("start_date"), text("end_date"), "start_station_id",
        F.trim("start_station_name").alias("start_station_name"), "end_station_id",
        F.trim("end_station_name").alias("end_station_name"), "start_lon", "end_lat", "duration_seconds", "duration_ms",
    )


@query
def src2_source_file_tag(spark, sf):
    """The tag is the last part of the path."""
    df = journeys.read_journeys(spark, feeds.named_journey_files(spark, sf))
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query
def src3_newest_files(spark, sf):
    return listing.newest_files(listing.journey_files(feeds.file_names(spark, sf)), n=12)


@query
def src4_journey_file_filter(spark, sf):
    return listing.journey_files(feeds.file_names(spark, sf))


@query
def src5_first_readable_file(spark, sf):
    path = feeds.collision_feed(spark, sf)
    df = collisions.read_first_available(spark, [path + "-absent", path])
    return df.select(*[F.col(c).cast("string") for c in ("collision_index", "collision_severity", "date", "time")])


@query
def src6_station_feed(spark, sf):
    return stations.read_station_feed(spark, feeds.station_feed(spark, sf), multi_line=False)


@query
def src7_station_fallback(spark, sf):
    met = stations.stations_from_journeys(journeys.to_journey_schema(derived.journeys(spark, sf)))
    feed = stations.read_station_feed(spark, feeds.station_feed(spark, sf), multi_line=False)
    return stations.stations_or_feed(met, feed)


@query
def src8_borough_seed(spark, sf):
    """Stations per region, the station id standing in for a borough code."""
    code = F.concat(F.lit("E09"), F.lpad((F.lit(1) + F.col("station_id") % 33).cast("string"), 6, "0"))
    seed = F.broadcast(boroughs.read_boroughs(spark))  # 33 rows
    joined = derived.stations(spark, sf).withColumn("borough_code", code).join(seed, "borough_code")
    return joined.groupBy("region").agg(
        F.count(F.lit(1)).alias("stations"), F.countDistinct("borough_name").alias("boroughs")
    )


@query
def src9_journey_schema(spark, sf):
    """The 17 columns, the absent ones null."""
    df = journeys.to_journey_schema(derived.journeys(spark, sf))
    times = ("start_date", "end_date")
    return df.select(*[text(c) if c in times else F.col(c) for c in df.columns])


@query
def src10_read_table(spark, sf):
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace("marts", "mart_temporal_safety", temporal_mart(spark, sf), ["grain"])
    return store.read("marts", "mart_temporal_safety")


@query
def snk1_full_replace(spark, sf):
    """The second write replaces the first."""
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace("staging", "accidents", stg_accidents(spark, sf))
    store.replace("staging", "accidents", serving.severe_only(stg_accidents(spark, sf)))
    return store.read("staging", "accidents").select("accident_index", "severity_label")


@query
def snk2_view_or_table(spark, sf):
    store = TableStore(spark, scratch_path(spark, "store"))
    tables.materialise_model(store, tables.STAGING, "stg_accidents", stg_accidents(spark, sf))
    tables.materialise_model(
        store, tables.INTERMEDIATE, "int_temporal_hourly", temporal.temporal_hourly(store.read("staging", "stg_accidents"))
    )
    return store.read("intermediate", "int_temporal_hourly")


@query
def snk3_replace_and_count(spark, sf):
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = store.replace("spatial_layer", "accidents_geo", staging.accidents_geo(derived.accidents(spark, sf)))
    stored_rows = store.read("spatial_layer", "accidents_geo").agg(F.count(F.lit(1)).alias("rows"))
    return stored_rows.select(F.lit("accidents_geo").alias("table_name"), F.lit(rows).cast("bigint").alias("observed"), "rows")


# ---------------------------------------------------------------- harmonisation and casts


@query
def prj1_rename_journey_headers(spark, sf):
    names = {"rental_id": "Number", "start_date": "Start date", "end_station_id": "EndStation Id", "bike_id": "Odd Name"}
    df = derived.journeys(spark, sf).select(*[F.col(k).alias(v) for k, v in names.items()])
    return journeys.rename_headers(df).withColumn("start_date", text("start_date"))


@query
def prj2_normalise_headers(spark, sf):
    df = derived.accidents(spark, sf).select(
        F.col("collision_index").alias(" Collision Index "), F.col("day_of_week").alias("Day Of Week")
    )
    return collisions.normalise_headers(df)


@query
def prj3_conditional_renames(spark, sf):
    df = derived.accidents(spark, sf).select(
        F.col("collision_index").alias("accident_reference"),
        F.col("road_type").alias("accident_index"),
        F.col("collision_severity").alias("accident_severity"),
        F.col("collision_year").alias("accident_year"),
    )
    return collisions.rename_collision_columns(df)


@query
def prj4_required_columns(spark, sf):
    """A file without one of the nine columns is skipped whole."""
    good = feeds.journey_feeds(spark, sf)
    bad = scratch_path(spark, "bad")
    derived.journeys(spark, sf).drop("end_station_name").write.option("header", True).csv(bad)
    return journeys.read_journeys(spark, [bad, *good]).groupBy("bike_model").agg(F.count(F.lit(1)).alias("n"))


@query
def prj5_duration_from_ms(spark, sf):
    df = derived.journeys(spark, sf).select(
        "rental_id", "bike_id", (F.col("duration_seconds") * 1000).alias("duration_ms")
    )
    return journeys.with_duration_seconds(df)


def _clock_texts(spark, sf):
    """Order dates written in the two layouts of the feeds."""
    key = F.col("collision_index").cast("bigint")
    hour = F.lpad(F.col("hour_of_day").cast("string"), 2, "0")
    iso = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":15"))
    day_first = F.concat(F.date_format("date", "dd/MM/yyyy"), F.lit(" "), hour, F.lit(":15"))
    return derived.accidents(spark, sf).select(
        "collision_index", F.when(key % 4 == 0, day_first).otherwise(iso).alias("raw_time")
    )


@query
def prj6_parse_minute_timestamp(spark, sf):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return _clock_texts(spark, sf).select(
        "collision_index",
        F.date_format(casts.iso_minute_timestamp(F.col("raw_time")), stamp).alias("strict"),
        F.date_format(casts.iso_minute_timestamp(F.col("raw_time"), True), stamp).alias("day_first_too"),
    )


@query
def prj7_lenient_numbers(spark, sf):
    raw = F.when(F.col("rental_id") % 9 == 0, F.lit("n/a")).otherwise(F.col("duration_seconds").cast("string"))
    return derived.journeys(spark, sf).select("rental_id", "bike_id", casts.to_number(raw).alias("duration_seconds"))


@query
def prj8_rental_id(spark, sf):
    key = F.col("rental_id")
    raw = F.when(key % 9 == 0, F.lit("?")).when(key % 9 == 1, F.concat(key.cast("string"), F.lit(".0"))).otherwise(key.cast("string"))
    df = derived.journeys(spark, sf).select(casts.to_long(raw).alias("rental_id"), "bike_id")
    return df.dropna(subset=["rental_id"])


@query
def prj9_bike_id_text(spark, sf):
    """A bike id that is a number becomes its text, through the reader's own conversion."""
    part = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("rental_id"),
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey")).alias("bike_id"),
        *(F.lit("1").alias(c) for c in ("start_station_id", "end_station_id", "start_station_name", "end_station_name")),
        *(F.lit("2023-01-01 00:00").alias(c) for c in ("start_date", "end_date")),
        F.lit("60").alias("duration_seconds"),
    )
    return journeys.conform(part).select("bike_id", F.col("rental_id").alias("l_orderkey"))


@query
def prj10_day_first_date(spark, sf):
    key = F.col("collision_index").cast("bigint")
    raw = (
        F.when(key % 3 == 0, F.date_format("date", "dd/MM/yyyy"))
        .when(key % 3 == 1, F.date_format("date", "yyyy-MM-dd"))
        .otherwise(F.lit("soon"))
    )
    return derived.accidents(spark, sf).select("collision_index", casts.day_first_date(raw).cast("string").alias("date"))


@query
def prj11_year_from_date(spark, sf):
    df = derived.accidents(spark, sf).select("collision_index", F.date_format("date", "dd/MM/yyyy").alias("date"))
    return collisions.parse_dates(df).select("collision_index", "year")


@query
def prj12_hour_from_clock(spark, sf):
    df = derived.accidents(spark, sf).select(
        "collision_index",
        F.coalesce(F.concat(F.lpad(F.col("hour_of_day").cast("string"), 2, "0"), F.lit(":45")), F.lit("25:00")).alias("time"),
    )
    return collisions.with_hour(df)


@query
def prj13_safe_cast(spark, sf):
    raw = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).otherwise(F.col("s_acctbal").cast("string"))
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", casts.safe_cast(raw, "double").alias("value"))


@query
def prj14_stage_journeys(spark, sf):
    df = stg_journeys(spark, sf)
    return df.select(*[text(c) if c in ("start_at", "end_at") else F.col(c) for c in df.columns])


@query
def prj15_duration_coalesce(spark, sf):
    df = derived.journeys(spark, sf).withColumns(
        {
            "duration_ms": F.col("duration_seconds") * 1000,
            "duration_seconds": F.when(F.col("rental_id") % 2 == 0, F.col("duration_seconds")),
        }
    )
    return df.select("rental_id", "bike_id", staging.whole_seconds(df).alias("duration_seconds"))


@query
def prj16_stage_accidents(spark, sf):
    return stg_accidents(spark, sf).withColumn("accident_date", F.col("accident_date").cast("string"))


@query
def prj17_stage_stations(spark, sf):
    return stg_stations(spark, sf)


@query
def prj18_accidents_geo(spark, sf):
    grid = Grid(0.0075, 0.005)
    points = grid.locate(staging.accidents_geo(derived.accidents(spark, sf)))
    return points.withColumn("date", F.col("date").cast("string"))


@query
def prj19_stations_geo(spark, sf):
    return Grid(0.0075, 0.005).locate(staging.stations_geo(derived.stations(spark, sf)))


# ---------------------------------------------------------------- filters


@query
def flt1_area_filter(spark, sf):
    df = derived.accidents(spark, sf).withColumn("longitude", F.col("longitude").cast("string"))
    return collisions.filter_area(df).select("collision_index", "longitude", "latitude")


@query
def flt2_area_at_start(spark, sf):
    df = feeds.with_coordinates(derived.journeys(spark, sf))
    return journeys.in_area_at_start(df).select("rental_id", "bike_id", "start_lon", "start_lat")


@query
def flt3_accident_years(spark, sf):
    df = derived.accidents(spark, sf)
    return collisions.filter_years(df, ["1996", "1998", "x"]).select("collision_index", "year")


@query
def flt4_casualty_years(spark, sf):
    return collisions.filter_related_years(feeds.casualty_rows(spark, sf), [1996, 1998])


@query
def flt5_valid_journeys(spark, sf):
    raw = derived.journeys(spark, sf)
    return raw.where(staging.is_valid_journey(staging.whole_seconds(raw))).select("rental_id", "duration_seconds")


@query
def flt6_valid_accidents(spark, sf):
    return stg_accidents(spark, sf).select("accident_index", "longitude", "latitude")


@query
def flt7_valid_stations(spark, sf):
    raw = derived.stations(spark, sf).withColumn("latitude", F.col("latitude") + F.col("station_id") % 4 * F.lit(0.1))
    return staging.stage_stations(raw).select("station_id", "latitude")


@query
def flt8_minimum_exposure(spark, sf):
    return corridor.corridor_journeys(stg_journeys(spark, sf))


@query
def flt9_station_filters(spark, sf):
    return serving.filter_stations(blackspot_mart(spark, sf), blackspots_only=True, min_score=100).select(
        "station_id", "weighted_risk_score", "is_blackspot"
    )


@query
def flt9_accident_severity(spark, sf):
    return serving.filter_severity(stg_accidents(spark, sf), ["Fatal", "Slight"]).select("accident_index", "severity_label")


@query
def flt10_corridor_filters(spark, sf):
    return serving.filter_corridors(corridor_mart(spark, sf), ["High", "Medium"], 85).select(
        "station_a_id", "station_b_id", "risk_category", "journey_count"
    )


@query
def flt11_selected_years(spark, sf):
    return serving.filter_selected_years(temporal_mart(spark, sf), [1996, 1998])


@query
def flt12_severe_accidents(spark, sf):
    return serving.severe_only(stg_accidents(spark, sf)).select("accident_index", "latitude", "longitude", "severity_label")


@query
def flt13_grain(spark, sf):
    return serving.of_grain(temporal_mart(spark, sf), "monthly")


# ---------------------------------------------------------------- joins


@query
def jn1_radius_join(spark, sf):
    points = stg_accidents(spark, sf).select("accident_index", "longitude", "latitude")
    return spatial.radius_join(stg_stations(spark, sf), points, ordered=True).select(
        "station_id", "accident_index", casts.round_half_up(F.col("distance_m"), 3).alias("distance_m")
    )


@query
def jn1_radius_join_planar(spark, sf):
    pairs = spatial.radius_join(stg_stations(spark, sf), stg_accidents(spark, sf), 300.0, metric="planar_deg")
    return pairs.select("station_id", "accident_index", casts.round_half_up(F.col("distance_m"), 3).alias("distance_m"))


@query
def jn2_box_join(spark, sf):
    return spatial.box_join(located(spark, sf), stg_accidents(spark, sf)).select(
        "station_a_id", "station_b_id", "accident_index"
    )


@query
def jn2_nearest_accidents(spark, sf):
    """The ten accidents nearest to each corridor within 800 m."""
    near = spatial.nearest_points(located(spark, sf), stg_accidents(spark, sf), 10, "accident_index", most_m=800.0)
    return near.select(
        "station_a_id", "station_b_id", "place", "accident_index", casts.round_half_up(F.col("distance_m"), 3).alias("distance_m")
    )


@query
def jn3_buffer_join(spark, sf):
    points = stg_accidents(spark, sf).select("accident_index", "longitude", "latitude")
    return spatial.buffer_join(located(spark, sf), points).select(
        "station_a_id", "station_b_id", "accident_index", casts.round_half_up(F.col("distance_m"), 3).alias("distance_m")
    )


@query
def jn4_pairs_to_stations_by_id(spark, sf):
    return located(spark, sf).withColumn("length_m", casts.round_half_up(F.col("length_m"), 3))


@query
def jn5_pairs_to_stations_by_name(spark, sf):
    pairs = corridor.named_corridor_journeys(stg_journeys(spark, sf), MIN)
    return corridor.locate_corridors(pairs, stg_stations(spark, sf), join_on="name").drop("length_m")


@query
def jn6_corridors_left_accidents(spark, sf):
    return risk(spark, sf).select("station_a_id", "station_b_id", "corridor_accident_count", "corridor_risk_raw")


@query
def jn7_corridors_join_scores(spark, sf):
    corridors = materialise(located(spark, sf), "corridors")
    scores = corridor.with_risk(corridors, corridor.corridor_accidents(corridors, stg_accidents(spark, sf)))
    return corridor.corridors_with_scores(corridors, scores)


@query
def jn7_corridors_join_scores_narrow(spark, sf):
    """Within 5 m most corridors have no accident, and stay with 0."""
    corridors = materialise(located(spark, sf), "corridors")
    near = corridor.corridor_accidents(corridors, stg_accidents(spark, sf), buffer_m=5.0)
    return corridor.corridors_with_scores(corridors, corridor.with_risk(corridors, near))


@query
def jn8_stations_left_scores_left_volumes(spark, sf):
    scores = blackspot.station_scores(stg_stations(spark, sf), stg_accidents(spark, sf))
    scored = blackspot.score_stations(scores, blackspot.station_volumes(stg_journeys(spark, sf)))
    return scored.select("station_id", F.col("nearby_accident_count").alias("accident_count"), "total_trips")


@query
def jn9_cross_join_thresholds(spark, sf):
    return corridor.rank_corridors(risk(spark, sf)).select(*corridor.PAIR, F.col("risk_category").alias("band"))


# ---------------------------------------------------------------- aggregations


@query
def agg1_station_scores(spark, sf):
    return blackspot.station_scores(stg_stations(spark, sf), stg_accidents(spark, sf))


@query
def agg2_corridor_journeys(spark, sf):
    return corridor.corridor_journeys(stg_journeys(spark, sf), MIN)


@query
def agg3_named_corridor_journeys(spark, sf):
    return corridor.named_corridor_journeys(stg_journeys(spark, sf), MIN)


@query
def agg4_corridor_accidents_buffer(spark, sf):
    return corridor.corridor_accidents(materialise(located(spark, sf), "corridors"), stg_accidents(spark, sf), "buffer")


@query
def agg4_corridor_accidents_box(spark, sf):
    return corridor.corridor_accidents(materialise(located(spark, sf), "corridors"), stg_accidents(spark, sf), "box")


@query
def agg4_corridor_accidents_narrow(spark, sf):
    """Within 5 m: corridors without accidents are absent."""
    corridors = materialise(located(spark, sf), "corridors")
    return corridor.corridor_accidents(corridors, stg_accidents(spark, sf), "buffer", buffer_m=5.0)


@query
def agg4_small_boxes(spark, sf):
    """Boxes of a station and its surroundings of 0.0005 degrees: those without accidents are absent."""
    places = stg_stations(spark, sf).select(
        "station_id", *(F.col(c).alias(f"{n}_{end}") for c, n in (("longitude", "lon"), ("latitude", "lat")) for end in "ab")
    )
    return spatial.box_totals(places, stg_accidents(spark, sf), corridor.corridor_measures(), 0.0005, ["station_id"])


@query
def agg5_station_volumes(spark, sf):
    return blackspot.station_volumes(stg_journeys(spark, sf))


@query
def agg6_hourly(spark, sf):
    return temporal.hourly_counts(temporal.time_cube(stg_accidents(spark, sf)))


@query
def agg7_period_summary(spark, sf):
    return temporal.period_summary(temporal.temporal_hourly(stg_accidents(spark, sf)))


@query
def agg8_monthly_trend(spark, sf):
    trend = temporal.monthly_trend(staging.accidents_geo(derived.accidents(spark, sf)))
    average = casts.round_half_up(F.col("avg_casualties_per_accident"), 6)
    return trend.withColumn("avg_casualties_per_accident", average)


@query
def agg9_monthly_totals(spark, sf):
    return temporal.monthly_totals(temporal.time_cube(stg_accidents(spark, sf)))


@query
def agg10_exact_quantiles(spark, sf):
    return positions.selected_quantiles(stg_journeys(spark, sf), "duration_seconds", corridor.QUANTILES)


def _sparse_volumes(spark, sf):
    """Journeys per pair, null for a third of the pairs."""
    volumes = corridor.corridor_journeys(stg_journeys(spark, sf), 1)
    missing = (F.col("station_a_id") + F.col("station_b_id")) % 3 == 0
    return volumes.withColumn("journey_count", F.when(~missing, F.col("journey_count")))


@query
def agg10_exact_quantiles_with_nulls(spark, sf):
    return positions.selected_quantiles(_sparse_volumes(spark, sf), "journey_count", corridor.QUANTILES)


@query
def agg10_quantiles_of_positions(spark, sf):
    """The same from a table whose positions are known for other reasons."""
    positioned = positions.with_positions(
        _sparse_volumes(spark, sf), F.asc("journey_count"), *[F.asc(c) for c in corridor.PAIR]
    )
    return positions.exact_quantiles(positioned, "journey_count", corridor.QUANTILES, descending=False)


@query
def agg11_approximate_quantiles(spark, sf):
    """Over 61 different values, which the sketch holds exactly: its quantiles are those of the data."""
    staged = stg_journeys(spark, sf).select((F.col("duration_seconds").cast("bigint") % 61).alias("seconds"))
    return positions.approximate_quantiles(staged, "seconds", corridor.QUANTILES, accuracy=1_000_000)


@query
def agg11_sketches_of_years(spark, sf):
    """Quantiles of four years from stored sketches of single years, and whether their true ranks are within 1 %."""
    staged = stg_journeys(spark, sf).select(F.year("start_at").alias("year"), "duration_seconds")
    sketches = materialise(positions.sketches_by(staged, "duration_seconds", "year"), "sketches")
    found = positions.quantiles_of_sketches(sketches.where(F.col("year").between(1993, 1996)), corridor.QUANTILES)
    inside = staged.where(F.col("year").between(1993, 1996)).crossJoin(F.broadcast(found))  # one row
    shares = {f"p{round(q * 100)}": q for q in corridor.QUANTILES}
    # The rank of a value that occurs often is an interval.
    below = [F.avg((F.col("duration_seconds") < F.col(p)).cast("double")).alias(f"{p}_below") for p in shares]
    upto = [F.avg((F.col("duration_seconds") <= F.col(p)).cast("double")).alias(f"{p}_upto") for p in shares]
    close = [((F.col(f"{p}_below") <= q + 0.01) & (F.col(f"{p}_upto") >= q - 0.01)).alias(f"{p}_close") for p, q in shares.items()]
    return inside.agg(F.count("duration_seconds").alias("n"), *below, *upto).select("n", *close)


@query
def agg12_record_counts(spark, sf):
    tables = {"journeys": derived.journeys(spark, sf), "stations": derived.stations(spark, sf), "accidents": derived.accidents(spark, sf)}
    return serving.counts_of(spark, tables | {"casualties": None})


@query
def agg13_blackspot_kpis(spark, sf):
    return serving.blackspot_kpis(blackspot_mart(spark, sf), stg_accidents(spark, sf))


@query
def agg14_corridor_kpis(spark, sf):
    kpis = serving.corridor_kpis(corridor_mart(spark, sf))
    return kpis.withColumn("avg_accidents", casts.round_half_up(F.col("avg_accidents"), 6))


@query
def agg15_category_counts(spark, sf):
    return serving.category_counts(corridor_mart(spark, sf))


@query
def agg16_temporal_kpis(spark, sf):
    kpis = serving.temporal_kpis(serving.of_grain(temporal_mart(spark, sf), "hourly"))
    return kpis.withColumns({f"{p}_pct": casts.round_half_up(F.col(f"{p}_pct"), 6) for p in ("rush", "night", "weekend", "weekday")})


@query
def agg17_hour_by_day_type(spark, sf):
    return serving.hour_by_day_type(serving.of_grain(temporal_mart(spark, sf), "hourly"))


@query
def agg18_period_by_day_type(spark, sf):
    return serving.period_by_day_type(serving.of_grain(temporal_mart(spark, sf), "time_period"))


@query
def agg19_month_by_year(spark, sf):
    return serving.month_by_year(serving.of_grain(temporal_mart(spark, sf), "monthly"))


@query
def agg20_hour_by_weekday(spark, sf):
    return serving.hour_by_weekday(stg_accidents(spark, sf))


@query
def agg21_score_histogram(spark, sf):
    return serving.score_histogram(blackspot_mart(spark, sf))


@query
def agg22_density_layer(spark, sf):
    layer = serving.density_layer(stg_accidents(spark, sf), SERVING_GRID, serving.label_weight())
    return layer.select("cell_x", "cell_y", "weight")


# ---------------------------------------------------------------- windows


@query
def win1_first_per_station(spark, sf):
    """Stations entered once per nation-sized group of ids, under different names."""
    raw = derived.stations(spark, sf).withColumn("station_id", F.col("station_id") % F.lit(25))
    return staging.first_per_station(raw)


@query
def win2_decile(spark, sf):
    scores = blackspot.station_scores(stg_stations(spark, sf), stg_accidents(spark, sf))
    return blackspot.with_decile(scores, "weighted_risk_score", "station_id").select(
        "station_id", "weighted_risk_score", "risk_decile"
    )


@query
def win2_decile_of_journeys(spark, sf):
    """The same operator on the largest table."""
    staged = stg_journeys(spark, sf).select("duration_seconds", "rental_id", "bike_id", "start_station_id")
    order = [F.asc(c) for c in ("duration_seconds", "rental_id", "bike_id", "start_station_id")]
    positioned = positions.with_positions(staged, *order)
    return positioned.groupBy(positions.ntile(10).alias("tile")).agg(
        F.count(F.lit(1)).alias("n"), F.min("duration_seconds").alias("lowest"), F.max("duration_seconds").alias("highest")
    )


@query
def win3_rank(spark, sf):
    return corridor.rank_corridors(risk(spark, sf)).select("station_a_id", "station_b_id", "composite_risk_score", "risk_rank")


@query
def win3_rank_with_ties(spark, sf):
    volumes = corridor.corridor_journeys(stg_journeys(spark, sf), 1)
    positioned = positions.with_positions(volumes, F.desc("journey_count"), *[F.asc(c) for c in corridor.PAIR])
    return positions.with_rank(positioned, "journey_count").select(*corridor.PAIR, "journey_count", "risk_rank")


@query
def win3_rank_with_nulls(spark, sf):
    positioned = positions.with_positions(
        _sparse_volumes(spark, sf), F.desc("journey_count"), *[F.asc(c) for c in corridor.PAIR]
    )
    return positions.with_rank(positioned, "journey_count").select(*corridor.PAIR, "journey_count", "risk_rank")


@query
def win4_share_of_year(spark, sf):
    return temporal.temporal_hourly(stg_accidents(spark, sf))


@query
def win5_first_station_seen(spark, sf):
    raw = feeds.with_coordinates(derived.journeys(spark, sf)).withColumn(
        "source_file", F.concat((F.col("rental_id") % 4 + 98).cast("string"), F.lit("JourneyDataExtract.csv"))
    )
    return stations.stations_from_journeys(raw.withColumn("start_station_name", F.concat("start_station_name", F.lit("S"))))


# ---------------------------------------------------------------- order, limit, sets


@query
def srt1_mart_order(spark, sf):
    return serving.stations_by_score(blackspot_mart(spark, sf))


@query
def srt1_corridor_order(spark, sf):
    return serving.corridors_by_rank(corridor_mart(spark, sf))


@query
def srt1_temporal_order(spark, sf):
    return serving.temporal_in_order(temporal_mart(spark, sf))


@query
def srt2_top_corridors(spark, sf):
    return serving.top_corridors(corridor_mart(spark, sf), 50)


@query
def srt3_top_stations(spark, sf):
    return serving.top_stations(blackspot_mart(spark, sf)).select("station_id", "weighted_risk_score")


@query
def srt4_top_corridors_by_score(spark, sf):
    return serving.top_corridors_by_score(corridor_mart(spark, sf)).select(
        "station_a_id", "station_b_id", "composite_risk_score"
    )


@query
def srt5_accident_sample(spark, sf):
    return serving.accident_sample(stg_accidents(spark, sf), rows=1000)


@query
def srt6_numeric_order(spark, sf):
    return serving.hourly_in_order(temporal_mart(spark, sf))


@query
def srt7_available_years(spark, sf):
    return serving.available_years(temporal_mart(spark, sf))


@query
def set1_union_of_grains(spark, sf):
    cube = temporal.time_cube(stg_accidents(spark, sf))
    hourly = temporal.with_share_of_year(temporal.hourly_counts(cube))
    return temporal.union_grains(hourly, temporal.period_summary(hourly), temporal.monthly_totals(cube))


@query
def set2_trips_by_end(spark, sf):
    return blackspot.trips_by_end(stg_journeys(spark, sf))


@query
def set3_stations_from_journeys(spark, sf):
    raw = feeds.with_coordinates(derived.journeys(spark, sf)).withColumn("source_file", F.lit("7JourneyDataExtract.csv"))
    return stations.stations_from_journeys(raw)


@query
def set4_concatenate_vintages(spark, sf):
    df = journeys.read_journeys(spark, feeds.journey_feeds(spark, sf))
    vintage = F.when(F.col("start_lon").isNotNull(), "title").when(F.col("duration_ms").isNotNull(), "recent").otherwise("snake")
    return df.groupBy(vintage.alias("vintage")).agg(
        F.count(F.lit(1)).alias("n"), F.count("bike_model").alias("with_model"), F.count("start_date").alias("with_start")
    )


# ---------------------------------------------------------------- scalar functions


@query
def scl1_period_of_day(spark, sf):
    raw = derived.accidents(spark, sf)
    return raw.select("collision_index", labels.period_of_day(F.col("hour_of_day")).alias("period"))


def _odd_severity():
    """Severity with a null for one in 29 and an unknown code for one in 31."""
    key = F.col("collision_index").cast("bigint")
    return F.when(key % 29 == 0, F.lit(None)).when(key % 31 == 0, F.lit(9)).otherwise(F.col("collision_severity"))


@query
def scl2_severity_label(spark, sf):
    return derived.accidents(spark, sf).select("collision_index", labels.severity_label(_odd_severity()).alias("label"))


@query
def scl3_severity_weight(spark, sf):
    return derived.accidents(spark, sf).select("collision_index", labels.severity_weight(_odd_severity()).alias("weight"))


@query
def scl4_scoring_weight(spark, sf):
    return derived.accidents(spark, sf).select("collision_index", labels.scoring_weight(_odd_severity()).alias("weight"))


@query
def scl5_weekday_name(spark, sf):
    day = F.when(F.col("road_type") != 3, F.col("day_of_week"))
    return derived.accidents(spark, sf).select("collision_index", labels.weekday_name(day).alias("weekday"))


@query
def scl6_day_type(spark, sf):
    day = F.when(F.col("road_type") != 3, F.col("day_of_week"))
    return derived.accidents(spark, sf).select("collision_index", labels.day_type(day).alias("day_type"))


def _from_centre(metric):
    """Distance of every accident point from a fixed point."""
    return metric(F.lit(-0.12), F.lit(51.5), F.col("longitude"), F.col("latitude"))


@query
def scl7_great_circle(spark, sf):
    distance = casts.round_half_up(_from_centre(geo.haversine_m), 3)
    return stg_accidents(spark, sf).select("accident_index", distance.alias("distance_m"))


@query
def scl8_planar_degrees(spark, sf):
    distance = casts.round_half_up(_from_centre(geo.planar_degrees_m), 3)
    return stg_accidents(spark, sf).select("accident_index", distance.alias("distance_m"))


@query
def scl9_equirectangular(spark, sf):
    distance = casts.round_half_up(_from_centre(geo.equirectangular_m), 3)
    return stg_accidents(spark, sf).select("accident_index", distance.alias("distance_m"))


@query
def scl10_segment_distance(spark, sf):
    distance = geo.segment_distance_m(
        F.col("longitude"), F.col("latitude"), F.lit(-0.15), F.lit(51.48), F.lit(-0.09), F.lit(51.52)
    )
    return stg_accidents(spark, sf).select("accident_index", casts.round_half_up(distance, 3).alias("distance_m"))


@query
def scl11_midpoint(spark, sf):
    return located(spark, sf).select(*corridor.PAIR, "mid_lon", "mid_lat")


@query
def scl12_risk_per_km(spark, sf):
    return risk(spark, sf).select(*corridor.PAIR, casts.round_half_up(F.col("risk_per_km"), 4).alias("risk_per_km"))


@query
def scl13_composite_risk(spark, sf):
    score = casts.round_half_up(F.col("composite_risk_score"), 4)
    return risk(spark, sf).select(*corridor.PAIR, score.alias("composite_risk_score"))


@query
def scl14_risk_per_1000_trips(spark, sf):
    """Every customer's balance as a score over 0 to 6 trips."""
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    score, trips = F.floor(F.abs("c_acctbal")).cast("bigint"), F.col("c_custkey") % 7
    return customers.select("c_custkey", rates.risk_per_1000_trips(score, trips).alias("rate"))


@query
def scl15_risk_category(spark, sf):
    score = (F.col("c_custkey") % 11).cast("double")
    bands = {0.4: F.lit(4.0), 0.7: F.lit(7.0), 0.9: F.lit(9.0)}
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", labels.risk_category(score, bands).alias("category"))


@query
def scl16_decile_colour(spark, sf):
    decile = F.col("c_custkey") % 11 + 1
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", labels.decile_colour(decile).alias("colour"))


@query
def scl17_category_colour(spark, sf):
    return corridor_mart(spark, sf).select(
        *corridor.PAIR, "risk_category", labels.category_colour(F.col("risk_category")).alias("colour")
    )


@query
def scl18_is_blackspot(spark, sf):
    decile = F.col("c_custkey") % 11
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", labels.is_blackspot(decile).alias("is_blackspot"))


@query
def scl19_corridor_label(spark, sf):
    return located(spark, sf).select(
        *corridor.PAIR, labels.corridor_label(F.col("station_a_name"), F.col("station_b_name")).alias("label")
    )


@query
def scl20_month_key(spark, sf):
    return derived.accidents(spark, sf).select(
        "collision_index", casts.month_key(F.col("date")).alias("year_month"), F.month("date").cast("bigint").alias("month")
    )


@query
def scl21_undirected_pair(spark, sf):
    start, end = F.col("start_station_id"), F.col("end_station_id")
    return derived.journeys(spark, sf).select(
        "rental_id", rates.low_end(start, end).alias("a"), rates.high_end(start, end).alias("b")
    )


@query
def scl22_text_and_null_functions(spark, sf):
    return derived.journeys(spark, sf).select(
        "rental_id",
        casts.clean_text(F.col("start_station_name")).alias("trimmed"),
        F.coalesce("duration_ms", "duration_seconds").alias("first_known"),
        casts.round_half_up(F.col("duration_seconds") / 60, 1).alias("minutes"),
        F.try_divide("duration_seconds", F.col("rental_id") % 2).alias("divided"),
    )


@query
def scl23_line_style(spark, sf):
    return serving.corridor_lines(corridor_mart(spark, sf)).select(*corridor.PAIR, "line_weight", "line_opacity")


@query
def scl24_short_labels(spark, sf):
    lines = serving.corridor_lines(corridor_mart(spark, sf)).select(
        F.col("station_a_id").alias("id"), F.col("corridor_label").alias("label"), F.lit("").alias("popup")
    )
    markers = serving.station_markers(blackspot_mart(spark, sf)).select(
        F.col("station_id").alias("id"), F.col("station_label").alias("label"), F.substring_index("popup", "\n", 2).alias("popup")
    )
    return lines.unionByName(markers)


# ---------------------------------------------------------------- quality


def _damaged_journeys(spark, sf):
    key = F.col("rental_id")
    return derived.journeys(spark, sf).withColumns(
        {
            "start_station_id": F.when(key % 50 != 0, F.col("start_station_id")),
            "end_station_id": F.when(key % 40 != 0, F.col("end_station_id")),
        }
    )


@query
def dq1_not_null(spark, sf):
    return quality.check_rows(
        _damaged_journeys(spark, sf), [quality.not_null("rental_id"), quality.not_null("start_station_id")]
    )


@query
def dq2_unique(spark, sf):
    return quality.unique(derived.journeys(spark, sf), "rental_id")


@query
def dq3_not_null_warning(spark, sf):
    return quality.check_rows(_damaged_journeys(spark, sf), [quality.not_null("end_station_id", "warn")])


@query
def dq4_accepted_values(spark, sf):
    df = derived.accidents(spark, sf).withColumn("collision_severity", _odd_severity())
    return quality.check_rows(df, [quality.accepted_values("collision_severity", [1, 2, 3])])


@query
def dq5_missing_tables(spark, sf):
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace("raw", "tfl_stations", derived.stations(spark, sf))
    return quality.missing_tables(store, "raw", build.REQUIRED_RAW)


@query
def dq5_layout(spark, sf):
    """Stations whole, accidents without two columns, no journeys."""
    store = TableStore(spark, scratch_path(spark, "store"))
    accidents = derived.accidents(spark, sf)
    expected = {"tfl_stations": derived.stations(spark, sf).columns, "uk_accidents": accidents.columns, "tfl_journeys": ["rental_id"]}
    store.replace("raw", "tfl_stations", derived.stations(spark, sf))
    store.replace("raw", "uk_accidents", accidents.drop("latitude", "collision_severity"))
    return quality.check_layout(store, "raw", expected)


@query
def dq_all_checks_on_raw(spark, sf):
    parts = [
        quality.check_journeys(_damaged_journeys(spark, sf)),
        quality.check_stations(derived.stations(spark, sf)),
        quality.check_collisions(derived.accidents(spark, sf)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- streaming


@query
def str1_incremental_pairs(spark, sf):
    return increments.pair_counts(spark, _delivered(spark, sf), 20)


@query
def str1_incremental_stations(spark, sf):
    return increments.station_counts(spark, _delivered(spark, sf))


def _delivered(spark, sf) -> increments.TripCounts:
    """Two deliveries. Line items of an order repeat its rental id, in one delivery with other stations, in the other
    with a month of their own; every 13th start time is unreadable in the first delivery."""
    rows = derived.journeys(spark, sf)
    root = scratch_path(spark, "increments")
    target, source = increments.TripCounts(root), f"{root}/arriving"
    readable = F.when(F.col("rental_id") % 13 != 0, F.col("start_date"))
    first = rows.where("rental_id % 2 = 0").withColumn("start_date", readable)
    journeys.to_journey_schema(first).write.mode("append").parquet(source)
    increments.update(spark, source, target)
    again = rows.where("rental_id % 2 = 1 OR rental_id % 10 = 0").withColumn(
        "start_date", F.when(F.col("rental_id") % 2 == 0, F.add_months("start_date", 1)).otherwise(F.col("start_date"))
    )
    journeys.to_journey_schema(again).write.mode("append").parquet(source)
    increments.update(spark, source, target)
    return target
