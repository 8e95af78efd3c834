import datetime

import pytest
from pyspark.sql import functions as F

from velorisk.operators import blackspot, corridor, quality, serving, staging, temporal
from velorisk.operators.grid import Grid


def test_journey_duration_bounds(spark, journeys_of):
    seconds = [59.4, 59.5, 60.0, 86400.0, 86400.4, 86400.5]
    staged = staging.stage_journeys(journeys_of([(i, 1, 2, s) for i, s in enumerate(seconds)]))
    assert sorted((r.rental_id, r.duration_seconds) for r in staged.collect()) == [(1, 60), (2, 60), (3, 86400), (4, 86400)]


def test_duration_falls_back_to_milliseconds(spark, journeys_of):
    raw = journeys_of([(1, 1, 2, 600.0), (2, 1, 2, 700.0)]).withColumn("duration_ms", F.lit(90_000.0))
    raw = raw.withColumn("duration_seconds", F.when(F.col("rental_id") == 2, F.col("duration_seconds")))
    rows = {r.rental_id: r for r in staging.stage_journeys(raw).collect()}
    assert rows[1].duration_seconds == 90 and rows[1].duration_minutes == 1.5
    assert rows[2].duration_seconds == 700


def test_journeys_need_two_different_stations(spark, journeys_of):
    rows = [(1, 1, 2), (2, 1, 1), (3, None, 2), (4, 1, None), (None, 1, 2)]
    assert [r.rental_id for r in staging.stage_journeys(journeys_of(rows)).collect()] == [1]


RAW_ACCIDENT = (
    "collision_index string, date string, collision_year bigint, year bigint, hour_of_day double, day_of_week string,"
    " collision_severity string, number_of_casualties bigint, road_type string, longitude string, latitude string"
)


def test_staged_accidents(spark):
    rows = [
        ("a", "2022-06-01", None, 2022, 8.0, "1", "1", 2, "Single", "-0.12", "51.5"),
        ("b", "oops", 2021, 2022, None, None, None, None, "6", "-0.55", "51.28"),
        ("c", None, 2021, 2022, 3.0, "4", "3", 1, "6", "0.31", "51.5"),
        (None, None, 2021, 2022, 3.0, "4", "3", 1, "6", "0.3", "51.5"),
        ("d", None, 2021, 2022, 3.0, "4", "3", 1, "6", "x", "51.5"),
    ]
    raw = spark.createDataFrame(rows, RAW_ACCIDENT)
    staged = {r.accident_index: r for r in staging.stage_accidents(raw).collect()}
    assert sorted(staged) == ["a", "b"]
    a, b = staged["a"], staged["b"]
    assert a.accident_date == datetime.date(2022, 6, 1) and a.year == 2022 and a.road_type is None
    assert (a.severity_label, a.severity_weight, a.weekday_name, a.day_type) == ("Fatal", 10, "Sunday", "Weekend")
    assert a.time_of_day_period == "AM Rush (07-09)"
    assert (b.severity_label, b.severity_weight, b.weekday_name, b.day_type) == ("Slight", 1, "Unknown", "Weekday")
    assert b.time_of_day_period == "Unknown" and b.year == 2021 and b.road_type == 6
    assert list(staged["a"].asDict()) == staging.ACCIDENT_COLUMNS
    # The point layer keeps a point without an index.
    assert staging.accidents_geo(raw).count() == 3


def test_repeated_station_ids(spark):
    rows = [("2", " B ", "-0.1", "51.5"), ("2", "A", "-0.2", "51.5"), ("3", "C", "-0.1", "55.0"), (None, "D", "-0.1", "51.5")]
    raw = spark.createDataFrame(rows, "station_id string, station_name string, longitude string, latitude string")
    assert [tuple(r) for r in staging.stage_stations(raw).collect()] == [(2, "A", -0.2, 51.5)]
    assert staging.stations_geo(raw).count() == 4


def test_station_without_accidents_scores_zero(spark, stations, accidents_of):
    accidents = accidents_of(
        [
            ("a", -0.1149, 51.5036, 1, 2),
            ("b", -0.1150, 51.5037, 2, None),
            ("c", -0.1150, 51.5037, None, 1),
            (None, -0.1150, 51.5037, 3, 1),
        ]
    )
    rows = {r.station_id: r for r in blackspot.station_scores(stations, accidents).collect()}
    one = rows[1]
    assert (one.accident_count, one.total_casualties, one.fatal_count, one.serious_count, one.slight_count) == (3, 4, 1, 1, 1)
    assert one.weighted_risk_score == 14  # an unknown severity weighs nothing
    assert (rows[3].accident_count, rows[3].weighted_risk_score, rows[3].total_casualties) == (0, 0, 0)
    assert one.search_radius_m == 500.0


def test_planar_radius_is_narrower_east_to_west(spark, accidents_of):
    site = spark.createDataFrame([(1, "x", -0.12, 51.5)], "station_id bigint, station_name string, longitude double, latitude double")
    east = accidents_of([("e", -0.12 + 400 / 69_300, 51.5, 3, 1)])
    assert blackspot.station_scores(site, east).first().accident_count == 1
    assert blackspot.station_scores(site, east, metric="planar_deg").first().accident_count == 0


def test_blackspot_scores(spark, stations, accidents_of, journeys_of):
    accidents = accidents_of([("a", -0.1149, 51.5036, 1, 2)])
    journeys = staging.stage_journeys(journeys_of([(1, 1, 2), (2, 2, 1), (3, 1, 2)]))
    rows = {r.station_id: r for r in blackspot.blackspot_mart(blackspot.blackspot_scores(stations, accidents, journeys)).collect()}
    assert rows[1].total_trips == 3 and rows[1].risk_per_1000_trips == 3333.33
    assert rows[3].total_trips == 0 and rows[3].risk_per_1000_trips == 0.0
    assert [rows[i].risk_decile for i in (2, 3, 1)] == [1, 2, 3]
    assert len(rows[1]) == 16 and not rows[1].is_blackspot


def test_corridors_are_undirected(spark, journeys_of):
    journeys = journeys_of([(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 2, 3), (5, 3, 2), (6, 3, 3), (7, None, 3)])
    assert corridor.corridor_journeys(journeys).count() == 0
    got = sorted(tuple(r) for r in corridor.corridor_journeys(journeys, 2).collect())
    assert got == [(1, 2, 3), (2, 3, 2)]
    named = {r.station_a_id: r for r in corridor.named_corridor_journeys(journeys, 2).collect()}
    assert (named[1].station_a_name_raw, named[1].station_b_name_raw) == ("Waterloo", "London Bridge")


@pytest.fixture
def corridors_frame(spark, stations, journeys_of):
    return corridor.locate_corridors(corridor.corridor_journeys(journeys_of([(1, 1, 2), (2, 2, 3)]), 1), stations)


def test_join_by_name_survives_other_ids(spark, stations, journeys_of):
    other = stations.withColumn("station_id", F.col("station_id") + 900)
    journeys = journeys_of([(1, 1, 2)])
    assert corridor.locate_corridors(corridor.corridor_journeys(journeys, 1), other).count() == 0
    row = corridor.locate_corridors(corridor.named_corridor_journeys(journeys, 1), other, join_on="name").first()
    assert (row.station_a_id, row.station_a_name, row.station_b_name) == (1, "Waterloo", "London Bridge")


def test_lengths(spark, stations, journeys_of):
    pairs = corridor.corridor_journeys(journeys_of([(1, 1, 2)]), 1)
    great = corridor.locate_corridors(pairs, stations).first()
    flat = corridor.locate_corridors(pairs, stations, length="equirectangular").first()
    assert great.length_m == pytest.approx(1909, abs=5) and flat.length_m == pytest.approx(great.length_m, rel=2e-3)
    assert great.mid_lon == pytest.approx(-0.1012)


def test_box_and_buffer_differ(spark, corridors_frame, accidents_of):
    # Inside the box of London Bridge–Victoria only, and some 250 m off its line.
    beside = accidents_of([("x", -0.1012, 51.5006, 2, 1)])
    wide = accidents_of([("y", -0.1012, 51.5046, 1, 1)])
    assert corridor.corridor_accidents(corridors_frame, beside, "buffer").count() == 0
    assert corridor.corridor_accidents(corridors_frame, wide, "buffer").first().corridor_risk_raw == 10
    in_box = corridor.corridor_accidents(corridors_frame, beside, "box").where("corridor_accident_count > 0")
    assert [(r.station_a_id, r.corridor_risk_raw) for r in in_box.collect()] == [(2, 3)]
    with pytest.raises(ValueError):
        corridor.corridor_accidents(corridors_frame, wide, "disc")


def risk_frame(spark, scores):
    rows = [(i, i + 100, "A", "B", 100, 0.0, 51.0, 0.0, 51.0, 0.0, 51.0, 1000.0, 1, 1, 1.0, s) for i, s in enumerate(scores)]
    schema = (
        "station_a_id bigint, station_b_id bigint, station_a_name string, station_b_name string, journey_count bigint,"
        " lon_a double, lat_a double, lon_b double, lat_b double, mid_lon double, mid_lat double, length_m double,"
        " corridor_accident_count bigint, corridor_risk_raw bigint, risk_per_km double, composite_risk_score double"
    )
    return spark.createDataFrame(rows, schema)


def test_scores_on_thresholds(spark):
    # Eleven scores 0..10 put p40, p70 and p90 on 4, 7 and 9 exactly.
    rows = corridor.rank_corridors(risk_frame(spark, [float(i) for i in range(11)])).collect()
    bands = {r.station_a_id: r.risk_category for r in rows}
    assert [bands[i] for i in (10, 9, 8, 7, 5, 4, 0)] == ["Very High", "High", "High", "Medium", "Medium", "Low", "Low"]
    assert {r.station_a_id: r.risk_rank for r in rows}[10] == 1


def test_rank_on_unrounded_scores(spark):
    risk = risk_frame(spark, [1.001, 1.002, 0.0, 0.0])
    exact = {r.station_a_id: r.risk_rank for r in corridor.rank_corridors(risk).collect()}
    assert exact == {1: 1, 0: 2, 2: 3, 3: 3}
    rounded = {r.station_a_id: r.risk_rank for r in corridor.rank_corridors(risk, round_first=True).collect()}
    assert rounded == {0: 1, 1: 1, 2: 3, 3: 3}


def test_approximate_bands(spark):
    rows = corridor.rank_corridors(risk_frame(spark, [float(i) for i in range(100)]), quantiles="approximate").collect()
    assert sum(r.risk_category == "Very High" for r in rows) == 10


def test_no_accident_means_zero_risk(spark, corridors_frame, accidents_of):
    none = corridor.corridor_accidents(corridors_frame, accidents_of([]))
    rows = corridor.with_risk(corridors_frame, none).collect()
    assert len(rows) == 2 and all(r.composite_risk_score == 0.0 and r.corridor_accident_count == 0 for r in rows)


@pytest.fixture
def timed(spark):
    schema = (
        "accident_index string, accident_date date, year bigint, hour_of_day bigint, day_of_week bigint, day_type string,"
        " time_of_day_period string, accident_severity bigint, severity_weight bigint, number_of_casualties bigint"
    )
    d = datetime.date
    rows = [
        ("a", d(2022, 6, 1), 2022, 8, 4, "Weekday", "AM Rush (07-09)", 1, 10, 2),
        ("b", d(2022, 6, 2), 2022, 8, 5, "Weekday", "AM Rush (07-09)", 3, 1, 1),
        ("c", d(2022, 7, 3), 2022, 9, 1, "Weekend", "AM Rush (07-09)", 2, 3, 1),
        ("d", d(2022, 7, 4), 2022, None, 2, "Weekday", "Unknown", 3, 1, 1),
        ("e", None, 2022, 10, 2, "Weekday", "Midday (10-16)", 3, 1, None),
    ]
    return spark.createDataFrame(rows, schema)


def test_temporal_grains(spark, timed):
    mart = temporal.temporal_mart(timed)
    rows = mart.collect()
    hourly = {(r.dimension, r.day_type): r for r in rows if r.grain == "hourly"}
    assert sorted(hourly) == [("10", "Weekday"), ("8", "Weekday"), ("9", "Weekend")]
    assert hourly[("8", "Weekday")].pct_of_year_accidents == 50.0 and hourly[("8", "Weekday")].fatal_count == 1
    assert hourly[("10", "Weekday")].casualty_count is None
    periods = {(r.dimension, r.day_type): r for r in rows if r.grain == "time_period"}
    assert periods[("AM Rush (07-09)", "Weekday")].avg_severity_weight == 11.0
    monthly = {r.dimension: r for r in rows if r.grain == "monthly"}
    # The accident without an hour counts in its month, the one without a date does not.
    assert {k: v.accident_count for k, v in monthly.items()} == {"2022-06": 2, "2022-07": 2}
    assert len(mart.columns) == 11 and monthly["2022-06"].fatal_count is None


def test_monthly_trend(spark, timed):
    row = temporal.monthly_trend(timed.withColumnRenamed("accident_date", "date")).orderBy("month").first()
    assert (row.year, row.month, row.year_month, row.accident_count, row.casualty_count) == (2022, 6, "2022-06", 2, 3)
    assert row.avg_casualties_per_accident == 1.5


def test_temporal_serving(spark, timed):
    mart = temporal.temporal_mart(timed)
    hours = [r.dimension for r in serving.hourly_in_order(mart).collect()]
    assert hours == ["8", "9", "10"]
    kpis = serving.temporal_kpis(serving.of_grain(mart, "hourly")).first()
    assert (kpis.total_accidents, kpis.rush_accidents, kpis.weekend_accidents, kpis.night_accidents) == (4, 3, 1, 0)
    assert kpis.rush_pct == 75.0
    nothing = serving.temporal_kpis(mart.where("false")).first()
    assert nothing.total_accidents == 0 and nothing.rush_pct is None
    order = [r.time_period for r in serving.period_by_day_type(serving.of_grain(mart, "time_period")).collect()]
    assert order == ["AM Rush (07-09)", "AM Rush (07-09)", "Midday (10-16)"]
    assert [r.year for r in serving.available_years(mart).collect()] == [2022]
    assert serving.filter_selected_years(mart, []).count() == mart.count()
    assert [r.dimension for r in serving.monthly_in_order(mart).collect()] == ["2022-06", "2022-07"]
    assert serving.period_in_order(mart).count() == 3
    assert serving.temporal_in_order(mart).first().grain == "hourly"


def test_weekday_matrix(spark, timed):
    rows = serving.hour_by_weekday(timed).collect()
    assert [r.weekday_name for r in rows] == ["Monday", "Wednesday", "Thursday", "Sunday"]
    assert rows[0].h10 == 1 and rows[0].h08 == 0 and len(rows[0]) == 25


def test_histogram(spark):
    df = spark.createDataFrame([(0, 1), (10, 5), (39, 10), (40, 10)], "weighted_risk_score bigint, risk_decile int")
    assert sorted((r.bin, r.risk_decile, r.stations) for r in serving.score_histogram(df).collect()) == [
        (1, 1, 1),
        (11, 5, 1),
        (40, 10, 2),
    ]
    one = serving.score_histogram(df.where("weighted_risk_score = 10")).first()
    assert one.bin == 1


def test_top_n_is_at_least_one(spark):
    df = spark.createDataFrame([(1, 1, 2), (2, 1, 3)], "risk_rank int, station_a_id int, station_b_id int")
    assert serving.top_corridors(df, 0).count() == 1
    assert serving.top_corridors(df, 5).count() == 2


def test_density_layer_keeps_all_weight(spark, accidents_of):
    points = accidents_of([("a", -0.1, 51.5, 1, 1), ("b", -0.1, 51.5, 2, 1), ("c", 0.1, 51.5, 3, 1), ("d", None, 51.5, 1, 1)])
    labelled = points.withColumn("severity_label", F.expr("CASE accident_severity WHEN 1 THEN 'Fatal' WHEN 2 THEN 'Serious' ELSE '?' END"))
    layer = serving.density_layer(labelled, Grid(0.0075, 0.005), serving.label_weight())
    assert sorted(r.weight for r in layer.collect()) == [1, 13]
    assert sorted(r.weight for r in serving.density_layer(labelled, Grid(0.0075, 0.005)).collect()) == [1, 2]


def test_quality_counts(spark):
    rows = [(1, 1.0, None), (1, None, 2.0), (None, 1.0, None), (2, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "rental_id bigint, start_station_id double, end_station_id double")
    got = {r.check_name: (r.severity, r.n_failing) for r in quality.check_journeys(df).collect()}
    assert got == {
        "not_null:rental_id": ("error", 1),
        "not_null:start_station_id": ("error", 1),
        "not_null:end_station_id": ("warn", 2),
        "unique:rental_id": ("error", 1),
    }
    bad = spark.createDataFrame([("a", 1), ("b", 4), ("c", None)], "collision_index string, collision_severity int")
    got = {r.check_name: r.n_failing for r in quality.check_collisions(bad).collect()}
    assert got["accepted_values:collision_severity"] == 1


def test_table_checks_read_it_once(spark, tmp_path):
    rows = [(k if k else None, k % 7 if k % 5 else None) for k in [*range(40), *range(10), 0, 0]]
    schema = "rental_id bigint, start_station_id int"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/t")
    checks = [quality.not_null("rental_id"), quality.not_null("start_station_id", "warn")]
    for df in (spark.read.parquet(f"{tmp_path}/t"), spark.createDataFrame([], schema)):
        got = quality.check_table(df, checks, "rental_id")
        apart = quality.check_rows(df, checks).unionByName(quality.unique(df, "rental_id"))
        assert sorted(got.collect()) == sorted(apart.collect())
    plan = quality.check_table(spark.read.parquet(f"{tmp_path}/t"), checks, "rental_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
