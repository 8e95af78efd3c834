import math
import random

import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES
from velorisk import constants as C
from velorisk.functions import geo
from velorisk.operators import spatial
from velorisk.operators.grid import Grid

@pytest.fixture
def counts(spark):
    return {"n": F.lit(1).cast("bigint"), "weight": F.col("accident_severity")}


def random_points(seed, n, spread=0.03, clustered=0.35):
    """Points around the centre; a good third of them at one spot."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rng.random() < clustered:
            lon, lat = -0.1, 51.5
        else:
            lon, lat = -0.1 + rng.uniform(-spread, spread), 51.5 + rng.uniform(-spread, spread)
        rows.append((f"p{i}", lon, lat, rng.choice([1, 2, 3]), 1))
    return rows


def random_segments(seed, n):
    rng = random.Random(seed)

    def point():
        return -0.1 + rng.uniform(-0.03, 0.03), 51.5 + rng.uniform(-0.03, 0.03)

    rows = []
    for i in range(n):
        a, b = point(), point()
        if i % 10 == 0:
            b = a  # no length
        elif i % 10 == 1:
            b = (b[0], a[1])  # due east
        elif i % 10 == 2:
            b = (a[0], b[1])  # due north
        rows.append((i, i + 1, a[0], a[1], b[0], b[1]))
    return rows


SEGMENTS = "station_a_id bigint, station_b_id bigint, lon_a double, lat_a double, lon_b double, lat_b double"


def test_radius_in_eight_directions(spark, accidents_of, counts):
    site = spark.createDataFrame([(1, "x", -0.12, 51.5)], "station_id bigint, station_name string, longitude double, latitude double")
    rows = []
    for k in range(8):
        for d in (499, 501):
            angle = k * math.pi / 4
            lat = 51.5 + d * math.sin(angle) / C.METRES_PER_DEGREE
            lon = -0.12 + d * math.cos(angle) / C.METRES_PER_DEGREE / math.cos(math.radians((51.5 + lat) / 2))
            rows.append((f"{k}:{d}", lon, lat, 3, 1))
    points = accidents_of(rows)
    inside = {r.accident_index for r in spatial.radius_join(site, points).collect()}
    assert inside == {f"{k}:499" for k in range(8)}
    assert spatial.radius_totals(site, points, counts).first().n == 8


@pytest.mark.parametrize("metric", ["great_circle", "planar_deg"])
@pytest.mark.parametrize("radius", [60.0, 500.0, 2500.0])
def test_radius_equals_brute_force(spark, accidents_of, metric, radius, counts):
    points = accidents_of(random_points(1, 300) + [("far", 0.4, 60.0, 1, 1), ("none", None, 51.5, 1, 1)])
    sites = spark.createDataFrame(
        [(i, "s", r[1], r[2]) for i, r in enumerate(random_points(2, 40))] + [(99, "s", 0.2, 51.6)],
        "station_id bigint, station_name string, longitude double, latitude double",
    )
    distance = geo.METRICS[metric](F.col("longitude"), F.col("latitude"), F.col("plon"), F.col("plat"))
    renamed = points.withColumnsRenamed({"longitude": "plon", "latitude": "plat"})
    brute = sites.join(renamed, distance <= radius, "left")
    expected = {(r.station_id, r.accident_index) for r in brute.collect()}
    pairs = spatial.radius_join(sites, points, radius, metric).collect()
    assert len(pairs) == len(expected)
    assert {(r.station_id, r.accident_index) for r in pairs} == expected
    assert all(r.distance_m is None or r.distance_m <= radius * (1 + 1e-9) for r in pairs)

    wanted = brute.groupBy("station_id").agg(F.count("accident_index").alias("n"), F.coalesce(F.sum("accident_severity"), F.lit(0)).alias("w"))
    wanted = {tuple(r) for r in wanted.collect()}
    for crowded in (2000, 3):  # 3 divides cells down to the finest grid
        totals = spatial.radius_totals(sites, points, counts, radius, metric, crowded=crowded)
        totals = sites.join(totals, ["longitude", "latitude"], "left")
        assert {(r.station_id, r.n or 0, r.weight or 0) for r in totals.collect()} == wanted


def test_inner_radius_join_drops_lonely_sites(spark, stations, accidents_of):
    points = accidents_of([("a", -0.1149, 51.5036, 1, 2)])
    assert [r.station_id for r in spatial.radius_join(stations, points, how="inner").collect()] == [1]
    left = spatial.radius_join(stations, points).collect()
    assert sorted((r.station_id, r.accident_index) for r in left if r.accident_index) == [(1, "a")]
    assert sorted(r.station_id for r in left) == [1, 2, 3]


@pytest.mark.parametrize("buffer_m", [50.0, 200.0, 900.0])
def test_buffer_equals_brute_force(spark, accidents_of, buffer_m, counts):
    points = accidents_of(random_points(3, 300))
    segments = spark.createDataFrame(random_segments(4, 40), SEGMENTS)
    near = geo.segment_distance_m(*(F.col(c) for c in ("longitude", "latitude", "lon_a", "lat_a", "lon_b", "lat_b"))) <= buffer_m
    brute = segments.join(points, near)
    expected = {(r.station_a_id, r.accident_index) for r in brute.collect()}
    assert {(r.station_a_id, r.accident_index) for r in spatial.buffer_join(segments, points, buffer_m, how="inner").collect()} == expected
    left = spatial.buffer_join(segments, points, buffer_m)
    assert left.select("station_a_id").distinct().count() == 40
    wanted = {tuple(r) for r in brute.groupBy("station_a_id", "station_b_id").agg(F.count("*"), F.sum("accident_severity")).collect()}
    for splits, crowded in ((1, 2000), (3, 2000), (1, 3)):
        totals = spatial.buffer_totals(segments, points, counts, buffer_m, splits=splits, crowded=crowded)
        assert {(r.station_a_id, r.station_b_id, r.n, r.weight) for r in totals.collect()} == wanted


@pytest.mark.parametrize("pad,cell_m", [(0.002, 150.0), (0.0, 400.0), (0.3, 150.0)])
def test_box_equals_brute_force(spark, accidents_of, pad, cell_m, counts):
    # Includes points and boxes beyond the area of interest.
    points = accidents_of(random_points(5, 300) + [("e", 0.9, 51.5, 1, 1), ("s", -0.1, 50.0, 2, 1), ("w", -0.9, 51.6, 3, 1)])
    rows = random_segments(6, 30) + [(100, 101, -1.0, 49.9, 1.0, 52.0), (102, 103, 0.5, 51.4, 1.0, 51.6)]
    segments = spark.createDataFrame(rows, SEGMENTS)
    inside = F.col("longitude").between(F.least("lon_a", "lon_b") - pad, F.greatest("lon_a", "lon_b") + pad) & F.col(
        "latitude"
    ).between(F.least("lat_a", "lat_b") - pad, F.greatest("lat_a", "lat_b") + pad)
    brute = segments.join(points, inside)
    assert {(r.station_a_id, r.accident_index) for r in spatial.box_join(segments, points, pad).collect()} == {
        (r.station_a_id, r.accident_index) for r in brute.collect()
    }
    wanted = {tuple(r) for r in brute.groupBy("station_a_id", "station_b_id").agg(F.count("*"), F.sum("accident_severity")).collect()}
    for crowded in (2000, 2):
        totals = spatial.box_totals(segments, points, counts, pad, cell_m=cell_m, crowded=crowded).where("n > 0")
        assert {(r.station_a_id, r.station_b_id, r.n, r.weight) for r in totals.collect()} == wanted


def test_covers_work_at_other_latitudes(spark, accidents_of, counts):
    """The cell size is chosen for one latitude; completeness must not depend on it."""
    rng = random.Random(8)
    rows = [(f"p{i}", 10 + rng.uniform(-0.05, 0.05), 68 + rng.uniform(-0.02, 0.02), 1, 1) for i in range(200)]
    points = accidents_of(rows)
    sites = spark.createDataFrame([(1, "n", 10.0, 68.0)], "station_id bigint, station_name string, longitude double, latitude double")
    near = geo.haversine_m(F.lit(10.0), F.lit(68.0), F.col("longitude"), F.col("latitude")) <= 1000.0
    assert spatial.radius_totals(sites, points, counts, 1000.0).first().n == points.where(near).count()


def test_no_nested_loops_and_no_broadcast_of_covers(spark, stations, accidents_of, counts):
    points = accidents_of(random_points(9, 50))
    segments = spark.createDataFrame(random_segments(10, 5), SEGMENTS)
    for df in (
        spatial.radius_join(stations, points, how="inner"),
        spatial.radius_totals(stations, points, counts),
        spatial.buffer_totals(segments, points, counts),
        spatial.box_join(segments, points),
        spatial.box_totals(segments, points, counts),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "SortMergeJoin" in plan
        assert "Python" not in plan


def test_grid_index_is_monotone(spark):
    grid = Grid.of_side(150.0)
    rows = spark.range(2000).select((F.lit(-0.6) + F.col("id") * 0.0005).alias("lon")).select("lon", grid.column_of(F.col("lon")).alias("x"))
    xs = [r.x for r in rows.orderBy("lon").collect()]
    assert xs == sorted(xs)


def test_crowded_cell_goes_to_many_tasks(spark, accidents_of):
    """Half of the points stand in one place."""
    rows = [(f"hot{i}", -0.1, 51.5, 3, 1) for i in range(1500)] + random_points(21, 1500)
    points = accidents_of(rows).repartition(5)
    sites = spark.createDataFrame(
        [(i, "s", r[1], r[2]) for i, r in enumerate(random_points(22, 25))] + [(99, "s", -0.1005, 51.5005)],
        "station_id bigint, station_name string, longitude double, latitude double",
    )
    segments = spark.createDataFrame(random_segments(23, 15) + [(500, 501, -0.11, 51.5, -0.09, 51.5)], SEGMENTS)

    def pairs(df, key):
        return sorted((r[key], r.accident_index) for r in df.collect())

    for least in (50, 10**6):
        assert pairs(spatial.radius_join(sites, points, how="inner", crowded=least), "station_id") == pairs(
            sites.join(
                points.withColumnsRenamed({"longitude": "x", "latitude": "y"}),
                geo.haversine_m(F.col("longitude"), F.col("latitude"), F.col("x"), F.col("y")) <= C.BLACKSPOT_RADIUS_M,
            ),
            "station_id",
        )
    for join in (spatial.buffer_join, spatial.box_join):
        extra = {"how": "inner"} if join is spatial.buffer_join else {}
        assert pairs(join(segments, points, crowded=50, **extra), "station_a_id") == pairs(join(segments, points, crowded=10**6, **extra), "station_a_id")
    grid = Grid.of_side(500.0)
    placed = spatial._placed_points(points, grid)
    heavy = spatial.crowded_cells(placed, 50).collect()
    x, y = grid.column_of(F.lit(-0.1)), grid.row_of(F.lit(51.5))
    hot = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    parts = {(r.cell_x, r.cell_y): r._parts for r in heavy}
    assert parts[(hot.x, hot.y)] >= 8 and len(parts) <= 4 * 4 and sum(parts.values()) <= 8 * 4
    part = F.pmod(F.xxhash64(*placed.columns), F.lit(parts[(hot.x, hot.y)]))
    sizes = [r["count"] for r in placed.where((F.col("cell_x") == hot.x) & (F.col("cell_y") == hot.y)).groupBy(part).count().collect()]
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


@pytest.mark.parametrize("metric", ["great_circle", "planar_deg"])
def test_pairs_of_a_point_come_together(spark, accidents_of, metric):
    """A point's pairs follow each other, so that a file names it once; a shape's pairs recur in every cell."""
    points = accidents_of(random_points(25, 300, spread=0.004, clustered=0.0)).repartition(5)
    sites = spark.createDataFrame(
        [(i, "s", r[1], r[2]) for i, r in enumerate(random_points(26, 40, spread=0.004))],
        "station_id bigint, station_name string, longitude double, latitude double",
    )
    met = [r.accident_index for r in spatial.radius_join(sites, points, metric=metric, how="inner").collect()]
    runs = sum(a != b for a, b in zip(met, [None, *met]))
    assert len(met) > 5 * len(set(met)) and runs == len(set(met))


@pytest.mark.parametrize("metric", ["great_circle", "planar_deg"])
def test_pairs_of_a_place_come_together(spark, accidents_of, metric):
    """With ``ordered`` the points of one place, met in any order, follow each other, all pairs of each in a row."""
    places = [(-0.105 + i % 10 * 0.001, 51.495 + i // 10 * 0.001) for i in range(100)]
    rows = [(f"p{i}", *places[i * 7 % 100], 1, 1) for i in range(600)]
    extra = [("none", None, 51.5, 1, 1), (None, *places[0], 1, 1), ("twice", *places[0], 1, 1), ("twice", *places[0], 1, 1)]
    points = accidents_of(rows + extra).repartition(5)
    sites = spark.createDataFrame(
        [(i % 11, "s", -0.1 + i * 0.0007, 51.5 + i * 0.0003) for i in range(12)] + [(99, "s", 0.2, 51.6)],
        "station_id bigint, station_name string, longitude double, latitude double",
    )
    for how in ("left", "inner"):
        pairs = spatial.radius_join(sites, points, metric=metric, how=how, ordered=True)
        want = spatial.radius_join(sites, points, metric=metric, how=how)
        assert pairs.columns == want.columns and sorted(map(repr, pairs.collect())) == sorted(map(repr, want.collect()))
    met = [((r.point_lon, r.point_lat), r.accident_index) for r in pairs.collect()]
    for what in ([m for m in met if m[1] not in (None, "twice")], [m[0] for m in met]):
        assert sum(a != b for a, b in zip(what, [None, *what])) == len(set(what)) < len(what) / 3


def test_stored_pairs_of_a_place_come_together(spark, tmp_path):
    """As above, in the query, for accidents in the order of their ids, of which every 30th is in the same place."""
    orders = [(k + j * 1501 * 901, 7, "1995-01-01") for j in range(6) for k in range(1, 31)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    suppliers = [(k, f"Supplier#{k}") for k in range(1500)]
    spark.createDataFrame(suppliers, "s_suppkey bigint, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    got = QUERIES["jn1_radius_join"](spark, str(tmp_path)).where("accident_index IS NOT NULL")
    assert got.columns == ["station_id", "accident_index", "distance_m"]
    met = [int(r.accident_index) % (1501 * 901) for r in got.collect()]
    assert sum(a != b for a, b in zip(met, [None, *met])) == len(set(met)) < len(met) / 20


def test_box_pairs_repeat_short_runs_of_points(spark, accidents_of):
    """Boxes over dense points give them cell by cell: a box never runs through hundreds of points before the next box
    has the same ones."""
    rows = [(f"p{i}", -0.105 + i % 40 * 0.00025, 51.495 + i // 40 * 0.00025, 1, 1) for i in range(1600)]
    points = accidents_of(rows).repartition(3)
    segments = spark.createDataFrame([(i, i + 1, -0.11, 51.49, -0.09, 51.51) for i in range(12)], SEGMENTS)
    found = [(r.station_a_id, r.accident_index) for r in spatial.box_join(segments, points).collect()]
    assert sorted(found) == sorted((s, r[0]) for s in range(12) for r in rows)
    longest = run = 1
    for (a, _), (b, _) in zip(found, found[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    assert longest <= 150


def test_buffer_pairs_repeat_short_runs_of_points_by_place(spark, accidents_of):
    """Segments over dense points give them cell by cell, and the points of one place, met in any order, side by side."""
    places = [(-0.105 + i % 20 * 0.0005, 51.495 + i // 20 * 0.0005) for i in range(400)]
    rows = [(f"p{i}", *places[i * 7 % 400], 1, 1) for i in range(2400)]
    points = accidents_of(rows + [("none", None, 51.5, 1, 1), ("twice", *places[0], 1, 1), ("twice", *places[0], 1, 1)]).repartition(5)
    segments = spark.createDataFrame([(i, i + 1, -0.11, 51.49 + i * 0.0001, -0.09, 51.51) for i in range(12)], SEGMENTS)
    pairs = spatial.buffer_join(segments, points, how="inner").collect()
    near = geo.segment_distance_m(*(F.col(c) for c in ("longitude", "latitude", "lon_a", "lat_a", "lon_b", "lat_b"))) <= 200.0
    want = sorted((r.station_a_id, r.accident_index) for r in segments.join(points, near).collect())
    assert sorted((r.station_a_id, r.accident_index) for r in pairs) == want
    met = [(r.station_a_id, r.point_lon, r.point_lat) for r in pairs]
    assert sum(a != b for a, b in zip(met, [None, *met])) == len(set(met)) < len(met) / 5
    longest = run = 1
    for (a, *_), (b, *_) in zip(met, met[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    assert longest <= 50


def test_sites_of_a_crowded_cell_are_held_in_parts(spark, accidents_of):
    """Most sites stand in one place, some twice with the same key; both sides have a column of the same name."""
    rows = [(i // 2, "s", -0.1, 51.5) for i in range(400)] + [(i, "s", r[1], r[2]) for i, r in enumerate(random_points(27, 50))]
    sites = spark.createDataFrame(rows, "station_id bigint, station_name string, longitude double, latitude double")
    sites = sites.withColumn("source", F.lit("site"))
    points = accidents_of(random_points(28, 120)).withColumn("source", F.lit("point"))
    want = sites.drop("source").join(
        points.withColumnsRenamed({"longitude": "x", "latitude": "y"}),
        geo.haversine_m(F.col("longitude"), F.col("latitude"), F.col("x"), F.col("y")) <= C.BLACKSPOT_RADIUS_M,
    )
    want = sorted((r.station_id, r.accident_index) for r in want.collect())
    places = []
    for least in (20, 10**6):
        got = spatial.radius_join(sites, points, how="inner", crowded=least)
        assert [got.columns.index(c) for c in ("station_id", "accident_index")] == sorted(
            got.columns.index(c) for c in ("station_id", "accident_index")
        )
        assert got.columns.count("source") == 2
        rows = got.select("station_id", "accident_index").collect()
        assert sorted((r.station_id, r.accident_index) for r in rows) == want
        runs = sum(a.accident_index != b.accident_index for a, b in zip(rows, rows[1:]))
        places.append(runs + 1)
    # Dealt out, the sites over the crowded cell meet each of its points in several parts.
    assert places[0] > places[1] == len({a for _, a in want})


def test_shapes_without_points_are_found_without_the_pairs(spark, accidents_of):
    points = accidents_of(random_points(31, 200))
    segments = spark.createDataFrame(random_segments(32, 60), SEGMENTS)
    left = spatial.buffer_join(segments, points, 60.0)
    met = {r.station_a_id for r in spatial.buffer_join(segments, points, 60.0, how="inner").collect()}
    lonely = [r.station_a_id for r in left.where("accident_index IS NULL").collect()]
    assert sorted([*met, *lonely]) == sorted(r.station_a_id for r in segments.collect()) and met and lonely
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("k", [1, 4, 500])
def test_nearest_points_equal_brute_force(spark, accidents_of, k):
    rows = random_points(41, 250) + [(f"same{i}", -0.1, 51.5, 1, 1) for i in range(6)]
    points = accidents_of(rows)
    segments = spark.createDataFrame(random_segments(42, 25) + [(900, 901, -0.1, 51.5, -0.1, 51.5)], SEGMENTS)
    distance = geo.segment_distance_m(*(F.col(c) for c in ("longitude", "latitude", "lon_a", "lat_a", "lon_b", "lat_b")))
    every = segments.join(points, distance <= 1000).select("station_a_id", "accident_index", distance.alias("d")).collect()
    want = []
    for a in {r.station_a_id for r in every}:
        mine = sorted((r.d, r.accident_index) for r in every if r.station_a_id == a)[:k]
        want += [(a, place, index) for place, (_, index) in enumerate(mine, 1)]
    found = spatial.nearest_points(segments, points, k, "accident_index", first_m=30.0, most_m=1000.0).collect()
    assert sorted((r.station_a_id, r.place, r.accident_index) for r in found) == sorted(want)


def test_cells_of_a_capsule_are_whole_if_their_corners_are_inside(spark):
    segments = spark.createDataFrame(random_segments(51, 30), SEGMENTS)
    grid = Grid.of_side(50.0)
    cells = spatial.capsule_cells(spatial.with_plane(segments), grid, 200.0)
    corners = []
    for x in (0, 1):
        for y in (0, 1):
            lon, lat = grid.origin_lon + (F.col("cell_x") + x) * grid.step_lon, grid.origin_lat + (F.col("cell_y") + y) * grid.step_lat
            corners.append(F.sqrt(spatial.gap_to_segment(lon, lat)))
    told = cells.select("whole", F.greatest(*corners).alias("far")).collect()
    assert all(r.far <= 200.0 for r in told if r.whole)
    assert all(r.whole for r in told if r.far <= 200.0 * 0.995)
    assert any(r.whole for r in told) and not all(r.whole for r in told)


@pytest.mark.parametrize("buffer_m", [0.5, 5.0])
def test_narrow_buffer_crosses_few_cells(spark, accidents_of, counts, monkeypatch, buffer_m):
    ends = [(-0.12, 51.48, -0.08, 51.52), (-0.08, 51.5, -0.12, 51.5), (-0.1, 51.52, -0.1, 51.48)]
    segments = spark.createDataFrame([(i, i + 1, *e) for i, e in enumerate(ends)], SEGMENTS)
    rng, rows = random.Random(52), []
    for i in range(300):
        a, share = ends[i % 3], rng.random()
        aside = rng.uniform(-8, 8) / C.METRES_PER_DEGREE
        rows.append((f"p{i}", a[0] + share * (a[2] - a[0]) + aside, a[1] + share * (a[3] - a[1]) + aside, 1 + i % 3, 1))
    points, covers, make = accidents_of(rows), [], spatial.capsule_cells
    monkeypatch.setattr(spatial, "capsule_cells", lambda *a: covers.append(make(*a)) or covers[-1])
    near = geo.segment_distance_m(*(F.col(c) for c in ("longitude", "latitude", "lon_a", "lat_a", "lon_b", "lat_b"))) <= buffer_m
    brute = segments.join(points, near)
    wanted = {tuple(r) for r in brute.groupBy("station_a_id", "station_b_id").agg(F.count("*"), F.sum("accident_severity")).collect()}
    for crowded in (2000, 3):
        totals = spatial.buffer_totals(segments, points, counts, buffer_m, crowded=crowded)
        assert {(r.station_a_id, r.station_b_id, r.n, r.weight) for r in totals.collect()} == wanted
    pairs = spatial.buffer_join(segments, points, buffer_m, how="inner")
    assert sorted(r.accident_index for r in pairs.collect()) == sorted(r.accident_index for r in brute.collect())
    assert wanted and all(cover.count() < 1000 for cover in covers)


def test_nearest_points_meet_few_where_they_are_dense(spark, accidents_of, monkeypatch):
    rng = random.Random(61)
    rows = [(f"p{i:04}", -0.1 + rng.uniform(-0.01, 0.01), 51.5 + rng.uniform(-0.0004, 0.0004), 1, 1) for i in range(3000)]
    rows += [(f"same{i:03}", -0.1, 51.5, 1, 1) for i in range(400)] + [("far", -0.1, 51.507, 1, 1)]
    points = accidents_of(rows).repartition(3)
    ends = [(-0.11, 51.5, -0.09, 51.5), (-0.1, 51.5, -0.1, 51.5), (-0.11, 51.5002, -0.09, 51.5002), (-0.11, 51.507, -0.09, 51.507)]
    segments = spark.createDataFrame([(i, i + 1, *e) for i, e in enumerate(ends)], SEGMENTS)
    formed, join = [], spatial.buffer_join
    monkeypatch.setattr(spatial, "buffer_join", lambda *a, **b: formed.append(join(*a, **b)) or formed[-1])
    found = spatial.nearest_points(segments, points, 3, "accident_index", most_m=800.0).collect()
    distance = geo.segment_distance_m(*(F.col(c) for c in ("longitude", "latitude", "lon_a", "lat_a", "lon_b", "lat_b")))
    every = segments.join(points, distance <= 800).select("station_a_id", "accident_index", distance.alias("d")).collect()
    want = []
    for a in range(len(ends)):
        mine = sorted((r.d, r.accident_index) for r in every if r.station_a_id == a)[:3]
        want += [(a, place, index) for place, (_, index) in enumerate(mine, 1)]
    assert sorted((r.station_a_id, r.place, r.accident_index) for r in found) == sorted(want)
    dense = sum(pairs.where("station_a_id < 3").count() for pairs in formed)
    assert 9 <= dense <= 100
