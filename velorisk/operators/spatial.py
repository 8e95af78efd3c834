"""Distance joins, as pairs and as totals.

The joins that return pairs emit the matches and nothing else. The totals never
form the pairs: points are summed per location first, cells that lie inside a
shape contribute their sum in one row, and only the cells on its edge are
compared point by point.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions.geo import METRICS, chord_limit, squared_gap, unit_vector
from velorisk.operators.grid import (
    PLANE,
    Grid,
    box_cells,
    capsule_cells,
    child_cells,
    classify_box,
    classify_capsule,
    classify_disc,
    disc_cells,
    gap_to_segment,
    padded_box,
    spread,
    with_plane,
)
from velorisk.session import materialise

# Cells per radius (or per buffer width) for totals: finer cells leave fewer
# points to compare, coarser ones fewer cells to shuffle.
DISC_SPLITS = 6
CAPSULE_SPLITS = 1
BOX_CELL_M = 150.0
# As CAPSULE_SPLITS, for the join that returns pairs.
PAIR_SPLITS = 4
# Cells of a buffer are not made smaller than this: a narrow buffer would cross hundreds of
# cells for each kilometre, most of them empty. Crowded cells are divided all the same.
LEAST_CELL_M = 50.0
_POINTS = "_points"
# Distinct locations in a cell beyond which its children are used on an edge. It
# affects speed only: the division is part of every plan, and without such cells
# its side is empty. Cells divide FINER_GRIDS times; below, points are compared.
CROWDED = 2000


def _placed_points(points: DataFrame, grid: Grid) -> DataFrame:
    named = points.withColumnsRenamed({"longitude": "point_lon", "latitude": "point_lat"})
    named = named.where(F.col("point_lon").isNotNull() & F.col("point_lat").isNotNull())
    return grid.locate(named, "point_lon", "point_lat")


def _by_place(points: DataFrame) -> DataFrame:
    """Points stored in the order of their places; the sort of a join on cells leaves those of a cell in this order.

    The hash of the row lets the points of a hot place go to several tasks. Stored, since Spark
    leaves out a sort below a join.
    """
    here = points.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    return materialise(here.orderBy("longitude", "latitude", F.xxhash64(*here.columns)), "by-place")


def _shuffled(cover: DataFrame) -> DataFrame:
    """Keep an exploded side out of any broadcast.

    The planner knows its size before the explosion only, and would broadcast
    a table hundreds of times larger. A sort-merge join spills, and adaptive
    execution splits its skewed cells.
    """
    return cover.hint("merge")


_SITE_VECTOR = ["_sx", "_sy", "_sz"]
_POINT_VECTOR = ["_px", "_py", "_pz"]


def _site_side(sites: DataFrame, metric: str, *keys: str) -> DataFrame:
    """Sites with what the pair test needs, spread for the explosion to cells."""
    if metric == "great_circle":
        vector = unit_vector(F.col("longitude"), F.col("latitude"))
        sites = sites.withColumns(dict(zip(_SITE_VECTOR, vector)))
    return spread(sites, *keys)


def _point_side(points: DataFrame, metric: str) -> DataFrame:
    if metric == "great_circle":
        vector = unit_vector(F.col("point_lon"), F.col("point_lat"))
        points = points.withColumns(dict(zip(_POINT_VECTOR, vector)))
    return points


def _within(radius_m: float, metric: str) -> Column:
    """Pair test between a site and a point, without trigonometry."""
    if metric == "great_circle":
        gap = squared_gap([F.col(c) for c in _SITE_VECTOR], [F.col(c) for c in _POINT_VECTOR])
        return gap <= F.lit(chord_limit(radius_m))
    gap = squared_gap([F.col("longitude"), F.col("latitude")], [F.col("point_lon"), F.col("point_lat")])
    return gap <= F.lit((radius_m / C.PLANAR_METRES_PER_DEGREE) ** 2)


# ---------------------------------------------------------------- pairs


# Points in a cell beyond which a pair join deals them to several tasks. It affects speed only.
CROWDED_PAIRS = 20_000


def crowded_cells(placed: DataFrame, least: int) -> DataFrame:
    """Cells with more than ``least`` points that one task should not meet alone, and into how many parts (``_parts``) they go.

    The fullest ones, four for each shuffle partition, so that the table can be broadcast
    whatever the number of points: no other cell holds more than a quarter of a task's even
    share. Their parts are in proportion to their points, eight for each partition in all.
    """
    most = 4 * int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = placed.groupBy("cell_x", "cell_y").agg(F.count(F.lit(1)).alias("_points"))
    fullest = counted.where(F.col("_points") > least).orderBy(F.desc("_points"), "cell_x", "cell_y").limit(most)
    everything = F.sum("_points").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = F.least(F.ceil(F.col("_points") / least), F.ceil(F.col("_points") * most / everything))
    return fullest.select("cell_x", "cell_y", parts.cast("int").alias("_parts"))


def _dealt(rows: DataFrame, crowded: DataFrame, by: Sequence[str], part: str) -> DataFrame:
    """Rows with the part of their cell that they belong to: crowded cells deal them by a hash of ``by``."""
    number = F.pmod(F.xxhash64(*by), F.coalesce("_parts", F.lit(1))).cast("int")
    return rows.join(crowded, ["cell_x", "cell_y"], "left").withColumn(part, number).drop("_parts")


def _copied(rows: DataFrame, crowded: DataFrame, part: str) -> DataFrame:
    """Rows once for each part of their cell."""
    numbers = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return rows.join(crowded, ["cell_x", "cell_y"], "left").withColumn(part, F.explode(numbers)).drop("_parts")


def _pairs_in_cells(cover: DataFrame, placed: DataFrame, is_hit: Column, crowded: int) -> DataFrame:
    """Shapes with the points of their cells that pass the test. A crowded cell's points are dealt to several tasks by a
    hash of their row, and the shapes over it go to each of these."""
    cell = ["cell_x", "cell_y"]
    heavy = F.broadcast(crowded_cells(placed.select(*cell), crowded))
    dealt, copied = _dealt(placed, heavy, placed.columns, "_part"), _copied(cover, heavy, "_part")
    return _shuffled(copied).join(dealt, [*cell, "_part"]).where(is_hit).drop(*cell, "_part")


def _pairs_by_point(cover: DataFrame, placed: DataFrame, is_hit: Column, crowded: int, keys: Sequence[str]) -> DataFrame:
    """The same pairs, with all pairs of a point in a row, for shapes that are fewer than the points of their cells.

    The join holds the shapes over a cell and reads its points one by one, so a file of the
    result has each point once, with a run of shapes that the next points repeat. The other
    way round its points recur with every shape, and their names soon outgrow the dictionary
    of a file. The shapes are dealt as the points are, by a hash of ``keys``, so that a task
    never holds those over a crowded cell together.
    """
    cell = ["cell_x", "cell_y"]
    heavy = F.broadcast(crowded_cells(placed.select(*cell), crowded))
    covered = F.broadcast(crowded_cells(cover.select(*cell), crowded))
    # Columns that both sides have stay apart until the end.
    taken = {c.lower() for c in cover.columns}
    names = {c: f"_point_{c}" if c.lower() in taken else c for c in placed.columns if c not in cell}
    points = _copied(_dealt(placed, heavy, placed.columns, "_part"), covered, "_group").withColumnsRenamed(names)
    shapes = _dealt(_copied(cover, heavy, "_part"), covered, keys, "_group")
    pairs = points.join(_shuffled(shapes), [*cell, "_part", "_group"]).where(is_hit)
    return pairs.select(*[c for c in cover.columns if c not in cell], *[F.col(n).alias(c) for c, n in names.items()])


def radius_join(
    sites: DataFrame,
    points: DataFrame,
    radius_m: float = C.BLACKSPOT_RADIUS_M,
    metric: str = "great_circle",
    site_key: str = "station_id",
    how: str = "left",
    crowded: int = CROWDED_PAIRS,
    ordered: bool = False,
) -> DataFrame:
    """Points within ``radius_m`` of each site; a left join keeps sites without any.

    Sites and points carry ``longitude`` and ``latitude``; those of the point come
    back as ``point_lon`` and ``point_lat``, next to ``distance_m``. All pairs of a point
    come in a row; with ``ordered`` the points of one place follow each other, each with the
    same sites at the same distances, which a written result packs. All columns of the points
    are stored for it, so they should be few, and where the pairs are not kept it isn't worth its cost.
    """
    grid = Grid.of_side(radius_m)
    if ordered:
        points = _by_place(points)
    distance = METRICS[metric](F.col("longitude"), F.col("latitude"), F.col("point_lon"), F.col("point_lat"))
    cover = disc_cells(_site_side(sites, metric, site_key), grid, radius_m, metric)
    placed = _point_side(_placed_points(points, grid), metric)
    pairs = (
        _pairs_by_point(cover, placed, _within(radius_m, metric), crowded, [site_key, "longitude", "latitude"])
        .drop("whole", "_cos_site", *_SITE_VECTOR, *_POINT_VECTOR)
        .withColumn("distance_m", distance)
    )
    if how == "inner":
        return pairs
    return _with_lonely(sites, pairs, _reached(cover, placed, _within(radius_m, metric), [site_key]), [site_key])


def _reached(cover: DataFrame, placed: DataFrame, is_hit: Column, keys: Sequence[str]) -> DataFrame:
    """Keys of the shapes with a point, more than once. No pair is formed: a cell inside a shape answers with its first
    point, a cell on the edge with the first that passes the test."""
    points = placed.withColumnsRenamed({"cell_x": "_point_x", "cell_y": "_point_y"})
    here = (F.col("cell_x") == F.col("_point_x")) & (F.col("cell_y") == F.col("_point_y"))
    return _shuffled(cover).join(points, here & (F.col("whole") | is_hit), "left_semi").select(*keys)


def _with_lonely(shapes: DataFrame, pairs: DataFrame, reached: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The pairs, and every shape that is not ``reached``."""
    # A shape's cells collapse to one key on the map side.
    lonely = shapes.join(reached.distinct().hint("merge"), list(keys), "left_anti")
    return pairs.unionByName(lonely, allowMissingColumns=True)


def box_join(
    segments: DataFrame,
    points: DataFrame,
    pad_deg: float = C.CORRIDOR_PAD_DEG,
    segment_keys: Sequence[str] = ("station_a_id", "station_b_id"),
    crowded: int = CROWDED_PAIRS,
) -> DataFrame:
    """Points inside the bounding box of each segment, widened by ``pad_deg``.

    Pairs come cell by cell, and in a cell shape by shape, each with the same points in the
    same order. The cells are small, so that this run of points stays short where points are
    dense: a written result then holds it many times in one page, and packs it well.
    """
    grid = Grid.of_side(BOX_CELL_M)
    west, east, south, north = padded_box(pad_deg)
    inside = F.col("point_lon").between(west, east) & F.col("point_lat").between(south, north)
    return _pairs_in_cells(box_cells(spread(segments, *segment_keys), grid, pad_deg), _placed_points(points, grid), inside, crowded)


def buffer_join(
    segments: DataFrame,
    points: DataFrame,
    buffer_m: float = C.CORRIDOR_BUFFER_M,
    segment_keys: Sequence[str] = ("station_a_id", "station_b_id"),
    how: str = "left",
    crowded: int = CROWDED_PAIRS,
    splits: int = PAIR_SPLITS,
    ordered: bool = True,
) -> DataFrame:
    """Points within ``buffer_m`` of each segment A–B.

    Pairs come cell by cell, and in a cell segment by segment, as in :func:`box_join`: the run
    of points that a segment repeats is short if the cells are small (``splits``), and with
    ``ordered`` those of one place, which are equally far away, follow each other in it. A written
    result packs both. Where the pairs are not kept, neither is worth its cost.
    """
    gap = gap_to_segment(F.col("point_lon"), F.col("point_lat"))
    near = gap <= F.lit(float(buffer_m) ** 2)
    ends = with_plane(spread(segments, *segment_keys))
    if ordered:
        points = _by_place(points)

    def sides(parts: int) -> tuple[DataFrame, DataFrame]:
        grid = Grid.of_side(max(buffer_m / parts, LEAST_CELL_M))
        return capsule_cells(ends, grid, buffer_m), _placed_points(points, grid)

    pairs = _pairs_in_cells(*sides(splits), near, crowded).withColumn("distance_m", F.sqrt(gap)).drop("whole", *PLANE)
    if how == "inner":
        return pairs
    # No pair is formed here, so wide cells do, and fewer of them are shuffled.
    return _with_lonely(segments, pairs, _reached(*sides(CAPSULE_SPLITS), near, segment_keys), segment_keys)


# Points found at the first reach, for each one wanted, beyond which a smaller reach is tried, and how often it may be
# halved. Both affect speed only.
PLENTY = 4
MOST_HALVINGS = 16


def nearest_points(
    segments: DataFrame,
    points: DataFrame,
    k: int,
    point_key: str,
    first_m: float = 50.0,
    most_m: float = 1600.0,
    segment_keys: Sequence[str] = ("station_a_id", "station_b_id"),
) -> DataFrame:
    """The ``k`` points nearest to each segment A–B within ``most_m``, with ``distance_m`` and ``place`` from 1.

    Of equal distances the smaller ``point_key`` comes first; a segment with fewer points
    in reach has fewer rows. The reach is doubled, from ``first_m`` on, for the segments
    that have not found ``k`` points, which is counted without forming pairs; where it finds
    many, it is halved by as much as their number tells, and doubled again from there. So a
    segment meets few points beyond those it keeps, however dense they are, and the result
    has at most ``k`` rows for each. Points of one place are all as far away, so only the
    ``k`` smallest keys of a place take part.
    """
    keys, found = list(segment_keys), []
    by_place = Window.partitionBy("longitude", "latitude").orderBy(point_key)
    near = points.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    near = near.withColumn("_place", F.row_number().over(by_place)).where(F.col("_place") <= k).drop("_place")
    near = materialise(near, "nearest-points")
    by_distance = Window.partitionBy(*keys).orderBy("distance_m", point_key)

    def counted(some: DataFrame, reach: float) -> DataFrame:
        totals = buffer_totals(some, near, {"_found": F.lit(1).cast("bigint")}, reach, keys)
        return materialise(some.join(totals, keys, "left").fillna(0, ["_found"]), "reach")

    def keep(ready: DataFrame, reach: float) -> None:
        pairs = buffer_join(ready.select(*segments.columns), near, reach, keys, "inner", splits=CAPSULE_SPLITS, ordered=False)
        found.append(pairs.withColumn("place", F.row_number().over(by_distance)).where(F.col("place") <= k))

    reach = min(first_m, most_m)
    at_first = counted(segments, reach)
    # A narrow buffer holds points in proportion to its width, or less: a halving too many is made good by a doubling.
    halvings = F.floor(F.log2(F.col("_found") / F.lit(float(PLENTY * k)))).cast("int") + F.lit(1)
    halvings = F.when(F.col("_found") <= F.lit(PLENTY * k), F.lit(0)).otherwise(F.least(halvings, F.lit(MOST_HALVINGS)))
    enough = at_first.where(F.col("_found") >= k).withColumn("_halvings", halvings).drop("_found")
    steps = {r["_halvings"] for r in enough.select("_halvings").distinct().collect()}  # at most MOST_HALVINGS + 1 numbers
    left = None
    for step in range(max(steps, default=0), 0, -1):
        begun = enough.where(F.col("_halvings") == step).drop("_halvings")
        tried = counted(begun if left is None else left.unionByName(begun), reach / 2**step)
        keep(tried.where(F.col("_found") >= k), reach / 2**step)
        left = tried.where(F.col("_found") < k).drop("_found")
    ready = enough.where(F.col("_halvings") == 0).drop("_halvings")
    keep(ready if left is None else ready.unionByName(left), reach)

    waiting = at_first.where(F.col("_found") < k).drop("_found")
    while not waiting.isEmpty():
        last = reach >= most_m
        if last:
            keep(waiting, reach)
            break
        reach = min(reach * 2, most_m)
        if reach >= most_m:
            continue
        tried = counted(waiting, reach)
        keep(tried.where(F.col("_found") >= k), reach)
        waiting = tried.where(F.col("_found") < k).drop("_found")
    together = found[0]
    for part in found[1:]:
        together = together.unionByName(part)
    return together


# ---------------------------------------------------------------- totals


def _sums(names: Sequence[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _stored_locations(points: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row per distinct coordinate pair, stored, since it is read several times.

    Partial sums collapse a hot spot before the shuffle.
    """
    sums = (
        points.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
        .groupBy(F.col("longitude").alias("point_lon"), F.col("latitude").alias("point_lat"))
        .agg(*[F.sum(expression).alias(name) for name, expression in measures.items()])
    )
    return materialise(sums, "locations")


def _covered_totals(
    cover: DataFrame,
    located: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    names: Sequence[str],
    is_hit: Column,
    classify: Callable[[DataFrame, Grid], DataFrame],
    crowded: int,
    divisible: Column | None = None,
    inner: bool = False,
) -> DataFrame:
    """Sum ``names`` over the located points of each cover: whole cells by their total, others by test.

    Where a cell on an edge holds more than ``crowded`` locations, its children
    take its place: most of them are inside or outside as a whole, so a hot
    cell does not meet every shape near it point by point.
    """
    cell = ["cell_x", "cell_y"]
    per_cell = located.groupBy(*cell).agg(*_sums(names), F.count(F.lit(1)).alias("_locations"))
    if not inner:
        # Read by the totals and twice to find crowded cells; finer grids hold few points.
        per_cell = materialise(per_cell, "cells")
    heavy = per_cell.where(F.col("_locations") > F.lit(crowded)).select(*cell)
    if divisible is not None:
        heavy = heavy.where(divisible)
    divide = grid.shift > 0

    singles = located.join(heavy, cell, "left_anti") if divide else located
    totals = per_cell.drop("_locations").withColumn("whole", F.lit(True))
    both = singles.withColumn("whole", F.lit(False)).unionByName(totals, allowMissingColumns=True)
    sums = (
        _shuffled(cover)
        .join(both, [*cell, "whole"])
        .where(F.col("whole") | is_hit)
        .groupBy(*keys)
        .agg(*_sums(names))
    )
    if not divide:
        return sums
    finer = grid.finer()
    edges = _shuffled(cover.where(~F.col("whole")).drop("whole")).join(heavy, cell)
    inside = _covered_totals(
        classify(child_cells(edges, finer), finer),
        finer.locate(located.join(heavy, cell, "left_semi").drop(*cell), "point_lon", "point_lat"),
        finer,
        keys,
        names,
        is_hit,
        classify,
        crowded,
        inner=True,
    )
    return sums.unionByName(inside).groupBy(*keys).agg(*_sums(names))


def radius_totals(
    sites: DataFrame,
    points: DataFrame,
    measures: dict[str, Column],
    radius_m: float = C.BLACKSPOT_RADIUS_M,
    metric: str = "great_circle",
    splits: int = DISC_SPLITS,
    crowded: int = CROWDED,
) -> DataFrame:
    """Sums of ``measures`` over the points within ``radius_m``, for every site location in reach of one.

    The result is keyed on ``longitude`` and ``latitude``: sites that share a
    location share the work.
    """
    grid = Grid.of_side(radius_m / splits)
    places = _site_side(sites.select("longitude", "latitude").distinct(), metric)
    return _covered_totals(
        disc_cells(places, grid, radius_m, metric),
        grid.locate(_point_side(_stored_locations(points, measures), metric), "point_lon", "point_lat"),
        grid,
        ["longitude", "latitude"],
        list(measures),
        _within(radius_m, metric),
        lambda cells, finer: classify_disc(cells, finer, radius_m, metric),
        crowded,
    )


def buffer_totals(
    segments: DataFrame,
    points: DataFrame,
    measures: dict[str, Column],
    buffer_m: float = C.CORRIDOR_BUFFER_M,
    keys: Sequence[str] = ("station_a_id", "station_b_id"),
    splits: int = CAPSULE_SPLITS,
    crowded: int = CROWDED,
) -> DataFrame:
    """Sums of ``measures`` over the points within ``buffer_m`` of each segment."""
    grid = Grid.of_side(max(buffer_m / splits, LEAST_CELL_M))
    ends = with_plane(spread(segments.select(*keys, "lon_a", "lat_a", "lon_b", "lat_b"), *keys))
    return _covered_totals(
        capsule_cells(ends, grid, buffer_m),
        grid.locate(_stored_locations(points, measures), "point_lon", "point_lat"),
        grid,
        list(keys),
        list(measures),
        gap_to_segment(F.col("point_lon"), F.col("point_lat")) <= F.lit(float(buffer_m) ** 2),
        lambda cells, finer: classify_capsule(cells, finer, buffer_m),
        crowded,
    )


def box_totals(
    segments: DataFrame,
    points: DataFrame,
    measures: dict[str, Column],
    pad_deg: float = C.CORRIDOR_PAD_DEG,
    keys: Sequence[str] = ("station_a_id", "station_b_id"),
    cell_m: float = BOX_CELL_M,
    crowded: int = CROWDED,
) -> DataFrame:
    """Sums of ``measures`` over the points in each segment's padded box.

    Cells strictly inside a box are read from running sums over the grid: four
    lookups, however large the box. The rim of cells is compared point by point.
    The grid spans the area of interest, so its size is fixed; whatever lies
    beyond falls into the outermost cells, and those always belong to a rim.
    """
    grid = Grid.of_side(cell_m)
    names = list(measures)
    last_x = int((C.LON_MAX - C.LON_MIN) / grid.step_lon)
    last_y = int((C.LAT_MAX - C.LAT_MIN) / grid.step_lat)

    def clamp(cell: Column, last: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(last), cell)).cast("bigint")

    def column_of(lon: Column) -> Column:
        return clamp(grid.column_of(lon), last_x)

    def row_of(lat: Column) -> Column:
        return clamp(grid.row_of(lat), last_y)

    names.append(_POINTS)
    located = _stored_locations(points, measures | {_POINTS: F.lit(1).cast("bigint")}).withColumns(
        {"cell_x": column_of(F.col("point_lon")), "cell_y": row_of(F.col("point_lat"))}
    )
    west, east, south, north = padded_box(pad_deg)
    boxes = spread(segments, *keys).select(
        *keys,
        west.alias("west"),
        east.alias("east"),
        south.alias("south"),
        north.alias("north"),
        column_of(west).alias("x0"),
        column_of(east).alias("x1"),
        row_of(south).alias("y0"),
        row_of(north).alias("y1"),
    )

    # Running sums: P(x, y) = total of the cells at or below x and at or below y.
    cell_sums = located.groupBy("cell_x", "cell_y").agg(*_sums(names))
    every_cell = segments.sparkSession.range((last_x + 1) * (last_y + 1)).select(
        (F.col("id") % F.lit(last_x + 1)).alias("cell_x"),
        F.floor(F.col("id") / F.lit(last_x + 1)).cast("bigint").alias("cell_y"),
    )
    dense = every_cell.join(cell_sums, ["cell_x", "cell_y"], "left").fillna(0, names)
    along = Window.partitionBy("cell_y").orderBy("cell_x").rowsBetween(Window.unboundedPreceding, 0)
    upward = Window.partitionBy("cell_x").orderBy("cell_y").rowsBetween(Window.unboundedPreceding, 0)
    running = dense.select("cell_x", "cell_y", *[F.sum(n).over(along).alias(n) for n in names])
    running = running.select("cell_x", "cell_y", *[F.sum(n).over(upward).alias(n) for n in names])

    def corner(x: Column, y: Column, sign: int) -> Column:
        return F.struct(x.alias("cell_x"), y.alias("cell_y"), F.lit(sign).alias("sign"))

    inner_x0, inner_x1 = F.col("x0"), F.col("x1") - F.lit(1)
    inner_y0, inner_y1 = F.col("y0"), F.col("y1") - F.lit(1)
    corners = (
        boxes.where((inner_x1 > inner_x0) & (inner_y1 > inner_y0))
        .select(
            *keys,
            F.inline(
                F.array(
                    corner(inner_x1, inner_y1, 1),
                    corner(inner_x0, inner_y1, -1),
                    corner(inner_x1, inner_y0, -1),
                    corner(inner_x0, inner_y0, 1),
                )
            ),
        )
    )
    inside = corners.join(running, ["cell_x", "cell_y"]).select(
        *keys, *[(F.col(n) * F.col("sign")).alias(n) for n in names]
    )

    rows = boxes.withColumn("cell_y", F.explode(F.sequence("y0", "y1")))
    whole_row = (F.col("cell_y") == F.col("y0")) | (F.col("cell_y") == F.col("y1"))
    rim = rows.withColumn(
        "cell_x",
        F.explode(
            F.when(whole_row, F.sequence("x0", "x1")).otherwise(F.array_distinct(F.array("x0", "x1")))
        ),
    )
    x, y = F.col("cell_x"), F.col("cell_y")
    edge = _covered_totals(
        rim.drop("x0", "x1", "y0", "y1").withColumn("whole", F.lit(False)),
        located,
        grid,
        keys,
        names,
        F.col("point_lon").between(F.col("west"), F.col("east"))
        & F.col("point_lat").between(F.col("south"), F.col("north")),
        classify_box,
        crowded,
        # The outermost cells also hold what lies beyond them, so they have no children.
        (x > 0) & (x < last_x) & (y > 0) & (y < last_y),
    )
    # The lookups give a row to every box; one without points has none in the result.
    totals = edge.unionByName(inside).groupBy(*keys).agg(*_sums(names))
    return totals.where(F.col(_POINTS) > 0).drop(_POINTS)
