"""Regular longitude/latitude cells: the equi-join key of every distance join.

A distance predicate on its own becomes a nested loop. Here each shape (disc,
capsule, box) is exploded to the cells that it can reach, each point lies in
exactly one cell, and the join runs on the cell. The covers are complete by
construction: cell limits come from the shape's own extent, and the cell index
is a monotone function of the coordinate.
"""

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions.geo import METRICS, segment_plane, squared_segment_gap

# Covers are widened by this factor so that rounding can never lose a cell.
SLACK = 1.001

# Columns that with_plane adds to segments.
PLANE = ["_per_lon", "_dx", "_dy"]


# A cell has CHILDREN × CHILDREN children in the next finer grid, a power of two.
CHILD_BITS = 3
CHILDREN = 1 << CHILD_BITS
FINER_GRIDS = 2


@dataclass(frozen=True)
class Grid:
    """Cells of ``step_lon`` × ``step_lat`` degrees, counted from a fixed origin.

    With ``shift``, a cell is the index in a finer grid shifted right: a point
    then lies in a cell exactly if it lies in one of the cell's children, which
    two separate divisions would not guarantee at the borders.
    """

    step_lon: float
    step_lat: float
    shift: int = 0
    origin_lon: float = C.LON_MIN
    origin_lat: float = C.LAT_MIN

    @classmethod
    def of_side(cls, metres: float, latitude: float = C.LAT_MAX) -> "Grid":
        """Cells of about ``metres`` on each side, twice divisible. Only speed depends on ``latitude``."""
        step_lat = metres / C.METRES_PER_DEGREE
        return cls(step_lat / math.cos(math.radians(latitude)), step_lat, FINER_GRIDS * CHILD_BITS)

    def finer(self) -> "Grid":
        return replace(
            self,
            step_lon=self.step_lon / CHILDREN,
            step_lat=self.step_lat / CHILDREN,
            shift=self.shift - CHILD_BITS,
        )

    def _index(self, offset: Column, step: float) -> Column:
        fine = F.floor(offset / F.lit(step / (1 << self.shift))).cast("bigint")
        return F.shiftright(fine, self.shift) if self.shift else fine

    def column_of(self, lon: Column) -> Column:
        return self._index(lon - F.lit(self.origin_lon), self.step_lon)

    def row_of(self, lat: Column) -> Column:
        return self._index(lat - F.lit(self.origin_lat), self.step_lat)

    def centre_lon(self, column: Column) -> Column:
        return F.lit(self.origin_lon) + (column + F.lit(0.5)) * F.lit(self.step_lon)

    def centre_lat(self, row: Column) -> Column:
        return F.lit(self.origin_lat) + (row + F.lit(0.5)) * F.lit(self.step_lat)

    def locate(self, df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
        return df.withColumns({"cell_x": self.column_of(F.col(lon)), "cell_y": self.row_of(F.col(lat))})


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Distribute a small table before it is exploded to many rows per row.

    By key, or evenly without one. The explicit count keeps adaptive execution from merging the partitions
    again: it would judge them by their size before the explosion.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def with_plane(segments: DataFrame) -> DataFrame:
    plane = segment_plane(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    return segments.withColumns(dict(zip(PLANE, plane)))


def gap_to_segment(lon: Column, lat: Column) -> Column:
    """Squared metres to the segment of a row that :func:`with_plane` prepared."""
    return squared_segment_gap(lon, lat, F.col("lon_a"), F.col("lat_a"), *(F.col(c) for c in PLANE))


def _classify(df: DataFrame, distance: Column, half_diagonal: Column, limit: float) -> DataFrame:
    """Drop cells out of reach and mark those that lie within ``limit`` as a whole.

    By the triangle inequality no point of a cell is nearer than the centre's
    distance minus half the diagonal, or farther than their sum.
    """
    return (
        df.withColumns({"_d": distance, "_h": half_diagonal * F.lit(SLACK)})
        .where(F.col("_d") - F.col("_h") <= F.lit(limit * SLACK))
        .withColumn("whole", F.col("_d") + F.col("_h") <= F.lit(limit / SLACK))
        .drop("_d", "_h")
    )


def _with_row_cosine(rows: DataFrame, grid: Grid) -> DataFrame:
    """Cosine of each row's centre latitude, taken before the row is exploded to its cells."""
    return rows.withColumn("_cos_row", F.cos(F.radians(grid.centre_lat(F.col("cell_y")))))


def child_cells(cells: DataFrame, finer: Grid) -> DataFrame:
    """The children of each cell, in the next finer grid."""
    steps = F.sequence(F.lit(0).cast("bigint"), F.lit(CHILDREN - 1).cast("bigint"))
    rows = cells.withColumn("_j", F.explode(steps))
    rows = rows.withColumn("cell_y", F.col("cell_y") * F.lit(CHILDREN) + F.col("_j")).drop("_j")
    children = _with_row_cosine(rows, finer).withColumn("_i", F.explode(steps))
    return children.withColumn("cell_x", F.col("cell_x") * F.lit(CHILDREN) + F.col("_i")).drop("_i")


def classify_disc(cells: DataFrame, grid: Grid, radius_m: float, metric: str = "great_circle") -> DataFrame:
    """Keep the cells in reach of the row's site, with the flag ``whole``.

    For small arcs the haversine is a plain square root with one cosine per
    end, which are columns here; the difference is far below the slack.
    """
    dx = grid.centre_lon(F.col("cell_x")) - F.col("longitude")
    dy = grid.centre_lat(F.col("cell_y")) - F.col("latitude")
    half_x, half_y = F.lit(grid.step_lon / 2), F.lit(grid.step_lat / 2)
    scale = C.PLANAR_METRES_PER_DEGREE
    if metric == "great_circle":
        scale = C.METRES_PER_DEGREE
        dx = dx * F.sqrt(F.col("_cos_site") * F.col("_cos_row"))
        # Nowhere in the cell is the cosine larger than at its centre plus half the height in radians.
        half_x = half_x * (F.col("_cos_row") + F.lit(math.radians(grid.step_lat / 2)))
    centre = F.sqrt(dx * dx + dy * dy) * F.lit(scale)
    half_diagonal = F.sqrt(half_x * half_x + half_y * half_y) * F.lit(scale)
    return _classify(cells, centre, half_diagonal, radius_m).drop("_cos_row")


def disc_cells(sites: DataFrame, grid: Grid, radius_m: float, metric: str = "great_circle") -> DataFrame:
    """Cells in reach of each site (``longitude``, ``latitude``), with the flag ``whole``."""
    lon, lat = F.col("longitude"), F.col("latitude")
    if metric == "great_circle":
        reach_lat = F.lit(radius_m / C.METRES_PER_DEGREE * SLACK)
        reach_lon = reach_lat / F.cos(F.radians(F.abs(lat) + reach_lat))
    elif metric == "planar_deg":
        reach_lat = reach_lon = F.lit(radius_m / C.PLANAR_METRES_PER_DEGREE * SLACK)
    else:
        raise ValueError(f"no disc cover for metric {metric!r}")
    sites = sites.withColumn("_cos_site", F.cos(F.radians(lat)))
    rows = sites.withColumn("cell_y", F.explode(F.sequence(grid.row_of(lat - reach_lat), grid.row_of(lat + reach_lat))))
    cells = _with_row_cosine(rows, grid).withColumn(
        "cell_x", F.explode(F.sequence(grid.column_of(lon - reach_lon), grid.column_of(lon + reach_lon)))
    )
    return classify_disc(cells, grid, radius_m, metric)


def classify_capsule(cells: DataFrame, grid: Grid, buffer_m: float) -> DataFrame:
    """Keep the cells in reach of the row's segment, with the flag ``whole``."""
    half_x = F.lit(grid.step_lon / 2) * F.col("_per_lon")
    half_y = F.lit(grid.step_lat / 2 * C.METRES_PER_DEGREE)
    centre = F.sqrt(gap_to_segment(grid.centre_lon(F.col("cell_x")), grid.centre_lat(F.col("cell_y"))))
    return _classify(cells, centre, F.sqrt(half_x * half_x + half_y * half_y), buffer_m).drop("_cos_row")


def _chord(y: Column, radius: float, right: bool) -> Column:
    """Where the capsule around a row's segment ends at height ``y``, to the right or to the left; null beyond it.

    In metres from A, in the plane of :func:`with_plane`. The end lies on the circle around A,
    on the circle around B or on the long side between them, whichever reaches farthest.
    """
    side, r = (1.0 if right else -1.0), F.lit(radius)
    dx, dy, ux, uy = (F.col(c) for c in ("_dx", "_dy", "_ux", "_uy"))

    def circle(x: Column, height: Column) -> Column:
        rest = r * r - height * height
        return F.when(rest >= 0, x + F.lit(side) * F.sqrt(rest))

    # The long side is the segment moved by the radius along its normal (|uy|, -ux * sign(uy)).
    along = (y + F.lit(side) * r * ux * F.signum(uy)) / uy
    on_side = F.when(along.between(0, F.col("_length")), along * ux + F.lit(side) * r * F.abs(uy))
    reached = [circle(F.lit(0.0), y), circle(dx, y - dy), on_side]
    return (F.greatest if right else F.least)(*reached)


def capsule_cells(segments: DataFrame, grid: Grid, buffer_m: float) -> DataFrame:
    """Cells within ``buffer_m`` of each segment prepared by :func:`with_plane`, with the flag ``whole``.

    Row by row, from where the capsule begins and ends in it: a capsule is convex, so the
    cells of a row that it touches lie side by side, and so do those that lie inside. They
    are told by their number, and a long diagonal costs its length and not its bounding box.
    """
    lon_a, lat_a, lat_b, dx, dy = (F.col(c) for c in ("lon_a", "lat_a", "lat_b", "_dx", "_dy"))
    metres, outer, inner = F.lit(C.METRES_PER_DEGREE), buffer_m * SLACK, buffer_m / SLACK
    reach_lat = F.lit(outer / C.METRES_PER_DEGREE)
    # Without a direction there are no long sides: null is passed over by the least and the greatest.
    ends = segments.withColumn("_length", F.sqrt(dx * dx + dy * dy)).withColumns(
        {"_ux": F.when(F.col("_length") > 0, dx / F.col("_length")), "_uy": F.when(dy != 0, dy / F.col("_length"))}
    )
    rows = ends.withColumn(
        "cell_y",
        F.explode(
            F.sequence(
                grid.row_of(F.least(lat_a, lat_b) - reach_lat),
                grid.row_of(F.greatest(lat_a, lat_b) + reach_lat),
            )
        ),
    )
    half_row = F.lit(grid.step_lat * SLACK / 2)
    centre = grid.centre_lat(F.col("cell_y")) - lat_a
    rows = rows.withColumns({"_south": (centre - half_row) * metres, "_north": (centre + half_row) * metres})

    # A row is widest at the height of the end that lies farthest out, or as near to it as it comes.
    def nearest_to(height: Column) -> Column:
        return F.greatest("_south", F.least("_north", height))

    left, right = F.when(dx < 0, dy).otherwise(F.lit(0.0)), F.when(dx > 0, dy).otherwise(F.lit(0.0))
    rows = rows.withColumns({"_left": nearest_to(left), "_right": nearest_to(right)})
    south, north = F.col("_south"), F.col("_north")
    rows = rows.withColumns(
        {
            "_x0": _chord(F.col("_left"), outer, False),
            "_x1": _chord(F.col("_right"), outer, True),
            # A cell lies inside with its four corners; a row that ends beyond the capsule has none inside.
            "_w0": _chord(south, inner, False),
            "_w1": _chord(south, inner, True),
            "_w2": _chord(north, inner, False),
            "_w3": _chord(north, inner, True),
        }
    )

    def column(x: Column) -> Column:
        return grid.column_of(lon_a + x / F.col("_per_lon"))

    inside = F.col("_w0").isNotNull() & F.col("_w1").isNotNull() & F.col("_w2").isNotNull() & F.col("_w3").isNotNull()
    rows = rows.select(
        *segments.columns,
        "cell_y",
        column(F.col("_x0")).alias("_x0"),
        column(F.col("_x1")).alias("_x1"),
        F.when(inside, column(F.greatest("_w0", "_w2"))).alias("_w0"),
        F.when(inside, column(F.least("_w1", "_w3"))).alias("_w1"),
    )
    cells = rows.withColumn("cell_x", F.explode(F.sequence("_x0", "_x1")))
    whole = (F.col("cell_x") > F.col("_w0")) & (F.col("cell_x") < F.col("_w1"))
    return cells.withColumn("whole", F.coalesce(whole, F.lit(False))).drop("_x0", "_x1", "_w0", "_w1")


def padded_box(pad_deg: float) -> tuple[Column, Column, Column, Column]:
    """West, east, south and north edge of the box around a segment."""
    pad = F.lit(pad_deg)
    return (
        F.least("lon_a", "lon_b") - pad,
        F.greatest("lon_a", "lon_b") + pad,
        F.least("lat_a", "lat_b") - pad,
        F.greatest("lat_a", "lat_b") + pad,
    )


def classify_box(cells: DataFrame, grid: Grid) -> DataFrame:
    """Keep the cells that the row's box (``west``, ``east``, ``south``, ``north``) touches, with the flag ``whole``.

    Indexes grow with the coordinate, so a cell strictly between those of the
    two edges lies inside, without any tolerance.
    """
    x, y = F.col("cell_x"), F.col("cell_y")
    x0, x1 = grid.column_of(F.col("west")), grid.column_of(F.col("east"))
    y0, y1 = grid.row_of(F.col("south")), grid.row_of(F.col("north"))
    touched = cells.where(x.between(x0, x1) & y.between(y0, y1)).drop("_cos_row")
    return touched.withColumn("whole", (x > x0) & (x < x1) & (y > y0) & (y < y1))


def box_cells(segments: DataFrame, grid: Grid, pad_deg: float) -> DataFrame:
    west, east, south, north = padded_box(pad_deg)
    rows = segments.withColumn("cell_y", F.explode(F.sequence(grid.row_of(south), grid.row_of(north))))
    return rows.withColumn("cell_x", F.explode(F.sequence(grid.column_of(west), grid.column_of(east))))
