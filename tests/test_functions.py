import math

import pytest
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk.functions import casts, geo, labels, rates


def evaluate(spark, schema, rows, **columns):
    return spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()


def test_periods_at_their_boundaries(spark):
    hours = [0, 6, 7, 9, 10, 16, 17, 19, 20, 23, 24, None]
    rows = evaluate(spark, "h int", [(h,) for h in hours], p=labels.period_of_day(F.col("h")))
    night, am, mid = "Night (00-06)", "AM Rush (07-09)", "Midday (10-16)"
    pm, late = "PM Rush (17-19)", "Evening (20-23)"
    assert [r.p for r in rows] == [night, night, am, am, mid, mid, pm, pm, late, late, "Unknown", "Unknown"]


def test_severity_of_unknown_and_null(spark):
    rows = evaluate(
        spark,
        "s bigint",
        [(1,), (2,), (3,), (9,), (None,)],
        label=labels.severity_label(F.col("s")),
        weight=labels.severity_weight(F.col("s")),
        strict=labels.scoring_weight(F.col("s")),
    )
    assert [tuple(r) for r in rows] == [
        ("Fatal", 10, 10),
        ("Serious", 3, 3),
        ("Slight", 1, 1),
        ("Slight", 1, 0),
        ("Slight", 1, 0),
    ]


def test_days(spark):
    rows = evaluate(
        spark,
        "d bigint",
        [(1,), (2,), (7,), (8,), (None,)],
        name=labels.weekday_name(F.col("d")),
        kind=labels.day_type(F.col("d")),
    )
    assert [tuple(r) for r in rows] == [
        ("Sunday", "Weekend"),
        ("Monday", "Weekday"),
        ("Saturday", "Weekend"),
        ("Unknown", "Weekday"),
        ("Unknown", "Weekday"),
    ]


def test_score_on_a_threshold_stays_below(spark):
    bands = {0.4: F.lit(4.0), 0.7: F.lit(7.0), 0.9: F.lit(9.0)}
    rows = evaluate(spark, "s double", [(4.0,), (4.1,), (7.0,), (9.0,), (9.1,)], c=labels.risk_category(F.col("s"), bands))
    assert [r.c for r in rows] == ["Low", "Medium", "Medium", "High", "Very High"]


def test_styles_of_known_and_unknown_categories(spark):
    rows = evaluate(
        spark,
        "c string",
        [("Very High",), ("Low",), ("?",), (None,)],
        colour=labels.category_colour(F.col("c")),
        weight=labels.line_weight(F.col("c")),
        opacity=labels.line_opacity(F.col("c")),
    )
    assert [tuple(r) for r in rows] == [
        ("#d73027", 9, 0.9),
        ("#91cf60", 2, 0.55),
        ("#91cf60", 4, 0.65),
        ("#91cf60", 4, 0.65),
    ]


def test_decile_colours(spark):
    rows = evaluate(spark, "d int", [(10,), (1,), (2,)], c=labels.decile_colour(F.col("d")), b=labels.is_blackspot(F.col("d")))
    assert [tuple(r) for r in rows] == [("#d73027", True), ("#006837", False), ("#1a9850", False)]


def test_lenient_casts(spark):
    rows = evaluate(
        spark,
        "v string",
        [("17",), ("17.0",), ("x",), (None,), ("9007199254740993",)],
        whole=casts.to_long(F.col("v")),
        number=casts.to_number(F.col("v")),
    )
    assert [r.whole for r in rows] == [17, 17, None, None, 9007199254740993]
    assert [r.number for r in rows][:3] == [17.0, 17.0, None]


def test_timestamps_dates_and_clocks(spark):
    stamp = casts.iso_minute_timestamp(F.col("v"))
    both = casts.iso_minute_timestamp(F.col("v"), also_day_first=True)
    rows = evaluate(
        spark,
        "v string",
        [("2023-06-01 08:05",), ("01/06/2023 08:05",), ("never",)],
        strict=F.date_format(stamp, "dd-MM HH:mm"),
        lenient=F.date_format(both, "dd-MM HH:mm"),
        date=casts.day_first_date(F.col("v")).cast("string"),
    )
    assert [r.strict for r in rows] == ["01-06 08:05", None, None]
    assert [r.lenient for r in rows] == ["01-06 08:05", "01-06 08:05", None]
    rows = evaluate(
        spark, "v string", [("01/06/2022",), ("2022-06-01",), ("31/31/2022",)], d=casts.day_first_date(F.col("v")).cast("string")
    )
    assert [r.d for r in rows] == ["2022-06-01", "2022-06-01", None]
    rows = evaluate(spark, "v string", [("08:30",), ("24:10",), ("",), (None,)], h=casts.hour_of_clock(F.col("v")))
    assert [r.h for r in rows] == [8, None, None, None]


def test_rounding_is_half_up(spark):
    rows = evaluate(
        spark, "v double", [(0.5,), (1.5,), (2.5,), (2.345,)], a=casts.round_half_up(F.col("v")), b=casts.round_half_up(F.col("v"), 1)
    )
    assert [r.a for r in rows] == [1, 2, 3, 2]
    assert rows[3].b == 2.3


def haversine(lon1, lat1, lon2, lat2):
    phi1, phi2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((phi2 - phi1) / 2) ** 2 + math.cos(phi1) * math.cos(phi2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * C.EARTH_RADIUS_M * math.asin(math.sqrt(h))


def test_distances(spark):
    args = [F.col(c) for c in ("a", "b", "c", "d")]
    points = [(-0.12, 51.5, -0.1, 51.52), (-0.12, 51.5, -0.12, 51.5), (0.0, 0.0, 180.0, 0.0)]
    rows = evaluate(
        spark,
        "a double, b double, c double, d double",
        points,
        great=geo.haversine_m(*args),
        flat=geo.equirectangular_m(*args),
        planar=geo.planar_degrees_m(*args),
    )
    for row, p in zip(rows, points):
        assert row.great == pytest.approx(haversine(*p), rel=1e-12)
    assert rows[0].flat == pytest.approx(rows[0].great, rel=2e-3)
    assert rows[0].planar == pytest.approx(math.hypot(0.02, 0.02) * 111320, rel=1e-9)
    # The planar figure overstates east–west distances.
    assert rows[0].planar > rows[0].great * 1.2


def test_segment_distance_clamps_to_the_ends(spark):
    rows = evaluate(
        spark,
        "lon double, lat double, bx double, by double",
        [
            (0.005, 0.001, 0.01, 0.0),  # beside the middle
            (-0.001, 0.0, 0.01, 0.0),  # before A
            (0.012, 0.0, 0.01, 0.0),  # beyond B
            (0.003, 0.004, 0.0, 0.0),  # no length
        ],
        d=geo.segment_distance_m(F.col("lon"), F.col("lat"), F.lit(0.0), F.lit(0.0), F.col("bx"), F.col("by")),
    )
    degree = C.METRES_PER_DEGREE
    assert [r.d / degree for r in rows] == pytest.approx([0.001, 0.001, 0.002, 0.005], rel=1e-6)


def test_rates_without_exposure(spark):
    rows = evaluate(
        spark,
        "w bigint, l double, n bigint",
        [(6, 2000.0, 3), (6, 0.0, 3), (6, 2000.0, 0)],
        km=rates.risk_per_km(F.col("w"), F.col("l")),
        composite=rates.composite_risk(F.col("w"), F.col("l"), F.col("n")),
    )
    assert [tuple(r) for r in rows] == [(3.0, 1000000.0), (0.0, 0.0), (3.0, 0.0)]
    rows = evaluate(
        spark, "s bigint, t bigint", [(5, 4), (5, 0), (5, None), (None, 4)], r=rates.risk_per_1000_trips(F.col("s"), F.col("t"))
    )
    assert [r.r for r in rows] == [1250.0, 0.0, 0.0, None]


def test_pair_and_labels(spark):
    rows = evaluate(
        spark,
        "a string, b string",
        [("Waterloo", "Victoria")],
        label=labels.corridor_label(F.col("a"), F.col("b")),
        low=rates.low_end(F.col("a"), F.col("b")),
        high=rates.high_end(F.col("a"), F.col("b")),
    )
    assert tuple(rows[0]) == ("Waterloo ↔ Victoria", "Victoria", "Waterloo")
    assert labels.title_label("risk_per_1000_trips") == "Risk Per 1000 Trips"
