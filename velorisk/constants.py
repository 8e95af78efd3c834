"""Fixed values of the domain.

Everything in this module must stay equal to the published definitions of the
marts: changing a number or a label here changes results.
"""

import math

# Area of interest in WGS84 degrees, both ends inclusive.
LON_MIN, LON_MAX = -0.55, 0.30
LAT_MIN, LAT_MAX = 51.28, 51.70

# Sphere used for every great-circle figure, and its metres per degree of arc.
EARTH_RADIUS_M = 6371008.8
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0
# Metres per degree of the planar approximation.
PLANAR_METRES_PER_DEGREE = 111320.0

BLACKSPOT_RADIUS_M = 500.0
CORRIDOR_BUFFER_M = 200.0
CORRIDOR_PAD_DEG = 0.002
MIN_CORRIDOR_JOURNEYS = 100
MIN_DURATION_S = 60
MAX_DURATION_S = 86400

SEVERITY_LABELS = {1: "Fatal", 2: "Serious", 3: "Slight"}
SEVERITY_WEIGHTS = {1: 10, 2: 3, 3: 1}

# Hour ranges, both ends inclusive, in the order in which reports list them.
PERIODS = [
    ("AM Rush (07-09)", 7, 9),
    ("Midday (10-16)", 10, 16),
    ("PM Rush (17-19)", 17, 19),
    ("Evening (20-23)", 20, 23),
    ("Night (00-06)", 0, 6),
]
RUSH_PERIODS = ["AM Rush (07-09)", "PM Rush (17-19)"]
NIGHT_PERIOD = "Night (00-06)"

# Day-of-week codes: 1 is Sunday.
WEEKDAYS = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

DECILE_COLOURS = {
    10: "#d73027",
    9: "#f46d43",
    8: "#fdae61",
    7: "#fee08b",
    6: "#ffffbf",
    5: "#d9ef8b",
    4: "#a6d96a",
    3: "#66bd63",
    2: "#1a9850",
}
LOWEST_DECILE_COLOUR = "#006837"

# Category, quantile whose value the score must exceed, line colour, line weight, opacity.
RISK_CATEGORIES = [
    ("Very High", 0.9, "#d73027", 9, 0.90),
    ("High", 0.7, "#fc8d59", 6, 0.80),
    ("Medium", 0.4, "#fee08b", 4, 0.65),
]
LOWEST_CATEGORY = ("Low", "#91cf60", 2, 0.55)
DEFAULT_LINE_WEIGHT = 4
DEFAULT_LINE_OPACITY = 0.65

BACKFILL_N_FILES = 52
BACKFILL_YEARS = [2019, 2020, 2021, 2022, 2023, 2024]
