"""The registered queries as SQL for an independent engine.

Written from the definitions, with nested loops instead of grids and plain
window functions instead of distributed order statistics.
"""

from velorisk import constants as C
from velorisk.derived import MIN_JOURNEYS

R = repr(C.EARTH_RADIUS_M)
DEG = repr(C.METRES_PER_DEGREE)


def haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"({2 * C.EARTH_RADIUS_M!r} * asin(sqrt(least(1e0, pow(sin(radians({lat2} - {lat1}) / 2e0), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2e0), 2)))))"
    )


def planar(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return f"(sqrt(({lon2} - {lon1}) * ({lon2} - {lon1}) + ({lat2} - {lat1}) * ({lat2} - {lat1})) * 111320e0)"


def equirectangular(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"sqrt(pow(({lon2} - {lon1}) * 111320e0 * cos(radians({lat1})), 2) + pow(({lat2} - {lat1}) * 111320e0, 2))"
    )


def to_segment(lon: str, lat: str, lon_a: str, lat_a: str, lon_b: str, lat_b: str) -> str:
    """Clamped projection on the segment."""
    k = f"({DEG} * cos(radians(({lat_a} + {lat_b}) / 2e0)))"
    dx, dy = f"(({lon_b} - {lon_a}) * {k})", f"(({lat_b} - {lat_a}) * {DEG})"
    px, py = f"(({lon} - {lon_a}) * {k})", f"(({lat} - {lat_a}) * {DEG})"
    squared = f"({dx} * {dx} + {dy} * {dy})"
    t = (
        f"(CASE WHEN {squared} > 0 THEN least(1e0, greatest(0e0, ({px} * {dx} + {py} * {dy}) / {squared}))"
        f" ELSE 0e0 END)"
    )
    return f"sqrt(pow({px} - {t} * {dx}, 2) + pow({py} - {t} * {dy}, 2))"


def half_up(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits} + 0.5e0) / 1e{digits}"


def case(value: str, choices: dict, default: str) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {k} THEN {v}" for k, v in choices.items()) + f" ELSE {default} END"


def period(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 7 AND 9 THEN 'AM Rush (07-09)' WHEN {hour} BETWEEN 17 AND 19 THEN 'PM Rush (17-19)'"
        f" WHEN {hour} BETWEEN 10 AND 16 THEN 'Midday (10-16)' WHEN {hour} BETWEEN 20 AND 23 THEN 'Evening (20-23)'"
        f" WHEN {hour} BETWEEN 0 AND 6 THEN 'Night (00-06)' ELSE 'Unknown' END"
    )


def weekday(day: str) -> str:
    return case(day, {k: f"'{v}'" for k, v in C.WEEKDAYS.items()}, "'Unknown'")


def band(score: str) -> str:
    return (
        f"CASE WHEN {score} > p90 THEN 'Very High' WHEN {score} > p70 THEN 'High'"
        f" WHEN {score} > p40 THEN 'Medium' ELSE 'Low' END"
    )


IN_BOX = "longitude BETWEEN -0.55e0 AND 0.30e0 AND latitude BETWEEN 51.28e0 AND 51.70e0"
LABEL = "CASE accident_severity WHEN 1 THEN 'Fatal' WHEN 2 THEN 'Serious' ELSE 'Slight' END"
STRICT = "CASE accident_severity WHEN 1 THEN 10 WHEN 2 THEN 3 WHEN 3 THEN 1 ELSE 0 END"
COLOUR = case("risk_decile", {k: f"'{v}'" for k, v in C.DECILE_COLOURS.items()}, "'#006837'")
CATEGORY_COLOUR = case(
    "risk_category", {"'Very High'": "'#d73027'", "'High'": "'#fc8d59'", "'Medium'": "'#fee08b'"}, "'#91cf60'"
)


def station_lon(key: str) -> str:
    return f"(-0.20e0 + (({key} * 7919) % 1501) / 10000e0)"


def station_lat(key: str) -> str:
    return f"(51.46e0 + (({key} * 104729) % 901) / 10000e0)"


BASE = {
    "raw_stations": f"""
        SELECT s_suppkey AS station_id, s_name AS station_name,
               {station_lon('s_suppkey')} AS longitude, {station_lat('s_suppkey')} AS latitude FROM supplier""",
    "raw_accidents": """
        SELECT CAST(o_orderkey AS VARCHAR) AS collision_index, o_orderkey AS k, CAST(o_orderdate AS DATE) AS date,
               CAST(year(o_orderdate) AS BIGINT) AS year,
               CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE (o_orderkey * 7 + o_custkey) % 24 END AS hour_of_day,
               CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS day_of_week,
               CAST(CASE WHEN o_orderkey % 53 = 0 THEN 1 WHEN o_orderkey % 6 = 0 THEN 2 ELSE 3 END AS BIGINT)
                 AS collision_severity,
               1 + o_custkey % 3 AS number_of_casualties, 1 + o_custkey % 2 AS number_of_vehicles,
               o_orderkey % 7 AS road_type, 20 + (o_orderkey % 5) * 10 AS speed_limit,
               o_orderkey % 4 AS light_conditions, o_orderkey % 9 AS weather_conditions,
               CASE WHEN o_orderkey % 97 = 0 THEN 2e0 WHEN o_orderkey % 101 = 0 THEN NULL
                    ELSE -0.20e0 + ((o_orderkey * 31 + o_custkey * 17) % 1501) / 10000e0 END AS longitude,
               51.46e0 + ((o_orderkey * 13 + o_custkey * 29) % 901) / 10000e0 AS latitude
        FROM orders""",
    "raw_journeys": """
        SELECT l_orderkey * 8 + l_linenumber AS rental_id, CAST(l_partkey AS VARCHAR) AS bike_id,
               l_returnflag AS bike_model, l_shipdate AS start_date,
               l_shipdate + to_seconds(CAST(floor(l_extendedprice + 0.5e0) AS BIGINT)) AS end_date,
               CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey + l_partkey % 6 ELSE l_suppkey END AS a,
               CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE l_suppkey + l_partkey % 6 END AS b,
               l_extendedprice AS duration_seconds, l_linestatus || 'JourneyDataExtract.csv' AS source_file
        FROM lineitem""",
    "named_journeys": """
        SELECT *, 'Supplier#' || lpad(CAST(a AS VARCHAR), 9, '0') AS a_name,
               'Supplier#' || lpad(CAST(b AS VARCHAR), 9, '0') AS b_name FROM raw_journeys""",
    "stg_stations": f"SELECT * FROM raw_stations WHERE {IN_BOX}",
    "stg_accidents": f"""
        SELECT collision_index AS accident_index, date AS accident_date, year, hour_of_day, day_of_week,
               collision_severity AS accident_severity,
               {LABEL.replace('accident_severity', 'collision_severity')} AS severity_label,
               number_of_casualties, number_of_vehicles, road_type, speed_limit, light_conditions,
               weather_conditions, longitude, latitude, {period('hour_of_day')} AS time_of_day_period,
               {weekday('day_of_week')} AS weekday_name,
               CASE WHEN day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
               CAST(CASE collision_severity WHEN 1 THEN 10 WHEN 2 THEN 3 ELSE 1 END AS BIGINT) AS severity_weight
        FROM raw_accidents WHERE {IN_BOX}""",
    "stg_journeys": """
        SELECT *, CAST(floor(duration_seconds + 0.5e0) AS BIGINT) AS seconds FROM named_journeys
        WHERE a <> b AND CAST(floor(duration_seconds + 0.5e0) AS BIGINT) BETWEEN 60 AND 86400""",
    "station_totals": f"""
        SELECT s.station_id, s.station_name, s.longitude, s.latitude, count(accident_index) AS accident_count,
               CAST(coalesce(sum(number_of_casualties), 0) AS BIGINT) AS total_casualties,
               count(*) FILTER (accident_severity = 1) AS fatal_count,
               count(*) FILTER (accident_severity = 2) AS serious_count,
               count(*) FILTER (accident_severity = 3) AS slight_count,
               CAST(coalesce(sum({STRICT}), 0) AS BIGINT) AS weighted_risk_score, 500e0 AS search_radius_m
        FROM stg_stations s LEFT JOIN stg_accidents p
          ON {haversine('s.longitude', 's.latitude', 'p.longitude', 'p.latitude')} <= 500
        GROUP BY ALL""",
    "volumes": """
        SELECT station_id, count(*) AS total_trips
        FROM (SELECT a AS station_id FROM stg_journeys UNION ALL SELECT b FROM stg_journeys) GROUP BY station_id""",
    "scored": f"""
        SELECT t.station_id, station_name, longitude, latitude, accident_count AS nearby_accident_count,
               total_casualties AS nearby_casualties, fatal_count AS nearby_fatal_count,
               serious_count AS nearby_serious_count, slight_count AS nearby_slight_count, weighted_risk_score,
               CASE WHEN coalesce(total_trips, 0) > 0
                    THEN {half_up('weighted_risk_score * 1000e0 / total_trips', 2)} ELSE 0e0 END AS risk_per_1000_trips,
               coalesce(total_trips, 0) AS total_trips, search_radius_m,
               ntile(10) OVER (ORDER BY weighted_risk_score, t.station_id) AS risk_decile
        FROM station_totals t LEFT JOIN volumes v ON v.station_id = t.station_id""",
    "mart_blackspot": f"SELECT *, {COLOUR} AS risk_colour, risk_decile = 10 AS is_blackspot FROM scored",
    "pairs": f"""
        SELECT least(a, b) AS station_a_id, greatest(a, b) AS station_b_id, count(*) AS journey_count
        FROM stg_journeys GROUP BY ALL HAVING count(*) >= {MIN_JOURNEYS}""",
    "corridors": f"""
        SELECT station_a_id, station_b_id, sa.station_name AS station_a_name, sb.station_name AS station_b_name,
               journey_count, sa.longitude AS lon_a, sa.latitude AS lat_a, sb.longitude AS lon_b, sb.latitude AS lat_b,
               (sa.longitude + sb.longitude) / 2e0 AS mid_lon, (sa.latitude + sb.latitude) / 2e0 AS mid_lat,
               {haversine('sa.longitude', 'sa.latitude', 'sb.longitude', 'sb.latitude')} AS length_m
        FROM pairs JOIN stg_stations sa ON sa.station_id = station_a_id
        JOIN stg_stations sb ON sb.station_id = station_b_id""",
    "buffer_pairs": f"""
        SELECT station_a_id, station_b_id, accident_index, accident_severity,
               {to_segment('longitude', 'latitude', 'lon_a', 'lat_a', 'lon_b', 'lat_b')} AS distance_m
        FROM corridors LEFT JOIN stg_accidents
          ON {to_segment('longitude', 'latitude', 'lon_a', 'lat_a', 'lon_b', 'lat_b')} <= 200""",
    "box_pairs": """
        SELECT station_a_id, station_b_id, accident_index, accident_severity FROM corridors JOIN stg_accidents
          ON longitude BETWEEN least(lon_a, lon_b) - 0.002e0 AND greatest(lon_a, lon_b) + 0.002e0
         AND latitude BETWEEN least(lat_a, lat_b) - 0.002e0 AND greatest(lat_a, lat_b) + 0.002e0""",
    "buffer_totals": f"""
        SELECT station_a_id, station_b_id, count(accident_index) AS corridor_accident_count,
               CAST(sum({STRICT}) AS BIGINT) AS corridor_risk_raw
        FROM buffer_pairs WHERE accident_index IS NOT NULL GROUP BY ALL""",
    "box_totals": f"""
        SELECT station_a_id, station_b_id, count(accident_index) AS corridor_accident_count,
               CAST(sum({STRICT}) AS BIGINT) AS corridor_risk_raw FROM box_pairs GROUP BY ALL""",
}


def risk_ctes(name: str, totals: str, length: str = "length_m", rounded: bool = False) -> dict[str, str]:
    """Corridors with totals to ranked, banded corridors."""
    composite = f"""CASE WHEN {length} > 0 AND journey_count > 0
        THEN coalesce(corridor_risk_raw, 0) / ({length} / 1000e0 * journey_count) * 1000000e0 ELSE 0e0 END"""
    if rounded:
        composite = half_up(composite, 2)
    return {
        f"{name}_risk": f"""
            SELECT c.* REPLACE ({length} AS length_m), coalesce(corridor_accident_count, 0) AS corridor_accident_count,
                   coalesce(corridor_risk_raw, 0) AS corridor_risk_raw,
                   CASE WHEN {length} > 0 THEN coalesce(corridor_risk_raw, 0) / ({length} / 1000e0) ELSE 0e0 END
                     AS risk_per_km,
                   {composite} AS composite_risk_score
            FROM corridors c LEFT JOIN {totals} t
              ON t.station_a_id = c.station_a_id AND t.station_b_id = c.station_b_id""",
        f"{name}_limits": f"""
            SELECT quantile_cont(composite_risk_score, 0.4) AS p40, quantile_cont(composite_risk_score, 0.7) AS p70,
                   quantile_cont(composite_risk_score, 0.9) AS p90 FROM {name}_risk""",
        f"{name}_ranked": f"""
            SELECT station_a_id, station_b_id, station_a_name, station_b_name, journey_count, lon_a, lat_a, lon_b,
                   lat_b, mid_lon, mid_lat, floor(length_m + 0.5e0) AS length_m, corridor_accident_count,
                   corridor_risk_raw, {half_up('risk_per_km', 2)} AS risk_per_km,
                   {half_up('composite_risk_score', 2)} AS composite_risk_score,
                   rank() OVER (ORDER BY composite_risk_score DESC) AS risk_rank,
                   {band('composite_risk_score')} AS risk_category
            FROM {name}_risk CROSS JOIN {name}_limits""",
        f"{name}_mart": f"""
            SELECT risk_rank, station_a_id, station_b_id, station_a_name, station_b_name,
                   station_a_name || ' ↔ ' || station_b_name AS corridor_label, journey_count, length_m,
                   corridor_accident_count, risk_per_km, composite_risk_score, risk_category, lon_a, lat_a, lon_b,
                   lat_b, mid_lon, mid_lat, {CATEGORY_COLOUR} AS corridor_colour FROM {name}_ranked""",
    }


BASE |= risk_ctes("buffer", "buffer_totals")
BASE |= risk_ctes("box", "box_totals", equirectangular("lon_a", "lat_a", "lon_b", "lat_b"))
BASE |= risk_ctes("rounded", "buffer_totals", rounded=True)
BASE |= {
    "hourly_counts": """
        SELECT hour_of_day, day_type, time_of_day_period, year, count(*) AS accident_count,
               CAST(sum(number_of_casualties) AS BIGINT) AS casualty_count,
               CAST(sum(severity_weight) AS BIGINT) AS total_severity_weight,
               count(*) FILTER (accident_severity = 1) AS fatal_count,
               count(*) FILTER (accident_severity = 2) AS serious_count
        FROM stg_accidents WHERE hour_of_day IS NOT NULL GROUP BY ALL""",
    "hourly": f"""
        SELECT *, {half_up('accident_count * 100e0 / sum(accident_count) OVER (PARTITION BY year)', 2)}
          AS pct_of_year_accidents FROM hourly_counts""",
    "periods": f"""
        SELECT time_of_day_period, day_type, year, CAST(sum(accident_count) AS BIGINT) AS accident_count,
               CAST(sum(casualty_count) AS BIGINT) AS casualty_count, CAST(sum(fatal_count) AS BIGINT) AS fatal_count,
               CAST(sum(serious_count) AS BIGINT) AS serious_count,
               {half_up('avg(total_severity_weight)', 2)} AS avg_severity_weight FROM hourly GROUP BY ALL""",
    "monthly": """
        SELECT strftime(accident_date, '%Y-%m') AS year_month, CAST(year(accident_date) AS BIGINT) AS year,
               count(*) AS accident_count, CAST(sum(number_of_casualties) AS BIGINT) AS casualty_count
        FROM stg_accidents GROUP BY ALL""",
    "mart_temporal": """
        SELECT 'hourly' AS grain, CAST(hour_of_day AS VARCHAR) AS dimension, day_type, time_of_day_period, year,
               accident_count, casualty_count, fatal_count, serious_count, pct_of_year_accidents,
               CAST(NULL AS DOUBLE) AS avg_severity_weight FROM hourly
        UNION ALL
        SELECT 'time_period', time_of_day_period, day_type, time_of_day_period, year, accident_count, casualty_count,
               fatal_count, serious_count, NULL, avg_severity_weight FROM periods
        UNION ALL
        SELECT 'monthly', year_month, NULL, NULL, year, accident_count, casualty_count, NULL, NULL, NULL, NULL
        FROM monthly""",
    # Files that the reader queries write and read back.
    "csv_journeys": f"""
        SELECT *, rental_id % 3 AS vintage, {station_lon('a')} AS a_lon, {station_lat('b')} AS b_lat,
               CASE WHEN rental_id % 13 = 0 THEN NULL ELSE strftime(start_date, '%Y-%m-%d %H:%M:00') END AS start_text,
               CASE WHEN rental_id % 13 = 0 THEN NULL ELSE strftime(end_date, '%Y-%m-%d %H:%M:00') END AS end_text
        FROM named_journeys WHERE NOT (rental_id % 3 = 0 AND rental_id % 97 = 0)""",
    "file_names": """
        SELECT CASE o_orderkey % 5 WHEN 0 THEN 'usage-stats/' || o_orderkey || '-notes.pdf'
                    WHEN 1 THEN 'usage-stats/' || o_orderkey || 'journeydataextract.CSV'
                    WHEN 2 THEN 'usage-stats/JourneyDataExtract' || o_orderkey || '.csv'
                    ELSE 'usage-stats/' || o_orderkey || 'JourneyDataExtract.csv' END AS path FROM orders""",
    "station_feed": f"""
        SELECT station_id, station_name, CASE WHEN station_id % 11 = 0 THEN 0e0 ELSE longitude END AS longitude,
               CASE WHEN station_id % 11 = 0 THEN 0e0 ELSE latitude END AS latitude
        FROM raw_stations WHERE station_id % 7 <> 0""",
    "odd_severity": """
        SELECT collision_index, CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 9 ELSE collision_severity END
          AS accident_severity FROM raw_accidents""",
    "odd_day": """
        SELECT collision_index, CASE WHEN road_type <> 3 THEN day_of_week END AS day FROM raw_accidents""",
    "damaged": """
        SELECT rental_id, CASE WHEN rental_id % 50 <> 0 THEN a END AS a, CASE WHEN rental_id % 40 <> 0 THEN b END AS b
        FROM raw_journeys""",
}

SQL: dict[str, str] = {}


def add(name: str, select: str) -> None:
    ctes = ",\n".join(f"{key} AS ({body})" for key, body in BASE.items())
    SQL[name] = f"WITH {ctes}\n{select}"


PAIR = "station_a_id, station_b_id"

add("pip1_blackspot_mart", "SELECT * FROM mart_blackspot")
add("pip2_corridor_mart", "SELECT * FROM buffer_mart")
add("pip2_corridor_mart_box", "SELECT * FROM box_mart")
add("pip2_corridor_mart_rounded_first", "SELECT * FROM rounded_mart")
add("pip3_temporal_mart", "SELECT * FROM mart_temporal")

_MODEL_ROWS = {
    "spatial_layer.accidents_geo": "stg_accidents",
    "spatial_layer.stations_geo": "raw_stations",
    "spatial_layer.station_blackspot_scores": "stg_stations",
    "spatial_layer.directed_trips": "(SELECT DISTINCT a, b FROM stg_journeys)",
    "spatial_layer.corridor_journeys": "pairs",
    "spatial_layer.corridor_risk": "corridors",
    "spatial_layer.monthly_accident_trend": "monthly",
    "intermediate.int_station_blackspot_scores": "stg_stations",
    "intermediate.int_corridor_risk": "corridors",
    "intermediate.int_temporal_hourly": "hourly",
    "marts.mart_blackspot_analysis": "stg_stations",
    "marts.mart_corridor_risk_score": "corridors",
    "marts.mart_temporal_safety": "mart_temporal",
}


def _repeated(table: str, key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1))"


_JOURNEY_ERRORS = f"(SELECT count(*) FROM damaged WHERE a IS NULL) + {_repeated('raw_journeys', 'rental_id')}"
_STAGING = ["staging.stg_bike_journeys", "staging.stg_bike_stations", "staging.stg_accidents"]
_TESTS = {
    "test_raw.tfl_journeys": f"{_repeated('raw_journeys', 'rental_id')} = 0",
    "test_raw.tfl_stations": "TRUE",
    "test_raw.uk_accidents": "TRUE",
}


def _steps(models: dict[str, str]) -> str:
    parts = ["SELECT 'check_raw' AS step, TRUE AS ok, CAST(NULL AS BIGINT) AS rows", "SELECT 'seeds.london_boroughs', TRUE, 33"]
    parts += [f"SELECT '{s}', {ok}, NULL" for s, ok in _TESTS.items()]
    parts += [f"SELECT '{s}', TRUE, NULL" for s in _STAGING]
    parts += [f"SELECT '{model}', TRUE, (SELECT count(*) FROM {source})" for model, source in models.items()]
    return " UNION ALL ".join(parts)


add("pip4_ordered_run", _steps(_MODEL_ROWS))
add("pip6_partial_rebuild", _steps({k: v for k, v in _MODEL_ROWS.items() if k.startswith("spatial_layer")}))
# What reads neither the journeys nor a table made of them.
_UNHARMED = {
    "spatial_layer.accidents_geo",
    "spatial_layer.stations_geo",
    "spatial_layer.station_blackspot_scores",
    "spatial_layer.monthly_accident_trend",
    "intermediate.int_temporal_hourly",
    "marts.mart_temporal_safety",
}
add(
    "pip4_damaged_run",
    " UNION ALL ".join(
        [
            "SELECT 'check_raw' AS step, 'built' AS state, FALSE AS warned, CAST(NULL AS BIGINT) AS rows",
            "SELECT 'seeds.london_boroughs', 'built', FALSE, 33",
            f"""SELECT 'test_raw.tfl_journeys', CASE WHEN {_JOURNEY_ERRORS} > 0 THEN 'failed' ELSE 'built' END,
                (SELECT count(*) FROM damaged WHERE b IS NULL) > 0, NULL""",
            "SELECT 'test_raw.tfl_stations', 'built', FALSE, NULL",
            "SELECT 'test_raw.uk_accidents', 'built', FALSE, NULL",
            f"SELECT '{_STAGING[0]}', 'skipped', FALSE, NULL",
            *(f"SELECT '{s}', 'built', FALSE, NULL" for s in _STAGING[1:]),
            *(
                f"SELECT '{model}', 'built', FALSE, (SELECT count(*) FROM {source})"
                if model in _UNHARMED
                else f"SELECT '{model}', 'skipped', FALSE, NULL"
                for model, source in _MODEL_ROWS.items()
            ),
        ]
    ),
)
add(
    "pip5_backfill_run",
    f"""SELECT 'ingest_accidents' AS step, TRUE AS ok, (SELECT count(*) FROM raw_accidents
          WHERE {IN_BOX} AND k % 17 <> 0 AND year IN (1996, 1997, 1998)) AS rows, '' AS message
        UNION ALL SELECT 'ingest_journeys', TRUE, (SELECT count(*) FROM csv_journeys),
          'passed over: 999JourneyDataExtract.csv'""",
)

add(
    "src1_read_journey_csv",
    """SELECT rental_id, bike_id, CASE WHEN vintage <> 0 THEN bike_model END AS bike_model, start_text AS start_date,
       end_text AS end_date, CAST(a AS DOUBLE) AS start_station_id, a_name AS start_station_name,
       CAST(b AS DOUBLE) AS end_station_id, b_name AS end_station_name,
       CASE WHEN vintage = 0 THEN a_lon END AS start_lon, CASE WHEN vintage = 0 THEN b_lat END AS end_lat,
       CASE WHEN vintage = 2 THEN duration_seconds * 1000e0 / 1000e0 ELSE duration_seconds END AS duration_seconds,
       CASE WHEN vintage = 2 THEN duration_seconds * 1000e0 END AS duration_ms FROM csv_journeys""",
)
add(
    "src2_source_file_tag",
    """SELECT (500 + vintage) || 'JourneyDataExtract' || rental_id % 4 || '.csv' AS source_file, count(*) AS n
       FROM csv_journeys GROUP BY ALL""",
)
_EXTRACTS = "file_names WHERE regexp_matches(path, 'JourneyDataExtract.*\\.csv$', 'i')"
_NUMBER = "coalesce(TRY_CAST(regexp_extract(path, '/([0-9]+)JourneyDataExtract', 1) AS BIGINT), 0)"
add(
    "src3_newest_files",
    f"SELECT path, {_NUMBER} AS file_number FROM {_EXTRACTS} ORDER BY file_number DESC, path LIMIT 12",
)
add("src4_journey_file_filter", f"SELECT path FROM {_EXTRACTS}")
add(
    "src5_first_readable_file",
    """SELECT collision_index, CAST(collision_severity AS VARCHAR) AS collision_severity,
       CASE WHEN k % 17 = 0 THEN 'unknown' ELSE strftime(date, '%d/%m/%Y') END AS date,
       CASE WHEN hour_of_day IS NULL THEN '--' ELSE lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':30' END AS time
       FROM raw_accidents""",
)
add("src6_station_feed", "SELECT * FROM station_feed")
add("src7_station_fallback", "SELECT * FROM station_feed")
add(
    "src8_borough_seed",
    """SELECT CASE WHEN n IN (1, 7, 11, 12, 13, 14, 19, 20, 22, 23, 25, 28, 30, 32, 33) THEN 'Inner London'
       ELSE 'Outer London' END AS region, count(*) AS stations, count(DISTINCT n) AS boroughs
       FROM (SELECT 1 + station_id % 33 AS n FROM raw_stations) GROUP BY ALL""",
)
add(
    "src9_journey_schema",
    """SELECT rental_id, bike_id, bike_model, strftime(start_date, '%Y-%m-%d %H:%M:%S') AS start_date,
       strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_date, CAST(a AS DOUBLE) AS start_station_id,
       ' ' || a_name || ' ' AS start_station_name, CAST(NULL AS DOUBLE) AS start_lon, CAST(NULL AS DOUBLE) AS start_lat,
       CAST(b AS DOUBLE) AS end_station_id, ' ' || b_name || ' ' AS end_station_name, CAST(NULL AS DOUBLE) AS end_lon,
       CAST(NULL AS DOUBLE) AS end_lat, duration_seconds, CAST(NULL AS DOUBLE) AS duration_ms,
       CAST(NULL AS VARCHAR) AS duration_text, source_file FROM named_journeys""",
)
add("src10_read_table", "SELECT * FROM mart_temporal")
add(
    "snk1_full_replace",
    "SELECT accident_index, severity_label FROM stg_accidents WHERE severity_label IN ('Fatal', 'Serious')",
)
add("snk2_view_or_table", "SELECT * FROM hourly")
add(
    "snk3_replace_and_count",
    'SELECT \'accidents_geo\' AS table_name, count(*) AS observed, count(*) AS "rows" FROM stg_accidents',
)

add(
    "prj1_rename_journey_headers",
    """SELECT rental_id, strftime(start_date, '%Y-%m-%d %H:%M:%S') AS start_date,
       CAST(b AS DOUBLE) AS end_station_id, bike_id AS odd_name FROM raw_journeys""",
)
add("prj2_normalise_headers", "SELECT collision_index, day_of_week FROM raw_accidents")
add(
    "prj3_conditional_renames",
    """SELECT collision_index, road_type AS accident_index, collision_severity, year AS collision_year
       FROM raw_accidents""",
)
add(
    "prj4_required_columns",
    "SELECT CASE WHEN vintage <> 0 THEN bike_model END AS bike_model, count(*) AS n FROM csv_journeys GROUP BY ALL",
)
add(
    "prj5_duration_from_ms",
    """SELECT rental_id, bike_id, duration_seconds * 1000 AS duration_ms,
       duration_seconds * 1000 / 1000e0 AS duration_seconds FROM raw_journeys""",
)
add(
    "prj6_parse_minute_timestamp",
    """SELECT collision_index, CASE WHEN k % 4 <> 0 THEN t END AS strict, t AS day_first_too
       FROM (SELECT collision_index, k, strftime(date, '%Y-%m-%d ') || lpad(CAST(hour_of_day AS VARCHAR), 2, '0')
             || ':15:00' AS t FROM raw_accidents)""",
)
add(
    "prj7_lenient_numbers",
    """SELECT rental_id, bike_id, CASE WHEN rental_id % 9 <> 0 THEN duration_seconds END AS duration_seconds
       FROM raw_journeys""",
)
add("prj8_rental_id", "SELECT rental_id, bike_id FROM raw_journeys WHERE rental_id % 9 <> 0")
add(
    "prj9_bike_id_text",
    "SELECT CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS bike_id, l_orderkey FROM lineitem",
)
add(
    "prj10_day_first_date",
    "SELECT collision_index, CASE WHEN k % 3 <> 2 THEN CAST(date AS VARCHAR) END AS date FROM raw_accidents",
)
add("prj11_year_from_date", "SELECT collision_index, year FROM raw_accidents")
add(
    "prj12_hour_from_clock",
    """SELECT collision_index, coalesce(lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':45', '25:00') AS time,
       hour_of_day FROM raw_accidents""",
)
add(
    "prj13_safe_cast",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS value FROM supplier",
)
add(
    "prj14_stage_journeys",
    f"""SELECT rental_id, seconds AS duration_seconds, {half_up('seconds / 60e0', 1)} AS duration_minutes, bike_id,
       bike_model, strftime(start_date, '%Y-%m-%d %H:%M:%S') AS start_at, a AS start_station_id,
       a_name AS start_station_name, strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_at, b AS end_station_id,
       b_name AS end_station_name, source_file FROM stg_journeys""",
)
add(
    "prj15_duration_coalesce",
    """SELECT rental_id, bike_id, CAST(floor(CASE WHEN rental_id % 2 = 0 THEN duration_seconds
       ELSE duration_seconds * 1000 / 1000e0 END + 0.5e0) AS BIGINT) AS duration_seconds FROM raw_journeys""",
)
add("prj16_stage_accidents", "SELECT * REPLACE (CAST(accident_date AS VARCHAR) AS accident_date) FROM stg_accidents")
add("prj17_stage_stations", "SELECT * FROM stg_stations")
_CELLS = """CAST(floor((longitude + 0.55e0) / 0.0075e0) AS BIGINT) AS cell_x,
       CAST(floor((latitude - 51.28e0) / 0.005e0) AS BIGINT) AS cell_y"""
add(
    "prj18_accidents_geo",
    f"""SELECT accident_index, CAST(accident_date AS VARCHAR) AS date, year, hour_of_day, day_of_week,
       accident_severity, severity_label, number_of_casualties, number_of_vehicles, road_type, speed_limit,
       light_conditions, weather_conditions, longitude, latitude, {_CELLS} FROM stg_accidents""",
)
add("prj19_stations_geo", f"SELECT *, {_CELLS} FROM raw_stations")

add("flt1_area_filter", "SELECT accident_index AS collision_index, longitude, latitude FROM stg_accidents")
add(
    "flt2_area_at_start",
    f"""SELECT rental_id, bike_id, {station_lon('a')} AS start_lon, {station_lat('a')} AS start_lat
       FROM raw_journeys WHERE rental_id % 97 <> 0""",
)
add("flt3_accident_years", "SELECT collision_index, year FROM raw_accidents WHERE year IN (1996, 1998)")
add(
    "flt4_casualty_years",
    """SELECT CAST(l_orderkey AS VARCHAR) AS collision_index, CAST(l_linenumber AS BIGINT) AS vehicle_reference,
       l_partkey AS casualty_reference, CAST(year(l_shipdate) AS VARCHAR) AS accident_year
       FROM lineitem WHERE year(l_shipdate) IN (1996, 1998)""",
)
add("flt5_valid_journeys", "SELECT rental_id, duration_seconds FROM stg_journeys")
add("flt6_valid_accidents", "SELECT accident_index, longitude, latitude FROM stg_accidents")
add(
    "flt7_valid_stations",
    """SELECT station_id, latitude FROM (SELECT station_id, latitude + station_id % 4 * 0.1e0 AS latitude
       FROM raw_stations) WHERE latitude <= 51.70e0""",
)
add(
    "flt8_minimum_exposure",
    f"""SELECT least(a, b) AS station_a_id, greatest(a, b) AS station_b_id, count(*) AS journey_count
       FROM stg_journeys GROUP BY ALL HAVING count(*) >= 100""",
)
add(
    "flt9_station_filters",
    """SELECT station_id, weighted_risk_score, is_blackspot FROM mart_blackspot
       WHERE is_blackspot AND weighted_risk_score >= 100""",
)
add(
    "flt9_accident_severity",
    "SELECT accident_index, severity_label FROM stg_accidents WHERE severity_label IN ('Fatal', 'Slight')",
)
add(
    "flt10_corridor_filters",
    f"""SELECT {PAIR}, risk_category, journey_count FROM buffer_mart
       WHERE risk_category IN ('High', 'Medium') AND journey_count >= 85""",
)
add("flt11_selected_years", "SELECT * FROM mart_temporal WHERE year IN (1996, 1998)")
add(
    "flt12_severe_accidents",
    """SELECT accident_index, latitude, longitude, severity_label FROM stg_accidents
       WHERE accident_severity IN (1, 2)""",
)
add("flt13_grain", "SELECT * FROM mart_temporal WHERE grain = 'monthly'")

_HAV = haversine("s.longitude", "s.latitude", "p.longitude", "p.latitude")
_PLANAR = planar("s.longitude", "s.latitude", "p.longitude", "p.latitude")
add(
    "jn1_radius_join",
    f"""SELECT station_id, accident_index, {half_up(_HAV, 3)} AS distance_m
       FROM stg_stations s LEFT JOIN stg_accidents p ON {_HAV} <= 500""",
)
add(
    "jn1_radius_join_planar",
    f"""SELECT station_id, accident_index, {half_up(_PLANAR, 3)} AS distance_m
       FROM stg_stations s LEFT JOIN stg_accidents p ON {_PLANAR} <= 300""",
)
add("jn2_box_join", f"SELECT {PAIR}, accident_index FROM box_pairs")
_TO_SEGMENT = to_segment("longitude", "latitude", "lon_a", "lat_a", "lon_b", "lat_b")
add(
    "jn2_nearest_accidents",
    f"""SELECT {PAIR}, CAST(place AS INTEGER) AS place, accident_index, {half_up('d', 3)} AS distance_m FROM
       (SELECT {PAIR}, accident_index, d, row_number() OVER (PARTITION BY {PAIR} ORDER BY d, accident_index) AS place FROM
         (SELECT {PAIR}, accident_index, {_TO_SEGMENT} AS d FROM corridors JOIN stg_accidents ON {_TO_SEGMENT} <= 800))
       WHERE place <= 10""",
)
add("jn3_buffer_join", f"SELECT {PAIR}, accident_index, {half_up('distance_m', 3)} AS distance_m FROM buffer_pairs")
add("jn4_pairs_to_stations_by_id", f"SELECT * REPLACE ({half_up('length_m', 3)} AS length_m) FROM corridors")
add("jn5_pairs_to_stations_by_name", "SELECT * EXCLUDE (length_m) FROM corridors")
add("jn6_corridors_left_accidents", f"SELECT {PAIR}, corridor_accident_count, corridor_risk_raw FROM buffer_risk")
add(
    "jn7_corridors_join_scores",
    f"SELECT {PAIR}, journey_count, corridor_accident_count, corridor_risk_raw FROM buffer_risk",
)
_NARROW = f"""SELECT {PAIR}, count(*) AS corridor_accident_count, CAST(sum({STRICT}) AS BIGINT) AS corridor_risk_raw
    FROM corridors JOIN stg_accidents
      ON {to_segment('longitude', 'latitude', 'lon_a', 'lat_a', 'lon_b', 'lat_b')} <= 5 GROUP BY ALL"""
add(
    "jn7_corridors_join_scores_narrow",
    f"""SELECT {PAIR}, journey_count, coalesce(corridor_accident_count, 0) AS corridor_accident_count,
       coalesce(corridor_risk_raw, 0) AS corridor_risk_raw FROM corridors LEFT JOIN ({_NARROW}) USING ({PAIR})""",
)
add(
    "jn8_stations_left_scores_left_volumes",
    "SELECT station_id, nearby_accident_count AS accident_count, total_trips FROM scored",
)
add(
    "jn9_cross_join_thresholds",
    f"SELECT {PAIR}, risk_category AS band FROM buffer_ranked",
)

add("agg1_station_scores", "SELECT * FROM station_totals")
add("agg2_corridor_journeys", "SELECT * FROM pairs")
add(
    "agg3_named_corridor_journeys",
    f"""SELECT least(a, b) AS station_a_id, greatest(a, b) AS station_b_id, min(least(a_name, b_name)) AS
       station_a_name_raw, min(greatest(a_name, b_name)) AS station_b_name_raw, count(*) AS journey_count
       FROM stg_journeys GROUP BY least(a, b), greatest(a, b) HAVING count(*) >= {MIN_JOURNEYS}""",
)
add("agg4_corridor_accidents_buffer", "SELECT * FROM buffer_totals")
add("agg4_corridor_accidents_box", "SELECT * FROM box_totals")
add("agg4_corridor_accidents_narrow", _NARROW)
add(
    "agg4_small_boxes",
    f"""SELECT station_id, count(*) AS corridor_accident_count, CAST(sum({STRICT}) AS BIGINT) AS corridor_risk_raw
       FROM stg_stations s JOIN stg_accidents p ON p.longitude BETWEEN s.longitude - 0.0005e0 AND s.longitude + 0.0005e0
        AND p.latitude BETWEEN s.latitude - 0.0005e0 AND s.latitude + 0.0005e0 GROUP BY ALL""",
)
add("agg5_station_volumes", "SELECT * FROM volumes")
add("agg6_hourly", "SELECT * FROM hourly_counts")
add("agg7_period_summary", "SELECT * FROM periods")
add(
    "agg8_monthly_trend",
    f"""SELECT CAST(year(accident_date) AS BIGINT) AS year, CAST(month(accident_date) AS BIGINT) AS month,
       strftime(accident_date, '%Y-%m') AS year_month, count(*) AS accident_count,
       CAST(sum(number_of_casualties) AS BIGINT) AS casualty_count,
       {half_up('avg(number_of_casualties)', 6)} AS avg_casualties_per_accident FROM stg_accidents GROUP BY ALL""",
)
add("agg9_monthly_totals", "SELECT * FROM monthly")
add(
    "agg10_exact_quantiles",
    """SELECT quantile_cont(CAST(seconds AS DOUBLE), 0.4) AS p40, quantile_cont(CAST(seconds AS DOUBLE), 0.7) AS p70,
       quantile_cont(CAST(seconds AS DOUBLE), 0.9) AS p90 FROM stg_journeys""",
)
_SPARSE = """(SELECT least(a, b) AS station_a_id, greatest(a, b) AS station_b_id,
    CASE WHEN (a + b) % 3 <> 0 THEN count(*) END AS journey_count FROM stg_journeys
    GROUP BY least(a, b), greatest(a, b), a + b)"""
add(
    "agg10_exact_quantiles_with_nulls",
    f"""SELECT quantile_cont(CAST(journey_count AS DOUBLE), 0.4) AS p40,
       quantile_cont(CAST(journey_count AS DOUBLE), 0.7) AS p70,
       quantile_cont(CAST(journey_count AS DOUBLE), 0.9) AS p90 FROM {_SPARSE}""",
)
SQL["agg10_quantiles_of_positions"] = SQL["agg10_exact_quantiles_with_nulls"]
add(
    "agg11_approximate_quantiles",
    """SELECT quantile_disc(seconds % 61, 0.4) AS p40, quantile_disc(seconds % 61, 0.7) AS p70,
       quantile_disc(seconds % 61, 0.9) AS p90 FROM stg_journeys""",
)
add(
    "agg11_sketches_of_years",
    """SELECT count(duration_seconds) AS n, true AS p40_close, true AS p70_close, true AS p90_close
       FROM stg_journeys WHERE year(start_date) BETWEEN 1993 AND 1996""",
)
add(
    "agg12_record_counts",
    """SELECT 'journeys' AS table_name, (SELECT count(*) FROM raw_journeys) AS rows
       UNION ALL SELECT 'stations', (SELECT count(*) FROM raw_stations)
       UNION ALL SELECT 'accidents', (SELECT count(*) FROM raw_accidents) UNION ALL SELECT 'casualties', NULL""",
)
add(
    "agg13_blackspot_kpis",
    """SELECT count(*) AS stations, (SELECT count(*) FROM stg_accidents) AS accidents_in_view,
       count(*) FILTER (is_blackspot) AS blackspots, max(weighted_risk_score) AS max_score FROM mart_blackspot""",
)
add(
    "agg14_corridor_kpis",
    f"""SELECT count(*) AS corridors, count(*) FILTER (risk_category = 'Very High') AS very_high,
       CAST(sum(journey_count) AS BIGINT) AS total_journeys,
       {half_up('avg(corridor_accident_count)', 6)} AS avg_accidents FROM buffer_mart""",
)
add("agg15_category_counts", "SELECT risk_category, count(*) AS corridors FROM buffer_mart GROUP BY ALL")
_SHARES = ", ".join(
    f"{half_up(f'{p}_accidents * 100e0 / total_accidents', 6)} AS {p}_pct" for p in ("rush", "night", "weekend", "weekday")
)
add(
    "agg16_temporal_kpis",
    f"""SELECT *, {_SHARES} FROM (SELECT CAST(sum(accident_count) AS BIGINT) AS total_accidents,
       CAST(sum(accident_count) FILTER (time_of_day_period IN ('AM Rush (07-09)', 'PM Rush (17-19)')) AS BIGINT)
         AS rush_accidents,
       CAST(sum(accident_count) FILTER (time_of_day_period = 'Night (00-06)') AS BIGINT) AS night_accidents,
       CAST(sum(accident_count) FILTER (day_type = 'Weekend') AS BIGINT) AS weekend_accidents,
       CAST(sum(accident_count) FILTER (day_type = 'Weekday') AS BIGINT) AS weekday_accidents FROM hourly)""",
)
add(
    "agg17_hour_by_day_type",
    """SELECT hour_of_day AS hour, day_type, CAST(sum(accident_count) AS BIGINT) AS accident_count FROM hourly
       GROUP BY ALL ORDER BY hour, day_type""",
)
add(
    "agg18_period_by_day_type",
    """SELECT * FROM (SELECT time_of_day_period AS time_period, day_type,
         CAST(sum(accident_count) AS BIGINT) AS accident_count, CAST(sum(fatal_count) AS BIGINT) AS fatal_count,
         CAST(sum(serious_count) AS BIGINT) AS serious_count FROM periods GROUP BY ALL)
       ORDER BY CASE time_period WHEN 'AM Rush (07-09)' THEN 1 WHEN 'Midday (10-16)' THEN 2
       WHEN 'PM Rush (17-19)' THEN 3 WHEN 'Evening (20-23)' THEN 4 ELSE 5 END, day_type""",
)
add(
    "agg19_month_by_year",
    """SELECT year_month, year, CAST(sum(accident_count) AS BIGINT) AS accident_count FROM monthly
       GROUP BY ALL ORDER BY year_month""",
)
_HOURS = ", ".join(f"count(*) FILTER (hour_of_day = {h}) AS h{h:02d}" for h in range(24))
add(
    "agg20_hour_by_weekday",
    f"""SELECT weekday_name, {_HOURS} FROM stg_accidents WHERE hour_of_day IS NOT NULL
       GROUP BY weekday_name, day_of_week ORDER BY (day_of_week + 5) % 7""",
)
add(
    "agg21_score_histogram",
    """SELECT CAST(least(40, floor((weighted_risk_score - lo) * 40e0 / (hi - lo)) + 1) AS BIGINT) AS bin, risk_decile,
       count(*) AS stations FROM mart_blackspot CROSS JOIN (SELECT CAST(min(weighted_risk_score) AS DOUBLE) AS lo,
       CAST(max(weighted_risk_score) AS DOUBLE) AS hi FROM mart_blackspot) GROUP BY ALL""",
)
add(
    "agg22_density_layer",
    f"""SELECT {_CELLS}, CAST(sum(CASE severity_label WHEN 'Fatal' THEN 10 WHEN 'Serious' THEN 3 ELSE 1 END) AS BIGINT)
       AS weight FROM stg_accidents GROUP BY ALL""",
)

add(
    "win1_first_per_station",
    """SELECT station_id, station_name, longitude, latitude FROM (SELECT station_id % 25 AS station_id, station_name,
       longitude, latitude, row_number() OVER (PARTITION BY station_id % 25 ORDER BY station_name, longitude, latitude)
       AS place FROM raw_stations) WHERE place = 1""",
)
add("win2_decile", "SELECT station_id, weighted_risk_score, risk_decile FROM scored")
add(
    "win2_decile_of_journeys",
    """SELECT tile, count(*) AS n, min(seconds) AS lowest, max(seconds) AS highest FROM (SELECT seconds, ntile(10)
       OVER (ORDER BY seconds, rental_id, bike_id, a) AS tile FROM stg_journeys) GROUP BY ALL""",
)
add("win3_rank", f"SELECT {PAIR}, composite_risk_score, risk_rank FROM buffer_ranked")
add(
    "win3_rank_with_ties",
    f"""SELECT *, rank() OVER (ORDER BY journey_count DESC) AS risk_rank FROM (SELECT least(a, b) AS station_a_id,
       greatest(a, b) AS station_b_id, count(*) AS journey_count FROM stg_journeys GROUP BY ALL)""",
)
add(
    "win3_rank_with_nulls",
    f"SELECT *, rank() OVER (ORDER BY journey_count DESC NULLS LAST) AS risk_rank FROM {_SPARSE}",
)
add("win4_share_of_year", "SELECT * FROM hourly")
add(
    "win5_first_station_seen",
    f"""SELECT station_id, station_name, longitude, latitude FROM (SELECT *, row_number() OVER (PARTITION BY station_id
       ORDER BY age, source_file, role, rental_id, station_name, longitude, latitude) AS place FROM (
         SELECT a AS station_id, ' ' || a_name || ' S' AS station_name,
                CASE WHEN rental_id % 97 = 0 THEN 2e0 ELSE {station_lon('a')} END AS longitude,
                {station_lat('a')} AS latitude, -(rental_id % 4 + 98) AS age,
                (rental_id % 4 + 98) || 'JourneyDataExtract.csv' AS source_file, 0 AS role, rental_id FROM named_journeys
         UNION ALL
         SELECT b, ' ' || b_name || ' ', {station_lon('b')}, {station_lat('b')}, -(rental_id % 4 + 98),
                (rental_id % 4 + 98) || 'JourneyDataExtract.csv', 1, rental_id FROM named_journeys))
       WHERE place = 1 AND {IN_BOX}""",
)

add("srt1_mart_order", "SELECT * FROM mart_blackspot ORDER BY weighted_risk_score DESC, station_id")
add("srt1_corridor_order", f"SELECT * FROM buffer_mart ORDER BY risk_rank, {PAIR}")
add("srt1_temporal_order", "SELECT * FROM mart_temporal ORDER BY grain, year NULLS LAST, dimension, day_type NULLS LAST")
add("srt2_top_corridors", f"SELECT * FROM buffer_mart ORDER BY risk_rank, {PAIR} LIMIT 50")
add(
    "srt3_top_stations",
    "SELECT station_id, weighted_risk_score FROM mart_blackspot ORDER BY weighted_risk_score DESC, station_id LIMIT 10",
)
add(
    "srt4_top_corridors_by_score",
    f"SELECT {PAIR}, composite_risk_score FROM buffer_mart ORDER BY composite_risk_score DESC, {PAIR} LIMIT 35",
)
add(
    "srt5_accident_sample",
    """SELECT accident_index, longitude, latitude, accident_severity, severity_label, number_of_casualties, hour_of_day,
       day_of_week, day_type, year FROM stg_accidents ORDER BY md5(accident_index), accident_index LIMIT 1000""",
)
add(
    "srt6_numeric_order",
    "SELECT * FROM mart_temporal WHERE grain = 'hourly' ORDER BY year, TRY_CAST(dimension AS INTEGER), day_type",
)
add("srt7_available_years", "SELECT DISTINCT year FROM mart_temporal WHERE year IS NOT NULL ORDER BY year")
add("set1_union_of_grains", "SELECT * FROM mart_temporal")
add(
    "set2_trips_by_end",
    """SELECT a AS station_id, count(*) AS trip_count FROM stg_journeys GROUP BY a
       UNION ALL SELECT b, count(*) FROM stg_journeys GROUP BY b""",
)
add(
    "set3_stations_from_journeys",
    f"""SELECT station_id, station_name, longitude, latitude FROM (SELECT *, row_number() OVER (PARTITION BY station_id
       ORDER BY role, rental_id, longitude) AS place FROM (
         SELECT a AS station_id, ' ' || a_name || ' ' AS station_name,
                CASE WHEN rental_id % 97 = 0 THEN 2e0 ELSE {station_lon('a')} END AS longitude,
                {station_lat('a')} AS latitude, 0 AS role, rental_id FROM named_journeys
         UNION ALL
         SELECT b, ' ' || b_name || ' ', {station_lon('b')}, {station_lat('b')}, 1, rental_id FROM named_journeys))
       WHERE place = 1 AND {IN_BOX}""",
)
add(
    "set4_concatenate_vintages",
    """SELECT CASE vintage WHEN 0 THEN 'title' WHEN 1 THEN 'snake' ELSE 'recent' END AS vintage, count(*) AS n,
       count(*) FILTER (vintage <> 0) AS with_model, count(start_text) AS with_start FROM csv_journeys GROUP BY vintage""",
)

add("scl1_period_of_day", f"SELECT collision_index, {period('hour_of_day')} AS period FROM raw_accidents")
add("scl2_severity_label", f"SELECT collision_index, {LABEL} AS label FROM odd_severity")
add(
    "scl3_severity_weight",
    "SELECT collision_index, CAST(CASE accident_severity WHEN 1 THEN 10 WHEN 2 THEN 3 ELSE 1 END AS BIGINT) AS weight"
    " FROM odd_severity",
)
add("scl4_scoring_weight", f"SELECT collision_index, CAST({STRICT} AS BIGINT) AS weight FROM odd_severity")
add("scl5_weekday_name", f"SELECT collision_index, {weekday('day')} AS weekday FROM odd_day")
add(
    "scl6_day_type",
    "SELECT collision_index, CASE WHEN day IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM odd_day",
)
for _name, _metric in (
    ("scl7_great_circle", haversine),
    ("scl8_planar_degrees", planar),
    ("scl9_equirectangular", equirectangular),
):
    _distance = half_up(_metric("-0.12e0", "51.5e0", "longitude", "latitude"), 3)
    add(_name, f"SELECT accident_index, {_distance} AS distance_m FROM stg_accidents")
_SEGMENT = half_up(to_segment("longitude", "latitude", "-0.15e0", "51.48e0", "-0.09e0", "51.52e0"), 3)
add("scl10_segment_distance", f"SELECT accident_index, {_SEGMENT} AS distance_m FROM stg_accidents")
add("scl11_midpoint", f"SELECT {PAIR}, mid_lon, mid_lat FROM corridors")
add("scl12_risk_per_km", f"SELECT {PAIR}, {half_up('risk_per_km', 4)} AS risk_per_km FROM buffer_risk")
add(
    "scl13_composite_risk",
    f"SELECT {PAIR}, {half_up('composite_risk_score', 4)} AS composite_risk_score FROM buffer_risk",
)
add(
    "scl14_risk_per_1000_trips",
    f"""SELECT c_custkey, CASE WHEN c_custkey % 7 > 0
       THEN {half_up('floor(abs(c_acctbal)) * 1000e0 / (c_custkey % 7)', 2)} ELSE 0e0 END AS rate FROM customer""",
)
add(
    "scl15_risk_category",
    """SELECT c_custkey, CASE WHEN c_custkey % 11 > 9 THEN 'Very High' WHEN c_custkey % 11 > 7 THEN 'High'
       WHEN c_custkey % 11 > 4 THEN 'Medium' ELSE 'Low' END AS category FROM customer""",
)
add(
    "scl16_decile_colour",
    f"SELECT c_custkey, {COLOUR} AS colour FROM (SELECT c_custkey, c_custkey % 11 + 1 AS risk_decile FROM customer)",
)
add("scl17_category_colour", f"SELECT {PAIR}, risk_category, {CATEGORY_COLOUR} AS colour FROM buffer_mart")
add("scl18_is_blackspot", "SELECT c_custkey, c_custkey % 11 = 10 AS is_blackspot FROM customer")
add("scl19_corridor_label", f"SELECT {PAIR}, station_a_name || ' ↔ ' || station_b_name AS label FROM corridors")
add(
    "scl20_month_key",
    """SELECT collision_index, strftime(date, '%Y-%m') AS year_month, CAST(month(date) AS BIGINT) AS month
       FROM raw_accidents""",
)
add(
    "scl21_undirected_pair",
    "SELECT rental_id, CAST(least(a, b) AS DOUBLE) AS a, CAST(greatest(a, b) AS DOUBLE) AS b FROM raw_journeys",
)
add(
    "scl22_text_and_null_functions",
    f"""SELECT rental_id, a_name AS trimmed, duration_seconds AS first_known,
       {half_up('duration_seconds / 60', 1)} AS minutes,
       CASE WHEN rental_id % 2 <> 0 THEN duration_seconds END AS divided FROM named_journeys""",
)
add(
    "scl23_line_style",
    f"""SELECT {PAIR}, CAST(CASE risk_category WHEN 'Very High' THEN 9 WHEN 'High' THEN 6 WHEN 'Medium' THEN 4
       WHEN 'Low' THEN 2 END AS BIGINT) AS line_weight, CASE risk_category WHEN 'Very High' THEN 0.9e0
       WHEN 'High' THEN 0.8e0 WHEN 'Medium' THEN 0.65e0 WHEN 'Low' THEN 0.55e0 END AS line_opacity FROM buffer_mart""",
)
add(
    "scl24_short_labels",
    """SELECT station_a_id AS id, left(corridor_label, 40) AS label, '' AS popup FROM buffer_mart
       UNION ALL SELECT station_id, left(station_name, 38), 'Station Name: ' || station_name || chr(10) ||
       'Weighted Risk Score: ' || weighted_risk_score FROM mart_blackspot""",
)


def _check(name: str, severity: str, count: str) -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, {count} AS n_failing"


_NO_ID = _check("not_null:rental_id", "error", "CAST(0 AS BIGINT)")
_NO_START = _check("not_null:start_station_id", "error", "(SELECT count(*) FROM damaged WHERE a IS NULL)")
_NO_END = _check("not_null:end_station_id", "warn", "(SELECT count(*) FROM damaged WHERE b IS NULL)")
_REPEATED_ID = _check("unique:rental_id", "error", _repeated("raw_journeys", "rental_id"))
add("dq1_not_null", f"{_NO_ID} UNION ALL {_NO_START}")
add("dq2_unique", _REPEATED_ID)
add("dq3_not_null_warning", _NO_END)
add(
    "dq4_accepted_values",
    _check(
        "accepted_values:collision_severity",
        "error",
        "(SELECT count(*) FROM odd_severity WHERE accident_severity NOT IN (1, 2, 3))",
    ),
)
add("dq5_missing_tables", "SELECT unnest(['uk_accidents', 'tfl_journeys']) AS table_name FROM (SELECT count(*) FROM raw_stations)")
add(
    "dq5_layout",
    """SELECT 'tfl_stations' AS table_name, TRUE AS is_there, '' AS missing_columns, count(*) AS n_rows FROM raw_stations
       UNION ALL SELECT 'uk_accidents', TRUE, 'collision_severity,latitude', count(*) FROM raw_accidents
       UNION ALL SELECT 'tfl_journeys', FALSE, 'rental_id', NULL""",
)
add(
    "dq_all_checks_on_raw",
    " UNION ALL ".join(
        [
            _NO_ID,
            _NO_START,
            _NO_END,
            _REPEATED_ID,
            _check("not_null:station_id", "error", "(SELECT count(*) FROM raw_stations WHERE station_id IS NULL)"),
            _check("unique:station_id", "error", _repeated("raw_stations", "station_id")),
            _check("not_null:collision_index", "error", "(SELECT count(*) FROM raw_accidents WHERE k IS NULL)"),
            _check(
                "accepted_values:collision_severity",
                "error",
                "(SELECT count(*) FROM raw_accidents WHERE collision_severity NOT IN (1, 2, 3))",
            ),
            _check("unique:collision_index", "error", _repeated("raw_accidents", "collision_index")),
        ]
    ),
)
_COUNTED_ONCE = """(SELECT a, b FROM (SELECT *, row_number() OVER (PARTITION BY rental_id ORDER BY a, b) AS place
    FROM stg_journeys) WHERE place = 1)"""
add(
    "str1_incremental_pairs",
    f"""SELECT least(a, b) AS station_a_id, greatest(a, b) AS station_b_id, count(*) AS journey_count FROM {_COUNTED_ONCE}
       GROUP BY ALL HAVING count(*) >= 20""",
)
add(
    "str1_incremental_stations",
    f"""SELECT station_id, count(*) AS total_trips FROM (SELECT a AS station_id FROM {_COUNTED_ONCE}
       UNION ALL SELECT b FROM {_COUNTED_ONCE}) GROUP BY ALL""",
)
