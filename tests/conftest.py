import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from velorisk.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left():
    """A file of tests leaves no temporary views to the next one: Spark lists them in every database."""
    yield
    session = SparkSession.getActiveSession()
    for table in session.catalog.listTables() if session else []:
        if table.isTemporary:
            session.catalog.dropTempView(table.name)


@pytest.fixture
def store(spark, tmp_path):
    from velorisk.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "tables"))


STATIONS = [
    (1, "Waterloo", -0.1149, 51.5036),
    (2, "London Bridge", -0.0875, 51.5055),
    (3, "Victoria", -0.1447, 51.4952),
]
STATION_SCHEMA = "station_id bigint, station_name string, longitude double, latitude double"


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(STATIONS, STATION_SCHEMA)


ACCIDENT_SCHEMA = (
    "accident_index string, longitude double, latitude double, accident_severity bigint, number_of_casualties bigint"
)


@pytest.fixture
def accidents_of(spark):
    def build(rows):
        return spark.createDataFrame(rows, ACCIDENT_SCHEMA)

    return build


JOURNEY_SCHEMA = (
    "rental_id bigint, duration_seconds double, bike_id string, start_date string, start_station_id double,"
    " start_station_name string, end_date string, end_station_id double, end_station_name string"
)


@pytest.fixture
def journeys_of(spark):
    """Raw journeys from (rental_id, start, end) or (rental_id, start, end, seconds)."""
    names = {i: n for i, n, _, _ in STATIONS}

    def build(rows):
        full = []
        for rental, start, end, *rest in rows:
            seconds = rest[0] if rest else 600.0
            full.append(
                (
                    rental,
                    seconds,
                    "7",
                    "2023-06-01 08:00",
                    None if start is None else float(start),
                    names.get(start, "Elsewhere"),
                    "2023-06-01 08:10",
                    None if end is None else float(end),
                    names.get(end, "Elsewhere"),
                )
            )
        return spark.createDataFrame(full, JOURNEY_SCHEMA)

    return build
