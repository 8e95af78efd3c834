import json

import pytest
from pyspark.sql import functions as F

from velorisk import schemas
from velorisk.sources import boroughs, collisions, journeys, listing, stations

TITLE = (
    "Rental Id,Duration,Bike Id,End Date,EndStation Id,EndStation Name,EndStation Longitude,EndStation Latitude,"
    "Start Date,StartStation Id,StartStation Name,StartStation Longitude,StartStation Latitude\n"
)
TITLE_ROWS = (
    '1001,600,101,2023-06-01 08:10,2,"Bank, The",-0.0875,51.5055,2023-06-01 08:00,1,Waterloo,-0.1149,51.5036\n'
    "1002,1200,102,2023-06-01 09:20,3,Victoria,-0.1447,51.4952,01/06/2023 09:00,2,London Bridge,-0.0875,51.5055\n"
    "1003,300,103,2023-06-01 10:05,1,Waterloo,-0.1149,51.5036,2023-06-01 10:00,3,Victoria,2.0,51.4952\n"
    "bad,300,103,2023-06-01 10:05,1,Waterloo,-0.1149,51.5036,2023-06-01 10:00,3,Victoria,-0.1447,51.4952\n"
)
SNAKE = (
    "rental_id,duration,bike_id,end_date,end_station_id,end_station_name,start_date,start_station_id,start_station_name\n"
    "2001,n/a,W-7,2017-12-01 08:10,20,Beta,2017-12-01 08:00,10,Alpha\n"
)
RECENT = (
    "Number,Start date,Start station number,Start station,End date,End station number,End station,Bike number,"
    "Bike model,Total duration,Total duration (ms)\n"
    "3001,2025-07-01 08:00,30,Gamma,2025-07-01 08:17,31,Delta,WSERV-1,PBSC_EBIKE,17m 1s,1021000\n"
)
NO_END = "rental_id,duration,bike_id,end_date,end_station_id,start_date,start_station_id,start_station_name\n1,1,1,1,1,1,1,x\n"


@pytest.fixture
def folder(tmp_path):
    files = {
        "500JourneyDataExtract01Jun.csv": TITLE + TITLE_ROWS,
        "99JourneyDataExtract01Dec.csv": SNAKE,
        "501journeydataextract01Jul.CSV": RECENT,
        "502JourneyDataExtractBroken.csv": NO_END,
        "503JourneyDataExtractEmpty.csv": "",
        "readme.csv": "x\n1\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_text(content)
    return str(tmp_path)


def test_newest_files_by_number(spark, folder):
    found = listing.journey_files(listing.list_files(spark, folder))
    # Spark leaves out files without content; the others all match but the readme.
    assert found.count() == 4
    newest = [r.path.rsplit("/", 1)[1] for r in listing.newest_files(found, 3).collect()]
    # 500 comes before 99, although "99" sorts after "500" as text.
    assert newest == [
        "502JourneyDataExtractBroken.csv",
        "500JourneyDataExtract01Jun.csv",
        "99JourneyDataExtract01Dec.csv",
    ]


def test_three_vintages_one_schema(spark, folder):
    df = journeys.read_newest_journeys(spark, folder, 12)
    assert df.schema == schemas.JOURNEYS
    rows = {r.rental_id: r for r in df.collect()}
    # 1003 starts outside the area, "bad" has no id, the broken file lacks a column.
    assert sorted(rows) == [1001, 1002, 2001, 3001]
    assert rows[1001].end_station_name == "Bank, The"
    assert rows[1001].source_file == "500JourneyDataExtract01Jun.csv"
    assert rows[1001].start_date is not None and rows[1002].start_date is None
    assert rows[2001].duration_seconds is None and rows[2001].start_lon is None and rows[2001].bike_id == "W-7"
    assert rows[3001].duration_seconds == 1021.0 and rows[3001].duration_ms == 1021000.0
    assert rows[3001].bike_model == "PBSC_EBIKE" and rows[3001].duration_text == "17m 1s"


def test_day_first_times_are_an_option(spark, folder):
    rows = {r.rental_id: r for r in journeys.read_newest_journeys(spark, folder, 12, day_first_times=True).collect()}
    assert rows[1002].start_date is not None


def test_headers_outside_the_map(spark):
    df = spark.createDataFrame([(1, 2)], "`Some Odd Name` int, `Number` int")
    assert journeys.rename_headers(df).columns == ["some_odd_name", "rental_id"]


def test_stations_from_journeys(spark, folder):
    raw = journeys.read_newest_journeys(spark, folder, 12)
    found = {r.station_id: r for r in stations.stations_from_journeys(raw).collect()}
    assert sorted(found) == [1, 2, 3]
    # Starts come before ends: station 2 takes the name it has as a start.
    assert found[2].station_name == "London Bridge"


def test_no_coordinates_no_stations(spark, tmp_path):
    path = tmp_path / "99JourneyDataExtract.csv"
    path.write_text(SNAKE)
    found = stations.stations_from_journeys(journeys.read_journeys(spark, [str(path)]))
    assert found.columns == ["station_id", "station_name", "longitude", "latitude"]
    assert found.isEmpty()


def test_first_appearance_decides_even_outside_the_area(spark):
    rows = [
        (1, 5.0, "inside", -0.1, 51.5, "9JourneyDataExtract.csv"),
        (2, 5.0, "outside", 3.0, 51.5, "10JourneyDataExtract.csv"),
        (3, 6.0, "older", -0.1, 51.5, "9JourneyDataExtract.csv"),
        (4, 6.0, "newer", -0.2, 51.5, "10JourneyDataExtract.csv"),
    ]
    schema = "rental_id bigint, start_station_id double, start_station_name string, start_lon double, start_lat double, source_file string"
    df = journeys.to_journey_schema(spark.createDataFrame(rows, schema))
    assert [(r.station_id, r.station_name) for r in stations.stations_from_journeys(df).collect()] == [(6, "newer")]


def test_station_feed(spark, tmp_path):
    feed = [
        {"id": "BikePoints_12", "commonName": " River Street ", "lat": 51.5, "lon": -0.1},
        {"id": "BikePoints_x", "commonName": "no number", "lat": 51.5, "lon": -0.1},
        {"id": "BikePoints_13", "commonName": "nowhere"},
    ]
    path = tmp_path / "feed.json"
    path.write_text(json.dumps(feed))
    rows = sorted(tuple(r) for r in stations.read_station_feed(spark, str(path)).collect())
    assert rows == [(12, "River Street", -0.1, 51.5), (13, "nowhere", 0.0, 0.0)]


def test_feed_is_only_a_fallback(spark, stations_frame):
    empty = stations_frame.where("false")
    assert stations.stations_or_feed(stations_frame, empty).count() == 3
    assert stations.stations_or_feed(empty, stations_frame).count() == 3


@pytest.fixture
def stations_frame(spark, request):
    return request.getfixturevalue("stations")


ACCIDENTS = (
    "Accident_Index, Longitude ,Latitude,Accident_Severity,Date,Time,Number of Casualties\n"
    "2022ABC001,-0.12,51.50,1,01/06/2022,08:30,1\n"
    "2022ABC002,-0.09,51.51,3,15/07/2022,17:45,1\n"
    "2021XYZ003,0.50,52.00,2,20/08/2021,12:00,2\n"
    "2022ABC004,oops,51.50,2,2022-08-20,late,2\n"
)


def test_accident_file(spark, tmp_path):
    path = tmp_path / "accidents.csv"
    path.write_text(ACCIDENTS)
    df = collisions.read_collisions(spark, [str(tmp_path / "absent.csv"), str(path)])
    rows = {r.collision_index: r for r in df.collect()}
    assert sorted(rows) == ["2022ABC001", "2022ABC002"]
    first = rows["2022ABC001"]
    assert (first.date.month, first.year, first.hour_of_day, first.collision_severity) == (6, 2022, 8, "1")
    assert "number_of_casualties" in df.columns
    assert collisions.read_collisions(spark, [str(path)], [2021]).count() == 0
    assert collisions.read_collisions(spark, [str(tmp_path / "absent.csv")]) is None


def test_reference_wins_over_index(spark):
    df = spark.createDataFrame([("i", "r", 1, 2020)], "accident_index string, accident_reference string, accident_severity int, accident_year int")
    renamed = collisions.rename_collision_columns(df)
    assert renamed.columns == ["accident_index", "collision_index", "collision_severity", "collision_year"]
    assert renamed.first().collision_index == "r"
    kept = spark.createDataFrame([("c", "r")], "collision_index string, accident_reference string")
    assert collisions.rename_collision_columns(kept).columns == ["collision_index", "accident_reference"]


@pytest.mark.parametrize("years,expected", [([], 3), (["2022", "x"], 2), ([2021], 1), (["x"], 0)])
def test_year_filter(spark, years, expected):
    df = spark.createDataFrame([(2022, 1), (2022, 2), (2021, 3)], "year int, k int")
    assert collisions.filter_years(df, years).count() == expected
    assert collisions.filter_years(df.drop("year"), years).count() == 3


def test_related_year_filter_uses_either_column(spark):
    df = spark.createDataFrame([("2022",), ("2021",)], "accident_year string")
    assert collisions.filter_related_years(df, [2022]).count() == 1
    assert collisions.filter_related_years(df.withColumnRenamed("accident_year", "collision_year"), [2022]).count() == 1
    assert collisions.filter_related_years(df.select(F.lit(1).alias("k")), [2022]).count() == 2


def test_area_filter_without_coordinates_passes(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert collisions.filter_area(df).count() == 1


def test_existing_year_is_kept(spark):
    df = spark.createDataFrame([("01/06/2022", 1999)], "date string, year int")
    assert collisions.parse_dates(df).first().year == 1999


def test_boroughs(spark):
    df = boroughs.read_boroughs(spark)
    assert df.count() == 33
    assert {r.region: r["count"] for r in df.groupBy("region").count().collect()} == {"Inner London": 15, "Outer London": 18}
    assert boroughs.read_boroughs(spark, str(boroughs.BOROUGH_FILE)).count() == 33


def test_named_feed_files_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A write by partition columns sorts its rows first; each task writes one quarter as it comes."""
    from registry import feeds

    from pyspark.sql import DataFrameWriter

    rows = spark.range(400).select(
        (F.col("id") * 7).alias("l_orderkey"),
        (F.col("id") % 5 + 1).cast("int").alias("l_linenumber"),
        F.lit(3).cast("bigint").alias("l_partkey"),
        (F.col("id") % 9).alias("l_suppkey"),
        F.lit(600.4).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.lit("1996-05-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"),
    )
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.delattr(DataFrameWriter, "partitionBy")
    paths = feeds.named_journey_files(spark, str(tmp_path))
    ids = [r[0] for r in rows.selectExpr("l_orderkey * 8 + l_linenumber").collect()]
    expected = {}
    for i in ids:
        name = f"{500 + i % 3}JourneyDataExtract{i % 4}.csv"
        expected.setdefault(name, []).append(i)
    found = {}
    for path in paths:
        frame = spark.read.option("header", True).csv(path)
        column = next(c for c in frame.columns if c in ("Rental Id", "rental_id", "Number"))
        found[path.rpartition("/")[2]] = sorted(int(r[0]) for r in frame.select(F.col(f"`{column}`")).collect())
    assert found == {name: sorted(some) for name, some in expected.items()}
    assert {path.rpartition("/")[0] for path in paths} == {feeds.folder_of(paths)}
