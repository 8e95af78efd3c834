import threading
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from velorisk import schemas
from velorisk.operators import quality, serving
from velorisk.plans import build, marts
from velorisk.session import materialise, shared_root
from velorisk.sources import tables
from velorisk.sources.journeys import read_journeys, to_journey_schema
from velorisk.streaming import increments

ACCIDENTS = (
    "collision_index,longitude,latitude,collision_severity,date,time,number_of_casualties,day_of_week,collision_year\n"
    "a1,-0.1149,51.5036,1,01/06/2023,08:30,1,5,2023\n"
    "a2,-0.1000,51.5046,3,15/07/2023,17:45,1,7,2023\n"
    "a3,-0.1000,51.5046,2,15/07/2019,17:45,1,2,2019\n"
)


@pytest.fixture
def config(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    header = (
        "Rental Id,Duration,Bike Id,End Date,EndStation Id,EndStation Name,EndStation Longitude,EndStation Latitude,"
        "Start Date,StartStation Id,StartStation Name,StartStation Longitude,StartStation Latitude\n"
    )
    for number in (10, 11):
        rows = [
            f"{number}{i},600,7,2023-06-01 08:10,2,London Bridge,-0.0875,51.5055,2023-06-01 08:00,1,Waterloo,-0.1149,51.5036\n"
            for i in range(5)
        ]
        (folder / f"{number}JourneyDataExtract.csv").write_text(header + "".join(rows))
    accidents = tmp_path / "accidents.csv"
    accidents.write_text(ACCIDENTS)
    related = tmp_path / "casualties.csv"
    related.write_text("collision_index,vehicle_reference,casualty_reference,collision_year\na1,1,1,2023\na3,1,1,2019\n")
    return build.BuildConfig(
        root=str(tmp_path / "tables"),
        journey_folder=str(folder),
        accident_paths=[str(accidents)],
        casualty_paths=[str(related)],
        vehicle_paths=[str(related)],
        min_journeys=5,
        years=[2022, 2023, 2024],
    )


def test_whole_run(spark, config):
    status = build.run(spark, config)
    failed = [(r.step, r.message) for r in status.collect() if not r.ok]
    assert failed == [] and build.succeeded(status)
    store = tables.TableStore(spark, config.root)
    stations = {r.station_id: r for r in store.read("marts", "mart_blackspot_analysis").collect()}
    assert stations[1].weighted_risk_score == 10 and stations[1].total_trips == 10
    line = store.read("marts", "mart_corridor_risk_score").first()
    assert (line.journey_count, line.corridor_accident_count, line.corridor_label) == (10, 2, "Waterloo ↔ London Bridge")
    assert store.read("raw", "uk_casualties").count() == 1
    grains = {r.grain for r in store.read("marts", "mart_temporal_safety").select("grain").distinct().collect()}
    assert grains == {"hourly", "time_period", "monthly"}
    # A second run replaces, it does not add.
    build.run(spark, config)
    assert store.read("raw", "tfl_journeys").count() == 10


def test_backfill_and_selection(spark, config):
    wide = build.backfill(config)
    assert wide.n_files == 52 and 2019 in wide.years
    assert build.succeeded(build.run(spark, wide))
    store = tables.TableStore(spark, config.root)
    assert store.read("raw", "uk_accidents").count() == 3
    narrow = build.replace(config, n_files=1, skip_accidents=True)
    assert build.succeeded(build.run(spark, narrow))
    assert store.read("raw", "tfl_journeys").count() == 5
    assert store.read("raw", "uk_accidents").count() == 3
    partial = build.run(spark, build.replace(config, skip_ingest=True, select="mart_temporal_safety"))
    assert [r.step for r in partial.collect()][-1] == "marts.mart_temporal_safety"
    assert build.succeeded(partial)
    with pytest.raises(ValueError):
        build.run(spark, build.replace(config, select="nothing"))


def test_a_failed_step_does_not_stop_the_others(spark, config):
    broken = build.replace(config, accident_paths=[config.accident_paths[0] + ".absent"])
    status = {r.step: r for r in build.run(spark, broken).collect()}
    assert not status["ingest_accidents"].ok and "no readable file" in status["ingest_accidents"].message
    assert not status["check_raw"].ok and "uk_accidents" in status["check_raw"].message
    assert status["spatial_layer.corridor_journeys"].ok
    assert not status["marts.mart_blackspot_analysis"].ok
    assert status["marts.mart_blackspot_analysis"].message.startswith("skipped: ")


def test_stale_tables_are_not_taken_for_new_ones(spark, config):
    assert build.succeeded(build.run(spark, config))
    store = tables.TableStore(spark, config.root)
    store.replace("raw", "tfl_stations", spark.range(3).withColumnRenamed("id", "station_id"))
    status = {r.step: r for r in build.run(spark, build.replace(config, skip_ingest=True)).collect()}
    assert not status["staging.stg_bike_stations"].ok
    for skipped in ("spatial_layer.station_blackspot_scores", "intermediate.int_corridor_risk", "marts.mart_corridor_risk_score"):
        assert status[skipped].message.startswith("skipped: ")
    assert status["marts.mart_temporal_safety"].ok


def test_failed_tests_hold_back_or_not(spark, config):
    build.run(spark, config)
    store = tables.TableStore(spark, config.root)
    twice = store.read("raw", "tfl_journeys")
    store.replace("raw", "tfl_journeys", twice.unionByName(twice.limit(1)))
    held = {r.step: r for r in build.run(spark, build.replace(config, skip_ingest=True)).collect()}
    assert "error unique:rental_id: 1" in held["test_raw.tfl_journeys"].message
    assert held["marts.mart_corridor_risk_score"].message.startswith("skipped: needs")
    free = build.run(spark, build.replace(config, skip_ingest=True, on_failed_test="continue"))
    assert [r.step for r in free.where("NOT ok").collect()] == ["test_raw.tfl_journeys"]


def test_run_and_marts_agree(spark, config, tmp_path):
    """Also on accidents without an index, which staging drops."""
    (tmp_path / "accidents.csv").write_text(ACCIDENTS + ",-0.1149,51.5036,1,02/06/2023,09:30,5,6,2023\n")
    config = build.replace(config, on_failed_test="continue")
    build.run(spark, config)
    store = tables.TableStore(spark, config.root)
    stations, accidents, journeys = (store.read("raw", t) for t in ("tfl_stations", "uk_accidents", "tfl_journeys"))
    for name, df in (
        ("mart_blackspot_analysis", marts.blackspots(stations, accidents, journeys)),
        ("mart_corridor_risk_score", marts.corridors(stations, accidents, journeys, min_journeys=5)),
        ("mart_temporal_safety", marts.temporal_patterns(accidents)),
    ):
        columns = sorted(df.columns)
        rows = [sorted(map(repr, x.select(columns).collect())) for x in (store.read("marts", name), df)]
        assert rows[0] == rows[1], name


def test_a_run_leaves_only_its_tables(spark, config, tmp_path):
    build.run(spark, config)
    build.run(spark, config)
    left = {p.name for layer in (tmp_path / "tables").iterdir() for p in layer.iterdir() if not p.name.endswith(".crc")}
    named = {m.name for m in build.models() if m.layer != "staging"}
    raw = {"tfl_journeys", "tfl_stations", "uk_accidents", "uk_casualties", "uk_vehicles"}
    assert left == named | raw | {"london_boroughs"}


def test_unreadable_files_are_passed_over(spark, config, tmp_path):
    (tmp_path / "feeds" / "12JourneyDataExtract.csv").write_text("no,journeys\n1,2\n")
    (tmp_path / "feeds" / "13JourneyDataExtract.csv").write_text("")
    skipped = []
    paths = [str(tmp_path / "feeds" / f"{n}JourneyDataExtract.csv") for n in (10, 11, 12, 13)] + [str(tmp_path / "absent.csv")]
    rows = read_journeys(spark, paths, skipped=skipped)
    assert rows.count() == 10
    assert sorted(p.rpartition("/")[2] for p in skipped) == ["12JourneyDataExtract.csv", "13JourneyDataExtract.csv", "absent.csv"]


def test_store(spark, store):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert store.replace("raw", "t", df) == 5
    assert store.replace("raw", "t", df.where("k < 2")) == 2
    assert store.read("raw", "t").count() == 2
    assert store.missing("raw", ["t", "u"]) == ["u"]
    assert [r.table_name for r in quality.missing_tables(store, "raw", ["t", "u"]).collect()] == ["u"]
    layout = quality.check_layout(store, "raw", {"t": ["k", "z", "a"], "u": ["b", "a"]})
    assert sorted(map(tuple, layout.collect())) == [("t", True, "a,z", 2), ("u", False, "a,b", None)]
    counts = serving.record_counts(store, {"things": "t", "others": "u"})
    assert sorted(map(tuple, counts.collect())) == [("others", None), ("things", 2)]
    assert tables.materialise_model(store, tables.STAGING, "v", df) is None
    assert spark.table("staging_v").count() == 5 and store.exists(tables.STAGING, "v")


def test_shared_root(spark, tmp_path):
    assert shared_root(spark) == shared_root(spark)
    stored = materialise(spark.range(3), "three")
    assert stored.count() == 3 and "three-" in stored.inputFiles()[0]


def test_increments_equal_the_batch(spark, journeys_of, tmp_path):
    rows = journeys_of([(i, 1 + i % 2, 2 if i % 2 == 0 else 3) for i in range(20)])
    raw = to_journey_schema(rows.withColumn("start_date", rows.start_date.cast("timestamp")))
    unreadable = raw.withColumn("start_date", raw.start_date.substr(1, 0).try_cast("timestamp")).where("rental_id >= 18")
    target = increments.TripCounts(str(tmp_path / "counts"))
    source = str(tmp_path / "arriving")
    raw.where("rental_id < 10").write.mode("append").parquet(source)
    increments.update(spark, source, target)
    first = {(r.station_a_id, r.station_b_id): r.journey_count for r in increments.pair_counts(spark, target, 1).collect()}
    assert first == {(1, 2): 5, (2, 3): 5}
    # The next delivery repeats five journeys, one of them twice, and adds eight.
    raw.where("rental_id >= 5 AND rental_id < 18").write.mode("append").parquet(source)
    raw.where("rental_id = 7").write.mode("append").parquet(source)
    unreadable.write.mode("append").parquet(source)
    increments.update(spark, source, target)
    unreadable.write.mode("append").parquet(source)
    increments.update(spark, source, target)
    got = {(r.station_a_id, r.station_b_id): r.journey_count for r in increments.pair_counts(spark, target, 1).collect()}
    assert got == {(1, 2): 10, (2, 3): 10}
    trips = {r.station_id: r.total_trips for r in increments.station_counts(spark, target).collect()}
    assert trips == {1: 10, 2: 20, 3: 10}
    # Replaying a batch changes nothing.
    increments._apply_batch(target, spark.read.schema(schemas.JOURNEYS).parquet(source).where("rental_id < 10"), 0)
    again = {(r.station_a_id, r.station_b_id): r.journey_count for r in increments.pair_counts(spark, target, 1).collect()}
    assert again == got


def test_a_rental_counts_once_whatever_its_month(spark, journeys_of, tmp_path):
    rows = to_journey_schema(journeys_of([(1, 1, 2), (1, 1, 3), (2, 1, 2)]).withColumn("start_date", F.lit("2023-06-01").cast("timestamp")))
    target, source = increments.TripCounts(str(tmp_path / "counts")), str(tmp_path / "arriving")
    rows.withColumn("start_date", F.lit(None).cast("timestamp")).write.mode("append").parquet(source)
    increments.update(spark, source, target)
    rows.withColumn("start_date", F.add_months("start_date", 1).cast("timestamp")).write.mode("append").parquet(source)
    increments.update(spark, source, target)
    got = {(r.station_a_id, r.station_b_id): r.journey_count for r in increments.pair_counts(spark, target, 1).collect()}
    assert got == {(1, 2): 2}


def test_ten_deliveries_move_no_history_and_keep_files_few(spark, journeys_of, tmp_path):
    target = increments.TripCounts(str(tmp_path / "counts"), buckets=3, fan=3)
    files = []
    for delivery in range(10):
        # Each delivery repeats half of the one before.
        rows = journeys_of([(i, 1, 2 + i % 2) for i in range(delivery * 10, delivery * 10 + 20)])
        raw = to_journey_schema(rows.withColumn("start_date", rows.start_date.cast("timestamp")))
        increments._apply_batch(target, raw, delivery)
        paths = increments.current_parts(spark, target, "accepted")
        files.append(sum(len(list(Path(p).glob("part-*"))) for p in paths))
        assert sum(r.journey_count for r in increments.pair_counts(spark, target, 1).collect()) == (delivery + 2) * 10
        totals = [increments.current_parts(spark, target, kind) for kind in ("pairs", "stations")]
        assert [len(t) for t in totals] == [1, 1]
    # At most fan - 1 generations of a level, so 2 + 2 + 2 here; and one file for each bucket.
    assert max(files) <= 5 * 3 and len(paths) <= 5
    kept = [p.name for p in Path(target.root, "accepted").iterdir()]
    assert len(kept) <= len(paths) + 4  # those that the last state but one names
    with increments._Buckets(spark, target) as buckets:
        fresh = spark.createDataFrame([(3, False), (1000, False)], "id bigint, missing boolean").repartition(2)
        new = increments.unseen(fresh, [buckets.read(p) for p in paths])
        assert [r.id for r in new.collect()] == [1000]
        plan = new._jdf.queryExecution().executedPlan().toString()
        final = plan[plan.index("Initial Plan") :]
        # The fresh rows are dealt out once; no exchange, of whatever kind, stands over a generation.
        assert final.count("Exchange hashpartitioning") == 1 and "Broadcast" not in final
        assert final.count("FileScan parquet") == len(paths) == final.count("Bucketed: true")


def test_a_batch_that_failed_is_done_anew(spark, journeys_of, tmp_path, monkeypatch):
    target = increments.TripCounts(str(tmp_path / "counts"), buckets=2, fan=2)

    def raw(ids):
        rows = journeys_of([(i, 1, 2) for i in ids])
        return to_journey_schema(rows.withColumn("start_date", rows.start_date.cast("timestamp")))

    assert increments.pair_counts(spark, target, 1).count() == 0
    increments._apply_batch(target, raw(range(5)), 0)
    with monkeypatch.context() as m:
        m.setattr(increments, "_merged", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            increments._apply_batch(target, raw(range(3, 9)), 1)
    assert increments.station_counts(spark, target).where("station_id = 1").first().total_trips == 5
    for _ in range(2):
        increments._apply_batch(target, raw(range(3, 9)), 1)
        assert increments.station_counts(spark, target).where("station_id = 1").first().total_trips == 9


def test_steps_wait_for_what_they_need_and_for_nothing_else(spark, config):
    store = tables.TableStore(spark, config.root)
    steps = build.steps_of(store, config)
    waits = {s.name: {steps[j].name for j in w} for s, w in zip(steps, build.waits_of(steps))}
    assert waits["ingest_journeys"] == waits["ingest_accidents"] == waits["seeds.london_boroughs"] == set()
    assert waits["check_raw"] == {"ingest_journeys", "ingest_accidents"}
    assert waits["test_raw.uk_accidents"] == {"ingest_accidents"}
    assert waits["spatial_layer.accidents_geo"] == {"ingest_accidents", "test_raw.uk_accidents"}
    assert waits["marts.mart_temporal_safety"] == {"intermediate.int_temporal_hourly", "spatial_layer.monthly_accident_trend"}


def test_parallel_and_single_runs_say_the_same(spark, config):
    def told(parallel):
        return [(r.step, r.ok, r.rows, r.message) for r in build.run(spark, replace(config, parallel=parallel)).collect()]

    assert told(1) == told(6)


def test_steps_run_at_the_same_time(spark, monkeypatch):
    meet = threading.Barrier(3, timeout=60)
    steps = [build.Step(f"s{i}", lambda: build.Outcome(meet.wait()), gives=(f"t{i}",)) for i in range(3)]
    steps.append(build.Step("last", lambda: 1 / 0, needs=("t0", "t2"), gives=("t3",)))
    steps.append(build.Step("held", lambda: build.Outcome(), needs=("t3",)))
    monkeypatch.setattr(build, "steps_of", lambda *_: steps)
    status = build.run(spark, build.BuildConfig(parallel=3)).collect()
    assert [(r.step, r.ok) for r in status] == [("s0", True), ("s1", True), ("s2", True), ("last", False), ("held", False)]
    assert status[4].message == "skipped: needs last"


def test_command_line(spark, config, capsys):
    from velorisk.__main__ import main, parse

    wide, _ = parse(["--backfill"])
    assert (wide.n_files, len(wide.years)) == (52, 6)
    narrow, _ = parse(["--backfill", "--n-files", "3", "--accident-years", "2023,x"])
    assert (narrow.n_files, narrow.years) == (3, [2023])
    places = ["--root", config.root, "--journeys", config.journey_folder, "--min-journeys", "5"]
    assert main([*places, "--accidents", *config.accident_paths]) == 0
    assert "marts.mart_temporal_safety" in capsys.readouterr().out
    assert main([*places, "--skip-journeys", "--accidents", "absent.csv", "--select", "staging"]) == 1
    assert "FAILED ingest_accidents" in capsys.readouterr().out
