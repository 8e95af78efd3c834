"""Headline queries at one scale; prints one JSON line."""

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from velorisk import derived  # noqa: E402
from velorisk.operators import blackspot, corridor, positions, spatial, staging, temporal  # noqa: E402
from velorisk.plans import build, marts  # noqa: E402
from velorisk.session import build_session, materialise, scratch_path  # noqa: E402
from velorisk.sources.tables import TableStore  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def entries(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """What is timed, by name. Each entry builds its DataFrame anew."""
    scattered = derived.raw_tables(spark, folder)
    lattice = derived.raw_tables(spark, folder, lattice=True)

    def staged(raw):
        return (
            staging.stage_stations(raw.stations),
            staging.stage_accidents(raw.accidents),
            staging.stage_journeys(raw.journeys),
        )

    def located(raw):
        stations, _, journeys = staged(raw)
        pairs = corridor.corridor_journeys(journeys, derived.MIN_JOURNEYS)
        return materialise(corridor.locate_corridors(pairs, stations), "corridors")

    def whole_run():
        store = TableStore(spark, scratch_path(spark, "bench"))
        for name, df in (("tfl_stations", scattered.stations), ("uk_accidents", scattered.accidents), ("tfl_journeys", scattered.journeys)):
            store.replace("raw", name, df)
        config = build.BuildConfig(root=store.root, min_journeys=derived.MIN_JOURNEYS, on_failed_test="continue")
        return build.run(spark, config)

    stations, accidents, journeys = staged(scattered)
    scattered_corridors, lattice_corridors = located(scattered), located(lattice)
    return {
        "radius_500m_pairs": lambda: spatial.radius_join(stations, accidents, how="inner"),
        "radius_500m_pairs_left": lambda: spatial.radius_join(stations, accidents),
        "journey_positions": lambda: positions.with_positions(
            journeys.select("rental_id", "duration_seconds"), F.asc("duration_seconds"), F.asc("rental_id")
        ),
        "whole_run": whole_run,
        "radius_500m_scores": lambda: blackspot.station_scores(stations, accidents),
        "corridor_box_totals": lambda: corridor.corridor_accidents(scattered_corridors, accidents, "box"),
        "corridor_buffer_totals": lambda: corridor.corridor_accidents(scattered_corridors, accidents, "buffer"),
        "corridor_buffer_totals_lattice": lambda: corridor.corridor_accidents(lattice_corridors, accidents, "buffer"),
        "corridor_journeys": lambda: corridor.corridor_journeys(journeys, derived.MIN_JOURNEYS),
        "station_volumes": lambda: blackspot.station_volumes(journeys),
        "stage_journeys": lambda: journeys,
        "stage_accidents": lambda: accidents,
        "temporal_hourly": lambda: temporal.temporal_hourly(accidents),
        "blackspot_mart": lambda: marts.blackspots(scattered.stations, scattered.accidents, scattered.journeys),
        "corridor_mart": lambda: marts.corridors(
            lattice.stations, lattice.accidents, lattice.journeys, min_journeys=derived.MIN_JOURNEYS
        ),
        "temporal_mart": lambda: marts.temporal_patterns(scattered.accidents),
    }


def seconds_of(entry: Callable[[], DataFrame]) -> float:
    began = time.perf_counter()
    # The no-op sink computes every column of every row and keeps nothing.
    entry().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, entry in entries(spark, FOLDER).items():
        seconds_of(entry)
        seconds[name] = round(min(seconds_of(entry) for _ in range(2)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
