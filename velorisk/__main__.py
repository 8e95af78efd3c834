"""Command line of a whole run: ``spark-submit velorisk/__main__.py --root … --journeys …``."""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from velorisk import constants as C  # noqa: E402
from velorisk.plans.build import BuildConfig, backfill, run, succeeded  # noqa: E402
from velorisk.session import build_session  # noqa: E402


def parse(arguments: list[str]) -> tuple[BuildConfig, str | None]:
    parser = argparse.ArgumentParser(prog="velorisk", description="Ingest, build the models and report every step.")
    parser.add_argument("--master", help="Spark master, if spark-submit does not set it")
    parser.add_argument("--root", help="folder of the tables; without it they go to the catalog")
    parser.add_argument("--journeys", help="folder of the journey files")
    parser.add_argument("--station-feed", help="JSON stations, used if the journeys carry no coordinates")
    parser.add_argument("--accidents", nargs="*", default=[], help="candidate files, the first readable one is taken")
    parser.add_argument("--casualties", nargs="*", default=[])
    parser.add_argument("--vehicles", nargs="*", default=[])
    parser.add_argument("--n-files", type=int, help="newest journey files to take; all without it")
    parser.add_argument("--accident-years", help="comma-separated; all without it")
    parser.add_argument("--backfill", action="store_true", help="a year of journey files and six years of accidents")
    parser.add_argument("--skip-ingest", action="store_true")
    parser.add_argument("--skip-journeys", action="store_true")
    parser.add_argument("--skip-accidents", action="store_true")
    parser.add_argument("--select", default="", help="a layer or a model to rebuild")
    parser.add_argument("--radius-m", type=float, default=C.BLACKSPOT_RADIUS_M)
    parser.add_argument("--min-journeys", type=int, default=C.MIN_CORRIDOR_JOURNEYS)
    parser.add_argument("--parallel", type=int, default=4, help="steps that run at a time")
    parser.add_argument("--near", choices=["buffer", "box"], default="buffer")
    parser.add_argument("--join-on", choices=["id", "name"], default="id")
    parser.add_argument("--day-first-times", action="store_true", help="read dd/MM/yyyy HH:mm too")
    parser.add_argument("--on-failed-test", choices=["skip", "continue"], default="skip")
    parser.add_argument("--metric", choices=["great_circle", "planar_deg"], default="great_circle")
    parser.add_argument("--buffer-m", type=float, default=C.CORRIDOR_BUFFER_M)
    parser.add_argument("--pad-deg", type=float, default=C.CORRIDOR_PAD_DEG)
    parser.add_argument("--length", choices=["great_circle", "equirectangular"], default="great_circle")
    parser.add_argument("--quantiles", choices=["exact", "approximate"], default="exact")
    parser.add_argument("--round-first", action="store_true", help="rank and band on the rounded score")
    args = parser.parse_args(arguments)
    wide = backfill(BuildConfig()) if args.backfill else BuildConfig()
    years = [int(y) for y in args.accident_years.split(",") if y.strip().isdigit()] if args.accident_years else wide.years
    config = BuildConfig(
        root=args.root,
        journey_folder=args.journeys,
        station_feed=args.station_feed,
        accident_paths=args.accidents,
        casualty_paths=args.casualties,
        vehicle_paths=args.vehicles,
        n_files=args.n_files or wide.n_files,
        years=years,
        skip_ingest=args.skip_ingest,
        skip_journeys=args.skip_journeys,
        skip_accidents=args.skip_accidents,
        select=args.select,
        radius_m=args.radius_m,
        min_journeys=args.min_journeys,
        near=args.near,
        join_on=args.join_on,
        day_first_times=args.day_first_times,
        on_failed_test=args.on_failed_test,
        metric=args.metric,
        buffer_m=args.buffer_m,
        pad_deg=args.pad_deg,
        length=args.length,
        quantiles=args.quantiles,
        round_first=args.round_first,
        parallel=args.parallel,
    )
    return config, args.master


def main(arguments: list[str]) -> int:
    """0 if every step went well, else 1."""
    config, master = parse(arguments)
    status = run(build_session("velorisk", master), config)
    for row in status.collect():
        print(f"{'ok' if row.ok else 'FAILED':6} {row.step:48} {row.rows if row.rows is not None else '':>12} {row.seconds:8.1f} s  {row.message}")
    return 0 if succeeded(status) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
