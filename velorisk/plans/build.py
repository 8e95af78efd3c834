"""A whole run: ingest, precompute, build the models, report the status of every step."""

import time
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from velorisk import constants as C
from velorisk.operators import blackspot, corridor, quality, staging, temporal
from velorisk.sources import boroughs, collisions, journeys, stations
from velorisk.sources.tables import INTERMEDIATE, MARTS, RAW, SEEDS, SPATIAL, STAGING, TableStore

STATUS_SCHEMA = "step string, ok boolean, rows bigint, seconds double, message string"
REQUIRED_RAW = ["uk_accidents", "tfl_journeys", "tfl_stations"]


@dataclass(frozen=True)
class BuildConfig:
    """What to run. File locations that are None leave the raw table as it is.

    Without ``n_files`` and ``years`` every file and every year is taken. With
    ``on_failed_test="skip"`` a raw table that fails a test of severity error holds
    back what is built on it; ``"continue"`` builds all the same, and the run still
    counts as failed. Up to ``parallel`` steps run at a time.
    """

    root: str | None = None
    journey_folder: str | None = None
    station_feed: str | None = None
    accident_paths: Sequence[str] = ()
    casualty_paths: Sequence[str] = ()
    vehicle_paths: Sequence[str] = ()
    n_files: int | None = None
    years: Sequence[int] | None = None
    skip_ingest: bool = False
    skip_journeys: bool = False
    skip_accidents: bool = False
    day_first_times: bool = False
    on_failed_test: str = "skip"
    select: str = ""
    radius_m: float = C.BLACKSPOT_RADIUS_M
    metric: str = "great_circle"
    min_journeys: int = C.MIN_CORRIDOR_JOURNEYS
    near: str = "buffer"
    buffer_m: float = C.CORRIDOR_BUFFER_M
    pad_deg: float = C.CORRIDOR_PAD_DEG
    join_on: str = "id"
    length: str = "great_circle"
    quantiles: str = "exact"
    round_first: bool = False
    parallel: int = 4


def backfill(config: BuildConfig) -> BuildConfig:
    """The same run over a year of journey files and six years of accidents."""
    return replace(config, n_files=C.BACKFILL_N_FILES, years=list(C.BACKFILL_YEARS))


@dataclass(frozen=True)
class Outcome:
    """Rows written and what to say about a step that went well."""

    rows: int | None = None
    message: str = ""


def ingest_journeys(store: TableStore, config: BuildConfig) -> Outcome:
    spark = store.spark
    skipped: list[str] = []
    raw = journeys.read_newest_journeys(
        spark, config.journey_folder, config.n_files, config.day_first_times, skipped
    )
    rows = store.replace(RAW, "tfl_journeys", raw)
    met = store.replace(RAW, "tfl_stations", stations.stations_from_journeys(store.read(RAW, "tfl_journeys")))
    if not met and config.station_feed:
        store.replace(RAW, "tfl_stations", stations.read_station_feed(spark, config.station_feed))
    names = sorted(path.rpartition("/")[2] for path in skipped)
    return Outcome(rows, f"passed over: {', '.join(names)}" if names else "")


def ingest_accidents(store: TableStore, config: BuildConfig) -> Outcome:
    rows = 0
    for table, paths, reader in (
        ("uk_accidents", config.accident_paths, collisions.read_collisions),
        ("uk_casualties", config.casualty_paths, collisions.read_related),
        ("uk_vehicles", config.vehicle_paths, collisions.read_related),
    ):
        if not paths:
            continue
        df = reader(store.spark, paths, config.years)
        if df is None:
            raise FileNotFoundError(f"no readable file for {table}: {list(paths)}")
        written = store.replace(RAW, table, df)
        rows += written if table == "uk_accidents" else 0
    return Outcome(rows)


RAW_TESTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "tfl_journeys": quality.check_journeys,
    "tfl_stations": quality.check_stations,
    "uk_accidents": quality.check_collisions,
}


def run_tests(store: TableStore, table: str) -> Outcome:
    """All tests of a raw table. A failing one of severity error fails the step, a warning is told."""
    results = RAW_TESTS[table](store.read(RAW, table)).where("n_failing > 0").collect()
    told = "; ".join(f"{r.severity} {r.check_name}: {r.n_failing}" for r in sorted(results))
    if any(r.severity == "error" for r in results):
        raise ValueError(told)
    return Outcome(None, told)


def check_raw(store: TableStore) -> Outcome:
    missing = store.missing(RAW, REQUIRED_RAW)
    if missing:
        raise RuntimeError(f"required raw tables not found: {missing}")
    return Outcome()


def load_seed(store: TableStore) -> Outcome:
    return Outcome(store.replace(SEEDS, "london_boroughs", boroughs.read_boroughs(store.spark)))


@dataclass(frozen=True)
class Model:
    """``needs`` names the tables that ``build`` reads, as ``layer.name``."""

    layer: str
    name: str
    build: Callable[[TableStore, BuildConfig], DataFrame]
    needs: tuple[str, ...]

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"


def models() -> list[Model]:
    """All models, each after the ones it reads. Heavy results are stored once, in order of use.

    Accidents enter every model through staging, so all of them count the same ones.
    Journeys are read once, into counts by direction.
    """
    raw_journeys, raw_stations, raw_accidents = f"{RAW}.tfl_journeys", f"{RAW}.tfl_stations", f"{RAW}.uk_accidents"
    staged_journeys, staged_stations = f"{STAGING}.stg_bike_journeys", f"{STAGING}.stg_bike_stations"
    staged_accidents = f"{STAGING}.stg_accidents"

    def raw(store: TableStore, name: str) -> DataFrame:
        return store.read(RAW, name)

    def stg(store: TableStore, name: str) -> DataFrame:
        return store.read(STAGING, name)

    return [
        Model(STAGING, "stg_bike_journeys", lambda s, c: staging.stage_journeys(raw(s, "tfl_journeys")), (raw_journeys,)),
        Model(STAGING, "stg_bike_stations", lambda s, c: staging.stage_stations(raw(s, "tfl_stations")), (raw_stations,)),
        Model(STAGING, "stg_accidents", lambda s, c: staging.stage_accidents(raw(s, "uk_accidents")), (raw_accidents,)),
        Model(SPATIAL, "accidents_geo", lambda s, c: staging.accidents_geo(raw(s, "uk_accidents")), (raw_accidents,)),
        Model(SPATIAL, "stations_geo", lambda s, c: staging.stations_geo(raw(s, "tfl_stations")), (raw_stations,)),
        Model(
            SPATIAL,
            "station_blackspot_scores",
            lambda s, c: blackspot.station_scores(
                stg(s, "stg_bike_stations"), stg(s, "stg_accidents"), c.radius_m, c.metric
            ),
            (staged_stations, staged_accidents),
        ),
        Model(
            SPATIAL,
            "directed_trips",
            lambda s, c: corridor.directed_trips(stg(s, "stg_bike_journeys")),
            (staged_journeys,),
        ),
        Model(
            SPATIAL,
            "corridor_journeys",
            lambda s, c: (
                corridor.named_corridor_journeys(stg(s, "stg_bike_journeys"), c.min_journeys)
                if c.join_on == "name"
                else corridor.corridors_of_trips(s.read(SPATIAL, "directed_trips"), c.min_journeys)
            ),
            (f"{SPATIAL}.directed_trips",),
        ),
        Model(
            SPATIAL,
            "corridor_risk",
            _corridor_risk,
            (f"{SPATIAL}.corridor_journeys", staged_stations, staged_accidents),
        ),
        Model(
            SPATIAL,
            "monthly_accident_trend",
            lambda s, c: temporal.monthly_trend(stg(s, "stg_accidents").withColumnRenamed("accident_date", "date")),
            (staged_accidents,),
        ),
        Model(
            INTERMEDIATE,
            "int_station_blackspot_scores",
            lambda s, c: blackspot.score_stations(
                s.read(SPATIAL, "station_blackspot_scores"),
                blackspot.volumes_of_trips(s.read(SPATIAL, "directed_trips")),
            ),
            (f"{SPATIAL}.station_blackspot_scores", f"{SPATIAL}.directed_trips"),
        ),
        Model(
            INTERMEDIATE,
            "int_corridor_risk",
            lambda s, c: corridor.rank_corridors(s.read(SPATIAL, "corridor_risk"), c.quantiles, c.round_first),
            (f"{SPATIAL}.corridor_risk",),
        ),
        Model(
            INTERMEDIATE,
            "int_temporal_hourly",
            lambda s, c: temporal.temporal_hourly(stg(s, "stg_accidents")),
            (staged_accidents,),
        ),
        Model(
            MARTS,
            "mart_blackspot_analysis",
            lambda s, c: blackspot.blackspot_mart(s.read(INTERMEDIATE, "int_station_blackspot_scores")),
            (f"{INTERMEDIATE}.int_station_blackspot_scores",),
        ),
        Model(
            MARTS,
            "mart_corridor_risk_score",
            lambda s, c: corridor.corridor_mart(s.read(INTERMEDIATE, "int_corridor_risk")),
            (f"{INTERMEDIATE}.int_corridor_risk",),
        ),
        Model(
            MARTS,
            "mart_temporal_safety",
            _temporal_mart,
            (f"{INTERMEDIATE}.int_temporal_hourly", f"{SPATIAL}.monthly_accident_trend"),
        ),
    ]


def _corridor_risk(store: TableStore, config: BuildConfig) -> DataFrame:
    located = corridor.locate_corridors(
        store.read(SPATIAL, "corridor_journeys"),
        store.read(STAGING, "stg_bike_stations"),
        config.join_on,
        config.length,
    )
    accidents = store.read(STAGING, "stg_accidents")
    return corridor.score_corridors(located, accidents, config.near, config.buffer_m, config.pad_deg)


def _temporal_mart(store: TableStore, config: BuildConfig) -> DataFrame:
    hourly = store.read(INTERMEDIATE, "int_temporal_hourly")
    monthly = store.read(SPATIAL, "monthly_accident_trend")
    return temporal.union_grains(hourly, temporal.period_summary(hourly), monthly)


def selected_models(select: str) -> list[Model]:
    """Models of a layer, or a single model by name; an empty selector means all."""
    wanted = [m for m in models() if not select or select in (m.layer, m.name)]
    if not wanted:
        raise ValueError(f"nothing matches the selector {select!r}")
    return wanted


def build_model(store: TableStore, model: Model, config: BuildConfig) -> Outcome:
    df = model.build(store, config)
    if model.layer == STAGING:
        store.view(STAGING, model.name, df)
        return Outcome()
    # The temporal mart is read one grain at a time, so a grain gets its own folder.
    partition_by = ["grain"] if model.name == "mart_temporal_safety" else []
    return Outcome(store.replace(model.layer, model.name, df, partition_by))


@dataclass(frozen=True)
class Step:
    """An action, the tables it needs, those that are stale if it fails, and steps to wait for besides."""

    name: str
    action: Callable[[], Outcome]
    needs: tuple[str, ...] = ()
    gives: tuple[str, ...] = ()
    after: tuple[str, ...] = ()


def steps_of(store: TableStore, config: BuildConfig) -> list[Step]:
    wanted = selected_models(config.select)
    steps = []
    if not config.skip_ingest:
        if config.journey_folder and not config.skip_journeys:
            gives = (f"{RAW}.tfl_journeys", f"{RAW}.tfl_stations")
            steps.append(Step("ingest_journeys", lambda: ingest_journeys(store, config), gives=gives))
        if (config.accident_paths or config.casualty_paths or config.vehicle_paths) and not config.skip_accidents:
            gives = (f"{RAW}.uk_accidents",)
            steps.append(Step("ingest_accidents", lambda: ingest_accidents(store, config), gives=gives))
    steps.append(Step("check_raw", lambda: check_raw(store), after=tuple(s.name for s in steps)))
    steps.append(Step(f"{SEEDS}.london_boroughs", lambda: load_seed(store)))
    for table in RAW_TESTS:
        name = f"{RAW}.{table}"
        held = (name,) if config.on_failed_test == "skip" else ()
        steps.append(Step(f"test_{name}", lambda t=table: run_tests(store, t), (name,), held))
    restated = [] if any(m.layer == STAGING for m in wanted) else models()[:3]
    # Staging lives in views of the session, so a partial rebuild restates it.
    for model in [*restated, *wanted]:
        action = lambda m=model: build_model(store, m, config)
        steps.append(Step(model.full_name, action, model.needs, (model.full_name,)))
    return steps


def waits_of(steps: Sequence[Step]) -> list[set[int]]:
    """For each step the earlier ones that it waits for: those that give a table it needs or gives, and those it names."""
    waits = []
    for i, step in enumerate(steps):
        tables = {*step.needs, *step.gives}
        waits.append({j for j, other in enumerate(steps[:i]) if tables & set(other.gives) or other.name in step.after})
    return waits


def run(spark: SparkSession, config: BuildConfig) -> DataFrame:
    """Run every step and return one status row for each, in their order.

    A step starts once all that it waits for have ended; several run at a time, so that
    small jobs don't leave a cluster idle. A failed step does not stop the others, but
    those that need what it should have made are skipped, and their rows say so: a table
    of an earlier run is never taken for a new one. :func:`succeeded` tells whether the
    run as a whole is good.
    """
    store = TableStore(spark, config.root)
    steps = steps_of(store, config)
    waits, status, stale = waits_of(steps), {}, {}

    def attempt(step: Step) -> tuple:
        began = time.monotonic()
        missing = sorted({stale[t] for t in step.needs if t in stale})
        if missing:
            rows, ok, message = None, False, f"skipped: needs {', '.join(missing)}"
        else:
            try:
                outcome = step.action()
                rows, ok, message = outcome.rows, True, outcome.message
            except Exception as error:  # noqa: BLE001 - any failure becomes a status row
                rows, ok, message = None, False, f"{type(error).__name__}: {error}".splitlines()[0]
        return step.name, ok, rows, time.monotonic() - began, message

    with ThreadPoolExecutor(max(1, config.parallel)) as pool:
        running: dict[Future, int] = {}
        begun: set[int] = set()
        while len(status) < len(steps):
            for i, step in enumerate(steps):
                if i not in begun and waits[i] <= status.keys():
                    begun.add(i)
                    running[pool.submit(attempt, step)] = i
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                i = running.pop(ended)
                status[i] = ended.result()
                if not status[i][1]:
                    stale |= {t: steps[i].name for t in steps[i].gives}
    return spark.createDataFrame([status[i] for i in range(len(steps))], STATUS_SCHEMA)


def succeeded(status: DataFrame) -> bool:
    return status.where("NOT ok").isEmpty()
