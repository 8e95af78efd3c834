"""Trip counts kept up to date from arriving journey files.

Each micro-batch drops journeys that were counted before and adds the counts of the
rest to the totals. A journey counts once per rental id, in whichever batch it was
accepted first, and not in watermarked state: a file that arrives years late is still
counted.

Accepted ids are the history. They lie in generations, each a table bucketed by the id,
so that a delivery is shuffled to the buckets and the history is not moved at all. When
``fan`` generations of one level have gathered, they are merged into one of the next
level: an id is rewritten as often as the logarithm of the number of deliveries, and
the number of files stays below ``(fan - 1) * buckets`` for each level.

What a batch leaves behind is named by a state that is written last. A batch that failed
half-way has no state and is done anew; one with a state is complete and left alone.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk import constants as C
from velorisk import schemas
from velorisk.operators.blackspot import station_volumes
from velorisk.operators.corridor import corridor_journeys
from velorisk.operators.staging import stage_journeys

#: Larger than any station id plus one, so that a pair of them packs into one number.
_PACK = 10**19

#: A null rental id is an id like any other; ``missing`` tells it from the id 0 that stands in its place.
_ID = ["id", "missing"]
_ACCEPTED_SCHEMA = "id bigint, missing boolean, start_station_id bigint, end_station_id bigint"
_PAIR_SCHEMA = "station_a_id bigint, station_b_id bigint, journey_count bigint"
_STATION_SCHEMA = "station_id bigint, total_trips bigint"
_STATE_SCHEMA = "kind string, path string, level int"


@dataclass(frozen=True)
class TripCounts:
    """Where an incremental run keeps its tables: below one root that every executor can reach.

    ``buckets`` is fixed for the life of a root; ``fan`` generations of a level are merged into one.
    """

    root: str
    buckets: int = 64
    fan: int = 4

    @property
    def states(self) -> str:
        return f"{self.root}/states"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


@dataclass(frozen=True)
class Part:
    """A folder that a state names: a generation of ``accepted`` ids, or the totals by ``pairs`` or ``stations``."""

    kind: str
    path: str
    level: int = 0


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    place, system = _hadoop(spark, path)
    system.delete(place, True)


def _complete_batches(spark: SparkSession, target: TripCounts) -> list[int]:
    """Ids of the batches with a written state, in order."""
    place, system = _hadoop(spark, target.states)
    if not system.exists(place):
        return []
    names = [status.getPath() for status in system.listStatus(place)]
    return sorted(int(p.getName()) for p in names if system.exists(_hadoop(spark, f"{p.toString()}/_SUCCESS")[0]))


def _state(spark: SparkSession, target: TripCounts, batch_id: int) -> list[Part]:
    rows = spark.read.schema(_STATE_SCHEMA).parquet(f"{target.states}/{batch_id}").collect()
    return [Part(r.kind, r.path, r.level) for r in rows]


def current_parts(spark: SparkSession, target: TripCounts, kind: str) -> list[str]:
    """Folders of one kind in the state of the last complete batch."""
    done = _complete_batches(spark, target)
    return [p.path for p in _state(spark, target, done[-1]) if p.kind == kind] if done else []


class _Buckets:
    """Bucketed tables over folders. Their names in the catalog last for one batch; the folders stay."""

    def __init__(self, spark: SparkSession, target: TripCounts):
        self.spark, self.target, self._names = spark, target, []

    def __enter__(self) -> "_Buckets":
        return self

    def __exit__(self, *_) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _name(self) -> str:
        self._names.append(f"velorisk_accepted_{uuid.uuid4().hex}")
        return self._names[-1]

    def write(self, ids: DataFrame, path: str) -> DataFrame:
        """One file for each bucket, since the rows are dealt out as the buckets are."""
        _delete(self.spark, path)
        name = self._name()
        dealt = ids.repartition(self.target.buckets, *_ID)
        dealt.write.bucketBy(self.target.buckets, *_ID).sortBy(*_ID).option("path", path).format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def read(self, path: str) -> DataFrame:
        name = self._name()
        self.spark.sql(
            f"CREATE TABLE {name} ({_ACCEPTED_SCHEMA}) USING parquet CLUSTERED BY ({', '.join(_ID)}) SORTED BY"
            f" ({', '.join(_ID)}) INTO {self.target.buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(name)


def unseen(fresh: DataFrame, history: Sequence[DataFrame]) -> DataFrame:
    """Rows of ``fresh`` whose id is in no table of the ``history``. Only the fresh rows are shuffled, once for all tables."""
    for generation in history:
        # The planner may think a generation small enough to be sent to every task; its size has no bound.
        fresh = fresh.join(generation.select(*_ID).hint("merge"), _ID, "left_anti")
    return fresh


def one_per_rental(journeys: DataFrame) -> DataFrame:
    """The row of each rental id with the least start and, of these, the least end station, nulls first.

    Both ids are packed into one number: its minimum is hashed and combined on the
    map side, where that of a struct would make Spark sort every journey. A null
    rental id is an id like any other.
    """
    pack = F.lit(str(_PACK)).cast("decimal(20,0)")
    ends = [F.coalesce(F.col(c) + 1, F.lit(0)).cast("decimal(19,0)") for c in ("start_station_id", "end_station_id")]
    packed = (ends[0] * pack + ends[1]).cast("decimal(38,0)")
    least = journeys.groupBy("rental_id").agg(F.min(packed).alias("ends"))

    def unpacked(value: Column, name: str) -> Column:
        number = value.cast("bigint")
        return F.when(number > 0, number - 1).alias(name)

    start = F.floor(F.col("ends") / pack).cast("decimal(38,0)")
    start = F.when(start * pack > F.col("ends"), start - 1).otherwise(start).cast("decimal(19,0)")
    return least.withColumn("first", start).select(
        "rental_id",
        unpacked(F.col("first"), "start_station_id"),
        unpacked(F.col("ends") - F.col("first") * pack, "end_station_id"),
    )


def _added(totals: Sequence[str], fresh: DataFrame, schema: str, keys: Sequence[str], count: str) -> DataFrame:
    """Totals so far and those of fresh rows, as one table."""
    spark = fresh.sparkSession
    both = spark.read.schema(schema).parquet(*totals).unionByName(fresh) if totals else fresh
    return both.groupBy(*keys).agg(F.sum(count).alias(count))


def _merged(buckets: _Buckets, target: TripCounts, batch_id: int, parts: list[Part]) -> list[Part]:
    """Generations after merging every level that is full, from the lowest up."""
    level = 0
    while len(full := [p for p in parts if p.level == level]) >= target.fan:
        # Read as plain files: the planner takes a union of bucketed tables for dealt out, and would write more files.
        together = buckets.spark.read.schema(_ACCEPTED_SCHEMA).parquet(*[p.path for p in full])
        path = f"{target.root}/accepted/{batch_id}-level-{level + 1}"
        buckets.write(together, path)
        parts = [p for p in parts if p.level != level] + [Part("accepted", path, level + 1)]
        level += 1
    return parts


def _apply_batch(target: TripCounts, batch: DataFrame, batch_id: int) -> None:
    spark = batch.sparkSession
    done = _complete_batches(spark, target)
    if done and done[-1] >= batch_id:
        return
    before = _state(spark, target, done[-1]) if done else []
    # What the last state no longer names has served its readers for one batch.
    if len(done) > 1:
        for path in {p.path for p in _state(spark, target, done[-2])} - {p.path for p in before}:
            _delete(spark, path)
    rentals = one_per_rental(stage_journeys(batch))
    fresh = rentals.select(
        F.coalesce("rental_id", F.lit(0)).alias("id"), F.col("rental_id").isNull().alias("missing"), "start_station_id", "end_station_id"
    )
    generations = [p for p in before if p.kind == "accepted"]
    with _Buckets(spark, target) as buckets:
        path = f"{target.root}/accepted/{batch_id}"
        stored = buckets.write(unseen(fresh, [buckets.read(p.path) for p in generations]), path)
        counted = {
            "pairs": (corridor_journeys(stored, 1), _PAIR_SCHEMA, ["station_a_id", "station_b_id"], "journey_count"),
            "stations": (station_volumes(stored), _STATION_SCHEMA, ["station_id"], "total_trips"),
        }
        totals = []
        for kind, (rows, *shape) in counted.items():
            totals.append(Part(kind, f"{target.root}/{kind}/{batch_id}"))
            _added([p.path for p in before if p.kind == kind], rows, *shape).write.mode("overwrite").parquet(totals[-1].path)
        parts = _merged(buckets, target, batch_id, [*generations, Part("accepted", path)])
    state = spark.createDataFrame([(p.kind, p.path, p.level) for p in [*parts, *totals]], _STATE_SCHEMA)
    state.coalesce(1).write.mode("overwrite").parquet(f"{target.states}/{batch_id}")


def update(
    spark: SparkSession, source: str, target: TripCounts, source_format: str = "parquet", **options: str
) -> None:
    """Take in every file that arrived since the last call, then stop.

    The files hold raw journeys; ``options`` go to the reader, such as ``header`` for CSV.
    """
    arriving = spark.readStream.schema(schemas.JOURNEYS).format(source_format).options(**options).load(source)
    (
        arriving.writeStream.foreachBatch(lambda batch, batch_id: _apply_batch(target, batch, batch_id))
        .option("checkpointLocation", target.checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def pair_counts(spark: SparkSession, target: TripCounts, min_journeys: int = C.MIN_CORRIDOR_JOURNEYS) -> DataFrame:
    """Current journeys per undirected pair with enough of them. None before the first delivery."""
    return _totals(spark, target, "pairs", _PAIR_SCHEMA).where(F.col("journey_count") >= F.lit(min_journeys))


def station_counts(spark: SparkSession, target: TripCounts) -> DataFrame:
    """Current trips per station. None before the first delivery."""
    return _totals(spark, target, "stations", _STATION_SCHEMA)


def _totals(spark: SparkSession, target: TripCounts, kind: str, schema: str) -> DataFrame:
    paths = current_parts(spark, target, kind)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
