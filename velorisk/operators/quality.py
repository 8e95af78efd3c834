"""Data-quality checks that report counts instead of stopping the run."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk.sources.tables import TableStore


@dataclass(frozen=True)
class RowCheck:
    """A check on single rows: ``fails`` is true for an offending row."""

    name: str
    fails: Column
    severity: str = "error"


def not_null(column: str, severity: str = "error") -> RowCheck:
    return RowCheck(f"not_null:{column}", F.col(column).isNull(), severity)


def accepted_values(column: str, values: Sequence) -> RowCheck:
    """Nulls pass."""
    return RowCheck(f"accepted_values:{column}", ~F.col(column).isin(*values))


def _told(counts: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row for each check (name, severity, column of ``counts`` that holds its result)."""
    results = [
        F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), F.col(count).alias("n_failing"))
        for name, severity, count in checks
    ]
    return counts.select(F.inline(F.array(*results)))


def check_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Failing rows of every check, from one scan."""
    counts = df.agg(*[F.count_if(check.fails).alias(f"c{i}") for i, check in enumerate(checks)])
    return _told(counts, [(check.name, check.severity, f"c{i}") for i, check in enumerate(checks)])


def unique(df: DataFrame, *columns: str, severity: str = "error") -> DataFrame:
    """Keys that occur more than once. Counts combine on the map side, so a hot key does no harm."""
    keys = df.where(F.col(columns[0]).isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.count_if(F.col("n") > 1).alias("n_failing")).select(
        F.lit(f"unique:{','.join(columns)}").alias("check_name"), F.lit(severity).alias("severity"), "n_failing"
    )


def check_table(df: DataFrame, checks: Sequence[RowCheck], key: str, severity: str = "error") -> DataFrame:
    """Failing rows of every check, and repeated values of ``key`` (nulls don't count), from one scan and one shuffle.

    The row checks are counted along with the rows of a key, so the table is not read
    again for them; what is shuffled is one row of counts for each key and task.
    """
    fails = [F.count_if(check.fails).alias(f"c{i}") for i, check in enumerate(checks)]
    by_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *fails)
    totals = by_key.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
        *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(checks))],
    )
    told = [(check.name, check.severity, f"c{i}") for i, check in enumerate(checks)]
    return _told(totals, [*told, (f"unique:{key}", severity, "_repeated")])


def check_journeys(journeys: DataFrame) -> DataFrame:
    checks = [not_null("rental_id"), not_null("start_station_id"), not_null("end_station_id", "warn")]
    return check_table(journeys, checks, "rental_id")


def check_stations(stations: DataFrame) -> DataFrame:
    return check_table(stations, [not_null("station_id")], "station_id")


def check_collisions(collisions: DataFrame) -> DataFrame:
    checks = [not_null("collision_index"), accepted_values("collision_severity", [1, 2, 3])]
    return check_table(collisions, checks, "collision_index")


def missing_tables(store: TableStore, layer: str, names: Sequence[str]) -> DataFrame:
    missing = [(name,) for name in store.missing(layer, names)]
    return store.spark.createDataFrame(missing, "table_name string")


def check_layout(store: TableStore, layer: str, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each expected table: whether it is there, which of its columns are missing (sorted, joined by commas), and its rows.

    A missing table lacks all its columns and has no row count. Other columns than the
    expected ones do no harm. Rows are counted without reading a column.
    """
    result = None
    for name, columns in expected.items():
        there = store.exists(layer, name)
        table = store.read(layer, name) if there else None
        lacking = ",".join(sorted(set(columns) - set(table.columns if there else [])))
        counted = table.agg(F.count(F.lit(1)).alias("n_rows")) if there else store.spark.range(1).select(F.lit(None).cast("bigint").alias("n_rows"))
        row = counted.select(F.lit(name).alias("table_name"), F.lit(there).alias("is_there"), F.lit(lacking).alias("missing_columns"), "n_rows")
        result = row if result is None else result.unionByName(row)
    return result
