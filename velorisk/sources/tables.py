"""Named tables in layers: full replace, views, reads and existence checks."""

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

STAGING, INTERMEDIATE, SPATIAL, MARTS, RAW = "staging", "intermediate", "spatial_layer", "marts", "raw"
SEEDS = "seeds"


class TableStore:
    """Parquet tables ``<root>/<layer>/<name>``, or catalog tables ``layer.name`` without a root."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self._views: dict[tuple[str, str], DataFrame] = {}

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def replace(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Replace a table and return its row count, observed during the write itself.

        The new table is written beside the old one, as a folder or as a catalog table,
        and takes its place when it is complete, so a job that dies leaves the old one.
        """
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.root:
            fresh = f"{self.root}/{layer}/.{name}-{uuid.uuid4().hex}"
            try:
                writer.parquet(fresh)
            except Exception:
                self._delete(fresh)
                raise
            self._swap(fresh, self._path(layer, name))
        else:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            self._recover(layer, name)
            fresh = f"{name}__fresh_{uuid.uuid4().hex}"
            # A table gets its entry in the catalog after its last row, so one with an entry is whole.
            writer.format("parquet").saveAsTable(f"{layer}.{fresh}")
            self._put_in_place(layer, name, fresh)
        return counted.get["rows"]

    def _put_in_place(self, layer: str, name: str, fresh: str) -> None:
        """Two renames in the catalog; :meth:`_recover` finishes a swap as long as ``__old`` stands there."""
        if self.spark.catalog.tableExists(f"{layer}.{name}"):
            self.spark.sql(f"ALTER TABLE {layer}.{name} RENAME TO {layer}.{name}__old")
        self._rename(layer, fresh, name)
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}__old")

    def _rename(self, layer: str, fresh: str, name: str) -> None:
        self.spark.sql(f"ALTER TABLE {layer}.{fresh} RENAME TO {layer}.{name}")
        self._find_partitions(layer, name)

    def _find_partitions(self, layer: str, name: str) -> None:
        """Renaming moves the folder, but partitions are listed under their old paths."""
        if any(c.isPartition for c in self.spark.catalog.listColumns(f"{layer}.{name}")):
            self.spark.sql(f"MSCK REPAIR TABLE {layer}.{name} SYNC PARTITIONS")

    def _recover(self, layer: str, name: str) -> None:
        """Finish a swap that was cut short, and drop what it or a failed one left.

        Every table with an entry is whole: if the name is free, the new table takes it, else the old one comes back.
        A store expects no other writer of the same table.
        """
        if not self.spark.catalog.databaseExists(layer):
            return
        found = self.spark.sql(f"SHOW TABLES IN {layer} LIKE '{name}__*'").collect()
        left = sorted(r.tableName for r in found if r.tableName == f"{name}__old" or r.tableName.startswith(f"{name}__fresh_"))
        if not left:
            return
        if self.spark.catalog.tableExists(f"{layer}.{name}"):
            self._find_partitions(layer, name)
        elif left:
            # The new one sorts before the old one.
            self._rename(layer, left[0], name)
            left = left[1:]
        for table in left:
            self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")

    def _hadoop(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        place, system = self._hadoop(path)
        system.delete(place, True)

    def _swap(self, fresh: str, path: str) -> None:
        new, system = self._hadoop(fresh)
        place, old = self._hadoop(path)[0], self._hadoop(f"{fresh}-old")[0]
        replaced = system.exists(place)
        if replaced and not system.rename(place, old):
            raise OSError(f"cannot put {path} aside")
        if not system.rename(new, place):
            raise OSError(f"cannot put the new table at {path}")
        if replaced:
            system.delete(old, True)
        # Spark may hold the old listing.
        self.spark.catalog.refreshByPath(path)

    def view(self, layer: str, name: str, df: DataFrame) -> None:
        """Register a lazy view: its filters and projections merge into whatever reads it."""
        self._views[(layer, name)] = df
        df.createOrReplaceTempView(f"{layer}_{name}")

    def read(self, layer: str, name: str) -> DataFrame:
        if (layer, name) in self._views:
            return self._views[(layer, name)]
        if self.root:
            return self.spark.read.parquet(self._path(layer, name))
        self._recover(layer, name)
        return self.spark.table(f"{layer}.{name}")

    def exists(self, layer: str, name: str) -> bool:
        if (layer, name) in self._views:
            return True
        if not self.root:
            self._recover(layer, name)
            return self.spark.catalog.tableExists(f"{layer}.{name}")
        try:
            self.read(layer, name)
        except AnalysisException:
            return False
        return True

    def missing(self, layer: str, names: Sequence[str]) -> list[str]:
        return [name for name in names if not self.exists(layer, name)]


def materialise_model(store: TableStore, layer: str, name: str, df: DataFrame) -> int | None:
    """Staging models are views, every other layer holds tables."""
    if layer == STAGING:
        store.view(layer, name, df)
        return None
    return store.replace(layer, name, df)
