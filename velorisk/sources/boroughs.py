"""Static borough list."""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from velorisk import schemas

BOROUGH_FILE = Path(__file__).parent.parent / "data" / "boroughs.csv"


def read_boroughs(spark: SparkSession, path: str | None = None) -> DataFrame:
    """33 rows. The packaged copy is read by the driver, so that no executor needs the package's files."""
    if path is not None:
        return spark.read.option("header", True).schema(schemas.BOROUGHS).csv(path)
    lines = BOROUGH_FILE.read_text(encoding="utf-8").splitlines()[1:]
    return spark.createDataFrame([tuple(line.split(",")) for line in lines if line], schemas.BOROUGHS)
