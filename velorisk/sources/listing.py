"""Which files to read: name filter and the newest N by file number."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNEY_FILE = r"(?i)JourneyDataExtract.*\.csv$"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder. The contents are not read: only ``path`` is asked for."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    )


def journey_files(files: DataFrame) -> DataFrame:
    """Files whose name looks like a journey extract, whatever its case."""
    return files.where(F.col("path").rlike(JOURNEY_FILE))


def with_file_number(files: DataFrame) -> DataFrame:
    """Leading number of the file name; 0 without one."""
    digits = F.regexp_extract("path", r"/(\d+)JourneyDataExtract", 1)
    return files.withColumn("file_number", F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint")))


def newest_files(files: DataFrame, n: int | None = None) -> DataFrame:
    """The N files with the highest number, or all: 500 is newer than 99."""
    ordered = with_file_number(files).orderBy(F.desc("file_number"), "path")
    return ordered if n is None else ordered.limit(n)
