"""Bounded samples of labelled documents for classifiers that are fitted on the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled documents a classifier is fitted on.
SAMPLE_ROWS = 8_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """Columns doc_id, text, label of at most ``most`` labelled ids, those with the smallest hash of the id.

    Null ids, texts and labels are left out; of several labels of one id the largest holds. The ids are a bounded
    list, so they are sent to the documents, whose texts are not shuffled.
    """
    chosen = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = docs.select("doc_id", F.col(text).alias("text")).where("text IS NOT NULL")
    return rows.join(F.broadcast(chosen), "doc_id")
