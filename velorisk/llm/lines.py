"""Line deduplication: lines that many documents share go."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk.llm.common import LOWER, UPPER, WHITE, materialise, salted_semi


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(WHITE))


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents without the lines whose key stands in at least ``min_docs`` of them.

    Columns: doc_id, n_lines, n_dropped, kept (text). Each row of ``docs`` is one
    document and keeps its row, also where ids repeat or are null. A null or empty
    text is one empty line; keys shorter than ``min_key_chars`` code points never
    count. An empty table gives an empty table. Other columns are not looked at.

    A document counts once per key because its keys are made distinct within the
    row, so the count needs one shuffle, summed on the map side. Keys travel as
    md5. The lines of a hot key are dealt to several tasks, and what goes back to
    a document are line numbers.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        whole.alias("text"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("rid"),
        F.xxhash64(F.col(doc_id), whole).alias("version"),
    )

    def hashed(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.length(key) >= min_key_chars, F.md5(key))

    keys = materialise(
        base.select("rid", "version", F.transform(F.split("text", "\n", -1), hashed).alias("keys")), "line-keys"
    )
    common = (
        keys.select(F.explode(F.array_distinct("keys")).alias("key"))
        .where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
        .select("key")
    )
    places = keys.select("rid", "version", F.posexplode("keys").alias("at", "key")).where("key IS NOT NULL")
    gone = (
        salted_semi(places, common, ["key"], F.col("version"))
        .groupBy("rid", "version")
        .agg(F.collect_set("at").alias("gone"))
    )
    split = base.join(gone, ["rid", "version"], "left").select(
        "doc_id",
        F.split("text", "\n", -1).alias("lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
    )
    # ``lines`` is used twice, so that Catalyst keeps it as a column and doesn't split again for every line.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.transform(left, lambda at: F.get("lines", at)), "\n").alias("kept"),
    )
