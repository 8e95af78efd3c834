"""A training corpus from raw documents: known language, no near copies, no benchmark text, mixed, written as tokens."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk.llm import decontaminate, language, mixing, neardup, shards
from velorisk.llm.common import held_out, materialise, read_table, scratch_path

#: Least score of the language that a document is kept for: an even split over four languages has 0.25.
LEAST_SCORE = 0.35


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. A null text, one without a letter, and one that fits no language go."""
    profiles = language.learn(docs.where(~held_out(F.col("doc_id"))))
    found = language.identify(docs, profiles)
    sure = (F.col("language.lang_pred") != language.UNKNOWN) & (F.col("language.score") >= LEAST_SCORE)
    return found.where(sure).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at a similarity of 0.80: the one with the smallest id.

    Rows are told apart by id and text: a row whose id repeats with another text is a
    document of its own, and of rows with equal id and text one stays. Rows without an
    id stay. An empty table gives an empty one.
    """
    found = neardup.near_duplicates(docs, neardup.Search(percent=80, words=5, close=0.75))
    found = materialise(found.where("doc_id IS NOT NULL").select("doc_id", "text_hash", "sole"), "near-duplicates")
    key = ["doc_id", "text_hash"]
    gone = found.where("NOT sole").select(*key).distinct()
    again = found.where("sole").groupBy(*key).count().where("count > 1").select(*key, F.lit(True).alias("_again"))
    columns = [F.col("_row")[c].alias(c) for c in docs.columns]
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    left = rows.join(gone, key, "left_anti")
    if again.isEmpty():
        return left.select(columns)
    left = materialise(left.join(again, key, "left"), "repeated-rows")
    once = left.where("_again").dropDuplicates(key)
    return left.where("_again IS NULL").unionByName(once).select(columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    found = decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark"), n=10)
    return found.where("hits.n_hit = 0").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says. Targets are shares among the domains that the labels have; no others can be told."""
    labels = read_table(spark, sf_dir, "labels")
    there = {r.quality for r in labels.select("quality").where(F.col("quality").isin(list(mixing.TARGETS))).distinct().collect()}
    found = mixing.mix(docs, labels, {c: x for c, x in mixing.TARGETS.items() if c in there} or mixing.TARGETS)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.where("copies > 0").select("row.*", times.alias("_time")).drop("_time")


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids in training order; a row per sequence."""
    return shards.write_shards(docs, scratch_path(spark, "shards"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_shards", as_tokens),
]

#: No stage is plain SQL: profiles, trees, classifier and tokens are computed. tests/llm compares each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what its predecessor wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
