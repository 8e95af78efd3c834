"""The registered query of each operator, over its whole table with production parameters."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk.llm import decontaminate, kernel, language, lines, mixing, neardup, pivots, quality, repeats, shards, spelling, toxicity, warc
from velorisk.llm.common import held_out, materialise, read_table, scratch_path


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.page_records(read_table(spark, sf_dir, "pages")), path)
    back = warc.read_archive(spark, path)
    is_revisit = F.col("record_type") == "revisit"
    return back.select(
        warc.page_id_of(F.col("record_id")).alias("page_id"),
        F.when(is_revisit, F.col("payload_bytes")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(is_revisit, F.col("payload_digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        warc.page_id_of(F.col("refers_to")).alias("refers_to"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_common_lines(read_table(spark, sf_dir, "documents"), min_docs=10, min_key_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = neardup.near_duplicates(docs, neardup.Search(percent=85, words=5))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark"), n=10)
    named = F.array_sort(F.transform("hits.items", lambda i: i.cast("string")))
    return found.select(
        "row.doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mixing.mix(docs, read_table(spark, sf_dir, "labels"))
    return mixed.select("row.doc_id", "tokens", "posterior", "rate", "copies", "targets", "reached")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    profiles = language.learn(docs.where(~held_out(F.col("doc_id"))))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "language.lang_pred", "language.score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.learn_field(docs, read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    m = {n: F.col(f"measures.{n}") for n in quality.COUNTS}
    failed = quality.base_failed(m["n_words"], m["n_repeat_words"])
    return quality.judge(docs, field).select(
        "row.doc_id",
        *(m[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"),
        (~failed & quality.content_enough(m["content_words"], m["n_words"])).alias("kept"),
        m["content_words"].alias("content_words"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, labels))
    return scored.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.drop_repeats(read_table(spark, sf_dir, "documents"), length=400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shards.write_shards(docs, scratch_path(spark, "shards"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.damaged_words(read_table(spark, sf_dir, "documents"), least=7, every=31)
    found = spelling.variants(spelling.vocabulary(words, least_n=2), ratio=10)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialise(kernel.with_statistics(docs).select("row.doc_id", "statistics"), "statistics")
    model = kernel.learn(measured, read_table(spark, sf_dir, "labels").where(~held))
    scored = kernel.with_score(measured, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = pivots.cluster(read_table(spark, sf_dir, "embeddings"), pivots.Clustering(clusters=8, rounds=10, seed="3"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = F.get(F.array(*map(F.lit, digests)), F.col("cluster")) if digests else F.lit(None).cast("string")
    return pivots.with_inertia(assigned).select(
        F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", named.alias("centroid_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_line_dedup,
        op3_near_duplicates,
        op4_decontamination,
        op5_mixing,
        op6_language_id,
        op7_quality,
        op8_toxicity,
        op9_repeats,
        op10_token_shards,
        op11_spelling,
        op12_kernel_quality,
        op13_pivot_clusters,
    )
}
