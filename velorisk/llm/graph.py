"""Connected components of links that stay distributed."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from velorisk.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """Columns node, root (smallest node of its component) for every node of ``links`` (columns a, b).

    Large-star and small-star steps in turn, until the links no longer change: the
    number of rounds grows with the logarithm of the longest path. Each step is a
    written table; what tells a change is observed while it is written. A node with
    very many links is split by adaptive execution, since the joins are on nodes and
    feed a distinct. The driver sees two numbers a round.
    """
    stars, seen = _stored(_pairs(links, "a", "b"))
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large, _ = _stored(_starred(both, large=True))
        stars, state = _stored(_starred(large, large=False))
        if state == seen:
            break
        seen = state
    leaves = stars.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    # A root is the end of links only.
    return leaves.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stored(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The written links, and their number and a sum over them that stands for their set."""
    seen = Observation()
    marks = F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("sum")
    stored = materialise(links.observe(seen, *marks), "links")
    return stored, tuple(sorted((k, int(v)) for k, v in seen.get.items()))


def _pairs(links: DataFrame, a: str, b: str) -> DataFrame:
    """Links from the larger to the smaller node, each once."""
    return links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()


def _starred(links: DataFrame, large: bool) -> DataFrame:
    """Every neighbour of a node, larger ones in a large star, linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    joined = links.join(least, "a")
    if large:
        return _pairs(joined.where("b > a"), "b", "least")
    return _pairs(joined.select("b", "least").unionByName(joined.select(F.col("a").alias("b"), "least")), "b", "least")
