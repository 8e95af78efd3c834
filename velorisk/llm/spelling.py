"""Spelling variants: words one insertion, deletion or replacement apart, found by partition-and-enumerate signatures.

A word's letters with their place among equal letters, (a,1), (a,2), (b,1), …, are the
ones of a binary vector. One edit changes at most two of them. The possible elements
are dealt to ``parts`` sets; a pair of near words then agrees on all sets but two, so
every choice of two sets to leave out gives a signature, and near words share one.
Letters alone say little where words are made of the same syllables, so each signature
is split by half a word: one edit leaves the first or the second half as it was.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorisk.llm.common import LOWER, UPPER, materialise

#: Letters of a word; À to ÿ takes in × and ÷, as the pattern says.
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Sets that the elements are dealt to: more of them make signatures longer and more numerous.
PARTS = 5


def damaged_words(docs: DataFrame, least: int = 7, every: int = 31, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Column word: every run of letters with A-Z lowered, a letter taken out of one in ``every``.

    Which run loses a letter, and which one, follows from the CRC of ``<key>:<run>``.
    Words of fewer than ``least`` letters are left out, before and after. A null text has
    no words, a null key counts as an empty one.
    """
    run = F.translate("run", UPPER, LOWER)
    found = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({LETTERS}{{{least},}})"), F.lit(1))).alias("run"),
    ).select("_key", run.alias("run"))
    h = F.crc32(F.concat("_key", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return found.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= least)


def vocabulary(words: DataFrame, least_n: int = 2) -> DataFrame:
    """Distinct words with their number n of occurrences, from ``least_n`` on. Counts combine before they are shuffled."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


def _element_sets(word: Column, parts: int) -> Column:
    """One hash for each of ``parts`` sets, of the word's elements that were dealt to it."""
    letters = F.split(word, "")

    def elements(letter: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(F.filter(letters, lambda x: x == letter)))
        return F.transform(places, lambda place: F.xxhash64(letter, place))

    every = F.flatten(F.transform(F.array_distinct(letters), elements))

    def of_set(p: int) -> Column:
        # Elements differ, so their xor tells sets apart whatever their order.
        inside = F.filter(every, lambda e: F.pmod(e, F.lit(parts)) == p)
        return F.aggregate(inside, F.lit(0).cast("bigint"), lambda total, e: total.bitwiseXOR(e))

    return F.array(*[of_set(p) for p in range(parts)])


def _signatures(sets: Column, parts: int) -> Column:
    """A hash for each choice of two sets to leave out."""
    left_out = enumerate(combinations(range(parts), 2))
    return F.array(*[F.xxhash64(F.lit(i), *[F.get(sets, F.lit(p)) for p in range(parts) if p not in out]) for i, out in left_out])


def _halves(word: Column) -> Column:
    """First and last letters, half as many as the shorter word of a pair has; a word can be the shorter or the longer."""
    size = F.length(word)
    lengths = [F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")]
    ends = [
        F.xxhash64(F.lit(side), part)
        for n in lengths
        for side, part in ((0, F.substring(word, F.lit(1), n)), (1, F.substring(word, size - n + 1, n)))
    ]
    return F.array_distinct(F.array(*ends))


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """Columns a, n_a, b, n_b: every pair of words, a before b, that one insertion, deletion or replacement makes equal.

    ``words`` has distinct ``word`` of two letters or more and ``n``. The signatures are
    equi-joined, the test runs inside the join, and a pair that shares several signatures
    is told once. A crowded signature is split by adaptive execution.
    """
    keyed = words.withColumn("_sets", _element_sets(F.col("word"), parts))
    keyed = keyed.select("word", "n", _signatures(F.col("_sets"), parts).alias("_s"), _halves(F.col("word")).alias("_h"))
    # Both explosions are narrow; the two sides of the join are one shuffle, read twice.
    keyed = keyed.select("word", "n", "_h", F.explode("_s").alias("_s")).select("word", "n", "_s", F.explode("_h").alias("_h"))
    keyed = keyed.select(F.xxhash64("_s", "_h").alias("key"), "word", "n")
    left = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    apart = F.abs(F.length("a") - F.length("b")) <= 1
    close = apart & (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1)
    return left.hint("merge").join(right, "key").where(close).select("a", "n_a", "b", "n_b").distinct()


def with_roots(forms: DataFrame) -> DataFrame:
    """Columns word and root for rows (word, form): the last word that the forms lead to.

    Each round replaces a word's target by its target's target, so rounds grow with the
    logarithm of the longest chain. Forms must not run in a circle.
    """
    reached = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not reached.where("moved").isEmpty():
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = reached.drop("moved").join(further, "root", "left")
        step = step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        reached = materialise(step, "roots")
    return reached.drop("moved")


def variants(words: DataFrame, ratio: int = 10, parts: int = PARTS) -> DataFrame:
    """Every word with the more frequent near word that it is a variant of, if there is one.

    ``words`` has distinct ``word`` and ``n``. Columns word, n, n_near (near words), form
    (the near word of largest n, the first in code-point order of equals, if its n is
    ``ratio`` times the word's or more, else null), form_n, root (where the forms lead,
    the word itself without one). An empty table gives an empty result.
    """
    words = materialise(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, parts)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    found = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    )
    grown = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.rank")).alias("near_n")
    )
    is_form = F.col("near_n") >= F.col("n") * ratio
    told = materialise(
        grown.select(
            "word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")
        ),
        "variants",
    )
    roots = with_roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
