"""Toxicity: a linear classifier over words whose score shall not change when identity terms are swapped."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import RollingHash, byte_class, map_batches, materialise, mixed, pieces, runs, utf8
from velorisk.llm.decontaminate import folded
from velorisk.llm.labels import SAMPLE_ROWS, labelled_sample

_WORD = byte_class(b" ", inverse=True)
#: Words that name groups of people, by kind; a term is swapped with the others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "muslimisch", "christlich", "jüdisch"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslime", "christen", "juden"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "transgender", "queer"),
    ("immigrants", "natives", "refugees", "foreigners", "migrants", "ausländer", "immigrés", "inmigrantes"),
    ("disabled", "deaf", "blind", "elderly", "young", "old"),
)
#: First bytes of a word that are features besides the word itself: related and inflected words share them.
STEMS = (4, 5, 6)
#: Least log-likelihood ratio of feature and label for a feature to be used, and the most features.
LEAST_EVIDENCE, MOST_FEATURES = 15.0, 20_000


@dataclass(frozen=True)
class Classifier:
    """Hashes of words in ascending order, their weights, and the constant."""

    words: np.ndarray
    weights: np.ndarray
    constant: float


def word_hash(word: str) -> int:
    data = np.frombuffer(folded(word.encode()), np.uint8)
    return int(RollingHash(data).of(np.array([0]), np.array([len(data)]))[0])


def term_features() -> list[list[list[int]]]:
    """The features of every identity term, its word first, by kind."""

    def of(term: str) -> list[int]:
        data = np.frombuffer(folded(term.encode()), np.uint8)
        found, _ = features(data, np.array([0, len(data)]))
        word = word_hash(term)
        return [word, *(int(f) for f in found if int(f) != word)]

    return [[of(term) for term in kind] for kind in IDENTITY_TERMS]


def features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every distinct feature of each text, by row; only the ``wanted`` ones if given (ascending)."""
    data = np.frombuffer(folded(data.tobytes()), np.uint8)
    starts, ends, rows = runs(data, offsets, _WORD)
    rolling = RollingHash(data)
    hashes, at = [rolling.of(starts, ends)], [rows]
    for size in STEMS:
        long = ends - starts > size
        hashes.append(mixed(rolling.of(starts[long], starts[long] + size), size))
        at.append(rows[long])
    if wanted is not None:
        # A table of the hashes' first bits throws most out; the rest is looked up.
        likely = np.zeros(1 << 20, bool)
        likely[wanted >> np.uint64(44)] = True
        for k, h in enumerate(hashes):
            maybe = np.flatnonzero(likely[h >> np.uint64(44)])
            h = h[maybe]
            if len(wanted):
                maybe = maybe[wanted[np.searchsorted(wanted, h).clip(max=len(wanted) - 1)] == h]
            hashes[k], at[k] = hashes[k][maybe], at[k][maybe]
    hashes, rows = np.concatenate(hashes), np.concatenate(at)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def evidence(toxic: Column, seen: Column, all_toxic: int, everything: int) -> Column:
    """Log-likelihood ratio of a feature's documents and the label."""
    share = all_toxic / everything

    def term(found: Column, expected: Column) -> Column:
        return F.when(found > 0, 2 * found * F.log(found / expected)).otherwise(0.0)

    return term(toxic, seen * share) + term(seen - toxic, seen * (1 - share))


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS, fairness: float = 1.0, text: str = "text"
) -> Classifier:
    """Fitted on at most ``most`` labelled documents (those with the smallest hash of their id), equal texts once.

    A text counts as the set of its words and their stems. Features are chosen by their evidence, counted by Spark;
    only those reach the driver. ``fairness`` weighs the squared change of the score when the identity terms of a
    text are swapped with others of their kind. Without toxic labels, or with no others, all scores are alike.
    """
    sample = labelled_sample(docs, labels, "toxic", most, text).groupBy("text").agg(F.max("label").alias("label"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, rows = features(*utf8(batch.column("text")))
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), lists], ["label", "tokens"])

    stored = materialise(sample.transform(map_batches, tokens, "label int, tokens array<long>"), "toxicity-sample")
    everything, toxic = stored.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < everything:
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), 3.0 if toxic else -3.0)
    counted = stored.select("label", F.explode("tokens").alias("token")).groupBy("token")
    counted = counted.agg(F.sum("label").alias("a"), F.count("*").alias("n")).where("n > 1")
    weighed = counted.select("token", evidence(F.col("a"), F.col("n"), toxic, everything).alias("e"))
    chosen = weighed.where(F.col("e") >= LEAST_EVIDENCE).orderBy(F.desc("e"), "token").limit(MOST_FEATURES).toPandas()
    terms = np.array([f for kind in term_features() for term in kind for f in term], np.uint64)
    words = np.union1d(chosen.token.to_numpy(np.int64).view(np.uint64), terms)
    known = F.array(*(F.lit(int(w)) for w in words.view(np.int64)))
    rows = stored.select("label", F.array_sort(F.array_intersect("tokens", known)).alias("tokens")).toPandas()
    rows = sorted(zip((tuple(t) for t in rows.tokens), rows.label, strict=True))
    return fit(words, [np.array(t, np.int64).view(np.uint64) for t, _ in rows], np.array([y for _, y in rows], float), fairness)


def fit(
    words: np.ndarray,
    texts: list[np.ndarray],
    toxic: np.ndarray,
    fairness: float = 1.0,
    rounds: int = 500,
    ridge: float = 2e-5,
) -> Classifier:
    """Logistic loss, a ridge penalty and the counterfactual penalty over the features ``words`` (ascending hashes), by
    gradient descent over all texts at once."""
    rows, flat = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.concatenate(texts)
    at = np.searchsorted(words, flat).clip(max=len(words) - 1)
    here = words[at] == flat
    rows, at = rows[here], at[here]
    # One pair for every text with a term and every other term of its kind: ``moved`` tells which features leave (-1)
    # and come (1) when the one becomes the other.
    partners: dict[int, list[tuple[list[int], list[int]]]] = {}
    for kind in term_features():
        places = [[int(np.searchsorted(words, np.uint64(f))) for f in term] for term in kind]
        for mine in places:
            partners[mine[0]] = [(mine, other) for other in places if other is not mine]
    pairs, which, moved, sign = [], [], [], []
    for row, word in zip(rows[np.isin(at, list(partners))].tolist(), at[np.isin(at, list(partners))].tolist(), strict=True):
        for mine, other in partners[word]:
            which += [len(pairs)] * (len(mine) + len(other))
            moved += mine + other
            sign += [-1.0] * len(mine) + [1.0] * len(other)
            pairs.append(row)
    pairs, which, moved, sign = np.array(pairs, np.int64), np.array(which, np.int64), np.array(moved, np.int64), np.array(sign)
    n = len(texts)
    weights, constant = np.zeros(len(words)), np.log(toxic.mean() / (1 - toxic.mean()))
    moment, energy = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for k in range(1, rounds + 1):
        raw = np.bincount(rows, weights=weights[at], minlength=n) + constant
        score = _squash(raw)
        pull = score - toxic
        if len(pairs):
            swapped = _squash(raw[pairs] + np.bincount(which, weights=sign * weights[moved], minlength=len(pairs)))
            gap = 2 * fairness * (score[pairs] - swapped)
            slope, slope_swapped = score[pairs] * (1 - score[pairs]), swapped * (1 - swapped)
            # Raising all weights of the text moves both scores; what is swapped moves the second one only.
            pull = pull + np.bincount(pairs, weights=gap * (slope - slope_swapped), minlength=n)
        step = np.bincount(at, weights=pull[rows], minlength=len(words)) / n + ridge * weights
        if len(pairs):
            turn = -gap * slope_swapped / n
            step += np.bincount(moved, weights=sign * turn[which], minlength=len(words))
        step = np.append(step, pull.mean())
        moment = 0.9 * moment + 0.1 * step
        energy = 0.999 * energy + 0.001 * step**2
        move = 0.1 * (moment / (1 - 0.9**k)) / (np.sqrt(energy / (1 - 0.999**k)) + 1e-8)
        weights, constant = weights - move[:-1], constant - move[-1]
    return Classifier(words, weights, float(constant))


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_toxicity(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, and ``score`` from 0 to 1.

    Whole texts are scored; a null or empty text has the score of no words. Rows
    may repeat, and other columns pass through inside ``row``.
    """
    sent = docs.sparkSession.sparkContext.broadcast((classifier.words, classifier.weights, classifier.constant))
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("score", T.DoubleType(), False)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(*sent.value)
        for batch in pieces(batches, "text"):
            words, rows = features(*utf8(batch.column("text")), model.words)
            weights = model.weights[np.searchsorted(model.words, words)]
            raw = np.bincount(rows, weights=weights, minlength=batch.num_rows) + model.constant
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(_squash(raw))], ["row", "score"])

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("text")).transform(map_batches, score, schema)
