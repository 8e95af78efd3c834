"""Language identification by hyperdimensional profiles of letter trigrams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import map_batches, pieces

#: Letters are told apart as a-z and further classes by code point; 0 is the gap between words.
SYMBOLS = 48
GRAMS = SYMBOLS**3
#: Length of the random vectors.
DIMENSIONS = 2048
#: Learning refuses more languages than this; it bounds what is gathered and broadcast.
MOST_LANGUAGES = 200
UNKNOWN = "und"

ANSWER = T.StructType([T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])


@dataclass(frozen=True)
class Profiles:
    """Languages, and for each trigram its vector's dot product with each language's unit prototype."""

    languages: list[str]
    agreement: np.ndarray


def letter_vectors(dimensions: int = DIMENSIONS) -> np.ndarray:
    """One random vector of +1 and -1 per symbol, the same in every run."""
    return np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (SYMBOLS, dimensions))


def gram_vectors(first: int, letters: np.ndarray) -> np.ndarray:
    """Vectors of all trigrams that begin with one symbol: the letters permuted by place, then bound by product."""
    pairs = np.roll(letters, 1, axis=1)[:, None, :] * letters[None, :, :]
    return (np.roll(letters, 2, axis=1)[first] * pairs).reshape(SYMBOLS * SYMBOLS, -1)


def symbols(codes: np.ndarray) -> np.ndarray:
    """Symbol of each code point."""
    if not len(codes):
        return np.zeros(0, np.int64)
    table = np.zeros(int(codes.max()) + 1, np.int64)
    for code in np.flatnonzero(np.bincount(codes)):
        letter = chr(code).lower()[0]
        if letter.isalpha():
            table[code] = ord(letter) - 96 if "a" <= letter <= "z" else 27 + ord(letter) % (SYMBOLS - 27)
    return table[codes]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams and their rows; every run of other characters, and each end of a text, is one gap."""
    coded = [np.frombuffer(("\n" + (t or "") + "\n").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(c) for c in coded])
    line = symbols(np.concatenate(coded).astype(np.int64)) if coded else np.zeros(0, np.int64)
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != 0) | (line[:-1] != 0) | (rows[1:] != rows[:-1])
    line, rows = line[keep], rows[keep]
    whole = (rows[2:] == rows[:-2]) if len(rows) > 2 else np.zeros(0, bool)
    gram = (line[:-2] * SYMBOLS + line[1:-1]) * SYMBOLS + line[2:]
    return gram[: len(whole)][whole], rows[: len(whole)][whole]


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS, text: str = "text", lang: str = "lang") -> Profiles:
    """Prototypes from every row with a text and a language.

    Tasks count trigrams per language; the sums that reach the driver are bounded
    by languages times trigrams. A prototype is the bundle (weighted sum) of the
    trigram vectors. Without labelled rows there are no languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text"):
            found, rows = grams(batch.column("text").to_pylist())
            names = np.array(batch.column("lang").to_pylist(), object)
            for name in set(names.tolist()):
                mine = np.bincount(found[(names == name)[rows]], minlength=GRAMS)
                totals[name] = totals[name] + mine if name in totals else mine
        for name, counts in totals.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen)), pa.array(seen), pa.array(counts[seen])], ["lang", "gram", "n"]
            )

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    names = sorted(r.lang for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in the labels")
    sums = rows.transform(map_batches, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(names), GRAMS), np.float32)
    for part in sums.toPandas().groupby("lang"):
        counts[names.index(part[0]), part[1].gram.to_numpy()] = part[1].n.to_numpy()
    counts /= np.maximum(1, counts.sum(axis=1, keepdims=True))
    letters = letter_vectors(dimensions)
    side = SYMBOLS * SYMBOLS
    bundles = np.zeros((len(names), dimensions), np.float32)
    for first in range(SYMBOLS):
        if counts[:, first * side : (first + 1) * side].any():
            bundles += counts[:, first * side : (first + 1) * side] @ gram_vectors(first, letters)
    if len(names) > 1:
        bundles = bundles - bundles.mean(axis=0)
    bundles /= np.maximum(1e-12, np.linalg.norm(bundles, axis=1, keepdims=True))
    agreement = np.concatenate([gram_vectors(first, letters) @ bundles.T for first in range(SYMBOLS)])
    return Profiles(names, agreement.astype(np.float32))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, and struct ``language`` with ``lang_pred`` and ``score``.

    A document's vector is the bundle of its trigrams' vectors. Since the dot
    product is linear in the bundle, its agreement with a prototype is the sum over
    its trigrams of theirs, and a task never builds the long vector. The document's
    own length divides all cosines alike, so the nearest prototype and the score,
    its share among the positive cosines, do without it. A tie goes to the first
    language by name. A text that is null or has no letter is ``und`` with score 0, as
    is every text if nothing was learned. Other columns pass through inside ``row``.
    """
    sent = docs.sparkSession.sparkContext.broadcast((profiles.languages, profiles.agreement))
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("language", ANSWER, False)])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, agreement = sent.value
        columns = [np.ascontiguousarray(agreement[:, k]) for k in range(len(names))]
        labels = np.array([*names, UNKNOWN], object)
        for batch in pieces(batches, "text"):
            rows = batch.num_rows
            found, at = grams(batch.column("text").to_pylist())
            # The trigram of three gaps cannot occur; one letter gives a gram, so no gram means no letter.
            cosines = np.zeros((rows, max(1, len(names))))
            for k, column in enumerate(columns):
                cosines[:, k] = np.bincount(at, weights=column[found], minlength=rows)
            best = cosines.argmax(axis=1)
            top, total = cosines.max(axis=1), np.maximum(cosines, 0).sum(axis=1)
            known = (np.bincount(at, minlength=rows) > 0) & bool(names)
            score = np.where(known & (top > 0), top / np.where(total > 0, total, 1), 0.0)
            answer = pa.StructArray.from_arrays(
                [pa.array(labels[np.where(known, best, len(names))], pa.string()), pa.array(np.clip(score, 0, 1))],
                ["lang_pred", "score"],
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), answer], ["row", "language"])

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("text")).transform(map_batches, predict, schema)
