"""Quality classifier: kernel ridge regression over document statistics, with calibrated scores.

Random Fourier features stand for a Gaussian kernel: the product of two documents'
features approximates the kernel of their statistics. Their normal equations are sums
over documents, so every task adds up its own and only the sums travel. An isotonic
fit over a fold that the regression never saw turns its value into a score.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import LOWER, UPPER, WHITE, RollingHash, byte_class, chained, map_batches, mixed, pieces, runs, utf8

_WORD, _NOT_BREAK = byte_class(WHITE, inverse=True), byte_class("\n", inverse=True)
#: Shares of a text's bytes outside white space, by class.
_CLASSES = {
    "upper": byte_class(UPPER),
    "lower": byte_class(LOWER),
    "digit": byte_class("0123456789"),
    "stop": byte_class(".!?"),
    "pause": byte_class(",;:"),
    "quote": byte_class("'\"()[]-"),
    "symbol": byte_class("#*$%&|<>@_~^{}=+/\\`"),
    "wide": byte_class(bytes(range(0x80, 0x100))),
}
STATISTICS = (
    "log_words", "log_lines", "word_bytes", "word_bytes_spread", "longest_word", "line_words", "short_lines", "stopped_lines",
    "copied_lines", "copied_words", "distinct_words", "echoes", "marked_words", "capital_words", "entropy", *_CLASSES,
)


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for every text; all 0 for a text without a word."""
    rows, hashes = len(offsets) - 1, RollingHash(data)
    starts, ends, of_word = runs(data, offsets, _WORD)
    line_starts, line_ends, of_line = runs(data, offsets, _NOT_BREAK)
    words, size = hashes.of(starts, ends), (ends - starts).astype(float)
    n_words, n_lines = np.bincount(of_word, minlength=rows), np.bincount(of_line, minlength=rows)
    each_word, each_line = np.maximum(n_words, 1), np.maximum(n_lines, 1)

    def share(flags: np.ndarray, of: np.ndarray, each: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flags, minlength=rows) / each

    def first_of(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        """True where a key is met first in its text."""
        met = np.zeros(len(keys), bool)
        met[np.unique(mixed(keys + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]] = True
        return met

    line_words = np.searchsorted(starts, line_ends) - np.searchsorted(starts, line_starts)
    windows, at = chained(words, of_word, 3)
    again = np.zeros(len(words), bool)
    again[at[~first_of(windows, of_word[at])] + 2] = True
    echo = np.zeros(len(words), bool)
    for back in (1, 2):
        echo[back:] |= (words[back:] == words[:-back]) & (of_word[back:] == of_word[:-back])
    mean = share(size, of_word, each_word)
    letter = _CLASSES["upper"] | _CLASSES["lower"] | _CLASSES["wide"]
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    first = data[starts] if len(starts) else np.zeros(0, np.uint8)
    final = data[line_ends - 1] if len(line_ends) else np.zeros(0, np.uint8)
    longest = np.zeros(rows)
    np.maximum.at(longest, of_word, size)
    of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    inside = _WORD[data]
    n_bytes = np.maximum(1, np.bincount(of_byte[inside], minlength=rows))
    counts = np.bincount(of_byte[inside] * 256 + data[inside], minlength=rows * 256).reshape(rows, 256)
    part = counts / n_bytes[:, None]
    entropy = -(part * np.log2(np.where(part > 0, part, 1))).sum(1)
    columns = [
        np.log1p(n_words), np.log1p(n_lines), mean, np.sqrt(np.maximum(0, share(size**2, of_word, each_word) - mean**2)), np.log1p(longest),
        np.log1p(n_words / each_line), share(line_words < 4, of_line, each_line), share(_CLASSES["stop"][final], of_line, each_line),
        share(~first_of(hashes.of(line_starts, line_ends), of_line), of_line, each_line), share(again, of_word, each_word),
        share(first_of(words, of_word), of_word, np.maximum(1, n_words**0.8)), share(echo, of_word, each_word),
        share(~letter[last], of_word, each_word), share(_CLASSES["upper"][first], of_word, each_word), entropy,
        *(counts[:, flags].sum(1) / n_bytes for flags in _CLASSES.values()),
    ]
    return np.where(n_words[:, None] > 0, np.stack(columns, 1), 0.0).astype(np.float32)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, and ``statistics`` of the whole text; of a null text as of an empty one."""
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("statistics", T.ArrayType(T.FloatType()), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch["row"], _lists(measure(*utf8(batch["text"])))], ["row", "statistics"])

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("text")).transform(map_batches, work, schema)


def _lists(table: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * table.shape[1], pa.int32()), pa.array(table.ravel()))


def _table(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), len(STATISTICS))


@dataclass(frozen=True)
class Kernel:
    """Random Fourier features of scaled statistics: ``size`` cosines whose products approximate exp(-|x - y|² / 2 width²)."""

    mean: np.ndarray
    spread: np.ndarray
    size: int = 384
    width: float = 3.0
    seed: int = 12

    @cached_property
    def _drawn(self) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(self.seed)
        return random.normal(0, 1 / self.width, (len(self.mean), self.size)), random.uniform(0, 2 * np.pi, self.size)

    def features(self, statistics: np.ndarray) -> np.ndarray:
        """A last column of ones is the constant term. Outliers count as 5 spreads from the mean."""
        turns, shift = self._drawn
        scaled = np.clip((statistics - self.mean) / self.spread, -5, 5)
        return np.hstack([np.sqrt(2 / self.size) * np.cos(scaled @ turns + shift), np.ones((len(scaled), 1))])


@dataclass(frozen=True)
class Model:
    kernel: Kernel
    weights: np.ndarray
    raw: np.ndarray
    score: np.ndarray

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(statistics), self.score[0])
        return np.interp(self.kernel.features(statistics) @ self.weights, self.raw, self.score)


def isotonic(raw: np.ndarray, label_sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The nondecreasing values closest to the mean labels in weighted squares, for ascending ``raw``: neighbours out of order are pooled."""
    totals, sizes, spans = [], [], []
    for total, n in zip(label_sums, counts, strict=True):
        totals.append(float(total))
        sizes.append(float(n))
        spans.append(1)
        while len(totals) > 1 and totals[-2] * sizes[-1] >= totals[-1] * sizes[-2]:
            for stack in (totals, sizes, spans):
                last = stack.pop()
                stack[-1] += last
    return np.repeat(np.array(totals) / np.array(sizes), spans) if len(raw) else np.zeros(0)


#: Raw values are rounded to this before calibration, within -1 and 2: at most 3,001 groups reach the driver.
STEP = 1e-3
#: Partial sums are added up in so many groups first, so that no task meets those of all tasks.
GROUPS = 64


def normal_equations(rows: DataFrame, kernel: Kernel) -> tuple[np.ndarray, np.ndarray, float]:
    """Gram matrix of the features, their products with the labels, and the number of rows, of ``statistics`` and ``label``.

    A task sends one row for each row of the matrix; these are added up in two steps, by group and then in all. The
    driver gets one matrix, whatever the number of documents.
    """
    width = kernel.size + 1
    schema = "at int, part int, sums array<double>"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((width, width + 1))
        for batch in batches:
            z = kernel.features(_table(batch["statistics"]))
            total += z.T @ np.hstack([z, np.asarray(batch["label"], float)[:, None]])
        part = np.full(width, TaskContext.get().partitionId() % GROUPS, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(part), _lists(total)], ["at", "part", "sums"])

    def added(table: pa.Table) -> pa.Table:
        sums = np.asarray(table["sums"].combine_chunks().flatten()).reshape(len(table), width + 1).sum(0)
        return pa.table({"at": table["at"][:1], "part": pa.array([0], pa.int32()), "sums": _lists(sums[None])})

    sums = map_batches(rows.select("statistics", "label"), partial, schema)
    sums = sums.groupBy("at", "part").applyInArrow(added, schema).groupBy("at").applyInArrow(added, schema)
    found = np.zeros((width, width + 1))
    for r in sums.select("at", "sums").toLocalIterator():
        found[r["at"]] = r["sums"]
    return found[:, :-1], found[:, -1], found[-1, -2]


def learn(measured: DataFrame, labels: DataFrame, label: str = "quality", ridge: float = 1e-4, size: int = 384, width: float = 3.0) -> Model:
    """Fitted on all rows of ``measured`` (doc_id, statistics) whose id has a label in ``labels``; a fifth of the ids calibrates.

    Null ids and labels are left out; of several labels of one id the largest holds. With
    labels of one value every score is that value, without labels 0.5.
    """
    chosen = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = measured.select("doc_id", "statistics").join(chosen, "doc_id").withColumn("_fold", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0)
    at = [F.get("statistics", F.lit(i)).cast("double") for i in range(len(STATISTICS))]
    scale = rows.agg(
        F.avg("label").alias("label"), F.array(*[F.avg(x) for x in at]).alias("mean"), F.array(*[F.stddev_pop(x) for x in at]).alias("spread")
    ).first()
    if scale.label is None or scale.label in (0.0, 1.0):
        value = 0.5 if scale.label is None else scale.label
        nothing = np.zeros(0)
        return Model(Kernel(nothing, nothing), nothing, nothing, np.array([value]))
    kernel = Kernel(np.array(scale.mean), np.maximum(np.array(scale.spread), 1e-3), size, width)
    gram, products, n = normal_equations(rows.where("NOT _fold"), kernel)
    penalty = np.full(len(gram), ridge * max(n, 1.0))
    penalty[-1] = 1e-9  # the constant term is free
    weights = np.linalg.solve(gram + np.diag(penalty), products)

    def raw_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(kernel.features(_table(batch["statistics"])) @ weights, -1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(raw / STEP).astype(np.int64)), batch["label"]], ["bin", "label"])

    # Few labels may all lie outside the fold; then the same rows calibrate.
    fold = rows.where("_fold") if not rows.where("_fold").isEmpty() else rows
    bins = map_batches(fold.select("statistics", "label"), raw_values, "bin bigint, label int").groupBy("bin")
    bins = sorted(bins.agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).collect())
    raw = np.array([b.bin * STEP for b in bins])
    return Model(kernel, weights, raw, isotonic(raw, [b.ones for b in bins], [b.n for b in bins]))


def with_score(measured: DataFrame, model: Model) -> DataFrame:
    """``measured`` with a column ``score`` in place of ``statistics``: a value from 0 to 1 for every row."""
    kept = [c for c in measured.columns if c != "statistics"]
    schema = T.StructType([*(measured.schema[c] for c in kept), T.StructField("score", T.DoubleType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(model.scores(_table(batch["statistics"])))], [*kept, "score"])

    return map_batches(measured, work, schema)
