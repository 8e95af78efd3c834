"""Quality rules: counts over a text, and a linear-chain conditional random field that marks its boilerplate lines."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import WHITE, RollingHash, byte_class, chained, map_batches, mixed, pieces, runs, utf8
from velorisk.llm.labels import SAMPLE_ROWS, labelled_sample

_SPACE = byte_class(WHITE)
_WORD = byte_class(WHITE, inverse=True)
_NOT_BREAK = byte_class("\n", inverse=True)
#: Characters that the base counts as symbols.
_SYMBOL = byte_class("#*$%&|<>")
_CLASSES = {
    "symbol": _SYMBOL,
    "upper": byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": byte_class("abcdefghijklmnopqrstuvwxyz"),
    "digit": byte_class("0123456789"),
    "mark": byte_class("!?|*/=_~{}[]"),
    "stop": byte_class(".:;"),
}
#: Least words, and most percent of words in repeated windows, of a text that isn't rejected outright.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Least share of words in content lines.
CONTENT_SHARE = 0.35
#: Feature columns of a line: a constant, shares cut at several levels, and flags.
_LEVELS = (0.02, 0.1, 0.25, 0.5, 0.8)
_SHARES = ("symbol", "upper", "digit", "mark", "stop", "echo", "repeat")
FEATURES = 1 + len(_SHARES) * len(_LEVELS) + 6
CONTENT, BOILERPLATE = 0, 1

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")
MEASURES = T.StructType([T.StructField(n, T.LongType(), False) for n in COUNTS])


@dataclass(frozen=True)
class Field:
    """Weights of a chain over two marks: per feature, between neighbours, and at the start."""

    unary: np.ndarray
    steps: np.ndarray
    start: np.ndarray


@dataclass
class Measured:
    counts: dict[str, np.ndarray]
    features: np.ndarray
    line_rows: np.ndarray
    line_words: np.ndarray


def measure(data: np.ndarray, offsets: np.ndarray) -> Measured:
    """Counts per row, and the features of every line with a word."""
    rows = len(offsets) - 1
    hashes = RollingHash(data)
    starts, ends, word_rows = runs(data, offsets, _WORD)
    words = hashes.of(starts, ends)
    windows, at = chained(words, word_rows, 3)
    windows = mixed(windows + word_rows[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
    again = at[often[which] > 1]
    repeated = np.zeros(len(words), bool)
    for k in range(3):
        repeated[again + k] = True
    line_starts, line_ends, line_rows = runs(data, offsets, _NOT_BREAK)
    first_word = np.searchsorted(starts, line_starts)
    line_words = np.searchsorted(starts, line_ends) - first_word
    full = line_words > 0
    line_starts, line_ends, line_rows = line_starts[full], line_ends[full], line_rows[full]
    first_word, line_words = first_word[full], line_words[full]
    keys = mixed(hashes.of(line_starts, line_ends) + line_rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    copy = np.ones(len(keys), bool)
    copy[first] = False
    points = _sums((data & 0xC0 != 0x80) & _WORD[data])
    symbol = _sums(_SYMBOL[data])

    def per_row(sums: np.ndarray) -> np.ndarray:
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def per_line(flags: np.ndarray) -> np.ndarray:
        sums = _sums(flags)
        return sums[line_ends] - sums[line_starts]

    letters = np.maximum(1, per_line(_WORD[data]))
    # A word equal to one of the two before it in its line.
    echo = np.zeros(len(words), bool)
    for back in (1, 2):
        echo[back:] |= (words[back:] == words[:-back]) & (word_rows[back:] == word_rows[:-back])
    echoes, repeats = _sums(echo), _sums(repeated)
    shares = {n: per_line(_CLASSES[n][data]) / letters for n in ("symbol", "digit", "mark", "stop")}
    cased = per_line(_CLASSES["upper"][data])
    shares["upper"] = cased / np.maximum(1, cased + per_line(_CLASSES["lower"][data]))
    last = first_word + line_words
    shares["echo"] = (echoes[last] - echoes[first_word]) / np.maximum(1, line_words)
    shares["repeat"] = (repeats[last] - repeats[first_word]) / np.maximum(1, line_words)
    final = data[line_ends - 1] if len(line_ends) else np.zeros(0, np.uint8)
    columns = [np.ones(len(line_starts))]
    columns += [shares[n] >= level for n in _SHARES for level in _LEVELS]
    columns += [copy, final == ord("."), line_words < 4, line_words < 10, line_words >= 40, letters / np.maximum(1, line_words) > 9]
    return Measured(
        {
            "n_words": np.bincount(word_rows, minlength=rows),
            "word_chars": per_row(points),
            "n_symbols": per_row(symbol),
            "n_dup_lines": np.bincount(line_rows[copy], minlength=rows),
            "n_repeat_words": np.bincount(word_rows[repeated], minlength=rows),
        },
        np.stack(columns, axis=1).astype(np.float32) if len(line_starts) else np.zeros((0, FEATURES), np.float32),
        line_rows,
        line_words,
    )


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


class Chains:
    """Lines grouped to sequences, longest first, so that step t of all sequences is one slice."""

    def __init__(self, rows: np.ndarray):
        _, begin, length = np.unique(rows, return_index=True, return_counts=True)
        order = np.argsort(-length, kind="stable")
        self.begin, self.length = begin[order], length[order]
        self.active = len(length) - np.searchsorted(np.sort(length), np.arange(1, (length.max() if len(length) else 0) + 1))

    def at(self, t: int) -> np.ndarray:
        return self.begin[: self.active[t]] + t


def viterbi(field: Field, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The likeliest marks; of equally likely ones content."""
    scores = features @ field.unary
    marks, chains = np.zeros(len(rows), np.int64), Chains(rows)
    if not len(rows):
        return marks
    best, back = np.zeros_like(scores), np.zeros(scores.shape, np.int64)
    best[chains.at(0)] = scores[chains.at(0)] + field.start
    for t in range(1, len(chains.active)):
        here = chains.at(t)
        ways = best[here - 1][:, :, None] + field.steps
        back[here] = ways.argmax(axis=1)
        best[here] = ways.max(axis=1) + scores[here]
    ends = chains.begin + chains.length - 1
    marks[ends] = best[ends].argmax(axis=1)
    for t in range(len(chains.active) - 1, 0, -1):
        here = chains.at(t)
        marks[here - 1] = back[here, marks[here]]
    return marks


def fit_field(features: np.ndarray, rows: np.ndarray, marks: np.ndarray, rounds: int = 120, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a ridge penalty, by gradient ascent over all sequences at once."""
    chains = Chains(rows)
    n = max(1, len(chains.begin))
    field = Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    if not len(rows):
        return field
    steps = [chains.at(t) for t in range(len(chains.active))]
    hot = np.eye(2)[marks]
    want_steps = np.zeros((2, 2))
    for here in steps[1:]:
        want_steps += hot[here - 1].T @ hot[here]
    want = [features.T @ hot, want_steps, hot[steps[0]].sum(axis=0)]
    weights = [field.unary, field.steps, field.start]
    moment, energy = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for k in range(1, rounds + 1):
        unary, move, start = weights
        scores = features @ unary
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[steps[0]] = scores[steps[0]] + start
        for here in steps[1:]:
            ahead[here] = scores[here] + np.logaddexp(*(ahead[here - 1][:, i, None] + move[i] for i in (0, 1)))
        for here in reversed(steps[1:]):
            onward = scores[here] + behind[here]
            behind[here - 1] = np.logaddexp(*(onward[:, j, None] + move[:, j] for j in (0, 1)))
        ends = chains.begin + chains.length - 1
        total = np.zeros(len(rows))
        whole = np.logaddexp(ahead[ends][:, 0], ahead[ends][:, 1])
        total[np.concatenate([np.arange(b, b + c) for b, c in zip(chains.begin, chains.length, strict=True)])] = np.repeat(
            whole, chains.length
        )
        chance = np.exp(ahead + behind - total[:, None])
        got_steps = np.zeros((2, 2))
        for here in steps[1:]:
            joint = ahead[here - 1][:, :, None] + move + (scores[here] + behind[here])[:, None, :] - total[here][:, None, None]
            got_steps += np.exp(joint).sum(axis=0)
        got = [features.T @ chance, got_steps, chance[steps[0]].sum(axis=0)]
        for i, w in enumerate(weights):
            slope = (want[i] - got[i]) / n - ridge * w
            moment[i] = 0.9 * moment[i] + 0.1 * slope
            energy[i] = 0.999 * energy[i] + 0.001 * slope**2
            w += 0.1 * (moment[i] / (1 - 0.9**k)) / (np.sqrt(energy[i] / (1 - 0.999**k)) + 1e-8)
    return Field(*weights)


def learn_field(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS // 2, text: str = "text") -> Field:
    """The field learned from ``labels.quality`` of at most ``most`` documents.

    Labels are of documents, marks of lines: a first field takes every line of a
    poor document for boilerplate, and the second one only those that the first,
    held to single lines, marks so; lines of good documents are content. Without
    labels all weights are 0 and every line counts as content.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            got = measure(*utf8(batch.column("text")))
            cuts = np.searchsorted(got.line_rows, np.arange(batch.num_rows + 1))
            packed = [got.features[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(packed, pa.binary())], ["doc_id", "label", "lines"]
            )

    sample = labelled_sample(docs, labels, "quality", most, text).where(F.length("text") > 0)
    found = sample.transform(map_batches, features, "doc_id long, label int, lines binary").toPandas().sort_values(["doc_id", "lines"])
    blocks = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found.lines]
    blocks = [(b, y) for b, y in zip(blocks, found.label, strict=True) if len(b)]
    if not blocks:
        return Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    lines = np.concatenate([b for b, _ in blocks])
    rows = np.repeat(np.arange(len(blocks)), [len(b) for b, _ in blocks])
    poor = np.repeat([y == 0 for _, y in blocks], [len(b) for b, _ in blocks])
    alone = fit_field(lines, np.arange(len(lines)), poor.astype(np.int64))
    marks = viterbi(alone, lines, np.arange(len(lines))) * poor
    return fit_field(lines, rows, marks)


def judge(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, and struct ``measures`` with the counts and the words in content lines.

    Whole texts are counted; a null text has no words. Rows may repeat, and other columns pass through inside ``row``.
    """
    sent = docs.sparkSession.sparkContext.broadcast((field.unary, field.steps, field.start))
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("measures", MEASURES, False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            got = measure(*utf8(batch.column("text")))
            content = viterbi(Field(*sent.value), got.features, got.line_rows) == CONTENT
            got.counts["content_words"] = np.bincount(
                got.line_rows[content], weights=got.line_words[content], minlength=batch.num_rows
            )
            measures = pa.StructArray.from_arrays([pa.array(got.counts[n].astype(np.int64)) for n in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column("row"), measures], ["row", "measures"])

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("text")).transform(map_batches, count, schema)


def base_failed(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def content_enough(content_words, n_words):
    return content_words >= CONTENT_SHARE * n_words
