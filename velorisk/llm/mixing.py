"""Mixing to target weights: soft domains from a labelled-table classifier, rates by projected gradient least squares."""

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import WHITE, byte_class, map_batches, materialise, pieces, runs, utf8
from velorisk.llm.labels import SAMPLE_ROWS, labelled_sample
from velorisk.llm.quality import FEATURES, measure

_WORD = byte_class(WHITE, inverse=True)
#: Domains are the values of ``labels.quality``; shares of tokens that the mixture shall have.
TARGETS = {0: 0.02, 1: 0.98}
#: A residual of this share of the targets' sum is told as a warning.
TOLD = 1e-3


@dataclass(frozen=True)
class Domains:
    """Classes in ascending order and the weights of a softmax over document features."""

    classes: list[int]
    weights: np.ndarray


def document_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the line features by words, with a constant, and the number of words, per row."""
    got = measure(data, offsets)
    rows = len(offsets) - 1
    tokens = got.counts["n_words"]
    out = np.zeros((rows, FEATURES), np.float64)
    for k in range(FEATURES):
        out[:, k] = np.bincount(got.line_rows, weights=got.features[:, k] * got.line_words, minlength=rows)
    out /= np.maximum(1, tokens)[:, None]
    out[:, 0] = 1
    return out, tokens


def posteriors(domains: Domains, features: np.ndarray) -> np.ndarray:
    raw = features @ domains.weights
    raw = np.exp(raw - raw.max(axis=1, keepdims=True))
    return raw / raw.sum(axis=1, keepdims=True)


def learn_domains(
    docs: DataFrame, labels: DataFrame, classes: list[int], label: str = "quality", most: int = SAMPLE_ROWS, text: str = "text"
) -> Domains:
    """A softmax fitted on at most ``most`` labelled documents; without labels all domains are equally likely."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found, _ = document_features(*utf8(batch.column("text")))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1, dtype=np.int32) * FEATURES), pa.array(found.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), lists], ["doc_id", "label", "x"])

    sample = labelled_sample(docs, labels, label, most, text).transform(map_batches, work, "doc_id long, label int, x array<double>")
    rows = sorted((r.doc_id, r.label, r.x) for r in sample.toLocalIterator() if r.label in classes)
    weights = np.zeros((FEATURES, len(classes)))
    if rows:
        x, y = np.array([r[2] for r in rows]), np.eye(len(classes))[[classes.index(r[1]) for r in rows]]
        moment, energy = np.zeros_like(weights), np.zeros_like(weights)
        for k in range(1, 301):
            step = x.T @ (posteriors(Domains(classes, weights), x) - y) / len(x) + 1e-4 * weights
            moment, energy = 0.9 * moment + 0.1 * step, 0.999 * energy + 0.001 * step**2
            weights = weights - 0.1 * (moment / (1 - 0.9**k)) / (np.sqrt(energy / (1 - 0.999**k)) + 1e-8)
        weights[0, [classes.index(c) for c in classes if c not in {r[1] for r in rows}]] = -np.inf
    return Domains(classes, weights)


def member(docs: DataFrame, domains: Domains, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, its ``tokens`` (words) and its ``posterior`` over the domains."""
    sent = docs.sparkSession.sparkContext.broadcast((domains.classes, domains.weights))
    schema = T.StructType(
        [
            T.StructField("row", docs.schema, False),
            T.StructField("tokens", T.LongType(), False),
            T.StructField("posterior", T.ArrayType(T.DoubleType(), False), False),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found, tokens = document_features(*utf8(batch.column("text")))
            chance = posteriors(Domains(*sent.value), found)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(chance) + 1, dtype=np.int32) * chance.shape[1]), pa.array(chance.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(tokens), lists], ["row", "tokens", "posterior"])

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("text")).transform(map_batches, work, schema)


@dataclass(frozen=True)
class Rates:
    """Steps that lead every document's rate from 1 to the fitted one, the totals reached, and what is left to the targets.

    ``scale`` is one over the mass of each domain; a step is a direction over the domains and a share of momentum.
    """

    scale: np.ndarray
    steps: list[tuple[np.ndarray, float]]
    reached: np.ndarray
    residual: np.ndarray


def fit_rates(
    members: DataFrame, targets: np.ndarray, rounds: int = 60, within: float = 1e-6, store_every: int = 8
) -> Rates:
    """Nonnegative rates w whose totals sum(w t p) come as close to the targets as least squares allows.

    ``members`` has columns t (share of all tokens) and p0, p1, ... (the posterior).
    Projected gradient: w <- max(0, y - d (p . r) / bound), where r is the residual of
    the totals at y and d = sum(p / mass of the domain) lets documents of a rare domain
    move as fast as others. ``bound`` is the largest eigenvalue of sum(d t p p'), so a
    step never overshoots. y runs ahead of w by momentum, which ends whenever the
    objective would rise. The fit ends when the totals are met, or when no rate moves by
    more than ``within`` under a step, which is the projected gradient, or after
    ``rounds``. Targets that nonnegative rates can meet take some 20 rounds; others are
    approached without ever moving away, to a few hundredths of all tokens in 60 rounds,
    since the best rates then grow without end on few documents. A round is one
    aggregation over a narrow table; the driver sees totals. Rates are never collected,
    they follow from the list of steps.
    """
    k = len(targets)
    p = [F.col(f"p{i}") for i in range(k)]
    mass = np.array(members.agg(*[F.coalesce(F.sum(F.col("t") * x), F.lit(0.0)) for x in p]).first(), float)
    scale = np.where(mass > 0, 1 / np.where(mass > 0, mass, 1), 0.0)
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    d = _pace(p, scale)
    found = members.agg(*[F.coalesce(F.sum(d * F.col("t") * p[i] * p[j]), F.lit(0.0)) for i, j in pairs]).first()
    matrix = np.zeros((k, k))
    for (i, j), value in zip(pairs, found, strict=True):
        matrix[i, j] = matrix[j, i] = value
    bound = max(float(np.linalg.eigvalsh(matrix)[-1]), 1e-300)
    narrow = members.select("t", *[f"p{i}" for i in range(k)], F.lit(1.0).alias("w"), F.lit(1.0).alias("y"), F.lit(1.0).alias("moved"))
    steps: list[tuple[np.ndarray, float]] = []
    lowest, theta = np.inf, 1.0
    for turn in range(rounds + 1):
        sums = [F.coalesce(F.sum(F.col(v) * F.col("t") * x), F.lit(0.0)) for v in ("w", "y") for x in p]
        got = narrow.agg(*sums, F.coalesce(F.max("moved"), F.lit(0.0))).first()
        reached, ahead = np.array(got[:k]), np.array(got[k : 2 * k])
        residual = reached - targets
        met = np.abs(residual).max() <= within * max(1.0, np.abs(targets).max())
        if met or got[2 * k] <= within or turn == rounds:
            break
        value = float(residual @ residual)
        if value > lowest:  # momentum has carried too far: begin anew from w
            theta, ahead = 1.0, reached
            narrow = narrow.withColumn("y", F.col("w"))
            steps.append((np.zeros(k), -1.0))
        lowest = value
        following = (1 + np.sqrt(1 + 4 * theta**2)) / 2
        steps.append(((ahead - targets) / bound, float((theta - 1) / following)))
        theta = following
        fresh, further = stepped(F.col("w"), F.col("y"), p, scale, *steps[-1])
        narrow = narrow.select("t", *p, fresh.alias("w"), further.alias("y"), F.abs(fresh - F.col("y")).alias("moved"))
        if (turn + 1) % store_every == 0:
            narrow = materialise(narrow, "rates")
    return Rates(scale, steps, reached, residual)


def _dot(p: list[Column], values: np.ndarray) -> Column:
    total = F.lit(0.0)
    for x, v in zip(p, values, strict=True):
        total = total + x * F.lit(float(v))
    return total


def _pace(p: list[Column], scale: np.ndarray) -> Column:
    return _dot(p, scale)


def stepped(w: Column, y: Column, p: list[Column], scale: np.ndarray, step: np.ndarray, momentum: float) -> tuple[Column, Column]:
    """Rates after a step, and the point ahead of them from which the next one starts."""
    fresh = F.greatest(F.lit(0.0), y - _pace(p, scale) * _dot(p, step))
    return fresh, fresh + (fresh - w) * F.lit(momentum)


def rate_of(posterior: Column, fit: Rates) -> Column:
    """The fitted rate of a document, from its posterior: all steps again. A momentum of -1 stands for a new start."""
    if not fit.steps:
        return F.lit(1.0)
    every = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in s]).alias("s"), F.lit(m).alias("m")) for s, m in fit.steps])

    def dot(values: Column) -> Column:
        return F.aggregate(F.zip_with(posterior, values, lambda x, v: x * v), F.lit(0.0), lambda total, x: total + x)

    pace = dot(F.array(*[F.lit(float(x)) for x in fit.scale]))

    def move(state: Column, step: Column) -> Column:
        fresh = F.greatest(F.lit(0.0), state["y"] - pace * dot(step["s"]))
        again = F.struct(state["w"].alias("w"), state["w"].alias("y"))
        return F.when(step["m"] < 0, again).otherwise(F.struct(fresh.alias("w"), (fresh + (fresh - state["w"]) * step["m"]).alias("y")))

    return F.aggregate(every, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("y")), move)["w"]


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[int, float] = TARGETS,  # noqa: B006
    label: str = "quality",
    total_tokens: float | None = None,
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with tokens, posterior (in order of the targets), rate, copies,
    and the same in every row: the ``targets`` in tokens, and the tokens ``reached``.

    Domains are the values of a column of ``labels``; ``targets`` gives their
    shares of the mixture's tokens, ``total_tokens`` its size, by default as many
    as there are. Rates are nonnegative, and with them the expected tokens of every
    domain, summed over soft memberships, meet the targets as well as least squares
    allows: they have no upper limit, so a rare domain with a large target is repeated
    often. A domain that no labelled document has cannot be told, its posterior is 0
    and its target is not reached. What stays unmet is also told as a warning. ``copies`` is the rate rounded up or down by a hash of the document
    with the chance that keeps its expectation. A null or empty text has no tokens
    and rate 1; equal rows get equal rates and copies. Without tokens all rates are
    1. Other columns pass through inside ``row``.
    """
    classes = sorted(targets)
    shares = np.array([targets[c] for c in classes], float)
    domains = learn_domains(docs, labels, classes, label, text=text)
    found = materialise(member(docs, domains, text), "members")
    everything = found.agg(F.sum("tokens")).first()[0] or 0
    scale = max(1, everything)
    p = [F.col("posterior")[i] for i in range(len(classes))]
    narrow = materialise(
        found.where("tokens > 0").select(
            (F.col("tokens") / F.lit(float(scale))).alias("t"),
            *(x.alias(f"p{i}") for i, x in enumerate(p)),
        ),
        "narrow",
    )
    wanted = shares / shares.sum() * ((total_tokens if total_tokens is not None else everything) / scale)
    nothing = Rates(np.zeros_like(wanted), [], np.zeros_like(wanted), -wanted)
    fit = fit_rates(narrow, wanted) if everything else nothing
    reached = fit.reached
    if np.abs(fit.residual).max() > TOLD * wanted.sum():
        warnings.warn(f"tokens aimed at {(wanted * scale).tolist()}, reached {(reached * scale).tolist()}", stacklevel=2)
    rate = rate_of(F.col("posterior"), fit)
    chance = F.pmod(F.xxhash64(F.lit(5), F.col("row.doc_id"), F.col(f"row.{text}")), F.lit(1 << 40)) / float(1 << 40)
    rated = found.withColumn("rate", F.when(F.col("tokens") > 0, rate).otherwise(F.lit(1.0)))
    told = {"targets": wanted * scale, "reached": reached * scale}
    lists = {name: F.array(*(F.lit(float(x)) for x in values)) for name, values in told.items()}
    return rated.withColumn("copies", F.floor(F.col("rate") + chance)).withColumns(lists)
