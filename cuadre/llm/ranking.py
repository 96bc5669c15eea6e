"""Quality scores by Bradley-Terry pairwise ranking.

A document has the strength w . x, x being standardised features of its text. A pair of a good and a bad
document is won by the good one with probability 1 / (1 + exp(-w . (x_good - x_bad))); w minimises the
logistic loss over all pairs of a good and a bad labelled document by Newton's method. The cutoff is the quantile of the
strengths at the share of bad documents; the score is the logistic function of the strength, shifted so that the cutoff scores
`CUT_SCORE`.

Learning takes every labelled document. The pairs are not formed: what a document gives to the loss depends on the strengths of
the other class, which are gathered on `NODES` even nodes, each document shared by the two next to it, and the sums over
pairs are convolutions over the nodes. Tasks add up sums of fixed size, so the driver's part does not grow with the corpus.

Defined cases: null and empty texts have zero counts and are scored like any text; a document labelled twice
counts as bad if any of its labels is; null labels are not used; without a document of each class all weights are
0, and every score is CUT_SCORE; repeated rows are scored alike; an id with several texts is learned from one of them, that of
the least counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, per_batch, raw, small_side, written
from cuadre.llm.signals import NAMES, signals

NODES = 4_096
RIDGE = 1e-3
CUT_SCORE = 0.3


def features(counts: np.ndarray) -> np.ndarray:
    """Features by row from the counts of signals.NAMES."""
    c = {name: counts[:, k].astype(float) for k, name in enumerate(NAMES)}
    words, letters = np.maximum(c["n_words"], 1), np.maximum(c["n_upper"] + c["n_lower"], 1)
    lines, chars = np.maximum(c["n_lines"], 1), np.maximum(c["word_chars"], 1)
    bounded = [
        c["n_symbols"] / words, c["n_exclaims"] / words, c["n_upper"] / letters, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_same_next"] / words, c["n_digits"] / chars, c["n_pipes"] / words,
        1 - c["n_distinct"] / words,
    ]
    columns = [np.minimum(x, 1) for x in bounded]
    columns += [np.minimum(20 * x, 1) for x in bounded[:8]]  # tells a little from none
    columns += [np.log1p(c["n_words"]), np.minimum(c["word_chars"] / words, 30)]
    return np.stack(columns, axis=1)


@dataclass
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        shifted = self.strengths(x) - self.cut + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(shifted, -500, 500)))


#: What a pass over the labelled documents makes of some of them: a table of numbers, from their features and which are good.
Part = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: A pass: the parts of all documents added up, or, if so said, their largest numbers.
Pass = Callable[[Part, bool], np.ndarray]


def fit(x: np.ndarray, good: np.ndarray, bad_share: float) -> Model:
    """The model of the rows of `x`."""
    return fit_by(lambda part, largest: part(x, good), bad_share)


def fit_by(over: Pass, bad_share: float) -> Model:
    """The model of all documents that `over` passes over."""
    width = len(features(np.zeros((1, len(NAMES))))[0])

    def moments(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.stack([np.full(width, good.sum()), np.full(width, (~good).sum()), x.sum(axis=0), (x * x).sum(axis=0)])

    def extremes(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.stack([(-x).max(axis=0, initial=-np.inf), x.max(axis=0, initial=-np.inf)])

    n_good, n_bad, total, squares = over(moments, False)
    if not n_good[0] or not n_bad[0]:
        return Model(np.zeros(width), np.zeros(width), np.ones(width), 0.0)
    n_good, n_bad, rows = n_good[0], n_bad[0], n_good[0] + n_bad[0]
    mean = total / rows
    scale = np.maximum(np.sqrt(np.maximum(squares / rows - mean * mean, 0)), 1e-6)
    least, most = over(extremes, True) * [[-1], [1]]
    least, most = (least - mean) / scale, (most - mean) / scale
    w = np.zeros(width)
    for _ in range(30):
        step = _newton_step(over, w, mean, scale, _bounds(w, least, most), n_good * n_bad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    # each class weighs as much as it does among all labels
    weights = np.array([bad_share / n_bad, (1 - bad_share) / n_good])
    return Model(w, mean, scale, _quantile(over, w, mean, scale, _bounds(w, least, most), weights, bad_share))


def _bounds(w: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[float, float]:
    """Between which all strengths lie."""
    ends = np.sort(np.stack([w * least, w * most]), axis=0).sum(axis=1)
    return float(ends[0]) - 1e-3, float(ends[1]) + 1e-3


def _newton_step(over: Pass, w: np.ndarray, mean: np.ndarray, scale: np.ndarray, bounds: tuple[float, float], pairs: float) -> np.ndarray:
    """A step of Newton's method for the mean loss over all pairs."""
    n, (low, high) = NODES, bounds
    gap = (high - low) / (n - 1)
    nodes = low + gap * np.arange(n)

    def gathered(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        z = (x - mean) / scale
        place = np.clip((z @ w - low) / gap, 0, n - 1)
        left = np.minimum(place.astype(np.int64), n - 2)
        right_share = (place - left)[:, None]
        row = np.concatenate([np.ones((len(z), 1)), z], axis=1)
        sums = np.zeros((2 * n, row.shape[1]))
        np.add.at(sums, left + n * good, row * (1 - right_share))
        np.add.at(sums, left + 1 + n * good, row * right_share)
        return sums

    sums = over(gathered, False)
    bad, good = sums[:n], sums[n:]
    apart = gap * np.arange(n - 1, -n, -1.0)
    lost = 1 / (1 + np.exp(np.clip(-apart, -500, 500)))  # the chance that a bad document so much stronger wins

    def convolved(kernel: np.ndarray, values: np.ndarray) -> np.ndarray:
        size = 4 * n
        product = np.fft.rfft(values, size, axis=0) * np.fft.rfft(kernel, size)[:, None]
        return np.fft.irfft(product, size, axis=0)[n - 1 : 2 * n - 1]

    of_bad, curved_bad = convolved(lost, bad), convolved(lost * (1 - lost), bad)
    curved_good = convolved(lost * (1 - lost), good[:, :1])
    gradient = (good[:, :1] * of_bad[:, 1:] - good[:, 1:] * of_bad[:, :1]).sum(axis=0) / pairs + RIDGE * w
    across = good[:, 1:].T @ curved_bad[:, 1:]
    by_bad, by_good = curved_bad[:, 0], curved_good[:, 0]

    def curvatures(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        z = (x - mean) / scale
        strength = z @ w
        weight = np.where(good, np.interp(strength, nodes, by_bad), np.interp(strength, nodes, by_good))
        return (z * weight[:, None]).T @ z

    curvature = (over(curvatures, False) - across - across.T) / pairs + RIDGE * np.eye(len(w))
    return np.linalg.solve(curvature, gradient)


def _quantile(
    over: Pass, w: np.ndarray, mean: np.ndarray, scale: np.ndarray, bounds: tuple[float, float], weights: np.ndarray, share: float
) -> float:
    """The middle between the strengths next to the place that has `share` of the documents' weight below it."""
    below, (low, high) = 0.0, bounds
    for _ in range(3):
        edges = np.linspace(low, high, NODES + 1)

        def counts(x: np.ndarray, good: np.ndarray, edges: np.ndarray = edges) -> np.ndarray:
            at = np.searchsorted(edges, (x - mean) / scale @ w, side="right") - 1
            inside = (at >= 0) & (at < NODES)
            return np.stack([np.bincount(at[inside & of], minlength=NODES) for of in (~good, good)], axis=1).astype(float)

        up_to = below + np.cumsum(over(counts, False) @ weights)
        k = min(int(np.searchsorted(up_to, share + 1e-9, side="right")), NODES - 1)
        below, low, high = (up_to[k - 1] if k else below), edges[k], edges[k + 1]

    def sides(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        strength = (x - mean) / scale @ w
        lower = strength[strength < low].max(initial=-np.inf)
        return np.array([[lower, strength[strength < high].max(initial=-np.inf)]])

    ((lower, upper),) = over(sides, True)
    return float((lower + upper) / 2 if np.isfinite(lower) else upper)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from `docs` and `labels` (doc_id, quality: 1 good, 0 bad)."""
    return learn_counted(counted(docs.select(doc_id, text), text), labels, doc_id)


def learn_counted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> Model:
    """A model from documents whose texts `counted` has counted; all that have a label."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col(doc_id).alias("labelled"))
    known = written(known.agg((F.min("quality") == 1).alias("good")), "labelled")
    of_class = {r["good"]: r["rows"] for r in known.groupBy("good").agg(F.count("*").alias("rows")).collect()}
    bad_share = of_class.get(False, 0) / max(1, sum(of_class.values()))
    counts = docs.select(F.col(doc_id).alias("labelled"), "counts").join(small_side(known), "labelled")
    rows = counts.groupBy("labelled").agg(F.min("good").alias("good"), F.min("counts").alias("counts"))
    rows = written(rows.select("good", "counts"), "learned")
    return fit_by(lambda part, largest: _passed(rows, part, largest), bad_share)


def _passed(rows: DataFrame, part: Part, largest: bool) -> np.ndarray:
    """A pass over (good, counts): a task gives the numbers of its rows, which are merged place by place."""
    shape = part(features(np.zeros((0, len(NAMES)))), np.zeros(0, dtype=bool)).shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = None
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(NAMES))
            found = part(features(counts), batch.column(0).to_numpy(zero_copy_only=False).astype(bool))
            merged = found if merged is None else np.maximum(merged, found) if largest else merged + found
        if merged is not None:
            there = np.arange(len(merged)) if largest else np.flatnonzero(merged.any(axis=1))
            columns = [pa.array(there), *[pa.array(merged[there, i]) for i in range(merged.shape[1])]]
            yield pa.RecordBatch.from_arrays(columns, names=["place", *[f"v{i}" for i in range(merged.shape[1])]])

    columns = [f"v{i}" for i in range(shape[1])]
    given = rows.mapInArrow(run, ", ".join(["place long", *[f"{c} double" for c in columns]]))
    merge = F.max if largest else F.sum
    result = np.full(shape, -np.inf) if largest else np.zeros(shape)
    for place, *values in given.groupBy("place").agg(*[merge(c).alias(c) for c in columns]).collect():
        result[place] = values
    return result


def counted(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with the array `counts` of signals.NAMES in place of `text`."""
    carried = [c for c in docs.columns if c != text]
    prepared = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("text"))

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [signals(x) for x in raw(batch.column(batch.num_columns - 1))]
            column = pa.array(counts, pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*carried, "counts"])

        return one

    return per_batch(prepared, kinds(docs, carried, "counts array<long>"), make)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` and `predicted` in place of `text`."""
    return score_counted(counted(docs.drop("score", "predicted"), text), model)


def score_counted(docs: DataFrame, model: Model) -> DataFrame:
    """`docs`, whose texts `counted` has counted, with `score` and `predicted` in place of `counts`."""
    # numbers alone: a class would be looked up in the package, which executors need not have
    numbers = (model.weights.tolist(), model.mean.tolist(), model.scale.tolist(), model.cut)
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    carried = [c for c in docs.columns if c not in ("counts", "score", "predicted")]
    prepared = docs.select(*[F.col(f"`{c}`") for c in carried], "counts")

    def make():
        *arrays, cut = shared.value
        model = Model(*map(np.array, arrays), cut)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(batch.num_rows, len(NAMES))
            scores = model.scores(features(counts))
            predicted = pa.array((scores >= CUT_SCORE).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores), predicted], names=[*carried, "score", "predicted"]
            )

        return one

    return per_batch(prepared, kinds(docs, carried, "score double, predicted int"), make)
