"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad. A line's features describe it and both its neighbours; the chain
adds how likely labels follow each other. Forward-backward gives each line's marginal
probability of being good, and their mean, weighted by the lines' lengths, is the
document's quality, which a logistic curve fitted on the same labels turns into a score.

The labels are of documents. A document labelled good has good lines only; in one labelled
bad all lines count as bad at first, in a fit of lines without their chain, and then
those that the last fit finds bad, the worst of them at least.

Fitted on at most `TRAIN_DOCUMENTS` labelled rows, those of the smallest id hashes. Of a long
one the chain learns from `TRAIN_WINDOWS` windows of `WINDOW_LINES` lines, spread evenly over
it; the curve learns from the quality of whole texts, which tasks compute. Scores are of whole texts.

Defined cases: a null text is empty, and an empty text has one empty line; without labels
of both kinds every score is the share of good labels, or a half without any;
a repeated id among the labels counts once, as bad if any says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.textblocks import (
    blocks,
    byte_values,
    mix,
    spread_starts,
    substring_hashes,
    words,
)

TRAIN_DOCUMENTS = 5_000
TRAIN_WINDOWS = 8
WINDOW_LINES = 64
FITS = 3
STEPS = 80
THRESHOLD = 0.7
GOOD = 1

_CLASSES = {
    "symbols": b"*$%&#@^~_=+<>{}[]\\/",
    "shouts": b"!?",
    "bars": b"|",
    # Up to here per word, the others per byte.
    "capitals": bytes(range(ord("A"), ord("Z") + 1)),
    "digits": b"0123456789",
    "stops": b".,;:",
}
_MASKS = np.zeros((len(_CLASSES), 256), dtype=bool)
for _row, _bytes in enumerate(_CLASSES.values()):
    _MASKS[_row, list(_bytes)] = True
_PER_WORD = 3
_REPEAT_FACTORS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(1))
OWN_FEATURES = len(_CLASSES) + 6
FEATURES = 3 * OWN_FEATURES + 1


class Lines(NamedTuple):
    features: np.ndarray  # a row per line
    lengths: np.ndarray
    counts: np.ndarray  # lines of each document


class Model(NamedTuple):
    weights: np.ndarray  # log odds of good
    transitions: np.ndarray  # log potentials [from, to]
    slope: float
    intercept: float


def _repeated(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether three words in a row have stood in the same document before."""
    n = len(hashes)
    seen = np.zeros(n, dtype=bool)
    if n < 3:
        return seen
    owner = np.repeat(np.arange(len(counts)), counts)
    triple = hashes[:-2] * _REPEAT_FACTORS[0] + hashes[1:-1] * _REPEAT_FACTORS[1] + hashes[2:]
    inside = owner[:-2] == owner[2:]
    triple = mix(triple[inside] + owner[:-2][inside].astype(np.uint64))
    position = np.flatnonzero(inside)
    order = np.argsort(triple, kind="stable")
    again = np.zeros(len(order), dtype=bool)
    again[1:] = triple[order][1:] == triple[order][:-1]
    seen[position[order[again]]] = True
    return seen


def _echoed(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a word is one of the two words before it in its document."""
    owner = np.repeat(np.arange(len(counts)), counts)
    echo = np.zeros(len(hashes), dtype=bool)
    for back in (1, 2):
        echo[back:] |= (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
    return echo


def line_features(data: np.ndarray, starts: np.ndarray) -> Lines:
    breaks = np.flatnonzero(data == ord("\n"))
    # A line begins with its document and after each of its line breaks.
    begins = np.sort(np.concatenate((starts[:-1], breaks + 1)), kind="stable")
    counts = 1 + np.diff(np.searchsorted(breaks, starts))
    firsts = spread_starts(counts)
    ends = np.empty(len(begins), dtype=np.int64)
    ends[:-1] = begins[1:] - 1
    ends[firsts[1:] - 1] = starts[1:]
    lengths = ends - begins
    word_begins, word_ends, word_counts = words(data, starts)
    line_of = np.searchsorted(begins, word_begins, "right") - 1
    n_words = np.bincount(line_of, minlength=len(begins))
    hashes = substring_hashes(byte_values(data), word_begins, word_ends)
    over_words, over_bytes = np.maximum(n_words, 1), np.maximum(lengths, 1)
    columns = []
    for row, mask in enumerate(_MASKS):
        sums = np.concatenate(([0], np.cumsum(mask[data], dtype=np.int64)))
        over = over_words if row < _PER_WORD else over_bytes
        columns.append(np.minimum((sums[ends] - sums[begins]) / over, 1))
    for marked in (_repeated(hashes, word_counts), _echoed(hashes, word_counts)):
        columns.append(np.bincount(line_of, weights=marked, minlength=len(begins)) / over_words)
    columns.append(np.log1p(lengths) / 10)
    columns.append(np.minimum(lengths / over_words, 50) / 10)
    columns.append(np.log1p(n_words) / 10)
    columns.append((lengths == 0).astype(float))
    own = np.stack(columns, axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[firsts[:-1]] = 0
    after[firsts[1:] - 1] = 0
    one = np.ones((len(own), 1))
    return Lines(np.hstack((own, before, after, one)), lengths, counts)


def _padded(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as rows, the longest first, cut to nothing; and the row of each sequence."""
    order = np.argsort(-counts, kind="stable")
    return order, spread_starts(counts)[:-1][order]


def line_marginals(
    odds: np.ndarray, counts: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and expected label pairs [from, to] over all chains.

    All chains advance together, the longest first, so that those still running are a prefix.
    """
    order, first = _padded(odds, counts)
    lengths = counts[order]
    longest = int(lengths[0])
    running = np.searchsorted(-lengths, -np.arange(longest), "left")
    step = np.exp(transitions - transitions.max())
    good = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    emitted = np.stack((1 - good, good), axis=1)
    forward = np.empty((len(odds), 2))
    backward = np.ones((len(odds), 2))
    state = np.ones((len(order), 2))
    for t in range(longest):
        at = first[: running[t]] + t
        state = state[: running[t]]
        state = (state @ step if t else state) * emitted[at]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[: running[t + 1]] + t
        later = emitted[at + 1] * backward[at + 1]
        joint = forward[at][:, :, None] * step * later[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        state = later @ step.T
        backward[at] = state / state.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), pairs


def document_quality(lines: Lines, model: Model) -> np.ndarray:
    marginals, _ = line_marginals(lines.features @ model.weights, lines.counts, model.transitions)
    weights = np.maximum(lines.lengths, 1)
    starts = spread_starts(lines.counts)[:-1]
    return np.add.reduceat(marginals * weights, starts) / np.add.reduceat(weights, starts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit_chain(
    features: np.ndarray, labels: np.ndarray, counts: np.ndarray, model: Model, chained: bool
) -> Model:
    """Penalised conditional likelihood by Adam steps, on features of one scale.

    Unless ``chained``, the lines count as independent of each other.
    """
    size = len(model.weights)
    scale = np.maximum(np.sqrt((features**2).mean(axis=0)), 1e-3)
    features = features / scale
    model = model._replace(weights=model.weights * scale)
    point = np.concatenate((model.weights, model.transitions.ravel()))
    first, second = np.zeros_like(point), np.zeros_like(point)
    starts = spread_starts(counts)
    inner = np.ones(len(labels), dtype=bool)
    inner[starts[1:] - 1] = False
    at = np.flatnonzero(inner)
    observed = np.bincount(labels[at] * 2 + labels[at + 1], minlength=4)
    for step in range(1, STEPS + 1):
        marginals, expected = line_marginals(
            features @ point[:size], counts, point[size:].reshape(2, 2)
        )
        slope = np.concatenate((features.T @ (labels - marginals), observed - expected.ravel()))
        slope = slope / len(labels) - 1e-4 * point
        slope[size:] *= chained
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        point = point + 0.1 * move
    return model._replace(weights=point[:size] / scale, transitions=point[size:].reshape(2, 2))


def _fit_curve(quality: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by penalised Newton steps."""
    inputs = np.stack((quality, np.ones_like(quality)), axis=1)
    point = np.zeros(2)
    for _ in range(50):
        guess = _sigmoid(inputs @ point)
        slope = inputs.T @ (labels - guess) - 1e-2 * point
        bend = (inputs * (guess * (1 - guess))[:, None]).T @ inputs + 1e-2 * np.eye(2)
        point = point + np.linalg.solve(bend, slope)
    return float(point[0]), float(point[1])


def fit_model(lines: Lines, labels: np.ndarray) -> Model:
    """``labels``: 0 or 1 of each document."""
    constant = Model(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, 0.0)
    if len(np.unique(labels)) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        share = share if not len(labels) else min(max(float(labels.mean()), 1e-9), 1 - 1e-9)
        return constant._replace(intercept=float(np.log(share / (1 - share))))
    of_line = np.repeat(labels, lines.counts)
    starts = spread_starts(lines.counts)[:-1]
    model, targets = constant, of_line
    for fit in range(FITS):
        model = _fit_chain(lines.features, targets, lines.counts, model, chained=fit > 0)
        marginals, _ = line_marginals(
            lines.features @ model.weights, lines.counts, model.transitions
        )
        worst = np.repeat(np.minimum.reduceat(marginals, starts), lines.counts)
        targets = np.where((of_line == GOOD) | ((marginals > 0.5) & (marginals > worst)), 1, 0)
    return with_curve(model, document_quality(lines, model), labels)


def with_curve(model: Model, qualities: np.ndarray, labels: np.ndarray) -> Model:
    slope, intercept = _fit_curve(qualities, labels)
    return model._replace(slope=slope, intercept=intercept)


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        lines = line_features(block.data, block.starts)
        ends = spread_starts(lines.counts)
        for row, label in enumerate(block.rows.column("label").to_pylist()):
            cuts = np.arange(ends[row], ends[row + 1], WINDOW_LINES)
            # Spread evenly over a long document.
            chosen = np.unique(np.linspace(0, len(cuts) - 1, TRAIN_WINDOWS).round().astype(int))
            for cut in cuts[chosen]:
                window = slice(cut, min(cut + WINDOW_LINES, ends[row + 1]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": pa.array([label], pa.int32()),
                        "features": [lines.features[window].astype(np.float32).tobytes()],
                        "lengths": [lines.lengths[window].astype(np.int64).tobytes()],
                    }
                )


def _whole_qualities(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found = document_quality(line_features(block.data, block.starts), model)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("label"), pa.array(found)], names=["label", "quality"]
            )

    return run


def held_out(row_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on a bounded sample of the rows that are not held out."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCUMENTS)
    )
    # At most TRAIN_DOCUMENTS rows of two numbers are broadcast.
    sample = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = (
        sample.select("text", "label")
        .mapInArrow(_training_windows, "label int, features binary, lengths binary")
        .collect()
    )
    # Sums depend on the order, so the order is fixed.
    rows.sort(key=lambda r: (r.label, bytes(r.features)))
    features = [np.frombuffer(r.features, dtype=np.float32).reshape(-1, FEATURES) for r in rows]
    lengths = [np.frombuffer(r.lengths, dtype=np.int64) for r in rows]
    lines = Lines(
        np.concatenate([np.zeros((0, FEATURES), np.float32), *features]).astype(float),
        np.concatenate([np.zeros(0, np.int64), *lengths]),
        np.array([len(x) for x in lengths], dtype=np.int64),
    )
    model = fit_model(lines, np.array([r.label for r in rows], dtype=np.int64))
    if not model.slope:  # labels of one kind
        return model
    whole = (
        sample.select("text", "label")
        .mapInArrow(_whole_qualities(model), "label int, quality double")
        .collect()
    )
    whole.sort()
    return with_curve(model, np.array([r.quality for r in whole]), np.array([r.label for r in whole]))


def scores(data: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    quality = document_quality(line_features(data, starts), model)
    return _sigmoid(model.slope * quality + model.intercept)


def score_documents(
    documents: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Id, score and predicted label of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found = scores(block.data, block.starts, model)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("id"), pa.array(found)], names=["id", "score"]
            )

    rows = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def good_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are predicted good, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            keep = scores(block.data, block.starts, model) >= THRESHOLD
            if keep.any():
                yield block.rows.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)
