"""Document quality from a linear-chain conditional random field over lines (operator 5).

Every line is labelled good or bad from features of itself and of the lines before and after
it; a chain of two states links the labels of neighbouring lines. A document's score is the
mean of its lines' forward-backward marginals, weighted by length, put through a logistic
curve fitted on the training documents.

Only documents are labelled, and a bad one may hold good lines. So lines are told apart first, by a
logistic model of each line's own features under its document's label. The lines of a bad document
that this model finds good are labelled good, all but its worst one; those of good documents all
are. The field is fitted to these labels, which change within documents. It is fitted on the driver from a bounded sample: at
most ``TRAIN_DOCS`` documents of each label, the first by a hash of their id, of at most
``TRAIN_LINES`` lines and ``TRAIN_CHARS`` characters each. Scoring covers all lines of all documents.

Null text counts as empty, which is one empty line. Repeated rows are scored one by one. Labels
with a null id or label are not used; without any usable label of both kinds the score is the
share of known labels that are good, or 0.5. Other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonarium.llm.bpe import _powers, chunks
from clonarium.llm.common import documents

TRAIN_DOCS, TRAIN_LINES, TRAIN_CHARS = 2500, 400, 200_000
ROUNDS, RATE, PENALTY = 250, 0.05, 1e-4
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _BANG, _BAR, _SIGN, _OTHER = range(9)
_KINDS = 9
_BASE = 0x9E3779B97F4A7C15


@lru_cache(1)
def _kinds() -> np.ndarray:
    table = np.full(0x110000, _OTHER, np.uint8)
    for point in range(0x10000):
        kind = unicodedata.category(chr(point))
        if kind[0] == "L":
            table[point] = _UPPER if kind in ("Lu", "Lt") else _LOWER
        elif kind[0] == "N":
            table[point] = _DIGIT
        elif kind[0] == "Z":
            table[point] = _SPACE
    for chars, kind in ((" \t\r\f\v", _SPACE), (".,;:?'\"()-", _STOP), ("!", _BANG), ("|", _BAR), ("#$%&*@^~<>{}[]\\/=+_`", _SIGN)):
        table[[ord(c) for c in chars]] = kind
    return table


FEATURES = ("log_length", "lower", "upper", "digit", "space", "stop", "bang", "bar", "sign", "other",
            "upper_of_letters", "word_length", "ends_sentence", "empty", "seen_before", "first", "last", "word_again")


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, its length, lines per text) for texts laid end to end."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.append(np.flatnonzero(points == 10), len(points))
    starts = np.append(0, ends[:-1] + 1)
    per_text = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
    size = ends - starts
    kinds = _kinds()[points]
    out = np.zeros((len(size), len(FEATURES)))
    some = np.maximum(size, 1)
    for kind in range(_KINDS):
        sums = np.append(0, np.cumsum(kinds == kind, dtype=np.int64))
        out[:, 1 + kind] = sums[ends] - sums[starts]
    letters = out[:, 1 + _LOWER] + out[:, 1 + _UPPER]
    out[:, 10] = out[:, 1 + _UPPER] / np.maximum(letters, 1)
    out[:, 11] = np.minimum(size / (out[:, 1 + _SPACE] + 1) / 10, 3)
    # A line holds no line break, so the one counted as "other" at its end is outside.
    out[:, 1 : 1 + _KINDS] /= some[:, None]
    out[:, 0] = np.log1p(size) / 5
    final = points[np.maximum(ends - 1, 0)] if len(points) else np.zeros(len(ends), np.uint32)
    out[:, 12] = np.isin(final, [ord(c) for c in ".!?"]) & (size > 0)
    out[:, 13] = size == 0
    text = np.repeat(np.arange(len(texts)), per_text)
    room = 1 << max(len(points) + 1, 1 << 20).bit_length()
    hashes = np.append(np.uint64(0), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, room)[: len(points)]))
    line = (hashes[ends] - hashes[starts]) * _powers(pow(_BASE, -1, 1 << 64), room)[starts]
    out[:, 14] = pd.DataFrame({"text": text, "line": line}).duplicated().to_numpy()
    first = np.cumsum(per_text) - per_text
    out[first, 15] = 1
    out[first + per_text - 1, 16] = 1
    # The share of a line's words that equal the word before them.
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = (kinds != _SPACE) & (points != 10)
    begin, end = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    word = (hashes[end] - hashes[begin]) * _powers(pow(_BASE, -1, 1 << 64), room)[begin]
    of_line = np.searchsorted(starts, begin, "right") - 1
    again = np.append(False, (word[1:] == word[:-1]) & (of_line[1:] == of_line[:-1]))[: len(word)]
    words = np.bincount(of_line, minlength=len(size))
    out[:, 17] = np.bincount(of_line, again, len(size)) / np.maximum(words, 1)
    return out, size, per_text


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """A line's own features, those of the line before and after, and a constant."""
    first = np.cumsum(per_text) - per_text
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[first] = 0
    after[first + per_text - 1] = 0
    return np.hstack([features, before, after, np.ones((len(features), 1))])


class Chains:
    """Positions of many chains, step by step, for vectorised passes over all of them."""

    def __init__(self, per_text: np.ndarray):
        order = np.argsort(-per_text, kind="stable")
        first = (np.cumsum(per_text) - per_text)[order]
        sizes = per_text[order]
        steps = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(steps), "left")
        self.steps = [first[:n] + t for t, n in enumerate(alive.tolist())]


def _message(odds: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Log odds of the next state given this one's; ``links`` are log weights [from, to]."""
    return np.logaddexp(odds + links[1, 1], links[0, 1]) - np.logaddexp(odds + links[1, 0], links[0, 0])


def forward_backward(unary: np.ndarray, links: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
    """Log odds from the lines up to each one, and from the lines after it."""
    ahead, behind = unary.copy(), np.zeros_like(unary)
    for last, here in zip(chains.steps, chains.steps[1:], strict=False):
        ahead[here] = unary[here] + _message(ahead[last[: len(here)]], links)
    for here, last in zip(chains.steps[::-1], chains.steps[-2::-1], strict=False):
        behind[last[: len(here)]] = _message(unary[here] + behind[here], links.T)
    return ahead, behind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights of a fitted field, the scaling of its inputs, and the final curve."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    links: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def unary(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        return with_neighbours((features - self.centre) / self.scale, per_text) @ self.weights

    def marginals(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """The probability that each line is good."""
        ahead, behind = forward_backward(self.unary(features, per_text), self.links, Chains(per_text))
        return _sigmoid(ahead + behind)

    def raw_scores(self, good: np.ndarray, size: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Length-weighted marginals, as clipped log odds."""
        first = np.cumsum(per_text) - per_text
        weight = np.maximum(size, 1).astype(float)
        mean = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean) - np.log1p(-mean)

    def score(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, lines, lines more likely bad) of each text."""
        parts = []
        for begin, end in chunks(texts):
            features, size, per_text = line_features(texts[begin:end])
            good = self.marginals(features, per_text)
            raw = self.raw_scores(good, size, per_text)
            first = np.cumsum(per_text) - per_text
            bad = np.add.reduceat((good < 0.5).astype(np.int64), first)
            parts.append((_sigmoid(self.slope * raw + self.shift), per_text, bad))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def line_labels(own: np.ndarray, per_text: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A label per line from its own features, scaled, and its document's label; see above."""
    text = np.repeat(np.arange(len(label)), per_text)
    inputs = np.hstack([own, np.ones((len(own), 1))])
    found = np.zeros(inputs.shape[1])
    # Newton's method; the penalty keeps separable lines from running off.
    for _ in range(25):
        p = _sigmoid(inputs @ found)
        slope = inputs.T @ (weight * (label[text] - p)) - PENALTY * found
        bend = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + PENALTY * np.eye(len(found))
        step = np.linalg.solve(bend, slope)
        found += step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    odds = inputs @ found
    wanted = (odds >= 0).astype(np.int64)
    first = np.cumsum(per_text) - per_text
    # A bad document's worst line stays bad.
    worst = np.minimum.reduceat(odds, first)[text] == odds
    wanted[worst & (label[text] == 0)] = 0
    wanted[label[text] == 1] = 1
    return wanted


def fit(features: np.ndarray, size: np.ndarray, per_text: np.ndarray, label: np.ndarray) -> Model:
    """Maximum likelihood of the lines' labels, both kinds of document weighing the same."""
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    model = Model(centre, scale, np.zeros(3 * features.shape[1] + 1), np.zeros((2, 2)))
    inputs = with_neighbours((features - centre) / scale, per_text)
    chains = Chains(per_text)
    share = np.array([max((label == 0).sum(), 1), max((label == 1).sum(), 1)])
    doc_weight = (len(label) / 2 / share)[label] / len(label)
    text = np.repeat(np.arange(len(label)), per_text)
    weight = (doc_weight / per_text)[text]
    wanted = line_labels(inputs[:, : features.shape[1]], per_text, label, weight).astype(float)
    moments = [np.zeros(model.weights.shape), np.zeros((2, 2)), np.zeros(model.weights.shape), np.zeros((2, 2))]
    for step in range(1, ROUNDS + 1):
        unary = inputs @ model.weights
        ahead, behind = forward_backward(unary, model.links, chains)
        slope_w = inputs.T @ (weight * (wanted - _sigmoid(ahead + behind))) - PENALTY * model.weights
        slope_l = -PENALTY * model.links
        for last, here in zip(chains.steps, chains.steps[1:], strict=False):
            last = last[: len(here)]
            from_odds, to_odds = ahead[last], unary[here] + behind[here]
            joint = np.stack([np.zeros_like(from_odds) + model.links[0, 0], to_odds + model.links[0, 1],
                              from_odds + model.links[1, 0], from_odds + to_odds + model.links[1, 1]])
            joint = np.exp(joint - joint.max(axis=0))
            joint /= joint.sum(axis=0)
            same = (2 * wanted[here] + wanted[last]).astype(int)
            seen = np.stack([same == 0, same == 2, same == 1, same == 3])
            slope_l += ((seen - joint) * weight[here]).sum(axis=1).reshape(2, 2)
        for i, (values, slope) in enumerate(((model.weights, slope_w), (model.links, slope_l))):
            moments[i] = 0.9 * moments[i] + 0.1 * slope
            moments[i + 2] = 0.999 * moments[i + 2] + 0.001 * slope**2
            values += RATE * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 2] / (1 - 0.999**step)) + 1e-9)
    raw = model.raw_scores(model.marginals(features, per_text), size, per_text)
    model.slope, model.shift = _logistic(raw, label.astype(float), doc_weight)
    return model


def _logistic(x: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's method with a small penalty."""
    inputs, found = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = _sigmoid(inputs @ found)
        slope = inputs.T @ (weight * (wanted - p)) - 1e-3 * found
        bend = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        found += step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    return float(found[0]), float(found[1])


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality") -> DataFrame:
    """(doc_id, text, label) of at most TRAIN_DOCS documents of each label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(usable & F.col("label").isin(0, 1))
    order = [F.xxhash64("doc_id"), "doc_id"]
    drawn = [known.where(F.col("label") == kind).orderBy(*order).limit(TRAIN_DOCS) for kind in (0, 1)]
    # At most 2 * TRAIN_DOCS rows of two numbers.
    sample = F.broadcast(drawn[0].union(drawn[1]))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return documents(docs).join(sample, "doc_id").where((breaks < TRAIN_LINES) & (F.length("text") <= TRAIN_CHARS))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality") -> Model | float:
    """A model, or the share of good labels where only one kind is known."""

    def describe(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if not texts:
                continue
            features, size, per_text = line_features(texts)
            first = np.cumsum(per_text) - per_text
            spans = list(zip(first.tolist(), (first + per_text).tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([features[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([size[a:b].tobytes() for a, b in spans], pa.binary())],
                names=["doc_id", "label", "features", "size"],
            )

    sample = training_sample(docs, labels, usable, label_col).select("doc_id", "text", "label")
    described = sample.mapInArrow(describe, "doc_id long, label int, features binary, size binary")
    rows = sorted((tuple(r) for r in described.collect()), key=lambda r: (r[0], r[1], bytes(r[2])))
    label = np.array([r[1] for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        return float(label.mean()) if len(label) else 0.5
    features = np.concatenate([np.frombuffer(r[2]).reshape(-1, len(FEATURES)) for r in rows])
    sizes = [np.frombuffer(r[3], np.int64) for r in rows]
    return fit(features, np.concatenate(sizes), np.array([len(s) for s in sizes]), label)


def score(docs: DataFrame, model: Model | float, *columns: str) -> DataFrame:
    """``doc_id``, ``text`` and ``columns`` with ``score``, ``n_lines`` and ``n_bad_lines``."""
    rows = documents(docs, *columns)

    def scored(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if not texts:
                continue
            if isinstance(model, Model):
                found, lines, bad = model.score(texts)
            else:
                lines = np.array([t.count("\n") + 1 for t in texts])
                found, bad = np.full(len(texts), model), lines * (model < 0.5)
            made = [pa.array(found), pa.array(lines), pa.array(bad)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "score", "n_lines", "n_bad_lines"])

    made = "score double, n_lines long, n_bad_lines long"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(scored, f"{fields}, {made}")
