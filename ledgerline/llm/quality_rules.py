"""Quality rules: fixed rules first, then a calibrated n-gram classifier.

Hashed word uni- and bigrams and character trigrams feed a logistic
regression, fitted on a bounded sample of labelled rows of the training folds
(``per_class`` rows of either label). A fifth of the sample, kept from the
fit, calibrates the score (Platt scaling). Documents are scored in Arrow
batches and kept when no rule fails and the probability reaches the threshold.

Defined results: null counts as an empty text, which has no words and so fails
the rules; without both labels in the sample every document that passes the
rules is kept; rows repeat as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_of
from ledgerline.llm.features import Adam, char_grams, sigmoid, word_grams
from ledgerline.llm.labelled import label_counts, sample_labels, with_texts

PER_CLASS = 3_000   # bound of the labelled sample, per label
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
THRESHOLD = 0.5
BITS = 13           # buckets of each kind of n-gram
GROUPS = 3
EPOCHS, BATCH, RATE, DECAY = 15, 128, 0.05, 1e-4

# Fixed values of the contract.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) < len(windows):
        again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
        covered = np.zeros(len(words), bool)
        for k in range(WINDOW):
            covered[k: k + len(windows)] |= again
        repeated = int(covered.sum())
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def buckets(text: str | None) -> list[np.ndarray]:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    return [word_grams(words, 1, BITS), word_grams(words, 2, BITS), char_grams(data, 3, BITS)]


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: roots of the shares within each kind."""
    ids, values = [], []
    for g, found in enumerate(buckets(text)):
        if len(found):
            at, n = np.unique(found, return_counts=True)
            ids.append(at.astype(np.int32) + (g << BITS))
            values.append(np.sqrt(n / len(found)).astype(np.float32))
    return (np.concatenate(ids), np.concatenate(values)) if ids else (np.empty(0, np.int32), np.empty(0, np.float32))


@dataclass
class NgramModel:
    weights: np.ndarray  # GROUPS x 2^BITS
    bias: float
    slope: float = 1.0   # of the calibration
    shift: float = 0.0

    def margin(self, text: str | None) -> float:
        z = self.bias
        for g, found in enumerate(buckets(text)):
            if len(found):
                n = np.bincount(found, minlength=1 << BITS)
                z += float(np.sqrt(n) @ self.weights[g]) / len(found) ** 0.5
        return z

    def probability(self, texts: list[str | None]) -> np.ndarray:
        z = np.fromiter(map(self.margin, texts), float, len(texts))
        return sigmoid(self.slope * z + self.shift)


def fit_logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed=0) -> NgramModel:
    """Minibatch Adam on the sparse rows; both labels weigh the same."""
    dim = GROUPS << BITS
    w, step, rng = np.zeros(dim + 1), Adam(dim + 1, RATE), np.random.default_rng(seed)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            part = order[at: at + BATCH]
            ids = np.concatenate([rows[i][0] for i in part])
            values = np.concatenate([rows[i][1] for i in part])
            row = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            z = np.bincount(row, w[ids] * values, minlength=len(part)) + w[-1]
            off = (sigmoid(z) - y[part]) * weight[part] / len(part)
            grad = np.append(np.bincount(ids, off[row] * values, minlength=dim), off.sum())
            step.step(w, grad + DECAY * w)
    return NgramModel(w[:-1].reshape(GROUPS, -1).astype(np.float32), float(w[-1]))


def platt(z: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins of unseen rows, by
    Newton steps; rows are weighted back to the labels' share ``prior``."""
    weight = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum()))
    goal = np.where(y == 1, 1 - 1 / (2 + (y == 1).sum()), 1 / (2 + (y == 0).sum()))
    x, ab = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ ab)
        grad = x.T @ (weight * (p - goal))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        ab -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(ab[0], 0.05)), float(ab[1])


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
          per_class=PER_CLASS) -> NgramModel | None:
    """None where the labelled sample lacks one of the two labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sparse(t) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                                   pa.array([r[1] for r in rows], pa.list_(pa.float32()))],
                                  names=["h", "label", "ids", "vals"])

    zeros, ones = label_counts(labels, id_col, label_col)
    sample = with_texts(sample_labels(labels, id_col, label_col, per_class, salt=9), docs, id_col, text_col)
    table = (sample.select(F.xxhash64("id").alias("h"), "label", "text")
             .mapInArrow(run, "h long, label int, ids array<int>, vals array<float>").toArrow().sort_by("h"))
    y = table.column("label").to_numpy()
    if not (0 < y.sum() < len(y)):
        return None
    rows = [(np.asarray(i.values), np.asarray(v.values))
            for i, v in zip(table.column("ids"), table.column("vals"), strict=True)]
    held = table.column("h").to_numpy() % 5 == 0
    fit = np.flatnonzero(~held) if 0 < y[~held].sum() < (~held).sum() else np.arange(len(y))
    model = fit_logistic([rows[i] for i in fit], y[fit])
    unseen = np.flatnonzero(held)
    if 0 < y[unseen].sum() < len(unseen):
        flat = model.weights.ravel()
        z = np.array([flat[rows[i][0]] @ rows[i][1] for i in unseen]) + model.bias
        model.slope, model.shift = platt(z, y[unseen], ones / (ones + zeros))
    return model


def apply_rules(docs: DataFrame, model: NgramModel | None, id_col="doc_id", text_col="text",
                threshold=THRESHOLD) -> DataFrame:
    """One row per input row: id, the five measures, base_failed, probability, kept."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = np.array([measures(t) for t in texts], np.int64).reshape(-1, len(names))
            failed = (found[:, 0] < MIN_WORDS) | (100 * found[:, 4] > MAX_REPEAT_PERCENT * found[:, 0])
            p = np.ones(len(texts)) if model is None else model.probability(texts)
            yield pa.record_batch([batch.column(0), *map(pa.array, found.T), pa.array(failed), pa.array(p),
                                   pa.array(~failed & (p >= threshold))],
                                  names=["id", *names, "base_failed", "probability", "kept"])

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, " + ", ".join(f"{n} long" for n in names)
        + ", base_failed boolean, probability double, kept boolean")
