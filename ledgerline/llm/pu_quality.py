"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1 in the training folds; the
unlabelled set is web text of those folds with labels left aside. A linear
scorer on text statistics and hashed character trigrams minimises the
non-negative unbiased risk of Kiryo et al. (2017) with logistic loss,

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

stepping back along the bracket's gradient whenever a batch makes it negative.
The class prior is estimated as the share of label 1 among all labelled rows
of the training folds. The fit runs on two samples bounded by ``positives``
and ``unlabelled`` rows, chosen by hash; the samples' features are computed on
the executors, and only fixed-size vectors come to the driver. Scoring is one
pass over all documents with the weights (some kB) in the closure.

Defined results: null and empty texts get the score of a text without words;
without a positive the score is the prior everywhere (0.5 without labels);
rows repeat as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_bytes, fold_of, text_of, tidy
from ledgerline.llm.features import STATS, Adam, char_grams, root_shares, sigmoid, stats
from ledgerline.llm.labelled import (HELD_OUT_FOLDS, bounded, label_counts, sample_labels, training_fold,
                                     with_texts)

POSITIVES = 4_000    # bound of the sample of trusted positives
UNLABELLED = 8_000   # bound of the sample of unlabelled documents
THRESHOLD = 0.3
GRAM_BITS = 10
GRAM_SCALE = 4.0
STEPS, BATCH, RATE, DECAY = 3_000, 512, 0.05, 1e-5


def vector(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    shares = root_shares(char_grams(data, 3, GRAM_BITS), GRAM_BITS)
    return np.concatenate([stats(data, data.lower().split()), shares * GRAM_SCALE]).astype(np.float32)


@dataclass
class PUModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            x = (vector(t) - self.mean) / self.scale
            np.clip(x[: len(STATS)], -5, 5, out=x[: len(STATS)])
            out[i] = x @ self.weights + self.bias
        return sigmoid(out)


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed=0) -> PUModel:
    """Minimises the non-negative risk; both matrices hold :func:`vector` rows."""
    size = len(STATS)
    dim = size + (1 << GRAM_BITS)
    mean, scale = np.zeros(dim, np.float32), np.ones(dim, np.float32)
    if not len(positive) or not len(unlabelled):
        logit = np.log(prior / (1 - prior))
        return PUModel(mean, scale, np.zeros(dim, np.float32), float(logit), prior)
    mean[:size], scale[:size] = unlabelled[:, :size].mean(0), unlabelled[:, :size].std(0) + 1e-6

    def prepared(x):
        x = (x - mean) / scale
        x[:, :size] = np.clip(x[:, :size], -5, 5)
        return np.hstack([x, np.ones((len(x), 1), np.float32)])

    positive, unlabelled = prepared(positive), prepared(unlabelled)
    rng = np.random.default_rng(seed)
    w = np.zeros(dim + 1)
    step = Adam(dim + 1, RATE)
    for _ in range(STEPS):
        p = positive[rng.integers(0, len(positive), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        narrow = w.astype(np.float32)  # else both matrices are widened for every product
        gp, gu = (p @ narrow).astype(float), (u @ narrow).astype(float)
        negative_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        up = u.T @ (sigmoid(gu) / BATCH).astype(np.float32)
        down = p.T @ (prior * sigmoid(gp) / BATCH).astype(np.float32)
        if negative_risk >= 0:
            step.step(w, up - down - p.T @ (prior * sigmoid(-gp) / BATCH).astype(np.float32) + DECAY * w)
        else:
            step.step(w, down - up)
    return PUModel(mean, scale, w[:-1].astype(np.float32), float(w[-1]), prior)


def _vectors(df: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [vector(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.float32()))], names=["x"])

    table = df.select("text").mapInArrow(run, "x array<float>").toArrow()
    flat = table.column("x").combine_chunks().values.to_numpy()
    x = flat.reshape(table.num_rows, len(STATS) + (1 << GRAM_BITS))
    # in one order, however the table was split: minibatches are drawn by place
    return x[np.lexsort(x.T[: len(STATS) + 8])]


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
          positives=POSITIVES, unlabelled=UNLABELLED) -> PUModel:
    zeros, ones = label_counts(labels, id_col, label_col)
    prior = min(max(ones / (ones + zeros), 0.01), 0.99) if ones + zeros else 0.5
    trusted = sample_labels(labels, id_col, label_col, positives, salt=6).where("label = 1")
    web = bounded(docs.where(training_fold(id_col) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"))
                  .distinct(), unlabelled, 60, "id")
    return fit_nnpu(_vectors(with_texts(trusted, docs, id_col, text_col)),
                    _vectors(with_texts(web, docs, id_col, text_col)), prior)


def score(docs: DataFrame, model: PUModel, id_col="doc_id", text_col="text", threshold=THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2):
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(model.score(batch.column(2).to_pylist()))],
                                  names=["id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("id"), (fold_of(id_col, HELD_OUT_FOLDS) == 0).alias("held_out"),
                       text_of(text_col).alias("text"))
    out = rows.mapInArrow(tidy(run), f"id {id_type}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_rows(docs: DataFrame, model: PUModel, text_col="text", threshold=THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text_at):
            texts = batch.column(text_at).to_pylist()
            yield batch.filter(pa.array(model.score(texts) >= threshold, pa.bool_()))

    text_at = docs.columns.index(text_col)
    return docs.mapInArrow(tidy(run), docs.schema)
