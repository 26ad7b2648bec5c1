"""Bounded samples of labelled rows, for the classifiers of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fold_of

HELD_OUT_FOLDS = 5


def training_fold(id_col: str) -> Column:
    return fold_of(id_col, HELD_OUT_FOLDS) != 0


def bounded(df: DataFrame, rows: int, salt: int, *key: str) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes: the same rows in
    every run. Only the key columns should be in ``df``: the top-k keeps
    ``rows`` of them per task."""
    return df.orderBy(F.xxhash64(*key, F.lit(salt)), *key).limit(rows)


def label_counts(labels: DataFrame, id_col: str, label_col: str) -> tuple[int, int]:
    """Rows of the training folds labelled 0 and 1."""
    taught = labels.where(F.col(id_col).isNotNull() & training_fold(id_col))
    return tuple(taught.agg(*[F.count(F.when(F.col(label_col) == c, 1)) for c in (0, 1)]).first())


def sample_labels(labels: DataFrame, id_col: str, label_col: str, per_class: int, salt: int) -> DataFrame:
    """(id, label): up to ``per_class`` ids of each of the labels 0 and 1, from
    the training fold. Rows without id or label teach nothing; an id labelled
    both ways counts by its mean, rounded up."""
    rows = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & training_fold(id_col))
            .groupBy(F.col(id_col).alias("id")).agg(F.ceil(F.avg(label_col)).cast("int").alias("label")))
    return bounded(rows.where("label = 0"), per_class, salt, "id").unionByName(
        bounded(rows.where("label = 1"), per_class, salt, "id"))


def with_texts(sample: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, label, text) of a bounded sample: its ids are broadcast (their
    number is the sample's bound), so no text is shuffled."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "id")
