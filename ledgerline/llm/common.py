"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import fresh_path

# The ASCII white space of the contracts, as a Java and RE2 character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_CLASS)).cast("long")


def fold_of(name: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    key = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(folds))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the cluster's shared folder and reads it back: the
    lineage ends there, so a lost executor costs no recomputation before it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Lets the cluster delete the shuffle files of jobs that are done: it does
    so only when the driver collects its garbage."""
    jvm = getattr(spark, "_jvm", None)
    for _ in range(2 if jvm is not None else 0):     # none on Spark Connect
        gc.collect()
        jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lowered_words(text: str | bytes | None) -> list[bytes]:
    """UTF-8 words with A-Z in lower case, of a text or its UTF-8 bytes. ``bytes.lower`` and ``bytes.split``
    touch ASCII alone: the letters A-Z and the six characters 0x20, 0x09-0x0D."""
    if isinstance(text, str):
        text = text.encode("utf-8", "surrogatepass")
    return (text or b"").lower().split()


def batches_of(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of one text column, one
    row at least: what a task makes of a batch is bounded by that, not by rows."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def release() -> None:
    """Gives freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:      # another C library
        pass


def tidy(run: Callable) -> Callable:
    """The task function, giving freed memory back at the task's end: the
    worker lives on for tasks of other stages."""
    def whole(batches):
        yield from run(batches)
        release()
    return whole


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the same connected components as the links a-b:
    pairs (node, root) for every node that is not its component's root, which
    is the smallest node. Hooking on the smaller label with pointer jumping,
    vectorised over one task's links."""
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        lu, lv = label[u], label[v]
        open_ = lu != lv
        if not open_.any():
            break
        u, v, lu, lv = u[open_], v[open_], lu[open_], lv[open_]
        low = np.minimum(lu, lv)
        np.minimum.at(label, lu, low)
        np.minimum.at(label, lv, low)
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label = nxt
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
