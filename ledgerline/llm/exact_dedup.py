"""Exact dedup by content sort.

Rows are range-partitioned on the first bytes of the normalised text, its hash
and the retention order; Spark samples the splitters. Each partition is sorted
externally on (prefix, hash, whole normalised text, retention order), so equal
texts stand next to each other, the row to keep first, and one pass compares
every text in full with its neighbour. The retention order is part of the
range key, so a group of copies that holds a third of all rows is cut over as
many partitions as its share; runs that go on over a border are put together
again by their sha256, at most a few per partition.

Texts are equal when identical after deleting ASCII white space
(0x20, 0x09-0x0D). Of equal texts the row with the most code points in the
original text stays, then the smallest id, a null id last.

Defined results: null text counts as empty, and empty texts form one group;
wholly equal rows (same id too) keep exactly one; an empty table gives an
empty result; extra columns are carried by :func:`distinct_rows` alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.common import SPACE_CLASS, batches_of, partitions, stored, text_of, tidy

PREFIX_BYTES = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_CLASS + "+", "")


def _sorted(df: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Equal texts adjacent, the one to keep first. The shuffle carries the
    normalised text, or the whole row when rows are to be carried."""
    text = text_of(text_col)
    rows = df.select(F.col(id_col).alias("id"), (-F.char_length(text)).alias("neg_length"),
                     normalised(text).alias("norm"), *([F.struct("*").alias("row")] if carry else []))
    rows = rows.withColumns({"prefix": F.substring(F.encode("norm", "UTF-8"), 1, PREFIX_BYTES),
                             "hash": F.xxhash64("norm")})
    if carry:
        rows = rows.drop("norm")
    key = ["prefix", "hash", "neg_length", F.col("id").asc_nulls_last()]
    rows = rows.repartitionByRange(partitions(df.sparkSession), *key)
    if carry:
        rows = rows.withColumn("norm", normalised(F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))))
    rows = rows.sortWithinPartitions("prefix", "hash", "norm", "neg_length", F.col("id").asc_nulls_last())
    return rows.drop("prefix", "neg_length")


def _starts(norm: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """True where a text differs from its neighbour above, compared in full."""
    n = len(norm)
    out = np.ones(n, bool)
    if n > 1:
        out[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    if before is not None and n:
        out[0] = norm[0].as_py() != before.as_py()
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: its run's head, size within the partition, and whether it is the
    head. ``edge`` marks runs that may go on from the partition before: those
    with the hash of the partition's first text. Of an open run only ids wait."""
    pid = TaskContext.get().partitionId()
    before = first_hash = None
    ids, sha, edge, number = [], "", False, 0

    def flush(ids, sha, edge, number):
        parts = pa.chunked_array(ids).combine_chunks()
        n = len(parts)
        head = np.zeros(n, bool)
        head[0] = True
        return pa.record_batch([
            parts, pa.array([sha] * n), pa.repeat(parts[0], n), pa.array(np.full(n, n, np.int64)),
            pa.array(head), pa.array(np.full(n, edge)), pa.array(np.full(n, pid, np.int32)),
            pa.array(np.full(n, number, np.int64))],
            names=["id", "sha", "head_id", "run", "head", "edge", "pid", "number"])

    for batch in batches:
        if not batch.num_rows:
            continue
        col = {n: batch.column(n) for n in ("id", "hash", "norm", "sha")}
        if first_hash is None:
            first_hash = col["hash"][0].as_py()
        starts = np.flatnonzero(_starts(col["norm"], before))
        before = col["norm"][batch.num_rows - 1]
        cuts = [*starts.tolist(), batch.num_rows]
        if cuts[0] and ids:
            ids.append(col["id"].slice(0, cuts[0]))
        out = []
        hashes = np.asarray(col["hash"])
        for a, b in zip(cuts, cuts[1:], strict=False):
            if ids:
                out.append(flush(ids, sha, edge, number))
            ids, sha = [col["id"].slice(a, b - a)], col["sha"][a].as_py()
            edge, number = bool(hashes[a] == first_hash), number + 1
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield flush(ids, sha, edge, number)


def exact_dedup(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per input row: id, keep_id (id of the row that stays),
    group_size, kept, text_sha256 (of the normalised text)."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = _sorted(df, id_col, text_col, carry=False).withColumn("sha", F.sha2("norm", 256))
    schema = (f"id {id_type}, sha string, head_id {id_type}, run long, head boolean, "
              "edge boolean, pid int, number long")
    rows = stored(rows.mapInArrow(_runs, schema), "content-runs")
    runs = rows.where("head")
    # Runs over a border: at most those with the first hash of a partition.
    later = runs.where("edge").groupBy("sha").agg(F.max("pid").alias("last_pid"))
    across = (runs.join(F.broadcast(later), "sha").groupBy("sha")
              .agg(F.min(F.struct("pid", "number", "head_id")).alias("top"), F.sum("run").alias("size"),
                   F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("sha", F.col("top.pid").alias("top_pid"), F.col("top.number").alias("top_number"),
                      F.col("top.head_id").alias("top_id"), "size"))
    out = rows.join(F.broadcast(across), "sha", "left")
    alone = F.col("size").isNull()
    return out.select(
        "id", F.when(alone, F.col("head_id")).otherwise(F.col("top_id")).alias("keep_id"),
        F.coalesce("size", "run").alias("group_size"),
        (F.col("head") & (alone | ((F.col("pid") == F.col("top_pid"))
                                   & (F.col("number") == F.col("top_number"))))).alias("kept"),
        F.col("sha").alias("text_sha256"))


_DELETED = bytes([0x20, *range(0x09, 0x0E)])


def _heads(text_col: str):
    """The first row of every run, with the same edge mark. The texts are
    normalised again here, so that a row crosses to Python once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, before, first_hash = TaskContext.get().partitionId(), None, None
        for batch in (part for whole in batches for part in batches_of(whole, 500)):
            hashes = np.asarray(batch.column("hash"))
            if first_hash is None:
                first_hash = hashes[0]
            starts = []
            for i, text in enumerate(batch.column("row").field(text_col)):
                norm = ("" if (t := text.as_py()) is None else str(t)).encode("utf-8", "surrogatepass").translate(None, _DELETED)
                if norm != before:
                    starts.append(i)
                before = norm
            if starts:
                kept = batch.select(["row", "sha"]).take(pa.array(starts))
                yield pa.record_batch([*kept.columns, pa.array(hashes[starts] == first_hash),
                                       pa.array(np.full(len(starts), pid, np.int32))],
                                      names=["row", "sha", "edge", "pid"])

    return run


def distinct_rows(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows that stay, whole, with the columns of ``df``."""
    rows = _sorted(df, id_col, text_col, carry=True).select("row", "hash", F.sha2("norm", 256).alias("sha"))
    schema = StructType([rows.schema["row"], *StructType.fromDDL("sha string, edge boolean, pid int").fields])
    heads = stored(rows.mapInArrow(tidy(_heads(text_col)), schema), "content-heads")
    marks = heads.select("sha", "edge", "pid")
    edges = marks.where("edge").select("sha", F.col("pid").alias("edge_pid"))
    # A run goes on here when an earlier partition has a head of the same text.
    goes_on = (marks.join(F.broadcast(edges), "sha").where("pid < edge_pid")
               .select("sha", F.col("edge_pid").alias("pid")).distinct())
    return heads.join(F.broadcast(goes_on), ["sha", "pid"], "left_anti").select("row.*")
