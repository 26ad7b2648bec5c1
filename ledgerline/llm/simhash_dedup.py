"""SimHash near-dedup by anchor-point covering.

A fingerprint has 64 bits. By pigeonhole, two fingerprints at most ``max_bits``
apart differ by at most one bit in one of ``max_bits // 2 + 1`` equal blocks.
Per block the anchors are the words of a perfect Hamming code (length
2^r - 1, covering radius 1): every block value lies within one bit of an
anchor, so two values one bit apart lie both within radius + 1 = 2 bits of the
anchor next to either. Each distinct fingerprint is replicated to all anchors
within two bits (2^(r-1) of them) and compared, over all 64 bits, with the
others at the anchor. Nothing is probabilistic: no link is missed.

Copies share a fingerprint and are collapsed first, so a group of copies with
a third of all rows is one row here. Within an anchor the comparison is by
pairs for few fingerprints; for more than the number of bit patterns within
``max_bits`` it looks up those patterns, so its work is linear in the anchor's
fingerprints. Only a spanning forest of the links leaves a task.

Defined results: null and empty texts have fingerprint zero, linked like any
other; a text shorter than a shingle is one shingle; repeated rows share a
component; a null id takes part but is never the smallest id unless all ids of
the component are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_bytes, forest, lowered_words, partitions, stored, text_of, tidy
from ledgerline.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
_CHUNK = 1 << 16  # shingles hashed at once: memory, not a limit


def simhash(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if set in over half the XXH64 (seed 42) of the shingles."""
    words = lowered_words(text)
    if not words:
        return 0
    norm = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(norm, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[: len(words) - shingle + 1], ends[shingle - 1:]
    n, ones = len(first), np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        a, b = first[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist()
        h = np.array([digest(norm[i:j], 42) for i, j in zip(a, b, strict=True)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE_WORDS) -> DataFrame:
    """(id, fp) with the fingerprint's 64 bits as a long, and the text's hash
    (``text_hash``) that tells rows with one id apart."""
    id_type = df.schema[id_col].dataType.simpleString()
    text = text_of(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2):
            fp = np.array([simhash(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))],
                                  names=["id", "text_hash", "fp"])

    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        tidy(run), f"id {id_type}, text_hash long, fp long")


def anchors_of(values: np.ndarray, r: int) -> np.ndarray:
    """For block values of 2^r - 1 bits, the Hamming code words within two
    bits: one column per word; a value that is a word repeats itself."""
    n = (1 << r) - 1
    syndrome = np.zeros(len(values), np.uint64)
    for i in range(n):
        syndrome ^= ((values >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    one = lambda pos: np.where(pos > 0, np.uint64(1) << (np.maximum(pos, np.uint64(1)) - np.uint64(1)), np.uint64(0))
    out = [values ^ one(syndrome)]
    # Distance two: positions i and j with i xor j = syndrome, each pair once.
    top = np.zeros(len(values), np.uint64)
    for k in range(r):
        top = np.where(syndrome >> np.uint64(k) & np.uint64(1), np.uint64(1 << k), top)
    for i in range(1, n + 1):
        j = syndrome ^ np.uint64(i)
        # The lower of the pair lacks the syndrome's highest bit.
        use = (syndrome > 0) & (j > 0) & ((np.uint64(i) & top) == 0)
        out.append(np.where(use, values ^ one(np.full(len(values), i, np.uint64)) ^ one(j), out[0]))
    return np.stack(out, axis=1)


def _layout(max_bits: int) -> tuple[int, int, int]:
    """Number of blocks, bits of a block, and r of its Hamming code."""
    blocks = max_bits // 2 + 1
    width = 64 // blocks
    return blocks, width, (width + 1).bit_length() - 1


def _to_anchors(max_bits: int):
    blocks, width, r = _layout(max_bits)
    mask = np.uint64((1 << ((1 << r) - 1)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy()
            for start in range(0, len(whole), 4096):
                fp = whole[start:start + 4096]
                for block in range(blocks):
                    value = (fp.view(np.uint64) >> np.uint64(block * width)) & mask
                    words = np.sort(anchors_of(value, r), axis=1)
                    fresh = np.ones(words.shape, bool)
                    fresh[:, 1:] = words[:, 1:] != words[:, :-1]
                    row, _ = np.nonzero(fresh)
                    yield pa.record_batch([pa.array(np.full(len(row), block, np.int8)),
                                           pa.array(words[fresh].view(np.int64)), pa.array(fp[row])],
                                          names=["block", "anchor", "fp"])

    return run


def links_within(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links at one anchor (distinct fingerprints)."""
    n = len(fp)
    patterns = sum(1 for k in range(1, max_bits + 1) for _ in combinations(range(64), k)) if n > 64 else n
    u = fp.view(np.uint64)
    if n <= max(patterns, 64):
        step = max(1, (1 << 20) // n)
        a = b = np.empty(0, np.int64)
        for at in range(0, n, step):
            near = np.bitwise_count(u[at:at + step, None] ^ u[None, :]) <= max_bits
            i, j = np.nonzero(near)
            keep = i + at < j
            a, b = forest(np.concatenate([a, fp[i[keep] + at]]), np.concatenate([b, fp[j[keep]]]))
        return a, b
    ordered = np.sort(u)
    a = b = np.empty(0, np.int64)
    for k in range(1, max_bits + 1):
        for bits in combinations(range(64), k):
            other = ordered ^ np.uint64(sum(1 << x for x in bits))
            at = np.minimum(np.searchsorted(ordered, other), n - 1)
            hit = (ordered[at] == other) & (other > ordered)
            if hit.any():
                a, b = np.concatenate([a, ordered[hit].view(np.int64)]), np.concatenate([b, other[hit].view(np.int64)])
            if len(a) > 1 << 20:
                a, b = forest(a, b)
    return forest(a, b)


def _compare(max_bits: int):
    """Partitions sorted by (block, anchor): compares within each anchor and
    emits a spanning forest of all links found in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.empty(0, np.int8), np.empty(0, np.int64), np.empty(0, np.int64))
        a = b = np.empty(0, np.int64)

        def found(block, anchor, fp):
            same = (block[1:] == block[:-1]) & (anchor[1:] == anchor[:-1])
            starts = np.flatnonzero(np.concatenate([[True], ~same])) if len(fp) else np.empty(0, np.int64)
            sizes = np.diff(np.append(starts, len(fp)))
            xs, ys = [], []
            for size in np.unique(sizes[sizes > 1]).tolist():
                at = starts[sizes == size]
                if size <= 32:  # all anchors of this size at once
                    rows = fp[at[:, None] + np.arange(size)]
                    for i, j in combinations(range(size), 2):
                        near = np.bitwise_count((rows[:, i] ^ rows[:, j]).view(np.uint64)) <= max_bits
                        xs.append(rows[near, i])
                        ys.append(rows[near, j])
                else:
                    for s in at.tolist():
                        x, y = links_within(fp[s:s + size], max_bits)
                        xs.append(x)
                        ys.append(y)
            return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.empty(0, np.int64),) * 2

        for batch in batches:
            now = [np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)]
            if not len(now[0]):
                continue
            open_ = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = len(open_) - int(open_.sum())
            x, y = found(*(c[:cut] for c in now))
            rest = tuple(c[cut:] for c in now)
            a, b = forest(np.concatenate([a, x]), np.concatenate([b, y]))
        x, y = found(*rest)
        a, b = forest(np.concatenate([a, x]), np.concatenate([b, y]))
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, max_bits=MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) at most
    ``max_bits`` apart: a spanning forest per task."""
    n = partitions(distinct.sparkSession)
    at = distinct.select("fp").mapInArrow(tidy(_to_anchors(max_bits)), "block byte, anchor long, fp long")
    at = at.repartition(n, "block", "anchor").sortWithinPartitions("block", "anchor")
    return at.mapInArrow(tidy(_compare(max_bits)), "a long, b long")


def near_duplicates(df: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE_WORDS,
                    max_bits=MAX_BITS) -> DataFrame:
    """One row per input row: id, text_hash, fp (64 bits as a long), component_id
    (smallest id reachable) and keeper (true for one row of each component)."""
    docs = stored(fingerprints(df, id_col, text_col, shingle), "simhash")
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash"))
    distinct = stored(docs.groupBy("fp").agg(least.alias("least")), "simhash-distinct")
    roots = components(fingerprint_links(distinct, max_bits))
    joined = distinct.join(roots, distinct["fp"] == roots["node"])
    # The hot component's fingerprints are combined map-side before the shuffle.
    tops = joined.groupBy("root").agg(F.min("least").alias("top"))
    linked = joined.select("fp", "root").join(tops, "root").select("fp", "top")
    # Written, so that the join with the documents has two plain shuffles, of
    # which adaptive execution can split the hot fingerprint's.
    tops = stored(distinct.join(linked, "fp", "left").select("fp", F.coalesce("top", "least").alias("top")),
                  "simhash-tops")
    out = docs.join(tops, "fp")
    return out.select("id", "text_hash", "fp", F.col("top.id").alias("component_id"),
                      (F.col("id").eqNullSafe(F.col("top.id"))
                       & (F.col("text_hash") == F.col("top.text_hash"))).alias("keeper"))


def representatives(df: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE_WORDS,
                    max_bits=MAX_BITS) -> DataFrame:
    """The rows of ``df`` that represent their component, with all its columns.
    Rows equal in id and text stay together."""
    gone = (near_duplicates(df, id_col, text_col, shingle, max_bits).where("not keeper")
            .select(F.col("id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct())
    same = df[id_col].eqNullSafe(gone["gone_id"]) & (F.xxhash64(F.coalesce(df[text_col].cast("string"), F.lit("")))
                                                     == gone["gone_hash"])
    return df.join(gone, same, "left_anti")
