"""Fuzzy line dedup over the lines of all documents.

A line is normalised (A-Z in lower case, white space squeezed); equal lines
are combined first, whatever their number. A line's distinct words are dealt
by hash into five classes, and the SimHash of each class (25 bits) is a block
of the line's fingerprint: a word that is added or lost changes one block, a
word that is altered two at most. By pigeonhole, changes that leave two blocks
alone leave a pair of blocks equal, so each pair is a join key (ten keys a line,
50 bits each); blocks without words make no key. A line of few distinct words
has too little in a block: its words are the blocks, and a key is all words but
one with the beginning or the end of that one, of which a letter altered, added
or lost leaves one alone. Lines of ``LEAST`` to ``FEW`` words have both kinds.

Lines that meet another one at a key go on with their text: at each key, pairs
whose fingerprints are within ``BITS`` are verified by edit similarity
(1 - Levenshtein / longer length, 0.8 or more) unless a verified chain at that
key connects them already, and each pair of long lines at its first common key
only. Verified links form groups by connected components; of each group the
first occurrence (document id, then line number) stays.

Lines without words are never removed. Rows equal in id and text share their
decisions: each keeps its copy.

Defined results: null text is empty and has one blank line; a null id sorts
last; lines of any length are compared whole; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_bytes, forest, partitions, stored, text_of
from ledgerline.llm.components import components

BITS = 30           # of 125, between lines whose edit distance is worth computing
SIMILARITY = 0.8
BLOCKS, WIDTH = 5, 25
LEAST, FEW = 9, 12  # distinct words of a line with a fingerprint, and of a short line
_KEYS = list(combinations(range(BLOCKS), 2))
_BLOCK = np.uint64((1 << WIDTH) - 1)
BROADCAST_NODES = 4_000_000  # 32 MB; more go through a join
_WORDS = 50_000  # words hashed at once: memory, not a limit


def _mixed(hashes) -> np.ndarray:
    """64-bit hashes from 32-bit ones."""
    z = np.array(hashes, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(32))


def simhashes(hashes: list[int], lengths: list[int]) -> np.ndarray:
    """Fingerprints (rows of two longs) of lines given the 32-bit hashes of
    their distinct words, line after line."""
    if not lengths:
        return np.empty((0, 2), np.int64)
    z = _mixed(hashes)
    cell = np.repeat(np.arange(len(lengths)) * BLOCKS, lengths) + ((z >> np.uint64(32)) % np.uint64(BLOCKS)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cells, starts, sizes = np.unique(cell[order], return_index=True, return_counts=True)
    bits = np.unpackbits((z & _BLOCK).astype("<u4")[order].view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    block = np.zeros(len(lengths) * BLOCKS, np.uint64)
    block[cells] = np.packbits(ones * 2 > sizes[:, None], axis=1, bitorder="little").view("<u4").ravel()
    b = block.reshape(-1, BLOCKS)
    w = np.uint64(WIDTH)
    low = b[:, 0] | b[:, 1] << w | (b[:, 4] & np.uint64(0x1FFF)) << (w + w)
    high = b[:, 2] | b[:, 3] << w | b[:, 4] >> np.uint64(13) << (w + w)
    return np.stack([low, high], axis=1).view(np.int64)


def blocks_of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The five blocks of fingerprints: one column each."""
    low, high, w = low.view(np.uint64), high.view(np.uint64), np.uint64(WIDTH)
    return np.stack([low & _BLOCK, low >> w & _BLOCK, high & _BLOCK, high >> w & _BLOCK,
                     low >> (w + w) | high >> (w + w) << np.uint64(13)], axis=1)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line with words: id, text_hash, line number, node (hash of
    the normalised line), the fingerprint (low, high; null below ``LEAST``
    words), whether it is short, and the normalised line."""
    for batch in by_bytes(batches, 2):
        row, number, node, norm, words, lengths, pending, size = [], [], [], [], [], [], [], []

        def flush():
            pending.append(simhashes(words, lengths))
            words.clear()
            lengths.clear()

        for r, text in enumerate(batch.column(2)):
            for i, line in enumerate(text.as_py().encode("utf-8", "surrogatepass").split(b"\n")):
                w = line.lower().split()
                if w:
                    joined = b" ".join(w)
                    row.append(r)
                    number.append(i)
                    node.append(xxhash.xxh64_intdigest(joined, 7))
                    norm.append(joined)
                    w = set(w)
                    size.append(len(w))
                    if len(w) >= LEAST:
                        words.extend(map(crc32, w))
                        lengths.append(len(w))
            if len(words) > _WORDS:
                flush()
        flush()
        at, size = pa.array(row, pa.int64()), np.array(size, np.int64)
        none = size < LEAST
        fp = np.zeros((len(row), 2), np.int64)
        fp[~none] = np.concatenate(pending)
        yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()),
                               pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(fp[:, 0].copy(), mask=none),
                               pa.array(fp[:, 1].copy(), mask=none), pa.array(size <= FEW), pa.array(norm, pa.binary()).cast(pa.string())],
                              names=["id", "text_hash", "line", "node", "low", "high", "few", "norm"])


def keys_of(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The join keys of fingerprints, one column per pair of blocks, with the
    pair's number in the top bits; and which of them there are."""
    b = blocks_of(low, high)
    keys = np.stack([(np.uint64(k << 2 * WIDTH) | b[:, i] << np.uint64(WIDTH) | b[:, j]).view(np.int64)
                     for k, (i, j) in enumerate(_KEYS)], axis=1)
    return keys, np.stack([(b[:, i] > 0) & (b[:, j] > 0) for i, j in _KEYS], axis=1)


def short_keys(norm: str) -> list[int]:
    """The join keys of a short line, in their own range."""
    words = sorted(set(norm.encode("utf-8", "surrogatepass").split(b" ")))
    out = set()
    for i, word in enumerate(words):
        rest = b" ".join(words[:i] + words[i + 1:])
        # two lengths, so that words whose lengths differ by one have one in common
        for n in {len(word) // 2, (len(word) - 1) // 2}:
            for side, part in enumerate((word[:n], word[len(word) - n:])):
                digest = xxhash.xxh64_intdigest(b"%d %s\0%s" % (side, part, rest), 11)
                out.add((0x3F << 57 | digest >> 7) & 0x7FFFFFFFFFFFFFFF)
    return sorted(out)


def _to_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ...) of each row with columns low, high, few and, for short lines, norm."""
    for batch in batches:
        for start in range(0, batch.num_rows, 8192):
            some = batch.slice(start, 8192)
            few = np.asarray(some.column("few"))
            rows = np.flatnonzero(~np.asarray(some.column("low").is_null()))
            fp = [some.column(c).fill_null(0).to_numpy()[rows] for c in ("low", "high")]
            keys, there = keys_of(*fp)
            norms = some.column("norm")
            found = [(i, k) for i in np.flatnonzero(few).tolist() for k in short_keys(norms[i].as_py())]
            at = np.concatenate([np.repeat(rows, there.sum(1)), np.array([i for i, _ in found], np.int64)])
            key = np.concatenate([keys[there], np.array([k for _, k in found], np.int64)])
            yield pa.record_batch([pa.array(key), *[some.column(c).take(pa.array(at)) for c in _carried(some.schema.names)]],
                                  names=["key", *_carried(some.schema.names)])


def _carried(names: list[str]) -> list[str]:
    """Columns that go on with the keys: all, or the node alone where lines
    only look for company."""
    return ["node"] if "alone" in names else names


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, node) sorted by both: nodes that share a key with another."""
    left = [np.empty(0, np.int64)] * 2

    def found(key, node):
        new = np.ones(len(key), bool)       # the first row of a node at a key
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        same = key[1:] == key[:-1]
        hit = np.zeros(len(key), bool)
        hit[1:] |= same
        hit[:-1] |= same
        return np.unique(node[hit])

    for batch in batches:
        now = [np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate(left)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        yield pa.record_batch([pa.array(found(*(c[:cut] for c in now)))], names=["node"])
        left = [c[cut:] for c in now]
        if len(left[0]) > 1 and left[1][0] != left[1][-1]:
            # A key of many lines: all of them have company but for later batches to see.
            yield pa.record_batch([pa.array(np.unique(left[1]))], names=["node"])
            left = [c[-1:] for c in left]
    yield pa.record_batch([pa.array(found(*left))], names=["node"])


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel (Myers 1999) on whole-number words."""
    while a and b and a[0] == b[0]:
        k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        a, b = a[k:], b[k:]
    if a and b and a[-1] == b[-1]:
        k = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
        a, b = a[: len(a) - k], b[: len(b) - k]
    if not a or not b:
        return len(a) + len(b)
    if len(a) > len(b):
        a, b = b, a
    m, peq = len(a), {}
    for i, ch in enumerate(a):
        peq[ch] = peq.get(ch, 0) | 1 << i
    mask, top, pv, mv, score = (1 << m) - 1, 1 << m - 1, (1 << m) - 1, 0, m
    for ch in b:
        eq = peq.get(ch, 0)
        xv, xh = eq | mv, (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & mask, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1 | 1) & mask, mh << 1 & mask
        pv, mv = mh | ~(xv | ph) & mask, ph & xv
    return score


def similar(a: str, b: str) -> bool:
    longer = max(len(a), len(b))
    if abs(len(a) - len(b)) > (1 - SIMILARITY) * longer:
        return False
    return longer - edit_distance(a, b) >= SIMILARITY * longer


def first_key(low: int, high: int, other_low: int, other_high: int) -> int:
    """The first key at which two fingerprints meet, -1 beyond ``BITS``."""
    x, y, block = low ^ other_low, high ^ other_high, (1 << WIDTH) - 1
    if x.bit_count() + y.bit_count() > BITS:
        return -1
    top = 2 * WIDTH
    equal = (not x & block and low & block, not x >> WIDTH & block and low >> WIDTH & block,
             not y & block and high & block, not y >> WIDTH & block and high >> WIDTH & block,
             not x >> top and not y >> top and (low >> top or high >> top))
    return next((k for k, (i, j) in enumerate(_KEYS) if equal[i] and equal[j]), -1)


def verified(nodes: list[int], fps: np.ndarray, texts: list[str], number: int) -> list[tuple[int, int]]:
    """Links that connect the verified pairs of one key's lines; ``fps``: rows
    of two longs, ``number``: that of the key's pair of blocks, -1 for short
    lines. Of a cluster, members are tried until one verifies."""
    links, clusters = [], []
    pairs = fps.tolist()
    for i in range(len(nodes)):
        joined = []
        for cluster in clusters:
            members = cluster
            if number >= 0 and len(cluster) > 32:
                members = np.array(cluster)
                members = members[_apart(fps[members], fps[i]).sum(1) <= BITS].tolist()
            for j in members:
                if (number < 0 or first_key(*pairs[i], *pairs[j]) == number) and similar(texts[i], texts[j]):
                    links.append((nodes[i], nodes[j]))
                    joined.append(cluster)
                    break
        merged = [i]
        for cluster in joined:
            merged = cluster + merged
        clusters = [c for c in clusters if not any(c is j for j in joined)] + [merged]
    return links


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, node, low, high, few, norm) sorted by key and node: verified links."""
    a = b = np.empty(0, np.int64)
    key, rows = None, {}

    def done():
        if len(rows) < 2:
            return a, b
        fps = np.array([r[:2] for r in rows.values()], np.int64)
        links = verified(list(rows), fps, [r[2] for r in rows.values()], key >> 2 * WIDTH if key >> 57 == 0 else -1)
        if not links:
            return a, b
        new = np.array(links, np.int64)
        return forest(np.concatenate([a, new[:, 0]]), np.concatenate([b, new[:, 1]]))

    for batch in batches:
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        # Lines alone at their key go at once; the last may go on in the next batch.
        same = np.concatenate([[keys[0] == key], keys[1:] == keys[:-1], [True]])
        some = batch.filter(pa.array(same[1:] | same[:-1]))
        for k, node, low, high, norm in zip(*(some.column(i).to_pylist() for i in (0, 1, 2, 3, 5)), strict=True):
            if k != key:
                a, b = done()
                key, rows = k, {}
            rows[node] = (low or 0, high or 0, norm)
    a, b = done()
    yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def _by_key(rows: DataFrame, schema: str) -> DataFrame:
    keyed = rows.mapInArrow(_to_keys, f"key long, {schema}")
    return keyed.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", "node")


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "line")


def dropped_lines(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, text_hash, lines): numbers of the lines that go, per document that
    loses any."""
    spark, id_type = df.sparkSession, df.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    lines = stored(df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        _lines, f"id {id_type}, text_hash long, line int, node long, low long, high long, few boolean, norm string"), "lines")
    distinct = stored(lines.groupBy("node").agg(
        F.min(_place()).alias("first"), F.max(_place()).alias("last"), F.first("low").alias("low"),
        F.first("high").alias("high"), F.first("few").alias("few"), F.min(F.when(F.col("few"), F.col("norm"))).alias("norm")),
        "lines-distinct")
    near = _by_key(distinct.select("node", "low", "high", "few", "norm", F.lit(True).alias("alone")), "node long").mapInArrow(
        _near, "node long")
    near = stored(near.distinct(), "lines-near")
    texts = lines.select("node", "low", "high", "few", "norm")
    if near.count() <= BROADCAST_NODES:
        wanted = spark.sparkContext.broadcast(np.sort(near.toArrow().column("node").to_numpy()))

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node = batch.column(0).to_numpy()
                yield batch.filter(pa.array(np.isin(node, wanted.value)))

        texts = texts.mapInArrow(some, texts.schema)
    else:
        texts = texts.join(near, "node", "left_semi")
    texts = texts.groupBy("node").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.first("few").alias("few"),
                                       F.min("norm").alias("norm"))
    links = _by_key(texts, "node long, low long, high long, few boolean, norm string").mapInArrow(_verify, "a long, b long")
    roots = components(links)
    linked = roots.join(distinct, "node")
    tops = linked.groupBy("root").agg(F.min("first").alias("top"))
    linked = linked.select("node", "root").join(tops, "root").select("node", "top")
    groups = (distinct.join(linked, "node", "left").where("top is not null or first != last")
              .select("node", F.coalesce("top", "first").alias("top")))
    # Written, so that the join with the lines has two plain shuffles, of which
    # adaptive execution can split a very common line's.
    groups = stored(groups, "lines-groups")
    gone = lines.select("id", "text_hash", "line", "node").join(groups, "node").where(_place() != F.col("top"))
    return gone.groupBy("id", "text_hash").agg(F.collect_set("line").alias("lines"))


def dedup_lines(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, text without the lines
    that go."""
    gone = dropped_lines(df, id_col, text_col)
    text = text_of(text_col)
    docs = df.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("hash"))
    out = docs.join(gone, docs["doc"].eqNullSafe(gone["id"]) & (docs["hash"] == gone["text_hash"]), "left")
    parts = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("lines", i)), "\n")
    return out.select(F.col("doc").alias("id"), F.size(parts).cast("long").alias("n_lines"),
                      F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_dropped"),
                      F.when(F.col("lines").isNull(), F.col("text")).otherwise(kept).alias("text"))
