"""Periodic runs of words, found online with dyadic square catchers.

A square of period p is a stretch of 2p words whose halves are equal: p words
in a row equal the words p further on. Any p in a row hold a whole aligned
block of L = 2^k words once p >= 2L - 1, so the blocks of size L answer for
the periods 2L - 1 .. 4L - 2 and all sizes together for every period. When a
block is complete it gets a catcher, alive while a suffix of the text can lie
at one of its distances; each appended word ends one suffix of every size,
which is compared with the two blocks of that size in reach (by polynomial
fingerprints of both). Equal neighbouring blocks at one distance join to
intervals; an interval that can reach the wanted length is compared word by
word to both sides and gives a square, which merges into the run of its
period: the maximal stretch. Runs that reach the end of the text grow with the
next words. What lies within a run at a multiple of its period is known and
left out at once, so a text of one word costs no more than another.

Fingerprints only choose what is compared: every reported run rests on the
words themselves. The work per word is a few vector operations per block size,
the memory a few numbers per word of the one text at hand.

Defined results: null and empty texts have no words and no runs; texts of any
length are read whole; rows are scored one by one, so repeated rows repeat and
ids may be null; an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_of

MIN_LENGTH = 24
MIN_EXPONENT = 3
CHUNK_WORDS = 1 << 16   # words appended at a time: temporary memory, not a limit
OUT_BYTES = 4 << 20     # collapsed text of one batch handed back
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the fingerprint's base and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_UNBASE, m, 1 << 64))])


_POWERS = _Powers()


class RunCatcher:
    """Runs of a growing sequence of whole numbers: smallest period q, at least
    ``min_length`` and ``min_exponent`` times q long, extended as far as they go."""

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
        if min_exponent < 2 or min_length < 2:
            raise ValueError("a run has a square: exponent and length are at least 2")
        self.min_length, self.min_exponent = min_length, min_exponent
        self.n = 0
        self.x = np.empty(0, np.int64)
        self.prints = np.zeros(1, np.uint64)                # prefix sums of word * base^position
        self.at = np.empty(0, np.int32)                     # a run holding the position, -1 for none
        self.start, self.end, self.period = [], [], []      # the runs
        self.by_start: dict[int, list[int]] = {}
        self.open: list[int] = []                           # runs that reach the end of the text
        self.waiting: dict[int, list[tuple[int, int, int]]] = {}    # by size: (period, start, end) of undecided intervals

    def _need(self, p):
        """Words in a row that must equal those p further on."""
        return np.maximum(self.min_length, self.min_exponent * p) - p

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.x):
            grown = max(self.n, 2 * len(self.x))
            for name, fill in (("x", 0), ("at", -1)):
                a = getattr(self, name)
                setattr(self, name, np.concatenate([a, np.full(grown - len(a), fill, a.dtype)]))
            self.prints = np.concatenate([self.prints, np.zeros(grown + 1 - len(self.prints), np.uint64)])
        _POWERS.reach(self.n + 1)
        self.x[old: self.n] = words
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        self.prints[old + 1: self.n + 1] = self.prints[old] + np.cumsum(mixed * _POWERS.up[old: self.n], dtype=np.uint64)
        self._grow_open(old)
        size = 1
        while 3 * size - 1 <= self.n:       # the nearest suffix of this size has a block in reach
            self._catch(size, old)
            size *= 2

    def _grow_open(self, old: int) -> None:
        still = []
        for r in self.open:
            q = self.period[r]
            more = self._forward(old - q, q)
            self.at[old: old + more] = r
            self.end[r] = old + more
            if old + more == self.n:
                still.append(r)
        self.open = still

    def _forward(self, i: int, p: int) -> int:
        """How many words from i on equal those p further on."""
        done, step = 0, 64
        while i + done + p < self.n:
            to = min(i + done + step, self.n - p)
            differ = self.x[i + done: to] != self.x[i + done + p: to + p]
            if differ.any():
                return done + int(differ.argmax())
            done, step = to - i, step * 4
        return done

    def _backward(self, i: int, p: int) -> int:
        """How many words before i equal those p further on."""
        done, step = 0, 64
        while done < i:
            frm = max(i - done - step, 0)
            differ = (self.x[frm: i - done] != self.x[frm + p: i - done + p])[::-1]
            if differ.any():
                return done + int(differ.argmax())
            done, step = i - frm, step * 4
        return done

    def _catch(self, size: int, old: int) -> None:
        """Compares the suffixes of one size that the new words end with the
        blocks in reach, and takes up what is equal."""
        lo, hi = max(old - size + 1, 2 * size - 1), self.n - size + 1
        found = []
        if lo < hi:
            t = np.arange(lo, hi)
            prints = (self.prints[lo + size: hi + size] - self.prints[lo: hi]) * _POWERS.down[lo: hi]
            near = (t - (2 * size - 1)) // size         # number of the nearer block; the other is before it
            first = max(int(near[0]) - 1, 0)
            edges = np.arange(first, int(near[-1]) + 2) * size
            blocks = (self.prints[edges[1:]] - self.prints[edges[:-1]]) * _POWERS.down[edges[:-1]]
            for back in (0, 1):
                equal = blocks[np.maximum(near - back - first, 0)] == prints
                if back:
                    equal &= near > 0
                where = np.flatnonzero(equal)
                if len(where):
                    s = (near[where] - back) * size
                    found.append((t[where] - s, s))
        waiting = self.waiting.pop(size, None)
        if not found and not waiting:
            return
        p, s = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2
        e = s + size
        if waiting:
            wp, ws, we = np.array(waiting, np.int64).T
            p, s, e = np.concatenate([wp, p]), np.concatenate([ws, s]), np.concatenate([we, e])
        fresh = ~self._known(p, s, e)
        p, s, e = p[fresh], s[fresh], e[fresh]
        if not len(p):
            return
        order = np.lexsort((s, p))
        p, s, e = p[order], s[order], e[order]
        head = np.ones(len(p), bool)
        head[1:] = (p[1:] != p[:-1]) | (s[1:] != e[:-1])
        heads = np.flatnonzero(head)
        p, s, e = p[heads], s[heads], np.maximum.reduceat(e, heads)
        long_enough = e - s + 2 * (size - 1) >= self._need(p)
        undecided = e + p + size > self.n       # the next block's counterpart is not all there yet
        held = [(int(a), int(b), int(c)) for a, b, c in zip(p[~long_enough & undecided], s[~long_enough & undecided],
                                                            e[~long_enough & undecided])]
        for a, b, c in zip(p[long_enough].tolist(), s[long_enough].tolist(), e[long_enough].tolist()):
            if not self._take(a, b, c):
                held.append((a, b, c))
        if held:
            self.waiting[size] = held

    def _known(self, p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Which intervals lie within a run at a multiple of its period."""
        r = self.at[s]
        out = r >= 0
        if out.any():
            r = r[out]
            q, end = np.array(self.period)[r], np.array(self.end)[r]
            out[out] = (p[out] % q == 0) & (e[out] + p[out] <= end)
        return out

    def _take(self, p: int, s: int, e: int) -> bool:
        """An interval of equal words at distance p, word by word. False: it is
        too short so far, but reaches the end of the text."""
        at = s
        while at < e:       # one pass, but for words that differ under equal fingerprints
            more = self._forward(at, p)
            if more == 0:
                at += 1
                continue
            a, b = at - self._backward(at, p), at + more
            if b - a >= self._need(p):
                self._add(a, b + p, p)
            elif b + p == self.n:
                return False
            at = b + 1
        return True

    def _add(self, a: int, b: int, p: int) -> None:
        # a stretch whose smallest period divides p is the very run of that period
        same = self.by_start.setdefault(a, [])
        if any(self.end[r] == b and p % self.period[r] == 0 for r in same):
            return
        r = len(self.start)
        same.append(r)
        self.start.append(a)
        self.end.append(b)
        self.period.append(p)
        self.at[a: b] = r
        if b == self.n:
            self.open.append(r)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period."""
        return sorted((a, b - a, q) for a, b, q in zip(self.start, self.end, self.period))


def runs_of(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """The runs of one text's words."""
    if len(words) < max(min_length, min_exponent):
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    catcher = RunCatcher(min_length, min_exponent)
    for at in range(0, len(ids), CHUNK_WORDS):
        catcher.append(ids[at: at + CHUNK_WORDS])
    return catcher.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, each run cut to its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period: start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(df: DataFrame, id_col="doc_id", text_col="text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per input row: id, n_words, runs (array of start, length, period
    in words, by start, then period) and the text with its white space squeezed
    and every run cut to its first period."""
    id_type = df.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
              "collapsed string")
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows, size = 0, [], 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_buffer()
                words = text.to_pybytes().split() if text is not None else []
                runs = runs_of(words, min_length, min_exponent)
                rows.append((len(words), runs, collapsed(words, runs)))
                size += len(rows[-1][2])
                if size >= OUT_BYTES or i + 1 == batch.num_rows:
                    n, found, short = zip(*rows)
                    yield pa.record_batch([
                        batch.column(0).slice(at, len(rows)), pa.array(n, pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], run_type),
                        pa.array([s.decode("utf-8", "surrogatepass") for s in short], pa.string())],
                        names=["id", "n_words", "runs", "collapsed"])
                    at, rows, size = i + 1, [], 0

    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(scan, schema)
