"""Text features of the classifiers: computed per text with numpy, in Arrow
batches, from the whole text."""

from __future__ import annotations

from collections import Counter
from operator import eq
from zlib import crc32

import numpy as np

_MIX = np.uint32(2654435761)  # multiplicative hashing

STATS = ("log_words", "upper", "symbols", "digits", "distinct_words", "top_word", "word_length",
         "shouting", "repeated_lines", "line_words", "ends", "stutter")

_CLASS = np.zeros(256, np.uint8)
for _c in range(128):
    _s = chr(_c)
    _CLASS[_c] = (1 if _s.isupper() else 2 if _s.islower() else 3 if _s.isdigit()
                  else 4 if _s.isspace() else 6 if _s in ".,;:'\"?-()" else 5)


def stats(data: bytes, words: list[bytes]) -> np.ndarray:
    """Scale-free statistics of one text and its lower-cased words; zeros for none."""
    out = np.zeros(len(STATS))
    if not words:
        return out
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=7)
    n, letters = len(words), max(1, kinds[1] + kinds[2])
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    out[:] = (np.log1p(n), kinds[1] / letters, kinds[5] / len(data), kinds[3] / len(data),
              len(counts) / n ** 0.9, max(counts.values()) / n, sum(map(len, words)) / n / 10,
              data.count(b"!") / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
              data.count(b".") / n, sum(map(eq, words, words[1:])) / n)
    return out


def char_grams(data: bytes, size: int, bits: int) -> np.ndarray:
    """Hash buckets (2^bits) of the byte n-grams, repeats included; size <= 4."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(raw) < size:
        return np.empty(0, np.uint32)
    code = np.full(len(raw) - size + 1, size, np.uint32)
    for i in range(size):
        code = code * np.uint32(257) + raw[i: len(raw) - size + 1 + i]
    return (code * _MIX) >> np.uint32(32 - bits)


def word_grams(words: list[bytes], size: int, bits: int) -> np.ndarray:
    """Hash buckets of the word n-grams, repeats included."""
    if len(words) < size:
        return np.empty(0, np.uint32)
    h = np.fromiter(map(crc32, words), np.uint32, len(words))
    code = np.full(len(h) - size + 1, size, np.uint32)
    for i in range(size):
        code = code * np.uint32(31) + h[i: len(h) - size + 1 + i]
    return (code * _MIX) >> np.uint32(32 - bits)


def root_shares(buckets: np.ndarray, bits: int) -> np.ndarray:
    """Square roots of the buckets' shares: a unit vector, zero for no bucket."""
    if not len(buckets):
        return np.zeros(1 << bits, np.float32)
    return np.sqrt(np.bincount(buckets, minlength=1 << bits) / len(buckets)).astype(np.float32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Adam:
    """Steps for one parameter vector."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, w: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        w -= self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)
