"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Examples are a bounded sample of labelled rows of the training folds. The
terms are words without outer punctuation, their leading stems, and stems that
come twice or three times, each known by a 64-bit hash. Every term of the
examples is indexed; document frequencies are those of the indexed collection,
and a term of no example has the largest idf there is, so a text's norm covers
all its terms in the same pass. (Such terms scale all similarities of a text
alike: order, votes and score do not depend on them, ``evidence`` does.)

The inverted index keeps the examples in blocks of alike ones. Terms of few
examples have their postings, which are added up first, for all examples.
Terms of many examples are kept by block with each block's largest weight: the
postings so far and these maxima bound what a block can reach. The blocks with
the highest bounds are opened first, then all that the k-th best similarity
found does not rule out, for many texts in one product of matrices: the result
is the exact top k.

Texts with many common terms are similar to every text, and toxic words are a
small part of a long one. So there are many neighbours, and each votes with how
far its similarity is above its own usual one (mean and deviation over the other
examples), from the least of the neighbours on; examples of either label are
weighted back to that label's number of rows. A curve fitted to the
examples' own votes (each left out of its own neighbours) calibrates the
share. ``evidence`` lists the nearest examples. The index is bounded by the
examples' texts and is broadcast; scoring is one pass over the texts.

Defined results: a text without any term of the examples (empty and null ones
too) gets the calibrated rate of toxic rows among examples without neighbours;
without labels every score is 0; ties in similarity go to the example with the
lower number; rows repeat as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerline.llm.common import batches_of, fold_of, release, text_of
from ledgerline.llm.features import sigmoid
from ledgerline.llm.labelled import HELD_OUT_FOLDS, label_counts, sample_labels, with_texts

PER_CLASS = 2_000     # bound of the examples, per label
STEMS = (4, 5, 6, 7, 8)
REPEATS = (2, 3)      # a stem that comes so often in a text is a further term
NEIGHBOURS = (15, 200)  # at least and at most; in between, 1 / SHARE of the examples
SHARE = 16
BLOCK = 64            # examples of a block of the index
OPENED = 4            # blocks of each text opened before the bounds decide
DENSE_SHARE = 1 / 12  # a term of more examples than this is bounded by block
SEEDS = 24            # examples that the others are grouped around for the order of blocks
TEXTS = 256           # texts scored together
THRESHOLD = 0.5
EVIDENCE = 3
_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_CACHE = 400_000      # remembered words of a task: memory, not a limit
_TOKENS = 400_000     # read at once: memory, not a limit
_BITS = 40            # of a term's number in a sort key


def terms_of(word: str) -> list[str]:
    """The bare word and its leading stems (marked, so that they differ from words)."""
    bare = word.lower().strip(_OUTER)
    return [bare] + [bare[:n] + "-" for n in STEMS if len(bare) >= n] if bare else []


def _hashes(word: str) -> list[int]:
    """64-bit hashes of ``terms_of(word)``: even for the word, odd for stems."""
    digest, data = xxhash.xxh64_intdigest, [t.encode("utf-8", "surrogatepass") for t in terms_of(word)]
    return [digest(data[0]) >> 1 << 1, *[digest(d) | 1 for d in data[1:]]] if data else []


class Terms:
    """Texts to the hashes of their terms and how often each comes. Hashes of
    stems are odd, those of words and repeats even."""

    def __init__(self):
        self.row, self.table = {}, np.zeros((1024, 1 + len(STEMS)), np.int64)

    def _add(self, word: str) -> int:
        at = self.row[word] = len(self.row)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        full = np.array(_hashes(word), np.uint64).view(np.int64)
        self.table[at] = 0
        self.table[at, : len(full)] = full
        return at

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = Counter((text or "").split())
        if len(self.row) > _CACHE:
            self.row.clear()
        get = self.row.get
        rows = [self._add(w) if (at := get(w)) is None else at for w in words]
        found = self.table[rows].ravel() if rows else np.empty(0, np.int64)
        times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), self.table.shape[1])
        some = found != 0
        terms, at = np.unique(found[some], return_inverse=True)
        n = np.bincount(at, times[some], minlength=len(terms)).astype(np.int64)
        stems = terms & 1 == 1
        more = [_repeat(terms[stems & (n >= k)], k) for k in REPEATS]
        return np.concatenate([terms, *more]), np.concatenate([n, *[np.ones(len(m), np.int64) for m in more]])


def _repeat(stems: np.ndarray, times: int) -> np.ndarray:
    """The hashes of the terms that say a stem comes so often."""
    z = (stems.view(np.uint64) ^ np.uint64(times)) * np.uint64(0x9E3779B97F4A7C15)
    return ((z ^ (z >> np.uint64(29))) << np.uint64(1)).view(np.int64)


class Vectors:
    """Indexed terms with their numbers and weights, (1 + log tf) * idf."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, unseen_idf: float):
        self.terms, self.idf, self.unseen_idf = terms, idf, unseen_idf  # sorted hashes
        self.stem = terms & 1 == 1
        self.repeats = {k: np.where(self.stem, self.numbers(_repeat(terms, k)), -1) for k in REPEATS}

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term, -1 for a term of no example."""
        if not len(self.terms):
            return np.full(len(terms), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def of(self, numbers: np.ndarray, n: np.ndarray, unseen: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of a vector of unit length, of which
        ``unseen`` (squared, in units of the unseen idf) is not indexed."""
        w = (1 + np.log(n)) * self.idf[numbers]
        square = float((w * w).sum())
        whole = square + unseen * self.unseen_idf ** 2
        return (numbers, w / np.sqrt(whole)) if square > 0 else (numbers[:0], w[:0])


class Reader:
    """Texts to the numbers of their indexed terms, how often each comes, and
    the squared weight of the terms of no example (without their idf)."""

    def __init__(self, vectors: Vectors):
        self.vectors = vectors
        self._clear()

    def _clear(self) -> None:
        """Terms of no example have numbers of their own, after the indexed ones."""
        self.row, self.code, self.stem = {}, {}, self.vectors.stem
        self.table = np.full((1024, 1 + len(STEMS)), -1, np.int64)

    def _add(self, words: list[str]) -> None:
        """Remembers words: the numbers of their terms. Stems, which many words
        share, are remembered too."""
        first = len(self.row)
        while first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        terms, code = list(map(terms_of, words)), self.code
        sizes, flat = np.fromiter(map(len, terms), np.int64, len(terms)), list(chain.from_iterable(terms))
        new = list(set(flat).difference(code))
        if new:
            digest = xxhash.xxh64_intdigest
            hashes = np.array([digest(t.encode("utf-8", "surrogatepass")) for t in new], np.uint64)
            stem = np.array([t[-1] == "-" for t in new])     # a bare word has no outer mark
            hashes = (hashes >> np.uint64(1) << np.uint64(1)) | stem.astype(np.uint64)
            numbers = self.vectors.numbers(hashes.view(np.int64))
            other = numbers < 0
            numbers[other] = len(self.stem) + np.arange(int(other.sum()))
            self.stem = np.concatenate([self.stem, stem[other]])
            code.update(zip(new, numbers.tolist(), strict=True))
        there = np.arange(self.table.shape[1]) < sizes[:, None]
        self.table[first: first + len(words)][there] = np.fromiter(map(code.__getitem__, flat), np.int64, len(flat))
        self.row.update(zip(words, range(first, first + len(words)), strict=True))

    def read(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        out, words, tokens = [], [], 0
        for text in texts:
            words.append((text or "").split())
            tokens += len(words[-1])
            if tokens > _TOKENS:
                out += self._count(words)
                words, tokens = [], 0
        return out + self._count(words)

    def _count(self, words: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        many, indexed, low = len(words), len(self.vectors.terms), (1 << _BITS) - 1
        if not many:
            return []
        seen = set().union(*words)
        if len(self.row) > _CACHE:
            self._clear()
        self._add(list(seen.difference(self.row)))
        sizes = list(map(len, words))
        rows = np.fromiter(map(self.row.__getitem__, chain.from_iterable(words)), np.int64, sum(sizes))
        key = np.sort(np.repeat(np.arange(many) << _BITS, sizes) | rows)
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        word, times = key[starts], np.diff(starts, append=len(key))
        codes = self.table[word & low]
        some = codes >= 0
        key = ((word & ~low)[:, None] | codes)[some]
        order = np.argsort(key)
        key, times = key[order], np.repeat(times, some.sum(1))[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        text, term, n = key[starts] >> _BITS, key[starts] & low, np.add.reduceat(times, starts) if len(starts) else times
        known, stem = term < indexed, self.stem[term]
        unseen = np.bincount(text[~known], (1 + np.log(n[~known])) ** 2, minlength=many)
        found, counts = [key[starts][known]], [n[known]]
        for k in REPEATS:
            unseen += np.bincount(text[~known & stem & (n >= k)], minlength=many)
            which = known & stem & (n >= k)
            repeat, of = self.vectors.repeats[k][term[which]], text[which]
            unseen += np.bincount(of[repeat < 0], minlength=many)
            found.append((of << _BITS | repeat)[repeat >= 0])
            counts.append(np.ones(len(found[-1]), np.int64))
        key, n = np.concatenate(found), np.concatenate(counts)
        order = np.argsort(key)
        key, n = key[order], n[order]
        cuts = np.searchsorted(key, np.arange(1, many) << _BITS)
        return list(zip(np.split(key & low, cuts), np.split(n, cuts), unseen.tolist(), strict=True))


class BlockMaxIndex:
    """Postings of rare terms, blocks with maxima of the others; exact top-k by cosine."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(rows)
        self.blocks = -(-self.n // BLOCK) or 1
        term = np.concatenate([r[0].astype(np.int32) for r in rows] or [np.empty(0, np.int32)])
        weight = np.concatenate([r[1] for r in rows] or [np.empty(0)])
        row = np.repeat(np.arange(self.n, dtype=np.int32), [len(r[0]) for r in rows])
        df = np.bincount(term, minlength=n_terms)
        dense = df > max(DENSE_SHARE * self.n, 1)
        self.column = np.where(dense, np.cumsum(dense) - 1, -1).astype(np.int32)
        matrix = np.zeros((self.blocks * BLOCK, int(dense.sum())))
        often = dense[term]
        matrix[row[often], self.column[term[often]]] = weight[often]
        # Alike examples side by side: by the nearest seed, then by nearness.
        seeds = matrix[np.linspace(0, max(self.n - 1, 0), min(SEEDS, self.n)).astype(int)] if self.n else matrix[:0]
        near = matrix[: self.n] @ seeds.T
        self.place = np.lexsort((-near.max(1), near.argmax(1))) if near.size else np.arange(self.n)  # example at each place
        at = np.empty(self.n, np.int64)
        at[self.place] = np.arange(self.n)
        matrix[: self.n] = matrix[self.place]
        self.columns, parts = matrix.shape[1], matrix.reshape(self.blocks, BLOCK, -1)
        self.top = parts.max(1)
        # Alike examples have many terms in common: each block with its own columns.
        self.parts = [(used := np.flatnonzero(top), part[:, used]) for top, part in zip(self.top, parts, strict=True)]
        rare = np.flatnonzero(~often)
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.posting, self.weight = at[row[rare]], weight[rare]
        self.of_term = np.searchsorted(term[rare], np.arange(n_terms + 1)).astype(np.int64)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip: list[int] | None = None,
                sums: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (term numbers, weights) the rows and similarities of its k
        nearest (similarity above 0), best first; ``skip``: a row to leave out of
        each; ``sums``: gets every row's similarities and their squares added."""
        many, width = len(queries), self.blocks * BLOCK
        dense = np.zeros((self.columns, many))
        near = np.zeros((many, width))      # by the rare terms
        for i, (ids, weights) in enumerate(queries):
            column = self.column[ids]
            often = column >= 0
            dense[column[often], i] = weights[often]
            few, w = ids[~often], weights[~often]
            start = self.of_term[few]
            sizes = self.of_term[few + 1] - start
            total = int(sizes.sum())
            if total:
                at = np.repeat(start - np.cumsum(sizes) + sizes, sizes)
                at += np.arange(total)
                products = self.weight[at]
                products *= np.repeat(w, sizes)
                near[i] = np.bincount(self.posting[at], products, minlength=width)
        opened = np.full((many, width), -1.0)
        gone = None
        if skip is not None:
            place = np.empty(self.n, np.int64)
            place[self.place] = np.arange(self.n)
            gone = np.arange(many), place[skip]
        if sums is not None:
            self._open(np.ones((many, self.blocks), bool), dense, near, opened)
            if gone:
                opened[gone] = 0
            sums[0][self.place] += opened[:, : self.n].sum(0)
            sums[1][self.place] += (opened[:, : self.n] ** 2).sum(0)
        else:
            # A little slack: bounds and similarities are sums of rounded products.
            bound = (self.top @ dense).T + near.reshape(many, self.blocks, BLOCK).max(2) + 1e-9
            first = np.zeros((many, self.blocks), bool)
            np.put_along_axis(first, np.argsort(-bound, axis=1, kind="stable")[:, :OPENED], True, 1)
            self._open(first, dense, near, opened)
            if gone:
                opened[gone] = -1
            least = self._kth(opened, k)
            self._open((bound >= least[:, None]) & ~first, dense, near, opened)
        if gone:
            opened[gone] = -1
        out = []
        for sims, least in zip(opened, self._kth(opened, k) - 1e-9, strict=True):
            places = np.flatnonzero((sims >= least) & (sims > 1e-12))
            places = places[places < self.n]
            rows, sims = self.place[places], sims[places]
            best = np.lexsort((rows, -np.round(sims, 9)))[:k]
            out.append((rows[best], sims[best]))
        return out

    @staticmethod
    def _kth(opened: np.ndarray, k: int) -> np.ndarray:
        """The k-th best similarity of each query so far, 0 for fewer."""
        if opened.shape[1] < k:
            return np.zeros(len(opened))
        return np.maximum(np.partition(opened, -k, axis=1)[:, -k], 0)

    def _open(self, wanted: np.ndarray, dense: np.ndarray, near: np.ndarray, out: np.ndarray) -> None:
        for b in np.flatnonzero(wanted.any(0)).tolist():
            who, part = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
            columns, weights = self.parts[b]
            if 2 * len(who) > len(wanted):      # cheaper than picking them
                out[:, part] = near[:, part] + (weights @ dense[columns]).T
            else:
                out[who, part] = near[who, part] + (weights @ dense[np.ix_(columns, who)]).T


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


@dataclass
class KnnModel:
    vectors: Vectors
    index: BlockMaxIndex | None
    labels: np.ndarray
    ids: list
    class_weight: tuple[float, float]
    rows: list[tuple[np.ndarray, np.ndarray]]   # term numbers and counts of the examples
    usual: np.ndarray                           # per example mean and deviation of its similarities
    slope: float = 1.0
    shift: float = 0.0
    none_score: float = 0.0

    @property
    def neighbours(self) -> int:
        return int(np.clip(len(self.labels) // SHARE, *NEIGHBOURS))

    def __getstate__(self) -> dict:
        """What the index is made of; a worker builds it once, so that a
        broadcast has eight bytes for each term of an example, not the index."""
        small = {k: v for k, v in self.__dict__.items() if k not in ("vectors", "index", "rows", "_reader")}
        return small | {"terms": self.vectors.terms, "sizes": np.array([len(r[0]) for r in self.rows]),
                        "numbers": np.concatenate([r[0] for r in self.rows]).astype(np.int32),
                        "counts": _narrow(np.concatenate([r[1] for r in self.rows]))}

    def __setstate__(self, state: dict) -> None:
        terms, sizes, numbers, counts = (state.pop(k) for k in ("terms", "sizes", "numbers", "counts"))
        cuts = np.cumsum(sizes)[:-1]
        self.__dict__.update(state)
        self.rows = list(zip(np.split(numbers.astype(np.int64), cuts), np.split(counts.astype(np.int64), cuts), strict=True))
        self.vectors = vectors_of(terms, numbers, len(sizes))
        self.index = BlockMaxIndex([self.vectors.of(*r) for r in self.rows], len(terms))

    def reader(self) -> Reader:
        """One for all tasks of a worker."""
        if "_reader" not in self.__dict__:
            self._reader = Reader(self.vectors)
        return self._reader

    def share(self, rows: np.ndarray, sims: np.ndarray) -> float:
        mean, deviation = self.usual
        above = (sims - mean[rows]) / deviation[rows]
        # Of fewer neighbours, the others have a similarity of 0.
        above -= above.min() if len(rows) == self.neighbours else (-mean / deviation).min()
        if not above.any():
            above += 1
        votes = above * np.where(self.labels[rows] == 1, self.class_weight[1], self.class_weight[0])
        return float(votes[self.labels[rows] == 1].sum() / votes.sum())

    def calibrated(self, share: float) -> float:
        return float(sigmoid(np.array(self.slope * (2 * share - 1) + self.shift)))

    def score(self, texts: list[tuple[np.ndarray, np.ndarray, float]]) -> list[tuple[float, list[dict]]]:
        """Score and evidence of texts given as a reader reads them."""
        out = []
        for rows, sims in self.index.nearest([self.vectors.of(*t) for t in texts], self.neighbours):
            value = self.calibrated(self.share(rows, sims)) if len(rows) else self.none_score
            out.append((value, [{"id": self.ids[r], "similarity": float(s), "label": int(self.labels[r])}
                                for r, s in zip(rows[:EVIDENCE].tolist(), sims.tolist(), strict=False)]))
        return out


def vectors_of(terms: np.ndarray, numbers: np.ndarray, n: int) -> Vectors:
    """Vectors of a collection of n examples, given its terms and the numbers
    of every example's terms, one after another."""
    idf = np.log((n + 1) / (np.bincount(numbers, minlength=len(terms)) + 1))
    return Vectors(terms, idf, float(np.log(n + 1)))


def fit(vectors: Vectors, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: list,
        class_rows: tuple[int, int]) -> KnnModel:
    """Index and calibration from the examples' term counts."""
    vecs = [vectors.of(*c) for c in rows]
    sampled = [max(1, int((labels == c).sum())) for c in (0, 1)]
    weight = tuple(class_rows[c] / sampled[c] for c in (0, 1))
    model = KnnModel(vectors, BlockMaxIndex(vecs, len(vectors.idf)), labels, ids, weight, rows, np.zeros((2, len(vecs))))
    sums = np.zeros((2, len(vecs)))
    found = [n for at in range(0, len(vecs), TEXTS) for n in model.index.nearest(
        vecs[at: at + TEXTS], model.neighbours, list(range(at, min(at + TEXTS, len(vecs)))), sums)]
    mean, square = sums / max(len(vecs) - 1, 1)
    deviation = np.sqrt(np.maximum(square - mean ** 2, 0))
    # An example like no other one must not outvote all the rest.
    deviation = np.maximum(deviation, deviation.mean() / 10 or 1)
    model.usual = np.stack([mean, deviation])
    x, y, w = [], [], []
    none = np.zeros(2)
    for i, (near, sims) in enumerate(found):
        if len(near):
            x.append(2 * model.share(near, sims) - 1)
            y.append(labels[i])
            w.append(weight[labels[i]])
        else:
            none[labels[i]] += weight[labels[i]]
    model.none_score = float(none[1] / none.sum()) if none.sum() else 0.0
    x, y, w = np.array(x), np.array(y), np.array(w)
    if len(y) and 0 < y.sum() < len(y):
        design, ab = np.stack([x, np.ones_like(x)], 1), np.array([1.0, 0.0])
        for _ in range(60):  # Newton steps with a light ridge
            p = sigmoid(design @ ab)
            grad = design.T @ (w * (p - y)) + 1e-2 * ab
            hess = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
            ab -= np.clip(np.linalg.solve(hess, grad), -1, 1)
        model.slope, model.shift = max(float(ab[0]), 0.05), float(ab[1])
    return model


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic",
          per_class=PER_CLASS) -> KnnModel | None:
    """None without labelled rows of both kinds."""
    zeros, ones = label_counts(labels, id_col, label_col)

    def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            rows = [terms.counts(t) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                                   pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["id", "label", "terms", "n"])

    id_type = docs.schema[id_col].dataType.simpleString()
    sample = with_texts(sample_labels(labels, id_col, label_col, per_class, salt=8), docs, id_col, text_col)
    # One text per id, so that an example counts once.
    sample = sample.groupBy("id", "label").agg(F.min("text").alias("text"))
    sample = sample.mapInArrow(term_counts, f"id {id_type}, label int, terms array<long>, n array<int>")
    examples = sample.orderBy(F.xxhash64("id"), "id", "label").toArrow()
    of_row, ids = examples.column("label").to_numpy(), examples.column("id").to_pylist()
    if not 0 < of_row.sum() < len(of_row):
        return None
    cuts = np.cumsum(pc.list_value_length(examples.column("terms")).to_numpy())[:-1]
    terms, number = np.unique(pc.list_flatten(examples.column("terms")).to_numpy(), return_inverse=True)
    n = pc.list_flatten(examples.column("n")).to_numpy()
    del examples
    release()
    number = number.astype(np.int32)
    rows = list(zip(np.split(number, cuts), np.split(n, cuts), strict=True))
    model = fit(vectors_of(terms, number, len(of_row)), rows, of_row, ids, (zeros, ones))
    model.index = None      # workers build it from the counts
    release()
    return model


def score(docs: DataFrame, model: KnnModel | None, id_col="doc_id", text_col="text", threshold=THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score, predicted, evidence."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = model.reader() if model else None
        for whole in batches:
            for batch in batches_of(whole, TEXTS):
                if model is None:
                    got = [(0.0, [])] * batch.num_rows
                else:
                    got = model.score(reader.read(batch.column(2).to_pylist()))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.float64()),
                                       pa.array([g[1] for g in got], kind)], names=["id", "held_out", "score", "evidence"])

    schema = (f"id {id_type}, held_out boolean, score double, "
              f"evidence array<struct<id:{id_type},similarity:double,label:int>>")
    kind = to_arrow_schema(StructType.fromDDL(schema)).field("evidence").type
    rows = docs.select(F.col(id_col).alias("id"), (fold_of(id_col, HELD_OUT_FOLDS) == 0).alias("held_out"),
                       text_of(text_col).alias("text"))
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
