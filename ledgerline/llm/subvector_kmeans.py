"""Centroid clustering (k-means) over subvector dictionaries, in whole numbers.

Each component x becomes the integer floor(scale * x). The vectors are cut into
blocks of ``block`` dimensions and stored in chunks; per chunk and block the
distinct subvectors form a dictionary and each vector keeps their codes, which
loses nothing. A round computes the exact squared distance of every dictionary
entry to every centroid's part once, and a vector's distance is the sum of its
codes' parts. New centroids come from how often each cluster uses each entry.

Vectors are never shuffled: a task hands on at most clusters x dimensions sums,
and the driver holds the centroids (k x dimensions numbers). Copies of a vector,
however many, are rows like any others. The encoded chunks are a table in the
cluster's shared folder, read again by every round.

Defined results: vectors with another number of components, or with a null or
non-finite one, are left out; null or repeated ids are kept (the first
centroids are ordered by the hash of the id, then by the vector); fewer vectors
than clusters give as many clusters as vectors; no vector gives no row. A
component whose integer is beyond 2^27 would not fit exact 64-bit distances:
the job fails and says so. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
BLOCK = 2               # dimensions of a block
CHUNK = 16_384          # vectors of a chunk: memory of a task, not a limit
MAX_INTEGER = 1 << 27   # 64 squares of a difference of two such fit a long


@dataclass
class Encoded:
    """The stored table of chunks and what is needed to read it."""
    chunks: DataFrame
    id_type: str
    dimensions: int
    block: int


def _kept(df: DataFrame, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (df.select(F.col(id_col).alias("id"), v.alias("v"))
            .where(F.coalesce((F.size("v") == dimensions) & sound, F.lit(False))))


def _integers(vectors: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions) * scale)
    if len(x) and np.abs(x).max() > MAX_INTEGER:
        raise ValueError(f"a component's integer is beyond {MAX_INTEGER}: distances would not be exact")
    return x.astype(np.int64)


def _encode_chunk(x: np.ndarray, block: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per block its distinct subvectors and every vector's code."""
    dictionaries, codes = [], []
    for at in range(0, x.shape[1], block):
        part = np.ascontiguousarray(x[:, at: at + block])
        # one key per subvector, exact: the spans' product says whether it fits a long
        low = part.min(axis=0)
        span = [int(s) for s in part.max(axis=0) - low + 1]
        size = 1
        for s in span:
            size *= s
        if size < 1 << 62:
            key = np.zeros(len(part), np.int64)
            for d, s in enumerate(span):
                key = key * s + (part[:, d] - low[d])
        else:
            key = part.view([("", part.dtype)] * part.shape[1]).ravel()
        _, first, code = np.unique(key, return_index=True, return_inverse=True)
        dictionaries.append(part[first])
        codes.append(code.ravel().astype(np.int32))
    return dictionaries, codes


def encode(df: DataFrame, id_col="vec_id", vector_col="embedding", dimensions: int = DIMENSIONS, scale: int = SCALE,
           block: int = BLOCK, chunk: int = CHUNK) -> Encoded:
    """The kept vectors as dictionary-encoded chunks, in a table of the shared
    folder: ids, and per block the dictionary (int64) and the codes (int32) as bytes."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, n = [], [], 0

        def out():
            x = np.concatenate(vectors)
            dictionaries, codes = _encode_chunk(x, block)
            row = [pa.chunked_array(ids).combine_chunks() if len(ids) > 1 else ids[0]]
            return pa.record_batch([
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), row[0]),
                pa.array([[d.tobytes() for d in dictionaries]], pa.list_(pa.binary())),
                pa.array([[c.tobytes() for c in codes]], pa.list_(pa.binary()))], names=["ids", "dictionaries", "codes"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(chunk - n, batch.num_rows - at)
                ids.append(batch.column(0).slice(at, take))
                vectors.append(_integers(batch.column(1).slice(at, take), dimensions, scale))
                n, at = n + take, at + take
                if n == chunk:
                    yield out()
                    ids, vectors, n = [], [], 0
        if n:
            yield out()

    kept = _kept(df, id_col, vector_col, dimensions)
    chunks = stored(kept.mapInArrow(run, f"ids array<{id_type}>, dictionaries array<binary>, codes array<binary>"),
                    "subvectors")
    return Encoded(chunks, id_type, dimensions, block)


def first_centroids(df: DataFrame, id_col="vec_id", vector_col="embedding", dimensions: int = DIMENSIONS,
                    scale: int = SCALE, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``, in that order."""
    name: Column = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = (_kept(df, id_col, vector_col, dimensions).select("v", F.sha2(name, 256).alias("h"))
             .orderBy("h", "v").limit(clusters).collect())      # clusters x dimensions numbers
    vectors = pa.array([r["v"] for r in first], pa.list_(pa.float64()))
    return _integers(vectors, dimensions, scale) if first else np.empty((0, dimensions), np.int64)


def _read(batch: pa.RecordBatch, row: int, dimensions: int, block: int):
    """The dictionaries and codes of a stored chunk."""
    widths = [min(block, dimensions - at) for at in range(0, dimensions, block)]
    dictionaries = [np.frombuffer(d, np.int64).reshape(-1, w)
                    for d, w in zip(batch.column("dictionaries")[row].as_py(), widths, strict=True)]
    codes = [np.frombuffer(c, np.int32) for c in batch.column("codes")[row].as_py()]
    return dictionaries, codes


def nearest(dictionaries, codes, centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance of
    every vector of a chunk: sums of partial distances by code."""
    total = np.zeros((len(codes[0]), len(centroids)), np.int64)
    for b, (entries, code) in enumerate(zip(dictionaries, codes)):
        part = np.zeros((len(entries), len(centroids)), np.int64)
        for d in range(entries.shape[1]):
            part += (entries[:, d, None] - centroids[None, :, b * block + d]) ** 2
        total += part[code]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(total)), best]


def _sums(encoded: Encoded, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Per non-empty cluster its number of vectors, summed distance and summed
    components, exact; clusters x (dimensions + 2) numbers come back."""
    dimensions, block, k = encoded.dimensions, encoded.block, len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dimensions), object)    # whole numbers without a bound
        counts, inertia = np.zeros(k, np.int64), np.zeros(k, object)
        for batch in batches:
            for row in range(batch.num_rows):
                dictionaries, codes = _read(batch, row, dimensions, block)
                cluster, distance = nearest(dictionaries, codes, centroids, block)
                counts += np.bincount(cluster, minlength=k)
                for c in np.flatnonzero(np.bincount(cluster, minlength=k)):
                    inertia[c] += sum(distance[cluster == c].tolist())
                for b, (entries, code) in enumerate(zip(dictionaries, codes)):
                    # uses of each entry by each cluster, of those that occur
                    pair, uses = np.unique(cluster * np.int64(len(entries)) + code, return_counts=True)
                    c, entry = np.divmod(pair, len(entries))
                    for d in range(entries.shape[1]):
                        chunk_sum = np.zeros(k, np.int64)   # a chunk's sum is below 2^27 x its vectors
                        np.add.at(chunk_sum, c, entries[entry, d] * uses)
                        sums[:, b * block + d] += chunk_sum.tolist()
        for c in np.flatnonzero(counts).tolist():
            values = [int(counts[c]), int(inertia[c]), *map(int, sums[c])]
            yield pa.record_batch([pa.array([c] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()),
                                   pa.array([str(v) for v in values])], names=["cluster", "place", "value"])

    rows = (encoded.chunks.select("dictionaries", "codes")
            .mapInArrow(run, "cluster int, place int, value string")
            .groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    out: dict[int, list[int]] = {}
    for r in rows:
        out.setdefault(r["cluster"], [0] * (dimensions + 2))[r["place"]] = int(r["value"])
    return {c: (v[0], v[1], v[2:]) for c, v in out.items()}


def fit(encoded: Encoded, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds; a non-empty cluster's centroid becomes the floor of its
    vectors' mean in every component, an empty one's stays."""
    for _ in range(rounds if len(centroids) else 0):
        centroids = centroids.copy()
        for c, (n, _, total) in _sums(encoded, centroids).items():
            centroids[c] = [t // n for t in total]
    return centroids


def assign(encoded: Encoded, centroids: np.ndarray) -> DataFrame:
    """One row per kept vector: id, cluster, distance (squared), cluster_inertia
    and inertia (summed distances of its cluster and of all), centroid_sha256
    (of the components as decimal integers joined by commas)."""
    dimensions, block = encoded.dimensions, encoded.block
    schema = (f"id {encoded.id_type}, cluster int, distance long, cluster_inertia long, inertia long, "
              "centroid_sha256 string")
    inertia = {c: s for c, (_, s, _) in _sums(encoded, centroids).items()} if len(centroids) else {}
    whole = sum(inertia.values())
    if whole >= 1 << 63:
        raise ValueError("the summed distances do not fit a long")
    per_cluster = np.array([inertia.get(c, 0) for c in range(len(centroids))], np.int64)
    names = pa.array([hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cluster, distance = nearest(*_read(batch, row, dimensions, block), centroids, block)
                ids = batch.column("ids")[row].values
                yield pa.record_batch([ids, pa.array(cluster.astype(np.int32)), pa.array(distance),
                                       pa.array(per_cluster[cluster]), pa.array(np.full(len(cluster), whole, np.int64)),
                                       names.take(pa.array(cluster))],
                                      names=["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return encoded.chunks.mapInArrow(run, schema)


def cluster(df: DataFrame, id_col="vec_id", vector_col="embedding", dimensions: int = DIMENSIONS, scale: int = SCALE,
            clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """k-means of the whole table; see ``assign`` for the columns."""
    encoded = encode(df, id_col, vector_col, dimensions, scale, block)
    centroids = first_centroids(df, id_col, vector_col, dimensions, scale, clusters, seed)
    return assign(encoded, fit(encoded, centroids, rounds))
