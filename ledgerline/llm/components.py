"""Connected components by randomised contraction, as Spark jobs.

Every round gives each node a pseudo-random rank, lets it join its lowest
ranked neighbour, and contracts the links onto those representatives; a
constant share of the nodes goes in each round whatever the shape (long chains
too). Links, maps and labels are written tables; nothing comes to the driver
but a row count per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import forest, stored


def thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs thinned within each partition to a star forest
    with the same components: no more links than a partition has nodes."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.empty(0, np.int64)
        for batch in batches:
            a, b = forest(np.concatenate([a, batch.column(0).to_numpy()]),
                          np.concatenate([b, batch.column(1).to_numpy()]))
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return links.select("a", "b").mapInArrow(thin, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of long nodes to (node, root): one row per linked node,
    root being one node of its component."""
    edges = stored(thinned(links), "cc-links")
    labels = None
    round_ = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("a").alias("b"), F.col("b").alias("a")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_)).alias("r"), F.col(c).alias("v"))
        rep = (both.groupBy("a").agg(F.min(rank("b")).alias("low"))
               .select(F.col("a").alias("node"), F.least(F.col("low"), rank("a"))["v"].alias("rep")))
        rep = stored(rep, "cc-reps")
        if labels is None:
            labels = rep.select("node", F.col("rep").alias("root"))
        else:
            labels = (labels.join(rep.select(F.col("node").alias("root"), "rep"), "root", "left")
                      .select("node", F.coalesce("rep", "root").alias("root")))
        labels = stored(labels, "cc-labels")
        to_a, to_b = rep.select(F.col("node").alias("a"), F.col("rep").alias("ra")), rep.select(
            F.col("node").alias("b"), F.col("rep").alias("rb"))
        edges = stored(thinned(edges.join(to_a, "a").join(to_b, "b").where("ra != rb")
                               .select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "cc-links")
        round_ += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
