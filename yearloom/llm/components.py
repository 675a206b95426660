"""Connected components of a large edge table, by alternating star rounds.

Every round first contracts the edges each task holds (a local forest), then links
each node's larger neighbours, and then its smaller ones, to the smallest of them. A node with
very many neighbours meets its smallest one in ``SALTS`` parts, by the neighbours' hashes. The edge
table is written to the session's checkpoint folder each round; nothing is collected
but a count and a checksum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.session import materialize

MAX_ROUNDS = 60
SALTS = 16


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (ascending) of the edges a-b and the smallest node of each one's component."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[:len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        open_ = low != high
        x, y, low, high = x[open_], y[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return nodes, nodes[label]


@ta.released
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        x, y = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        nodes, roots = forest(np.concatenate([a, x]), np.concatenate([b, y]))
        a, b = nodes[nodes != roots], roots[nodes != roots]
    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, component), component the smallest node; nodes without an edge to another are absent."""
    links = edges.select("a", "b").where("a <> b").mapInArrow(_contract, "a long, b long").distinct()
    state = None
    for _ in range(MAX_ROUNDS):
        links = materialize(links)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = both.where("b > a").withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
        large = salted.join(spread, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest)
        links = small.mapInArrow(_contract, "a long, b long").distinct()
    raise RuntimeError("components did not settle")
