"""Nearest neighbours inside the classes of one table of distinct vectors, spread over the cluster.

A class of at most one leaf is worked on whole, so its neighbours are exact. Of a larger one every vector goes to
one leaf of each of a few random trees: tasks take ranges of (class, tree, random projection) and cut them on at
medians of further projections. Inside a leaf neighbours are exact, and a vector's short lists from its leaves
are merged. Work and shuffle are trees times rows times leaf, whatever the data; the plan is one for all classes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.operators.joins import lookup_side

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed package

TREES, LEAF = 6, 1024
LEAVES_PER_TASK = 8
NEAR = "array<struct<distance: double, vec: array<double>, copies: bigint>>"


def nearest_distinct(vectors: DataFrame, k: int, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """`(kind, vec, near)`: vectors of the same kind near to each, at most `k`, with distance and number of copies, nearest first.

    `vectors` has `kind string`, not null, and within a kind distinct `vec array<double>` of one length and
    `copies bigint`; it is read more than once.
    """
    leaf = max(leaf, 2 * k + 2)
    n = vectors.count()
    rows = planted(vectors, trees, leaf)
    tasks = max(1, trees * n // (leaf * LEAVES_PER_TASK))
    # rows of a small class have one key, which no range ends within
    ranged = rows.repartitionByRange(tasks, "kind", "tree", "at", F.when(F.col("at").isNotNull(), F.col("vec")))
    ranged = ranged.sortWithinPartitions("kind", "tree", "vec").select("kind", "tree", "vec", "copies")
    short = ranged.mapInPandas(_leaves(k, leaf), f"kind string, vec array<double>, near {NEAR}")
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))  # at most trees * k entries
    return short.groupBy("kind", "vec").agg(F.slice(merged, 1, k).alias("near"))


def planted(vectors: DataFrame, trees: int, leaf: int = LEAF) -> DataFrame:
    """`(kind, vec, copies, tree, at)`: each vector once for each tree, with its place along the tree's first direction.

    Vectors of a kind with at most `leaf` of them come once, without a place.
    """
    first = vectors.select(F.size("vec").alias("width")).first()
    width = first["width"] if first else 0
    directions = np.random.default_rng(11).standard_normal((trees, max(1, width)))
    places = [F.aggregate(F.zip_with("vec", F.lit(d.tolist()), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x) for d in directions]
    large = vectors.groupBy("kind").agg(F.count("*").alias("_n")).filter(F.col("_n") > leaf).select(F.col("kind").alias("_kind"))
    marked = vectors.join(lookup_side(large), F.col("kind") == F.col("_kind"), "left")
    at = F.when(F.col("_kind").isNotNull(), F.array(*places)).otherwise(F.array(F.lit(None).cast("double")))
    return marked.select("kind", "vec", "copies", F.posexplode(at).alias("tree", "at"))


def _leaves(k: int, leaf: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows are sorted by (kind, tree); of both only one is held at a time."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            same = (batch["kind"].ne(batch["kind"].shift()) | batch["tree"].ne(batch["tree"].shift())).cumsum()
            for _, part in batch.groupby(same, sort=False):
                if held and (held[0]["kind"].iat[0], held[0]["tree"].iat[0]) != (part["kind"].iat[0], part["tree"].iat[0]):
                    yield from cut(pd.concat(held, ignore_index=True))
                    held = []
                held.append(part)
        if held:
            yield from cut(pd.concat(held, ignore_index=True))

    def cut(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        kind, tree, copies = rows["kind"].iat[0], int(rows["tree"].iat[0]), rows["copies"].to_numpy()
        points = np.array(rows["vec"].tolist(), dtype=float).reshape(len(rows), -1)
        rng, todo = np.random.default_rng(tree), [np.arange(len(rows))]
        while todo:
            part = todo.pop()
            if len(part) > leaf:
                order = part[np.argsort(points[part] @ rng.standard_normal(points.shape[1]), kind="stable")]
                todo += [order[: len(order) // 2], order[len(order) // 2 :]]
            else:
                found = _within(points[part], copies[part], k)
                found.insert(0, "kind", kind)
                yield found

    return run


def _within(points: np.ndarray, copies: np.ndarray, k: int) -> pd.DataFrame:
    """The nearest other points of each point of a leaf."""
    squares = (points * points).sum(1)
    rough = squares[:, None] + squares[None, :] - 2.0 * points @ points.T
    np.fill_diagonal(rough, np.inf)
    n = min(k + 4, len(points) - 1)
    near = []
    for i in range(len(points)):
        picks = np.argpartition(rough[i], n - 1)[:n] if n else np.zeros(0, int)
        exact = np.sqrt(((points[picks] - points[i]) ** 2).sum(1))
        order = picks[np.lexsort((picks, exact))][:k]
        exact.sort()
        near.append([{"distance": float(d), "vec": points[j].tolist(), "copies": int(copies[j])} for d, j in zip(exact, order)])
    return pd.DataFrame({"vec": points.tolist(), "near": near})
