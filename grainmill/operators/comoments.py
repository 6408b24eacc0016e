"""Co-moments of all pairs of many columns in one scan, each pair over the rows in which both are present.

A task turns Arrow batches into a value and a presence matrix; four matrix products give counts, sums, squares
and cross products of every pair at once, taken around the batch's own means. States are merged by the update
for means and centred moments, so no large sums cancel. A task sends one row of arrays per column; rows of one
column meet in two steps, first by a share of the tasks, then all, each as a sorted stream.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import as_double

#: Parts of the tasks whose states are merged first.
SHARES = 64
#: A pair is computed again from its own rows if less than this share of its squares is left after centring.
CANCELLED = 1e-6

#: Of the pair (row, column): rows, mean and centred squares of `row`, mean and centred squares of `column`, centred products,
#: rows in which one of both is infinite.
FIELDS = ("n", "mean", "square", "other_mean", "other_square", "product", "infinite")
SCHEMA = "at int, share int, task int, " + ", ".join(f"{f} array<double>" for f in FIELDS)

State = dict[str, np.ndarray]


def batch_state(values: np.ndarray) -> State:
    """The state of a matrix of rows, missing values as NaN; arrays are columns squared."""
    infinite = np.isinf(values)
    there = np.isfinite(values)
    first = np.zeros(values.shape[1])
    some = there.any(axis=0)
    first[some] = values[there.argmax(axis=0)[some], np.flatnonzero(some)]
    x = np.where(there, values - first, 0.0)  # a constant column is exactly zero
    count = np.maximum(there.sum(axis=0), 1)
    centre = x.sum(axis=0) / count
    x = np.where(there, x - centre, 0.0)
    mask = there.astype(float)
    n = mask.T @ mask
    many = np.maximum(n, 1.0)
    sums, squares, products = x.T @ mask, (x * x).T @ mask, x.T @ x
    means = sums / many
    state = {
        "n": n,
        "mean": (first + centre)[:, None] + means,
        "square": np.maximum(squares - sums * means, 0.0),
        "product": products - sums * means.T,
    }
    lost = np.triu((state["square"] < CANCELLED * squares) | (state["square"] < CANCELLED * squares).T)
    for i, j in zip(*np.nonzero(lost)):
        _pair_again(state, values, there, i, j)
    state["other_mean"], state["other_square"] = state["mean"].T, state["square"].T
    any_there = (there | infinite).astype(float)
    hit = infinite.astype(float).T @ any_there
    state["infinite"] = hit + hit.T
    return state


def _pair_again(state: State, values: np.ndarray, there: np.ndarray, i: int, j: int) -> None:
    """One pair from the rows it has, centred on their own means."""
    both = there[:, i] & there[:, j]
    if not both.any():
        return
    a, b = values[both, i], values[both, j]
    da, db = a - a[0], b - b[0]
    ma, mb = da.mean(), db.mean()
    da, db = da - ma, db - mb
    state["mean"][i, j], state["mean"][j, i] = a[0] + ma, b[0] + mb
    state["square"][i, j], state["square"][j, i] = da @ da, db @ db
    state["product"][i, j] = state["product"][j, i] = da @ db


def merged(a: State, b: State) -> State:
    """The state of the rows of both."""
    n = a["n"] + b["n"]
    part = b["n"] / np.maximum(n, 1.0)
    weight = a["n"] * part
    step, other = b["mean"] - a["mean"], b["other_mean"] - a["other_mean"]
    step, other = np.where(weight > 0, step, 0.0), np.where(weight > 0, other, 0.0)
    return {
        "n": n,
        "mean": np.where(a["n"] > 0, a["mean"] + step * part, b["mean"]),
        "square": a["square"] + b["square"] + step * step * weight,
        "other_mean": np.where(a["n"] > 0, a["other_mean"] + other * part, b["other_mean"]),
        "other_square": a["other_square"] + b["other_square"] + other * other * weight,
        "product": a["product"] + b["product"] + step * other * weight,
        "infinite": a["infinite"] + b["infinite"],
    }


def _state_rows(rows: list[tuple[int, int, int, State]]) -> pa.RecordBatch:
    keys = [pa.array([r[k] for r in rows], pa.int32()) for k in range(3)]
    arrays = [pa.array([r[3][f] for r in rows], pa.list_(pa.float64())) for f in FIELDS]
    return pa.RecordBatch.from_arrays([*keys, *arrays], names=["at", "share", "task", *FIELDS])


def _merged_rows(batches) -> Iterator[tuple[int, State]]:
    """The merged state of each run of rows with one `at`."""

    def rows():
        for batch in batches:
            at = batch.column("at").to_pylist()
            columns = {f: batch.column(f) for f in FIELDS}
            for i, a in enumerate(at):
                yield a, {f: columns[f][i].values.to_numpy() for f in FIELDS}

    for at, states in groupby(rows(), key=lambda r: r[0]):
        total = None
        for _, state in states:
            total = state if total is None else merged(total, state)
        yield at, total


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its place `at`, and `FIELDS` as arrays over all columns. No rows give no rows."""
    task = F.spark_partition_id().alias("task")
    values = df.select(*[as_double(df, c).alias(f"v{i}") for i, c in enumerate(columns)], task)
    width = len(columns)

    def scan(batches):
        state, task = None, 0
        for batch in batches:
            if batch.num_rows:
                matrix = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1).astype(float)
                task = batch.column(width)[0].as_py()
                found = batch_state(matrix)
                state = found if state is None else merged(state, found)
        if state is not None:
            for i in range(width):
                yield _state_rows([(i, task % SHARES, task, {f: state[f][i] for f in FIELDS})])

    def meet(batches):
        for at, state in _merged_rows(batches):
            yield _state_rows([(at, 0, 0, state)])

    def meet_shares(batches):
        def runs():
            for batch in batches:
                yield from (batch.slice(i, 1) for i in range(batch.num_rows))

        for (at, share), group in groupby(runs(), key=lambda b: (b.column("at")[0].as_py(), b.column("share")[0].as_py())):
            for _, state in _merged_rows(group):
                yield _state_rows([(at, share, 0, state)])

    first = values.mapInArrow(scan, SCHEMA).repartition("at", "share").sortWithinPartitions("at", "share", "task").mapInArrow(meet_shares, SCHEMA)
    return first.repartition("at").sortWithinPartitions("at", "share").mapInArrow(meet, SCHEMA).drop("share", "task")


def correlation_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(f1, f2, correlation)` of every pair in column order; null without variance or rows, NaN with infinite values."""
    names = list(columns)

    def pairs(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                at = batch.column("at")[row].as_py()
                state = {f: batch.column(f)[row].values.to_numpy()[at + 1 :] for f in FIELDS}
                spread = np.sqrt(state["square"]) * np.sqrt(state["other_square"])
                known = (spread > 0) | (state["infinite"] > 0)
                found = np.where(state["infinite"] > 0, np.nan, state["product"] / np.where(spread > 0, spread, 1.0))
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[at]] * len(found)), pa.array(names[at + 1 :]), pa.array(found, mask=~known, from_pandas=False)], names=["f1", "f2", "correlation"]
                    )

    return co_moments(df, names).mapInArrow(pairs, "f1 string, f2 string, correlation double")
