"""Approximate nearest neighbours by inner product: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node. Nodes are numbered along a random projection and cut into blocks of consecutive ones; a
block's edges are one packed row. Leaves of random trees give every node first neighbours. Then, round after round,
edges meet the nodes that they lead to, and among all that are neighbours of one node (or have it as theirs) the new
ones are compared with each other and with the old ones; every node keeps the best it has seen. A vector goes once to
each block that compares it, not to each neighbour, and only pairs that better an end leave the task.

A query starts at its node and follows the graph: the best nodes seen so far are asked for their neighbours until all
of them have been asked. Neighbours come back to the query's block, which asks once for a node, and its vector goes
once to each block that has a node it wants, however many nodes led there. Messages between blocks are packed rows
joined by block; a task holds the messages of one.

Products are in double precision of the components as they are stored, so near copies stay apart wherever their
vectors do. The last bits of such products depend on the order of the sums: all of a pool that can be among the best
by these bits is ranked again by sums in one order.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.merkle import numbered
from grainmill.llm.staging import forget, stored

#: Nodes that are compared all with all at the start, and vectors that a task cuts into such leaves.
LEAF, LEAVES = 1024, 16_384
#: Nodes whose edges are one row.
BLOCK = 8192
#: New edges of a node, and new edges to it, that take part in a round; the others wait.
SAMPLE = 16
#: Random trees that give the first neighbours.
TREES = 4
#: The graph is done when a round changes no more than this share of its edges.
SETTLED = 0.02
#: Pairs that are held before they are cut to the best of each node.
HELD = 2_000_000
#: Pairs of a query and a node it wants that are dealt to the nodes' blocks together.
WANTED = 500_000


def distinct_vectors(df: DataFrame, copies: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`(node, v, copies)`: distinct vectors, named by their smallest id, with their `copies` smallest ids.

    Rows with a null id, and vectors that are null, zero, or hold null or non-finite components, take no part;
    of repeated ids the least vector counts.
    """
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists(vector_col, lambda x: x != 0)
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite & some)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= copies)
    return ranked.groupBy("v").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("copies"))


def _floats(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


@dataclass(frozen=True)
class Shape:
    """Components of a vector and their type, nodes of a block, and edges of a node."""

    width: int
    kind: str
    block: int
    k: int

    def vectors(self, cells: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(cells), self.kind).reshape(-1, self.width)


def _nodes(exact: DataFrame, shape: Shape, trees: int) -> DataFrame:
    """`(place, node, norm, vec, cut)`: nodes numbered from 0, their lengths, all components, and projections to cut the space by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto = np.random.default_rng(11).standard_normal((shape.width, trees))
        for batch in batches:
            v = _floats(batch.column(1), shape.width)
            cells = pa.array([c.tobytes() for c in v.astype(shape.kind)], pa.binary())
            cuts = pa.array(list(v @ onto), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.linalg.norm(v, axis=1)), cells, cuts], names=["node", "norm", "vec", "cut"])

    coded = exact.select("node", "v").mapInArrow(run, "node long, norm double, vec binary, cut array<double>")
    placed = numbered(coded.withColumns({"all": F.lit(0), "first": F.get("cut", F.lit(0))}), "all", "first", "node")
    return placed.select("place", "node", "norm", "vec", "cut")


# --- packed rows --------------------------------------------------------------------------------

#: Columns of messages between blocks; what a column holds depends on the message.
MESSAGE = "block long, kind int, a binary, b binary, x binary, vec binary"
NAMES = ["block", "kind", "a", "b", "x", "vec"]


def _message(block: int, kind: int, a, b=None, x=None, vec: bytes | None = None) -> tuple:
    return (
        int(block), kind, np.asarray(a, "<i8").tobytes(), None if b is None else np.asarray(b, "<i8").tobytes(),
        None if x is None else np.asarray(x, "<f8").tobytes(), vec,
    )


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=NAMES)


def _read(table: pa.Table, kind: int | None = None):
    """`a`, `b`, `x` of all messages of a kind one after the other, and their `vec` cells."""
    found = {n: [] for n in ("a", "b", "x", "vec")}
    kinds = table.column("kind").to_pylist()
    for name in found:
        found[name] = [c for c, of in zip(table.column(name).to_pylist(), kinds) if (kind is None or of == kind) and c is not None]
    return (
        np.frombuffer(b"".join(found["a"]), "<i8"), np.frombuffer(b"".join(found["b"]), "<i8"), np.frombuffer(b"".join(found["x"]), "<f8"), found["vec"],
    )


def _by_block(block: int, to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of nodes, and the places in `to` that lie in each."""
    owner = to // block
    order = np.argsort(owner, kind="stable")
    owners, starts = np.unique(owner[order], return_index=True)
    for of, part in zip(owners.tolist(), np.split(order, starts[1:])):
        yield of, part


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each row in its run of equal keys."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))


def _top(a, b, score, k: int, *others):
    """The `k` best distinct b of each a, of equal pairs the first; sorted by a, falling score and b."""
    order = np.lexsort((b, a))
    once = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))[: len(a)]
    kept = order[once]
    kept = kept[np.lexsort((b[kept], -score[kept], a[kept]))]
    kept = kept[_ranks(a[kept]) < k]
    return tuple(x[kept] for x in (a, b, score, *others))


# --- the graph ----------------------------------------------------------------------------------

#: A block's edges a -> b, sorted by a, falling score and b; whether each is new; how many were changed last, and how many there are.
GRAPH = "block long, a binary, b binary, score binary, fresh binary, changed long, edges long"


def _edges(row: dict):
    return np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "<i8"), np.frombuffer(row["score"], "<f8"), np.frombuffer(row["fresh"], "?")


def _picked(a: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The best new edges of each node, which take part in the coming round."""
    at = np.flatnonzero(fresh)
    out = np.zeros(len(a), bool)
    out[at[_ranks(a[at]) < SAMPLE]] = True
    return out


def _graph_row(block: int, a, b, score, fresh, changed: int) -> pa.Table:
    cells = [np.asarray(x, t).tobytes() for x, t in ((a, "<i8"), (b, "<i8"), (score, "<f8"), (fresh, "?"))]
    kinds = [pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array([x], t) for x, t in zip((block, *cells, changed, len(a)), kinds)], names=["block", "a", "b", "score", "fresh", "changed", "edges"])


def _merge(shape: Shape):
    """A block's edges and the better ones found for its nodes to its new edges."""

    def run(key, old, found):
        block = key[0].as_py()
        a, b, score, _ = _read(found)
        fresh = np.ones(len(a), bool)
        if old.num_rows:
            a0, b0, score0, fresh0 = _edges(old.to_pylist()[0])
            fresh0 = fresh0 & ~_picked(a0, fresh0)
            a, b, score, fresh = (np.concatenate(x) for x in ((a0, a), (b0, b), (score0, score), (fresh0, fresh)))
            added = np.concatenate((np.zeros(len(a0), bool), np.ones(len(a) - len(a0), bool)))
        else:
            added = fresh.copy()
        a, b, score, fresh, added = _top(a, b, score, shape.k, fresh, added)
        return _graph_row(block, a, b, score, fresh, int(added.sum()))

    return run


def _first_neighbours(nodes: DataFrame, shape: Shape, n: int, trees: int) -> DataFrame:
    """Messages with the neighbours within the leaves of random trees: ranges of each tree's own projection to the tasks, cut further there.

    All trees share one shuffle.
    """

    def grow(batches):
        held, size, rows = [], 0, []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
        if held:
            whole = pa.Table.from_batches(held).combine_chunks()
            tree, place = whole.column("tree").to_numpy(), whole.column("place").to_numpy()
            v = shape.vectors(whole.column("vec").to_pylist())
            for t in np.unique(tree):
                rng, todo = np.random.default_rng(t), [np.flatnonzero(tree == t)]
                while todo:
                    part = todo.pop()
                    own = v[part].astype(np.float64)
                    if len(part) > LEAF:
                        order = part[np.argsort(own @ rng.standard_normal(shape.width), kind="stable")]
                        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
                        continue
                    near = own @ own.T
                    np.fill_diagonal(near, -np.inf)
                    m = min(shape.k, len(part) - 1)
                    if not m:
                        continue
                    top = np.argpartition(-near, m - 1, axis=1)[:, :m]
                    a, b, score = np.repeat(place[part], m), place[part][top].ravel(), np.take_along_axis(near, top, 1).ravel()
                    rows += [_message(of, 0, a[at], b[at], score[at]) for of, at in _by_block(shape.block, a)]
                    size += len(a)
                    if size > HELD:
                        yield from _table(rows).to_batches()
                        size, rows = 0, []
        if rows:
            yield from _table(rows).to_batches()

    planted = nodes.select(F.posexplode(F.slice("cut", 1, trees)).alias("tree", "at"), "place", "vec")
    ranged = planted.repartitionByRange(max(1, trees * n // LEAVES), "tree", "at", "place").sortWithinPartitions("tree", "place")
    return ranged.select("tree", "place", "vec").mapInArrow(grow, MESSAGE)


#: Kinds of messages of a round: a neighbourhood's members, vectors of members.
MEMBERS, VECTORS = 1, 2


def _backward(shape: Shape, reverse: int):
    """A block's edges to the blocks that they lead to: the best to each node, new and old apart; `x` tells new ones (1) from old (0).

    The best edge to a node is always among them, so the node's block knows of every block that needs its vector.
    """

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b, score, fresh = _edges(row)
                new = _picked(a, fresh)
                used = np.flatnonzero(new | ~fresh)
                order = used[np.lexsort((a[used], -score[used], new[used], b[used]))]
                rank = _ranks(b[order] * 2 + new[order])
                order = order[rank < np.where(new[order], SAMPLE, reverse)]
                rows = []
                for of, part in _by_block(shape.block, b[order]):
                    rows.append(_message(of, MEMBERS, a[order][part], b[order][part], new[order][part], score[order][part].astype("<f8").tobytes()))
                yield from _table(rows).to_batches()

    return run


def _around(shape: Shape, reverse: int):
    """A block's edges and vectors, and the edges that lead to it, to neighbourhoods for itself and vectors for all blocks that compare them."""

    def run(key, own, back):
        block = key[0].as_py()
        if not own.num_rows:
            return _table([])
        row = own.to_pylist()[0]
        a, b, score, fresh = _edges(row)
        start, vectors = block * shape.block, np.frombuffer(row["vecs"], shape.kind).reshape(-1, shape.width)
        new = _picked(a, fresh)
        used = new | ~fresh
        from_, to, flag, cells = _read(back, MEMBERS)
        back_score = np.frombuffer(b"".join(cells), "<f8")
        # the best of all blocks that lead to a node
        near = np.lexsort((from_, -back_score, flag, to))
        near = near[_ranks(to[near] * 2 + flag[near].astype(np.int64)) < np.where(flag[near] == 1, SAMPLE, reverse)]
        v = np.concatenate((a[used], to[near], np.unique(a)))
        u = np.concatenate((b[used], from_[near], np.unique(a)))
        is_new = np.concatenate((new[used], flag[near] == 1, np.zeros(len(v) - int(used.sum()) - len(near), bool)))
        order = np.lexsort((~is_new, u, v))
        order = order[np.append(True, (v[order][1:] != v[order][:-1]) | (u[order][1:] != u[order][:-1]))[: len(order)]]
        v, u, is_new = v[order], u[order], is_new[order]
        alive = np.zeros(shape.block, bool)
        alive[v[is_new] - start] = True
        some = alive[v - start]
        rows = [_message(block, MEMBERS, v[some], u[some], is_new[some])] if some.any() else []
        # a node's vector goes to the blocks of its neighbours, of those that lead to it, and to its own
        mine = np.concatenate((a[used], to, np.unique(v[some])))
        towards = np.concatenate((b[used], from_, np.unique(v[some]))) // shape.block
        pairs = np.unique(np.stack((towards, mine)), axis=1) if len(mine) else np.zeros((2, 0), np.int64)
        floor = np.full(shape.block, -np.inf)
        full = np.flatnonzero(_ranks(a) == shape.k - 1)
        floor[a[full] - start] = score[full]
        for of in np.unique(pairs[0]).tolist():
            ids = pairs[1, pairs[0] == of]
            rows.append(_message(of, VECTORS, ids, None, floor[ids - start], vectors[ids - start].tobytes()))
        return _table(rows)

    return run


def _compare(shape: Shape):
    """The neighbourhoods and vectors of a block to pairs that are better than what an end has."""

    def run(key, table):
        v, u, is_new, _ = _read(table.filter(pyarrow.compute.equal(table.column("kind"), MEMBERS)))
        if not len(v):
            return _table([])
        ids, _, floors, cells = _read(table, VECTORS)
        x = np.frombuffer(b"".join(cells), shape.kind).reshape(-1, shape.width)
        order = np.argsort(ids)
        ids, floors = ids[order], floors[order]
        at = np.searchsorted(ids, u)
        is_new = is_new > 0
        starts = np.append(np.flatnonzero(_ranks(v) == 0), len(v)).tolist()
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        held, size = [], 0
        for s, e in zip(starts[:-1], starts[1:]):
            members, fresh = at[s:e], np.flatnonzero(is_new[s:e])
            own = x[order[members]].astype(np.float64)
            near = own[fresh] @ own.T
            near[np.arange(len(fresh)), fresh] = -np.inf
            limit = floors[members]
            i, j = np.nonzero(near > limit[fresh][:, None])
            back_i, back_j = np.nonzero((near > limit[None]) & ~is_new[s:e][None])
            held.append((members[fresh[i]], members[j], near[i, j]))
            held.append((members[back_j], members[fresh[back_i]], near[back_i, back_j]))
            size += len(i) + len(back_i)
            if size > HELD:
                best = _top(*(np.concatenate(c) for c in zip(best, *held)), shape.k)
                held, size = [], 0
        a, b, score = _top(*(np.concatenate(c) for c in zip(best, *held)), shape.k)
        a, b = ids[a], ids[b]
        return _table([_message(of, 0, a[part], b[part], score[part]) for of, part in _by_block(shape.block, a)])

    return run


def _blocks(nodes: DataFrame, shape: Shape) -> DataFrame:
    """`(block, vecs)`: the vectors of each block in the order of its nodes."""
    cut = nodes.select(F.expr(f"place div {shape.block}").alias("block"), "place", "vec")

    def run(key, table):
        order = np.argsort(table.column("place").to_numpy())
        cells = table.column("vec").to_pylist()
        return pa.Table.from_arrays([pa.array([key[0].as_py()]), pa.array([b"".join(cells[i] for i in order)], pa.binary())], names=["block", "vecs"])

    return cut.groupBy("block").applyInArrow(run, "block long, vecs binary")


def neighbour_graph(nodes: DataFrame, blocks: DataFrame, shape: Shape, reverse: int = 24, trees: int = 4, rounds: int = 50) -> DataFrame:
    """`GRAPH`: up to `shape.k` neighbours of each node, by NN-descent over `nodes(place, vec, cut)` and their `blocks(block, vecs)`.

    Rounds go on until one changes no more than `SETTLED` of all edges; `rounds` only keeps them from going on for ever.
    """
    none = nodes.sparkSession.createDataFrame([], GRAPH)

    def merged(old: DataFrame, better: DataFrame) -> DataFrame:
        return stored(old.groupBy("block").cogroup(better.groupBy("block")).applyInArrow(_merge(shape), GRAPH), "graph")

    graph = merged(none, _first_neighbours(nodes, shape, nodes.count(), trees))
    for _ in range(rounds):
        back = graph.mapInArrow(_backward(shape, reverse), MESSAGE)
        around = graph.join(blocks, "block").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_around(shape, reverse), MESSAGE)
        better = around.groupBy("block").applyInArrow(_compare(shape), MESSAGE)
        turned = merged(graph, better)
        forget(graph)
        graph = turned
        share = graph.agg(F.sum("changed") / F.greatest(F.sum("edges"), F.lit(1))).first()[0] or 0.0
        if share <= SETTLED:
            return graph
    warnings.warn(f"the neighbour graph still changed {share:.4f} of its edges in the last of {rounds} rounds", stacklevel=2)
    return graph


# --- the search ---------------------------------------------------------------------------------

#: A block's queries a with their pools, sorted by a, falling score and b; which entries were asked, and which wait to be.
STATE = "block long, a binary, b binary, score binary, asked binary, waiting long"


def _links(graph: DataFrame, shape: Shape, reverse: int) -> DataFrame:
    """`(block, a, b)`: the neighbours of each node of a block, and the `reverse` best of those it is a neighbour of."""

    def backward(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b, score, _ = _edges(row)
                order = np.lexsort((a, -score, b))
                order = order[_ranks(b[order]) < reverse]
                yield from _table([_message(of, 0, b[order][p], a[order][p], score[order][p]) for of, p in _by_block(shape.block, b[order])]).to_batches()

    def run(key, own, back):
        a, b, score, _ = _read(back)
        a, b, _ = _top(a, b, score, reverse)
        if own.num_rows:
            a0, b0, *_ = _edges(own.to_pylist()[0])
            a, b = np.concatenate((a0, a)), np.concatenate((b0, b))
        order = np.lexsort((b, a))
        order = order[np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))[: len(order)]]
        return pa.Table.from_arrays([pa.array([key[0].as_py()]), pa.array([a[order].tobytes()], pa.binary()), pa.array([b[order].tobytes()], pa.binary())], names=["block", "a", "b"])

    back = graph.mapInArrow(backward, MESSAGE)
    return graph.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, "block long, a binary, b binary")


def _state_row(block, a, b, score, asked) -> pa.Table:
    cells = [pa.array([np.asarray(x, t).tobytes()], pa.binary()) for x, t in ((a, "<i8"), (b, "<i8"), (score, "<f8"), (asked, "?"))]
    return pa.Table.from_arrays([pa.array([block]), *cells, pa.array([int((~asked).sum())])], names=["block", "a", "b", "score", "asked", "waiting"])


def _asking(shape: Shape, step: int):
    """The best nodes of a block's queries that were not asked, to the nodes' blocks: each once, and the block that asks."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b, asked = np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "<i8"), np.frombuffer(row["asked"], "?")
                nodes = np.unique(b[_next(a, asked, step)])
                yield from _table([_message(of, MEMBERS, nodes[part], [row["block"]]) for of, part in _by_block(shape.block, nodes)]).to_batches()

    return run


def _next(a: np.ndarray, asked: np.ndarray, step: int) -> np.ndarray:
    """Places of the entries that are asked next."""
    at = np.flatnonzero(~asked)
    return at[_ranks(a[at]) < step]


def _spans(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places `first`, `first + 1`, ... of each run, one run after the other."""
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _answering(key, links, asked):
    """A block's nodes that were asked to the block that asks: nodes, how many neighbours each has, and these."""
    if not asked.num_rows or not links.num_rows:
        return _table([])
    row = links.to_pylist()[0]
    a, b = np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "<i8")
    rows = []
    for cells in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist()):
        nodes, to = (np.frombuffer(c, "<i8") for c in cells)
        first = np.searchsorted(a, nodes, "left")
        counts = np.searchsorted(a, nodes, "right") - first
        rows.append(_message(to[0], MEMBERS, np.concatenate((nodes, counts)), b[_spans(first, counts)]))
    return _table(rows)


def _wanting(shape: Shape, pool: int, step: int):
    """A block's queries and the neighbours of the nodes they asked to the blocks of those that are not in the pool yet.

    A query goes once to such a block, with its vector and its floor. `a` holds queries and how many nodes each wants,
    `b` these nodes by their places in the block, in four bytes.
    """

    def run(key, own, answers):
        if not own.num_rows or not answers.num_rows:
            return _table([])
        row = own.to_pylist()[0]
        a, b = np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "<i8")
        score, asked = np.frombuffer(row["score"], "<f8"), np.frombuffer(row["asked"], "?")
        start, vectors = row["block"] * shape.block, np.frombuffer(row["vecs"], shape.kind).reshape(-1, shape.width)
        nodes, counts = (np.concatenate(x) for x in zip(*[np.split(np.frombuffer(c, "<i8"), 2) for c in answers.column("a").to_pylist()]))
        near = np.frombuffer(b"".join(answers.column("b").to_pylist()), "<i8")
        order = np.argsort(nodes)
        nodes, counts, first = nodes[order], counts[order], (np.cumsum(counts) - counts)[order]
        starts = np.flatnonzero(_ranks(a) == 0)
        ends = np.append(starts[1:], len(a))
        next_ = np.zeros(len(a), bool)
        next_[_next(a, asked, step)] = True
        held, size, rows = [], 0, []

        def tell():
            query, wanted = (np.concatenate(x) for x in zip(*held))
            for of, part in _by_block(shape.block, wanted):
                queries, many = np.unique(query[part], return_counts=True)
                at = np.searchsorted(a[starts], queries)
                floors = np.where(ends[at] - starts[at] >= pool, score[ends[at] - 1], -np.inf)
                places = (wanted[part] - of * shape.block).astype("<i4").tobytes()
                message = _message(of, VECTORS, np.concatenate((queries, many)), None, floors, vectors[queries - start].tobytes())
                rows.append((*message[:3], places, *message[4:]))

        for s, e in zip(starts.tolist(), ends.tolist()):
            mine = b[s:e][next_[s:e]]
            at = np.searchsorted(nodes, mine)
            at = at[nodes[np.minimum(at, len(nodes) - 1)] == mine]
            found = np.unique(near[_spans(first[at], counts[at])])
            if not len(found):
                continue
            known = np.minimum(np.searchsorted(found, b[s:e]), len(found) - 1)
            new = np.ones(len(found), bool)
            new[known[found[known] == b[s:e]]] = False
            held.append((np.full(int(new.sum()), a[s]), found[new]))
            size += len(held[-1][1])
            if size > WANTED:
                tell()
                held, size = [], 0
        if held:
            tell()
        return _table(rows)

    return run


def _scoring(shape: Shape):
    """Queries that want a block's nodes to the products that beat their floors, for the queries' blocks."""

    def run(key, blocks, wanted):
        if not wanted.num_rows or not blocks.num_rows:
            return _table([])
        own = np.frombuffer(blocks.column("vecs")[0].as_py(), shape.kind).reshape(-1, shape.width).astype(np.float64)
        start, rows = key[0].as_py() * shape.block, []
        for batch in wanted.to_batches(max_chunksize=1):
            cells = {c: batch.column(c)[0].as_py() for c in ("a", "b", "x", "vec")}
            queries, counts = np.split(np.frombuffer(cells["a"], "<i8"), 2)
            places, floors = np.frombuffer(cells["b"], "<i4"), np.frombuffer(cells["x"], "<f8")
            vectors = shape.vectors([cells["vec"]]).astype(np.float64)
            score = np.concatenate([own[part] @ v for part, v in zip(np.split(places, np.cumsum(counts)[:-1]), vectors)])
            good = score > np.repeat(floors, counts)
            if good.any():
                rows.append(_message(queries[0] // shape.block, 0, np.repeat(queries, counts)[good], places[good] + start, score[good]))
        return _table(rows)

    return run


def _pooled(pool: int, step: int):
    """A block's pools and the products found to its new pools."""

    def run(key, old, found):
        row = old.to_pylist()[0]
        a, b = np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "<i8")
        score, asked = np.frombuffer(row["score"], "<f8"), np.frombuffer(row["asked"], "?").copy()
        asked[_next(a, asked, step)] = True
        best, held, size = (a, b, score, asked), [], 0
        for batch in found.to_batches(max_chunksize=1):
            new = [np.frombuffer(batch.column(c)[0].as_py(), t) for c, t in (("a", "<i8"), ("b", "<i8"), ("x", "<f8"))]
            held.append((*new, np.zeros(len(new[0]), bool)))
            size += len(new[0])
            if size > HELD:
                a, b, score, asked = (np.concatenate(x) for x in zip(best, *held))
                best, held, size = _top(a, b, score, pool, asked), [], 0
        a, b, score, asked = (np.concatenate(x) for x in zip(best, *held))
        return _state_row(key[0].as_py(), *_top(a, b, score, pool, asked))

    return run


def search(graph: DataFrame, blocks: DataFrame, queries: DataFrame, shape: Shape, pool: int = 256, step: int = 256, reverse: int = 24) -> DataFrame:
    """`(a, b, score)`: for each node a of `queries(place)` up to `pool` nodes b found along the graph, a itself among them."""
    links = stored(_links(graph, shape, reverse), "links")

    def begin(key, table):
        a = np.unique(table.column("place").to_numpy())
        # a node's product with itself is the first entry of its pool
        return _state_row(key[0].as_py(), a, a, np.full(len(a), np.inf), np.zeros(len(a), bool))

    cut = queries.select(F.expr(f"place div {shape.block}").alias("block"), "place")
    state = stored(cut.groupBy("block").applyInArrow(begin, STATE), "pool")
    while (state.agg(F.sum("waiting")).first()[0] or 0) > 0:
        asked = state.mapInArrow(_asking(shape, step), MESSAGE)
        answers = links.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_answering, MESSAGE)
        wanted = state.join(blocks, "block").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_wanting(shape, pool, step), MESSAGE)
        hits = blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(_scoring(shape), MESSAGE)
        turned = stored(state.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(_pooled(pool, step), STATE), "pool")
        forget(state)
        state = turned

    def rows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cells = [np.frombuffer(row[c], t) for c, t in (("a", "<i8"), ("b", "<i8"), ("score", "<f8"))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["a", "b", "score"])

    return state.mapInArrow(rows, "a long, b long, score double")


def nearest(
    df: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", neighbours: int = 32, rounds: int = 50, pool: int = 256,
    block: int = BLOCK,
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each row with `is_query` (over `id`) the `k` largest inner products found among all others.

    Nearest first, equal products to the smaller id; all others, if they are fewer than `k`. Products are those
    of the original vectors in double precision; shorter vectors count as filled up with zeros. Null, zero and
    non-finite vectors, and null ids, take no part; of repeated ids the least vector counts. Copies of a vector
    are one node of the graph; each then stands for its `k + 1` smallest ids, as no query can have more.
    """
    exact = stored(distinct_vectors(df, k + 1, id_col, vector_col), "exact")
    width = max(1, exact.agg(F.max(F.size("v")).alias("w")).first()["w"] or 1)
    shape = Shape(width, "<f4" if exact.schema["v"].dataType.elementType.typeName() == "float" else "<f8", block, neighbours)
    nodes = stored(_nodes(exact, shape, TREES), "nodes")
    blocks = stored(_blocks(nodes, shape), "blocks")
    graph = neighbour_graph(nodes, blocks, shape, trees=TREES, rounds=rounds)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    own = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    own = own.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    own = stored(own.join(exact.select("v", "node"), "v").select("id", "node"), "own")
    places = nodes.select("place", "node")
    pools = search(graph, blocks, places.join(own.select("node").distinct(), "node"), shape, pool)
    found = pools.join(places.select(F.col("place").alias("a"), F.col("node").alias("of")), "a").join(places.select(F.col("place").alias("b"), "node"), "b")
    found = found.select(F.col("of").alias("a"), F.col("node").alias("b"), "score")

    # Two sums of the same terms differ by less than `off`: all of the pool that may be among the k + 1 best are ranked.
    longest = nodes.agg(F.max("norm").alias("n")).first()["n"] or 0.0
    off = F.lit(min(4 * width * float(np.finfo(float).eps) * longest * longest, 1e308))
    placed = found.withColumn("n", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "b")))
    least = F.max(F.when(F.col("n") == k + 1, F.col("score"))).over(Window.partitionBy("a"))
    close = placed.withColumn("least", least - 2 * off).where(F.col("least").isNull() | (F.col("score") >= F.col("least"))).select("a", "b")
    left = exact.select(F.col("node").alias("a"), F.col("v").alias("x"))
    right = exact.select(F.col("node").alias("b"), F.col("v").alias("y"), "copies")
    terms = F.zip_with("x", "y", lambda p, q: F.coalesce(p.cast("double") * q.cast("double"), F.lit(0.0)))
    scored = close.join(left, "a").join(right, "b").select("a", F.aggregate(terms, F.lit(0.0), lambda s, t: s + t).alias("score"), "copies")
    members = scored.select("a", "score", F.explode("copies").alias("vec_id"))
    top = Window.partitionBy("a").orderBy(F.desc("score"), "vec_id")
    lists = members.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1)
    lists = lists.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))  # k + 1 entries
    mine = own.join(lists, own["node"] == lists["a"]).select("id", F.slice(F.filter("near", lambda r: r["vec_id"] != F.col("id")), 1, k).alias("near"))
    return mine.select(F.col("id").alias("query_id"), F.posexplode("near").alias("place", "r")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), "r.vec_id", "r.score"
    )
