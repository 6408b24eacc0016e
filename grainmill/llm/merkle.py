"""Merkle trees over the rows of a table, one for each group and one over their roots, with a proof for each row.

Time-forward processing: a node is labelled by the last leaf below it and its level, every node sends its digest
to its parent, and a priority queue hands messages out in the order of labels. When its time comes, a node's
messages lie at the head of the queue. A second sweep goes through the labels backwards: a node sends each child
what the proof holds above it, headed by the child's siblings, until the proofs arrive at the leaves.

The external part of the queue is a sorted shuffle: leaves are cut into blocks of `fan ** depth` consecutive ones,
a block is worked on by one task with a queue of a few messages for each level, and the digest of its top is the
message to the block above. A table of n rows takes log(n) / log(fan ** depth) rounds, each stored in the shared
folder. A group with most of the rows is as many blocks as its rows need.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.batches import as_batches, by_row
from grainmill.llm.staging import stored

#: Leaves of a block are `fan ** DEPTH`.
DEPTH = 10
HEX = 64


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of a row: of each field `-` if null, else its bytes in UTF-8, `:` and the value."""
    texts = [x.cast("string") for x in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x), F.lit(":"), x), F.lit("-")) for x in texts]), 256)


def height(size: int, fan: int) -> int:
    """Levels above `size` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fan), levels + 1
    return levels


class Tree:
    """The tree over `size` leaves, cut off after `levels` levels, swept in the order of its labels."""

    def __init__(self, size: int, levels: int, fan: int):
        self.last, self.levels, self.fan = size - 1, levels, fan
        self.queue: list[tuple[int, int, int, str]] = []
        self.top: str | None = None

    def label(self, level: int, child: int) -> tuple[int, int]:
        """The label of the node of `level` above a place on the level below it."""
        return min((child // self.fan + 1) * self.fan**level - 1, self.last), level

    def send(self, level: int, place: int, value: str) -> None:
        """The digest at a place of `level` goes to its parent."""
        if level == self.levels:
            self.top = value
        else:
            heapq.heappush(self.queue, (*self.label(level + 1, place), place, value))

    def ready(self, time: int) -> Iterator[tuple[int, int, list[str]]]:
        """Level, place and child digests of each node whose leaves have all been sent up to `time`."""
        queue = self.queue
        while queue and queue[0][0] <= time:
            label, children = queue[0][:2], []
            while queue and queue[0][:2] == label:
                _, level, place, value = heapq.heappop(queue)
                children.append(value)
            yield level, place // self.fan, children
            self.send(level, place // self.fan, digest("".join(children)))

    def add(self, place: int, value: str) -> list[tuple[int, int, list[str]]]:
        """A leaf, and the nodes that are complete with it."""
        self.send(0, place, value)
        return list(self.ready(place))


def suffixes(values: list[str], levels: int, fan: int, above: str) -> Iterator[tuple[int, str]]:
    """Place and proof of every leaf of a block, the last one first; `above` is the proof of its top.

    A proof is one `place:siblings;` for each level, place being where the node itself stands among them.
    """
    tree = Tree(len(values), levels, fan)
    nodes = [node for place, value in enumerate(values) for node in tree.add(place, value)]
    if not levels:
        yield 0, above
        return
    queue = [(-(len(values) - 1), -levels, 0, above)]
    for level, place, children in reversed(nodes):
        _, _, at, suffix = heapq.heappop(queue)
        assert at == place
        for i in range(len(children) - 1, -1, -1):
            own = f"{i}:{''.join(children[:i] + children[i + 1 :])};{suffix}"
            child = place * fan + i
            if level == 1:
                yield child, own
            else:
                end, _ = tree.label(level - 1, child * fan)
                heapq.heappush(queue, (-end, -(level - 1), child, own))


def proof_steps(proof: str) -> list[tuple[int, str]]:
    """Own place and the siblings' digests, level by level."""
    return [(int(place), others) for place, _, others in (step.partition(":") for step in proof.split(";")[:-1])]


def fold(leaf: str, steps: list[tuple[int, str]]) -> str:
    """The root that a leaf leads to."""
    for place, others in steps:
        leaf = digest(others[: HEX * place] + leaf + others[HEX * place :])
    return leaf


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """`df` with `place` (from 0, by `order` within `group`, neither null in `group`) and `size` (rows of the group).

    Ranges over all groups are sorted and written with their running numbers; only the counts of (group, range)
    are summed up over a group. Rows equal in all of `order` are interchangeable and are dealt over ranges.
    """
    salted = df.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)] + [F.col("salt").asc()]
    ranges = salted.repartitionByRange(*keys).sortWithinPartitions(group, *order).drop("salt")
    marked = stored(ranges.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("row")), "ranges")
    counts = marked.groupBy(group, "range").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy(group)).alias("size")
    )
    placed = marked.join(starts, [group, "range"]).withColumn("place", F.col("row") + F.col("shift"))
    return placed.select(*df.columns, "place", "size")


NODE = "tree string, place long, size long, digest string"
TOLD = "tree string, place long, proof string, subroot string, root string"
TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}


def _fields(schema: str) -> dict[str, pa.DataType]:
    return {name: TYPES[kind] for name, kind in (field.split() for field in schema.split(", "))}


def _block(span: int) -> Column:
    return F.expr(f"place div {span}").alias("block")


def _up(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """The tops of all blocks as the nodes of the next round."""
    span = fan**depth

    def sweep(batches):
        def tops():
            tree = None
            for name, block, place, size, value in by_row(batches):
                at = place - block * span
                if at == 0:
                    tree = Tree(min(span, size - block * span), min(depth, height(size, fan)), fan)
                tree.add(at, value)
                if at == tree.last:
                    yield name, block, -(-size // span), tree.top

        return as_batches(tops(), _fields(NODE))

    rows = nodes.select("tree", _block(span), "place", "size", "digest").repartition("tree", "block")
    return rows.sortWithinPartitions("tree", "block", "place").mapInArrow(sweep, NODE)


def _down(nodes: DataFrame, proofs: DataFrame, fan: int, depth: int, finish=None, schema: str = TOLD) -> DataFrame:
    """What the tops of blocks know of the proof, `proofs(tree, place, proof, subroot, root)`, told to all their nodes.

    With `finish`, a row of each node made from (node's `rest`, digest, proof, subroot, root).
    """
    span = fan**depth
    rest = "rest" in nodes.columns
    told = proofs.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("size"), "proof", "subroot", "root")
    told = told.select("*", *([F.lit(None).cast(nodes.schema["rest"].dataType).alias("rest")] if rest else []))
    own = nodes.select(
        "tree", _block(span), "place", "size", F.col("digest").alias("proof"), F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"), *(["rest"] if rest else [])
    )

    def sweep(batches):
        def below():
            for (name, block), rows in groupby(by_row(batches), key=lambda r: r[:2]):
                _, _, _, _, above, subroot, root, *_ = next(rows)
                values, extra = [], []
                for _, _, _, size, value, _, _, *more in rows:
                    values.append(value)
                    extra += more
                for at, proof in suffixes(values, min(depth, height(size, fan)), fan, above):
                    if finish:
                        yield finish(extra[at], values[at], proof, subroot, root)
                    else:
                        yield name, block * span + at, proof, subroot, root

        return as_batches(below(), _fields(schema))

    merged = own.unionByName(told).repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    return merged.mapInArrow(sweep, schema)


def _climb(leaves: DataFrame, fan: int, depth: int) -> list[DataFrame]:
    """The stored nodes of every round; the last ones are the tops of all trees."""
    rounds = [leaves]
    while (rounds[-1].agg(F.max("size")).first()[0] or 0) > 1:
        rounds.append(stored(_up(rounds[-1], fan, depth), "nodes"))
    return rounds


def _descend(rounds: list[DataFrame], proofs: DataFrame, fan: int, depth: int, finish=None, schema: str = TOLD) -> DataFrame:
    for nodes in reversed(rounds[1:-1]):
        proofs = stored(_down(nodes, proofs, fan, depth), "proofs")
    return _down(rounds[0], proofs, fan, depth, finish, schema)


PROVED = "id long, leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string, verified boolean"


def prove(rows: DataFrame, fan: int = 2, depth: int = DEPTH) -> DataFrame:
    """Proofs for `rows(id, tree, leaf, claim)`, digests in lowercase hex: `PROVED`, one row for each row.

    Within a tree, leaves ascend by id (null first, repeated ids by leaf). While a tree has more than one node,
    every `fan` consecutive ones become the digest of their joined digests; the last run may be shorter. What
    remains is the subroot; subroots in the order of `tree` (null first, by bytes) make the root in the same way.
    `proof` holds own place and siblings of each level up to the root, proof_sha256 the digest of the joined
    siblings. folded_root is what `claim` (null: the leaf) leads to with them; verified tells if it is the root.
    A null leaf takes part as an empty text. An empty table gives no rows. Other columns are ignored.
    """
    label = F.coalesce(F.concat(F.lit("="), F.col("tree")), F.lit(""))
    leaves = rows.select(label.alias("tree"), F.col("id").cast("long").alias("id"), F.coalesce("leaf", F.lit("")).alias("digest"), "claim")
    placed = numbered(leaves, "tree", "id", "digest", "claim")
    leaves = stored(placed.select("tree", "place", "size", "digest", F.struct("id", "claim").alias("rest")), "leaves")
    rounds = _climb(leaves, fan, depth)
    subroots = rounds[-1].select("tree", "digest") if len(rounds) > 1 else leaves.select("tree", "digest")

    placed = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "tree", "of")
    heads = stored(placed.select("tree", "place", "size", "digest", F.col("of").alias("rest")), "subroots")
    upper = _climb(heads, fan, depth)
    tops = upper[-1].select("tree", F.lit(0).cast("long").alias("place"), F.lit("").alias("proof"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def head(tree, subroot, proof, _, root):
        return tree, 0, proof, subroot, root

    proofs = stored(_descend(upper, tops, fan, depth, head), "proofs")

    def leaf(rest, own, proof, subroot, root):
        steps = proof_steps(proof)
        claim = rest["claim"]
        folded = fold(own if claim is None else claim, steps)
        return rest["id"], own, subroot, root, proof, digest("".join(others for _, others in steps)), folded, folded == root

    return _descend(rounds, proofs, fan, depth, leaf, PROVED)
