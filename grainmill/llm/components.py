"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.staging import forget, stored


#: A key with more than this many rows and more than this share of all rows is dealt over this many parts.
CROWD, SHARE, PARTS = 64, 256, 64


def join_dealt(rows: DataFrame, side: DataFrame, key: str, total: int) -> DataFrame:
    """`rows.join(side, key)` for a `side` of one row a key, where one key may have most of about `total` rows.

    Rows of a hot key are dealt over `PARTS` parts by a hash of the whole row, and its row of `side` is copied to
    each part. The hot keys are counted with a sum in the map tasks; as each holds more than `1 / SHARE` of the rows,
    fewer than `SHARE` of them come to the driver, whatever the table. Null keys join nothing.
    """
    limit = max(CROWD, total // SHARE)
    hot = [r[0] for r in rows.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > limit) & F.col(key).isNotNull()).select(key).collect()]
    if not hot:
        return rows.join(side, key)
    is_hot, none = F.col(key).isin(hot), F.lit(0).cast("bigint")
    part = F.when(is_hot, F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS))).otherwise(none)
    parts = F.when(is_hot, F.sequence(none, F.lit(PARTS - 1).cast("bigint"))).otherwise(F.array(none))
    dealt, copied = rows.withColumn("part", part), side.withColumn("part", F.explode(parts))
    return dealt.join(copied, [key, "part"]).drop("part")


def _star(pairs: DataFrame, total: int) -> DataFrame:
    """From about `total` rows `(u, v)`: each v hangs below the smallest of u and all its v.

    The minimum is summed up in the map tasks, so a node with very many neighbours costs a row per task there.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return join_dealt(pairs, least, "u", total)


def _large(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of u goes to the smallest neighbour of u: at most a row for each of the `total` edges."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    return _star(both, 2 * total).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame, total: int) -> DataFrame:
    """Every smaller neighbour of u, and u itself, goes to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    starred = _star(down, total)
    moved = starred.select(F.col("v").alias("a"), F.col("m").alias("b")).union(starred.select("u", "m"))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `edges(a, b)`; root is the smallest node that can be reached.

    Alternates the two star steps until no edge changes: O(log² n) rounds whatever the shape, each round
    stored in the shared folder. Edges may repeat and point either way; loops and null ends are left out.
    No edges give no rows.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    total, seen = edges.count(), None
    while True:
        hung = stored(_large(edges, total), "hung")
        turned = stored(_small(hung, total), "edges")
        forget(edges)
        forget(hung)
        edges = turned
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        total = mark[0]
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
