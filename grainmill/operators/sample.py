"""Sampling and splitting by a hash of a row key: the same rows again after a retry or another layout.

The key must identify a row (rows with equal keys go the same way together).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.columns import col
from grainmill.operators.joins import lookup_side
from grainmill.operators.order_statistics import ranked_values
from grainmill.session import checkpoint_folder

HASH_RANGE = 1 << 52  # hash values stay exact as doubles
SLOTS = 1 << 12  # parts of the hash range that are counted: a task sends at most that many rows a class, a cut slot holds that share of a class


def hash_share(key: Sequence[str], seed: int = 42) -> Column:
    """A repeatable number in [0, 1) for each key."""
    return F.pmod(F.xxhash64(*[col(k) for k in key], F.lit(seed)), F.lit(HASH_RANGE)).cast("double") / F.lit(float(HASH_RANGE))


def bernoulli_sample(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42, share: Column | None = None) -> DataFrame:
    """Each row kept with probability `fraction`, by the hash of its key; the size varies.

    `share` is the caller's own number in [0, 1) for each row, in place of the hash.
    """
    return df.filter((hash_share(key, seed) if share is None else share) < F.lit(float(fraction)))


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly `n` rows without replacement (all rows if there are fewer).

    The n-th smallest hash is found by counting, then one filter keeps the rows up to it: no global
    sort and no single task holds the sample.
    """
    share = hash_share(key, seed)
    cut = ranked_values(df, {"share": (share, [n - 1])})["share"].get(n - 1)
    if cut is None:
        return df if n > 0 else df.limit(0)
    below, to_cut = df.agg(F.count_if(share < F.lit(cut)), F.count_if(share <= F.lit(cut))).first()
    if to_cut == n:
        return df.filter(share <= F.lit(cut))
    ties = df.filter(share == F.lit(cut)).orderBy(*[col(c) for c in df.columns]).limit(n - below)
    return df.filter(share < F.lit(cut)).unionAll(ties)


def split_rows(df: DataFrame, weights: Sequence[float], key: Sequence[str], seed: int = 42, share: Column | None = None) -> list[DataFrame]:
    """Disjoint parts with about the given shares; each is a filter over the input.

    `share` is the caller's own number in [0, 1) for each row, in place of the hash of its key.
    """
    total = float(sum(weights))
    edges = [0.0, *[e / total for e in accumulate(weights)]]
    edges[-1] = 1.0
    share = hash_share(key, seed) if share is None else share
    return [df.filter((share >= F.lit(a)) & (share < F.lit(b))) for a, b in zip(edges, edges[1:])]


def stratified_split(df: DataFrame, label: str, test_share: float, key: Sequence[str], seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """`(train, test)` with `round(test_share * n)` test rows of every class."""
    both = marked_rows(df, label, lambda n, _: F.bround(n * F.lit(float(test_share))), key, seed)
    names = [col(c) for c in df.columns]
    return both.filter("NOT _picked").select(*names), both.filter("_picked").select(*names)


def marked_rows(df: DataFrame, label: str, wanted: Callable[[Column, Column], Column], key: Sequence[str], seed: int = 42) -> DataFrame:
    """`df` with `_picked`, true for exactly `wanted(n, largest)` rows of every class, and the class's `_size` and `_largest`.

    `wanted` is an expression of the rows of a class and of the largest class. Each class is cut at the hash with
    the wanted rank. One count over (class, slot of the hash) finds the slots of all cuts, whatever the number of
    classes; a second scan ranks the hashes of a class's own cut slot. The bounds are stored, so the result is one
    more scan without a shuffle. Only where rows share the hash at a bound and not all of them are wanted are
    these rows ranked by their key.
    """
    checkpoint_folder(df.sparkSession)
    share = hash_share(key, seed)
    slot = F.floor(share * SLOTS).cast("int")
    counted = df.groupBy(col(label).alias("_class"), slot.alias("_slot")).agg(F.count("*").alias("_n"))
    sizes = counted.groupBy("_class").agg(F.sum("_n").alias("_size"))
    largest = sizes.agg(F.max("_size").alias("_largest"))  # one row
    upto = Window.partitionBy("_class").orderBy("_slot")
    whole = Window.partitionBy("_class")
    run = counted.withColumns({"_upto": F.sum("_n").over(upto), "_size": F.sum("_n").over(whole)}).crossJoin(F.broadcast(largest))
    run = run.withColumn("_wanted", wanted(F.col("_size"), F.col("_largest")).cast("bigint"))
    # a row for each class: the slot in which its wanted number of rows is reached (its first slot if none is wanted), and how many rows of that slot are among them
    reached = F.when(F.col("_wanted") > 0, (F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted"))).otherwise(F.col("_upto") == F.col("_n"))
    cuts = run.filter(reached).select(
        "_class", F.col("_slot").alias("_cut"), F.greatest(F.col("_wanted") - F.col("_upto") + F.col("_n"), F.lit(0)).alias("_rest"), "_size", "_largest"
    ).checkpoint()
    # a class's bound: all rows below it, and `_take` of the `_tied` rows at it
    of_class = col(label).eqNullSafe(F.col("_class"))
    hashed = df.select(col(label), share.alias("_share"), slot.alias("_slot"))
    at_cut = hashed.join(lookup_side(cuts), of_class & (F.col("_slot") == F.col("_cut")))  # by slot as well, so a hot class is spread
    hashes = at_cut.groupBy("_class", "_share", "_cut", "_rest", "_size", "_largest").agg(F.count("*").alias("_tied"))
    below = F.sum("_tied").over(Window.partitionBy("_class").orderBy("_share")) - F.col("_tied")
    # the first hash is the bound if nothing is wanted of the slot
    at_bound = F.when(F.col("_rest") > 0, (F.col("_below") < F.col("_rest")) & (F.col("_below") + F.col("_tied") >= F.col("_rest"))).otherwise(F.col("_below") == 0)
    bounds = hashes.withColumn("_below", below).filter(at_bound).select(
        "_class", F.col("_share").alias("_bound"), (F.col("_rest") - F.col("_below")).alias("_take"), "_tied", "_size", "_largest"
    ).checkpoint()
    names = [col(c) for c in df.columns]
    placed = df.withColumn("_share", share).join(lookup_side(bounds), of_class)
    picked = (F.col("_share") < F.col("_bound")) | ((F.col("_share") == F.col("_bound")) & (F.col("_take") == F.col("_tied")))
    parted = (F.col("_take") > 0) & (F.col("_take") < F.col("_tied"))
    if bounds.filter(parted).isEmpty():
        return placed.select(*names, picked.alias("_picked"), "_size", "_largest")
    at_tie = parted & (F.col("_share") == F.col("_bound"))
    order = Window.partitionBy("_class").orderBy(*[col(k) for k in key])
    tied = placed.filter(at_tie).withColumn("_picked", F.row_number().over(order) <= F.col("_take"))
    clear = placed.filter(~at_tie).withColumn("_picked", picked)
    return clear.unionByName(tied).select(*names, "_picked", "_size", "_largest")


def with_fold(df: DataFrame, folds: int, key: Sequence[str], seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number 0 … folds-1 for each row."""
    return df.withColumn(out, F.least(F.floor(hash_share(key, seed) * folds), F.lit(folds - 1)).cast("int"))
