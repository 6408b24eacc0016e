"""Synthetic minority oversampling: new rows on the segments between a row and its near neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import col
from grainmill.models.neighbours import nearest_distinct
from grainmill.operators.sample import HASH_RANGE, marked_rows
from grainmill.session import checkpoint_folder

ROWS_PER_TASK_STEP = 10_000


def smote(df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """`(features…, label, synthetic)`: every class brought up to the size of the largest, all by one plan.

    Each row of a smaller class is used equally often as a base, the remainder by hash of its key.
    A synthetic row is `x + u (y - x)` with `y` one of the k nearest rows of the class that its
    leaves of random trees hold (all of the class up to a thousand rows) and `u` uniform.
    """
    sizes = df.groupBy(col(label).alias("value")).agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    short = sizes.filter((F.col("n") <= k) & (F.col("n") < F.lit(largest))).first()
    if short is not None:
        raise ValueError(f"class {short['value']!r} has {short['n']} rows, {k} neighbours need more")
    result = df.select(*[col(c) for c in features], col(label), F.lit(False).alias("synthetic"))
    lacking = lambda n, most: most - n
    marked = marked_rows(df, label, lambda n, most: lacking(n, most) % n, key, seed).filter("_size < _largest")
    draws = F.floor(lacking(F.col("_size"), F.col("_largest")) / F.col("_size")).cast("bigint") + F.col("_picked").cast("bigint")
    vec = F.array(*[col(c).cast("double") for c in features])
    # equal vectors of a class become one row with its copies and the number of new rows it is the base of
    rows = marked.select(F.to_json(F.struct(col(label).alias("v"))).alias("kind"), col(label).alias("value"), vec.alias("vec"), draws.alias("draw"))
    vectors = rows.groupBy("kind", "vec").agg(F.any_value("value").alias("value"), F.count("*").alias("copies"), F.sum("draw").alias("draws"))
    new = _synthetic(vectors, k, seed)
    back = [F.get("point", F.lit(i)).cast(df.schema[c].dataType if _floating(df, c) else "double").alias(c) for i, c in enumerate(features)]
    return result.unionAll(new.select(*back, F.col("value").alias(label), F.lit(True)))


def _floating(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.simpleString() in ("double", "float")


def _synthetic(vectors: DataFrame, k: int, seed: int) -> DataFrame:
    """`(value, point)`: the new rows of `vectors(kind, vec, value, copies, draws)`."""
    checkpoint_folder(vectors.sparkSession)
    vectors = vectors.checkpoint()  # read several times below
    near = nearest_distinct(vectors.select("kind", "vec", "copies"), k)
    neighbours = F.slice(
        F.concat(
            F.array_repeat("vec", F.least(F.col("copies") - 1, F.lit(k)).cast("int")),
            F.flatten(F.transform(F.coalesce("near", F.array()), lambda x: F.array_repeat(x["vec"], F.least(x["copies"], F.lit(k)).cast("int")))),
        ),
        1,
        k,
    )
    bases = vectors.filter("draws > 0").join(near, ["kind", "vec"], "left").select("value", "vec", "draws", neighbours.alias("neighbours"))
    # a base with very many new rows is first cut into steps that can go to different tasks
    steps = bases.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("draws") - 1) / ROWS_PER_TASK_STEP))).alias("step")
    ).repartition("value", "vec", "step")
    last = F.least((F.col("step") + 1) * ROWS_PER_TASK_STEP, F.col("draws")) - 1
    each_new = steps.select("value", "vec", "neighbours", F.explode(F.sequence(F.col("step") * ROWS_PER_TASK_STEP, last)).alias("no"))
    pick = F.pmod(F.xxhash64("vec", "no", F.lit(seed)), F.size("neighbours")).cast("int")
    u = F.pmod(F.xxhash64("vec", "no", F.lit(seed + 1)), F.lit(HASH_RANGE)).cast("double") / F.lit(float(HASH_RANGE))
    chosen = each_new.select("value", "vec", F.get("neighbours", pick).alias("other"), u.alias("u"))
    return chosen.select("value", F.zip_with("vec", "other", lambda x, y: x + F.col("u") * (y - x)).alias("point"))
