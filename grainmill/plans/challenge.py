"""Cleaning, scaling, three feature sets against each other, choice and robustness, through tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.columns import with_pair_maxima, with_pair_products
from grainmill.models.evaluate import accuracy
from grainmill.models.feature_stages import apply_min_max, min_max_table
from grainmill.models.search import choose_challenger, robustness, score
from grainmill.operators.clean import drop_z_outliers
from grainmill.operators.sample import split_rows
from grainmill.sources.stages import run_stages, table_stage

PARTS = ("train", "test")


def feature_frames(features: Sequence[str]) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The columns of the model in production, and of its two challengers: pair maxima and pair products."""
    return {"production": lambda df: df, "max": lambda df: with_pair_maxima(df, features), "product": lambda df: with_pair_products(df, features)}


def challenge(
    spark: SparkSession,
    raw: str,
    name: str,
    label: str,
    features: Sequence[str],
    key: Sequence[str],
    build: Callable[[list[str]], Estimator],
    share: Column | None = None,
    rounds: int = 50,
    std: float = 0.1,
) -> dict[str, str]:
    """The names of the tables that the flow writes: `clean`, `scaled`, `results`, `choice`, `robustness`.

    Rows far from the mean are dropped, both parts of the split are scaled with the training values, and
    `build` makes an estimator for a list of feature columns. Production stays unless a challenger is close.
    """
    tables = {t: f"{name}_{t}" for t in ("clean", "scaled", "results", "choice", "robustness")}
    sets = feature_frames(features)

    @table_stage(raw, tables["clean"])
    def clean(frame):
        return {"tables": {tables["clean"]: drop_z_outliers(frame, *features)}}

    @table_stage(tables["clean"], tables["scaled"])
    def scale(frame):
        parts = split_rows(frame, [0.8, 0.2], key, share=share)
        values = min_max_table(parts[0], features)
        marked = [apply_min_max(p, values).withColumn("part", F.lit(n)) for n, p in zip(PARTS, parts)]
        return {"tables": {tables["scaled"]: marked[0].unionAll(marked[1])}}

    @table_stage(tables["scaled"], [tables[t] for t in ("results", "choice", "robustness")])
    def train(frame):
        rows, stable = None, None
        for model, widen in sets.items():
            wide = widen(frame)
            names = [c for c in wide.columns if c not in {label, "part", *key}]
            fitted = build(names).fit(wide.filter(F.col("part") == "train"))
            test = wide.filter(F.col("part") == "test")
            row = accuracy(score(fitted, test), label).select(F.lit(model).alias("model"), "accuracy")
            firm = robustness(fitted, test, names, label, key, rounds, std).withColumn("model", F.lit(model))
            rows = row if rows is None else rows.unionAll(row)
            stable = firm if stable is None else stable.unionAll(firm)
        choice = choose_challenger(rows, "production", "max", "product")
        return {"tables": {tables["results"]: rows, tables["choice"]: choice, tables["robustness"]: stable.join(choice, F.col("model") == F.col("choice")).drop("choice")}}

    run_stages(spark, [clean, scale, train])
    return tables
