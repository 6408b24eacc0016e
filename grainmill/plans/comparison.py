"""Preparation of a raw table and the comparison of models on several feature sets, through tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.columns import as_double, col
from grainmill.models.search import FeatureSet, best_per_model, best_result, searches
from grainmill.operators.sample import split_rows, stratified_split
from grainmill.plans.preparation import prepare
from grainmill.sources.stages import run_stages, table_stage
from grainmill.sources.writers import save_model


def compare_prepared(
    spark: SparkSession,
    raw: str,
    name: str,
    label: str,
    features: Sequence[str],
    key: Sequence[str],
    models: dict[str, Callable[[list[str]], tuple[Estimator, list[dict]]]],
    feature_sets: Sequence[FeatureSet],
    test_share: float = 0.1,
    share: Column | None = None,
    stratify: bool = False,
    model_path: str | None = None,
    folds: int = 5,
    **options,
) -> dict[str, str]:
    """The names of the tables that the flow writes from table `raw`: `prepared`, `pairs`, `reports`, `results`, `best`.

    Gaps of `features` are filled and outliers moved to the bounds, the most correlated pairs are kept beside. Rows
    are split by their key (`share` is the caller's own number in place of its hash; `stratify` gives exact shares
    of every class), and each of `models` is searched on each feature set with the same folds. `reports` holds
    every search's metrics, `results` its accuracy on the test rows, `best` the best feature set of each model and
    which of them wins. The winner is saved at `model_path`. Rows without a label have no part.
    """
    if stratify and share is not None:
        raise ValueError("a stratified split takes its shares from the key")
    tables = {t: f"{name}_{t}" for t in ("prepared", "pairs", "reports", "results", "best")}

    @table_stage(raw, [tables["prepared"], tables["pairs"]])
    def prepared(frame):
        known = frame.filter(col(label).isNotNull()).select(*[col(c) for c in (*key, label)], *[as_double(frame, c).alias(c) for c in features])
        tidy, pairs = prepare(known if share is None else known.withColumn("_share", share), features)
        parts = stratified_split(tidy, label, test_share, key) if stratify else split_rows(tidy, [1 - test_share, test_share], key, share=None if share is None else F.col("_share"))
        marked = [p.drop("_share").withColumn("part", F.lit(n)) for n, p in zip(("train", "test"), parts)]
        return {"tables": {tables["prepared"]: marked[0].unionAll(marked[1]), tables["pairs"]: pairs}}

    @table_stage(tables["prepared"], [tables["reports"], tables["results"], tables["best"]])
    def compared(frame):
        train, test = (frame.filter(F.col("part") == n).drop("part") for n in ("train", "test"))
        found, top = [], None
        for model, feature_set, search in searches(models, feature_sets, train, test, label, key, features, folds, **options):
            reached = search.report.filter("metric = 'accuracy'").first()["value"]
            found.append((model, feature_set, reached, search.report))
            if top is None or (-reached, model, feature_set) < top[0]:  # as in `best_result`
                top = (-reached, model, feature_set), search.model
        results = spark.createDataFrame([f[:3] for f in found], "model string, feature_set string, accuracy double")
        if model_path is not None:
            save_model(top[1], model_path)
        winner = best_result(results).select("model", F.lit(True).alias("wins"))
        best = best_per_model(results).join(F.broadcast(winner), "model", "left").withColumn("wins", F.coalesce("wins", F.lit(False)))  # one row
        return {"tables": {tables["reports"]: reduce(DataFrame.unionAll, [f[3] for f in found]), tables["results"]: results, tables["best"]: best}}

    run_stages(spark, [prepared, compared])
    return tables
