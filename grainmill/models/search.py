"""Grid search over pipelines, model comparison and choice, robustness to noise."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool
from statistics import NormalDist

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import add_columns, as_double, col, present
from grainmill.models.evaluate import confusion, metrics_report
from grainmill.operators.rows import top_rows
from grainmill.operators.sample import HASH_RANGE, with_fold
from grainmill.session import checkpoint_folder


DEALT_FROM = 100_000  # training rows from which they are dealt evenly over the cores
PART_ROWS = 1_000_000  # most of them in one part, so that what a fit keeps of a part stays small


def logistic_regression(label: str, features: str = "features", weight: str | None = None, max_iter: int = 10_000, **params) -> LogisticRegression:
    model = LogisticRegression(labelCol=label, featuresCol=features, maxIter=max_iter, **params)
    return model.setWeightCol(weight) if weight else model


def random_forest(label: str, features: str = "features", seed: int = 42, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **params)


def decision_tree(label: str, features: str = "features", seed: int = 42, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed, **params)


def boosted_trees(label: str, features: str = "features", seed: int = 42, checkpoint_every: int = 10, **params) -> GBTClassifier:
    """Boosted trees for two classes; the lineage is cut every few rounds in the checkpoint folder."""
    return GBTClassifier(labelCol=label, featuresCol=features, seed=seed, checkpointInterval=checkpoint_every, **params)


def grid(**choices: tuple[object, Sequence]) -> list[dict]:
    """Parameter grid from `name=(param, values)`."""
    builder = ParamGridBuilder()
    for param, values in choices.values():
        builder = builder.addGrid(param, list(values))
    return builder.build()


@dataclass
class Search:
    """A finished search: the best model, every grid point's mean score and the best point's parameters."""

    model: Model
    scores: list[float]
    points: list[dict[str, object]]
    larger_is_better: bool = True
    predictions: DataFrame | None = None
    counts: DataFrame | None = None
    report: DataFrame | None = None

    @property
    def best(self) -> int:
        pick = max if self.larger_is_better else min
        return self.scores.index(pick(self.scores))

    @property
    def best_score(self) -> float:
        return self.scores[self.best]

    @property
    def best_params(self) -> dict[str, object]:
        return self.points[self.best]


def k_fold_search(
    estimator: Estimator,
    points: list[dict],
    train: DataFrame,
    label: str,
    key: Sequence[str],
    folds: int = 5,
    evaluator=None,
    seed: int = 42,
    parallelism: int = 2,
    fold: str | None = None,
) -> Search:
    """Search with folds taken from the row key, so every run and every grid point sees the same folds.

    Stages of a pipeline before the first one that a grid point changes are fitted and applied once a fold, and
    once on all rows for the best point; their result is kept for the fold's grid points, which fit the rest, up
    to `parallelism` at a time. `fold` names a column of the caller's own fold numbers (0 to `folds` - 1).
    Every pass of a fit lasts as long as its largest part, so many rows are dealt evenly first.
    """
    checkpoint_folder(train.sparkSession)
    evaluator = evaluator or MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    shared, rest = shared_stages(estimator, points)
    number = fold or "fold"
    train = evenly(train)
    folded = train if fold is not None else with_fold(train, folds, key, seed, number)
    folded = folded.persist()  # read by every fit; spills to disk, rebuilt if an executor goes
    sums = [0.0] * len(points)
    try:
        for i in range(folds):
            inside = col(number) != i
            prepared = _needed(Pipeline(stages=shared).fit(folded.filter(inside)).transform(folded), rest, evaluator, number).persist()

            def measure(point: dict, prepared: DataFrame = prepared, inside: Column = inside) -> float:
                model = Pipeline(stages=rest).fit(prepared.filter(inside), point)
                return evaluator.evaluate(model.transform(prepared.filter(~inside)))

            try:
                with ThreadPool(min(parallelism, len(points))) as pool:
                    scores = pool.map(inheritable_thread_target(train.sparkSession)(measure), points)
            finally:
                prepared.unpersist()
            sums = [total + score for total, score in zip(sums, scores)]
        means = [total / folds for total in sums]
        best = means.index(max(means) if evaluator.isLargerBetter() else min(means))
        before = Pipeline(stages=shared).fit(folded)
        prepared = _needed(before.transform(folded), rest, evaluator, number).persist()
        try:
            after = Pipeline(stages=rest).fit(prepared, points[best])
        finally:
            prepared.unpersist()
    finally:
        folded.unpersist()
    stages = [*before.stages, *after.stages]
    shown = [{p.name: v for p, v in point.items()} for point in points]
    return Search(PipelineModel(stages) if isinstance(estimator, Pipeline) else stages[-1], means, shown, evaluator.isLargerBetter())


def evenly(df: DataFrame) -> DataFrame:
    """The rows in parts of one size, as many as there are cores or a multiple; few rows stay as they lie."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df if rows < DEALT_FROM else df.repartition(cores * math.ceil(rows / (cores * PART_ROWS)))


def shared_stages(estimator: Estimator, points: list[dict]) -> tuple[list, list]:
    """The stages that no grid point changes, up to the first one that does, and the others; the last one is never shared."""
    if not isinstance(estimator, Pipeline):
        return [], [estimator]
    stages = estimator.getStages()
    changed = {param.parent for point in points for param in point}
    first = next((i for i, s in enumerate(stages) if _owners(s) & changed), len(stages) - 1)
    return stages[:first], stages[first:]


def _owners(stage) -> set[str]:
    inner = stage.getStages() if isinstance(stage, Pipeline) else []
    return {stage.uid}.union(*[_owners(s) for s in inner])


def _needed(df: DataFrame, stages: Sequence, evaluator, fold: str) -> DataFrame:
    """Only the columns that predictors and the evaluator name, if all stages are predictors; else all columns."""
    if not all(isinstance(s, HasFeaturesCol) for s in stages):
        return df
    names = {v for s in (*stages, evaluator) for p, v in s.extractParamMap().items() if p.name.endswith("Col")}
    return df.select(*[col(c) for c in df.columns if c in names or c == fold])


def scores_table(df: DataFrame, search: Search) -> DataFrame:
    """`(point, params, score)` of every grid point."""
    rows = [(i, {k: str(v) for k, v in p.items()}, float(s)) for i, (p, s) in enumerate(zip(search.points, search.scores))]
    return df.sparkSession.createDataFrame(rows, "point int, params map<string,string>, score double")


def train_and_evaluate(
    name: str,
    estimator: Estimator,
    points: list[dict],
    train: DataFrame,
    test: DataFrame,
    label: str,
    key: Sequence[str],
    folds: int = 5,
    feature_set: str = "base",
    **options,
) -> Search:
    """Search on train, score test, and build the metrics report of the best model."""
    search = k_fold_search(estimator, points, train, label, key, folds, **options)
    search.predictions = score(search.model, test)
    counted = confusion(search.predictions, label)
    search.counts = train.sparkSession.createDataFrame(counted.collect(), counted.schema)  # classes squared; test is scored once
    search.report = metrics_report(search.counts, name, search.best_params, search.best_score, feature_set)
    return search


def score(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


# --- comparison and choice ----------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureSet:
    """A named list of extra columns; each set is built from the cleaned table itself."""

    name: str
    columns: dict[str, Column] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        return add_columns(df, self.columns)


def combined(name: str, *sets: FeatureSet) -> FeatureSet:
    return FeatureSet(name, {k: v for s in sets for k, v in s.columns.items()})


def searches(
    models: dict[str, Callable[[list[str]], tuple[Estimator, list[dict]]]],
    feature_sets: Sequence[FeatureSet],
    train: DataFrame,
    test: DataFrame,
    label: str,
    key: Sequence[str],
    base_features: Sequence[str],
    folds: int = 5,
    **options,
) -> Iterator[tuple[str, str, Search]]:
    """`(model, feature set, search)` of every model on every feature set.

    Each entry of `models` builds an estimator and its grid for a list of feature columns.
    """
    train, test = train.persist(), test.persist()  # read by every fit; spills to disk, rebuilt if an executor goes
    try:
        for features, (name, build) in product(feature_sets, models.items()):
            estimator, points = build([*base_features, *features.columns])
            yield name, features.name, train_and_evaluate(
                name, estimator, points, features.apply(train), features.apply(test), label, key, folds, features.name, **options
            )
    finally:
        train.unpersist(), test.unpersist()


def compare(*args, **options) -> DataFrame:
    """`(model, feature_set, accuracy)` of all `searches`: results are appended."""
    table = None
    for _, _, search in searches(*args, **options):
        rows = search.report.filter("metric = 'accuracy'").select("model", "feature_set", F.col("value").alias("accuracy"))
        table = rows if table is None else table.unionAll(rows)
    return table


def best_result(results: DataFrame) -> DataFrame:
    """The best row; by model and feature set name on a tie."""
    return top_rows(results, 1, "accuracy", "model", "feature_set")


def best_per_model(results: DataFrame) -> DataFrame:
    """Each model's best accuracy over the feature sets."""
    return results.groupBy("model").agg(
        F.max(present(results, "accuracy")).alias("accuracy"),
        F.min_by("feature_set", F.struct(-present(results, "accuracy"), "feature_set")).alias("feature_set"),
    )


def choose_challenger(results: DataFrame, production: str, first: str, second: str, tolerance: float = 0.01) -> DataFrame:
    """One row `(choice)` from a `(model, accuracy)` table.

    Production stays if the better challenger is behind by more than the tolerance; else the larger
    challenger wins, the second on a tie.
    """
    at = {m: F.max(F.when(F.col("model") == m, present(results, "accuracy"))) for m in (production, first, second)}
    wide = results.agg(at[production].alias("p"), at[first].alias("a"), at[second].alias("b"))
    return wide.select(
        F.when(F.greatest("a", "b") - F.col("p") < -tolerance, F.lit(production))
        .when(F.col("a") > F.col("b"), F.lit(first))
        .otherwise(F.lit(second))
        .alias("choice")
    )


# --- robustness ---------------------------------------------------------------------------------


def gaussian(key: Sequence[str], salt: Column | int, round_no: Column) -> Column:
    """A standard normal number for each (key, salt, round): the same one again after a retry."""

    def share(part: int) -> Column:
        hashed = F.xxhash64(*[col(k) for k in key], F.lit(salt), round_no, F.lit(part))
        return (F.pmod(hashed, F.lit(HASH_RANGE)).cast("double") + 0.5) / F.lit(float(HASH_RANGE))

    return F.sqrt(-2.0 * F.log(share(0))) * F.cos(2.0 * math.pi * share(1))


def perturbed(df: DataFrame, columns: Sequence[str], key: Sequence[str], rounds: int, std: float, seed: int = 42) -> DataFrame:
    """Every row once per round with N(0, std) noise on every feature, and the column `round`.

    Round 0 is the row itself.
    """
    copies = df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds))))
    noise = {c: F.lit(std) * gaussian(key, seed + i, F.col("round")) for i, c in enumerate(columns)}
    return add_columns(copies, {c: as_double(df, c) + F.when(F.col("round") > 0, noise[c]).otherwise(0.0) for c in columns})


def robustness(
    model: Model, test: DataFrame, columns: Sequence[str], label: str, key: Sequence[str], rounds: int = 50, std: float = 1.2, confidence: float = 0.95
) -> DataFrame:
    """One row `(accuracy, rounds, mean_accuracy, low, high)`: all rounds are scored in one job."""
    width = NormalDist().inv_cdf(0.5 + confidence / 2)
    scored = score(model, perturbed(test, columns, key, rounds, std))
    by_round = scored.groupBy("round").agg(F.avg((col(label) == F.col("prediction")).cast("double")).alias("accuracy"))
    noisy = F.when(F.col("round") > 0, F.col("accuracy"))
    return by_round.agg(
        F.max(F.when(F.col("round") == 0, F.col("accuracy"))).alias("accuracy"),
        F.count(noisy).alias("rounds"),
        F.avg(noisy).alias("mean_accuracy"),
        (F.stddev_pop(noisy) / F.sqrt(F.count(noisy))).alias("error"),
    ).select(
        "accuracy",
        "rounds",
        "mean_accuracy",
        (F.col("mean_accuracy") - width * F.col("error")).alias("low"),
        (F.col("mean_accuracy") + width * F.col("error")).alias("high"),
    )


def pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))
