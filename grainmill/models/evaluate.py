"""Scores and reports as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import col


def confusion(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """`(label, prediction, n)`."""
    return predictions.groupBy(col(label).cast("double").alias("label"), col(prediction).cast("double").alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row `(accuracy)`."""
    return predictions.agg(F.avg((col(label) == col(prediction)).cast("double")).alias("accuracy"))


def area_under_roc(predictions: DataFrame, label: str, score: str = "rawPrediction", bins: int = 0) -> float:
    """Area under the ROC curve over every distinct score; with `bins` the curve is down-sampled."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins).evaluate(predictions)


def classification_report(counts: DataFrame) -> DataFrame:
    """`(class, precision, recall, f1, support)` per class plus accuracy, macro and weighted averages.

    Works on a `confusion` table, whose size is classes squared. A class without predictions has
    precision 0, one without rows has recall 0.
    """
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when((F.col("label") == F.col("prediction")) & (F.col("class") == F.col("label")), F.col("n")).otherwise(0)
    totals = (
        counts.select("label", "prediction", "n", F.inline(sides))
        .groupBy("class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            (F.sum(hit) / 2).alias("hits"),  # a true cell shows up on both sides
        )
    )
    precision = F.coalesce(F.col("hits") / F.nullif(F.col("predicted"), F.lit(0)), F.lit(0.0))
    recall = F.coalesce(F.col("hits") / F.nullif(F.col("support"), F.lit(0)), F.lit(0.0))
    scored = totals.select("class", "support", "hits", precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1",
        F.coalesce(
            2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)
        ),
    )
    measures = ("precision", "recall", "f1")
    wide = scored.agg(
        F.collect_list(F.struct(F.col("class").cast("string").alias("class"), *measures, "support")).alias("rows"),  # one per class
        F.sum("support").alias("total"),
        F.sum("hits").alias("hits"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / F.nullif(F.sum("support"), F.lit(0))).alias(f"weighted_{m}") for m in measures],
    )
    share = F.col("hits") / F.nullif(F.col("total"), F.lit(0))

    def line(name: str, prefix: str | None):
        values = [(share if prefix is None else F.col(f"{prefix}_{m}")).cast("double").alias(m) for m in measures]
        return F.struct(F.lit(name).alias("class"), *values, F.col("total").alias("support"))

    averages = F.array(line("accuracy", None), line("macro avg", "macro"), line("weighted avg", "weighted"))
    return wide.select(F.inline(F.concat("rows", averages)))


def metrics_report(counts: DataFrame, model: str, params: dict[str, object] | None = None, cv_score: float | None = None, feature_set: str = "base") -> DataFrame:
    """`(model, feature_set, metric, value, params)`: accuracy, confusion cells, report and best search score."""
    cells = counts.select(
        F.format_string("confusion[%s,%s]", F.col("label").cast("string"), F.col("prediction").cast("string")).alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    report = classification_report(counts)
    parts = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in ("precision", "recall", "f1", "support")]
    lines = (
        report.filter("class != 'accuracy'")
        .select("class", F.inline(F.array(*parts)))
        .select(F.format_string("%s[%s]", "measure", "class").alias("metric"), "value")
    )
    single = report.filter("class = 'accuracy'").select(F.lit("accuracy").alias("metric"), F.col("f1").alias("value"))
    rows = single.unionAll(cells).unionAll(lines)
    if cv_score is not None:
        rows = rows.unionAll(single.select(F.lit("best_cv_score").alias("metric"), F.lit(float(cv_score)).alias("value")))
    pairs = [part for k, v in (params or {}).items() for part in (F.lit(k), F.lit(str(v)))]
    shown = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return rows.select(F.lit(model).alias("model"), F.lit(feature_set).alias("feature_set"), "metric", "value", shown.alias("params"))


def results_table(df: DataFrame, rows: Sequence[tuple[str, str, float]]) -> DataFrame:
    return df.sparkSession.createDataFrame(list(rows), "model string, feature_set string, accuracy double")
