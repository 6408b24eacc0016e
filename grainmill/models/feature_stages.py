"""Persistable pipeline stages, fitted inside the folds of a search."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import add_columns, as_double, col
from grainmill.models.table_index import MODE, FrequencyIndexer
from grainmill.operators.joins import lookup_side


class PairwiseProduct(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """`a_b` for every pair i < j of the input columns, in one projection."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def pairs(self) -> list[tuple[str, str]]:
        return list(combinations(self.getInputCols(), 2))

    def names(self) -> list[str]:
        return self.getOutputCols() if self.isSet(self.outputCols) else [f"{a}_{b}" for a, b in self.pairs()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_columns(dataset, {out: as_double(dataset, a) * as_double(dataset, b) for out, (a, b) in zip(self.names(), self.pairs())})


class SquareFeatures(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """The square of every input column."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def names(self) -> list[str]:
        return self.getOutputCols() if self.isSet(self.outputCols) else [f"{c}_squared" for c in self.getInputCols()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_columns(dataset, {out: as_double(dataset, c) * as_double(dataset, c) for out, c in zip(self.names(), self.getInputCols())})


def mean_imputer(columns: Sequence[str], prefix: str = "Imputed") -> Imputer:
    return Imputer(inputCols=list(columns), outputCols=[f"{prefix}{c}" for c in columns], strategy="mean")


def frequency_indexer(columns: Sequence[str], suffix: str = "Index") -> FrequencyIndexer:
    """Index by falling frequency, alphabetical on a tie; null and unseen values get the extra index."""
    return FrequencyIndexer(inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns])


def mode_indexer(columns: Sequence[str], prefix: str = "ImputedIndex") -> FrequencyIndexer:
    """The same with null and unseen values as the mode, which has index 0."""
    return FrequencyIndexer(inputCols=list(columns), outputCols=[f"{prefix}{c}" for c in columns], unknown=MODE)


def assembler(columns: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid)


def scaler(source: str = "raw_features", out: str = "features", centre: bool = False) -> StandardScaler:
    """Unit sample deviation; `centre` also removes the mean."""
    return StandardScaler(inputCol=source, outputCol=out, withMean=centre, withStd=True)


def preparation_stages(numeric: Sequence[str], text: Sequence[str], out: str = "features") -> list:
    """Index and impute text, impute numbers, add pair products, assemble: the stages before a classifier."""
    stages: list = []
    text_ready = [f"ImputedIndex{c}" for c in text]
    if text:
        stages.append(mode_indexer(text))
    numeric_ready = [f"Imputed{c}" for c in numeric]
    products: list[str] = []
    if numeric:
        product = PairwiseProduct(inputCols=numeric_ready)
        products = product.names()
        stages += [mean_imputer(numeric), product]
    return [*stages, assembler(products + numeric_ready + text_ready, out)]


# --- tables of fitted values --------------------------------------------------------------------


def min_max_table(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(name, min, max, scale)`: scale is 1/(max-min), and 1 for a constant column."""
    wide = train.agg(*[f(as_double(train, c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("l", F.min), ("h", F.max))])
    rows = [F.struct(F.lit(c).alias("name"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max")) for i, c in enumerate(columns)]
    span = F.col("max") - F.col("min")
    return wide.select(F.inline(F.array(*rows))).withColumn("scale", F.when(span == 0, 1.0).otherwise(1.0 / F.nullif(span, F.lit(0.0))))


def apply_min_max(df: DataFrame, table: DataFrame) -> DataFrame:
    """Any frame scaled with the values of a `min_max_table`, the training values for train and test alike."""
    found = {r["name"]: (r["min"], r["scale"]) for r in table.collect()}  # one row per column
    return add_columns(df, {c: (as_double(df, c) - F.lit(low)) * F.lit(scale) for c, (low, scale) in found.items() if low is not None})


def ratio_weight(train: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Label 1 weighs n0/n1, all else 1; both counts in one job."""
    zeros, ones = train.agg(F.count_if(col(label) == 0), F.count_if(col(label) == 1)).first()
    return train.withColumn(out, F.when(col(label) == 1, F.lit(zeros / ones if ones else 1.0)).otherwise(F.lit(1.0)))


def balanced_weights(train: DataFrame, label: str) -> DataFrame:
    """`(label, n, weight)` with weight n_total / (classes * n)."""
    counts = train.groupBy(col(label).alias("label")).agg(F.count("*").alias("n"))
    wide = counts.agg(F.collect_list(F.struct("label", "n")).alias("rows"), F.sum("n").alias("total"))  # one entry per class
    one = wide.select(F.inline("rows"), "total", F.size("rows").alias("classes"))
    return one.select("label", "n", (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight"))


def balanced_weight(train: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = balanced_weights(train, label).select(F.col("label").alias("_label"), F.col("weight").alias(out))
    return train.join(lookup_side(weights), col(label) == F.col("_label"), "left").drop("_label")
