"""Text columns to frequency codes held in a table, so that no column's texts come to the driver.

The fitted state is a Parquet table `(column, value, n, code, common)` in the shared folder, written beside the
metadata when the model is saved. A column's codes are applied by a left join: as a checked broadcast, or, for
more values than that, the common ones (at most a thousand hold a thousandth of the rows each) by broadcast and
the others by a shuffle in which the rows that are done already are spread and meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainmill.functions.columns import present
from grainmill.operators.clean import numbered
from grainmill.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS
from grainmill.session import scratch_path

#: A value is common if it holds more than this part of its column's rows.
COMMON = 1000
#: Parts that the rows of no further interest are dealt over in the join of the others.
SPREAD = 1024
EXTRA, MODE = "extra", "mode"


class _IndexParams(HasInputCols, HasOutputCols):
    unknown = Param(Params._dummy(), "unknown", "what null and unseen values become: extra, a code of their own; mode, the most frequent value's", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(unknown=EXTRA)


def frequency_table(df: DataFrame, columns: Sequence[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """`(column, value, n, code, common)`: each column's texts numbered from 0 by falling count, by value on a tie.

    The counts of all columns are one job with a map-side combine, written to the shared folder. Up to `limit` of
    them are numbered by a window for each column, more over sorted ranges.
    """
    spark = df.sparkSession
    texts = F.array(*[present(df, c).cast("string") for c in columns])
    counted = df.select(F.posexplode(texts).alias("column", "value")).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "value-counts")
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    order = [F.col("column"), F.col("n").desc(), F.col("value")]
    if counted.count() <= limit:
        coded = counted.withColumn("code", (F.row_number().over(Window.partitionBy("column").orderBy(*order[1:])) - 1).cast("bigint"))
    else:
        placed = numbered(counted, order, "place")
        first = placed.groupBy("column").agg(F.min("place").alias("first"))  # a row per column
        coded = placed.join(F.broadcast(first), "column").withColumn("code", F.col("place") - F.col("first")).drop("place", "first")
    totals = counted.groupBy("column").agg(F.sum("n").alias("total"))  # a row per column
    common = F.col("n") * COMMON > F.col("total")
    return coded.join(F.broadcast(totals), "column").select("column", "value", "n", "code", common.alias("common"))


class FrequencyIndexer(Estimator, _IndexParams, DefaultParamsReadable, DefaultParamsWritable):
    """Codes by falling frequency, as doubles; null and unseen values get the number of values, or the mode's code 0."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, unknown=EXTRA):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequencyIndexerModel:
        path = scratch_path(dataset.sparkSession, "frequency-index")
        frequency_table(dataset, self.getInputCols()).write.parquet(path)
        table = dataset.sparkSession.read.parquet(path)
        sizes = table.groupBy("column").agg(F.count("*").alias("n"), F.sum(F.octet_length("value") + 16).alias("bytes")).collect()  # a row per column
        found = {r["column"]: (r["n"], r["bytes"]) for r in sizes}
        both = [found.get(i, (0, 0)) for i in range(len(self.getInputCols()))]
        return self._copyValues(FrequencyIndexerModel(path, [n for n, _ in both], [b for _, b in both]))


class FrequencyIndexerModel(Model, _IndexParams, MLWritable, MLReadable):
    """The codes of a fitted `FrequencyIndexer`, at `path`."""

    def __init__(self, path: str | None = None, sizes: Sequence[int] = (), widths: Sequence[int] = ()):
        super().__init__()
        self.path, self.sizes, self.widths = path, list(sizes), list(widths)

    def table(self, spark: SparkSession) -> DataFrame:
        """`(column, value, n, code, common)`; column is the place among the input columns."""
        return spark.read.parquet(self.path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        extra = self.getOrDefault(self.unknown) == EXTRA
        for i, (name, out) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            fits = self.sizes[i] <= BROADCAST_ROWS and self.widths[i] <= BROADCAST_BYTES
            dataset = self._coded(dataset, i, name, out, fits)
            shown = {"ml_attr": {"type": "nominal", "num_vals": self.sizes[i] + 1, "name": out}} if extra else {}
            code = F.coalesce(F.col("_code").cast("double"), F.lit(float(self.sizes[i] if extra else 0)))
            dataset = dataset.withColumn(out, code.alias(out, metadata=shown)).drop("_code")
        return dataset

    def _coded(self, df: DataFrame, i: int, name: str, out: str, fits: bool) -> DataFrame:
        codes = self.table(df.sparkSession).filter(F.col("column") == i)
        value = present(df, name).cast("string")

        def side(rows: DataFrame, code: str) -> DataFrame:
            return rows.select(F.col("value").alias("_value"), F.col("code").alias(code))

        if fits:
            return df.join(F.broadcast(side(codes, "_code")), value == F.col("_value"), "left").drop("_value")
        done = df.join(F.broadcast(side(codes.filter("common"), "_first")), value == F.col("_value"), "left").drop("_value")
        spread = F.when(F.col("_first").isNull() & value.isNotNull(), F.lit(0)).otherwise(1 + F.monotonically_increasing_id() % SPREAD)
        keyed = done.withColumns({"_text": F.coalesce(value, F.lit("")), "_spread": spread})
        # zero, but not as a literal, which the optimizer would take out of the join's keys
        rest = codes.filter("NOT common").withColumn("_of", F.least("n", F.lit(0).cast("bigint")))
        rest = rest.select(F.col("value").alias("_value"), F.col("code").alias("_second"), "_of")
        met = keyed.join(rest, (F.col("_text") == F.col("_value")) & (F.col("_spread") == F.col("_of")), "left")
        return met.withColumn("_code", F.coalesce("_first", "_second")).drop("_first", "_second", "_text", "_spread", "_value", "_of")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: FrequencyIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"sizes": self.model.sizes, "widths": self.model.widths})
        self.model.table(self.sparkSession).write.parquet(f"{path.rstrip('/')}/codes")


class _Reader(MLReader):
    def __init__(self, cls: type[FrequencyIndexerModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FrequencyIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(f"{path.rstrip('/')}/codes", metadata["sizes"], metadata["widths"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
