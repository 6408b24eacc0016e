"""Grouped and whole-table aggregates. Result tables hold one row per column unless stated."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import as_double, col, numeric_columns, present
from grainmill.operators.comoments import correlation_rows
from grainmill.operators.order_statistics import mode_table, quantiles


def group_mean(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(col(key)).agg(F.avg(col(value)).alias(out or f"average_{value}"))


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n"))


def shape(df: DataFrame) -> DataFrame:
    """`(n_rows, n_columns)`."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """One row, one column per input: distinct non-null values."""
    count = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(*[count(col(c)).alias(c) for c in columns])


def per_column(df: DataFrame, columns: Sequence[str], fields: dict[str, Callable[[Column], Column]], key: str = "column") -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    wide = df.select(*[as_double(df, c).alias(f"v{i}") for i, c in enumerate(columns)]).agg(
        *[fn(F.col(f"v{i}")).alias(f"v{i}_{field}") for i in range(len(columns)) for field, fn in fields.items()]
    )
    rows = [
        F.struct(F.lit(c).alias(key), *[F.col(f"v{i}_{field}").alias(field) for field in fields]) for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def quantile_table(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], approx: bool = False) -> DataFrame:
    """`(column, p, quantile)`."""
    found = quantiles(df, columns, probabilities, approx)
    rows = [(c, float(p), q) for c in columns for p, q in zip(probabilities, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, p double, quantile double")


def modes_of(df: DataFrame, columns: Sequence[str], as_type: str | None = None) -> DataFrame:
    return mode_table(df, columns, as_type).withColumnRenamed("name", "column")


def mean_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, mean, std)` with the sample standard deviation."""
    return per_column(df, columns, {"mean": F.avg, "std": F.stddev_samp})


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return per_column(df, columns, {"min": F.min, "max": F.max})


def biased_skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return per_column(df, columns, {"skewness": F.skewness})


def corrected_skewness(x: Column) -> Column:
    """G1, null below three values."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)) * F.skewness(x))


def corrected_kurtosis(x: Column) -> Column:
    """G2 (excess), null below four values."""
    n = F.count(x).cast("double")
    scale = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0))
    return F.when(n > 3, scale * ((n + 1) * F.kurtosis(x) + 6))


def skew_kurtosis(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, skewness, kurtosis)`, both bias-corrected."""
    return per_column(df, columns, {"skewness": corrected_skewness, "kurtosis": corrected_kurtosis})


def describe(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """`(column, count, mean, std, min, q25, q50, q75, max)` with exact quartiles by default."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    quartiles = quantile_rows(df, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], approx)
    moments = per_column(df, columns, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    return moments.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def quantile_rows(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], names: Sequence[str], approx: bool = False) -> DataFrame:
    """One row per column with the quantiles side by side: as many rows as there are columns."""
    found = quantiles(df, columns, probabilities, approx)
    schema = "column string, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame([(c, *found[c]) for c in columns], schema)


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`(f1, f2, correlation)` for every pair in column order, over rows where both are present.

    One scan for any number of columns. A pair without variance or without rows gives null, one with an infinite
    value NaN.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "f1 string, f2 string, correlation double")
    pairs = df.sparkSession.createDataFrame(
        [(a, b) for a, b in combinations(columns, 2)], "f1 string, f2 string"
    )  # a pair is listed even if the table has no rows
    return pairs.join(correlation_rows(df, columns), ["f1", "f2"], "left")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return group_count(df, label)


def class_ratio(df: DataFrame, label: str, numerator=0, denominator=1) -> DataFrame:
    """One row `(n_numerator, n_denominator, ratio)`; null for an empty denominator."""
    counted = df.agg(
        F.count_if(col(label) == F.lit(numerator)).alias("n_numerator"),
        F.count_if(col(label) == F.lit(denominator)).alias("n_denominator"),
    )
    return counted.withColumn("ratio", F.col("n_numerator") / F.nullif(F.col("n_denominator"), F.lit(0)))


def arg_max(df: DataFrame, value: str, tie: str) -> DataFrame:
    """The whole row with the largest value, null and NaN left out; the lowest `tie` column on a tie."""
    x = present(df, value)
    return df.filter(x.isNotNull()).orderBy(x.desc(), col(tie).asc()).limit(1)
