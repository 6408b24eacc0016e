"""Null, outlier and type profiles of a table: one aggregate over all columns each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import as_double, missing, numeric_columns
from grainmill.operators.order_statistics import iqr_bounds


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one column per input column: nulls, and NaN in floating columns."""
    return df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """`(column, missing, percent)`; percent is null for an empty frame."""
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"), F.col("_n")) for i, c in enumerate(df.columns)]
    return wide.select(F.inline(F.array(*rows))).select(
        "column", "missing", (F.col("missing") * 100.0 / F.nullif(F.col("_n"), F.lit(0))).alias("percent")
    )


def null_ranking(df: DataFrame) -> DataFrame:
    """Columns that have nulls, most first, by name on a tie."""
    return null_profile(df).filter("missing > 0").select("column", "missing").orderBy(F.desc("missing"), "column")


def outlier_counts(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5) -> DataFrame:
    """`(column, outliers)`: values outside the quartiles by more than `factor` times their distance."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    bounds = iqr_bounds(df, columns, factor)
    wide = df.agg(*[_outliers(df, c, bounds).alias(f"o{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"o{i}").alias("outliers")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def _outliers(df: DataFrame, name: str, bounds: dict[str, tuple[float, float]]):
    if name not in bounds:
        return F.count_if(F.lit(False))
    low, high = bounds[name]
    return F.count_if((as_double(df, name) < F.lit(low)) | (as_double(df, name) > F.lit(high)))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, skew_limit: float = 0.5) -> DataFrame:
    """`(variable, missing_values, outliers, prone_to_outliers, skewness, skewness_label)`.

    Skewness is the biased one. Text columns have null numbers and the label "N/A".
    """
    columns = list(columns) if columns is not None else df.columns
    numeric = [c for c in columns if c in set(numeric_columns(df))]
    bounds = iqr_bounds(df, numeric)
    measures = []
    for i, c in enumerate(columns):
        measures.append(F.count_if(missing(df, c)).alias(f"m{i}"))
        if c in numeric:
            measures += [_outliers(df, c, bounds).alias(f"o{i}"), F.skewness(as_double(df, c)).alias(f"s{i}")]
    rows = []
    for i, c in enumerate(columns):
        outliers = F.col(f"o{i}") if c in numeric else F.lit(None).cast("bigint")
        skewness = F.col(f"s{i}") if c in numeric else F.lit(None).cast("double")
        label = F.when(F.abs(skewness) > skew_limit, "Yes").otherwise("No") if c in numeric else F.lit("N/A")
        rows.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.col(f"m{i}").alias("missing_values"),
                outliers.alias("outliers"),
                F.when(outliers > 0, "Yes").otherwise("No").alias("prone_to_outliers"),
                skewness.alias("skewness"),
                label.alias("skewness_label"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def column_listing(df: DataFrame) -> DataFrame:
    """`(position, column, non_null, type)` for every column."""
    types = dict(df.dtypes)
    wide = df.agg(*[F.count_if(~missing(df, c)).alias(f"k{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(c).alias("column"),
            F.col(f"k{i}").alias("non_null"),
            F.lit(types[c]).alias("type"),
        )
        for i, c in enumerate(df.columns)
    ]
    return wide.select(F.inline(F.array(*rows)))
