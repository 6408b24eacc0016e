"""Tables behind the exploratory pictures and suggestions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import as_double, numeric_columns
from grainmill.operators.aggregates import correlations, min_max, skew_kurtosis
from grainmill.operators.order_statistics import quantiles


def top_pairs(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10, both_directions: bool = True) -> DataFrame:
    """`(feature1, feature2, correlation, abs_correlation)`: the `n` strongest pairs.

    With `both_directions` a pair is listed as (a, b) and (b, a), as in a flattened square matrix.
    """
    pairs = correlations(df, columns).filter("correlation is not null")
    one = pairs.select(F.col("f1").alias("feature1"), F.col("f2").alias("feature2"), "correlation")
    if both_directions:
        flips = F.array(F.struct("feature1", "feature2"), F.struct(F.col("feature2").alias("feature1"), F.col("feature1").alias("feature2")))
        one = one.select(F.inline(flips).alias("feature1", "feature2"), "correlation")
    ranked = one.withColumn("abs_correlation", F.abs("correlation"))
    return ranked.orderBy(F.desc("abs_correlation"), "feature1", "feature2").limit(n)


def strong_pairs(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """`(f1, f2, abs_correlation)` above the threshold, strongest first, from a `correlations` table."""
    strong = pairs.select("f1", "f2", F.abs("correlation").alias("abs_correlation")).filter(F.col("abs_correlation") > threshold)
    return strong.orderBy(F.desc("abs_correlation"), "f1", "f2")


def interaction_terms(strong: DataFrame) -> DataFrame:
    """`(term)` lines like `a * b (Correlation: 0.93)`."""
    return strong.select(F.format_string("%s * %s (Correlation: %.2f)", "f1", "f2", "abs_correlation").alias("term"))


def suggested_transformations(moments: DataFrame, limit: float = 1.0) -> DataFrame:
    """`(column, suggestion)` for strongly skewed columns of a `skew_kurtosis` table."""
    suggestion = F.when(F.col("skewness") > 0, "Consider log transformation").otherwise("Consider square root transformation")
    return moments.filter(F.abs("skewness") > limit).select("column", suggestion.alias("suggestion"))


def skew_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return skew_kurtosis(df, list(columns) if columns is not None else numeric_columns(df))


def _edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, tuple[float, float]]:
    """`(start, width)` of equal bins; a constant column gets the range of one around its value."""
    edges = {}
    for row in min_max(df, columns).collect():
        low, high = row["min"], row["max"]
        if low is not None:
            low, high = (low - 0.5, high + 0.5) if low == high else (low, high)
            edges[row["column"]] = (low, (high - low) / bins)
    return edges


def _bin(x: Column, edge: tuple[float, float], bins: int) -> Column:
    """Bin number from 0, null for null (`least` alone would skip it); the last bin is closed on the right."""
    start, width = edge
    return F.when(x.isNotNull(), F.least(F.floor((x - F.lit(start)) / F.lit(width)), F.lit(bins - 1))).cast("bigint")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """`(column, bin, low, high, n)` with empty bins included: `bins` rows per column."""
    edges = _edges(df, columns, bins)
    names = [c for c in columns if c in edges]
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(c, b, edges[c][0] + b * edges[c][1], edges[c][0] + (b + 1) * edges[c][1]) for c in names for b in range(bins)],
        "column string, bin bigint, low double, high double",
    )
    placed = df.select(*[_bin(as_double(df, c), edges[c], bins).alias(f"v{i}") for i, c in enumerate(names)])
    if not names:
        return grid.withColumn("n", F.lit(0).cast("bigint"))
    labels = F.create_map(*[part for i, c in enumerate(names) for part in (F.lit(f"v{i}"), F.lit(c))])
    counted = (
        placed.unpivot([], [f"v{i}" for i in range(len(names))], "name", "bin")
        .filter("bin is not null")
        .groupBy("name", "bin")
        .agg(F.count("*").alias("n"))
        .select(labels[F.col("name")].alias("column"), "bin", "n")
    )
    return grid.join(counted, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def scatter_grid(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """`(f1, f2, bin1, bin2, n)`: occupied cells of the scatter of every column pair."""
    edges = _edges(df, columns, bins)
    names = [c for c in columns if c in edges]
    placed = df.select(*[_bin(as_double(df, c), edges[c], bins).alias(f"v{i}") for i, c in enumerate(names)])
    # each row is taken apart into its pairs before the count, so a task sends at most bins squared cells of each pair
    pairs = [
        F.struct(F.lit(names[i]).alias("f1"), F.lit(names[j]).alias("f2"), F.col(f"v{i}").alias("bin1"), F.col(f"v{j}").alias("bin2"))
        for i, j in combinations(range(len(names)), 2)
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "f1 string, f2 string, bin1 bigint, bin2 bigint, n bigint")
    return (
        placed.select(F.inline(F.array(*pairs)))
        .filter("bin1 is not null and bin2 is not null")
        .groupBy("f1", "f2", "bin1", "bin2")
        .agg(F.count("*").alias("n"))
    )


def box_statistics(df: DataFrame, columns: Sequence[str], factor: float = 1.5, approx: bool = False) -> DataFrame:
    """`(column, q25, q50, q75, whisker_low, whisker_high, outliers)`; whiskers end at data points."""
    quartiles = {c: q for c, q in quantiles(df, columns, [0.25, 0.5, 0.75], approx).items() if q[0] is not None}
    measures, rows = [], []
    for i, (c, (q1, q2, q3)) in enumerate(quartiles.items()):
        x = as_double(df, c)
        low, high = F.lit(q1 - factor * (q3 - q1)), F.lit(q3 + factor * (q3 - q1))
        measures += [
            F.min(F.when(x >= low, x)).alias(f"l{i}"),
            F.max(F.when(x <= high, x)).alias(f"h{i}"),
            F.count_if((x < low) | (x > high)).alias(f"o{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(q1).alias("q25"),
                F.lit(q2).alias("q50"),
                F.lit(q3).alias("q75"),
                F.col(f"l{i}").alias("whisker_low"),
                F.col(f"h{i}").alias("whisker_high"),
                F.col(f"o{i}").alias("outliers"),
            )
        )
    if not rows:
        schema = "column string, q25 double, q50 double, q75 double, whisker_low double, whisker_high double, outliers bigint"
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def qq_points(df: DataFrame, columns: Sequence[str], points: int = 99, approx: bool = False) -> DataFrame:
    """`(column, i, theoretical, sample)`: normal quantiles against those of the standardised column."""
    shares = [(i - 0.5) / points for i in range(1, points + 1)]
    found = quantiles(df, columns, shares, approx)
    normal = NormalDist()
    rows = [(c, i, normal.inv_cdf(p), q) for c in columns for i, (p, q) in enumerate(zip(shares, found[c]), 1)]
    wide = df.agg(*[f(as_double(df, c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    moments = wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("_mean"), F.col(f"s{i}").alias("_std")) for i, c in enumerate(columns)]))
    )
    placed = df.sparkSession.createDataFrame(rows, "column string, i bigint, theoretical double, quantile double")
    sample = (F.col("quantile") - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    return placed.join(F.broadcast(moments), "column").select("column", "i", "theoretical", sample.alias("sample"))
