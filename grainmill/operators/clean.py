"""Imputation, range repair and outlier handling.

Statistics of independent columns are taken in one job and enter the plan as literals, so the
cleaned frame is a plain projection over its input: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.columns import add_columns, as_double, cap_upper, clamp, col, missing, numeric_columns, present, text_columns
from grainmill.operators.joins import BROADCAST_ROWS, fits_broadcast
from grainmill.operators.order_statistics import distinct_estimates, iqr_bounds, medians, modes, repaired_medians
from grainmill.session import checkpoint_folder


def fill_mode(df: DataFrame, *columns: str) -> DataFrame:
    """Nulls become the most frequent value (nulls not counted, lowest value on a tie)."""
    found = modes(df, columns)
    return add_columns(
        df, {c: F.when(missing(df, c), F.lit(v).cast(df.schema[c].dataType)).otherwise(col(c)) for c, v in found.items() if v is not None}
    )


def fill_median(df: DataFrame, *columns: str, approx: bool = False) -> DataFrame:
    """Nulls become the median; the column turns into double, since a median of integers may be fractional."""
    columns = columns or tuple(numeric_columns(df))
    found = medians(df, columns, approx)
    return add_columns(df, {c: F.coalesce(as_double(df, c), F.lit(m)) for c, m in found.items() if m is not None})


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Nulls become the constant, in the type of the column."""
    return df.na.fill(values)


def replace_out_of_range(
    df: DataFrame, ranges: dict[str, tuple[float | None, float | None]], refit: bool = True, approx: bool = False, fill: Sequence[str] = ()
) -> DataFrame:
    """Values below the low or above the high end become the median; then nulls do too.

    `refit` takes a new median after the replacement for the nulls, otherwise the first one is used
    for both. The columns of `fill` only get their nulls filled. All columns and both medians share the jobs.
    """
    found = repaired_medians(df, {**ranges, **dict.fromkeys(fill, (None, None))}, approx)
    new = {}
    for c, (first, last) in found.items():
        low, high = ranges.get(c, (None, None))
        x = as_double(df, c)
        tests = ([x < F.lit(low)] if low is not None else []) + ([x > F.lit(high)] if high is not None else [])
        kept = F.when(reduce(Column.__or__, tests), F.lit(first)).otherwise(x) if tests else x
        if first is not None:
            new[c] = F.coalesce(kept, F.lit(last if refit else first))
        elif c in ranges:
            new[c] = x
    return add_columns(df, new)


def cap_columns(df: DataFrame, cap: float, *columns: str) -> DataFrame:
    """Upper limit for the named columns; null stays null, and NaN becomes null."""
    return add_columns(df, {c: cap_upper(present(df, c), cap).cast(df.schema[c].dataType) for c in columns})


def clamp_iqr(df: DataFrame, *columns: str, factor: float = 1.5, approx: bool = False) -> DataFrame:
    """Values outside the IQR bounds are moved to the bound (the bounds come from the unclamped column)."""
    columns = columns or tuple(numeric_columns(df))
    bounds = iqr_bounds(df, columns, factor, approx)
    return add_columns(df, {c: clamp(as_double(df, c), low, high) for c, (low, high) in bounds.items()})


def drop_z_outliers(df: DataFrame, *columns: str, factor: float = 3.0, tolerance: float = 0.01) -> DataFrame:
    """Keep rows with `|x - mean| / std - factor < tolerance`, column after column.

    Each column's mean and sample deviation come from the rows that survived the earlier columns,
    so there is one small job per column. A null value, or a column without deviation, keeps nothing.
    """
    for c in columns or tuple(numeric_columns(df)):
        x = as_double(df, c)
        mean, std = df.agg(F.avg(x), F.stddev_samp(x)).first()
        df = df.filter(F.abs(x - F.lit(mean)) / F.lit(std) - F.lit(factor) < F.lit(tolerance)) if std else df.filter(F.lit(False))
    return df


def trim_text(df: DataFrame, *columns: str) -> DataFrame:
    """Spaces at both ends removed from all (or the named) text columns, in one projection."""
    return add_columns(df, {c: F.trim(col(c)) for c in columns or tuple(text_columns(df))})


def fill_from(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Nulls and NaN of a column taken from another expression."""
    return add_columns(df, {column: F.coalesce(present(df, column), value)})


def round_columns(df: DataFrame, digits: int, *columns: str, half_even: bool = False) -> DataFrame:
    rounding = F.bround if half_even else F.round
    return add_columns(df, {c: rounding(col(c), digits) for c in columns})


# --- text codes ---------------------------------------------------------------------------------


def bounded_columns(df: DataFrame, *columns: str) -> dict[str, bool]:
    """Whether each column's dictionary is small enough to broadcast: one scan for all columns."""
    return {c: n <= BROADCAST_ROWS for c, n in distinct_estimates(df, columns).items()}


def label_codes(df: DataFrame, column: str, bounded: bool | None = None) -> DataFrame:
    """`(value, code)`: distinct values numbered from 0 in sorted order; null has no code.

    A checked small set of values is numbered by one window. A larger one is sorted over all tasks:
    the code is the position inside the task's range plus the rows of the ranges before it.
    """
    values = df.select(col(column).alias("value")).filter("value is not null").distinct()
    return _dictionary(values, [F.col("value")], bounded_columns(df, column)[column] if bounded is None else bounded)


def frequency_codes(df: DataFrame, column: str, bounded: bool | None = None) -> DataFrame:
    """`(value, n, code)`: values numbered from 0, most frequent first, by value on a tie."""
    counted = df.select(col(column).alias("value")).filter("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col("value").asc()]
    return _dictionary(counted, order, bounded_columns(df, column)[column] if bounded is None else bounded)


def _dictionary(values: DataFrame, order: Sequence[Column], bounded: bool) -> DataFrame:
    if bounded:
        return values.withColumn("code", (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
    return numbered(values, order, "code")


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Rows numbered from 0 in a total order, without one task seeing them all."""
    checkpoint_folder(df.sparkSession)
    ranged = df.orderBy(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))  # one row per task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, (F.col("_start") + F.col("_at")).cast("bigint"))
        .drop("_part", "_start", "_at")
    )


def encode(df: DataFrame, column: str, codes: DataFrame, out: str | None = None, bounded: bool | None = None) -> DataFrame:
    """The column's code beside the column; a null or unknown value gets null."""
    table = codes.select(F.col("value").alias("_value"), F.col("code").alias(out or f"{column}_encoded"))
    if fits_broadcast(table) if bounded is None else bounded:
        table = F.broadcast(table)
    return df.join(table, col(column) == F.col("_value"), "left").drop("_value")


def label_encode(df: DataFrame, *columns: str, suffix: str = "_encoded") -> DataFrame:
    """`<column>_encoded` in sorted value order for all (or the named) text columns."""
    columns = columns or tuple(text_columns(df))
    bounded = bounded_columns(df, *columns) if columns else {}
    source = df
    for c in columns:
        df = encode(df, c, label_codes(source, c, bounded[c]), f"{c}{suffix}", bounded[c])
    return df
