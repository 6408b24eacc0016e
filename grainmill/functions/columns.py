"""Scalar expressions and blocks of feature columns. Everything here stays inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = FLOATING + INTEGRAL + (T.DecimalType,)


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of_type(df: DataFrame, kinds, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the columns whose type is one of `kinds`, in schema order (no job)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of_type(df, NUMERIC, exclude)


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of_type(df, T.StringType, exclude)


def missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN where the type can hold it (`isnan` on text raises under ANSI)."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column in its own type with NaN turned into null: NaN is missing everywhere."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(col(name)), col(name))
    return col(name)


def number(x: Column) -> Column:
    """A numeric expression as a double with NaN turned into null."""
    value = x.cast("double")
    return F.when(~F.isnan(value), value)


def as_double(df: DataFrame, name: str) -> Column:
    """The column as a double with NaN turned into null."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(col(name)), col(name)).cast("double")
    return col(name).cast("double")


# --- single expressions -------------------------------------------------------------------------


def binary_encode(x: Column, zero=0) -> Column:
    """0 for the zero value, 1 for all else, null included."""
    return F.when(x == F.lit(zero), 0).otherwise(1)


def cap_upper(x: Column, cap: float) -> Column:
    """Values above `cap` become `cap`; null stays null."""
    return F.when(x > F.lit(cap), F.lit(cap)).otherwise(x)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x < F.lit(low), F.lit(low)).when(x > F.lit(high), F.lit(high)).otherwise(x)


def choose(condition: Column, then, otherwise) -> Column:
    """`then` where the condition holds; false and null go to `otherwise`."""
    return F.when(condition, then).otherwise(otherwise)


def mean_of_available(*parts: Column) -> Column:
    """Row mean of the parts that are neither null nor NaN; null only if all are."""
    values = [number(p) for p in parts]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    there = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    return F.when(there > 0, total / F.nullif(there, F.lit(0)))


def null_propagating_sum(*parts: Column) -> Column:
    return sum(parts[1:], parts[0])


def ratio_corrected(rate: Column, numerator: Column, denominator: Column) -> Column:
    """`rate * numerator / denominator`; the factor is 1 when the denominator is 0."""
    factor = F.when(denominator != 0, numerator / F.nullif(denominator, F.lit(0))).otherwise(F.lit(1.0))
    return rate * factor


# --- blocks of columns, each added by one select ------------------------------------------------


def _widened(df: DataFrame, name: str) -> Column:
    """Integers widened to bigint so that a product does not overflow int."""
    return col(name).cast("bigint") if isinstance(df.schema[name].dataType, INTEGRAL) else col(name)


def add_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """All columns of `df` with `new` added or replaced in one projection."""
    return df.withColumns(new) if new else df


def with_products(df: DataFrame, pairs: Sequence[tuple[str, str]], name: str = "{a}_{b}") -> DataFrame:
    """Products of named column pairs."""
    return add_columns(df, {name.format(a=a, b=b): _widened(df, a) * _widened(df, b) for a, b in pairs})


def with_self_products(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`a_x_b` for every pair i <= j of the integer columns (squares included)."""
    columns = list(columns) if columns is not None else columns_of_type(df, T.IntegerType)
    return with_products(df, list(combinations_with_replacement(columns, 2)), "{a}_x_{b}")


def with_pair_products(df: DataFrame, columns: Sequence[str], name: str = "{a}*{b}") -> DataFrame:
    """Products of every pair i < j."""
    return with_products(df, list(combinations(columns, 2)), name)


def with_pair_maxima(df: DataFrame, columns: Sequence[str], name: str = "max_{a}_{b}") -> DataFrame:
    """Row maximum of every pair i < j; a null side is skipped."""
    return add_columns(df, {name.format(a=a, b=b): F.greatest(col(a), col(b)) for a, b in combinations(columns, 2)})


def with_log1p(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return add_columns(df, {c: F.log1p(col(c).cast("double")) for c in columns})


def with_sqrt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return add_columns(df, {c: F.sqrt(col(c).cast("double")) for c in columns})


def with_squares(df: DataFrame, columns: Sequence[str], name: str = "{a}_squared") -> DataFrame:
    return add_columns(df, {name.format(a=c): _widened(df, c) * _widened(df, c) for c in columns})


def with_abs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return add_columns(df, {c: F.abs(col(c)) for c in columns})
