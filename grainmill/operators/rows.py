"""Projections, filters, row selection, order and union."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.columns import add_columns, col, numeric_columns, present


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Raise with the missing names; no job is run."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def keep_columns(df: DataFrame, *names: str) -> DataFrame:
    return require_columns(df, *names).select(*[col(n) for n in names])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that exist; other names are ignored."""
    return df.select(*[col(c) for c in df.columns if c not in set(names)])


def drop_non_numeric(df: DataFrame, label: str) -> DataFrame:
    """Numeric columns and the label, in the order of the frame."""
    keep = set(numeric_columns(df)) | {label}
    return df.select(*[col(c) for c in df.columns if c in keep])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def feature_names(df: DataFrame, label: str, exclude: Iterable[str] = ()) -> list[str]:
    """All columns but the label and the excluded ones."""
    skip = {label, *exclude}
    return [c for c in df.columns if c not in skip]


def split_label(df: DataFrame, label: str, exclude: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Feature frame and label frame."""
    require_columns(df, label)
    return df.select(*[col(c) for c in feature_names(df, label, exclude)]), df.select(col(label))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first `n` rows in the order of the given columns, which must determine the order."""
    if not order:
        raise ValueError("first_rows needs columns that give the order")
    return df.orderBy(*[col(c) for c in order]).limit(n)


def top_rows(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The `n` rows with the largest value; `ties` (ascending) make the result repeatable."""
    return sort_descending(df, by, *ties).limit(n)


def sort_descending(df: DataFrame, by: str, *ties: str) -> DataFrame:
    """Largest first; null and NaN last."""
    return df.orderBy(present(df, by).desc_nulls_last(), *[col(t).asc() for t in ties])


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last `n` rows in the given order (a peek: both ends stay top-k plans)."""
    return df.orderBy(*[col(c).desc() for c in order]).limit(n)


def keep_range(df: DataFrame, name: str, low=None, high=None, include_high: bool = False) -> DataFrame:
    """Rows with `low <= name < high` (`<=` with `include_high`); null and NaN rows go."""
    x = present(df, name)
    test = x.isNotNull()
    if low is not None:
        test = test & (x >= F.lit(low))
    if high is not None:
        test = test & ((x <= F.lit(high)) if include_high else (x < F.lit(high)))
    return df.filter(test)


def keep_equal(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(col(name) == F.lit(value))


def count_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row with the number of rows under each condition, in one pass."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return add_columns(df, {c: col(c).cast(t) for c, t in types.items()})


def lenient_numeric(df: DataFrame, *names: str) -> DataFrame:
    """Text to double, null where it is no number (a plain cast would raise)."""
    return add_columns(df, {c: F.trim(col(c).cast("string")).try_cast("double") for c in names})


def drop_incomplete(df: DataFrame, *names: str) -> DataFrame:
    """Rows without any null or NaN, over all or the named columns."""
    return df.na.drop("any", subset=list(names) or None)


def keep_first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    A rank limit of 1 is applied per task before the shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).filter("_position = 1").drop("_position")


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_ranked(*frames: DataFrame, rank: str = "source_rank") -> DataFrame:
    """`union_all` with the position of the source frame, the order key for `keep_first_per_key`."""
    return union_all(*[f.withColumn(rank, F.lit(i)) for i, f in enumerate(frames)])


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[col(n) for n in names]).distinct()
