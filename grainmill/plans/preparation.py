"""Preparation of numeric columns before they are modelled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from grainmill.functions.columns import numeric_columns
from grainmill.operators.clean import clamp_iqr, fill_median
from grainmill.operators.eda import top_pairs


def prepare(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10, factor: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """The frame with gaps at the median and values moved into the IQR bounds, and its `n` most correlated pairs.

    The bounds come from the filled columns. Medians and bounds enter as literals, so the frame stays a
    projection over its input, and the pairs are one more scan of it.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    tidy = clamp_iqr(fill_median(df, *columns), *columns, factor=factor)
    return tidy, top_pairs(tidy, columns, n, both_directions=False)
