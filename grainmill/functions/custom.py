"""A caller's own Python functions, over Arrow batches; native expressions come first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(function: Callable[..., pd.Series], returns: str) -> Callable[..., Column]:
    """A function of whole series as a column function: `scalar(f, "double")("a", "b")`."""

    def apply(*series: pd.Series) -> pd.Series:
        return function(*series)

    apply.__annotations__ = {"return": pd.Series, "series": pd.Series}
    return F.pandas_udf(apply, returns)


def map_frame(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """`function` over the frame's rows, a batch at a time; it may change, drop or add rows and columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
