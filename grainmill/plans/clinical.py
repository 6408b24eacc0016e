"""Clinical cleaning flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import col, mean_of_available
from grainmill.operators.bands import add_rates
from grainmill.operators.clean import cap_columns, fill_constant, fill_from, fill_mode, replace_out_of_range, round_columns
from grainmill.operators.rows import first_rows, keep_columns, keep_range, lenient_numeric

# The kept columns and the limits of the cleaning rules.
KEPT_COLUMNS = (
    "age", "sex", "painloc", "painexer", "cp", "trestbps", "smoke", "fbs", "prop", "nitr", "pro", "diuretic",
    "thaldur", "thalach", "exang", "oldpeak", "slope", "target",
)
MODE_COLUMNS = ("painloc", "painexer", "exang")
MEDIAN_COLUMNS = ("thaldur", "thalach")
FLAG_COLUMNS = ("fbs", "prop", "nitr", "pro", "diuretic")
RANGES = {"trestbps": (100.0, None), "oldpeak": (0.0, 4.0)}
AGES = (18, 75)


def clean_clinical(
    df: DataFrame, abs_rates: DataFrame, cdc_rates: DataFrame, row_order: str | None = None, n_rows: int | None = None, refit: bool = True, age_filter: bool = True
) -> DataFrame:
    """Modes, range repair, medians, capped flags, slope mode, age filter, rates, smoking fill, rounding.

    With `n_rows`, only the first rows in the order of `row_order` are kept; without it all are. Rate tables are `(lo, hi, group, rate)`.
    Independent statistics share jobs: modes of the binary columns and slope, then all first medians.
    """
    if n_rows is not None:
        df = first_rows(df, n_rows, *([row_order] if row_order else []))
    df = keep_columns(df, *KEPT_COLUMNS)
    df = fill_mode(df, *MODE_COLUMNS, "slope")
    df = replace_out_of_range(df, RANGES, refit=refit, fill=MEDIAN_COLUMNS)
    df = fill_constant(cap_columns(df, 1, *FLAG_COLUMNS), {c: 0 for c in FLAG_COLUMNS})
    df = lenient_numeric(df, "age")
    if age_filter:
        df = keep_range(df, "age", *AGES)
    df = add_rates(df, {"abs_smoke_rate": abs_rates, "cdc_smoke_rate": cdc_rates}, "age", "sex")
    df = fill_from(df, "smoke", mean_of_available(col("abs_smoke_rate"), col("cdc_smoke_rate")))
    return round_columns(df, 3, "smoke", "abs_smoke_rate", "cdc_smoke_rate").select(
        *KEPT_COLUMNS[:-1], "abs_smoke_rate", "cdc_smoke_rate", F.col("target")
    )
