"""Census flow: scan, trim, null counts, complete rows, products, group average, outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.functions.columns import with_self_products
from grainmill.operators.aggregates import group_mean
from grainmill.operators.clean import trim_text
from grainmill.operators.joins import outer_small, outer_with_lookup
from grainmill.operators.profile import null_counts
from grainmill.operators.rows import drop_incomplete, keep_equal
from grainmill.sources.readers import literal_table, read_csv

# The census columns and the population shares by marital status (male, female).
CENSUS_SCHEMA = T.StructType(
    [
        T.StructField("age", T.IntegerType()),
        T.StructField("workclass", T.StringType()),
        T.StructField("fnlwgt", T.IntegerType()),
        T.StructField("education", T.StringType()),
        T.StructField("education_num", T.IntegerType()),
        T.StructField("marital_status", T.StringType()),
        T.StructField("occupation", T.StringType()),
        T.StructField("relationship", T.StringType()),
        T.StructField("race", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("capital_gain", T.IntegerType()),
        T.StructField("capital_loss", T.IntegerType()),
        T.StructField("hours_per_week", T.IntegerType()),
        T.StructField("native_country", T.StringType()),
        T.StructField("income", T.StringType()),
    ]
)
MARITAL_STATUS_BY_GENDER = (
    ("Never-married", 47.35, 41.81),
    ("Married-AF-spouse", 67.54, 68.33),
    ("Widowed", 3.58, 11.61),
    ("Divorced", 10.82, 15.09),
)
MARITAL_STATUS_BY_GENDER_COLUMNS = ("marital_status_statistics", "male", "female")


def read_census(spark: SparkSession, path) -> DataFrame:
    """The padded, header-less files with integer columns and trimmed text."""
    return trim_text(read_csv(spark, path, CENSUS_SCHEMA, header=False, trim=True))


def census_flow(spark: SparkSession, path) -> dict[str, DataFrame]:
    """All results of the flow as lazy frames."""
    data = read_census(spark, path)
    complete = drop_incomplete(data)
    featured = with_self_products(complete)
    statistics = literal_table(spark, MARITAL_STATUS_BY_GENDER, MARITAL_STATUS_BY_GENDER_COLUMNS)
    return {
        "missing": null_counts(data),
        "features": featured,
        "average_gain": group_mean(complete, "marital_status", "capital_gain", "average_capital_gain"),
        "divorced": keep_equal(featured, "marital_status", "Divorced"),
        "joined": outer_with_lookup(featured, statistics, "marital_status", "marital_status_statistics"),
    }


def segment_summary(customers: DataFrame, orders: DataFrame, shares: DataFrame) -> DataFrame:
    """The same flow on a star schema: customers' orders by market segment beside literal shares."""
    customers = drop_incomplete(trim_text(customers.select("c_custkey", "c_mktsegment")))
    spending = orders.select("o_custkey", "o_totalprice").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    means = group_mean(spending, "c_mktsegment", "o_totalprice", "average_price")
    return outer_small(means, shares, "c_mktsegment", "segment")
