"""Aggregates (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.catalog.cleaning import MEASURED, MEASURES, measures
from grainmill.catalog.frames import GAPPED, KEY, gapped
from grainmill.catalog.registry import query, table
from grainmill.catalog.storing import SEGMENT_SHARES, SHARE_COLUMNS, SHARES_SQL
from grainmill.operators import aggregates as A
from grainmill.plans.census import segment_summary
from grainmill.sources.readers import literal_table


def _rounded(df, digits, *names):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query(
    "entry",
    f"""WITH means AS (SELECT c_mktsegment, round(avg(o_totalprice), 4) AS average_price FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)
    SELECT c_mktsegment, average_price, segment, CAST(male AS DOUBLE) AS male, CAST(female AS DOUBLE) AS female
    FROM means FULL OUTER JOIN {SHARES_SQL} ON c_mktsegment = segment""",
)
def flagship(spark, folder):
    """Trim, complete rows, group average over a join, full outer join with literal shares."""
    shares = literal_table(spark, SEGMENT_SHARES, SHARE_COLUMNS)
    return _rounded(segment_summary(table(spark, folder, "customer"), table(spark, folder, "orders"), shares), 4, "average_price")


@query("A1", "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS average_price FROM orders GROUP BY o_orderpriority")
def group_mean(spark, folder):
    return _rounded(A.group_mean(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice", "average_price"), 4, "average_price")


@query("A2", "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")
def group_count(spark, folder):
    return A.group_count(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus")


@query("A3", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(spark, folder):
    return A.shape(table(spark, folder, "lineitem"))


@query(
    "A4",
    f"WITH {GAPPED} SELECT CAST(count(DISTINCT flag) AS BIGINT) AS flag, CAST(count(DISTINCT price) AS BIGINT) AS price FROM base",
)
def distinct_counts(spark, folder):
    return A.distinct_counts(gapped(spark, folder), ["flag", "price"])


@query(
    "A6",
    f"WITH {GAPPED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 4) AS quantile FROM base"
        for c in ("quantity", "price")
        for p in (0.25, 0.5, 0.75)
    ),
)
def quantile_table(spark, folder):
    return _rounded(A.quantile_table(gapped(spark, folder), ["quantity", "price"], [0.25, 0.5, 0.75]), 4, "quantile")


@query(
    "A7",
    f"WITH {GAPPED} "
    + " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n FROM base WHERE {c} IS NOT NULL
        GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""
        for c in ("flag", "quantity")
    ),
)
def modes(spark, folder):
    df = gapped(spark, folder)
    numbers = A.modes_of(df, ["quantity"])
    return A.modes_of(df, ["flag"]).unionAll(numbers.withColumn("value", F.col("value").cast("string")))


@query(
    "A8",
    f"WITH {MEASURED} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM measured" for c in MEASURES),
)
def mean_std(spark, folder):
    return _rounded(A.mean_std(measures(spark, folder), list(MEASURES)), 4, "mean", "std")


@query(
    "A9",
    f"WITH {MEASURED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 6) AS skewness FROM measured, (SELECT avg({c}) AS m FROM measured)"
        for c in MEASURES
    ),
)
def biased_skewness(spark, folder):
    return _rounded(A.biased_skewness(measures(spark, folder), list(MEASURES)), 6, "skewness")


@query(
    "A10",
    f"WITH {MEASURED} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis FROM measured" for c in MEASURES),
)
def corrected_moments(spark, folder):
    return _rounded(A.skew_kurtosis(measures(spark, folder), list(MEASURES)), 6, "skewness", "kurtosis")


@query(
    "A11",
    f"WITH {GAPPED} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS "min",
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS "max" FROM base"""
        for c in ("quantity", "price", "discount")
    ),
)
def described(spark, folder):
    return _rounded(A.describe(gapped(spark, folder).drop(*KEY)), 4, "mean", "std", "q25", "q50", "q75")


LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def correlation_sql(columns, source="lineitem") -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, corr({a}, {b}) AS correlation FROM {source}" for i, a in enumerate(columns) for b in columns[i + 1 :]
    )


@query("A12", f"SELECT f1, f2, round(correlation, 6) AS correlation FROM ({correlation_sql(LINE_COLUMNS)})")
def correlations(spark, folder):
    return _rounded(A.correlations(table(spark, folder, "lineitem"), LINE_COLUMNS), 6, "correlation")


@query(
    "A13",
    f"WITH {GAPPED}, total AS (SELECT quantity, quantity + price + discount AS total FROM base) "
    "SELECT 'quantity' AS f1, 'total' AS f2, round(corr(quantity, total), 6) AS correlation FROM total",
)
def chosen_correlation(spark, folder):
    df = gapped(spark, folder).withColumn("total", F.col("quantity") + F.col("price") + F.col("discount"))
    return _rounded(A.correlations(df, ["quantity", "total"]), 6, "correlation")


@query(
    "A14",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\" FROM part" for c in ("p_size", "p_retailprice")),
)
def min_max(spark, folder):
    return A.min_max(table(spark, folder, "part"), ["p_size", "p_retailprice"])


@query(
    "A15",
    """SELECT CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_numerator, CAST(count(*) FILTER (WHERE quality = 1) AS BIGINT) AS n_denominator,
    round(count(*) FILTER (WHERE quality = 0) / nullif(count(*) FILTER (WHERE quality = 1), 0), 6) AS ratio FROM labels""",
)
def class_ratio(spark, folder):
    return _rounded(A.class_ratio(table(spark, folder, "labels"), "quality"), 6, "ratio")


@query("A16", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def arg_max(spark, folder):
    return A.arg_max(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice", "o_orderkey")
