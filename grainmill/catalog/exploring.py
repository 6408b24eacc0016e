"""Exploratory tables (E)."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from grainmill.catalog.aggregating import LINE_COLUMNS, correlation_sql
from grainmill.catalog.cleaning import MEASURED, MEASURES, measures
from grainmill.catalog.frames import GAPPED, KEY, gapped
from grainmill.catalog.registry import query, table
from grainmill.functions.columns import with_log1p, with_squares
from grainmill.operators import eda
from grainmill.operators.aggregates import correlations
from grainmill.operators.profile import column_listing

PART_COLUMNS = ("p_size", "p_size_squared", "log_size", "p_retailprice")


def part_features(spark, folder):
    """Part sizes with their square and logarithm, which are strongly correlated."""
    part = table(spark, folder, "part").select("p_size", "p_retailprice")
    df = with_log1p(with_squares(part, ["p_size"]).withColumn("log_size", F.col("p_size")), ["log_size"])
    return df.select(*PART_COLUMNS)


PARTS = "parts AS (SELECT p_size, p_size::BIGINT * p_size AS p_size_squared, ln(1 + p_size) AS log_size, p_retailprice FROM part)"
STRONG = f"SELECT f1, f2, abs(correlation) AS abs_correlation FROM ({correlation_sql(PART_COLUMNS, 'parts')}) WHERE abs(correlation) > 0.7"


@query(
    "E1",
    f"""SELECT feature1, feature2, round(correlation, 6) AS correlation, round(abs(correlation), 6) AS abs_correlation FROM (
      SELECT f1 AS feature1, f2 AS feature2, correlation FROM ({correlation_sql(LINE_COLUMNS)})
      UNION ALL SELECT f2, f1, correlation FROM ({correlation_sql(LINE_COLUMNS)})) ORDER BY abs(correlation) DESC, feature1, feature2 LIMIT 10""",
)
def top_pairs(spark, folder):
    pairs = eda.top_pairs(table(spark, folder, "lineitem"), LINE_COLUMNS)
    return pairs.withColumns({c: F.round(c, 6) for c in ("correlation", "abs_correlation")})


@query("E2", f"WITH {PARTS} SELECT f1, f2, round(abs_correlation, 6) AS abs_correlation FROM ({STRONG})")
def strong_pairs(spark, folder):
    strong = eda.strong_pairs(correlations(part_features(spark, folder)))
    return strong.withColumn("abs_correlation", F.round("abs_correlation", 6))


@query("E3", f"WITH {PARTS} SELECT format('{{}} * {{}} (Correlation: {{:.2f}})', f1, f2, abs_correlation) AS term FROM ({STRONG})")
def interaction_terms(spark, folder):
    return eda.interaction_terms(eda.strong_pairs(correlations(part_features(spark, folder))))


MOMENTS = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", skewness({c}) AS skewness, kurtosis({c}) AS kurtosis FROM measured" for c in MEASURES)


@query("E4", f"WITH {MEASURED} SELECT \"column\", round(skewness, 6) AS skewness, round(kurtosis, 6) AS kurtosis FROM ({MOMENTS})")
def skew_table(spark, folder):
    return eda.skew_table(measures(spark, folder)).withColumns({c: F.round(c, 6) for c in ("skewness", "kurtosis")})


@query(
    "E5",
    f"""WITH {MEASURED} SELECT "column", CASE WHEN skewness > 0 THEN 'Consider log transformation' ELSE 'Consider square root transformation' END AS suggestion
    FROM ({MOMENTS}) WHERE abs(skewness) > 0.5""",
)
def transformations(spark, folder):
    return eda.suggested_transformations(eda.skew_table(measures(spark, folder)), limit=0.5)


@query(
    "E6",
    """WITH m AS (SELECT min(l_extendedprice) AS a, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem),
    c AS (SELECT least(floor((l_extendedprice - a) / w), 49) AS bin, count(*) AS n FROM lineitem, m GROUP BY 1)
    SELECT 'l_extendedprice' AS "column", CAST(g.bin AS BIGINT) AS bin, round(a + g.bin * w, 4) AS low, round(a + (g.bin + 1) * w, 4) AS high, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM m, range(50) AS g(bin) LEFT JOIN c ON g.bin = c.bin""",
)
def histogram(spark, folder):
    counted = eda.histogram(table(spark, folder, "lineitem"), ["l_extendedprice"], 50)
    return counted.withColumns({c: F.round(c, 4) for c in ("low", "high")})


@query(
    "E7",
    f"WITH {MEASURED} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(q1, 4) AS q25, round(q2, 4) AS q50, round(q3, 4) AS q75,
        round(min({c}) FILTER (WHERE {c} >= q1 - 0.4 * (q3 - q1)), 4) AS whisker_low, round(max({c}) FILTER (WHERE {c} <= q3 + 0.4 * (q3 - q1)), 4) AS whisker_high,
        CAST(count(*) FILTER (WHERE {c} < q1 - 0.4 * (q3 - q1) OR {c} > q3 + 0.4 * (q3 - q1)) AS BIGINT) AS outliers
        FROM measured, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM measured) GROUP BY q1, q2, q3"""
        for c in MEASURES
    ),
)
def box_statistics(spark, folder):
    box = eda.box_statistics(measures(spark, folder), list(MEASURES), factor=0.4)
    return box.withColumns({c: F.round(c, 4) for c in ("q25", "q50", "q75", "whisker_low", "whisker_high")})


_POINTS = ", ".join(f"({i}, {(i - 0.5) / 99!r}, {NormalDist().inv_cdf((i - 0.5) / 99)!r})" for i in range(1, 100))
_SHARES = "[" + ", ".join(repr((i - 0.5) / 99) for i in range(1, 100)) + "]"


@query(
    "E8",
    f"""WITH q AS (SELECT quantile_cont(l_extendedprice, {_SHARES}) AS qs, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem)
    SELECT 'l_extendedprice' AS "column", CAST(i AS BIGINT) AS i, round(CAST(z AS DOUBLE), 6) AS theoretical, round((qs[i] - m) / s, 6) AS sample
    FROM q, (VALUES {_POINTS}) AS v(i, p, z)""",
)
def qq_points(spark, folder):
    points = eda.qq_points(table(spark, folder, "lineitem"), ["l_extendedprice"])
    return points.withColumns({c: F.round(c, 6) for c in ("theoretical", "sample")})


GRID = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "E9",
    "WITH m AS (SELECT "
    + ", ".join(f"min({c}) AS {c}_a, (max({c}) - min({c})) / 20 AS {c}_w" for c in GRID)
    + " FROM lineitem), b AS (SELECT "
    + ", ".join(f"CAST(least(floor(({c} - {c}_a) / {c}_w), 19) AS BIGINT) AS {c}" for c in GRID)
    + " FROM lineitem, m) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, {a} AS bin1, {b} AS bin2, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY {a}, {b}"
        for i, a in enumerate(GRID)
        for b in GRID[i + 1 :]
    ),
)
def scatter_grid(spark, folder):
    return eda.scatter_grid(table(spark, folder, "lineitem"), GRID, 20)


@query(
    "E10",
    f"WITH {GAPPED} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS non_null, '{t}' AS type FROM base"
        for i, (c, t) in enumerate((("quantity", "double"), ("price", "double"), ("discount", "double"), ("flag", "string")))
    ),
)
def listing(spark, folder):
    return column_listing(gapped(spark, folder).drop(*KEY))
