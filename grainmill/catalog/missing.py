"""Operators over columns that hold NaN and infinite values: NaN is missing, an infinite value is a value."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.catalog.frames import KEY, KEY_SQL, SEVEN_RATES, rates_sql
from grainmill.catalog.registry import query, table
from grainmill.functions import columns as C
from grainmill.operators import aggregates, bands, clean, order_statistics, rows

NAN, INFINITE = float("nan"), float("inf")


def strange(spark, folder):
    """Lineitem with a quantity that is NaN on line 3, and a price that is NaN on line 1, infinite on line 4 and minus infinite on line 6."""
    line = F.col("l_linenumber")
    price = F.when(line == 1, NAN).when(line == 4, INFINITE).when(line == 6, -INFINITE).otherwise(F.col("l_extendedprice"))
    return table(spark, folder, "lineitem").select(*KEY, F.when(line == 3, NAN).otherwise(F.col("l_quantity")).alias("quantity"), price.alias("price"))


STRANGE = f"""base AS (SELECT {KEY_SQL}, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
    CASE l_linenumber WHEN 1 THEN NULL WHEN 4 THEN CAST('inf' AS DOUBLE) WHEN 6 THEN CAST('-inf' AS DOUBLE) ELSE l_extendedprice END AS price FROM lineitem)"""
ROW = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query(
    "C4_nan",
    f"""WITH {STRANGE}, m AS (SELECT quantity AS v FROM base WHERE quantity IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, quantity LIMIT 1)
    SELECT {KEY_SQL}, coalesce(quantity, v) AS quantity FROM base, m""",
)
def mode_filled(spark, folder):
    return clean.fill_mode(strange(spark, folder).drop("price"), "quantity")


@query("C9_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, CASE WHEN price > 50000 THEN 50000 ELSE price END AS price FROM base")
def capped(spark, folder):
    return clean.cap_columns(strange(spark, folder).drop("quantity"), 50000, "price")


LABELS_SQL = " ".join(f"WHEN quantity + 15 >= {lo} {f'AND quantity + 15 <= {hi}' if hi is not None else ''} THEN '{label}'" for lo, hi, label in bands.SEVEN_BANDS)


@query("C16_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, CASE {LABELS_SQL} END AS label FROM base")
def banded(spark, folder):
    aged = strange(spark, folder).select(*KEY, (F.col("quantity") + 15).alias("age"))
    return bands.add_band_label(aged, "age", bands.SEVEN_BANDS, "label").drop("age")


@query(
    "C17_nan",
    f"""WITH {STRANGE} SELECT {KEY_SQL}, rate FROM base LEFT JOIN {rates_sql(bands.SEVEN_BANDS, SEVEN_RATES)}
    ON quantity + 15 >= lo AND (hi IS NULL OR quantity + 15 <= hi) AND grp = l_linenumber % 2""",
)
def rated(spark, folder):
    aged = strange(spark, folder).select(*KEY, (F.col("quantity") + 15).alias("age"), (F.col("l_linenumber") % 2).alias("sex"))
    return bands.add_rate(aged, bands.rate_table(spark, bands.SEVEN_BANDS, SEVEN_RATES), "age", "sex", "rate").drop("age", "sex")


@query(
    "C18_nan",
    f"""WITH {STRANGE} SELECT {KEY_SQL}, CASE WHEN quantity IS NULL THEN price WHEN price IS NULL THEN quantity ELSE (quantity + price) / 2 END AS mean FROM base""",
)
def row_mean(spark, folder):
    return strange(spark, folder).select(*KEY, C.mean_of_available(F.col("quantity"), F.col("price")).alias("mean"))


@query("C19_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, coalesce(quantity, l_linenumber + 0.5) AS quantity FROM base")
def filled_from(spark, folder):
    return clean.fill_from(strange(spark, folder).drop("price"), "quantity", F.col("l_linenumber") + 0.5)


@query("P4_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, price FROM base WHERE price >= 60000")
def in_range(spark, folder):
    return rows.keep_range(strange(spark, folder).drop("quantity"), "price", 60000)


@query("O1_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, quantity FROM base ORDER BY quantity DESC NULLS LAST, {ROW} LIMIT 25")
def top(spark, folder):
    return rows.top_rows(strange(spark, folder).drop("price"), 25, "quantity", *KEY)


@query("O3_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, price IS NULL AS last FROM base ORDER BY price DESC NULLS LAST, {ROW}")
def in_order(spark, folder):
    found = rows.sort_descending(strange(spark, folder), "price", *KEY)
    return found.select(*KEY, F.isnan("price").alias("last"))


@query("A16_nan", f"WITH {STRANGE} SELECT {KEY_SQL}, quantity FROM base WHERE quantity IS NOT NULL ORDER BY quantity DESC, l_partkey, {ROW} LIMIT 1")
def largest(spark, folder):
    tied = strange(spark, folder).drop("price").withColumn("tie", F.struct("l_partkey", *KEY))
    return aggregates.arg_max(tied, "quantity", "tie").drop("tie")


@query(
    "A6_infinite",
    f"""WITH {STRANGE}, r AS (SELECT price, row_number() OVER (ORDER BY price) - 1 AS i, count(*) OVER () - 1 AS n FROM base WHERE price IS NOT NULL),
    q AS (SELECT p, max(price) FILTER (WHERE i = floor(p * n)) AS low, max(price) FILTER (WHERE i = ceil(p * n)) AS high, any_value(p * n - floor(p * n)) AS part
      FROM r, (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]) AS p) GROUP BY p)
    SELECT CAST(p AS DOUBLE) AS p, round(CASE WHEN low = high THEN low ELSE low + (high - low) * part END, 6) AS value FROM q""",
)
def infinite_ends(spark, folder):
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = order_statistics.quantiles(strange(spark, folder), ["price"], shares)["price"]
    return spark.createDataFrame([(p, round(v, 6)) for p, v in zip(shares, found)], "p double, value double")
