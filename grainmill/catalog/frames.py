"""Frames derived from the test tables (which hold no nulls), and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.catalog.registry import table

KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
KEY_SQL = ", ".join(KEY)


def gapped(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitem with nulls: quantity where line 3, price where line 5, flag where line 2."""
    return table(spark, folder, "lineitem").select(
        *KEY,
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linenumber") != 5, F.col("l_extendedprice")).alias("price"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_linenumber") != 2, F.col("l_returnflag")).alias("flag"),
    )


GAPPED = f"""base AS (
  SELECT {KEY_SQL},
    CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
    CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS price,
    l_discount AS discount,
    CASE WHEN l_linenumber <> 2 THEN l_returnflag END AS flag
  FROM lineitem)"""


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as people: an age with fractions, below and above the bands, and a sex with nulls."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 100).alias("age"),
        F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey") % 2).alias("sex"),
    )


PEOPLE = """people AS (
  SELECT c_custkey, c_acctbal / 100 AS age, CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey % 2 END AS sex
  FROM customer)"""

# Invented rates, {label: (male, female)}; one band of each table has none.
SEVEN_RATES = {
    "18–24": (0.124, 0.081),
    "25–34": (0.131, 0.092),
    "35–44": (0.143, 0.102),
    "45–54": (0.157, 0.118),
    "55–64": (0.149, 0.112),
    "75 years and over": (0.053, 0.042),
}
FOUR_RATES = {
    "18–24 years": (0.062, 0.053),
    "25–44 years": (0.133, 0.114),
    "65 years and older": (0.093, 0.082),
}


def rates_sql(bands, rates) -> str:
    """The rows of a rate table as SQL VALUES `(lo, hi, grp, rate)`."""
    rows = []
    for low, high, label in bands:
        for group, rate in zip((1, 0), rates.get(label, (None, None))):
            shown = ["NULL" if v is None else str(v) for v in (high, rate)]
            rows.append(f"({low}, CAST({shown[0]} AS DOUBLE), {group}, CAST({shown[1]} AS DOUBLE))")
    return "(VALUES " + ", ".join(rows) + ") AS r(lo, hi, grp, rate)"


def doc_features(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with numeric features of their whole text."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    chars = F.greatest(F.length("text"), F.lit(1))
    words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    counted = documents.select(
        "doc_id",
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        words.cast("double").alias("n_words"),
        (breaks + 1).cast("double").alias("n_lines"),
        (F.regexp_count("text", F.lit("[0-9]")) / chars).alias("digit_share"),
        (chars / words).alias("word_length"),
    )
    return counted.join(labels, "doc_id")


FEATURES = ["n_chars", "n_words", "n_lines", "digit_share", "word_length"]
