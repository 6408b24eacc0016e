"""Scalar functions, feature columns and text (F, X, A5)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from grainmill.catalog.frames import GAPPED, KEY, KEY_SQL, gapped
from grainmill.catalog.registry import query, table
from grainmill.functions import columns as C
from grainmill.functions import custom
from grainmill.functions import text as X
from grainmill.models.feature_stages import PairwiseProduct, SquareFeatures
from grainmill.operators.rows import distinct_values


def lineitem(spark, folder):
    return table(spark, folder, "lineitem").select(*KEY, "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("F1", f"SELECT {KEY_SQL}, l_quantity * l_discount AS l_quantity_l_discount FROM lineitem")
def product(spark, folder):
    return C.with_products(lineitem(spark, folder), [("l_quantity", "l_discount")]).select(*KEY, "l_quantity_l_discount")


@query("F2", f"SELECT {KEY_SQL}, round(ln(1 + l_quantity), 9) AS l_quantity FROM lineitem")
def log1p(spark, folder):
    df = C.with_log1p(lineitem(spark, folder), ["l_quantity"])
    return df.select(*KEY, F.round("l_quantity", 9).alias("l_quantity"))


@query("F3", f"SELECT {KEY_SQL}, round(sqrt(l_extendedprice), 9) AS l_extendedprice FROM lineitem")
def square_root(spark, folder):
    return C.with_sqrt(lineitem(spark, folder), ["l_extendedprice"]).select(*KEY, F.round("l_extendedprice", 9).alias("l_extendedprice"))


@query("F4", "SELECT p_partkey, CAST(p_size AS BIGINT) * p_size AS p_size_squared FROM part")
def square(spark, folder):
    return C.with_squares(table(spark, folder, "part").select("p_partkey", "p_size"), ["p_size"]).select("p_partkey", "p_size_squared")


@query(
    "F5",
    """SELECT l_orderkey, l_partkey, l_linenumber, size, l_linenumber::BIGINT * l_linenumber AS l_linenumber_x_l_linenumber,
    l_linenumber::BIGINT * size AS l_linenumber_x_size, size::BIGINT * size AS size_x_size
    FROM (SELECT l_orderkey, l_partkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS size FROM lineitem)""",
)
def self_products(spark, folder):
    """Squares of prices pass the int range, so products are bigint."""
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").cast("int").alias("size"))
    return C.with_self_products(df)


@query("F6", "SELECT p_partkey, p_size, p_retailprice, p_size * p_retailprice AS p_size_p_retailprice FROM part")
def pair_products(spark, folder):
    return PairwiseProduct(inputCols=["p_size", "p_retailprice"]).transform(table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice"))


@query(
    "F7",
    f"WITH {GAPPED} SELECT {KEY_SQL}, greatest(quantity, price) AS max_quantity_price, greatest(quantity, discount) AS max_quantity_discount, "
    "greatest(price, discount) AS max_price_discount FROM base",
)
def pair_maxima(spark, folder):
    names = ["quantity", "price", "discount"]
    return C.with_pair_maxima(gapped(spark, folder), names).drop(*names, "flag")


@query("F8", f"WITH {GAPPED} SELECT {KEY_SQL}, quantity + price + discount AS total FROM base")
def null_sum(spark, folder):
    parts = [F.col(c) for c in ("quantity", "price", "discount")]
    return gapped(spark, folder).select(*KEY, C.null_propagating_sum(*parts).alias("total"))


@query("F9", "SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer")
def absolute(spark, folder):
    return C.with_abs(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


@query("F10", f"SELECT DISTINCT word FROM (SELECT unnest(string_split(line, ' ')) AS word FROM ({LINES}))")
def split_tokens(spark, folder):
    return distinct_values(X.tokens(X.lines(table(spark, folder, "documents"), "text")), "word")


@query("A5", f"SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(line, ' ')) AS word FROM ({LINES})) GROUP BY word HAVING count(*) >= 3")
def words(spark, folder):
    return X.word_counts(X.lines(table(spark, folder, "documents"), "text"))


@query("F11", "SELECT event_id, nullif(regexp_extract(props, '(\\d+)', 1), '') AS number, nullif(regexp_extract(props, '(\\d+\\.\\d+)', 1), '') AS dec FROM events")
def regex_group(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", X.first_group(F.col("props"), r"(\d+)").alias("number"), X.first_group(F.col("props"), X.DECIMAL_PATTERN).alias("dec")
    )


@query(
    "F12",
    "SELECT p_partkey, TRY_CAST(trim(CASE WHEN p_size % 10 = 0 THEN 'N/A' ELSE ' ' || p_size || '.5 ' END) AS DOUBLE) / 100 AS fraction FROM part",
)
def percent(spark, folder):
    shown = F.when(F.col("p_size") % 10 == 0, "N/A").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".5 ")))
    return table(spark, folder, "part").select("p_partkey", X.percent_to_fraction(shown).alias("fraction"))


@query(
    "F13",
    f"SELECT {KEY_SQL}, round(l_quantity * CASE WHEN l_tax <> 0 THEN l_discount / l_tax ELSE 1 END, 6) AS corrected FROM lineitem",
)
def corrected(spark, folder):
    rate = C.ratio_corrected(F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"))
    return lineitem(spark, folder).select(*KEY, F.round(rate, 6).alias("corrected"))


@query("F14", f"WITH {GAPPED} SELECT {KEY_SQL}, CASE WHEN quantity > 25 THEN 'high' ELSE 'low' END AS size FROM base")
def conditional(spark, folder):
    return gapped(spark, folder).select(*KEY, C.choose(F.col("quantity") > 25, "high", "low").alias("size"))


@query("F15", f"WITH {GAPPED} SELECT {KEY_SQL}, quantity IS NULL AS no_quantity, flag IS NULL AS no_flag FROM base")
def null_tests(spark, folder):
    df = gapped(spark, folder)
    return df.select(*KEY, C.missing(df, "quantity").alias("no_quantity"), C.missing(df, "flag").alias("no_flag"))


@query(
    "F16",
    """SELECT o_orderkey, row_no, header, male_rate, female_rate FROM (
      SELECT o_orderkey, 0 AS row_no, o_orderpriority AS header, TRY_CAST(o_totalprice AS DOUBLE) / 100 AS male_rate, (o_custkey % 90 + 0.5) / 100 AS female_rate FROM orders
      UNION ALL SELECT o_orderkey, 1, 'N/A', NULL, (o_custkey % 70 + 0.5) / 100 FROM orders)""",
)
def html_tables(spark, folder):
    """A page per order with two captioned tables, of which one is wanted; its second row lacks the header and a cell."""
    cell = lambda x: F.concat(F.lit("<td>"), x.cast("string"), F.lit("</td>"))
    filler = F.lit("<td> 1.0 </td><td>2.0</td>")
    first = F.concat(F.lit("<tr><th scope='row'> "), F.col("o_orderpriority"), F.lit(" </th>"), cell(F.col("o_totalprice")), filler, cell(F.col("o_custkey") % 90 + 0.5), filler, F.lit("</tr>"))
    second = F.concat(F.lit("<tr><td></td>"), filler, F.lit("\n<td class='x'>\n"), (F.col("o_custkey") % 70 + 0.5).cast("string"), F.lit("</td>"), filler, F.lit("</tr>"))
    other = F.lit("<table><caption>Something else</caption><tbody><tr><th>no</th><td>9</td></tr></tbody></table>")
    wanted = F.concat(F.lit("<TABLE id='t'><caption>Rates by priority, 2022</caption><thead><tr><th>p</th></tr></thead><tbody>"), first, second, F.lit("</tbody></TABLE>"))
    pages = table(spark, folder, "orders").select("o_orderkey", F.concat(F.lit("<html><body>"), other, wanted, F.lit("</body></html>")).alias("html"))
    found = X.table_rows(pages, "o_orderkey", "html", "Rates by priority", 6)
    rates = X.table_rates(found.withColumn("header", F.concat_ws("|", "row_no", "header")), "o_orderkey")
    number = F.split("label", r"\|")
    return rates.select("o_orderkey", number[0].cast("int").alias("row_no"), number[1].alias("header"), "male_rate", "female_rate")


ITEM_TEXT = "replace(replace(replace(replace(replace(replace(regexp_replace(body, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query(
    "F17",
    f"""SELECT page_id, CAST(place - 1 AS INTEGER) AS item_no, {ITEM_TEXT} AS text FROM (
      SELECT page_id, unnest(bodies) AS body, unnest(range(1, len(bodies) + 1)) AS place FROM (
        SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS bodies FROM pages))""",
)
def html_items(spark, folder):
    """Every item of every page."""
    return X.list_items(table(spark, folder, "pages"), "page_id", "html")


@query(
    "F17_rates",
    """SELECT p_partkey, label, round(rate * CASE WHEN female <> 0 THEN male / female ELSE 1 END / 100, 6) AS male_rate, round(rate / 100, 6) AS female_rate FROM (
      SELECT p_partkey, p_size + 0.5 AS male, p_size % 7 + 0.0 AS female,
        unnest(['18–24 years', '65 years and older']) AS label, unnest([p_size % 20 + 0.3, p_size % 30 + 0.1]) AS rate FROM part)""",
)
def item_rates(spark, folder):
    """A page per part whose list items carry a rate for men, for women and for two age ranges."""
    size = F.col("p_size")
    item = lambda number, words: F.concat(F.lit("<li class='a'>About <b></b>"), number.cast("decimal(9,1)").cast("string"), F.lit(f"% of {words}</li>"))
    html = F.concat(
        F.lit("<ul>"),
        item(size + 0.5, "adult men"),
        item(size % 7, "adult women"),
        item(size % 20 + 0.3, "adults aged 18–24 years"),
        item(size % 30 + 0.1, "adults aged 65 years and older"),
        F.lit("<li>no number here</li></ul>"),
    )
    items = X.list_items(table(spark, folder, "part").select("p_partkey", html.alias("html")), "p_partkey", "html")
    return X.item_rates(items, "p_partkey").select(
        "p_partkey", "label", F.round("male_rate", 6).alias("male_rate"), F.round("female_rate", 6).alias("female_rate")
    )


@query("X1", "SELECT p_partkey, p_size * 2.0 + p_retailprice AS value FROM part")
def series_function(spark, folder):
    """A caller's own function over series of two columns."""
    value = custom.scalar(lambda size, price: size * 2.0 + price, "double")
    return table(spark, folder, "part").select("p_partkey", value("p_size", "p_retailprice").alias("value"))


@query("X2", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_retailprice ELSE p_size END AS picked FROM part")
def row_function(spark, folder):
    """A caller's own function over whole batches of rows."""

    def pick(batch):
        picked = batch["p_retailprice"].where(batch["p_size"] > 25, batch["p_size"].astype(float))
        return pd.DataFrame({"p_partkey": batch["p_partkey"], "picked": picked})

    return custom.map_frame(table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice"), pick, "p_partkey bigint, picked double")


@query("X3", "SELECT p_partkey, p_size, CAST(p_size AS DOUBLE) * p_size AS p_size_squared FROM part")
def custom_transformer(spark, folder):
    return SquareFeatures(inputCols=["p_size"]).transform(table(spark, folder, "part").select("p_partkey", "p_size"))
