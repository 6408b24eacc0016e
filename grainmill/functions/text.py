"""Text expressions, and tables read off HTML pages."""

from __future__ import annotations

from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import col
from grainmill.functions.html import ABSENT, items, read_pages, tables


def lines(df: DataFrame, text: str, out: str = "value") -> DataFrame:
    """One row per line of a text column, like a text scan of the same content."""
    return df.select(F.explode(F.split(col(text), "\n")).alias(out))


def tokens(df: DataFrame, text: str = "value", out: str = "word") -> DataFrame:
    """One row per piece between single spaces; empty pieces and punctuation are kept."""
    return df.select(F.explode(F.split(col(text), " ")).alias(out))


def word_counts(df: DataFrame, text: str = "value", minimum: int | None = 3) -> DataFrame:
    """`(word, n)`; a hot word is combined map-side, so it costs one row per task in the shuffle."""
    counted = tokens(df, text).groupBy("word").agg(F.count("*").alias("n"))
    return counted if minimum is None else counted.filter(F.col("n") >= minimum)


def first_group(text: Column, pattern: str) -> Column:
    """First regex group, null where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def percent_to_fraction(text: Column) -> Column:
    """`' 12.5 '` -> 0.125; text that is no number gives null."""
    return F.trim(text).try_cast("double") / F.lit(100.0)


# The patterns used on the rate pages.
DECIMAL_PATTERN = r"(\d+\.\d+)"
AGE_RANGE_PATTERN = r"(\d+[–\-]\d+ years|\d+ years and older)"

def list_items(df: DataFrame, key: str, html: str, matching: str | None = None, own: bool = False) -> DataFrame:
    """`(key, item_no, text)`: one row per `<li>`, optionally only where the text matches a pattern.

    The text is that of the item without the items of lists inside it, or with `own` its first text that is in
    no element of its own ('' if there is none).
    """

    def read(page: str) -> list[tuple]:
        return [(i, (x.own or "") if own else "".join(x.whole)) for i, x in enumerate(items(page))]

    found = read_pages(df, key, html, "item_no bigint, text string", read).withColumn("item_no", F.col("item_no").cast("int"))
    return found if matching is None else found.filter(F.col("text").rlike(matching))


def table_rows(df: DataFrame, key: str, html: str, caption: str, cells: int | None = None) -> DataFrame:
    """Rows of the tables whose caption contains a text.

    `(key, table_no, row_no, header, cells)`: the header is the first `<th>`, the cells are all `<td>` of the
    row, or with `cells` exactly that many; a missing or empty one is "N/A", as on the page. Pages without the
    text are not taken apart.
    """

    def read(page: str) -> list[tuple]:
        if caption not in page and caption not in unescape(page):
            return []
        found = []
        for number, table in enumerate(tables(page)):
            if any(caption in c for c in table.captions[:1]):
                for place, (header, texts) in enumerate(table.rows):
                    texts = texts if cells is None else (texts + [ABSENT] * cells)[:cells]
                    found.append((number, place, header, texts))
        return found

    rows = read_pages(df, key, html, "table_no bigint, row_no bigint, header string, cells array<string>", read)
    return rows.withColumns({c: F.col(c).cast("int") for c in ("table_no", "row_no")})


def table_rates(rows: DataFrame, key: str) -> DataFrame:
    """`(key, label, male_rate, female_rate)` of the six-cell rows: cell 1 is male, cell 4 is female, in percent."""
    return rows.select(
        col(key),
        F.col("header").alias("label"),
        percent_to_fraction(F.get("cells", F.lit(0))).alias("male_rate"),
        percent_to_fraction(F.get("cells", F.lit(3))).alias("female_rate"),
    )


def item_rates(items: DataFrame, key: str, male: str = "adult men", female: str = "adult women") -> DataFrame:
    """`(key, label, male_rate, female_rate)` from list items such as "… 12.3% … aged 18–24 years".

    The page gives one rate per age range and one per sex; the male rate of a range is its rate
    times male/female. The per-sex items are picked by min_by over the item number, so a page costs
    one aggregated row.
    """
    number = first_group(F.col("text"), DECIMAL_PATTERN).try_cast("double")
    marked = items.select(col(key), "item_no", "text", number.alias("rate"))
    by_sex = marked.groupBy(col(key)).agg(
        F.min_by(F.when(F.col("text").contains(male), F.col("rate")), F.when(F.col("text").contains(male), F.col("item_no"))).alias("male"),
        F.min_by(F.when(F.col("text").contains(female), F.col("rate")), F.when(F.col("text").contains(female), F.col("item_no"))).alias("female"),
    )
    ranges = marked.withColumn("label", first_group(F.col("text"), AGE_RANGE_PATTERN)).filter(F.col("label").isNotNull())
    factor = F.when(F.col("female") != 0, F.col("male") / F.nullif(F.col("female"), F.lit(0.0))).otherwise(F.lit(1.0))
    return ranges.join(by_sex, key, "left").select(
        col(key),
        "label",
        (F.col("rate") * factor / 100).alias("male_rate"),
        (F.col("rate") / 100).alias("female_rate"),
    )
