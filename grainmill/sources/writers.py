"""Sinks. All but the single-file and driver forms write from the tasks that hold the rows."""

from __future__ import annotations

import pandas as pd
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.sources.stages import replace_tables, versions


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_csv_single(df: DataFrame, path: str, max_rows: int) -> None:
    """One CSV file, for results of at most `max_rows` rows: a larger frame raises before anything is written.

    The rows are gathered by a shuffle, so the work before it stays parallel.
    """
    _require_small(df, max_rows, "write_csv")
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table, at a path of its own if given; the frame must not read that table (see `stages`).

    A table that stages write gets a new version instead.
    """
    if versions(df.sparkSession, name):
        replace_tables(df.sparkSession, {name: df})
        return
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Replace a database table from all tasks."""
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, **options).save()


def write_text(df: DataFrame, path: str, line) -> None:
    """One line per row, from an expression."""
    df.select(line.cast("string").alias("value")).write.mode("overwrite").text(path)


def pair_line(word: str = "word", n: str = "n"):
    """Lines like `('The', 7)`; a word that holds a single quote but no double quote is put in double quotes."""
    text = F.col(word)
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, shown in (("\t", "\\t"), ("\r", "\\r"), ("\n", "\\n")):
        escaped = F.replace(escaped, F.lit(control), F.lit(shown))
    double = text.contains("'") & ~text.contains('"')
    quoted = F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )
    return F.concat(F.lit("("), quoted, F.lit(", "), F.col(n).cast("string"), F.lit(")"))


def write_report(metrics: DataFrame, path: str) -> None:
    """A metrics table as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def to_driver(df: DataFrame, max_rows: int) -> pd.DataFrame:
    """A result of at most `max_rows` rows as pandas; a larger one raises instead of being cut."""
    taken = df.limit(max_rows + 1).toPandas()
    if len(taken) > max_rows:
        raise ValueError(f"more than {max_rows} rows; aggregate first")
    return taken


def _require_small(df: DataFrame, max_rows: int, instead: str) -> None:
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows; use {instead}")
