"""Car price flow: extract three formats, round, keep the first row per model, stage, load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.operators.clean import round_columns
from grainmill.operators.rows import keep_first_per_key
from grainmill.sources.readers import read_folder, read_parquet
from grainmill.sources.writers import write_parquet, write_table

CAR_SCHEMA = "car_model string, year_of_manufacture int, price double, fuel string"
FILE_ORDER = ("source_rank", "file_path", "file_block", "position")


def extract(spark: SparkSession, folder: str, schema: str = CAR_SCHEMA) -> DataFrame:
    """All rows of the folder with their place in reading order."""
    return read_folder(spark, folder, schema)


def transform(rows: DataFrame, key: str = "car_model", price: str = "price") -> DataFrame:
    """Prices to cents, first row per model in file order."""
    first = keep_first_per_key(round_columns(rows, 2, price), [key], [F.col(c) for c in FILE_ORDER])
    return first.drop(*FILE_ORDER)


def etl(spark: SparkSession, folder: str, staging: str, table: str, schema: str = CAR_SCHEMA) -> DataFrame:
    """Extract, transform, stage as parquet, load into a table."""
    write_parquet(transform(extract(spark, folder, schema)), staging)
    write_table(read_parquet(spark, staging), table)
    return spark.table(table)
