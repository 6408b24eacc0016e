"""Scans. Paths go to Spark unchanged, so any file system it is set up for works (`s3a://…` too)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.functions.columns import col
from grainmill.operators.rows import union_all
from grainmill.sources.stages import VERSION

Schema = T.StructType | str


def read_csv(spark: SparkSession, path, schema: Schema | None = None, header: bool = True, infer: bool = False, trim: bool = False) -> DataFrame:
    """CSV with a given schema, else all text; `infer` costs another pass over the data.

    `trim` drops padding around fields, so that padded numbers can be read as integers.
    """
    reader = spark.read.option("header", header).option("inferSchema", infer and schema is None)
    if trim:
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", True)
    return reader.csv(path)


def read_csv_columns(spark: SparkSession, path, columns: Sequence[str], schema: Schema | None = None, **options) -> DataFrame:
    """A column subset in list order: only these columns are parsed."""
    return read_csv(spark, path, schema, **options).select(*[col(c) for c in columns])


def read_json(spark: SparkSession, path, schema: Schema | None = None, array_files: bool = False) -> DataFrame:
    """JSON lines; `array_files` for files that hold one JSON array."""
    reader = spark.read.option("multiLine", array_files)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_xml(spark: SparkSession, path, schema: Schema, row_tag: str = "row") -> DataFrame:
    """Records under `row_tag`; a value that does not fit its type raises."""
    return spark.read.schema(schema).format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").load(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_text(spark: SparkSession, path) -> DataFrame:
    """One row `value` per line."""
    return spark.read.text(path)


def with_place(df: DataFrame) -> DataFrame:
    """A file scan with `file_path`, `file_block` and `position`: together they give the file order.

    A block is read by one task from its start, so the running id grows with the row's place in it.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("position"),
    )


def read_folder(spark: SparkSession, folder: str, schema: Schema, row_tag: str = "row") -> DataFrame:
    """All CSV, JSON and XML files of a folder as one frame; a format may be absent, but not all three.

    `source_rank` (CSV 0, JSON 1, XML 2) and the columns of `with_place` give the reading order.
    """
    folder = folder.rstrip("/")
    readers = [
        ("csv", lambda path: read_csv(spark, path, schema)),
        ("json", lambda path: read_json(spark, path, schema)),
        ("xml", lambda path: read_xml(spark, path, schema, row_tag)),
    ]
    found = [(rank, read(f"{folder}/*.{kind}")) for rank, (kind, read) in enumerate(readers) if _exists(spark, f"{folder}/*.{kind}")]
    if not found:
        raise FileNotFoundError(f"no CSV, JSON or XML file in {folder}")
    return union_all(*[with_place(df).withColumn("source_rank", F.lit(rank)) for rank, df in found])


def _exists(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def jdbc_options(url: str, table: str, column: str | None = None, lower=None, upper=None, partitions: int | None = None, **options) -> dict[str, str]:
    """Reader options; with a numeric or date column and its bounds the scan runs in parallel ranges."""
    found = {"url": url, "dbtable": table, **{k: str(v) for k, v in options.items()}}
    if column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        found |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return found


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table; credentials come from the caller's options."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: Schema | Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """`(table_name)` of a database, temporary views and the versions of stages' tables left out."""
    tables = spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")
    return tables.filter(~F.col("isTemporary") & ~F.col("tableName").rlike(VERSION.pattern)).select(F.col("tableName").alias("table_name"))
