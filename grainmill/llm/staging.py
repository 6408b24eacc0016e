"""Tables written to the shared folder, so that a lost executor costs no recomputation of what stands before them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).withMetadata(df.columns[0], {"stored": path})


def forget(df: DataFrame) -> None:
    """Delete what `stored` wrote for `df`, once nothing reads it any more."""
    path = df.schema.fields[0].metadata.get("stored")
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def by_hash(df: DataFrame, key: str, n: int, total: int, seed: int) -> DataFrame:
    """Up to `n` of about `total` rows, those with the least hash of a key.

    Rows that can hardly be among them are filtered first, so that tasks don't each send `n` rows to be merged.
    """
    hashed = F.xxhash64(key, F.lit(seed))
    if total > 4 * n:
        df = df.where(F.pmod(hashed, F.lit(1 << 40)) < F.lit(int((1 << 40) * 4 * n / total)))
    return df.orderBy(F.pmod(hashed, F.lit(1 << 40)), key).limit(n)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
