"""From raw documents to packed training sequences: four stages, each written as Parquet and read again by the next.

Toxic documents go, then those of low quality; of each group of near copies one row stays, the one with the
smallest doc_id (without one only if no row of the group has any); what is left is packed. Stages learn from and
count over their own input. All but the last return the columns of their input. Null and empty texts are judged
like any other text (no words: of low quality). The near-copy stage decides by row: rows that share a doc_id, or
have none, are rows like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm.batches import unused
from grainmill.llm.catalog import GOOD, TOXIC, pieces_of, toxicity_labels
from grainmill.llm.quality import fit_quality, score_quality
from grainmill.llm.simhash import near_duplicates
from grainmill.llm.staging import stored, table
from grainmill.llm.toxicity import fit_toxicity, score_toxicity

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, score = fit_toxicity(docs, toxicity_labels(spark, sf_dir)), unused(docs, "score")
    return score_toxicity(docs, model, into=score, spans=False).where(F.col(score) < TOXIC).drop(score)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = unused(docs, "score")
    return score_quality(docs, fit_quality(docs), into=score).where(F.col(score) >= GOOD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = unused(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # numbers that stay as they are
    found = near_duplicates(rows, row, width=4, distance=4).select(F.col("id").alias(row), "component_id")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("best")
    kept = found.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(best)
    return rows.join(kept.select(F.col(f"best.{row}").alias(row)), row, "left_semi").select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces_of(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near copies", drop_near_copies),
    ("packing", pack_documents),
]

#: Trained models have no SQL; tests compare each stage with a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
